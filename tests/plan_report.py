"""Write PLANS.md: the physical-plan operators of the headline queries (sf0.1).

usage: python tests/plan_report.py [sf_dir]
Lists, per query, the parquet scans (columns read, pushed filters), the
exchanges, join strategies, window/limit operators and Python steps, from
``explain("formatted")``.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"^\(\d+\) (Scan parquet|Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|"
                  r"ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|WindowGroupLimit|Window|"
                  r"MapInPandas|MapInArrow|FlatMapGroupsInPandas|ObjectHashAggregate|HashAggregate|"
                  r"TakeOrderedAndProject|Generate|InMemoryTableScan)")


def main(sf_dir="/root/testdata/sf0.1"):
    import bench
    import __spark_entry__ as E
    from shelfrank.session import get_spark
    spark = get_spark("local[4]")
    qs = E.queries()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tests/plan_report.py` at `{sf_dir}` (AQE initial plans; `explain(\"formatted\")`).",
           "Operator counts per query, then the scans with the columns they read and the pushed filters.", ""]
    for name in bench.HEADLINE:
        spark.catalog.clearCache()          # each query shows its own plan, not cached frames of the ones before
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        ops = {}
        for line in text.splitlines():
            m = KEEP.match(line)
            if m:
                ops[m.group(1)] = ops.get(m.group(1), 0) + 1
        scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:.*\n)*?Location: [^\n]*\[([^\]]*)\][^\n]*\n"
                           r"(?:PushedFilters: ([^\n]*)\n)?ReadSchema: ([^\n]*)", text)
        out.append(f"## {name}")
        out.append("")
        out.append("operators: " + ", ".join(f"{k} x{v}" for k, v in sorted(ops.items())))
        out.append("")
        seen = set()
        for loc, pf, rs in scans:
            key = (os.path.basename(loc.split(",")[0].strip()), pf, rs)
            if key in seen:
                continue
            seen.add(key)
            out.append(f"- `{key[0]}` reads `{rs}`" + (f"; pushed `{pf}`" if pf else ""))
        out.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main(*sys.argv[1:])
