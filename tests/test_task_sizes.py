"""Tasks grow in number with the rows, not in size, and the rows stay the same."""

import datetime as dt
import re

import pytest

from shelfrank import session
from shelfrank.functions import histories as H
from shelfrank.functions.ranks import top_k_unseen_global
from shelfrank.models.popularity import WalkHistory, walk_forward_recs
from shelfrank.operators.evaluate import SlicePlan
from shelfrank.sources import roles

CONFS = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]


@pytest.fixture
def small_tasks(spark, monkeypatch):
    """Ten rows are a task's share, so that 200 rows need 20 tasks; the session's settings come back."""
    before = {c: spark.conf.get(c, None) for c in CONFS}
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    yield 10
    for c, v in before.items():
        spark.conf.set(c, v) if v else spark.conf.unset(c)


def _dealt(df, key):
    """Partition counts of the plan's explicit shuffles by ``key``."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [int(n) for n in re.findall(rf"RepartitionByExpression \[.*{key}#\d+L?.*\], (\d+)", plan)]


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def log(spark):
    rows = [(None if u == 3 else u, (u * 7 + i) % 23 if i else None, i, i % 2) for u in range(20) for i in range(10)]
    return spark.createDataFrame(rows, "user_idx long, item_idx long, ts long, relevance int").cache()


def test_history_window(log, small_tasks, monkeypatch):
    got = H.with_previous(log, 3, ["ts", "item_idx"])
    assert _dealt(got, "user_idx") == [20]
    monkeypatch.undo()
    plain = H.with_previous(log, 3, ["ts", "item_idx"])
    assert _dealt(plain, "user_idx") == [] and _rows(got) == _rows(plain)


def test_few_rows_leave_the_session_as_it_is(spark, log):
    before = {c: spark.conf.get(c, None) for c in CONFS}
    assert session.dealt(log, log.count(), "user_idx") is log
    assert {c: spark.conf.get(c, None) for c in CONFS} == before


def test_more_rows_raise_the_partitions_only(spark, small_tasks):
    spark.conf.set(CONFS[0], "30")
    spark.conf.set(CONFS[1], "3m")
    assert session.wide_enough(spark, 200) == 20
    assert [spark.conf.get(c) for c in CONFS] == ["30", "3m"]
    assert session.wide_enough(spark, 395) == 40
    assert [spark.conf.get(c) for c in CONFS] == ["40", "3m"]
    spark.conf.unset(CONFS[1])
    session.wide_enough(spark, 395)
    assert spark.conf.get(CONFS[1]) == "8m"


def test_joined_log(spark, small_tasks, tmp_path, monkeypatch):
    day = dt.datetime(2000, 1, 1)
    spark.createDataFrame([(i // 4 if i % 50 else None, i % 4, i % 9, "AR"[i % 2]) for i in range(200)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 7, day) for o in range(50)] + [(5, 6, day), (None, 1, day)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    got = roles.log(spark, str(tmp_path))
    assert _dealt(got, "l_orderkey") == [20] and _dealt(got, "o_orderkey") == [20]
    monkeypatch.undo()
    plain = roles.log(spark, str(tmp_path))
    assert _dealt(plain, "l_orderkey") == [] and _rows(got) == _rows(plain)


def test_unseen_ranks(spark, log, small_tasks, monkeypatch):
    ranked = spark.createDataFrame([(i, i + 1) for i in range(23)], "item_idx long, grank long")
    users = log.select("user_idx").distinct()
    got = top_k_unseen_global(ranked, users, log, 4)
    assert _dealt(got, "user_idx") == [20]
    monkeypatch.undo()
    assert _rows(got) == _rows(top_k_unseen_global(ranked, users, log, 4))


def test_walk_forward(spark, small_tasks, monkeypatch):
    plan = SlicePlan()
    rows = [(u, (u * 5 + i) % 17, dt.datetime(1999 + i // 12, 1 + i % 12, 3), 1) for u in range(12) for i in range(30)]
    log = spark.createDataFrame(rows, "user_idx long, item_idx long, ts timestamp_ntz, relevance int").cache()
    items = spark.createDataFrame([(i, 1.0 + i) for i in range(17)], "item_idx long, price double")
    history = WalkHistory.of(log, plan)
    assert history.seen.inputFiles()            # written: its size is known before it is dealt
    got = _rows(walk_forward_recs(log, items, plan, history=history))
    monkeypatch.undo()
    assert got and got == _rows(walk_forward_recs(log, items, plan))
