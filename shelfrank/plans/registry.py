"""Named query registry: one Spark builder and (when SQL can express it) a DuckDB twin.

Names follow ``<inventory id>_<slug>`` so the registry can be checked line by
line against the operator inventory.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Role views shared by every oracle (same mapping as shelfrank.sources.roles).
ROLE_CTES = """
log AS (
  SELECT o_custkey AS user_idx, l_partkey AS item_idx, o_orderdate AS ts,
         CAST(l_returnflag <> 'R' AS INTEGER) AS relevance, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
users AS (
  SELECT c_custkey AS user_idx, c_mktsegment AS segment,
         CAST(c_acctbal AS DOUBLE) AS user_attr_0, CAST(c_nationkey AS DOUBLE) AS user_attr_1
  FROM customer),
items AS (
  SELECT p_partkey AS item_idx, p_type AS category, CAST(p_retailprice AS DOUBLE) AS price,
         CAST(p_size AS DOUBLE) AS item_attr_0, p_brand AS brand
  FROM part)"""


def with_roles(body: str, extra_ctes: str = "") -> str:
    """Prefix a SQL body with the role CTEs (and optional further CTEs)."""
    ctes = ROLE_CTES + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + body
