"""Change logs: ``lineitem`` read as changes to ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import changes as ops
from tidepool.operators.records import sort_key
from tidepool.plans import Query, table


def _cents(column):
    return F.round(F.col(column) * 100).cast("long")


def base(spark, sf):
    """All orders; the log replaces, removes and adds some."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), _cents("o_totalprice").alias("cents"))


# Order lines share line numbers, so further columns decide which of two changes came first.
ORDER = ["seq", "l_partkey", "l_suppkey", "cents", "l_returnflag", "l_quantity"]


def log_of(lines):
    op = (F.when(F.col("l_returnflag") == "A", "add").when(F.col("l_returnflag") == "R", "remove")
          .otherwise("put"))
    return lines.select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").cast("long").alias("seq"),
        op.alias("op"), _cents("l_extendedprice").alias("cents"), "l_partkey", "l_suppkey",
        "l_returnflag", "l_quantity")


def log(spark, sf):
    return log_of(table(spark, sf, "lineitem"))


def apply_changes(spark, sf):
    state, _ = ops.apply_changes(base(spark, sf), log(spark, sf), ["cents"], order=ORDER)
    return state


def change_errors(spark, sf):
    _, errors = ops.apply_changes(base(spark, sf), log(spark, sf), ["cents"], order=ORDER)
    return errors.select("key", "seq", "cents")


def snapshot_diff(spark, sf):
    old = base(spark, sf)
    new, _ = ops.apply_changes(old, log(spark, sf), ["cents"], order=ORDER)
    keys = [sort_key("cents", descending=True), sort_key("key")]
    return ops.snapshot_diff(old.filter("cents > 2500000"), new.filter("cents > 2500000"), "key",
                             keys, ["cents"])


LOG_SQL = """base AS (SELECT o_orderkey AS key, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders),
  log AS (SELECT l_orderkey AS key, CAST(l_linenumber AS BIGINT) AS seq,
      CASE l_returnflag WHEN 'A' THEN 'add' WHEN 'R' THEN 'remove' ELSE 'put' END AS op,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        round(l_extendedprice * 100), l_returnflag, l_quantity) AS nr FROM lineitem),
  seen AS (SELECT *, lag(op) OVER (PARTITION BY key ORDER BY nr) AS prev FROM log),
  checked AS (SELECT *, op = 'add' AND CASE WHEN prev IS NULL THEN key IN (SELECT key FROM base)
                ELSE prev IN ('put', 'add') END AS error FROM seen),
  last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY nr DESC) AS k
             FROM checked WHERE NOT error) WHERE k = 1),
  state AS (SELECT key, cents FROM base WHERE key NOT IN (SELECT key FROM last)
            UNION ALL SELECT key, cents FROM last WHERE op <> 'remove')"""

DIFF_SQL = """
  o AS (SELECT *, row_number() OVER (ORDER BY cents DESC, key) - 1 AS pos FROM base
        WHERE cents > 2500000),
  n AS (SELECT *, row_number() OVER (ORDER BY cents DESC, key) - 1 AS pos FROM state
        WHERE cents > 2500000)
  SELECT coalesce(o.key, n.key) AS key, coalesce(o.pos, -1) AS removed_from,
    coalesce(n.pos, -1) AS inserted_into
  FROM o FULL JOIN n ON o.key = n.key
  WHERE o.cents IS DISTINCT FROM n.cents AND coalesce(o.pos, -1) <> coalesce(n.pos, -1)"""

QUERIES = {
    "apply_changes": Query(apply_changes, f"WITH {LOG_SQL} SELECT key, cents FROM state"),
    "change_errors": Query(change_errors,
                           f"WITH {LOG_SQL} SELECT key, seq, cents FROM checked WHERE error"),
    "snapshot_diff": Query(snapshot_diff, f"WITH {LOG_SQL}, {DIFF_SQL}"),
}
