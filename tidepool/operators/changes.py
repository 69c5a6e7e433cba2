"""Change logs and differences between query results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.ordered import CHUNK, order_chunks, row_numbers, shift


def _with_previous(log: DataFrame, key: str, order: Sequence[str], op: str) -> DataFrame:
    parts = order_chunks(log, [key], order)
    return shift(parts, [key], order, {"_prev": F.col(op)}).drop(CHUNK)


def net_changes(log: DataFrame, payload: Sequence[str], key: str = "key",
                order: Sequence[str] = ("seq",), op: str = "op") -> DataFrame:
    """What a log comes to, one row per key: (key, op, payload).

    ``put`` inserts or replaces, ``remove`` deletes, ``add`` inserts and is refused where the key
    exists.  After a put or an add the key exists, after a remove it does not, so only a key's first
    change depends on the table it is applied to: the net change is an ``add`` if that first change
    is an add and every later one was refused.
    """
    return _net(_with_previous(log, key, order, op), payload, key, order, op)


def _net(seen: DataFrame, payload: Sequence[str], key: str, order: Sequence[str],
         op: str) -> DataFrame:
    is_add, first = F.col(op) == "add", F.col("_prev").isNull()
    refused = is_add & ~first & F.col("_prev.v").isin("put", "add")
    change = F.struct(op, *payload)
    sure = F.max_by(F.when(~refused, change), F.when(~refused & ~(is_add & first),
                                                     F.struct(*order)))
    opening = F.max(F.when(is_add & first, change))
    net = seen.groupBy(key).agg(F.coalesce(sure, opening).alias("_c"), sure.isNull().alias("_a"))
    kind = F.when(F.col("_a"), "add").when(F.col(f"_c.{op}") == "remove", "remove").otherwise("put")
    return net.select(key, kind.alias(op), *[F.col(f"_c.{c}").alias(c) for c in payload])


def overlay(base: DataFrame, net: DataFrame, payload: Sequence[str], key: str = "key",
            op: str = "op") -> DataFrame:
    """``base`` (key, payload) after net changes: one full join on unique keys."""
    old = base.select(key, *payload).withColumn("_live", F.lit(True))
    new = net.select(key, F.col(op).alias("_op"), *[F.col(c).alias(f"_n_{c}") for c in payload])
    keep_old = F.col("_op").isNull() | ((F.col("_op") == "add") & F.col("_live").isNotNull())
    return old.join(new, key, "full").filter("_op IS NULL OR _op <> 'remove'").select(
        key, *[F.when(keep_old, F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c) for c in payload])


def settled(net: DataFrame, base: DataFrame, key: str = "key", op: str = "op") -> DataFrame:
    """Net changes that hold without ``base``: adds become puts or, where the key exists, vanish."""
    live = base.select(key, F.lit(True).alias("_live"))
    joined = net.join(live, key, "left").filter(f"{op} <> 'add' OR _live IS NULL")
    return joined.withColumn(op, F.when(F.col(op) == "remove", "remove").otherwise("put")).drop(
        "_live")


def apply_changes(base: DataFrame, log: DataFrame, payload: Sequence[str], key: str = "key",
                  order: Sequence[str] = ("seq",), op: str = "op") -> tuple[DataFrame, DataFrame]:
    """(state, errors): ``base`` (key, payload) after the log, and the adds that were refused."""
    seen = _with_previous(log, key, order, op)
    state = overlay(base, _net(seen, payload, key, order, op), payload, key, op)
    adds = seen.filter(F.col(op) == "add")
    late = adds.filter(F.col("_prev.v").isin("put", "add"))
    first = adds.filter("_prev IS NULL").join(base.select(key), key, "left_semi")
    return state, first.unionByName(late).select(*log.columns)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, sort: Sequence[Column],
                  payload: Sequence[str], include_updates: bool = False) -> DataFrame:
    """(key, removed_from, inserted_into): rows that left, entered or changed between two results.

    Positions are 0-based in the order of ``sort`` (which must end in a unique column), -1 for
    "not there".  Rows that only moved because others did are not reported; a changed row that
    kept its place is reported with ``include_updates``.
    """
    def placed(df: DataFrame, name: str) -> DataFrame:
        rows = row_numbers(df.select(key, *payload), sort, name)
        return rows.select(key, name, F.struct(*payload).alias(f"{name}_data"))

    both = placed(old, "_from").join(placed(new, "_into"), key, "full")
    changed = (F.col("_from").isNull() | F.col("_into").isNull()
               | ~F.col("_from_data").eqNullSafe(F.col("_into_data")))
    rows = both.filter(changed).select(
        key, F.coalesce("_from", F.lit(-1)).alias("removed_from"),
        F.coalesce("_into", F.lit(-1)).alias("inserted_into"))
    return rows if include_updates else rows.filter("removed_from <> inserted_into")
