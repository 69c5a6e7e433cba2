"""Queries into JSON columns: paths, wildcards and search at any depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.storage import materialize

Step = str | int


def _children(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Members of objects and arrays, one row each, with their normalised path."""
    view = F.variant_get("v", "$", "variant")
    source = rows.select(*keep, "path", view.alias("v"))
    names = ", ".join(f"s.`{c}`" for c in keep)
    step = "CASE WHEN t.key IS NULL THEN concat('[', t.pos, ']') ELSE concat('[''', t.key, ''']') END"
    return source.sparkSession.sql(
        f"SELECT {names}, concat(s.path, {step}) AS path, t.value AS v, t.key AS key "
        "FROM {s} AS s, LATERAL variant_explode(s.v) AS t", s=source)


def _parsed(df: DataFrame, json: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.lit("$").alias("path"), F.try_parse_json(json).alias("v")).filter(
        "v IS NOT NULL")


def _values(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    return rows.select(*keep, "path", F.col("v").cast("string").alias("value"))


def json_path(df: DataFrame, json: str, keep: Sequence[str], steps: Sequence[Step]) -> DataFrame:
    """(keep, path, value) of the values the steps lead to; a step is a member name, an array index
    or ``*`` for all members."""
    rows = _parsed(df, json, keep)
    for step in steps:
        if step == "*":
            rows = _children(rows, keep).drop("key")
            continue
        part = f"[{step}]" if isinstance(step, int) else f"['{step}']"
        rows = rows.select(*keep, F.concat("path", F.lit(part)).alias("path"),
                           F.try_variant_get("v", f"${part}", "variant").alias("v")).filter(
                               "v IS NOT NULL")
    return _values(rows, keep)


def wildcard_values(df: DataFrame, json: str, keep: Sequence[str]) -> DataFrame:
    return json_path(df, json, keep, ["*"])


def recursive_find(df: DataFrame, json: str, keep: Sequence[str], name: str) -> DataFrame:
    """(keep, path, value) of every member called ``name`` at any depth.

    One pass per level of nesting over what that level holds, until a level holds nothing.
    """
    level, out = _parsed(df, json, keep), None
    while True:
        hit = F.coalesce(F.col("key") == name, F.lit(False))
        # Scalars have no members and fall away with the next level by themselves.
        level = materialize(_children(level, keep).withColumn("hit", hit).drop("key"), "members")
        if level.isEmpty():
            return out if out is not None else _values(level.filter("hit"), keep)
        hits = _values(level.filter("hit"), keep)
        out = hits if out is None else out.unionByName(hits)
        level = level.drop("hit")


def flatten_table(df: DataFrame, items: str, keep: Sequence[str],
                  columns: Sequence[str]) -> DataFrame:
    """An array of records as rows with the selected columns."""
    return df.select(*keep, F.explode(items).alias("_r")).select(
        *keep, *[F.col(f"_r.{c}").alias(c) for c in columns])
