"""The registered queries, grouped by area, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidepool.storage import ship_package

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_queries() -> dict[str, Query]:
    from tidepool.plans import crawl, index, records, nested, stats, quality, changes, events

    out: dict[str, Query] = {}
    for module in (crawl, index, records, nested, stats, quality, changes, events):
        for name, query in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = query
    return out
