"""Directory listings and one-entry JSON objects as records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, path: str, pattern: str = "*",
                 recursive: bool = False) -> DataFrame:
    """(name, path, length, modified) of the files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", recursive).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length",
                        F.col("modificationTime").alias("modified"))


def key_value_source(df: DataFrame, json: str, keep: list[str]) -> DataFrame:
    """(keep, key, value) of each entry of a JSON object column."""
    return df.select(*keep, F.explode(F.from_json(json, "map<string,string>")).alias("key",
                                                                                     "value"))
