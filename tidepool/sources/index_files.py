"""Text forms of blocks, the merged index and the dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.functions.text import percent_restore
from tidepool.operators.index import index_line

_DEFAULT = IndexConfig()


def write_blocks(blocks: DataFrame, path: str, cfg: IndexConfig = _DEFAULT) -> None:
    """Lines ``block;term;freq;urls`` sorted by (block, term, shard) over all part files; a rerun
    replaces the files.  The block is a field, so there are as many files as tasks."""
    line = F.concat_ws(cfg.separator, F.col("block").cast("string"),
                       index_line(separator=cfg.separator))
    ordered = blocks.repartitionByRange("block", "term", "shard").sortWithinPartitions(
        "block", "term", "shard")
    ordered.select(line.alias("value")).write.mode("overwrite").text(path)


def parse_lines(lines: DataFrame, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    """``value`` lines to (term, freq, postings); fields behind the third are ignored."""
    parts = F.split("value", f"\\Q{cfg.separator}\\E")
    urls = F.transform(F.split(parts[2], ","),
                       lambda u: percent_restore(u, cfg.separator + ","))
    kept = [c for c in lines.columns if c != "value"]
    return lines.select(*kept, F.trim(parts[0]).alias("term"),
                        F.trim(parts[1]).cast("long").alias("freq"), urls.alias("postings"))


def read_blocks(spark: SparkSession, path: str, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    lines = spark.read.text(path)
    cut = F.instr("value", cfg.separator)
    return parse_lines(lines.select(
        F.substr(F.col("value"), F.lit(1), cut - 1).cast("long").alias("block"),
        F.substr(F.col("value"), cut + len(cfg.separator)).alias("value")), cfg)


def write_index(index: DataFrame, path: str, cfg: IndexConfig = _DEFAULT) -> None:
    """Lines sorted by (term, shard) over all part files in name order."""
    (index.repartitionByRange("term", "shard").sortWithinPartitions("term", "shard")
     .select(index_line(separator=cfg.separator).alias("value")).write.text(path))


def read_index(spark: SparkSession, path: str, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    return parse_lines(spark.read.text(path), cfg)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """``term offset`` lines, last term first."""
    (dictionary.orderBy(F.desc("term"))
     .select(F.concat_ws(" ", "term", F.col("byte_offset").cast("string")).alias("value"))
     .write.text(path))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", " ")
    return spark.read.text(path).select(parts[0].alias("term"),
                                        F.trim(parts[1]).cast("long").alias("byte_offset"))
