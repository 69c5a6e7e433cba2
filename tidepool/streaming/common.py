"""Reading table folders as streams and running them to the end of the available input."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidepool.storage import scratch_path

FILE_ROWS, FILE_BYTES = 1_000_000, 16 * 1024 * 1024  # of one file that arrives


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                   files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def arrival(df: DataFrame, order: str, parts: int) -> Column:
    """The part, from 0, of a row: ranges of equal width of ``order``, a whole number; nulls first."""
    ends = df.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    if ends["low"] is None:
        return F.lit(0)
    low, width = int(ends["low"]), int(ends["high"]) - int(ends["low"]) + 1
    place = (F.col(order).cast("long") - F.lit(low)) * F.lit(parts)
    return F.coalesce(F.floor(place / F.lit(width)).cast("int"), F.lit(0))


def in_files(df: DataFrame, order: str, parts: int = 4, files: int | None = 1) -> str:
    """Write a table as it might arrive and return the folder: one range of ``order`` after the other,
    each in ``files`` files, so that ``files_per_trigger=files`` makes every range a micro-batch.

    The table is read once.  Rows without an order come with the first range.
    """
    return dealt(df, order, parts, files)[0]


def arriving(df: DataFrame, order: str, parts: int = 4, schema: T.StructType | None = None) -> DataFrame:
    """The table as a stream in which every range of ``order`` is a micro-batch; see :func:`in_files`.

    A range is written by as many tasks as leave at most FILE_ROWS rows or FILE_BYTES to each.
    """
    folder, files = dealt(df, order, parts)
    return parquet_stream(df.sparkSession, folder, schema or df.schema, files_per_trigger=files)


def dealt(df: DataFrame, order: str, parts: int = 4, files: int | None = None) -> tuple[str, int]:
    """The folder of :func:`in_files` and how many files each range has; without ``files`` as many as
    the largest range needs."""
    spark = df.sparkSession
    staged, path = scratch_path(spark, "ranges"), scratch_path(spark, "arriving")
    df.withColumn("_part", arrival(df, order, parts)).write.partitionBy("_part").parquet(staged)
    stored = spark.read.schema("_part INT").parquet(staged).select(
        "_part", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    stored = stored.groupBy("_part", "file").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    found = stored.groupBy("_part").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).orderBy(
        "_part").collect()  # at most ``parts`` rows
    if files is None:
        files = max([1, *(-(-r["n"] // FILE_ROWS) for r in found), *(-(-r["size"] // FILE_BYTES) for r in found)])
    for turn, r in enumerate(found, 1):
        rows = spark.read.schema(df.schema).parquet(f"{staged}/_part={r['_part']}")
        rows.repartition(files).write.mode("append").parquet(path)
        # a range of very few rows leaves some files out; empty ones keep the next range apart
        for _ in range(turn * files - len(spark.read.schema(df.schema).parquet(path).inputFiles())):
            spark.createDataFrame([], df.schema).write.mode("append").parquet(path)
    return path, files


@contextmanager
def state_store(spark: SparkSession):
    """Let queries that start inside keep their state in RocksDB, which operators with state of their
    own need; larger than memory, with changes written to the checkpoint."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run_available(writer: DataStreamWriter, checkpoint: str | None = None,
                  spark: SparkSession | None = None):
    """Process everything there is, in micro-batches, and stop."""
    if checkpoint is None:
        checkpoint = scratch_path(spark or SparkSession.active(), "offsets")
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batches(query) -> int:
    """How many micro-batches a query that has ended has run since its checkpoint began."""
    return 0 if query.lastProgress is None else query.lastProgress["batchId"] + 1


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch; a batch that is run again replaces its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
