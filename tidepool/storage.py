"""Shared-folder tables that cut lineage, and size-checked joins.

Intermediate results that must not be recomputed (range-partitioned chunks, crawl rounds) are
written as Parquet below ``spark.checkpoint.dir``.  They survive the loss of executors, prune
columns when read back, and are never kept on a worker's own disk.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that functions which run on them
    find it wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="tidepool-package-"), "tidepool_package")
    context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(folder), "tidepool"))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master that names none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/tidepool/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> bool:
    """Delete every scratch table this application wrote."""
    jvm = spark.sparkContext._jvm
    root = f"{shared_dir(spark).rstrip('/')}/tidepool/{spark.sparkContext.applicationId}"
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (one aggregate job) and tell whether a broadcast of it is safe."""
    cells = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16
             for c in df.columns]
    total: Column = cells[0]
    for cell in cells[1:]:
        total = total + cell
    size = df.select(F.sum(total.cast("long")).alias("n")).first()["n"]
    return (size or 0) <= max_bytes


def hot_keys(df: DataFrame, on: list[str], rows: int) -> DataFrame:
    """(on, n) of the keys with more than ``rows`` rows, of which there are (rows of df) / rows."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows)


def sized_join(big: DataFrame, small: DataFrame, on: list[str], spread: str,
               how: str = "inner", hot_rows: int = 5_000_000,
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Equi-join that holds when one key owns a large part of ``big``.

    ``small`` is written once and broadcast if it was measured to fit.  Otherwise the keys with more
    than ``hot_rows`` rows in ``big`` are found first: their rows are dealt by a hash of ``spread``
    into as many sub-groups as leave ``hot_rows`` rows in each, and the matching rows of ``small``
    are repeated once per sub-group.  All other keys are joined as they are.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} cannot repeat the right side")
    small = materialize(small, "side")
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    hot = hot_keys(big, on, hot_rows).withColumn("_salts", F.ceil(F.col("n") / hot_rows)).drop("n")
    hot = materialize(hot, "hot")
    if hot.isEmpty():
        return big.join(small, on, how)
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_salts"))
                  ).otherwise(0)
    salted = big.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1).cast("long")) - 1)
    repeated = small.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def narrow_join(big: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join wide rows with a table (unique in ``on``) that concerns some of them, ``inner`` or ``left``.

    ``side`` is written once.  If its keys alone were measured to fit a broadcast, they pick the rows
    that meet it, and only those are shuffled; the others of a left join stay where they are.  If not,
    it is one plain join.  Skewed keys are left to adaptive execution, which can split them.
    """
    side = materialize(side, "side")
    keys = side.select(*on)
    if not fits_broadcast(keys):
        return big.join(side, on, how)
    met = big.join(F.broadcast(keys), on, "left_semi").join(side, on)
    if how == "inner":
        return met
    return met.unionByName(big.join(F.broadcast(keys), on, "left_anti"), allowMissingColumns=True)
