"""What a stream has stored so far, in blocks that are merged in tiers.

Every micro-batch adds a block.  When ``fanout`` blocks of one level have come together they become
one block of the next level, so a reader meets a number of blocks that grows with the logarithm of
the batches, and each row is rewritten as often as that.  A manifest per batch names the blocks that
count after it; blocks and manifests are only ever replaced by the batch that wrote them, so a batch
that runs again, and readers of earlier manifests, see what they saw before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.crawl import unseen
from tidepool.storage import materialize

_MANIFEST = "folder STRING, level INT, batch BIGINT"


class Block(NamedTuple):
    folder: str
    level: int
    batch: int      # the latest that is in it


class Tiers:
    """``merge`` makes one table of the rows of several blocks; it is told whether they are all there
    is.  ``write`` stores a table in a folder; by default as plain Parquet."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame, bool], DataFrame],
                 read: Callable[[Block], DataFrame],
                 write: Callable[[DataFrame, str], None] | None = None, fanout: int = 4):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.merge, self.read_block = merge, read
        self.write = write or (lambda df, folder: df.write.mode("overwrite").parquet(folder))

    def blocks(self, batch_id: int) -> list[Block]:
        """The blocks that count before a batch; as many as the logarithm of the batches."""
        if batch_id <= 0:
            return []
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/batch={batch_id - 1}")
        return sorted((Block(*r) for r in rows.select("folder", "level", "batch").collect()),
                      key=lambda b: b.batch)

    def read(self, blocks: Sequence[Block]) -> DataFrame | None:
        return reduce(DataFrame.unionByName, map(self.read_block, blocks)) if blocks else None

    def append(self, folder: str, batch_id: int) -> list[Block]:
        """Count a block that was written to ``folder``, merge what is due, and note the result."""
        blocks = [*self.blocks(batch_id), Block(folder, 0, batch_id)]
        level = 0
        while sum(b.level == level for b in blocks) >= self.fanout:
            due = [b for b in blocks if b.level == level]
            rest = [b for b in blocks if b.level != level]
            merged = f"{self.path}/level-{level + 1}-batch-{batch_id}"
            self.write(self.merge(self.read(due), not rest), merged)
            level += 1
            blocks = [*rest, Block(merged, level, batch_id)]
        self.spark.createDataFrame(blocks, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/batch={batch_id}")
        return blocks


class VisitedSet:
    """URLs that were seen, in hash buckets, each in ranges with a Bloom filter on ``url``.

    A batch of candidates opens only the buckets that its own URLs fall into; of these, a batch of at
    most ``pushed`` URLs reads only the row groups whose Bloom filter holds one of them.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, pushed: int = 1000,
                 fanout: int = 4):
        self.spark, self.path, self.buckets, self.pushed = spark, path, buckets, pushed
        self.tiers = Tiers(spark, path, lambda rows, _: rows.distinct(), self._open, self._store,
                           fanout)

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("url"), F.lit(self.buckets)).cast("int"))

    def _open(self, block: Block) -> DataFrame:
        return self.spark.read.schema("url STRING, bucket INT").parquet(block.folder)

    def _store(self, df: DataFrame, folder: str) -> None:
        dealt = self._bucket(df.select("url")).repartition("bucket").sortWithinPartitions("bucket", "url")
        dealt.write.mode("overwrite").option("parquet.bloom.filter.enabled#url", "true").partitionBy(
            "bucket").parquet(folder)

    def candidates(self, urls: DataFrame) -> DataFrame:
        """Each URL once, with its bucket, as a written table; URLs that are null are left out."""
        return materialize(self._bucket(urls.select("url").filter("url IS NOT NULL").distinct()),
                           "candidates")

    def opened(self, candidates: DataFrame, batch_id: int) -> DataFrame | None:
        """The part of what was seen before a batch that its candidates can meet."""
        blocks = self.tiers.blocks(batch_id)
        touched = [r["bucket"] for r in candidates.select("bucket").distinct().collect()]
        if not blocks or not touched:
            return None
        seen = self.tiers.read(blocks).filter(F.col("bucket").isin(touched))
        few = candidates.select("url").limit(self.pushed + 1).collect()
        if len(few) <= self.pushed:
            seen = seen.filter(F.col("url").isin([r["url"] for r in few]))
        return seen

    def unseen(self, urls: DataFrame, batch_id: int) -> DataFrame:
        """Each URL once that no earlier batch has added."""
        rows = self.candidates(urls)
        name = "spark.sql.parquet.pushdown.inFilterThreshold"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, str(self.pushed))
        try:
            seen = self.opened(rows, batch_id)
            if seen is None:
                return rows.select("url")
            return materialize(unseen(rows.select("url"), seen.select("url")), "unseen")
        finally:
            self.spark.conf.set(name, before)

    def add(self, urls: DataFrame, batch_id: int) -> None:
        """Add the URLs that a batch found new."""
        folder = f"{self.path}/block-{batch_id}"
        self._store(urls, folder)
        self.tiers.append(folder, batch_id)


class Parts:
    """A table cut into numbered parts, of which a batch replaces those that it changes.

    A manifest per batch says which version of each part counts and how many rows it has, so reading
    some parts opens their latest files only, and the rows before a part can be counted without it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, most: int):
        self.spark, self.path, self.schema, self.most = spark, path, schema, most

    def manifest(self, batch_id: int) -> DataFrame:
        """(part, version, n) before a batch; at most ``most`` rows."""
        return self.spark.read.schema("part INT, version BIGINT, n BIGINT").parquet(
            f"{self.path}/manifest/batch={batch_id - 1}")

    def read(self, batch_id: int, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows, with their ``part``, before a batch: all, or those of some parts."""
        known = self.manifest(batch_id).filter("n > 0")
        if parts is not None:
            known = known.filter(F.col("part").isin(list(parts)))
        wanted = F.lit(False)
        versions: dict[int, list[int]] = {}
        for r in known.collect():
            versions.setdefault(r["version"], []).append(r["part"])
        for version, some in versions.items():
            wanted |= (F.col("version") == version) & F.col("part").isin(some)
        rows = self.spark.createDataFrame([], f"{self.schema}, part INT") if not versions else (
            self.spark.read.schema(f"{self.schema}, version BIGINT, part INT").parquet(
                f"{self.path}/rows").filter(wanted).drop("version"))
        return rows

    def replace(self, rows: DataFrame, batch_id: int, parts: Sequence[int] | None) -> None:
        """Put ``rows`` (with ``part``) in the place of some parts, or of all."""
        folder = f"{self.path}/rows/version={batch_id}"
        rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(folder)
        counts = self.spark.read.schema(f"{self.schema}, part INT").parquet(folder).groupBy(
            "part").agg(F.count(F.lit(1)).alias("n"))
        new = counts.select("part", F.lit(batch_id).cast("long").alias("version"), "n")
        if parts is not None:
            new = self.manifest(batch_id).filter(~F.col("part").isin(list(parts))).unionByName(new)
        new.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
