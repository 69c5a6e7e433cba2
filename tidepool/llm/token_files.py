"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on ids.

Documents are dealt into ranges of their id and sorted, so each file holds a range.  ORC encodes the
ids in runs per stripe, keeps minimum and maximum per row group, and a Bloom filter on ``doc_id``, so
a look-up by id opens only the row groups that may hold it, and stripes are read in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.tokens import BATCH_IDS, END_ID, crc32, default_tokenizer, encoded_texts
from tidepool.storage import sized_join

SCHEMA = "doc_id long, local_start long, n_tokens long, ids array<int>"
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true", "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 * 1024 * 1024), "compression": "zstd",
}


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None,
                      end_id: int | None = END_ID) -> None:
    """Write the ids of every row of ``docs`` in ascending order of ``doc_id``.

    Rows without an id come first; rows that share an id are ordered by a hash of their text and
    then the text, so any number of them can be split over files.  A null or empty text has only
    its end id.  ``local_start`` counts the ids before a document in its file.
    """
    vocabulary = tokenizer or default_tokenizer()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), text.cast("binary").alias("t"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "t")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            keys, first, held, size = batch.column(0), 0, [], 0
            for i, ids in enumerate(encoded_texts(batch.column(2), vocabulary, end_id)):
                held.append(ids)
                size += len(ids) // 4
                if size >= BATCH_IDS or i + 1 == len(keys):
                    yield _file_rows(keys.slice(first, len(held)), held, start)
                    start, first, held, size = start + size, i + 1, [], 0

    ordered.mapInArrow(encode, SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def _file_rows(keys: pa.Array, held: list[bytes], start: int) -> pa.RecordBatch:
    n = np.array([len(x) // 4 for x in held], np.int64)
    ends = np.cumsum(n)
    ids = pa.array(np.frombuffer(b"".join(held), "<u4").astype(np.int32))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), ids)
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(start + ends - n), pa.array(n), lists],
        ["doc_id", "local_start", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of the files; with ``doc_ids``, statistics and Bloom filters prune what is read."""
    files = spark.read.schema(SCHEMA).orc(path)
    return files if doc_ids is None else files.filter(F.col("doc_id").isin(*doc_ids))


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the ids in the files."""
    files = read_token_files(spark, path).withColumn("file", F.col("_metadata.file_name"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    sizes = files.groupBy(number.alias("part")).agg(F.sum("n_tokens").alias("n"))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            ends = ids.offsets.to_numpy().astype(np.int64) * 4
            crc = [crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(np.diff(ends) // 4), pa.array(crc, pa.int64())],
                ["part", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    rows = files.select(number.alias("part"), "doc_id", "local_start", "ids").mapInArrow(
        digest, "part long, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    placed = sized_join(rows, starts, ["part"], spread="doc_id")
    return placed.select("doc_id", (F.col("file_start") + F.col("local_start")).alias("start"),
                         "n_tokens", "ids_crc32")
