"""Exact token counts: a histogram of encoded lengths whose suffix sums answer every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.tokens import END_ID, token_counts

BLOCK = 1024  # lengths per block of the suffix sums


def length_histogram(docs: DataFrame, tokenizer: str | None = None,
                     end_id: int | None = END_ID) -> DataFrame:
    """``n_tokens, n_docs``: how many documents have each encoded length.

    Counting is partial before the shuffle, so a length that a third of all documents share costs
    one row per task.  A null or empty text has only its end id.  No documents give no rows.
    """
    counts = token_counts(docs, tokenizer, keys=(), end_id=end_id)
    return counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length: the documents and tokens at or above it, and what a limit there leaves.

    ``truncated_tokens`` is the total if every document is cut to at most that length;
    ``docs_up_to`` counts from below, so the smallest length with ``docs_up_to >= q * total`` is
    the q-quantile.  Sums run within blocks of lengths; only one row per block meets in one task.
    """
    h = histogram.withColumn("block", F.expr(f"n_tokens div {BLOCK}")).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"))
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, 0)
    summed = h.join(blocks, "block").withColumn(
        "docs_at_least", F.sum("n_docs").over(down) + F.col("docs_after")).withColumn(
        "tokens_at_least", F.sum("tokens").over(down) + F.col("tokens_after"))
    below = F.col("all_tokens") - F.col("tokens_at_least")
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"),
        (below + F.col("docs_at_least") * F.col("n_tokens")).alias("truncated_tokens"))


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut to at most ``limit``, for any limit."""
    kept = F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs"))
    return histogram.select(kept.alias("n")).first()["n"] or 0


def length_quantile(sums: DataFrame, q: float) -> int | None:
    """The smallest length that at least the share ``q`` of all documents does not exceed."""
    total = sums.agg(F.max("docs_up_to").alias("n")).first()["n"]
    if total is None:
        return None
    reached = sums.filter(F.col("docs_up_to") >= F.lit(q) * F.lit(total))
    return reached.agg(F.min("n_tokens").alias("n")).first()["n"]
