"""Inverted index: tokens, postings, shards, blocks, dictionary and search.

The normalised table ``postings(term, url, tf)`` is the store.  Postings arrays are cut into
document shards, so the array of the most frequent term is as short as a shard has documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.functions.text import html_to_text, percent_escape, tokens
from tidepool.operators.ordered import prefix_sum, row_numbers
from tidepool.storage import materialize, sized_join

_DEFAULT = IndexConfig()


def page_text(pages: DataFrame, mode: str = "text") -> DataFrame:
    """(url, text): visible text, or the markup as it is."""
    body = html_to_text("html") if mode == "text" else F.col("html")
    return pages.select("url", body.alias("text"))


def tokenize(docs: DataFrame, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    """One row per token of ``text``, in the case it was written; other columns are kept."""
    kept = [c for c in docs.columns if c != "text"]
    return docs.select(*kept, F.explode(tokens("text", cfg.words_only)).alias("token"))


def exclude_tokens(toks: DataFrame, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    """Drop excluded tokens, compared as written unless ``exclude_ci``."""
    compared = F.lower("token") if cfg.exclude_ci else F.col("token")
    return toks.filter(~compared.isin(list(cfg.excluded)))


def lowercase_terms(toks: DataFrame) -> DataFrame:
    return toks.select(*[c for c in toks.columns if c != "token"], F.lower("token").alias("term"))


def document_index(docs: DataFrame, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    """(url, term, tf) of documents (url, text)."""
    terms = lowercase_terms(exclude_tokens(tokenize(docs.select("url", "text"), cfg), cfg))
    return terms.groupBy("url", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(postings: DataFrame) -> DataFrame:
    """(term, freq, df) over the whole collection."""
    return postings.groupBy("term").agg(F.sum("tf").alias("freq"), F.count(F.lit(1)).alias("df"))


def shard_of(url: Column | str, shards: int) -> Column:
    """Shard of a document: the first 28 bits of its md5, modulo the number of shards."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(url) if isinstance(url, str) else url), 1, 7),
                         16, 10).cast("long"), F.lit(shards)).cast("int")


def shard_count(docs: DataFrame, cfg: IndexConfig = _DEFAULT) -> int:
    """From the number of rows, which a Parquet table knows without being read."""
    return max(1, math.ceil(docs.count() / cfg.docs_per_shard))


def inverted_index(postings: DataFrame, shards: int) -> DataFrame:
    """(term, shard, freq, df, postings): sums and the sorted URLs per term and document shard."""
    return postings.groupBy("term", shard_of("url", shards).alias("shard")).agg(
        F.sum("tf").alias("freq"), F.count(F.lit(1)).alias("df"),
        F.array_sort(F.collect_list("url")).alias("postings"))


def _counted(docs: DataFrame, order: str, cfg: IndexConfig) -> DataFrame:
    """(order, url, bytes, term, tf) of documents; one without terms has one row with a null term."""
    words = tokens("text", cfg.words_only)
    shape = F.lower if cfg.exclude_ci else (lambda t: t)
    kept = F.transform(F.filter(words, lambda t: ~shape(t).isin(list(cfg.excluded))), F.lower)
    size = F.octet_length("text").cast("long").alias("bytes")
    terms = docs.select(order, "url", size, F.explode_outer(kept).alias("term"))
    return terms.groupBy(order, "url", "bytes", "term").agg(F.count("term").alias("tf"))


def build_blocks(docs: DataFrame, order: str, cfg: IndexConfig = _DEFAULT,
                 shards: int | None = None) -> DataFrame:
    """Partial indices (block, term, shard, freq, df, postings).

    Documents (``order``, url, text) fill a block until its text exceeds ``block_bytes``, so a
    block's postings arrays are bounded by the block size.  The text is read once: counts per
    document are written, and what follows moves only those.
    """
    shards = shards or shard_count(docs, cfg)
    counted = materialize(_counted(docs, order, cfg), "counted")
    sizes = counted.groupBy(order).agg(F.max("bytes").alias("bytes"))
    numbered = prefix_sum(sizes, [order], F.coalesce("bytes", F.lit(0)), "before").select(
        order, (F.floor(F.col("before") / cfg.block_bytes) + 1).alias("block"))
    placed = counted.filter("term IS NOT NULL").join(numbered, order)
    urls = F.array_sort(F.collect_set("url"))
    lines = placed.groupBy("block", "term", shard_of("url", shards).alias("shard")).agg(
        F.sum("tf").alias("freq"), urls.alias("postings"))
    return lines.select("block", "term", "shard", "freq",
                        F.size("postings").cast("long").alias("df"), "postings")


def merge_blocks(blocks: DataFrame, shards: int) -> DataFrame:
    """One index (term, shard, freq, df, postings) from blocks (term, freq, postings).

    A line holds the URLs of one shard, so lines meet per (term, shard), which bounds every array;
    blocks read from text find their shard by a line's first URL.
    """
    if "shard" not in blocks.columns:
        blocks = blocks.withColumn("shard", shard_of(F.col("postings")[0], shards))
    urls = F.array_sort(F.array_distinct(F.flatten(F.collect_list("postings"))))
    merged = blocks.groupBy("term", "shard").agg(F.sum("freq").alias("freq"), urls.alias("postings"))
    return merged.select("term", "shard", "freq", F.size("postings").cast("long").alias("df"),
                         "postings")


def index_line(freq: str = "freq", separator: str = _DEFAULT.separator) -> Column:
    """The text form ``term;freq;url,url`` with ``;``, ``,`` and ``%`` in URLs percent-encoded."""
    urls = F.transform("postings", lambda u: percent_escape(u, separator + ","))
    return F.concat_ws(separator, "term", F.col(freq).cast("string"), F.array_join(urls, ","))


def build_dictionary(index: DataFrame, cfg: IndexConfig = _DEFAULT) -> DataFrame:
    """(term, byte_offset, byte_len) of each term's lines in the text index sorted by term, shard."""
    size = (F.octet_length(index_line(separator=cfg.separator)) + 1).cast("long")
    lines = index.select("term", "shard", size.alias("bytes"))
    placed = prefix_sum(lines, ["term", "shard"], F.col("bytes"), "before")
    return placed.groupBy("term").agg(F.min("before").alias("byte_offset"),
                                      F.sum("bytes").alias("byte_len"))


def sort_terms(index: DataFrame, position: str | None = None) -> DataFrame:
    """Total order on terms, by code point; with ``position`` as a column of that name."""
    return row_numbers(index, ["term"], position) if position else index.orderBy("term")


def search_term(postings: DataFrame, term: str, exact: bool = False) -> DataFrame:
    """(term, url, tf) of one term; the query is lower-cased as the index is, unless ``exact``."""
    return postings.filter(F.col("term") == (term if exact else term.lower()))


def search_batch(postings: DataFrame, queries: DataFrame) -> DataFrame:
    """Postings of many terms at once; ``queries`` has a ``term`` column."""
    wanted = queries.select(F.lower("term").alias("term")).distinct()
    return sized_join(postings, wanted, ["term"], spread="url")


def search_json(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(term, shard, json): the postings as JSON arrays, one per shard of a term."""
    wanted = [t.lower() for t in terms]
    return index.filter(F.col("term").isin(wanted)).select(
        "term", "shard", F.to_json("postings").alias("json"))


def search_all(postings: DataFrame, terms: Sequence[str]) -> DataFrame:
    """URLs that hold every term."""
    wanted = list(dict.fromkeys(t.lower() for t in terms))
    hits = postings.filter(F.col("term").isin(wanted)).groupBy("url").agg(
        F.count(F.lit(1)).alias("_n"))
    return hits.filter(F.col("_n") == len(wanted)).select("url")


def search_any(postings: DataFrame, terms: Sequence[str]) -> DataFrame:
    """URLs that hold some of the terms."""
    wanted = [t.lower() for t in terms]
    return postings.filter(F.col("term").isin(wanted)).select("url").distinct()


def search_without(postings: DataFrame, term: str, without: str) -> DataFrame:
    """URLs that hold ``term`` and not ``without``."""
    flags = postings.filter(F.col("term").isin(term.lower(), without.lower())).groupBy("url").agg(
        F.max(F.col("term") == term.lower()).alias("_has"),
        F.max(F.col("term") == without.lower()).alias("_not"))
    return flags.filter("_has AND NOT _not").select("url")


def number_urls(postings: DataFrame) -> DataFrame:
    """(url, doc): the documents numbered from 0 in the order of their URLs, as a written table."""
    urls = postings.select("url").distinct()
    return materialize(row_numbers(urls, ["url"], "doc"), "numbers")


def term_bitmaps(postings: DataFrame, numbers: DataFrame) -> DataFrame:
    """(term, shard, words): which documents have a term, 64 to a word; a shard is 2^15 documents.

    ``words`` holds (word, bits) for words that are not zero, at most 512, in order; so a rare term
    takes a word for a document and a frequent one a bit.
    """
    placed = sized_join(postings.select("term", "url").filter("term IS NOT NULL"), numbers, ["url"],
                        spread="term")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("doc") % 64).cast("int"))
    words = placed.groupBy("term", F.expr("doc div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("term", F.expr("word div 512").alias("shard")).agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))


def _term_words(bitmaps: DataFrame, terms: Sequence[str]) -> DataFrame:
    return bitmaps.filter(F.col("term").isin(list(terms))).select(
        "term", F.explode("words").alias("w")).select("term", "w.*")


def bits_of_all(bitmaps: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(word, bits) of the documents that hold every term; terms are lower-cased like the index."""
    wanted = list(dict.fromkeys(t.lower() for t in terms))
    met = _term_words(bitmaps, wanted).groupBy("word").agg(
        F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("_n"))
    return met.filter((F.col("_n") == len(wanted)) & (F.col("bits") != 0)).drop("_n")


def bits_of_any(bitmaps: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(word, bits) of the documents that hold some of the terms."""
    return _term_words(bitmaps, [t.lower() for t in terms]).groupBy("word").agg(
        F.bit_or("bits").alias("bits"))


def bits_without(bitmaps: DataFrame, term: str, without: str) -> DataFrame:
    """(word, bits) of the documents that hold ``term`` and not ``without``."""
    has, lacks = term.lower(), without.lower()
    both = _term_words(bitmaps, [has, lacks]).groupBy("word").agg(
        F.bit_or(F.when(F.col("term") == has, F.col("bits"))).alias("_has"),
        F.bit_or(F.when(F.col("term") == lacks, F.col("bits"))).alias("_not"))
    left = F.col("_has").bitwiseAND(F.bitwise_not(F.coalesce("_not", F.lit(0).cast("long"))))
    return both.select("word", left.alias("bits")).filter("bits <> 0")


def urls_of(bits: DataFrame, numbers: DataFrame) -> DataFrame:
    """The URLs that the bits stand for: the only step with a row for each of them."""
    places = F.filter(F.sequence(F.lit(0), F.lit(63)),
                      lambda k: F.getbit("bits", k) == 1)
    docs = bits.select((F.col("word") * 64).alias("_first"), F.explode(places).alias("_k")).select(
        (F.col("_first") + F.col("_k")).alias("doc"))
    return sized_join(numbers, docs, ["doc"], spread="url", how="left_semi").select("url")


def save_postings(postings: DataFrame, path: str) -> None:
    """Range-partitioned by (term, url) and sorted, so a term filter prunes files and row groups."""
    postings.repartitionByRange("term", "url").sortWithinPartitions("term", "url").write.parquet(
        path)


def save_index(index: DataFrame, path: str) -> None:
    """Range-partitioned by (term, shard) and sorted; the counterpart for postings as arrays."""
    index.repartitionByRange("term", "shard").sortWithinPartitions("term", "shard").write.parquet(
        path)


def open_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("term STRING, url STRING, tf BIGINT").parquet(path)
