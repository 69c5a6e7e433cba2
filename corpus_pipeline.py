"""The corpus pipeline: documents to packed sequences, each stage by one operator of the library.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but the last
return the columns of ``documents``, extra ones included; the last returns pieces of sequences.  Nulls,
empty texts, repeated rows and empty tables are defined by the operators' docstrings; beyond them:

* language: a row leaves if its language is undetermined or less than ``MIN_SCORE`` sure.
* near_duplicates: rows are told apart by id and text (a 64-bit hash of both, nulls included), and of
  rows that agree in both one stays.  Of a group one row stays, that of the smallest id; ids that are
  missing come last, and texts that share an id in the order of the hash.
* repeats: a null text stays null; ``n_chars`` follows a text that got shorter.
* mixing: rows that share an id stay or leave together, unless their labels or texts differ; a row
  whose cell should weigh more than it does comes several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.language import accepted_rows
from tidepool.llm.language_queries import learned
from tidepool.llm.mixing import repeated
from tidepool.llm.near_duplicates import NearSettings, near_duplicates
from tidepool.llm.packing import PackSettings, pack_documents
from tidepool.llm.repeats import RepeatSettings, without_repeats
from tidepool.plans import Query, table
from tidepool.storage import materialize, sized_join

MIN_SCORE = 0.5
CACHE_WORDS = 100_000  # a worker of the last stage stands beside a JVM that four stages have filled

#: SQL cannot express a learned language model, so the stages are tested against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some certainty (operator 10)."""
    return accepted_rows(docs, learned(docs), MIN_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 (operator 4)."""
    names = docs.columns
    held = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    key, text = (F.col(f"_c{names.index(c)}") for c in ("doc_id", "text"))
    held = held.withColumn("_r", F.xxhash64(
        key.isNull(), F.coalesce(key.cast("string"), F.lit("")),
        text.isNull(), F.coalesce(text, F.lit(""))))
    verdict = near_duplicates(held.select(F.col("_r").alias("doc_id"), text.alias("text")),
                              NearSettings(shingle_words=5))
    others = materialize(verdict.filter(~F.col("kept")).select(
        F.col("doc_id").alias("_r"), F.col("component_id").alias("_g")).distinct(), "others")
    members = others.union(others.select(F.col("_g"), F.col("_g")).distinct())
    twice = held.groupBy("_r").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    twice = materialize(twice, "twice")
    left = held
    if not twice.isEmpty():
        again = sized_join(held, twice, ["_r"], spread="_r", how="left_semi")
        once = sized_join(held, twice, ["_r"], spread="_r", how="left_anti")
        left = once.unionByName(again.dropDuplicates(["_r"]))
    if not others.isEmpty():
        named = sized_join(held.select("_r", key.alias("_k")), members, ["_r"], spread="_r")
        named = materialize(named.distinct(), "members")
        first = F.min(F.struct(F.col("_k").isNull().alias("none"), "_k", "_r")).alias("first")
        stays = named.groupBy("_g").agg(first).select(F.col("first._r").alias("_r"))
        gone = named.select("_r").join(stays, "_r", "left_anti")
        left = sized_join(left, gone, ["_r"], spread="_r", how="left_anti")
    return left.drop("_r").toDF(*names)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte passages that start earlier in the corpus (operator 3)."""
    cut = without_repeats(docs, RepeatSettings(length=100))
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    shorter = F.least(F.col("n_chars"), F.length("text").cast(kind))
    return cut.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), shorter))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mix with raked source, language and topic weights (operator 7)."""
    return repeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of 4096 tokens (operator 5)."""
    return pack_documents(docs, settings=PackSettings(cache_words=CACHE_WORDS))


STAGES = [("language", language), ("near_duplicates", near_copies), ("repeats", repeats),
          ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


def all_queries() -> dict[str, Query]:
    return {"pipeline": Query(run, ORACLE_SQL)}
