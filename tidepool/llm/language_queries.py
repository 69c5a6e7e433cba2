"""op10: the language of every document, learned from three of four folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.language import LanguageModel, fit_language_model, predict_language
from tidepool.plans import Query, table

FOLDS, HELD_FOLD = 4, 2


def fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def learned(docs: DataFrame) -> LanguageModel:
    """A model of all labelled rows outside the held fold; rows without an id are not learned from."""
    training = docs.select("doc_id", "text", "lang").filter(fold() != HELD_FOLD)
    return fit_language_model(training, F.xxhash64("doc_id"))


def op10_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = learned(docs)
    rows = docs.select("doc_id", F.coalesce(fold() == HELD_FOLD, F.lit(False)).alias("held_out"),
                       "text")
    return predict_language(rows, model, ["doc_id", "held_out"])


QUERIES = {"op10_language_id": Query(op10_language_id)}
