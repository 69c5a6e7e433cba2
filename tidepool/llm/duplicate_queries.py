"""op3 and op4: repeated passages and near duplicates, over all documents."""

from __future__ import annotations

from tidepool.llm.near_duplicates import NearSettings, near_duplicates
from tidepool.llm.repeats import RepeatSettings, repeat_digest
from tidepool.plans import Query, table


def op3_suffix_arrays(spark, sf):
    return repeat_digest(table(spark, sf, "documents"), RepeatSettings(length=100))


def op4_minhash(spark, sf):
    return near_duplicates(table(spark, sf, "documents"), NearSettings(shingle_words=2))


QUERIES = {"op3_suffix_arrays": Query(op3_suffix_arrays), "op4_minhash": Query(op4_minhash)}
