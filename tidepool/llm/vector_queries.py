"""op9: the ten nearest neighbours of every hundredth vector among all vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.llm.permutation_index import nearest
from tidepool.plans import Query, table

EVERY = 100


def op9_permutation_index(spark, sf):
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % EVERY == 0, k=10)


QUERIES = {"op9_permutation_index": Query(op9_permutation_index)}
