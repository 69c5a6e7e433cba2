"""op6 and op8: token files and the exact length histogram, over all documents."""

from __future__ import annotations

from tidepool.llm.lengths import length_histogram, suffix_sums
from tidepool.llm.token_files import token_file_digest, write_token_files
from tidepool.plans import Query, table
from tidepool.storage import materialize, scratch_path


def op6_token_files(spark, sf):
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf, "documents"), path)
    return token_file_digest(spark, path)


def op8_token_counts(spark, sf):
    histogram = materialize(length_histogram(table(spark, sf, "documents")), "lengths")
    return suffix_sums(histogram)


QUERIES = {"op6_token_files": Query(op6_token_files), "op8_token_counts": Query(op8_token_counts)}
