"""op5: all documents packed into sequences of 4096 tokens."""

from __future__ import annotations

from tidepool.llm.packing import pack_documents
from tidepool.plans import Query, table


def op5_packing(spark, sf):
    return pack_documents(table(spark, sf, "documents"))


QUERIES = {"op5_packing": Query(op5_packing)}
