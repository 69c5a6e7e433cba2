"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tidepool.functions.dates import epoch_us
from tidepool.functions.text import html_to_text
from tidepool.operators import index as ix
from tidepool.operators import ordered
from tidepool.operators.crawl import extract_links


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def no_nested_loop(df):
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, duck, name):
    sql = oracle_sql().get(name)
    result = compare(spark, duck, queries()[name], sql, sf, no_nested_loop)
    assert result is None or (sql is None and result.startswith("rows")), result


def test_entry(spark):
    top = entry(spark).collect()
    assert len(top) == 20 and top[0]["freq"] >= top[-1]["freq"]


def test_markup_is_not_carried_on(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    exchanges = [line for line in plan(ix.document_index(ix.page_text(pages))).splitlines()
                 if "Exchange" in line]
    assert exchanges and not any("html" in line for line in exchanges)
    assert "page_id" not in plan(extract_links(pages))


def test_only_needed_columns_are_read(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(lines.filter("l_quantity > 40").groupBy("l_suppkey").count())
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in text
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double>", text)


def test_text_stays_in_generated_code(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    text = plan(pages.select("page_id", html_to_text("html").alias("t")).filter("length(t) > 5"))
    assert "*(1)" in text and "Python" not in text


def test_windows_never_take_a_whole_large_key(spark, sf, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_KEY_ROWS", 10)
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("us", epoch_us("ts"))
    parts = ordered.order_chunks(events, ["user_id"], ["us", "event_id"])
    text = plan(ordered.shift(parts, ["user_id"], ["us", "event_id"], {"p": F.col("us")}))
    assert re.search(r"hashpartitioning\(_chunk#\d+, user_id#\d+L", text)
    assert not re.search(r"hashpartitioning\(user_id#\d+L, ", text)
