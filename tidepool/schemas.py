"""Explicit schemas; streams and text sources never infer one."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
FRONTIER = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("depth", T.IntegerType()),
])
CHANGES = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("payload", T.StringType()),
])
