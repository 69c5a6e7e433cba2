"""Session settings for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "tidepool") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Arrays of URLs are collected for many terms at once; the default of 128 groups per task
        # switches to sorting far too early.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "100000")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Merge a batch's sessions before they are shuffled.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
