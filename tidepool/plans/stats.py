"""Statistics and ordered computations over ``events``, ``orders`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions.dates import day_number, epoch_us
from tidepool.operators import ordered
from tidepool.operators import stats as ops
from tidepool.plans import Query, table

ORDER = ["us", "event_id"]


def _events(spark, sf):
    return table(spark, sf, "events")


def _rounded(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


def _cents(spark, sf):
    """Events with the clock in microseconds and the value in whole cents, so sums are exact."""
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", epoch_us("ts").alias("us"),
        F.round(F.col("value") * 100).cast("long").alias("cents"))


def stats_basic(spark, sf):
    return _rounded(ops.basic(_events(spark, sf), ["event_type"], "value"), "sum", "mean")


def stats_spread(spark, sf):
    return _rounded(ops.spread(_events(spark, sf), ["event_type"], "value"), "variance", "sd")


def stats_median(spark, sf):
    return _rounded(ops.median(_events(spark, sf), ["user_id"], "value"), "median")


def quantile_summary(spark, sf):
    return _rounded(ops.quantile_summary(_events(spark, sf), ["event_type"], "value"), *ops.SUMMARY)


def approx_quantiles(spark, sf):
    return ops.approx_quantile_summary(_events(spark, sf), ["event_type"], "value")


def stats_mode(spark, sf):
    return ops.mode(table(spark, sf, "lineitem"), ["l_suppkey"], "l_linenumber")


def _points(spark, sf):
    return _events(spark, sf).select(
        "event_type", F.get_json_object("props", "$.k").cast("double").alias("x"),
        F.col("value").alias("y"))


def best_fit(spark, sf):
    return _rounded(ops.best_fit(_points(spark, sf), ["event_type"], "x", "y"),
                    "slope", "intercept", "r", "r2")


def forecast(spark, sf):
    fits = ops.best_fit(_points(spark, sf), ["event_type"], "x", "y")
    return _rounded(ops.forecast(fits, [0, 50, 120]).select("event_type", "x", "y"), "y")


def group_rollup(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")
                                             ).join(region, F.col("n_regionkey") == F.col(
                                                 "r_regionkey"))
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    return ops.group_rollup(rows, ["r_name", "n_name", "c_mktsegment"], cents)


def _bars(spark, sf):
    return ops.ohlc_bars(_events(spark, sf).withColumn("day", day_number("ts")),
                         ["event_type", "day"], "value", ["ts", "event_id"])


def ohlc_bars(spark, sf):
    return _bars(spark, sf)


def series_bounds(spark, sf):
    return ops.series_bounds(_bars(spark, sf), ["event_type"], ymax=600)


def running_fold(spark, sf):
    parts = ordered.order_chunks(_cents(spark, sf), ["user_id"], ORDER)
    out = ordered.running(parts, ["user_id"], ORDER, {
        "run_sum": ("sum", F.col("cents")), "run_max": ("max", F.col("cents")),
        "run_min": ("min", F.col("cents")), "run_n": ("count", F.col("cents"))})
    out = ordered.running(out, ["user_id"], ORDER, {"rest": ("sum", F.col("cents"))}, reverse=True)
    return out.select("event_id", "user_id", "run_sum", "run_max", "run_min", "run_n", "rest")


def stacked_series(spark, sf):
    points = _cents(spark, sf).withColumn("day", F.floor(F.col("us") / 86_400_000_000))
    return ops.stacked_series(points, "day", "event_type", "cents", hidden=["error"])


def consecutive_groups(spark, sf):
    parts = ordered.order_chunks(_cents(spark, sf), ["user_id"], ORDER)
    marked = ordered.runs(parts, ["user_id"], ORDER, ["event_type"])
    return marked.groupBy("user_id", "run_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"),
        F.min("us").alias("first_us"), F.max("us").alias("last_us"))


def change_points(spark, sf):
    parts = ordered.order_chunks(_cents(spark, sf), ["user_id"], ORDER)
    level = F.struct("event_type", (F.col("cents") > 5000).alias("big"))
    seen = ordered.shift(parts, ["user_id"], ORDER, {"prev": level})
    now = F.struct(level.alias("v"))
    return seen.filter(~F.col("prev").eqNullSafe(now)).select("event_id", "user_id", "event_type")


_ORDERED = "PARTITION BY user_id ORDER BY ts, event_id"

QUERIES = {
    "stats_basic": Query(stats_basic, """
        SELECT event_type, count(value) AS n, round(sum(value), 6) AS sum,
          round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max
        FROM events GROUP BY event_type"""),
    "stats_spread": Query(stats_spread, """
        SELECT event_type, round(var_pop(value), 6) AS variance, round(stddev_pop(value), 6) AS sd
        FROM events GROUP BY event_type"""),
    "stats_median": Query(stats_median, """
        SELECT user_id, round(quantile_cont(value, 0.5), 6) AS median FROM events GROUP BY user_id"""),
    "quantile_summary": Query(quantile_summary, "SELECT event_type, " + ", ".join(
        f"round(quantile_cont(value, {p}), 6) AS \"{n}\"" for n, p in ops.SUMMARY.items())
        + " FROM events GROUP BY event_type"),
    "approx_quantiles": Query(approx_quantiles, "SELECT event_type, " + ", ".join(
        f"quantile_disc(value, {p}) AS \"{n}\"" for n, p in ops.SUMMARY.items())
        + " FROM events GROUP BY event_type"),
    "stats_mode": Query(stats_mode, """
        SELECT l_suppkey, l_linenumber AS mode, n FROM (SELECT l_suppkey, l_linenumber,
            count(*) AS n, row_number() OVER (PARTITION BY l_suppkey
              ORDER BY count(*) DESC, l_linenumber) AS k
          FROM lineitem GROUP BY l_suppkey, l_linenumber) WHERE k = 1"""),
    "best_fit": Query(best_fit, """
        WITH p AS (SELECT event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS x, value AS y
                   FROM events)
        SELECT event_type, round(regr_slope(y, x), 6) AS slope,
          round(regr_intercept(y, x), 6) AS intercept, round(corr(y, x), 6) AS r,
          round(regr_r2(y, x), 6) AS r2 FROM p GROUP BY event_type"""),
    "forecast": Query(forecast, """
        WITH p AS (SELECT event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS x, value AS y
                   FROM events),
        f AS (SELECT event_type, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM p
              GROUP BY event_type)
        SELECT event_type, CAST(v.x AS DOUBLE) AS x, round(s * v.x + i, 6) AS y
        FROM f, (VALUES (0), (50), (120)) v(x)"""),
    "group_rollup": Query(group_rollup, """
        SELECT r_name, n_name, c_mktsegment, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT))
            AS BIGINT) AS value,
          CAST(3 - bit_count(grouping_id(r_name, n_name, c_mktsegment)) AS INTEGER) AS level
        FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey
        GROUP BY ROLLUP (r_name, n_name, c_mktsegment)"""),
    "ohlc_bars": Query(ohlc_bars, """
        SELECT event_type, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day,
          first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
          last(value ORDER BY ts, event_id) AS close FROM events GROUP BY 1, 2"""),
    "series_bounds": Query(series_bounds, """
        SELECT event_type, min(value) AS vmin, CAST(600 AS DOUBLE) AS vmax,
          count(DISTINCT epoch_us(ts) // 86400000000) AS bars FROM events GROUP BY event_type"""),
    "running_fold": Query(running_fold, f"""
        WITH e AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
        SELECT event_id, user_id,
          CAST(sum(cents) OVER ({_ORDERED} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_sum,
          max(cents) OVER ({_ORDERED} ROWS UNBOUNDED PRECEDING) AS run_max,
          min(cents) OVER ({_ORDERED} ROWS UNBOUNDED PRECEDING) AS run_min,
          count(*) OVER ({_ORDERED} ROWS UNBOUNDED PRECEDING) AS run_n,
          CAST(sum(cents) OVER ({_ORDERED} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            AS BIGINT) AS rest FROM e"""),
    "stacked_series": Query(stacked_series, """
        WITH p AS (SELECT CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day, event_type,
            CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS y FROM events
          WHERE event_type <> 'error' GROUP BY 1, 2)
        SELECT day, event_type, y,
          CAST(sum(y) OVER (PARTITION BY day ORDER BY event_type) - y AS BIGINT) AS base,
          CAST(sum(y) OVER (PARTITION BY day ORDER BY event_type) AS BIGINT) AS top FROM p"""),
    "consecutive_groups": Query(consecutive_groups, f"""
        WITH e AS (SELECT *, CASE WHEN lag(event_type) OVER ({_ORDERED}) = event_type THEN 0
                     ELSE 1 END AS s FROM events),
        r AS (SELECT *, sum(s) OVER ({_ORDERED} ROWS UNBOUNDED PRECEDING) AS run FROM e)
        SELECT user_id, CAST(run AS BIGINT) AS run_id, event_type, count(*) AS n,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
          min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us
        FROM r GROUP BY user_id, run, event_type"""),
    "change_points": Query(change_points, f"""
        WITH e AS (SELECT event_id, user_id, event_type, ts, round(value * 100) > 5000 AS big
                   FROM events),
        l AS (SELECT *, lag(event_type) OVER ({_ORDERED}) AS pt, lag(big) OVER ({_ORDERED}) AS pb
              FROM e)
        SELECT event_id, user_id, event_type FROM l
        WHERE pt IS DISTINCT FROM event_type OR pb IS DISTINCT FROM big"""),
}
