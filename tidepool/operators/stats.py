"""Descriptive statistics, fits, rollups and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.ordered import CHUNK, order_chunks, running


def basic(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n, sum, mean (0 without rows), min and max."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.coalesce(F.sum(value), F.lit(0.0)).alias("sum"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), F.min(value).alias("min"),
        F.max(value).alias("max"))


def spread(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Population variance and standard deviation."""
    return df.groupBy(*keys).agg(F.var_pop(value).alias("variance"),
                                 F.stddev_pop(value).alias("sd"))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
              chunks: int | None = None) -> DataFrame:
    """Exact quantiles, linear between the neighbours of position p(n - 1).

    Equal values are counted before anything is sorted; ranks are running counts over balanced
    chunks, so neither a large group nor all its distinct values are held in one place.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"))
    parts = order_chunks(counts, keys, [value], chunks)
    ranked = running(parts, keys, [value], {"_upto": ("sum", F.col("_n"))})
    ranked = running(ranked, keys, [value], {"_after": ("sum", F.col("_n"))}, reverse=True,
                     exclusive=True)
    last = F.col("_upto") + F.col("_after") - 1
    first, behind = F.col("_upto") - F.col("_n"), F.col("_upto")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < behind), F.col(value)))

    wanted = []
    for name, p in probs.items():
        wanted += [at(F.floor(last * p)).alias(f"_lo_{name}"),
                   at(F.ceil(last * p)).alias(f"_hi_{name}")]
    found = ranked.groupBy(*keys).agg(F.max(last).alias("_last"), *wanted)

    def between(name: str, p: float) -> Column:
        part = F.col("_last") * p - F.floor(F.col("_last") * p)
        return (F.col(f"_lo_{name}") * (1 - part) + F.col(f"_hi_{name}") * part).alias(name)

    return found.select(*keys, *[between(name, p) for name, p in probs.items()])


SUMMARY = {"min": 0.0, "p10": 0.1, "p25": 0.25, "med": 0.5, "p75": 0.75, "p90": 0.9, "max": 1.0}


def quantile_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return quantiles(df, keys, value, SUMMARY)


def approx_quantile_summary(df: DataFrame, keys: Sequence[str], value: str,
                            accuracy: int = 10_000) -> DataFrame:
    """The same summary from a mergeable sketch; rank error at most 1/accuracy."""
    found = F.percentile_approx(value, list(SUMMARY.values()), accuracy)
    return df.groupBy(*keys).agg(found.alias("_q")).select(
        *keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(SUMMARY)])


def median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return quantiles(df, keys, value, {"median": 0.5})


def mode(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value, the smallest on ties, with its count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"))
    rank = F.struct(-F.col("n"), F.col(value))
    return counts.groupBy(*keys).agg(F.min_by(value, rank).alias("mode"), F.max("n").alias("n"))


def best_fit(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least squares line: slope, intercept, signed r and r2.

    A group whose x or y never varies has no r; it gets null r and r2, slope 0 when x is constant.
    """
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = both.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("_slope"), F.regr_intercept(y, x).alias("_at0"),
        F.avg(y).alias("_mean"), F.var_pop(x).alias("_vx"), F.var_pop(y).alias("_vy"),
        F.covar_pop(x, y).alias("_cov"))
    r = F.when((F.col("_vx") > 0) & (F.col("_vy") > 0),
               F.col("_cov") / F.sqrt(F.col("_vx") * F.col("_vy")))
    return fit.select(*keys, F.when(F.col("_vx") > 0, F.col("_slope")).otherwise(F.lit(0.0)).alias(
        "slope"), F.when(F.col("_vx") > 0, F.col("_at0")).otherwise(F.col("_mean")).alias(
            "intercept"), r.alias("r"), (r * r).alias("r2"))


def forecast(fits: DataFrame, xs: Sequence[float]) -> DataFrame:
    """The fitted y at each given x."""
    at = F.explode(F.array(*[F.lit(float(x)) for x in xs])).alias("x")
    return fits.select("*", at).withColumn("y", F.col("slope") * F.col("x") + F.col("intercept"))


def group_rollup(df: DataFrame, levels: Sequence[str], measure: Column) -> DataFrame:
    """Measure summed on every level of the hierarchy; ``level`` 0 is the grand total."""
    bits = F.grouping_id()
    depth = F.lit(len(levels)) - F.length(F.replace(F.bin(bits), F.lit("0"), F.lit("")))
    return df.rollup(*levels).agg(F.sum(measure).alias("value"), depth.cast("int").alias("level"))


def ohlc_bars(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First, highest, lowest and last value per group."""
    position = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.min_by(value, position).alias("open"), F.max(value).alias("high"),
        F.min(value).alias("low"), F.max_by(value, position).alias("close"))


def series_bounds(bars: DataFrame, keys: Sequence[str], ymin: float | None = None,
                  ymax: float | None = None) -> DataFrame:
    """Smallest and largest of open, high, low and close; a given bound replaces the found one."""
    four = ["open", "high", "low", "close"]
    low = F.min(F.least(*four)) if ymin is None else F.min(F.lit(float(ymin)))
    high = F.max(F.greatest(*four)) if ymax is None else F.max(F.lit(float(ymax)))
    return bars.groupBy(*keys).agg(low.alias("vmin"), high.alias("vmax"),
                                   F.count(F.lit(1)).alias("bars"))


def stacked_series(df: DataFrame, x: str, series: str, y: str,
                   hidden: Sequence[str] = ()) -> DataFrame:
    """Height of each series stacked on the ones before it at the same x: (x, series, y, base, top).

    Hidden series neither show nor add; a null y adds nothing.
    """
    shown = df.filter(~F.col(series).isin(list(hidden))) if hidden else df
    points = shown.groupBy(x, series).agg(F.sum(y).alias("y"))
    parts = order_chunks(points, [x], [series])
    value = F.coalesce("y", F.lit(0))
    stacked = running(parts, [x], [series], {"base": ("sum", value)}, exclusive=True)
    return stacked.withColumn("top", F.col("base") + value).drop(CHUNK)

