"""Mixing to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are summed up into cells of source, language and topic.  The cells' token weights are raked
to the three target marginals in turn until all agree, and documents are then sampled by the fitted
weights: a weight below 1 is a probability, one above it is so many copies and a probability for one
more, so no target is cut short.  Only sums per cell are ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.storage import materialize, sized_join

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSettings:
    """Target marginals are the present shares to the given powers; 1 keeps a marginal as it is."""

    source_power: float = 0.5
    lang_power: float = 0.7
    topic_power: float = 0.8
    share: float = 0.75       # of all tokens that the sample should hold
    rounds: int = 8
    cap_rounds: int = 6
    seed: int = 7
    digits: int = 6           # of the reported ratio and probability

    def power(self, dimension: str) -> float:
        return getattr(self, f"{dimension}_power")


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text is made of."""
    size = F.length(text)
    symbols = size - F.length(F.regexp_replace(text, "[#*$%&]+", ""))
    figures = size - F.length(F.regexp_replace(text, "[0-9]+", ""))
    return (F.when(size == 0, F.lit("empty")).when(symbols * 20 >= size, F.lit("symbols"))
            .when(text.contains(" | "), F.lit("lists")).when(text.contains("!!"), F.lit("shouting"))
            .when(figures * 50 >= size, F.lit("figures")).when(size < 1000, F.lit("short prose"))
            .otherwise(F.lit("long prose")))


def cell_columns() -> list[Column]:
    """Source, language and topic of a row of documents; a missing label is a label of its own."""
    labels = [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")]
    return [*labels, topic_of(F.coalesce(F.col("text"), F.lit(""))).alias("topic")]


def weighed(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, topic, tokens``: the words of a text are its tokens."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), F.lit(0))
    return docs.select("doc_id", *cell_columns(), F.size(words).cast("long").alias("tokens"))


def smoothed_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """``dimension, target``: shares proportional to a power of the present ones, summing to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).filter("t > 0")
    sums = sums.withColumn("p", F.pow(F.col("t").cast("double"), F.lit(float(power))))
    total = sums.agg(F.sum("p").alias("p")).first()["p"] or 1.0  # one number
    return sums.select(dimension, (F.col("p") / F.lit(total)).alias("target"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """``cells`` with ``ratio``: the factor by which each cell's token weight changes.

    One round scales the cells to each marginal in turn.  A value without tokens keeps its factor;
    so does one that the targets do not name.  Fitted weights sum up to the tokens that there are.
    Targets stand beside the cells, and every step is written: a plan has one sum and one join, where
    steps planned together would repeat those before them and hold their broadcasts on the driver.
    """
    total = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    fitted = cells.withColumn("ratio", F.lit(1.0))
    for dimension, target in targets.items():
        target = target.select(dimension, F.col("target").alias(f"target_{dimension}"))
        fitted = fitted.join(target, dimension, "left")
    fitted = materialize(fitted, "raked")
    for _ in range(rounds):
        for dimension in targets:
            now = fitted.groupBy(dimension).agg(
                F.sum(F.col("tokens") * F.col("ratio")).alias("now"))
            step = F.col(f"target_{dimension}") * F.lit(float(total)) / F.col("now")
            fitted = fitted.join(now, dimension, "left").withColumn("ratio", F.col("ratio") * F.coalesce(
                F.when(F.col("now") > 0, step), F.lit(1.0))).drop("now")
            fitted = materialize(fitted, "raked")
    return fitted.select(*cells.columns, "ratio")


def scale_for(fitted: DataFrame, share: float, rounds: int) -> float:
    """The factor that makes min(1, factor * ratio) keep ``share`` of the tokens, as far as it can."""
    tokens = F.col("tokens").cast("double")
    total = fitted.agg(F.sum(tokens).alias("t")).first()["t"] or 0.0
    scale = share
    for _ in range(rounds):
        full = F.col("ratio") * F.lit(scale) >= 1
        row = fitted.agg(
            F.sum(F.when(full, tokens).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(tokens * F.col("ratio"))).alias("open")).first()
        if not row["open"]:
            break
        scale = (share * total - row["full"]) / row["open"]
    return scale


def chance(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(NONE)))
                   .cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16 ** 13))


def fitted_cells(rows: DataFrame, s: MixSettings) -> DataFrame:
    """Every cell of the weighed ``rows`` with its ``tokens`` and fitted ``ratio``."""
    cells = materialize(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = {d: materialize(smoothed_targets(cells, d, s.power(d)), "target") for d in DIMENSIONS}
    return raked(cells, targets, s.rounds)


def residual(fitted: DataFrame, targets: dict[str, DataFrame]) -> float:
    """How far the fitted marginals are from the targets: the largest difference of a share."""
    total = fitted.agg(F.sum(F.col("tokens") * F.col("ratio")).alias("t")).first()["t"] or 1.0
    worst = 0.0
    for dimension, target in targets.items():
        now = fitted.groupBy(dimension).agg(
            (F.sum(F.col("tokens") * F.col("ratio")) / F.lit(total)).alias("now"))
        gap = now.join(target, dimension).agg(F.max(F.abs(F.col("now") - F.col("target")))).first()[0]
        worst = max(worst, gap or 0.0)
    return worst


def fitted_mix(rows: DataFrame, s: MixSettings) -> DataFrame:
    """The fitted ``ratio`` and ``weight``, share * ratio, of every cell of the weighed ``rows``.

    Rows of a cell without tokens change no marginal; their weight is 1 at most.
    """
    ratio = F.round("ratio", s.digits)
    weight = ratio * F.lit(float(s.share))
    return fitted_cells(rows, s).select(
        *DIMENSIONS, ratio.alias("ratio"),
        F.when(F.col("tokens") > 0, weight).otherwise(F.least(F.lit(1.0), weight)).alias("weight"))


def capped_mix(rows: DataFrame, s: MixSettings) -> DataFrame:
    """The ``probability`` of every cell where no row may be there twice: min(1, factor * ratio)."""
    fitted = fitted_cells(rows, s)
    scale = scale_for(fitted, s.share, s.cap_rounds)
    return fitted.select(*DIMENSIONS, F.round(
        F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)), s.digits).alias("probability"))


def copies(weight: Column, draw: Column) -> Column:
    """The whole part of the weight, and one more if the draw is below the fraction."""
    return F.floor(weight) + (draw < weight - F.floor(weight)).cast("long")


def mix_documents(docs: DataFrame, settings: MixSettings | None = None) -> DataFrame:
    """One row per row of ``docs``: its cell, ``ratio``, ``weight``, how many ``copies`` of it the mix
    holds and whether that is any (``kept``).

    Copies are expected to sum up to ``share`` of the tokens with the fitted marginals; nothing is
    capped.  A missing source or language is the label ``(none)``, a missing text has no tokens and
    the topic ``empty``.  Equal ids share one draw, so repeated rows are kept or left together.  No
    documents give no rows.  Other columns of ``docs`` are not looked at.
    """
    s = settings or MixSettings()
    rows = materialize(weighed(docs.select("doc_id", "source", "lang", "text")), "weighed")
    out = sized_join(rows, fitted_mix(rows, s), list(DIMENSIONS), spread="doc_id")
    number = copies(F.col("weight"), chance(F.col("doc_id"), s.seed))
    return out.select("doc_id", *DIMENSIONS, "tokens", "ratio", "weight", number.alias("copies")
                      ).withColumn("kept", F.col("copies") > 0)


def _placed(docs: DataFrame, fitted: DataFrame, value: str, s: MixSettings) -> DataFrame:
    """The columns of ``docs``, named by position, with ``draw`` and the ``value`` of each row's cell."""
    cell = [f"cell_{d}" for d in DIMENSIONS]
    placed = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)],
        *[c.alias(name) for c, name in zip(cell_columns(), cell)],
        chance(F.col("doc_id"), s.seed).alias("draw"))
    fitted = fitted.select(*[F.col(d).alias(name) for d, name in zip(DIMENSIONS, cell)],
                           F.col(value).alias("value"))
    return sized_join(placed, fitted, cell, spread="draw")


def _unplaced(placed: DataFrame, docs: DataFrame) -> DataFrame:
    return placed.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def sampled(docs: DataFrame, settings: MixSettings | None = None) -> DataFrame:
    """Rows of ``docs`` with all their columns, none of them twice.

    A cell whose tokens should become more stays behind its target; see :func:`repeated`.
    """
    s = settings or MixSettings()
    fitted = capped_mix(weighed(docs.select("doc_id", "source", "lang", "text")), s)
    return _unplaced(_placed(docs, fitted, "probability", s).filter("draw < value"), docs)


def repeated(docs: DataFrame, settings: MixSettings | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix_documents` says, with all columns."""
    s = settings or MixSettings()
    fitted = fitted_mix(weighed(docs.select("doc_id", "source", "lang", "text")), s)
    placed = _placed(docs, fitted, "weight", s)
    number = copies(F.col("value"), F.col("draw")).cast("int")
    return _unplaced(placed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), number))), docs)
