"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training rows.  The weights are learned from a bounded,
documented sample of them with the follow-the-regularised-leader rule and elastic-net penalties, the
scores are calibrated by a temperature on a part of that sample, and every whole text is predicted
on the executors.  Language, source and id never enter a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.batches import lean, release_memory, whole_texts
from tidepool.storage import materialize, sized_join

UNDETERMINED = "und"
PIECE = 4 << 20
_MOST = (1 << 31) - 1


@dataclass(frozen=True)
class LanguageSettings:
    """``per_language`` and ``max_sample`` bound the rows that the weights are learned from."""

    features: int = 4096
    longest: int = 3              # characters of the longest n-gram
    per_language: int = 800
    max_sample: int = 8000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    calibration_part: int = 5     # one sampled row in so many calibrates the temperature


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray           # (languages, features), mostly zeros
    bias: np.ndarray
    temperature: float
    settings: LanguageSettings = field(default_factory=LanguageSettings)


SparseRows = list[tuple[np.ndarray, np.ndarray]]
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _LETTER


def ngram_counts(texts: list[bytes], settings: LanguageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts (texts, features) and how many letters each text has.

    Texts are lower-cased; whatever is not a letter counts as a blank, runs of blanks as one.  A text
    longer than ``PIECE`` bytes is counted in pieces, cut at blanks if it has any.
    """
    long = [i for i, t in enumerate(texts) if len(t) > PIECE]
    if not long:
        return _counted([t.decode("utf-8", "replace") for t in texts], settings)[:2]
    counts, letters = ngram_counts([t if len(t) <= PIECE else b"" for t in texts], settings)
    for i in long:
        before = ""  # the end of the piece before, as far as n-grams reach into the next one
        for piece in _pieces(texts[i]):
            both, n, ends = _counted([before + piece.decode("utf-8", "replace"), before], settings)
            counts[i] += both[0] - both[1]
            letters[i] += n[0] - n[1]
            before = ends[0]
    return counts, letters


def _pieces(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):
            blank = raw.rfind(b" ", at, end)
            end = blank + 1 if blank >= 0 else end
            while blank < 0 and end < len(raw) and raw[end] & 0xC0 == 0x80:
                end += 1  # whole characters
        yield raw[at:end]
        at = end


def _counted(texts: list[str], settings: LanguageSettings
             ) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Counts and letters of each text, and its last characters as they were counted."""
    size = settings.features
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
    lengths = np.array([len(c) for c in codes], np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    code = np.concatenate([*codes, np.zeros(0, np.uint32)])
    letter = _letters()[np.minimum(code, 0x10FFFF)]
    letters = np.bincount(row[letter], minlength=len(texts))
    code = np.where(letter, code, 32).astype(np.uint64)
    blank_run = np.zeros(len(code), bool)
    blank_run[1:] = ~letter[1:] & ~letter[:-1] & (row[1:] == row[:-1])
    code, row = code[~blank_run], row[~blank_run]
    last = np.searchsorted(row, np.arange(len(texts)), "right")
    first = np.searchsorted(row, np.arange(len(texts)))
    ends = ["".join(map(chr, code[max(a, b - settings.longest + 1):b].tolist()))
            for a, b in zip(first.tolist(), last.tolist())]
    counts = np.zeros(len(texts) * size, np.int64)
    key = np.zeros(len(code), np.uint64)
    for n in range(1, settings.longest + 1):
        if len(code) < n:
            break
        end = len(code) - n + 1
        key = key[:end] * np.uint64(0x100000001B3) + code[n - 1:] + np.uint64(n)
        inside = row[:end] == row[n - 1:]
        cell = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(size)
        cell = cell.astype(np.int64) + row[:end] * size
        counts += np.bincount(cell[inside], minlength=len(counts))
    return counts.reshape(len(texts), size), letters, ends


def _text_groups(column: pa.Array, max_bytes: int = 1 << 19, max_rows: int = 128):
    held, size = [], 0
    for value in column:
        held.append(value.as_py() or b"")
        size += len(held[-1])
        if size >= max_bytes or len(held) >= max_rows:
            yield held
            held, size = [], 0
    if held:
        yield held


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts, dtype=np.float32) * idf.astype(np.float32)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def sparse_tf_idf(cells, counts, idf: np.ndarray) -> SparseRows:
    """(features, values) of each row, from its features and their counts."""
    out = []
    for columns, n in zip(cells, counts):
        columns = np.asarray(columns, np.int32)
        x = np.log1p(np.asarray(n), dtype=np.float32) * idf[columns].astype(np.float32)
        out.append((columns, x / np.sqrt((x * x).sum()) if len(x) else x))
    return out


def document_frequencies(texts: DataFrame, settings: LanguageSettings) -> tuple[int, np.ndarray]:
    """Rows, and rows per feature, over all of ``texts``; each task adds up what it has seen."""
    size = settings.features

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, found = 0, np.zeros(size, np.int64)
        for batch in batches:
            for group in _text_groups(batch.column(0)):
                counts, _ = ngram_counts(group, settings)
                found += (counts > 0).sum(0)
                rows += len(group)
        cells = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(np.append(found[found > 0], rows))], ["feature", "n"])

    counted = texts.mapInArrow(lean(count), "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n"))
    out, rows = np.zeros(size, np.int64), 0
    for feature, n in counted.collect():  # at most one row per feature
        if feature < 0:
            rows = n
        else:
            out[feature] = n
    return rows, out


def follow_the_leader(x: np.ndarray | SparseRows, y: np.ndarray, languages: int,
                      settings: LanguageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of multinomial logistic regression, one row at a time.

    ``x`` is a matrix, or (features, values) of each row for all ``settings.features``.

    Each weight is the minimiser of the linearised losses so far plus the two penalties; weights
    whose accumulated gradient stays within ``l1`` are exactly zero.
    """
    s = settings
    width = s.features + 1  # the last column is the bias, which is not penalised
    if isinstance(x, np.ndarray):
        width = x.shape[1] + 1
        x = [(np.flatnonzero(row), row[row != 0]) for row in x]
    z, n = np.zeros((languages, width)), np.zeros((languages, width))
    l1 = np.append(np.full(width - 1, s.l1), 0.0)

    def solve(columns):
        zc, nc = z[:, columns], n[:, columns]
        shrunk = np.sign(zc) * np.maximum(np.abs(zc) - l1[columns], 0)
        return -shrunk / ((s.beta + np.sqrt(nc)) / s.alpha + s.l2)

    for epoch in range(s.epochs):
        for i in np.random.default_rng(epoch).permutation(len(x)):
            columns, value = np.append(x[i][0], width - 1), np.append(x[i][1], 1.0)
            w = solve(columns)
            p = _softmax(w @ value)
            p[y[i]] -= 1
            g = np.outer(p, value)
            root = np.sqrt(n[:, columns] + g * g)
            z[:, columns] += g - (root - np.sqrt(n[:, columns])) / s.alpha * w
            n[:, columns] += g * g
    w = solve(np.arange(width))
    return w[:, :-1].astype(np.float32), w[:, -1].astype(np.float32)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        p = _softmax(scores / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def _sample(training: DataFrame, settings: LanguageSettings) -> DataFrame:
    """For each language the rows that come first by ``_order``, a hash; found without their texts.

    A language's rows are thinned by a threshold on the hash that leaves about twice as many as are
    wanted, so a window over a language sees a bounded number of rows however many it has.
    """
    narrow = training.select("lang", "_order")
    counted = materialize(narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows")), "languages")
    each = max(2, min(settings.per_language, settings.max_sample // max(1, counted.count())))
    place = F.pmod(F.xxhash64("_order", F.lit("sample")), F.lit(1 << 52)) / float(1 << 52)
    thinned = sized_join(narrow, counted, ["lang"], spread="_order").filter(
        place * F.col("_rows") <= 2 * each + 16)
    first = Window.partitionBy("lang").orderBy("_order")
    chosen = thinned.select("lang", "_order").distinct().withColumn(
        "_n", F.row_number().over(first)).filter(F.col("_n") <= each).drop("_n")
    chosen = sized_join(training, chosen, ["lang", "_order"], spread="_order", how="left_semi")
    return chosen.dropDuplicates(["lang", "_order"])


def fit_language_model(training: DataFrame, order, settings: LanguageSettings | None = None
                       ) -> LanguageModel:
    """Learn from ``lang`` and ``text``; rows that lack either are left out.

    ``order`` is a column of hashes that decides which rows are sampled (rows that agree in language
    and hash count once there).  Without any usable row the model knows no language.
    """
    settings = settings or LanguageSettings()
    usable = whole_texts(training).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows, found = document_frequencies(usable.select(F.col("text").cast("binary")), settings)
    idf = np.log((1 + rows) / (1 + found)) + 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group in _text_groups(batch.column(2)):
                counts, letters = ngram_counts(group, settings)
                part = batch.slice(done, len(group))
                cells = [np.flatnonzero(c) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(letters),
                     pa.array([c.astype(np.int32) for c in cells], pa.list_(pa.int32())),
                     pa.array([np.minimum(counts[i, c], _MOST).astype(np.int32)
                               for i, c in enumerate(cells)], pa.list_(pa.int32()))],
                    ["lang", "_order", "letters", "cells", "counts"])
                done += len(group)

    sample = _sample(usable.select("lang", "text", order.alias("_order")), settings)
    sample = sample.select("lang", "_order", F.col("text").cast("binary").alias("text")).mapInArrow(
        lean(features), "lang string, _order long, letters long, cells array<int>, counts array<int>")
    got = sample.filter("letters > 0").toArrow()  # at most max_sample sparse rows
    got = got.sort_by([("_order", "ascending"), ("lang", "ascending")]).combine_chunks()
    lang = np.array(got["lang"].to_pylist(), object)
    languages = sorted(set(lang))
    if not languages:
        empty = np.zeros((0, settings.features), np.float32)
        return LanguageModel([], idf, empty, np.zeros(0, np.float32), 1.0, settings)
    x = sparse_tf_idf(got["cells"].to_numpy(), got["counts"].to_numpy(), idf)
    y = np.array([languages.index(one) for one in lang])
    held = np.arange(len(x)) % settings.calibration_part == 0
    if len(np.unique(y[~held])) < len(languages):
        held[:] = False
    some = lambda mask: [x[i] for i in np.flatnonzero(mask)]
    weights, bias = follow_the_leader(some(~held), y[~held], len(languages), settings)
    scores = [weights[:, columns] @ value + bias for columns, value in some(held)]
    temperature = fit_temperature(np.array(scores), y[held])
    del got, x, scores
    release_memory()  # the driver's Python goes on through all that follows
    return LanguageModel(languages, idf, weights, bias, temperature, settings)


def _predicted(texts: list[bytes], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Number of the likeliest language of each text (their count for none) and its probability."""
    counts, letters = ngram_counts(texts, model.settings)
    best, top = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
    if model.languages:
        logits = tf_idf(counts, model.idf) @ model.weights.T + model.bias
        p = _softmax(logits.astype(np.float64) / model.temperature)
        known = letters > 0
        best[known], top[known] = p.argmax(1)[known], p.max(1)[known]
    return best, top


def predict_language(docs: DataFrame, model: LanguageModel, keys: list[str]) -> DataFrame:
    """``keys``, ``lang_pred`` and ``score`` (the calibrated probability) of every row.

    A text that is null or has no letter is ``und`` with score 0, and so is any text if the model
    knows no language.
    """
    rows = whole_texts(docs).select(*keys, F.col("text").cast("binary").alias("_text"))
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys),
                        "lang_pred string, score double"])
    names = np.array([*model.languages, UNDETERMINED], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_predicted(group, model) for group in _text_groups(batch.column(len(keys)))]
            if found:
                best, top = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(keys))),
                     pa.array(names[best], pa.string()), pa.array(top)],
                    [*keys, "lang_pred", "score"])

    return rows.mapInArrow(lean(predict), schema)


def accepts(model: LanguageModel, min_score: float):
    """A function of a binary column: whether the text's language is told with that probability."""
    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        found = [_predicted(g, model) for g in _text_groups(pa.array(texts, pa.binary()))]
        if not found:
            return pd.Series([], dtype=bool)
        best, top = (np.concatenate(x) for x in zip(*found))
        return pd.Series((best < len(model.languages)) & (top >= min_score))

    return accepted


def accepted_rows(docs: DataFrame, model: LanguageModel, min_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is told with that probability, all columns as they are."""
    names = docs.columns
    held = whole_texts(docs).toDF(*[f"_c{i}" for i in range(len(names))])
    text = names.index("text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group in _text_groups(batch.column(text).cast(pa.binary())):
                best, top = _predicted(group, model)
                good = (best < len(model.languages)) & (top >= min_score)
                yield batch.slice(done, len(group)).filter(pa.array(good))
                done += len(group)

    return held.mapInArrow(lean(choose), held.schema).toDF(*names)
