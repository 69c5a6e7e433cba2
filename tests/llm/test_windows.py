"""op13: repeated word windows against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm.batches import word_runs
from tidepool.llm.cover_repeats import CoverSettings, window_digest, without_repeated_windows

DOCS = "doc_id long, text string, k string, spans int"


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1
                for j in range(window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)


def digest(spark, rows, s):
    return sorted((tuple(r) for r in window_digest(frame(spark, rows), s).collect()), key=repr)


def planted(seed, passage, docs=60):
    """Prose of few words with passages of about a window's length, copies, and copies with edits."""
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(n)]
    shared = [prose(passage + d) for d in (-1, 0, 1, 7, 30)]
    rows, long_doc = [], prose(4 * passage)
    for i in range(docs):
        words = prose(rng.randrange(0, 2 * passage))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(shared)
        if i % 6 == 0:  # near copies: one edit each
            words = list(long_doc)
            words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i, rng.choice([" ", "\n", "\t ", " \r\n"]).join(words)))
    return rows


@pytest.mark.parametrize("settings", [
    CoverSettings(window=35), CoverSettings(window=35, hot_kinds=2, task_kinds=7),
    CoverSettings(window=9, period=7, cover=(0, 1, 3)),
    CoverSettings(window=7, period=7, cover=(0, 1, 3), hot_kinds=3)])
def test_against_brute_force(spark, settings):
    rows = planted(settings.window, settings.window)
    found = digest(spark, rows, settings)
    assert found == brute(rows, settings.window)
    assert sum(r[2] for r in found) > 0 and sum(r[2] == 0 for r in found) > 0


def test_odd_rows(spark):
    s = CoverSettings(window=9, period=7, cover=(0, 1, 3))
    rep = " ".join(f"r{i}" for i in range(12))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 300), (5, rep), (5, rep), (6, "x" + rep),
            (None, rep + " end"), (None, None), (7, "one two"), (8, " ".join("abcdefghijkl")),
            (9, "long" * 100_000 + " " + rep), (5, "other text under an id that repeats")]
    assert digest(spark, rows, s) == brute(rows, 9)
    assert digest(spark, [], s) == []
    cut = without_repeated_windows(frame(spark, rows), s)
    assert cut.columns == ["doc_id", "text", "k", "spans"] and cut.count() == len(rows)
    by = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert (1, None) in by and (4, "") in by and (None, "end") in by and (7, "one two") in by
    assert all(r["k"] == "x" and r["spans"] == 1 for r in cut.collect())


def test_a_hot_passage_in_every_document(spark):
    s = CoverSettings(window=9, period=7, cover=(0, 1, 3), hot_kinds=5, task_kinds=20)
    hot = " ".join(f"h{i}" for i in range(11))
    rows = [(i, f"{i} b{i % 7} {hot} c{i % 5} d{i}") for i in range(400)]
    assert digest(spark, rows, s) == brute(rows, 9)


def test_very_long_texts_in_pieces():
    rng = np.random.default_rng(3)
    words = [b"w%d" % i for i in rng.integers(0, 999, 4000)]
    words[1000] = b"y" * 9000
    text = b"  " + b" ".join(words) + b"\n"
    column = pa.array([text, b"a b"])
    whole = [(first, h.tolist(), b.tolist()) for first, h, b in word_runs(column)]
    parts = [(first, h.tolist(), b.tolist()) for first, h, b in word_runs(column, piece=700)]
    assert len(whole) == 1 and len(parts) == 2
    assert whole[0][2] == [0, 4000, 4002]
    assert parts[0][1] + parts[1][1] == whole[0][1]


def test_a_cover_must_hold_every_shift():
    with pytest.raises(ValueError):
        CoverSettings(cover=(0, 1, 4, 14))
    with pytest.raises(ValueError):
        CoverSettings(window=20)
