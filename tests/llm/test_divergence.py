"""op12: source divergence against a plain calculation, and the shared trees by themselves."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidepool.llm.divergence import (
    DivergenceSettings, _pieces, shared_trees, source_divergence, walk_together,
)

DOCS = "doc_id long, text string, lang string, source string, item string, value long"


def brute(rows, s):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang or "", source or "") for _, lang, source in rows})
    for text, lang, source in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall("(?:[a-z]|[^\x00-\x7f])+", low)
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= s.min_documents]
        p = {}
        for g in [*(g for g in groups if g[0] == lang), lang]:
            own = sum((counts[x] for x in groups if x[0] == lang), Counter()) if g == lang else counts[g]
            below = sum(own[t] for t in kept) + s.smoothing * len(kept)
            p[g] = {t: 1 + 10 ** 9 * (own[t] + s.smoothing) // below for t in kept}
        for g in (g for g in groups if g[0] == lang):
            pairs = [(-sum(abs(p[g][t] - p[h][t]) for t in kept), h[1].encode(), h[1])
                     for h in groups if h[0] == lang and h != g]
            terms = [(p[lang][t] - p[g][t], t.encode(), t) for t in kept
                     if counts[g][t] and p[g][t] > p[lang][t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:s.top_terms])):
                out += [(*g, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)]
    return sorted(out)


def found(spark, rows, s):
    table = spark.createDataFrame([(1, t, lang, src, "x", 7) for t, lang, src in rows], DOCS)
    got = source_divergence(table, s)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, docs=120):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "ümlaut", "DELTA", "eins", "zwei", "日本", "x", "yy", "zZz"]
    words += [f"{a}{b}" for a in "abcdef" for b in "ghijklm"]
    rows = []
    for _ in range(docs):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["s0", "s0", "s1", "s2", "ö", None])
        rows.append((rng.choice([" ", "-", "1"]).join(rng.choices(words, k=rng.randrange(30))),
                     lang, source))
    return rows


@pytest.mark.parametrize("settings", [
    DivergenceSettings(min_documents=3), DivergenceSettings(min_documents=2, chunk=8, sources=2, pairs=3),
    DivergenceSettings(min_documents=2, chunk=2, sources=3), DivergenceSettings(min_documents=10 ** 6), DivergenceSettings(min_documents=1, top_terms=3, chunk=1)])
def test_against_a_plain_calculation(spark, settings):
    rows = corpus(settings.chunk)
    assert found(spark, rows, settings) == brute(rows, settings)


def test_odd_rows(spark):
    s = DivergenceSettings(min_documents=2)
    rows = [(None, None, None), ("", "en", "a"), ("12 %", "en", "b"), ("word " * 50_000, "en", "a"),
            ("word Word wORD", "en", "c"), ("word other", "en", "c"), ("other", "en", "c"),
            ("other", "en", "c"), ("ÄÖ äö", "de", "a"), ("ÄÖ", "de", "a"), ("alone", "fr", "a")]
    assert found(spark, rows, s) == brute(rows, s)
    assert found(spark, [], s) == []


def test_shares_are_exact_beyond_longs(spark):
    from pyspark.sql import functions as F

    from tidepool.llm.divergence import _shares, share
    s, n = DivergenceSettings(), 10 ** 15 + 7
    row = spark.range(1).select(share(F.lit(n), F.lit(3 * n), F.lit(11), s).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (n + 5) // (3 * n + 55) == _shares(np.array([n]), 3 * n, 11, s)[0]


def test_equal_subtrees_are_one_node():
    counts = np.array([[0, 0, 0, 0, 3, 1, 0, 0], [0, 0, 0, 0, 3, 1, 0, 2], [0] * 8])
    leaves, levels, roots = shared_trees(counts)
    assert leaves.tolist() == [0, 1, 2, 3] and [len(x) for x in levels] == [3, 3, 3]
    assert len(set(roots.tolist())) == 3
    pair, x, y, times = walk_together(levels, roots[[0, 0]], roots[[1, 0]])
    met = {(p, int(leaves[a]), int(leaves[b])): t for p, a, b, t in zip(pair, x, y, times)}
    assert met == {(0, 0, 0): 5, (0, 3, 3): 1, (0, 1, 1): 1, (0, 0, 2): 1,
                   (1, 0, 0): 6, (1, 3, 3): 1, (1, 1, 1): 1}


def test_pieces_do_not_cut_terms(monkeypatch):
    import tidepool.llm.divergence as d
    monkeypatch.setattr(d, "_PIECE", 5)
    text = b"ab cdefghijkl m nopq 1 rs"
    assert b"".join(_pieces(text)) == text
    assert [t for p in _pieces(text) for t in d.TERM.findall(p)] == d.TERM.findall(text)
