"""Language identification, the permutation index and mixing: held-out accuracy, recall, margins."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm.language import (
    LanguageSettings, accepts, fit_language_model, fit_temperature, follow_the_leader,
    ngram_counts, predict_language,
)
from tidepool.llm.language_queries import op10_language_id
from tidepool.llm.mixing import (
    DIMENSIONS, MixSettings, mix_documents, raked, repeated, residual, sampled, scale_for, smoothed_targets,
    topic_of, weighed,
)
from tidepool.llm.permutation_index import IndexSettings, nearest, spread_out
from tidepool.llm.vector_queries import op9_permutation_index

DOCS = "doc_id long, text string, lang string, source string, topic string, kept int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op10_language_id(spark, sf).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"]]
    assert 0.2 < len(held) / len(got) < 0.3
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def docs_table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "t", 1) for i, t, lang in rows], DOCS)


def test_language_of_odd_rows(spark):
    rows = [(i, "the cat and the dog " * (i % 5 + 1), "en") for i in range(30)]
    rows += [(100 + i, "der hund und die katze " * (i % 5 + 1), "de") for i in range(30)]
    odd = [(200, None, "en"), (201, "", "de"), (202, "12 34 !!", "en"), (203, "die katze " * 20_000, None),
           (None, "the dog", "en"), (0, "the cat and the dog ", "en")]
    docs = docs_table(spark, rows + odd)
    model = fit_language_model(docs, F.xxhash64("doc_id"))
    assert model.languages == ["de", "en"] and (model.weights == 0).mean() > 0.5
    got = predict_language(docs, model, ["doc_id"]).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == lang for i, _, lang in rows)
    for i in (200, 201, 202):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0
    assert by[203]["lang_pred"] == "de" and by[None]["lang_pred"] == "en"
    kept = docs.filter(accepts(model, 0.5)(F.col("text").cast("binary")))
    assert kept.count() == len(rows) + 3 and kept.columns == docs.columns
    empty = docs_table(spark, [])
    none = fit_language_model(empty, F.xxhash64("doc_id"))
    assert none.languages == [] and predict_language(empty, none, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in predict_language(docs, none, ["doc_id"]).collect()} == {"und"}


def test_ngram_counts_by_hand():
    s = LanguageSettings(features=1 << 16)
    counts, letters = ngram_counts([b"Ab", b"", b"a1!b", "É".encode(), b"ab"], s)
    assert letters.tolist() == [2, 0, 2, 1, 2]
    assert (counts[0] == counts[4]).all() and counts[0].sum() == 3  # a, b, ab
    assert counts[2].sum() == 6 and counts[3].sum() == 1 and counts[1].sum() == 0


def test_long_texts_are_counted_in_pieces(monkeypatch):
    import tidepool.llm.language as language
    s = LanguageSettings(features=512)
    texts = ["Ein  Haus, das — dort steht. ".encode() * 30, "漢字かな交じり文".encode() * 40, b"", b"ab",
             b"12 34 " * 50, b"a" * 300 + b"  " + b"b" * 7]
    whole = ngram_counts(texts, s)
    monkeypatch.setattr(language, "PIECE", 37)
    parts = ngram_counts(texts, s)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_accepted_rows_keep_all_columns(spark):
    import tidepool.llm.language as language
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(30)]
    rows += [(100 + i, "der hund und die katze " * 3, "de") for i in range(30)] + [(7, None, "en"), (8, "", "x")]
    docs = docs_table(spark, rows)
    model = fit_language_model(docs, F.xxhash64("doc_id"))
    got = language.accepted_rows(docs, model, 0.5)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r[0] for r in rows[:60])


def test_penalties_make_weights_sparse():
    rng = np.random.default_rng(0)
    x = (rng.random((300, 40)) < 0.2).astype(np.float32)
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    weak, strong = (follow_the_leader(x, y, 2, LanguageSettings(l1=l1))[0] for l1 in (0.0, 3.0))
    assert (strong == 0).mean() > (weak == 0).mean() and (strong == 0).sum() > 0
    assert strong[1, 0] > 0 and strong[1, 1] > 0


def test_temperature_minimises_the_loss():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(4000, 3)) * 2
    y = np.array([rng.choice(3, p=np.exp(s / 2.5) / np.exp(s / 2.5).sum()) for s in scores])
    assert abs(fit_temperature(scores, y) - 2.5) < 0.3


def brute_nearest(rows, k, every):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if any(v) and (i not in vectors or v < vectors[i]):
            vectors[i] = v
    out = {}
    for q, v in vectors.items():
        if q % every == 0:
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), i)
                          for i, w in vectors.items() if i != q)
            out[q] = near[:k]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], list(map(float, r["embedding"]))) for r in
            spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    got = found(op9_permutation_index(spark, sf))
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        assert [i for _, i in got[q]] == [i for _, i in sorted(got[q])]
        hits += len(set(best) & {i for _, i in got[q]})
        total += 10
    assert hits / total >= 0.9, hits / total


def test_recall_beside_a_hot_third_of_near_copies(spark):
    rng = np.random.default_rng(29)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hot = np.arange(len(x)) % 3 == 1
    x[hot] = x[1] + rng.normal(size=(hot.sum(), 64)) * 0.02
    vectors = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    queries = [*range(0, len(x), 600), *range(1, len(x), 6000)]  # outside of the group and in it
    got = found(nearest(vectors, F.col("vec_id").isin(queries), 10))
    hits = {True: [], False: []}
    for q in queries:
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits[bool(hot[q])].append(len(set(np.argsort(d)[:10].tolist()) & {i for _, i in got[q]}))
    assert min(np.mean(hits[False]), np.mean(hits[True])) >= 9, hits


def test_pivots_are_spread_out():
    rng = np.random.default_rng(31)
    x = rng.normal(size=(300, 8))
    x[::3] = x[0] + rng.normal(size=(100, 8)) * 1e-3
    got = spread_out(x, 60)
    assert got.shape == (60, 8) and len(np.unique(got, axis=0)) == 60
    assert (((got - x[0]) ** 2).sum(1) < 0.01).sum() == 1
    assert len(spread_out(x[::3], 60)) == 60 and len(spread_out(x[:2], 1)) == 1


def test_copies_of_one_vector_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(3)
    hot = [1.0, 0.5, 0.25, 0.0]
    rows = [(i, hot) for i in range(0, 3000, 2)]
    rows += [(i, (np.array(hot) + rng.normal(size=4) * 0.1).tolist()) for i in range(1, 1000, 2)]
    rows += [(5000, [1.0, 0.5, 0.2501, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(nearest(vectors, F.col("vec_id") % 500 == 0, 10))
    want = brute_nearest(rows, 10, 500)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for _, i in near] == [i for _, i in got[q]]
        assert np.allclose([s for s, _ in near], [s for s, _ in got[q]], atol=1e-12)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]),
            (9, [2.0, 0.0]), (200, None), (10, [])]
    schema = "vec_id long, embedding array<double>, rank int, node string"
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    got = found(nearest(vectors, F.col("vec_id") % 100 == 0, 10))
    assert got == brute_nearest([r for r in rows if r[1] != []], 10, 100)
    assert nearest(spark.createDataFrame([], schema), F.col("vec_id") >= 0, 10).count() == 0


def test_small_blocks_find_the_same(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    query = F.col("vec_id") % 20 == 0
    assert found(nearest(vectors, query, 5, IndexSettings(block=40, queries=3))) == found(
        nearest(vectors, query, 5))


def test_raking_reaches_the_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(f"s{a}", f"l{b}", f"t{c}", int(rng.integers(1, 1000)))
            for a in range(5) for b in range(3) for c in range(4)] + [("s0", "l0", "t9", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {d: smoothed_targets(cells, d, p) for d, p in zip(DIMENSIONS, (0.3, 0.0, 0.7))}
    fitted = raked(cells, targets, 25).cache()
    total = sum(r[3] for r in rows)
    for d, target in targets.items():
        want = {r[d]: r["target"] for r in target.collect()}
        got = fitted.groupBy(d).agg(F.sum(F.col("tokens") * F.col("ratio")).alias("w")).collect()
        for r in got:
            if r[d] in want:
                assert abs(r["w"] / total - want[r[d]]) < 1e-6
    assert residual(fitted, targets) < 1e-6 < residual(cells.withColumn("ratio", F.lit(1.0)), targets)
    scale = scale_for(fitted, 0.9, 30)
    kept = sum(r["tokens"] * min(1.0, scale * r["ratio"]) for r in fitted.collect())
    assert abs(kept - 0.9 * total) < 1e-3 * total


def test_raking_takes_one_sum_and_one_join_at_a_time(spark, monkeypatch):
    from tidepool.llm import mixing

    plans, write = [], mixing.materialize

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(mixing, "materialize", noted)
    rows = [("a", "x", "t", 10), ("a", "y", "t", 30), ("b", "x", "u", 5), ("b", "y", "u", 0), ("c", "x", "t", 7),
            (None, "y", "u", 3), ("d", "z", "v", 0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    want = {"source": {"a": 0.5, "b": 0.2, "d": 0.1}, "lang": {"x": 0.3, "y": 0.7}, "topic": {"t": 0.6, "u": 0.4}}
    targets = {d: spark.createDataFrame(list(t.items()), f"{d} string, target double") for d, t in want.items()}
    got = raked(cells, targets, 3)
    assert got.columns == [*DIMENSIONS, "tokens", "ratio"]
    got = {tuple(r)[:3]: r["ratio"] for r in got.collect()}
    ratio = dict.fromkeys([r[:3] for r in rows], 1.0)
    for _ in range(3):
        for k, d in enumerate(DIMENSIONS):
            now = {v: sum(r[3] * ratio[r[:3]] for r in rows if r[k] == v) for v in {r[k] for r in rows}}
            for cell in ratio:
                if now[cell[k]] > 0 and cell[k] in want[d]:
                    ratio[cell] *= want[d][cell[k]] * 55 / now[cell[k]]
    assert got.keys() == ratio.keys() and all(math.isclose(got[c], ratio[c], rel_tol=1e-9) for c in ratio)
    steps = [p for p in plans if "Aggregate" in p]
    assert len(steps) == 9 and all(p.count("Aggregate") == p.count("Join") == 1 for p in steps)


def test_mixing_odd_rows(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "word " * 50_000, "en"), (4, "one two", "de"),
            (4, "one two", "de"), (None, "no id", "en")] + [(i, "a b c.", "en") for i in range(10, 60)]
    docs = docs_table(spark, rows)
    got = mix_documents(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["lang"] == "(none)" and by[1]["topic"] == "empty" and by[1]["tokens"] == 0
    assert all(r["weight"] >= 0 and r["copies"] in (math.floor(r["weight"]), math.floor(r["weight"]) + 1)
               and r["kept"] == (r["copies"] > 0) for r in got)
    assert all(r["weight"] <= 1 for r in got if r["tokens"] == 0)
    twice = [r for r in got if r["doc_id"] == 4]
    assert twice[0] == twice[1]
    kept = repeated(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in got for _ in range(r["copies"]))
    once = sampled(docs)
    assert once.columns == docs.columns and once.exceptAll(docs).count() == 0
    assert mix_documents(docs_table(spark, [])).count() == 0
    assert repeated(docs_table(spark, [])).count() == sampled(docs_table(spark, [])).count() == 0


def test_mixing_takes_columns_of_any_name(spark):
    names = ["draw", "value", "copy", "_mix_chance", "cell_source", "_c0"]
    docs = docs_table(spark, [(i, "a b c", "en") for i in range(30)]).select(
        "doc_id", "text", "lang", "source", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    for mix in (repeated, sampled):
        got = mix(docs)
        assert got.columns == docs.columns and got.exceptAll(docs.unionAll(docs)).count() == 0
        assert [got.first()[c] for c in names] == list(range(6))


def test_sample_has_the_share_it_should(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    settings = MixSettings(share=0.6)
    got = mix_documents(docs, settings).cache()
    tokens = got.agg(F.sum("tokens").alias("all"), F.sum(F.col("copies") * F.col("tokens"))
                     .alias("kept")).first()
    assert abs(tokens["kept"] / tokens["all"] - 0.6) < 0.02
    once = weighed(sampled(docs, settings)).agg(F.sum("tokens")).first()[0]
    assert abs(once / tokens["all"] - 0.6) < 0.02
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeats_reach_the_targets_beside_a_hot_source(spark):
    rng = np.random.default_rng(13)
    endings = ["", " | x", " now!!", " 123456"]
    rows = []
    for i in range(12_000):
        hot = i % 3 == 0
        source = "hot" if hot else f"s{int(rng.zipf(1.5)) % 12}"
        lang = str(rng.choice(["en", "de", "eo"], p=[0.97, 0.02, 0.01]))
        text = "word " * int(rng.integers(5, 15)) + endings[int(rng.choice(4, p=[0.9, 0.06, 0.03, 0.01]))]
        rows.append((i, text, lang, source, "t", 1))
    docs = spark.createDataFrame(rows, DOCS).cache()
    s = MixSettings()
    cells = weighed(docs).cache()
    total = cells.agg(F.sum("tokens")).first()[0]
    got = repeated(docs, s).cache()
    assert got.columns == docs.columns
    have = weighed(got).cache()
    kept = have.agg(F.sum("tokens")).first()[0]
    assert abs(kept / total - s.share) < 0.02 and kept > 0
    assert have.groupBy("doc_id").count().agg(F.max("count")).first()[0] > 1
    for d in DIMENSIONS:
        want = {r[d]: r["target"] for r in smoothed_targets(cells, d, s.power(d)).collect()}
        share = {r[d]: r["t"] / kept for r in have.groupBy(d).agg(F.sum("tokens").alias("t")).collect()}
        for value, target in want.items():
            assert abs(share.get(value, 0) - target) < 0.01 + 0.05 * target, (d, value)
    few = docs.filter("doc_id < 3").select("doc_id", F.lit(None).cast("string").alias("text"), "lang", "source")
    assert repeated(few).count() <= 3 and repeated(few.limit(0)).count() == 0


@pytest.mark.parametrize("text, topic", [
    ("", "empty"), ("a ### $$$ b", "symbols"), ("a | b | c", "lists"), ("GO!! NOW!!", "shouting"),
    ("call 12345 now please", "figures"), ("plain words", "short prose"), ("x" * 1000, "long prose")])
def test_topics(spark, text, topic):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(topic_of(F.col("t")).alias("x")).first()["x"] == topic
