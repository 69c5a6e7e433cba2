"""The corpus pipeline: every stage on documents with planted cases and on odd tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.storage import materialize

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
          "k long, _row string, ratio double")
ENGLISH = "the cat and dog went up to house by river with old man who had seen many things".split()
GERMAN = "der hund und die katze gingen zum haus am fluss mit dem alten mann welcher viel sah".split()


def prose(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "s", "en", "ly"]) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(80):
        words = ENGLISH if i % 2 else GERMAN
        rows.append([i, prose(rng, words, rng.randint(60, 200)), "en" if i % 2 else "de", f"s{i % 3}"])
    passage = prose(rng, ENGLISH, 60)
    rows.append([100, rows[3][1], "en", "s0"])                                  # an exact copy
    near = rows[5][1].split(" ")
    near[7] = "changed"
    rows.append([101, " ".join(near), "en", "s1"])                              # a near copy
    rows.append([102, prose(rng, ENGLISH, 90) + " " + passage, "en", "s1"])
    rows.append([103, prose(rng, ENGLISH, 90) + " " + passage, "en", "s2"])     # a shared passage
    rows.append([104, "12345 67890 !!", "en", "s0"])                            # no language
    rows.append([105, None, None, None])
    rows.append([106, "", "en", None])
    return [tuple(r) for r in rows], passage


def table(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, source, None if t is None else len(t), True, 1, "x", 0.5)
         for i, t, lang, source in rows], SCHEMA)


def staged(spark, docs, upto):
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), name)
        if name == upto:
            return docs


def test_language_keeps_what_it_can_tell(spark, corpus):
    rows, _ = corpus
    docs = table(spark, rows)
    left = staged(spark, docs, "language")
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in rows} - {104, 105, 106}


def test_near_copies_leave_one_of_each_group(spark, corpus):
    rows, _ = corpus
    docs = table(spark, rows + [rows[9], rows[9]])
    left = corpus_pipeline.near_copies(spark, docs, "")
    assert left.columns == docs.columns
    ids = sorted(r["doc_id"] for r in left.collect())
    assert ids == sorted({r[0] for r in rows} - {100, 101})


def test_near_copies_judge_rows_and_not_ids(spark):
    rng = random.Random(23)
    texts = [prose(rng, ENGLISH, 90) for _ in range(7)]
    near = [t.replace(" ", " changed ", 1) for t in texts]
    rows = [(1, texts[0]), (None, near[0]), (None, texts[1]), (None, None), (None, ""),  # a copy without id
            (2, texts[2]), (3, near[2]), (3, texts[3]),                         # a copy shares its id
            (4, texts[4]), (4, near[4]),                                        # copies share one id
            (None, texts[5]), (None, near[5]),                                  # copies without one
            (6, texts[6]), (5, near[6]), (None, texts[6]), (5, near[6])]
    left = corpus_pipeline.near_copies(spark, table(spark, [(*r, "en", "s") for r in rows]), "")
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    alone = {(1, texts[0]), (None, texts[1]), (None, None), (None, ""), (2, texts[2]), (3, texts[3]),
             (5, near[6])}
    assert alone <= set(got)
    assert sorted((i is None, texts.index(t) if t in texts else near.index(t))
                  for i, t in set(got) - alone) == [(False, 4), (True, 5)]


def test_repeats_are_cut(spark, corpus):
    rows, passage = corpus
    docs = table(spark, rows)
    left = {r["doc_id"]: r for r in corpus_pipeline.repeats(spark, docs, "").collect()}
    assert passage in left[102]["text"] and passage not in left[103]["text"]
    assert left[100]["text"] == "" and left[105]["text"] is None
    for i, text, *_ in rows[:80]:
        assert left[i]["text"] == text
    for r in left.values():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_mixing_follows_its_operator(spark, corpus):
    from tidepool.llm.mixing import mix_documents

    rows, _ = corpus
    docs = table(spark, rows)
    left = corpus_pipeline.mixing(spark, docs, "")
    assert left.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in mix_documents(docs).filter("kept").collect()}
    assert {r["doc_id"]: r["count"] for r in left.groupBy("doc_id").count().collect()} == want


def test_packing_takes_all_that_is_left(spark, corpus):
    rows, _ = corpus
    docs = staged(spark, table(spark, rows), "mixing")
    pieces = corpus_pipeline.packing(spark, docs, "")
    have = {r["doc_id"]: r["n"] for r in pieces.groupBy("doc_id").agg(
        F.sum("length").alias("n")).collect()}
    copies = {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    want = {r["doc_id"]: r["n"] * copies[r["doc_id"]] for r in pieces.select(
        "doc_id", F.col("doc_tokens").alias("n")).distinct().collect()}
    assert have == want and set(have) == set(copies)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    empty = table(spark, [])
    assert stage(spark, empty, "").count() == 0
    odd = table(spark, [(None, None, None, None), (None, "some words here", None, "s"), (1, "", "en", None),
                        (1, "", "en", None), (2, "x " * 30_000, "en", "s"), (3, "ends", "en", "s")])
    out = stage(spark, odd, "")
    assert out.count() <= (30 if name in ("mixing", "packing") else 6)  # copies, pieces
    if name != "packing":
        assert out.columns == odd.columns


def test_packing_keeps_few_words_on_the_workers(monkeypatch):
    asked = {}
    monkeypatch.setattr(corpus_pipeline, "pack_documents", lambda docs, **given: asked.update(given))
    corpus_pipeline.packing(None, None, "")
    assert asked["settings"].cache_words <= 100_000


def test_run_over_the_test_table(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "repeats", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    pieces = corpus_pipeline.run(spark, sf)
    sizes = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sizes.filter("n <> end or n > 4096").count() == 0
    assert sizes.filter("bit_count(n) <> 1").count() == 0  # full windows or powers of two
