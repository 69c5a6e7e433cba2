import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.operators import index as ix
from tidepool.operators import ordered
from tidepool.sources import index_files
from tidepool.storage import scratch_path

TEXTS = [
    ("u1", "Class class CLASS the cat, the dog."), ("u2", "the café CAFÉ _x1 switch Switch"),
    ("u3", ""), ("u4", "don't stop; a/b the"), ("u;5,6", "the end % of"), ("u7", "naïve 日本 ß the"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate(TEXTS)],
                                 "n INT, url STRING, text STRING")


def test_exclusion_before_lowercase(docs):
    terms = {(r["url"], r["term"]): r["tf"] for r in ix.document_index(docs).collect()}
    assert terms[("u1", "class")] == 2  # "class" is excluded as written, "Class" and "CLASS" stay
    assert terms[("u2", "switch")] == 1
    assert terms[("u2", "café")] == 2 and terms[("u2", "_x1")] == 1
    assert not any(u == "u3" for u, _ in terms)
    ci = ix.document_index(docs, IndexConfig(exclude_ci=True))
    assert ci.filter("term IN ('class', 'switch')").count() == 0


def test_marks_are_terms_on_request(docs):
    got = {r["token"] for r in ix.exclude_tokens(ix.tokenize(docs, IndexConfig(words_only=False)),
                                                 IndexConfig(words_only=False)).collect()}
    assert {",", ".", "%"} <= got and not {"'", ";", "/"} & got


def by_term(index):
    out = {}
    for r in index.collect():
        f, urls = out.get(r["term"], (0, []))
        out[r["term"]] = (f + r["freq"], urls + r["postings"])
    return {t: (f, sorted(u)) for t, (f, u) in out.items()}


@pytest.mark.parametrize("block_bytes", [1, 40, 10_000])
@pytest.mark.parametrize("shards", [1, 3])
def test_blocks_merge_to_the_index(docs, block_bytes, shards):
    cfg = IndexConfig(block_bytes=block_bytes)
    whole = ix.inverted_index(ix.document_index(docs), shards)
    blocks = ix.build_blocks(docs, "n", cfg, shards)
    assert blocks.select("block").distinct().count() == {1: 5, 40: 3, 10_000: 1}[block_bytes]
    columns = ["term", "shard", "freq", "df", "postings"]
    assert rows(ix.merge_blocks(blocks, shards), *columns) == rows(whole, *columns)
    unsharded = blocks.drop("shard")
    assert rows(ix.merge_blocks(unsharded, shards), *columns) == rows(whole, *columns)


def test_blocks_move_no_text(docs):
    plan = ix._counted(docs, "n", IndexConfig())._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("text#" in line for line in exchanges)


def test_url_seen_twice_is_one_posting(spark):
    docs = spark.createDataFrame([(1, "u", "x y"), (2, "u", "x"), (3, "v", "x")],
                                 "n INT, url STRING, text STRING")
    merged = by_term(ix.merge_blocks(ix.build_blocks(docs, "n", IndexConfig(block_bytes=1)), 1))
    assert merged == {"x": (3, ["u", "v"]), "y": (1, ["u"])}
    assert merged == by_term(ix.inverted_index(ix.document_index(docs), 1))


def test_dictionary_points_into_the_file(spark, docs, monkeypatch):
    monkeypatch.setattr(ordered, "MIN_ROWS", 4)
    index = ix.inverted_index(ix.document_index(docs), 2)
    path = scratch_path(spark, "index").replace("file:", "")
    index_files.write_index(index, path)
    data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*")))
    dictionary = ix.build_dictionary(index).collect()
    assert sum(r["byte_len"] for r in dictionary) == len(data)
    for r in dictionary:
        piece = data[r["byte_offset"]:r["byte_offset"] + r["byte_len"]].decode("utf-8")
        lines = piece.splitlines()
        assert lines and all(line.split(";")[0] == r["term"] for line in lines)
    back = index_files.read_index(spark, path)
    assert by_term(back) == by_term(index)
    text = scratch_path(spark, "dictionary")
    index_files.write_dictionary(ix.build_dictionary(index), text)
    assert rows(index_files.read_dictionary(spark, text)) == rows(
        ix.build_dictionary(index), "term", "byte_offset")
    terms = [line.split(" ")[0] for line in spark.read.text(text).rdd.map(lambda r: r[0]).collect()]
    assert terms == sorted(terms, reverse=True)


def test_blocks_on_disk(spark, docs):
    blocks = ix.build_blocks(docs, "n", IndexConfig(block_bytes=40))
    path = scratch_path(spark, "blocks")
    index_files.write_blocks(blocks, path)
    index_files.write_blocks(blocks, path)  # a rerun replaces its blocks
    assert rows(index_files.read_blocks(spark, path), "block", "term", "freq", "postings") == rows(
        blocks, "block", "term", "freq", "postings")


def test_line_parsing(spark):
    lines = spark.createDataFrame([(" term ;7;a,b;ignored;x",)], "value STRING")
    assert rows(index_files.parse_lines(lines)) == [("term", 7, ["a", "b"])]


def test_search(spark, docs):
    postings = ix.document_index(docs)
    assert rows(ix.search_term(postings, "CAFÉ"), "url") == [("u2",)]
    assert ix.search_term(postings, "CAFÉ", exact=True).count() == 0
    assert ix.search_term(postings, "absent").count() == 0
    wanted = spark.createDataFrame([("The",), ("the",), ("dog",), ("nope",)], "term STRING")
    assert ix.search_batch(postings, wanted).count() == 6
    assert rows(ix.search_all(postings, ["the", "dog"])) == [("u1",)]
    assert rows(ix.search_without(postings, "the", "dog")) == [("u2",), ("u4",), ("u7",), ("u;5,6",)]
    assert rows(ix.search_any(postings, ["dog", "end"])) == [("u1",), ("u;5,6",)]
    index = ix.inverted_index(postings, 1)
    assert rows(ix.search_json(index, ["dog"]), "json") == [('["u1"]',)]


def test_saved_postings_prune_by_term(spark, docs):
    path = scratch_path(spark, "saved")
    ix.save_postings(ix.document_index(docs), path)
    hits = ix.search_term(ix.open_postings(spark, path), "the")
    assert hits.count() == 5
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,the)" in plan


def test_index_raw_markup(spark):
    pages = spark.createDataFrame([("u", "<p class='x'>hi</p>")], "url STRING, html STRING")
    raw = ix.document_index(ix.page_text(pages, "raw"))
    assert {r["term"] for r in raw.collect()} == {"p", "x", "hi"}
    assert {r["term"] for r in ix.document_index(ix.page_text(pages)).collect()} == {"hi"}


def test_shards_bound_the_postings(spark):
    docs = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("the").alias("text"))
    cfg = IndexConfig(docs_per_shard=100)
    index = ix.inverted_index(ix.document_index(docs), ix.shard_count(docs, cfg))
    sizes = [len(r["postings"]) for r in index.collect()]
    assert sum(sizes) == 2000 and len(sizes) == 20 and max(sizes) < 200


def test_set_operations_on_bits(spark):
    import random

    rng = random.Random(3)
    has = {t: {f"http://h/{rng.randrange(70_000)}" for _ in range(n)}
           for t, n in (("often", 9000), ("some", 300), ("rare", 2), ("other", 8000))}
    postings = spark.createDataFrame([(u, t, 1) for t, urls in has.items() for u in urls] + [("x", None, 0)],
                                     "url STRING, term STRING, tf LONG").repartition(4)
    numbers = ix.number_urls(postings)
    bitmaps = ix.term_bitmaps(postings, numbers).cache()
    assert bitmaps.filter("size(words) > 512").count() == 0
    assert bitmaps.filter("term = 'often'").agg(F.sum(F.size("words"))).first()[0] < 400
    got = lambda bits: {r["url"] for r in ix.urls_of(bits, numbers).collect()}
    assert got(ix.bits_of_all(bitmaps, ["often", "OTHER"])) == has["often"] & has["other"]
    assert got(ix.bits_of_all(bitmaps, ["often", "often"])) == has["often"]
    assert got(ix.bits_of_all(bitmaps, ["rare", "none"])) == set()
    assert got(ix.bits_of_any(bitmaps, ["some", "rare"])) == has["some"] | has["rare"]
    assert got(ix.bits_without(bitmaps, "often", "other")) == has["often"] - has["other"]
    assert got(ix.bits_without(bitmaps, "some", "none")) == has["some"]
