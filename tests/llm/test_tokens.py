"""Token encoding, token files, length histograms and packing against the tokenizer itself."""

import gc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepool.llm import batches, tokens
from tidepool.llm.lengths import length_histogram, length_quantile, suffix_sums, truncated_total
from tidepool.llm.packing import (
    PackSettings, _driver_rows, combinations, non_negative_least_squares, pack_documents,
    solve_repeats,
)
from tidepool.llm.token_files import read_token_files, token_file_digest, write_token_files
from tidepool.storage import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, row string, n int, part long"
ODD = [None, "", " ", "\n\n", "Hello, World. it's 12%", "Füße ÉTÉ çà İstanbul ΟΔΟΣ σας", "a b c",
       "été ́x", "<|endoftext|> and <|startoftext|>.", "<|ENDOFTEXT|>", "x\x01y \x01 z",
       "one,two ,three . four..", "日本語 テキスト", "tab\there\r\nand\x0bthere\x0cfin", "!!! ### $$$ &&&,"]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)

    def encode(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        return np.array([*ids, 2], "<u4")

    return encode


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_words_encode_like_whole_texts(spark, sf, path):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    encoder = tokens.Encoder(path)
    assert encoder.by_word == (path == PATH)
    library = Tokenizer.from_file(path)
    for text in [*texts, *ODD[1:]]:
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.text(text.encode()) == want, text[:80]


def test_signs_and_case_do_not_change_ids(whole):
    coder = tokens.Encoder(PATH)
    texts = ["Word word. WORD,. word$$$ word.'s it's IT'S (word) \"Word\" 12. 12.5% -word- É. ÉTÉ!!",
             "J\u030c j\u030c \u01f0 I\u0307 i\u0307 \u0130 \u212a K", "--.. .,; a.b.c. …. ß. Σας ΣΑΣ.",
             "<|ENDOFTEXT|> Word", "x\u00a0y. Ab\u2014.. ab\u2014.."]
    for text in texts:
        assert coder.text(text.encode()) == whole(text)[:-1].tobytes(), text


def test_a_stem_is_encoded_once(monkeypatch):
    coder, stems, slow = tokens.Encoder(PATH), [], []
    model, encode = coder.tokenize, coder._encode
    monkeypatch.setattr(coder, "tokenize", lambda word: stems.append(word) or model(word))
    monkeypatch.setattr(coder, "_encode", lambda text: slow.append(text) or encode(text))
    coder.text(b"Heaned heaned. heaned$$$ HEANED!! heaned,")
    assert stems == ["heaned"] and set(slow) == {".", "$$$", "!!", ","}


def test_a_full_cache_changes_nothing(monkeypatch, whole):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    encoder = tokens.Encoder(PATH)
    text = "one two three four five six two one seven, eight. one"
    assert encoder.text(text.encode()) == whole(text)[:-1].tobytes()


def test_token_files(spark, sf, whole):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, rows), path)
    want, start = {}, 0
    for i, text in sorted(rows):
        ids = whole(text)
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in token_file_digest(spark, path).collect()}
    assert got == want
    found = read_token_files(spark, path, [3, 77, 10**9])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan
    assert {r["doc_id"]: r["ids"] for r in found.collect()} == {
        i: whole(dict(rows)[i]).tolist() for i in (3, 77)}


def test_token_files_of_odd_rows(spark, whole):
    rows = [(None, "no id"), (3, None), (3, "twice"), (3, "twice"), (2, ""), (1, "w " * 50_000)]
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, rows), path)
    got = sorted(token_file_digest(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 3, 3]
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]]
    assert sorted(r["n_tokens"] for r in got) == sorted(len(whole(t)) for _, t in rows)
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, []), path)
    assert token_file_digest(spark, path).count() == 0


def test_length_histogram(spark, sf, whole):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(None, t) for t in ODD] + [(1, "same")] * 30
    n = np.array([len(whole(t)) for _, t in rows])
    histogram = length_histogram(table(spark, rows)).cache()
    assert {r["n_tokens"]: r["n_docs"] for r in histogram.collect()} == {
        int(k): int((n == k).sum()) for k in set(n)}
    sums = suffix_sums(histogram)
    for r in sums.collect():
        k = r["n_tokens"]
        assert r["docs_at_least"] == (n >= k).sum() and r["tokens_at_least"] == n[n >= k].sum()
        assert r["docs_up_to"] == (n <= k).sum()
        assert r["truncated_tokens"] == np.minimum(n, k).sum()
    for limit in (0, 1, 100, 2048, 10**6):
        assert truncated_total(histogram, limit) == np.minimum(n, limit).sum()
    ordered = np.sort(n)
    for q in (0.01, 0.5, 0.9, 1.0):
        assert length_quantile(sums, q) == ordered[int(np.ceil(q * len(n))) - 1]
    empty = length_histogram(table(spark, []))
    assert suffix_sums(empty).count() == 0 and truncated_total(empty, 5) == 0
    assert length_quantile(suffix_sums(empty), 0.5) is None


def packed(spark, rows, whole, settings):
    got = pack_documents(table(spark, rows), settings=settings).collect()
    ids = [(i, whole(t)) for i, t in rows]
    by_sequence, padding = {}, 0
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= settings.window
        padding += 0 if at & (at - 1) == 0 else settings.window - at
    assert sum(r["length"] for r in got) == sum(len(x) for _, x in ids)
    want = sorted((str(i), k, int(x[k])) for i, x in ids for k in range(len(x)))
    texts = {str(i): x for i, x in ids}
    have = []
    for r in got:
        x = texts[str(r["doc_id"])]
        part = x[r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(x)
        have += [(str(r["doc_id"]), r["start"] + k, int(v)) for k, v in enumerate(part)]
    assert sorted(have) == want
    return padding


def test_packing_keeps_every_id_once(spark, sf, whole):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    assert packed(spark, rows, whole, PackSettings()) == 0
    assert packed(spark, rows[:60], whole, PackSettings(window=256, unit=16, depth=4)) == 0


def test_packing_odd_rows(spark, whole):
    settings = PackSettings(window=64, unit=8, depth=4)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, "w " * 127), (101, "w " * 3000)]
    rows += [(102, "same words"), (102, "same words"), (None, "no id")]
    assert packed(spark, rows, whole, settings) == 0
    assert packed(spark, [(7, None)], whole, settings) == 0
    assert pack_documents(table(spark, [])).count() == 0


def test_least_squares_solution_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random((6, 9)), rng.normal(size=6)
        x = non_negative_least_squares(a, b)
        gradient = a.T @ (a @ x - b)
        assert (x >= 0).all() and (gradient > -1e-7).all() and abs(gradient @ x) < 1e-7


def test_repeats_never_exceed_the_supply():
    s = PackSettings()
    combos = combinations(s.units, s.depth)
    assert (combos @ np.arange(s.units + 1) == s.units).all()
    assert (combos.sum(1) <= s.depth).all() and len(np.unique(combos, axis=0)) == len(combos)
    rng = np.random.default_rng(4)
    for supply in ({1: 5}, {64: 3}, {u: int(rng.integers(0, 400)) for u in range(1, 65)}):
        tokens_left = sum((u * 64 - 20) * n for u, n in supply.items())
        used = np.zeros(65)
        windows = 0
        for combo, repeats in solve_repeats(supply, tokens_left, s):
            used += combo * repeats
            windows += repeats
        assert all(used[u] <= supply.get(u, 0) for u in range(1, 65))
        assert windows * s.window <= tokens_left


def test_a_worker_gives_an_encoder_and_hashing_tables_back():
    tokens._encoders.clear()
    gc.disable()  # as long as nothing collects cycles by chance
    try:
        left = weakref.ref(tokens.encoder(tokens.default_tokenizer()).words)
        list(tokens.encoded_texts(pa.array([b"some words"]), tokens.default_tokenizer(), 2))
        batches.powers(10, 3)
        assert list(batches.lean(lambda rows: rows, keep=True)(iter([1]))) == [1]
        assert left() is not None and not batches._POWERS
        assert list(batches.lean(lambda rows: rows)(iter([1]))) == [1]
        assert left() is None
    finally:
        gc.enable()


def test_a_small_cache_of_words_changes_no_piece(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 400))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = (sorted(tuple(r) for r in pack_documents(docs, settings=s).collect())
                 for s in (PackSettings(), PackSettings(cache_words=50)))
    assert got == want
    path = tokens.default_tokenizer()
    texts = pa.array([t.encode() for _, t in rows])
    assert list(tokens.encoded_texts(texts, path, 2, 50)) == list(tokens.encoded_texts(texts, path, 2))
    list(tokens.encoded_texts(texts, path, 2, 50))
    words = tokens.encoder(path, 50).words
    assert 0 < len(words) <= 50 and 0 < len(words.older) <= 50


def test_sessions_read_whole_texts_in_small_batches(spark):
    session = spark.newSession()
    name = "spark.sql.parquet.columnarReaderBatchSize"
    batches.whole_texts(session.range(1))
    assert session.conf.get(name) == str(batches.READ_ROWS)
    session.conf.set(name, "77")
    batches.whole_texts(session.range(1))
    assert session.conf.get(name) == "77"


def test_rows_of_the_driver(spark):
    for rows in ([], [(1, np.int64(5)), (2, 6)]):
        table = _driver_rows(spark, rows, "units", "used")
        assert [tuple(r) for r in table.collect()] == [tuple(r) for r in rows]
