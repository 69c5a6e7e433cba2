"""Near duplicates and repeated passages against brute force, with hot groups and odd rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.llm import near_duplicates as near
from tidepool.llm.bwt import repeated_prefixes
from tidepool.llm.components import connected_components
from tidepool.llm.near_duplicates import NearSettings, near_duplicates
from tidepool.llm.repeats import (RepeatSettings, _halves, _text_segments, _wanted_segments,
                                  _whole_keys, repeat_digest, without_repeats)

SCHEMA = "doc_id long, text string, kept string, key int, spans string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)


def brute_sets(rows, words):
    out = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        out[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words \
            else ({tuple(w)} if w else set())
    return out


def brute_components(rows, words=2, percent=80):
    sets = brute_sets(rows, words)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p:p + length]
            if window in seen:
                covered[p:p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, m in zip(raw, covered) if not m)
        runs = sum(1 for k in range(len(raw)) if covered[k] and (k == 0 or not covered[k - 1]))
        out[i] = (len(raw), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n=90):
    """Copies, near copies, a passage that many share, and runs of one letter."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choices(vocabulary, k=k))
    passage, rows = prose(40), []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4 or not rows:
            text = prose(rng.randint(1, 120))
        elif kind < 0.5:
            text = rng.choice(rows)[1]
        elif kind < 0.75:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        elif kind < 0.95:
            text = prose(rng.randint(0, 30)) + "\n" + passage + " " + prose(rng.randint(0, 30))
        else:
            text = "a" * rng.randint(90, 400)
        rows.append((i, text))
    return rows


def components(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("words", [2, 5])
def test_components_match_all_pairs(spark, words):
    rows = corpus(words, 120)
    got = components(near_duplicates(table(spark, rows), NearSettings(shingle_words=words)))
    assert got == brute_components(rows, words)


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "TASK_ROWS", 50)
    monkeypatch.setattr(near, "CELL_BYTES", 4000)
    monkeypatch.setattr(near, "HUB_PAIRS", 4)
    rows = corpus(9, 100)
    assert components(near_duplicates(table(spark, rows), NearSettings(2))) == brute_components(rows)


def test_a_group_of_near_copies_without_a_common_hub(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):  # a chain: each differs a little from the one before, much from the first
        base[rng.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(base)))
    assert components(near_duplicates(table(spark, rows), NearSettings(2))) == brute_components(rows)


def test_sketches_of_similar_sets_are_close(spark):
    s, rng = NearSettings(), np.random.default_rng(0)
    apart = []
    for _ in range(40):
        both = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        pair = [both[:450], both[50:]]  # a similarity of 0.8
        bits = near.sketch_bits(near.least_hashes([np.unique(x) for x in pair], s.functions))
        apart.append(int(np.bitwise_count(bits[0] ^ bits[1]).sum()))
    assert max(apart) <= s.max_bits and 75 < np.mean(apart) < 130
    other = near.sketch_bits(near.least_hashes(
        [np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(2)], s.functions))
    rows = [(bits[0].view(np.int64).tolist(), x.view(np.int64).tolist()) for x in (bits[1], other[0])]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r["d"] for r in df.select(near.differing_bits(F.col("a"), F.col("b"), s).alias("d")).collect()]
    assert got[0] == apart[-1] and got[1] > 400


def test_keys_meet_every_pair_within_the_distance():
    s = NearSettings()
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (300, s.values), dtype=np.uint64)
    b = a.copy()
    for row in b:
        row[rng.permutation(s.values)[:s.max_distance]] ^= np.uint64(1)
    assert (near._keys(a, s) == near._keys(b, s)).any(1).all()


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "ONE"), (10, "one two"),
            (11, "One  two"), (11, "One  two"), (None, "one two"), (12, "one " * 40_000)]
    got = near_duplicates(table(spark, rows), NearSettings(2)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i in (5, 6, 7):
        assert by[i]["n_shingles"] == 0 and by[i]["component_id"] == i and by[i]["kept"]
    assert by[9]["component_id"] == 8 and not by[9]["kept"]
    assert by[11]["component_id"] == 10 and by[None]["component_id"] == 10 and not by[None]["kept"]
    assert by[12]["n_shingles"] == 1 and by[12]["kept"]
    assert near_duplicates(table(spark, [])).count() == 0


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, k) for k in range(1, 50)] + [(7, 7)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    root = {i: i for pair in links for i in pair}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (root[a] == root[b])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def digests(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in df.collect()}


@pytest.mark.parametrize("settings", [
    RepeatSettings(length=20, gram=8), RepeatSettings(length=30, gram=30),
    RepeatSettings(length=20, gram=8, shard_bytes=60, task_bytes=400),
    RepeatSettings(length=24, gram=6, hot_segments=2)])
def test_repeats_match_brute_force(spark, settings):
    rows = corpus(settings.length + settings.hot_segments, 100)
    got = digests(repeat_digest(table(spark, rows), settings))
    assert got == brute_repeats(rows, settings.length)


def test_a_passage_in_most_documents(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("xyzuvw", k=5))
    passage = " ".join(word() for _ in range(50))
    rows = [(i, " ".join(word() for _ in range(20)) + " " + passage + " " + word())
            for i in range(150)]
    settings = RepeatSettings(length=40, gram=12, hot_segments=10)
    assert digests(repeat_digest(table(spark, rows), settings)) == brute_repeats(rows, 40)


def test_splitting_hot_anchors_keeps_windows_whole(spark):
    text = "abcdefghijklmnopqrstuvwxyz0123456789"
    s = RepeatSettings(length=10, gram=4)
    hot = spark.createDataFrame(
        [(1, 1, 3, bytearray(text[3:18].encode()), 5, 0, s.reach - 1)],
        "r long, key long, lo int, bytes binary, anchor int, low int, high int")
    parts = _halves(hot, s).collect()
    starts = sorted(p["lo"] + j for p in parts for j in range(p["windows"]))
    assert starts == list(range(3, 3 + 6)) and len(parts) == 2
    for p in parts:
        assert bytes(p["bytes"]).decode() == text[p["lo"]:p["lo"] + p["windows"] + 9]
        assert p["lo"] + p["anchor"] == 8


def test_repeats_of_odd_rows(spark):
    long = "".join(chr(97 + (i * i * 7 + i // 13) % 26) for i in range(1_300_000))
    rows = [(None, "q" * 50), (1, None), (2, ""), (3, "short"), (4, "q" * 50), (5, long),
            (6, long[600_000:900_000]), (6, long[600_000:900_000])]
    got = repeat_digest(table(spark, rows), RepeatSettings(length=100)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_bytes"] == by[2]["n_bytes"] == 0 and by[3]["n_removed"] == 0
    assert by[6]["n_removed"] == 300_000 and by[6]["n_spans"] == 1
    short = RepeatSettings(length=20, gram=8)
    by = {r["doc_id"]: r for r in repeat_digest(table(spark, rows[:5]), short).collect()}
    assert by[None]["n_removed"] == 49 and by[4]["n_removed"] == 50  # null ids come first
    assert repeat_digest(table(spark, [])).count() == 0


def test_text_without_repeats(spark):
    passage = "é passage that is long enough to be found again ü"
    rows = [(1, "first " + passage), (2, passage + " last"), (3, None), (2, passage + " last")]
    docs = table(spark, rows)
    out = without_repeats(docs, RepeatSettings(length=20, gram=8))
    assert out.columns == docs.columns and out.schema == docs.schema
    by = {r["doc_id"]: r["text"] for r in out.collect()}
    assert by[1] == "first " + passage and by[3] is None and by[2] == " last"
    assert out.count() == 4 and without_repeats(table(spark, [])).count() == 0


def test_merge_matches_brute_force():
    rng = np.random.default_rng(1)
    for turn in range(40):
        lengths = rng.integers(0, 60, rng.integers(1, 12))
        letters = 255 if turn % 5 == 0 else rng.integers(1, 5)
        data = rng.integers(0, letters + 1, lengths.sum()).astype(np.uint8)
        depth = int(rng.choice([2, 3, 10]))
        if not len(data):
            continue
        group, place = repeated_prefixes(data, lengths, depth, int(rng.choice([8, 40, 1000])))
        got, want, at = {}, {}, 0
        for g, p in zip(group, place):
            got.setdefault(g, []).append(int(p))
        for n in lengths:
            for p in range(at, at + n - depth + 1):
                want.setdefault(bytes(data[p:p + depth]), []).append(p)
            at += n
        assert sorted(map(sorted, got.values())) == sorted(x for x in want.values() if len(x) > 1)


def test_segments_are_merged_in_portions_of_whole_keys():
    rng = np.random.default_rng(1)
    keys, lengths = rng.integers(0, 40, 500), rng.integers(100, 180, 500)
    keys[:90] = 7
    portions = _whole_keys(keys, lengths, 4000)
    assert sorted(np.concatenate(portions).tolist()) == list(range(500))
    found = [set(keys[p].tolist()) for p in portions]
    assert sum(map(len, found)) == len(set(keys.tolist()))  # no key is in two of them
    assert all(lengths[p].sum() <= 4000 or len(k) == 1 for p, k in zip(portions, found))
    assert len(portions) > 10 and [len(p) for p in _whole_keys(keys[:0], lengths[:0], 4000)] == [0]


def test_segments_of_many_texts_are_cut_at_once():
    rng, s = random.Random(4), RepeatSettings(length=20, gram=8)
    texts = [bytes(rng.choices(b"abcd ", k=n)) for n in (0, 19, 20, 300, 90, 5, 400, 20)]
    expected, wanted = [], []
    for i, text in enumerate(texts):
        wanted.append([])
        for _, lo, windows, (anchor, gram), _ in _text_segments(
                np.frombuffer(text, np.uint8), np.array([0, len(text)]), s):
            assert lo[0] == 0 and list(lo[1:]) == list((lo + windows)[:-1])
            assert lo[-1] + windows[-1] == len(text) - s.length + 1
            for a, n, at, g in list(zip(lo, windows, anchor, gram.view(np.int64)))[::2]:
                wanted[-1].append(int(a))
                expected.append((100 + i, a, n, at, g, text[a:a + n - 1 + s.length]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(99, 108)), pa.array([b"a" * 50, *texts], pa.binary()),
         pa.array([[1], *wanted], pa.list_(pa.int32()))], ["r", "t", "wanted"]).slice(1)
    got = list(_wanted_segments(batch, s))
    assert len(got) == 1
    assert [tuple(r.values()) for r in got[0].to_pylist()] == expected
