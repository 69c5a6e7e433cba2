"""Ordered operators against plain Python, with one key holding much of the table."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import ordered
from tidepool.operators.timing import debounce, event_packets, idle_sessions, throttle


def make(seed, n=400):
    rng = random.Random(seed)
    keys = [None, "a", "b", "c", "d"]
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(keys)
        out.append((i, key, rng.randrange(0, 3 * n), rng.choice([None, *range(-5, 6)])))
    return out


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


@pytest.fixture(params=[1, 2])
def case(request, spark):
    data = make(request.param)
    df = spark.createDataFrame(data, "id INT, k STRING, t LONG, v LONG")
    return data, df


@pytest.mark.parametrize("chunks", [7, None])
def test_running_folds(case, chunks):
    data, df = case
    parts = ordered.order_chunks(df, ["k"], ["t", "id"], chunks)
    assert not chunks or parts.select(ordered.CHUNK).distinct().count() == 7
    v = F.col("v")
    out = ordered.running(parts, ["k"], ["t", "id"], {
        "s": ("sum", v), "lo": ("min", v), "hi": ("max", v), "n": ("count", v)})
    out = ordered.running(out, ["k"], ["t", "id"], {"rs": ("sum", v), "rmax": ("max", v)},
                          reverse=True)
    out = ordered.running(out, ["k"], ["t", "id"], {"xs": ("sum", v), "xlo": ("min", v)},
                          exclusive=True)
    got = {r["id"]: (r["s"], r["lo"], r["hi"], r["n"], r["rs"], r["rmax"], r["xs"], r["xlo"])
           for r in out.collect()}
    assert len(got) == len(data)

    def fold(f, values):
        values = [x for x in values if x is not None]
        return f(values) if values else None

    for rows in by_key(data).values():
        vs = [r[3] for r in rows]
        for i, r in enumerate(rows):
            upto, rest, before = vs[:i + 1], vs[i:], vs[:i]
            assert got[r[0]] == (
                fold(sum, upto), fold(min, upto), fold(max, upto),
                sum(x is not None for x in upto), fold(sum, rest), fold(max, rest),
                fold(sum, before) or 0, fold(min, before))


@pytest.mark.parametrize("chunks", [6, None])
@pytest.mark.parametrize("forward", [True, False])
def test_shift(case, forward, chunks):
    data, df = case
    parts = ordered.order_chunks(df, ["k"], ["t", "id"], chunks)
    out = ordered.shift(parts, ["k"], ["t", "id"], {"near": F.col("v")}, forward)
    got = {r["id"]: None if r["near"] is None else (r["near"]["v"],) for r in out.collect()}
    for rows in by_key(data).values():
        for i, r in enumerate(rows):
            j = i - 1 if forward else i + 1
            assert got[r[0]] == ((rows[j][3],) if 0 <= j < len(rows) else None)


def test_runs_and_numbers(case):
    data, df = case
    parts = ordered.order_chunks(df, ["k"], ["t", "id"], chunks=5)
    got = {r["id"]: r["run_id"]
           for r in ordered.runs(parts, ["k"], ["t", "id"], ["v"]).collect()}
    for rows in by_key(data).values():
        run = 0
        for i, r in enumerate(rows):
            run += i == 0 or rows[i - 1][3] != r[3]
            assert got[r[0]] == run
    numbers = ordered.row_numbers(df, [F.col("v").desc_nulls_first(), "id"], chunks=5)
    want = sorted(data, key=lambda r: (r[3] is not None, -(r[3] or 0), r[0]))
    assert [r["id"] for r in numbers.orderBy("pos").collect()] == [r[0] for r in want]


@pytest.fixture(params=["chunks", "plain"])
def layout(request, monkeypatch):
    """Force the range-partitioned chunks, or leave the small table to plain windows."""
    monkeypatch.setattr(ordered, "MIN_ROWS", 30)
    if request.param == "chunks":
        monkeypatch.setattr(ordered, "MAX_KEY_ROWS", 10)
    return request.param


def test_layout(case, layout):
    _, df = case
    parts = ordered.order_chunks(df, ["k"], ["t", "id"])
    assert (ordered.CHUNK in parts.columns) == (layout == "chunks")
    out = ordered.running(parts, ["k"], ["t", "id"], {"x": ("sum", F.col("v"))}, exclusive=True)
    assert out.filter("x IS NULL").count() == 0
    assert ordered.order_chunks(df, [], ["t", "id"]).select(ordered.CHUNK).distinct().count() == 4


@pytest.mark.parametrize("wait", [1, 7, 60, 5000])
def test_throttle(case, wait, layout):
    data, df = case
    got = {r["id"] for r in throttle(df, ["k"], "t", "id", wait).collect()}
    want = set()
    for rows in by_key(data).values():
        last = None
        for r in rows:
            if last is None or r[2] >= last + wait:
                want.add(r[0])
                last = r[2]
    assert got == want


@pytest.mark.parametrize("limit", [1, 12, 50, 900])
def test_packets(case, spark, limit):
    data, _ = case
    df = spark.createDataFrame([(r[0], "x" * (r[2] % 17)) for r in data], "id INT, body STRING")
    parts_before = ordered.MIN_ROWS
    ordered.MIN_ROWS = 40
    try:
        got = {r["id"]: r["packet"] for r in event_packets(df, "id", F.col("body"), limit).collect()}
    finally:
        ordered.MIN_ROWS = parts_before
    packet, used = 0, None
    for r in sorted(data):
        size = r[2] % 17
        if used is None or used + size > limit:
            packet, used = packet + 1, 0
        used += size
        assert got[r[0]] == packet


def test_debounce_and_idle(case, layout):
    data, df = case
    fired = {r["id"]: r["fired_us"] for r in debounce(df, ["k"], "t", "id", 5).collect()}
    idle = {(r["k"], r["session"]): (r["active_us"], r["idle_us"], r["n"])
            for r in idle_sessions(df, ["k"], "t", "id", 5).collect()}
    want_fired, want_idle = {}, {}
    for key, rows in by_key(data).items():
        sessions = []
        for i, r in enumerate(rows):
            if i + 1 == len(rows) or rows[i + 1][2] - r[2] > 5:
                want_fired[r[0]] = r[2] + 5
            if not i or r[2] - rows[i - 1][2] > 5:
                sessions.append([])
            sessions[-1].append(r[2])
        for n, s in enumerate(sessions, 1):
            want_idle[(key, n)] = (s[0], s[-1] + 5, len(s))
    assert fired == want_fired
    assert idle == want_idle


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id INT, k STRING, t LONG, v LONG")
    assert throttle(empty, ["k"], "t", "id", 5).count() == 0
    assert ordered.row_numbers(empty, ["id"]).count() == 0


def test_chunk_count():
    assert ordered.chunk_count(0, 200) == 1
    assert ordered.chunk_count(100_000, 8) == 8
    assert ordered.chunk_count(10 ** 9, 2000) == 2000
    assert ordered.chunk_count(10 ** 12, 2000) == 250_000
