import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.operators import changes, ordered
from tidepool.operators.records import sort_key

LOG = "key INT, seq LONG, op STRING, v INT"


def replay(base, log):
    state, errors = dict(base), []
    for key, seq, op, v in sorted(log, key=lambda c: c[1]):
        if op == "put":
            state[key] = v
        elif op == "remove":
            state.pop(key, None)
        elif key in state:
            errors.append((key, seq))
        else:
            state[key] = v
    return state, errors


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay(spark, seed, monkeypatch):
    monkeypatch.setattr(ordered, "MIN_ROWS", 25)
    monkeypatch.setattr(ordered, "MAX_KEY_ROWS", 20 if seed < 3 else 10 ** 6)
    rng = random.Random(seed)
    base = [(k, k * 10) for k in range(0, 30, 2)]
    log = [(0 if rng.random() < 0.35 else rng.randrange(30), s,
            rng.choice(["put", "add", "add", "remove"]), rng.randrange(1000)) for s in range(300)]
    state, errors = changes.apply_changes(spark.createDataFrame(base, "key INT, v INT"),
                                          spark.createDataFrame(log, LOG), ["v"])
    want_state, want_errors = replay(base, log)
    assert {r["key"]: r["v"] for r in state.collect()} == want_state
    assert rows(errors, "key", "seq") == sorted(want_errors, key=repr)


def test_null_payload_replaces(spark):
    base = spark.createDataFrame([(1, 5)], "key INT, v INT")
    log = spark.createDataFrame([(1, 1, "put", None)], LOG)
    state, _ = changes.apply_changes(base, log, ["v"])
    assert rows(state) == [(1, None)]


def test_net_changes(spark):
    log = spark.createDataFrame([
        (1, 1, "add", 1), (1, 2, "add", 2), (2, 1, "put", 1), (2, 2, "add", 2), (3, 1, "add", 1),
        (3, 2, "remove", None), (4, 1, "remove", None), (4, 2, "add", 7), (4, 3, "add", 8)], LOG)
    net = changes.net_changes(log, ["v"])
    assert rows(net, "key", "op", "v") == [(1, "add", 1), (2, "put", 1), (3, "remove", None),
                                           (4, "put", 7)]
    base = spark.createDataFrame([(1, 100)], "key INT, v INT")
    assert rows(changes.overlay(base, net, ["v"])) == [(1, 100), (2, 1), (4, 7)]
    assert rows(changes.settled(net, base), "key", "op") == [(2, "put"), (3, "remove"), (4, "put")]
    assert rows(changes.settled(net, base.filter("key > 1")), "key", "op")[0] == (1, "put")


def test_no_changes(spark):
    base = spark.createDataFrame([(1, 5)], "key INT, v INT")
    state, errors = changes.apply_changes(base, spark.createDataFrame([], LOG), ["v"])
    assert rows(state) == [(1, 5)] and errors.count() == 0


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "key INT, v INT")
    new = spark.createDataFrame([(2, 20), (3, 5), (4, 41), (5, 50)], "key INT, v INT")
    keys = [sort_key("v"), sort_key("key")]
    got = rows(changes.snapshot_diff(old, new, "key", keys, ["v"]))
    assert got == [(1, 0, -1), (3, 2, 0), (4, 3, 2), (5, -1, 3)]
    same = old.filter("key < 3")
    touched = same.withColumn("v", F.when(F.col("key") == 2, 21).otherwise(F.col("v")))
    assert rows(changes.snapshot_diff(same, touched, "key", keys, ["v"])) == []
    assert rows(changes.snapshot_diff(same, touched, "key", keys, ["v"], True)) == [(2, 1, 1)]
