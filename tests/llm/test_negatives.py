"""op11: hard negatives against a full search, and the index by itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm.hard_negatives import (
    Cells, MiningSettings, _scores, learned_codebook, mine_hard_negatives,
)

ROWS = "vec_id long, embedding array<double>, label int, score long, block string"


def brute(rows, every):
    seen = {(i, tuple(v), label) for i, v, label in rows if i is not None and v is not None
            and label is not None and all(x is not None and np.isfinite(x) for x in v)}
    held = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in seen]
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1]))
    out = []
    for a in (r for r in held if r[0] % every == 0):
        others = sorted(((score(a, b), b) for b in held if b[0] != a[0]), key=lambda x: (-x[0], x[1][0]))
        for p, pos in [x for x in others if x[1][2] == a[2]][:5]:
            fits = [x for x in others if x[1][2] != a[2] and 80 * p <= 100 * x[0] <= 100 * p][:5]
            out += [(a[0], pos[0], k + 1, neg[0], p, n) for k, (n, neg) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, every, settings=None):
    table = spark.createDataFrame([(i, v, label, 5, "x") for i, v, label in rows], ROWS)
    got = mine_hard_negatives(table, F.col("vec_id") % every == 0, None, settings)
    return sorted(tuple(r) for r in got.collect())


def clustered(seed, n, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    of = rng.integers(0, 5, n)
    of[: n // 3] = 0  # a third of all rows round one centre
    v = centres[of] + 0.2 * rng.normal(size=(n, width))
    v[: n // 6] = v[0]  # and half of those are equal
    return [(int(i), v[i].tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("settings", [
    MiningSettings(), MiningSettings(least_block=40, most_block=40, anchors=3, rows_per_cell=2, batch=4)])
def test_against_a_full_search(spark, settings):
    rows = clustered(1, 300)
    found = mined(spark, rows, 20, settings)
    assert found == brute(rows, 20) and len(found) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(2, 80, 4) + [
        (0, [1.0, 2.0, 3.0, 4.0], 1), (20, None, 1), (40, [1.0, None, 1.0, 1.0], 1),
        (60, [1.0, nan, 1.0, 1.0], 1), (100, [1.0, inf, 1.0, 1.0], 1), (120, [1.0] * 4, None),
        (None, [1.0] * 4, 1), (140, [0.0] * 4, 1), (160, [], 2), (180, [1.0, 0.5], 2),
        (7, [1.0] * 4, 2), (7, [1.0] * 4, 2), (200, [-1e-3] * 4, 0)]
    found = mined(spark, rows, 20)
    assert found == brute(rows, 20) and found
    assert mined(spark, [], 20) == []
    assert mined(spark, [(0, [1.0], 1)], 20) == []
    assert mined(spark, [(20, None, 1)], 20) == []


def test_scores_beyond_floating_point_are_exact():
    rows = np.array([[2.0 ** 30, 3.0], [2.0 ** 30, 4.0]])
    anchor = np.array([2.0 ** 32, 1.0])
    assert _scores(rows, anchor, 2.0 ** 30).tolist() == [2 ** 62 + 3, 2 ** 62 + 4]
    with pytest.raises(OverflowError):
        _scores(rows, np.array([2.0 ** 34, 1.0]), 2.0 ** 30)


def test_bounds_hold_and_fall_and_spare_cells():
    rng = np.random.default_rng(4)
    centres = 100 * rng.normal(size=(8, 6))
    x = np.floor(centres[rng.integers(0, 8, 2000)] + 3 * rng.normal(size=(2000, 6)))
    cells = Cells(x, (learned_codebook(x[:500, :3], 8, 8), learned_codebook(x[:500, 3:], 8, 8)))
    for anchor in x[:5]:
        left, last, met = np.ones(2000, bool), np.inf, 0
        best = np.sort(x @ anchor)[-5]
        for rows, bound in cells.visits(anchor, 50):
            met += len(rows) if last >= best else 0
            assert (x[rows] @ anchor).max(initial=-np.inf) <= last
            left[rows] = False
            assert not left.any() or (x[left] @ anchor).max() <= bound
            assert bound <= last
            last = bound
        assert not left.any() and met < 1200
