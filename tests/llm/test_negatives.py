import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score string"


def brute(rows, every=10, positives=5, k=10):
    usable = {}
    for vec, e, label, *_ in rows:
        if vec is None or label is None or not e or any(c is None or not math.isfinite(c) for c in e):
            continue
        x = [math.floor(256 * c) for c in e]
        usable[vec] = min(usable.get(vec, (label, x)), (label, x))
    out = []
    for a, (label, x) in usable.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), vec, kind) for vec, (kind, y) in usable.items() if vec != a and len(y) == len(x))
        for minus, pos, kind in [s for s in scored if s[2] == label][:positives]:
            p = -minus
            window = [(v, -m) for m, v, kind in scored if kind != label and 30 * p <= -100 * m <= 90 * p]
            out += [(a, pos, r + 1, v, p, s) for r, (v, s) in enumerate(window[:k])]
    return sorted(out)


def vectors(seed, n=160, dims=6, grid=None):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        e = [rng.gauss(0, 1) for _ in range(dims)]
        if grid:
            e = [round(c * grid) / grid for c in e]  # many ties
        rows.append((k, e, rng.randrange(4), None, "x"))
    rows += [(n + k, rows[10][1], k % 4, "r", None) for k in range(60)]  # a group of copies over all labels
    rows += [(900, None, 1, "", ""), (910, [], 1, "", ""), (920, [float("nan")] * dims, 1, "", ""), (930, [None] * dims, 1, "", ""),
             (940, rows[3][1], None, "", ""), (None, rows[3][1], 1, "", ""), (950, [1.0, 2.0], 1, "", ""), (951, [1.0, 1.0], 1, "", ""),
             (952, [0.5, 0.5], 2, "", ""), (960, [0.0] * dims, 1, "", ""), rows[20], (30, rows[30][1], 3, "", "")]
    return rows


@pytest.mark.parametrize("seed, grid, block", [(1, None, 8192), (2, 1, 8192), (3, 2, 3)])
def test_same_as_brute_force(spark, monkeypatch, seed, grid, block):
    rows = vectors(seed, grid=grid)
    rows = [r for r in rows if r[0] != 30] + [(30, rows[30][1], 0, "", "")]  # packed and plain order agree on one label
    monkeypatch.setattr(negatives, "ROWS_AT_ONCE", 37)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 5)
    monkeypatch.setattr(negatives, "PENDING", 100)
    got = negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0, block=block)
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 200


def test_empty_table(spark):
    assert negatives.mine_hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0


def test_scores_beyond_doubles_are_exact():
    x = np.array([[2.0 ** 30, 1.0], [-2.0 ** 30, 3.0]])
    a = np.array([[2.0 ** 22, 5.0], [2.0 ** 40, 0.0]])
    assert negatives.score_matrix(x, a).tolist() == [[2.0 ** 52 + 5, 2.0 ** 53], [-2.0 ** 52 + 15, -2.0 ** 53]]


def test_slots_are_disjoint_and_falling():
    upper, lower = negatives.slot_limits([[90, 45, 10], [7]], [4, 7])
    assert upper.tolist() == [[90, 45, 10], [7, -np.inf, -np.inf]]
    assert lower[0].tolist() == [45, 10, 3] and lower[1, 0] == 6
