import math

import numpy as np
import pytest

from mercato.llm import queries, whitening
from mercato.llm.vectors import pack, unpack

SCHEMA = "vec_id long, embedding array<float>, label int, n string, x string"


def expected(rows, components=4):
    """Plain version for vectors of one length: numpy's eigh over the distinct whole vectors."""
    usable = [(r[0], [math.floor(256 * c) for c in r[1]]) for r in rows
              if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    fit = np.array(sorted({tuple(x) for _, x in usable}), dtype=float)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for vec, x in usable:
        w = (np.array(x) - fit.mean(axis=0)) @ vectors / np.sqrt(values)
        for k in range(len(values)):
            out.setdefault((vec, k + 1), []).append(
                (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), abs(w[k]), values[k] / np.trace(centred.T @ centred / n)))
    return out


def check(spark, rows):
    got = whitening.whiten_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    want = expected(rows)
    assert len(got) == sum(map(len, want.values()))
    signs = {}
    for r in got:
        n, deviation, size, share = want[r.vec_id, r.component][0]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(size, rel=1e-7, abs=1e-7) and r.explained == pytest.approx(share, rel=1e-9)
        assert r.identity_error < 1e-8
        signs.setdefault(r.component, {})[r.vec_id] = r.whitened
    return signs


def test_same_as_eigh(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 0.5
    rows = [(k, [float(c) for c in v], 0, None, "x") for k, v in enumerate(data)]
    rows += [(1000 + k, rows[5][1], 1, "a", None) for k in range(150)]  # copies count once in the fit
    rows += [(2000, None, 0, "", ""), (2001, [], 0, "", ""), (2002, [float("nan")] * 12, 0, "", ""),
             (2003, [None] + [1.0] * 11, None, "", ""), (2004, [float("inf")] + [1.0] * 11, 0, "", ""), (7, rows[7][1], 0, "", "")]
    signs = check(spark, rows)
    # one sign for all rows: the whitened columns themselves have unit variance over the fit
    assert all(len(set(round(v, 9) for v in s.values())) > 100 for s in signs.values())


@pytest.mark.parametrize("matrix", [np.diag([5.0, 5.0, 5.0, 1.0, 0.0]), np.ones((6, 6)), np.eye(3) * 1e-200, np.zeros((4, 4)),
                                    np.diag([3.0, 3.0 - 1e-13, 3.0 - 2e-13, 1e-3]), np.array([[2.0]]), np.zeros((0, 0)),
                                    np.kron(np.eye(4), np.array([[2.0, 1.0], [1.0, 2.0]]))])
def test_leading_eigenvectors_of_clusters(matrix):
    values, vectors = whitening.leading_eigenvectors(matrix, 4)
    true = np.linalg.eigvalsh(matrix)[::-1][:4] if len(matrix) else np.zeros(0)
    true = true[true > 1e-12 * max(true.max(initial=0), 0)] if true.max(initial=0) > 0 else np.zeros(0)
    assert values == pytest.approx(true, rel=1e-12)
    scale = np.abs(matrix).max(initial=0) or 1
    assert np.abs(matrix / scale @ vectors - vectors * (values / scale)).max(initial=0) < 1e-13 * max(1, len(matrix))
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13


def test_random_spectra():
    rng = np.random.default_rng(5)
    for n in (2, 5, 33, 64):
        a = rng.normal(size=(n, n))
        a = a @ a.T
        values, vectors = whitening.leading_eigenvectors(a, 4)
        assert values == pytest.approx(np.linalg.eigvalsh(a)[::-1][:4], rel=1e-12)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * values[0]


def test_lengths_equal_vectors_and_empty_tables(spark):
    two = [(1, [0.5, 1.0], 0, "", ""), (2, [0.25, 3.0], 0, "", ""), (3, [1.5, 2.0], 0, "", "")]
    three = [(k + 10, [k / 7, (k * k) % 5 / 3, -k / 2], 0, "", "") for k in range(9)]
    same = [(k + 30, [1.0, 2.0, 3.0, 4.0], 0, "", "") for k in range(3)]  # no variance: no components
    got = whitening.whiten_embeddings(spark.createDataFrame(two + three + same, SCHEMA)).collect()
    sizes = {(r.vec_id >= 10, r.component): r.n for r in got}
    assert sizes == {(False, 1): 3, (False, 2): 3, (True, 1): 9, (True, 2): 9, (True, 3): 9}
    assert whitening.whiten_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_entries_are_exact(spark):
    rows = [(1, [1e9, 2.0], 0, "", ""), (2, [-3e9, 5.5], 0, "", ""), (3, [2.5e9, -7.0], 0, "", "")]
    whole = [[math.floor(256 * c) for c in np.float32(r[1]).tolist()] for r in rows]
    sums = [sum(c) for c in zip(*whole)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {r[0]: sum((3 * a - s) ** 2 for a, s in zip(x, sums)) for r, x in zip(rows, whole)}


def test_pack_round_trip():
    x = np.array([[1.0, -5], [40000, 1], [2.0 ** 60, -1], [0, 0]])
    assert np.array_equal(unpack(pack(x), 2), x) and [len(p) for p in pack(x)] == [4, 8, 16, 4]


def test_query_over_the_whole_table(spark):
    got = queries.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    want = expected(rows)
    assert {(r.vec_id, r.component) for r in got} == set(want)
    assert all((r.n, r.deviation) == want[r.vec_id, r.component][0][:2] for r in got)
    assert all(abs(r.whitened) == pytest.approx(want[r.vec_id, r.component][0][2], abs=1e-7) for r in got)
