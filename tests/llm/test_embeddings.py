import math

import numpy as np
import pytest

from mercato.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, code int"


def vectors(seed, n=120, dims=64):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        x = rng.normal(size=dims)
        for c in [1.0] + list(rng.choice([1.0, 0.99, 0.96, 0.952, 0.94, 0.9], rng.integers(0, 4))):
            z = rng.normal(size=dims)
            z -= (z @ x) / (x @ x) * x
            y = c * x / np.linalg.norm(x) + math.sqrt(1 - c * c) * z / np.linalg.norm(z)
            rows.append((y * rng.choice([0.5, 1, 30])).astype(np.float32).tolist())
    rng.shuffle(rows)
    return rows


def brute(rows, cosine=0.95):
    ok = [k for k, r in enumerate(rows) if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    links, low = [0] * len(rows), {r[0]: r[0] for r in rows}

    def root(d):
        while low[d] != d:
            d = low[d]
        return d

    for i in ok:
        for j in ok:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], np.float64), np.array(rows[j][1], np.float64)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    a, b = sorted((root(rows[i][0]), root(rows[j][0])))
                    low[b] = a
    return sorted(((r[0], n, None if r[0] is None else root(r[0])) for r, n in zip(rows, links)), key=str)


def result(df):
    got = df.collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("block", [1024, 7])
def test_same_as_brute_force(spark, block):
    vecs = vectors(3) + [vectors(4, 1)[0]] * 40  # a large group of equal vectors, split when blocks are small
    rows = [(1000 - k, v, k, "u", 0) for k, v in enumerate(vecs)]
    rows += [(2001, None, 0, "u", 0), (2002, [], 0, "u", 0), (2003, [0.0] * 64, 0, "u", 0), (2004, [float("nan")] * 64, 0, "u", 0),
             (2005, [None, 1.0], 0, "u", 0), (2006, [1.0, 2.0, 3.0], 0, "u", 0), (2007, [2.0, 4.0, 6.01], 0, "u", 0),
             (2008, [5.0], 0, "u", 0), (2009, [1.0], 0, "u", 0), (2010, [-1.0], 0, "u", 0), (None, vecs[0], 0, "u", 0),
             (1000, vecs[0], 0, "u", 0), (2011, [float("inf")] + [1.0] * 63, 0, "u", 0)]
    rows = [r[:1] + (None if r[1] is None else [None if x is None else float(np.float32(x)) for x in r[1]],) + r[2:] for r in rows]
    got = result(embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block))
    assert got == brute(rows)


def test_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    a, b = embeddings.bucket_codes(x), embeddings.bucket_codes(0.95 * x + math.sqrt(1 - 0.95**2) * z)
    assert np.mean([bool(np.isin(p, q).any()) for p, q in zip(a, b)]) >= 0.999
