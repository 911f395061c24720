import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from mercato.llm import queries, repeats

SCHEMA = "doc_id long, text string, starts string, kept int"


def brute(rows, length):
    """Every window of every text against all earlier ones."""
    texts = sorted(((d is None, d or 0, k, (t or "").encode()) for k, (d, t, *_) in enumerate(rows)))
    seen, out = set(), []
    for none, d, _, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if (w := t[i:i + length]) in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        runs = [i for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((None if none else d, len(t), sum(gone), len(runs), bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = ["alpha", "béta", "gamma", "δέλτα", "x", "epsilon", "zeta", "eta"]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "s", "7"]) for _ in range(n))

    passages = [prose(rng.choice([8, 30, 80])) for _ in range(6)]
    rows = []
    for k in range(docs):
        text = "".join(rng.choice([prose(rng.choice([3, 10, 40])), rng.choice(passages), rng.choice(passages)[rng.randrange(9):]])
                       for _ in range(rng.choice([1, 2, 4, 8])))
        rows.append((k * 7 % 101, text, None, k))
        if rng.random() < 0.3:  # copies, some with a changed byte
            at = rng.randrange(len(text) + 1)
            rows.append((200 + k, text[:at] + rng.choice(["", "Q", "zz"]) + text[at:], "s", None))
    rows += [(500, None, None, 0), (501, "", None, 0), (502, "a" * 400, None, 0), (503, "ab" * 300, None, 0), (504, "ab" * 99, None, 0),
             (None, passages[2] * 3, None, 0), (3, passages[2] + "!", None, 0), (505, "a" * 150, None, 0), (506, "\0" * 230 + "x", None, 0),
             (507, "\0" * 180, None, 0), rows[4], rows[4]]
    return rows


def removed(df):
    return sorted(((r.doc_id, r.n_bytes, sum(e - s for s, e in zip(r.starts, r.ends)), len(r.starts), bytes(r.kept)) for r in df.collect()),
                  key=str)


@pytest.mark.parametrize("seed, length, hot", [(1, 100, 100_000), (2, 100, 3), (3, 40, 100_000), (4, 50, 8)])
def test_same_as_brute_force(spark, monkeypatch, seed, length, hot):
    rows = corpus(seed)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 3000)
    monkeypatch.setattr(repeats, "CHUNK", 11)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)  # repeated ids: in the order of the rows
    got = removed(repeats.without_repeats(df, length, hot))
    assert got == brute(rows, length) and any(r[2] for r in got)


def test_many_files(spark, scratch):
    rows = [r for r in corpus(5) if r[0] not in (None, 3)]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, SCHEMA).repartition(7).write.parquet(f"{scratch}/docs")
    assert removed(repeats.without_repeats(spark.read.parquet(f"{scratch}/docs"))) == brute(rows, 100)


def test_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repeats.maximal_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_anchors_of_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 700, 790, 800, 800, 3100, 5000])
    whole = repeats.anchors(data, offsets, 100)
    monkeypatch.setattr(repeats, "PIECE", 333)
    pieces = repeats.anchors(data, offsets, 100)
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces))
    windows = sorted(i for p, a, b, *_ in zip(*whole) for i in range(a, b + 1))
    assert windows == [i for s, e in zip(offsets, offsets[1:]) for i in range(s, e - 99)]  # each window has one anchor


def test_maximal_repeats(spark):
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    long, short = noise(130), noise(104)
    texts = {1: noise(50) + long + noise(60), 2: long + noise(30) + short, 3: noise(5) + short + noise(200) + long, 4: noise(400),
             5: noise(20) + long[10:120] + noise(20)}
    df = spark.createDataFrame([(k, t, None, 0) for k, t in texts.items()], SCHEMA)
    found = {}
    for r in repeats.maximal_repeats(df).collect():
        assert r.start + r.length <= len(texts[r.doc_id])
        found.setdefault((r.repeat, r.length), set()).add((r.doc_id, r.start))
    strings = {}
    for (_, size), places in found.items():
        assert len(places) > 1 and len({texts[d][s:s + size] for d, s in places}) == 1
        d, s = min(places)
        strings[texts[d][s:s + size]] = places
    # all the occurrences of each, not just neighbours
    for string, places in strings.items():
        assert places == {(d, i) for d, t in texts.items() for i in range(len(t)) if t.startswith(string, i)}
    def covered(doc, string):  # longer than an anchor's reach: in overlapping parts
        at = texts[doc].index(string)
        parts = [(s, s + len(t)) for t, places in strings.items() for d, s in places if d == doc]
        return all(any(s <= i < e for s, e in parts) for i in range(at, at + len(string)))

    assert all(covered(d, long) for d in (1, 2, 3)) and all(covered(d, short) for d in (2, 3)) and covered(5, long[10:120])
    repeated = {(d, i) for d, t in texts.items() for i in range(len(t) - 99) if sum(u.count(t[i:i + 100]) for u in texts.values()) > 1}
    hot = repeats.maximal_repeats(df, hot=1).groupBy("repeat").count().collect()
    assert len(hot) == len({texts[d][i:i + 100] for d, i in repeated}) and sum(r["count"] for r in hot) == len(repeated)


def range_of_contexts(n, grams, seed=3):
    """One hash range's table: n contexts of random grams in 20 batches, a third of them copies of others."""
    rng = np.random.default_rng(seed)
    reach, rows = 69, rng.integers(97, 100, (n, 169)).astype(np.uint8)
    h = np.sort(rng.integers(1, 1 << 60, grams).astype(np.uint64)[rng.integers(0, grams, n)])
    again = rng.integers(0, n - 1, n // 3)
    rows[again + 1, :150] = rows[again, :150]
    left, low = np.full(n, reach, np.uint8), np.zeros(n, np.uint8)
    columns = [h, rows, left, np.full(n, 100, np.uint8), low, rng.integers(0, reach, n).astype(np.uint8), rng.permutation(n), np.arange(n) * 300]
    payloads = [repeats._dumped(*(x[k::20] for x in columns)) for k in range(20)]
    return rows.nbytes, pa.table({"key": [0] * 20, "batch": list(range(20)), "kind": pa.array([repeats.CONTEXTS] * 20, pa.int32()), "payload": payloads})


def spans_of(table):
    return sorted((b, *x) for b, p in zip(table.column("batch").to_pylist(), table.column("payload").to_pylist())
                  for x in zip(*(v.tolist() for v in repeats._loaded(p))))


@pytest.mark.parametrize("grams", [1, 7, 900])
def test_parts_of_a_range_lose_the_same(monkeypatch, grams):
    _, table = range_of_contexts(2000, grams)
    monkeypatch.setattr(repeats, "PART", 1 << 40)
    whole = spans_of(repeats._lose(100)(table))
    monkeypatch.setattr(repeats, "PART", 50)
    assert whole and spans_of(repeats._lose(100)(table)) == whole


def test_a_range_is_analysed_in_bounded_memory():
    size, table = range_of_contexts(60_000, 20_000)
    tracemalloc.start()
    repeats._lose(100)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * size


def test_ranges_hold_equal_shares_of_anchors():
    # an anchor's hash is the smallest of 69: by the hashes themselves the lowest range would hold 97 %
    data = np.random.default_rng(4).integers(97, 123, 300_000).astype(np.uint8)
    h = repeats.anchors(data, np.array([0, len(data)]))[4]
    for hashes in (h, np.unique(h >> repeats.COUNTED)):
        ranges = dict(repeats._by_range(hashes, 20))
        sizes = [len(k) for k in ranges.values()]
        assert len(sizes) == 20 and sum(sizes) == len(hashes) and max(sizes) < 1.5 * len(hashes) / 20
        assert all((np.diff(hashes[k].astype(np.float64)) >= 0).all() for k in ranges.values())
        assert all(set(hashes[k].tolist()).isdisjoint(hashes[ranges[0]].tolist()) for r, k in ranges.items() if r)


def test_interval_tree_of_a_known_array():
    # suffixes of one string at which "aXXX" occurs 3 times, "aXXXb" twice: lcp 4 and 5
    lost, found = repeats.interval_tree([0, 4, 5, 0], [2, 0, 1, 3], [-1, 7, 7, 7], 4)
    assert lost == [4, 0, 5, 0] and found == [(0, 2, 4)]
    lost, found = repeats.interval_tree([0, 5, 4], [2, 1, 0], [1, 2, 3], 4)
    assert lost == [5, 4, 0] and found == [(0, 1, 5), (0, 2, 4)]


def test_query_over_the_whole_table(spark):
    got = sorted(tuple(r) for r in queries.op12_repeated_strings(spark, "/root/testdata/sf0.001").collect())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got == sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, 100)) and any(r[2] for r in got)
