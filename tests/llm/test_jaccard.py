import random
import re

import numpy as np
import pyarrow as pa
import pytest

from mercato.llm import jaccard, words
from mercato.llm.graph import connected_components

SCHEMA = "doc_id long, text string, n int, label string"


def brute(rows):
    sets = {}
    for doc, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        got = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        sets.setdefault(doc, []).append(got)
    low = {d: d for d in sets}

    def root(d):
        while low[d] != d:
            d = low[d]
        return d

    ids = [d for d in sets if d is not None]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = sorted((root(a), root(b)))
                low[rb] = ra
    return sorted((str(doc), str(root(doc)) if doc is not None else "None") for doc, *_ in rows)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts = []
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 6, 12, 40, 90, 200]))]
        texts.append(" ".join(own))
        for _ in range(rng.choice([0, 0, 1, 3, 8])):  # near copies, some above and some below the threshold
            copy = list(own)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words).upper()
            texts.append("  ".join(copy))
        if rng.random() < 0.4:
            texts.append(passage + " " + " ".join(rng.choice(words) for _ in range(rng.choice([0, 5, 12, 60]))))
    rng.shuffle(texts)
    rows = [(k * 3 + 1, t, k, "x") for k, t in enumerate(texts)]
    return rows + [(2, None, 0, "x"), (5, "", 0, "x"), (8, " \t\n", 0, "x"), (None, texts[0], 0, None), (1, texts[5], 0, "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed, scratch):
    rows = corpus(seed)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{scratch}/docs")
    got = jaccard.jaccard_components(spark.read.parquet(f"{scratch}/docs")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == brute(rows)


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(39, 130), (500, 500), (600, 601)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 1 for k in [*range(1, 40), *range(100, 161)]) and got[601] == 600 and 500 not in got


def test_sets_of_a_cut_batch():
    texts = [r[1] for r in corpus(3)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = jaccard.shingle_sets(words.texts_of(batch.column(0)), 5)
    for start in (1, 7, 50):
        cut = jaccard.shingle_sets(words.texts_of(batch.slice(start, 20).column(0)), 5)
        assert all(np.array_equal(a, b) for a, b in zip(whole[start:start + 20], cut)) and len(cut) == 20


def test_cut_batches_and_files(spark, scratch, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(jaccard, "MAX_ROWS", 7)  # many batches, most of them cut
    for files in (1, 32):
        spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(f"{scratch}/docs{files}")
        got = jaccard.jaccard_components(spark.read.parquet(f"{scratch}/docs{files}")).collect()
        assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == brute(rows)
