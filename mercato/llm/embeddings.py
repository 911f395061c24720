"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, multiprobe."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.graph import connected_components
from mercato.session import write_table

COSINE = 0.95
TABLES = 10
HASHES = 4
PROBES = 7
BLOCK = 1024
SEED = 20240


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (a power of two long), in place, scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        step *= 2
    return x.reshape(n, width) / np.sqrt(width)


def bucket_codes(vectors: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES,
                 seed: int = SEED) -> np.ndarray:
    """(n, tables, 1 + probes) bucket numbers of n unit vectors.

    A rotation is three rounds of random signs and a Hadamard transform; its hash is the signed
    axis nearest to the rotated vector. A bucket joins `hashes` of them. The probes are the other
    choices among the nearest axes that give up least: the squared distances lost add up.
    """
    n, dims = vectors.shape
    width = max(2, 1 << (dims - 1).bit_length())
    padded = np.zeros((n, width), np.float32)
    padded[:, :dims] = vectors
    near = min(width, 4)
    choices = np.array(np.meshgrid(*[np.arange(near)] * hashes, indexing="ij")).reshape(hashes, -1).T
    choices = choices[np.argsort(choices.sum(axis=1), kind="stable")]
    choices = choices[: max(1 + probes, min(len(choices), 4 * (1 + probes)))]
    out = np.empty((n, tables, min(1 + probes, len(choices))), np.int64)
    for t in range(tables):
        axes, losses = [], []
        for k in range(hashes):
            signs = np.random.default_rng((seed, t, k)).choice(np.float32([-1, 1]), (3, width))
            x = padded
            for s in signs:
                x = hadamard(x * s)
            size = np.abs(x)
            top = np.argpartition(-size, near - 1, axis=1)[:, :near] if near < width else np.argsort(-size, axis=1)
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
            best = np.take_along_axis(size, top, 1)
            axes.append(2 * top + (np.take_along_axis(x, top, 1) < 0))
            losses.append(best[:, :1] - best)
        loss = sum(losses[k][:, choices[:, k]] for k in range(hashes))
        code = np.zeros((n, len(choices)), np.int64)
        for k in range(hashes):
            code = code * (2 * width) + axes[k][:, choices[:, k]]
        order = np.argsort(loss, axis=1, kind="stable")[:, : out.shape[2]]
        out[:, t] = np.take_along_axis(code, order, 1) * tables + t
    return out


def unit_vector(x: np.ndarray) -> np.ndarray:
    """x in unit length, in double precision, without overflow or underflow in the norm."""
    x = x.astype(np.float64) / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _hash_vectors(batches, tables: int, hashes: int, probes: int, seed: int, kind: str):
    """(uid, vec_id, embedding) -> the usable vectors, as bytes of their own type, with their buckets."""
    for batch in batches:
        groups: dict[int, list[tuple]] = {}
        for uid, vec, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if values and None not in values:
                x = np.array(values, dtype=kind)
                if np.isfinite(x).all() and x.any():
                    groups.setdefault(len(x), []).append((uid, vec, x))
        for rows in groups.values():
            codes = bucket_codes(np.array([unit_vector(r[2].astype(np.float64)) for r in rows]), tables, hashes, probes, seed)
            codes = codes * np.int64(8191) + np.int64(len(rows[0][2]))  # vectors of other lengths: other buckets
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2].tobytes() for r in rows], pa.binary()),
                 pa.array(list(codes.reshape(len(rows), -1)), pa.list_(pa.int64()))],
                names=["uid", "vec_id", "vector", "codes"])


def _first_here(linked: np.ndarray, codes: list, code: int) -> np.ndarray:
    """Of the linked pairs of a bucket, those that share no smaller bucket: each pair counts once."""
    below = [c[c < code] for c in codes]
    owner = np.repeat(np.arange(len(below)), [len(c) for c in below])
    values, column, n = np.unique(np.concatenate(below), return_inverse=True, return_counts=True)
    shared = n > 1
    if not shared.any():
        return linked
    keep = shared[column]
    member = np.zeros((len(below), int(shared.sum())), np.float32)
    member[owner[keep], (np.cumsum(shared) - 1)[column[keep]]] = 1
    return linked & ~(member @ member.T > 0)


def _bucket_links(code, low, high, uid, vec, unit, codes, block, cosine):
    """(uid, vec_id, links, root) of one block pair of one bucket, for vectors that link there."""
    x = np.array(unit)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if low != high:  # pairs inside a block belong to that block's own group
        linked &= block[:, None] != block[None, :]
    if not linked.any():
        return None
    counts = _first_here(linked, codes, code).sum(axis=1)
    roots, before = vec.copy(), None
    while before is None or (roots != before).any():
        before = roots
        roots = np.minimum(roots, np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1))
    some = linked.any(axis=1)
    return uid[some], vec[some], counts[some], roots[some]


def _links(batches, cosine: float, kind: str):
    """Sorted rows of blocks -> links of each bucket's block pair; only one group is held."""
    kept: pa.Table | None = None
    def groups():
        nonlocal kept
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            if table.num_rows == 0:
                continue
            keys = np.column_stack([table.column(c).to_numpy() for c in ("code", "low", "high")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            kept = table.slice(last)
            if last:
                yield table.slice(0, last), keys[:last], np.concatenate(([0], cuts))
        if kept is not None and kept.num_rows:
            keys = np.column_stack([kept.column(c).to_numpy() for c in ("code", "low", "high")])
            yield kept, keys, np.array([0, kept.num_rows])

    for table, keys, cuts in groups():
        uid, vec, block = (table.column(c).to_numpy() for c in ("uid", "vec_id", "block"))
        vectors, codes = (table.column(c).combine_chunks() for c in ("vector", "codes"))
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a > 1:
                got = _bucket_links(*keys[a].tolist(), uid[a:b], vec[a:b],
                                    [unit_vector(np.frombuffer(x.as_buffer(), kind).astype(np.float64)) for x in vectors[a:b]],
                                    [x.values.to_numpy() for x in codes[a:b]], block[a:b], cosine)
                if got is not None:
                    out.append(got)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(4)],
                                             names=["uid", "vec_id", "links", "root"])


def near_vectors(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES,
                 probes: int = PROBES, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of vectors (vec_id, embedding).

    Vectors link when their cosine in double precision is at least cosine. Candidates share a
    bucket: the concatenated nearest axes after `hashes` random rotations (three rounds of signs
    and fast Hadamard transforms), in one of `tables` tables, at home or in one of the cheapest
    probes. Every candidate pair of a bucket is verified exactly, as a block of one matrix
    product; a pair counts in the smallest bucket that both have, and only counts and one edge per
    vector leave the task. Buckets of more than `block` vectors are split into pairs of blocks, so
    no task holds a whole hot bucket and nothing is capped. Components come from rounds of joins.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as
    do those with a null vec_id (component null, not kept); vectors of different lengths never
    link. Rows that repeat a vec_id are vectors of their own in n_links and one node in the
    components. Other columns are ignored. An empty table gives no rows.
    """
    rows, _ = write_table(vectors.select("vec_id", "embedding").withColumn(
        "uid", F.monotonically_increasing_id()), "vectors")
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    hashed, _ = write_table(rows.where("vec_id IS NOT NULL").select("uid", "vec_id", "embedding").mapInArrow(
        lambda it: _hash_vectors(it, tables, hashes, probes, seed, kind),
        "uid long, vec_id long, vector binary, codes array<long>"), "vector-codes")
    # ids and buckets first: a vector travels only to the buckets that it shares, with the names of these alone
    entries = hashed.select("uid", F.explode("codes").alias("code"))
    live = entries.groupBy("code").count().where("count > 1").select(
        "code", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    shared = entries.join(live, "code").groupBy("uid").agg(F.collect_list(F.struct("code", "blocks")).alias("shared"))
    order = ("code", "low", "high")
    dealt = (hashed.select("uid", "vec_id", "vector").join(shared, "uid")
             .select("uid", "vec_id", "vector", F.col("shared.code").alias("codes"), F.explode("shared").alias("bucket"))
             .withColumn("block", F.pmod(F.xxhash64("uid"), F.col("bucket.blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bucket.blocks") - 1))))
    found = (dealt.select(F.col("bucket.code").alias("code"), F.least("block", "other").cast("long").alias("low"),
                          F.greatest("block", "other").cast("long").alias("high"), "uid", "vec_id", "vector", "codes", "block")
             .repartition(*order).sortWithinPartitions(*order))
    links, _ = write_table(found.mapInArrow(lambda it: _links(it, cosine, kind),
                                               "uid long, vec_id long, links long, root long"), "vector-links")
    component = connected_components(links.select(F.col("root").alias("a"), F.col("vec_id").alias("b")))
    counts = links.groupBy("uid").agg(F.sum("links").alias("n_links"))
    return (rows.select("uid", "vec_id").join(counts, "uid", "left")
            .join(component.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"),
                    F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept")))
