"""Hard-negative mining: scores split into slots by the positives' upper limits, merged downwards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.vectors import PACKED, SCALE, packed_rows, unpack
from mercato.session import write_table

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90        # percent of the positive's score
ANCHORS = 8192            # anchors of one pass over the vectors; their vectors are sent to every task
ANCHORS_AT_ONCE = 512     # anchors and rows of one score matrix
ROWS_AT_ONCE = 4096
PENDING = 1_000_000       # entries a task holds before it cuts them to the best of each slot
LARGEST = 2.0 ** 53       # scores beyond it count as it


def score_matrix(x: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors), exact: as doubles while these hold every partial sum, else as whole numbers."""
    if np.abs(x).max(initial=0) * np.abs(anchors).max(initial=0) * x.shape[1] < LARGEST:
        return x @ anchors.T
    whole = [[int(v) for v in row] for row in x.tolist()]
    others = [[int(v) for v in row] for row in anchors.tolist()]
    return np.array([[float(max(-LARGEST, min(LARGEST, sum(a * b for a, b in zip(r, o))))) for o in others] for r in whole])


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int):
    """(column, score, id) of the k first allowed rows of each column: highest score, then smallest id."""
    masked = np.where(allowed, scores, -np.inf)
    last = np.partition(masked, len(ids) - k, axis=0)[len(ids) - k] if len(ids) > k else -np.inf
    rows, columns = np.nonzero((masked >= last) & allowed)
    return cut(columns, masked[rows, columns], ids[rows], k)


def cut(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int):
    """The first k entries of each group."""
    order = np.lexsort((ids, -scores, groups))
    groups, scores, ids = groups[order], scores[order], ids[order]
    keep = np.ones(len(groups), bool)
    keep[k:] = groups[k:] != groups[:-k]
    return groups[keep], scores[keep], ids[keep]


def slot_limits(limits: list[list[int]], floors: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(upper, lower) of each anchor's slots, falling and disjoint: a slot holds lower < score <= upper.

    limits are an anchor's distinct upper limits, falling; floors its smallest lower limit, below
    which no window reaches. An anchor with fewer limits has empty slots at the end.
    """
    width = max(map(len, limits), default=0)
    upper = np.full((len(limits), width), -np.inf)
    lower = np.full((len(limits), width), np.inf)
    for k, (own, floor) in enumerate(zip(limits, floors)):
        upper[k, :len(own)] = own
        lower[k, :len(own)] = [*own[1:], floor - 1]
        lower[k, :len(own)] = np.maximum(lower[k, :len(own)], floor - 1)
    return upper, lower


def _scored(anchors: list, negatives: int, positives: int):
    """Task function: the best rows of each slot (or, without slots, of the anchor's label) for a block of anchors."""
    groups: dict[int, list] = {}
    for a in anchors:
        groups.setdefault(a.dims, []).append(a)

    def task(batches):
        blocks = []
        for dims, members in groups.items():
            for s in range(0, len(members), ANCHORS_AT_ONCE):
                part = members[s:s + ANCHORS_AT_ONCE]
                x = unpack([bytes(a.x) for a in part], dims)
                slots = slot_limits([list(a.limits) for a in part], [a.floor for a in part]) if negatives else None
                blocks.append((dims, np.array([a.vec_id for a in part]), np.array([a.label for a in part]), x, slots))
        k = negatives or positives
        held: dict[tuple[int, int], list] = {}
        pending = 0

        def shorten():
            for key, parts in held.items():
                held[key] = [cut(*(np.concatenate([p[i] for p in parts]) for i in range(3)), k)]
            return sum(len(parts[0][0]) for parts in held.values())

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids, labels, dims = (np.asarray(part.column(c)) for c in ("vec_id", "label", "dims"))
                packed = part.column("x").to_pylist()
                for length in np.unique(dims).tolist():
                    if length not in groups:
                        continue
                    rows = np.flatnonzero(dims == length)
                    x = unpack([packed[r] for r in rows.tolist()], length)
                    for b, (own, names, kinds, vectors, slots) in enumerate(blocks):
                        if own != length:
                            continue
                        scores = score_matrix(x, vectors)
                        same = labels[rows][:, None] == kinds[None, :]
                        if slots is None:
                            allowed = [same & (ids[rows][:, None] != names[None, :])]
                        else:
                            upper, lower = slots
                            allowed = [~same & (scores <= upper[:, j]) & (scores > lower[:, j]) for j in range(upper.shape[1])]
                        for j, a in enumerate(allowed):
                            got = best(scores, ids[rows], a, k)
                            held.setdefault((b, j), []).append(got)
                            pending += len(got[0])
                        if pending > PENDING:
                            pending = shorten()
        if held:
            shorten()
        for (b, j), parts in held.items():
            columns, scores, found = parts[0]
            if len(columns):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[b][1][columns]), pa.array(np.full(len(columns), j), pa.int32()),
                     pa.array(scores.astype(np.int64)), pa.array(found)], names=["anchor_id", "slot", "score", "vec_id"])
    return task


FOUND = "anchor_id long, slot int, score long, vec_id long"


def _passes(vectors: DataFrame, anchors: DataFrame, block: int, name: str, positives: int = 0, negatives: int = 0) -> DataFrame:
    """Best entries of every anchor and slot in every task, one pass over the vectors per block of anchors."""
    n = anchors.count()
    blocks = max(1, -(-n // block))
    ranked = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        members = ranked.where(F.col("block") == b).collect()  # about `block` anchors
        part, _ = write_table(vectors.mapInArrow(_scored(members, negatives, positives), FOUND), name)
        found = part if found is None else found.unionByName(part)
    return found


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                        low: int = LOW, high: int = HIGH, scale: int = SCALE, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, embedding).

    Components become floor(scale * component); a score is the whole-number inner product with the
    anchor, higher first, ties by smaller vec_id. An anchor's positives are its first `positives`
    other rows of its label. A positive's negatives are the first `negatives` rows of other labels with
    low * positive_score <= 100 * score <= high * positive_score.

    The windows of an anchor's positives overlap. Their upper limits cut the scores into disjoint slots;
    every task keeps the first `negatives` rows of each slot, and a window is answered by merging
    the slots from its own limit downwards and dropping what is below its lower limit. Anchors
    are taken in blocks of about `block`, each sent to all tasks in one pass over the vectors, so neither
    rows nor scores are shuffled: only each task's best entries, cut again before their shuffle.

    No part take rows whose vec_id, label or vector is null, or whose vector is empty or has a null or
    non-finite component. Vectors of different lengths have no score. Of rows that repeat a vec_id
    one counts, that with the smallest label, then the smallest packed vector. A positive with a
    negative score has no negatives (its window is empty); positives without negatives give no
    rows. Scores beyond 2^53 count as 2^53. Other columns are ignored. An empty table gives no rows.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    usable = source.where("vec_id IS NOT NULL AND label IS NOT NULL").mapInArrow(lambda it: packed_rows(it, scale), PACKED)
    one = usable.groupBy("vec_id").agg(F.min(F.struct("label", "dims", "x")).alias("v")).select("vec_id", "v.*")
    rows, _ = write_table(one, "mine-vectors")
    anchors = rows.where(is_anchor)

    nearest = _passes(rows, anchors, block, "mine-positives", positives=positives)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = nearest.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    chosen, _ = write_table(chosen.where("score >= 0").select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.expr(f"score * {int(high)} div 100").alias("upper"), F.expr(f"(score * {int(low)} + 99) div 100").alias("lower")),
        "mine-chosen")

    limits = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("floor"))
    scored = _passes(rows, anchors.join(limits, "vec_id"), block, "mine-negatives", negatives=negatives)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    kept = scored.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= negatives)
    slots = kept.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        "slot", (-F.col("score")).alias("falling"), "vec_id"))).alias("entries"))  # slots x negatives at most

    slot = F.expr("array_position(limits, upper) - 1").alias("slot")
    windows = chosen.join(limits.withColumnRenamed("vec_id", "anchor_id"), "anchor_id").select(
        "anchor_id", "positive_id", "positive_score", "lower", slot)
    merged = windows.join(slots, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score",
        F.filter(F.slice(F.filter("entries", lambda e: e["slot"] >= F.col("slot")), 1, int(negatives)),
                 lambda e: -e["falling"] >= F.col("lower")).alias("entries"))
    return merged.select("anchor_id", "positive_id", "positive_score", F.posexplode("entries").alias("k", "e")).select(
        "anchor_id", "positive_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("negative_id"),
        "positive_score", (-F.col("e.falling")).alias("negative_score"))
