"""Near duplicates by an n-gram Jaccard join with rare-first prefix filtering."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.graph import connected_components
from mercato.llm.words import batches_of, texts_of, word_codes
from mercato.session import write_table

WIDTH = 5
PERCENT = 75
RANGES_PER_PARTITION = 4
PIVOTS = 8
MERGED = 50  # rounds of stars go on while each joins a fiftieth of the components in question
MAX_ROWS = 30_000  # of a batch, so that row numbers and counts fit 16 bits

# ---------------------------------------------------------------- shingles


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of an Arrow array of large strings, from its bytes and a weight per position."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    words = words.cast(pa.large_string())
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    starts, lengths = ends[:-1] - ends[0], np.diff(ends)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    weights = mixed(np.arange(1, int(place.max(initial=0)) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros(len(words), np.uint64)
    if len(data):  # an empty word has no bytes to add up
        out[lengths > 0] = np.add.reduceat((data + np.uint64(1)) * weights[place], starts[lengths > 0])
    return mixed(out)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle as a whole."""
    words, codes, ends = word_codes(pc.ascii_lower(texts))
    hashes = word_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    odd = mixed(np.arange(11, 11 + width, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled += hashes[k:k + len(rolled)] * odd[k]
    rolled, out = mixed(rolled), []
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        n = end - start
        if n >= width:
            out.append(np.unique(rolled[start:end - width + 1]))
        else:
            out.append(mixed(np.array([(hashes[start:end] * odd[:n]).sum() + np.uint64(n)], np.uint64))[: min(n, 1)])
    return out


# ------------------------------------------------------------- packed lists


def _packed(ascending: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as byte planes of their gaps; the shuffle's compression does the rest."""
    return np.diff(ascending, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def _rows(names: dict, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(names.values())], names=list(names))


SENT = {"range": pa.int32(), "batch": pa.int64(), "kind": pa.int32(), "payload": pa.binary()}
RETURNED = {"batch": pa.int64(), "kind": pa.int32(), "payload": pa.binary()}
PROFILE = "doc_id long, n long, same_as long, alone long, shared array<long>, pivots array<long>"


def _send(batches, width: int, ranges: int):
    """(doc_id, text) batches -> per hash range the distinct shingles of the batch, plus its documents.

    A shingle that one document of the batch has is sent with that document's number, one that
    several have with their count: a frequent shingle is one entry per batch. Documents with
    equal sets are collapsed to the one with the smallest id first.
    """
    part, sequence = TaskContext.get().partitionId(), 0
    small = (b.slice(k, MAX_ROWS) for b in batches_of(batches) for k in range(0, b.num_rows, MAX_ROWS))
    for batch in small:
        name, sequence = (part << 32) | sequence, sequence + 1
        docs = batch.column(0).to_pylist()
        sets = shingle_sets(texts_of(batch.column(1)), width)
        same, first = [None] * len(docs), {}
        for k in sorted((k for k, d in enumerate(docs) if d is not None), key=docs.__getitem__):
            if len(sets[k]):
                same[k] = first.setdefault(xxhash.xxh3_128_digest(sets[k].tobytes()), k)
        own = [k for k, s in enumerate(same) if s == k]
        h = np.concatenate([sets[k] for k in own]) if own else np.zeros(0, np.uint64)
        who = np.repeat(np.array(own, np.uint16), [len(sets[k]) for k in own])
        order = np.argsort(h, kind="stable")
        h, who = h[order], who[order]
        starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(h)))
        single, distinct = counts == 1, h[starts]
        field = np.where(single, who[starts], counts).astype(np.uint16)
        several = np.repeat(~single, counts)
        info = (docs, [len(s) for s in sets], same, _packed(h[several]), who[several])
        rows = [(name % ranges, name, 1, pickle.dumps(info))]
        where = ((distinct >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(where, np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[r], cuts[r + 1]
            rows.append((r, name, 0, pickle.dumps((_packed(distinct[a:b]), field[a:b], np.packbits(single[a:b])))))
        yield _rows(SENT, rows)


def _count(table: pa.Table) -> pa.Table:
    """One hash range: shingles that several documents have go back to their batches with the count."""
    batches, kinds, payloads = (table.column(c).to_pylist() for c in ("batch", "kind", "payload"))
    rows = [(b, 1, p) for b, k, p in zip(batches, kinds, payloads) if k == 1]
    lists = [(b, pickle.loads(p)) for b, k, p in zip(batches, kinds, payloads) if k == 0]
    if lists:
        hs = [_unpacked(x[0]) for _, x in lists]
        fields = [x[1] for _, x in lists]
        singles = [np.unpackbits(x[2], count=len(x[1])).astype(bool) for _, x in lists]
        h = np.concatenate(hs)
        weight = np.concatenate([np.where(s, 1, f) for s, f in zip(singles, fields)]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        total = np.add.reduceat(weight[order], starts)
        df = np.empty(len(h), np.int64)
        df[order] = np.repeat(total, np.diff(np.append(starts, len(h))))
        at = 0
        for (name, _), own, field, single in zip(lists, hs, fields, singles):
            mine = df[at:at + len(own)]
            at += len(own)
            if (keep := mine > 1).any():
                rows.append((name, 2, pickle.dumps((_packed(own[keep]), mine[keep].astype(np.uint32), field[keep],
                                                    np.packbits(single[keep])))))
    return pa.Table.from_batches([_rows(RETURNED, rows)])


def prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _profiles(percent: int):
    def profiles(table: pa.Table) -> pa.Table:
        """One batch: each document's shared shingles, rarest first, where its prefix reaches them."""
        hs, dfs, fields, singles, info = [], [], [], [], None
        for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()):
            x = pickle.loads(payload)
            if kind == 1:
                info = x
            else:
                hs.append(_unpacked(x[0]))
                dfs.append(x[1])
                fields.append(x[2])
                singles.append(np.unpackbits(x[3], count=len(x[2])).astype(bool))
        docs, sizes, same, repeated, who = info
        none = [np.zeros(0, np.uint64)]
        h, df = np.concatenate(hs or none), np.concatenate(dfs or none).astype(np.int64)
        field = np.concatenate(fields or none).astype(np.int64)
        single = np.concatenate(singles or none).astype(bool)
        several = np.argsort(h[~single])
        key, key_df = h[~single][several], df[~single][several]
        repeated = _unpacked(repeated)
        again = key_df[np.searchsorted(key, repeated)] if len(repeated) else np.zeros(0, np.int64)
        h, df = np.concatenate((h[single], repeated)), np.concatenate((df[single], again))
        who = np.concatenate((field[single], who.astype(np.int64)))
        order = np.lexsort((h, df, who))
        h, who = h[order], who[order]
        cuts = np.searchsorted(who, np.arange(len(docs) + 1))
        rows = []
        for k, doc in enumerate(docs):
            n, shared = sizes[k], h[cuts[k]:cuts[k + 1]]
            alone, mine, pivots = n - len(shared), None, None
            if doc is not None and same[k] == k and n and alone < prefix_length(n, percent):
                mine = shared.view(np.int64)
                pivots = np.bincount((shared >> np.uint64(61)).astype(np.int64), minlength=PIVOTS)
            rows.append((doc, n, None if same[k] is None else docs[same[k]], alone, mine, pivots))
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                        names=[x.split()[0] for x in PROFILE.split(", ")])
    return profiles


# ------------------------------------------------------------------- join


def shingle_profiles(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: set size, document with an equal set in its batch, shingles of its
    own, and (where a link is possible at all) the shared shingles, rarest first.

    Two shuffles of packed lists: the batches' distinct shingles go to hash ranges to be counted
    over all documents, and only those that several documents have come back.
    """
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select("doc_id", "text").mapInArrow(
        lambda it: _send(it, width, ranges), "range int, batch long, kind int, payload binary")
    returned = sent.groupBy("range").applyInArrow(_count, "batch long, kind int, payload binary")
    return returned.groupBy("batch").applyInArrow(_profiles(percent), PROFILE)


def _close(percent: int):
    """Length and positional filter of a pair (x, y) with a shingle in common at their positions."""
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    long, short = F.greatest("x.n", "y.n"), F.least("x.n", "y.n")
    return (100 * short >= percent * long), need


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; the suffix filter goes before the exact count."""
    sets = sets.select("doc_id", "n", "shared", "pivots")
    x = sets.select(*[F.col(c).alias(f"{c}_a") for c in sets.columns])
    y = sets.select(*[F.col(c).alias(f"{c}_b") for c in sets.columns])
    joined = pairs.join(x, F.col("a") == F.col("doc_id_a")).join(y, F.col("b") == F.col("doc_id_b"))
    size = F.col("n_a") + F.col("n_b")
    most = F.aggregate(F.zip_with("pivots_a", "pivots_b", lambda p, q: F.least(p, q)), F.lit(0).cast("long"), lambda s, v: s + v)
    both = F.when((100 + percent) * most >= percent * size, F.size(F.array_intersect("shared_a", "shared_b")))
    return joined.where((100 + percent) * both >= percent * size).select("a", "b").distinct()


def _star_pairs(entries: DataFrame, centre: DataFrame, percent: int) -> DataFrame:
    """Pairs of each entry with the centre of its shingle, as far as length and position allow."""
    near, need = _close(percent)
    # both documents may have common shingles before this one, at most as many as precede it
    left = (F.least("x.pos", "y.pos") + 1
            + F.least(F.col("x.n") - F.col("x.pos") - 1, F.col("y.n") - F.col("y.pos") - 1))
    return (entries.alias("x").join(centre.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.label") != F.col("y.label"))
                                    & near & (left >= need))
            .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct())


def _open(labelled: DataFrame) -> DataFrame:
    """The entries of shingles found under several labels, with the most frequent label of each."""
    share = labelled.groupBy("h", "label").agg(F.count(F.lit(1)).alias("m"))
    several = share.groupBy("h").agg(F.max_by("label", "m").alias("most"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    return write_table(labelled.select("h", "doc_id", "n", "pos", "label").join(several.select("h", "most"), "h"), "shingle-open")[0]


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs.

    Documents link when the Jaccard similarity of their sets of width-word shingles is percent/100
    or more. Shingles are ordered rarest first by their count over all documents, and only those
    in a document's prefix can give a pair. As shingles of one document alone come first, most
    prefixes hold nothing that another document has.

    The join on prefix shingles runs in rounds. In the first ones each document is paired with one
    document, the centre, of each shingle: the smallest one, then others, drawn by hash among the
    documents left in different components, as long as a round joins many of these. That is linear in a
    group of copies. The last round pairs all documents that are still in different components, and
    verifies each pair once. So a large group of copies isn't expanded, and no link between
    components is lost. Length and positional filters cut pairs in the join, a suffix filter (counts
    between fixed pivots of the hash order) before the exact intersection.

    Null and empty texts have no shingles and link with nothing, nor do rows with a null doc_id
    (component null). Texts of any length are read whole; a longer one makes a batch of its own.
    Rows that repeat a doc_id are one document with several texts. Other columns are ignored. An empty table gives no rows. docs should be read from files: a lost task must
    read the same rows in the same order again.
    """
    profiles, _ = write_table(shingle_profiles(docs, width, percent), "shingle-profiles")
    length = F.expr(f"n - cast(ceil({percent} * n / 100) as bigint) + 1 - alone").cast("int")
    sets = profiles.where("shared IS NOT NULL")
    entries = sets.select("doc_id", "n", "alone", F.posexplode(F.slice("shared", 1, length)).alias("k", "h")).select(
        "h", "doc_id", "n", (F.col("alone") + F.col("k")).alias("pos"))
    entries, _ = write_table(entries, "shingle-prefixes")
    near, need = _close(percent)
    centre = entries.groupBy("h").agg(F.min(F.struct("doc_id", "n", "pos")).alias("c"), F.count(F.lit(1)).alias("m"))
    centre = centre.where("m > 1").select("h", "c.*")
    stars = _star_pairs(entries.withColumn("label", F.col("doc_id")), centre.withColumn("label", F.col("doc_id")), percent)
    links = (_verified(stars, profiles, percent)
             .unionByName(profiles.where("same_as <> doc_id").select(F.col("same_as").alias("a"), F.col("doc_id").alias("b"))))
    links, _ = write_table(links, "shingle-links")
    found, _ = write_table(connected_components(links), "shingle-components")

    label = found.select(F.col("node").alias("doc_id"), F.col("component").alias("label"))
    open_entries = _open(entries.join(label, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id")))
    in_question, _ = write_table(open_entries.select("doc_id").distinct(), "shingle-question")
    open_sets, _ = write_table(sets.join(in_question, "doc_id", "left_semi"), "shingle-open-sets")
    edges, merged, turn = found.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")), 1, 0
    while merged:
        turn += 1
        centre = open_entries.groupBy("h").agg(F.min_by(F.struct("doc_id", "n", "pos", "label"), F.xxhash64("h", "doc_id", F.lit(turn))).alias("c"))
        stars = _star_pairs(open_entries, centre.select("h", "c.*"), percent)
        new, _ = write_table(_verified(stars, open_sets, percent), "shingle-links")
        edges = edges.unionByName(new)
        of = open_entries.select("doc_id", "label").distinct()
        labels = new.join(of.select(F.col("doc_id").alias("a"), F.col("label").alias("u")), "a").join(
            of.select(F.col("doc_id").alias("b"), F.col("label").alias("v")), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
        joined, _ = write_table(connected_components(labels), "shingle-merged")
        count = open_entries.agg(F.count_distinct("label")).first()[0]
        merged = joined.where("node <> component").count() * MERGED >= max(1, count)
        renamed = open_entries.join(joined.withColumnRenamed("node", "label"), "label", "left").withColumn(
            "label", F.coalesce("component", "label"))
        open_entries = _open(renamed)
    # Of each shingle, one side of a pair at least is not of the most frequent label, so that a group of copies is
    # not compared with itself. The positional filter is right at the first shingle of a pair and
    # stricter after it; it is part of the join, whose output stays small.
    rest = 1 + F.least(F.col("x.n") - F.col("x.pos") - 1, F.col("y.n") - F.col("y.pos") - 1)
    pairs = (open_entries.where("label <> most").alias("x")
             .join(open_entries.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.label") != F.col("y.label")) & near & (rest >= need))
             .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct())
    more, _ = write_table(_verified(pairs, open_sets, percent), "shingle-more")
    found = connected_components(edges.unionByName(more))
    return (profiles.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))
