"""Line dedup: range-partitioned hashes, streamed first occurrences, keep bitmaps."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.words import batches_of
from mercato.session import cut_lineage, write_table

WHITE = " \t\n\v\f\r"
MIN_CHARS = 10
BATCH_BYTES = 1 << 20  # of documents whose lines are hashed at a time: a line's tuple takes several times its bytes
LAST = (1 << 63) - 1  # stands for a null doc_id: it comes after all others


def _key(text: str) -> tuple[int, bytes]:
    """(code points, bytes) of a line's key: stripped, A-Z lower-cased."""
    stripped = text.strip(WHITE)
    return len(stripped), stripped.encode("utf-8", "surrogatepass").lower()


def _hash_lines(batches, min_chars: int):
    """Document batches -> (hi, lo, doc, version, pos) of every line that is long enough."""
    for batch in batches_of(batches, BATCH_BYTES):
        out: list[tuple] = []
        docs, texts, versions = (batch.column(i).to_pylist() for i in range(3))
        for doc, text, version in zip(docs, texts, versions):
            for pos, line in enumerate((text or "").split("\n")):
                chars, key = _key(line)
                if chars >= min_chars:
                    out.append((xxhash.xxh3_128_digest(key), doc, version, pos))
        digests = np.frombuffer(b"".join(x[0] for x in out), dtype=">i8").reshape(-1, 2).astype(np.int64)
        columns = [pa.array(digests[:, 0]), pa.array(digests[:, 1])]
        columns += [pa.array([x[i] for x in out], t) for i, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["hi", "lo", "doc", "version", "pos"])


def _later_lines(batches, first_docs: dict):
    """Sorted lines -> (doc, version, pos) of those whose document is not their hash's first.

    State: the hash at hand and its first document. first_docs has the first document of each hash
    that a partition starts with, as its lines may have begun in an earlier partition.
    """
    hash_now, doc_now = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        hi, lo, doc = (batch.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(np.concatenate(
            ([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
        firsts = doc[starts].copy()
        head = (int(hi[0]), int(lo[0]))
        if head == hash_now:
            firsts[0] = doc_now
        elif head in first_docs:
            firsts[0] = first_docs[head]
        owner = np.repeat(firsts, np.diff(np.concatenate((starts, [len(doc)]))))
        hash_now, doc_now = (int(hi[-1]), int(lo[-1])), owner[-1]
        later = pa.array(owner != doc)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).filter(later) for i in (2, 3, 4)], names=["doc", "version", "pos"])


def _bitmap(positions) -> bytes:
    """Compressed keep bitmap, up to the byte of the last dropped line; all later lines are kept."""
    keep = np.ones((max(positions) // 8 + 1) * 8, dtype=bool)  # whole bytes, padded with kept lines
    keep[list(positions)] = False
    return zlib.compress(np.packbits(keep).tobytes())


@F.pandas_udf(T.BinaryType())
def _bitmaps(positions: pd.Series) -> pd.Series:
    return positions.map(_bitmap)


def _kept(text: str | None, bitmap: bytes | None) -> str | None:
    if text is None or bitmap is None:
        return text
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bytes(bitmap)), np.uint8))
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i >= len(keep) or keep[i])


@F.pandas_udf(T.StringType())
def _kept_texts(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
    return pd.Series([_kept(t, b) for t, b in zip(texts, bitmaps)], dtype=object)


def _version() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, version, n_dropped, bitmap) of the documents that lose lines; no text moves.

    Keys of min_chars code points or more that several documents hold lose their lines except in
    the smallest doc_id. Lines become 128-bit hashes, range-partitioned and sorted by (hash,
    document, position): a hash that a third of all documents hold spans as many partitions as it
    needs. Each partition is streamed and only remembers one hash and its first document. For the
    hash that a partition starts with, the first document is looked up (one row per partition).
    The sorted lines are checkpointed, so a lost task reads the same partitions again.

    Null text is one empty line; null doc_ids count as one document after all others. Rows that
    repeat a doc_id are the same document; version (a hash of the text) tells their texts apart.
    Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text", _version().alias("version"))
    lines, _ = write_table(narrow.mapInArrow(lambda it: _hash_lines(it, min_chars),
                                             "hi long, lo long, doc long, version long, pos int"), "lines")
    order = ("hi", "lo", "doc", "version", "pos")
    ranged = cut_lineage(lines.repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order))
    heads = (ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("hi", "lo")).alias("h"))
             .select("h.hi", "h.lo").distinct())
    # one row per partition: bounded by the number of partitions, not by the data
    firsts = ranged.join(F.broadcast(heads), ["hi", "lo"]).groupBy("hi", "lo").agg(F.min("doc").alias("doc"))
    first_docs = {(r.hi, r.lo): r.doc for r in firsts.collect()}
    later = ranged.mapInArrow(lambda it: _later_lines(it, first_docs), "doc long, version long, pos int")
    return (later.groupBy("doc", "version")
            .agg(F.collect_set("pos").alias("positions"))
            .select("doc", "version", F.size("positions").cast("long").alias("n_dropped"),
                    _bitmaps("positions").alias("bitmap")))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(row struct, text with the kept lines, n_dropped) for every row of docs; see line_bitmaps.

    The texts stream past a hash table of their partition's bitmaps: they are not sorted, and the bitmaps'
    Python worker is done before that of the texts begins.
    """
    maps = line_bitmaps(docs, min_chars)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
                       _version().alias("version"))
    return (rows.join(maps.hint("shuffle_hash"), ["doc", "version"], "left")
            .select("row", _kept_texts(F.col("row.text"), "bitmap").alias("kept_text"),
                    F.coalesce("n_dropped", F.lit(0)).alias("n_dropped")))
