"""Best-fit packing of tokenised documents, certified by dual-feasible-function bounds."""

from __future__ import annotations

import bisect
import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.words import batches_of, texts_of, worker_cache
from mercato.session import write_table

CAPACITY = 4096
PIECES_PER_PART = 20_000
ROUNDS = 2

# ---------------------------------------------------------------- tokens


class WordTokenizer:
    """Token ids of texts by a word-end BPE file of the tokenizers library, by distinct words.

    The file's pre-tokenizer never joins across white space, so the ids of a text are those of its
    space-separated words in a row, and each distinct word of a batch is encoded once. Words of
    Latin letters are merged in one tiktoken call with the file's own merge ranks (each word ends
    in a space there, and the last byte with that space is one symbol, merged first). Other words
    of ASCII and Latin-1 letters are split by the file's pattern and merged the same way. All
    remaining words go through the tokenizers library itself.
    """

    LETTERS = "a-zß-öø-ÿ"
    PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
    SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
    PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+")
    END = b" "

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        symbols = _byte_symbols()
        to_byte = {c: b for b, c in symbols.items()}

        def raw(token: str) -> bytes:
            own = token.removesuffix(suffix)
            return bytes(to_byte[c] for c in own) + (self.END if own != token else b"")

        tokens = [symbols[b] for b in range(256)]
        tokens += [symbols[b] + suffix for b in range(256)]
        tokens += [x.replace(" ", "") if isinstance(x, str) else "".join(x) for x in model["merges"]]
        self.ids = np.array([vocab.get(t, 0) for t in tokens], dtype=np.int64)
        self.ends = np.array([t.endswith(suffix) for t in tokens])
        bpe = tiktoken.Encoding("word-ends", pat_str="[^ ]+ ", special_tokens={},
                                mergeable_ranks={raw(t): k for k, t in enumerate(tokens)})
        self.merge = bpe._core_bpe.encode_ordinary

    def _merged(self, pieces: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens of each piece) of lower-case pieces that each end in a space."""
        ranks = np.array(self.merge(pieces), dtype=np.int64)
        last = np.flatnonzero(self.ends[ranks])
        return self.ids[ranks], np.diff(last, prepend=-1)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a pool of ids, where each word's ids start in it, how many they are)."""
        plain = pc.match_substring_regex(words, self.PLAIN)
        letters = pc.utf8_lower(words.filter(plain)).cast(pa.string())
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(letters)], letters), " ")[0].as_py()
        ids, counts = self._merged(joined + " " if len(letters) else "")
        simple, pieces, slow = [], [], []
        for k, word in enumerate(words.filter(pc.invert(plain)).to_pylist()):
            if self.SIMPLE.fullmatch(word) and "<|" not in word:
                own = self.PIECES.findall(word.lower())
                simple.append((k, len(own)))
                pieces += own
            else:
                slow.append((k, self.slow.encode(word, add_special_tokens=False).ids))
        more, per_piece = self._merged("".join(x + " " for x in pieces))
        before = np.concatenate(([0], np.cumsum(per_piece)))
        n_pieces = np.array([n for _, n in simple], dtype=np.int64)
        at = np.concatenate(([0], np.cumsum(n_pieces)))
        mask = np.asarray(plain)
        place = np.concatenate((np.flatnonzero(mask),
                                np.flatnonzero(~mask)[np.array([k for k, _ in simple + slow], np.int64)]))
        sizes, starts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        own = np.concatenate((counts, before[at[1:]] - before[at[:-1]], [len(x) for _, x in slow])).astype(np.int64)
        sizes[place], starts[place] = own, np.cumsum(own) - own
        return np.concatenate((ids, more, *[np.array(x, np.int64) for _, x in slow])), starts, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, ids before each text); texts: large strings without nulls."""
        # line feeds and spaces are white space under any reading, and the file's pattern always
        # parts a letter from a full stop or comma: all of that only makes shorter words
        spaced = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "),
                                            "([A-Za-zÀ-ÖØ-öø-ÿ])([.,])", r"\1 \2")
        lists = pc.split_pattern(spaced, " ")
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        coded = pc.dictionary_encode(lists.values.slice(offsets[0], offsets[-1] - offsets[0]))
        codes = np.asarray(coded.indices, dtype=np.int64)
        pool, starts, sizes = self.words(coded.dictionary)
        per_word = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(per_word)))
        gather = np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], per_word)
        return pool[gather].astype(np.uint32), ends[offsets - offsets[0]]


def _byte_symbols() -> dict[int, str]:
    """Printable stand-ins of byte-level BPE: bytes that print stand for themselves, others follow 255."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    symbols = {b: chr(b) for b in own}
    for k, b in enumerate(b for b in range(256) if b not in symbols):
        symbols[b] = chr(256 + k)
    return symbols


def tokenizer(path: str) -> WordTokenizer:
    cache = worker_cache()
    if ("tokenizer", path) not in cache:
        cache["tokenizer", path] = WordTokenizer(path)
    return cache["tokenizer", path]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cut(batches, path: str | None, capacity: int, end_id: int):
    """(doc_id, text) batches -> one row per piece of at most capacity tokens."""
    for batch in batches_of(batches):
        tokens = tokenizer(path or vocabulary_path())
        ids, ends = tokens.encode(texts_of(batch.column(1)))
        docs, rows = batch.column(0).to_pylist(), []
        for k, doc in enumerate(docs):
            own = np.append(ids[ends[k]:ends[k + 1]], np.uint32(end_id)).astype("<u4")
            for piece, start in enumerate(range(0, len(own), capacity)):
                part = own[start:start + capacity]
                rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the token ids of each text and end_id, cut at capacity."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _cut(it, path, capacity, end_id),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


# --------------------------------------------------------------- packing


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual feasible functions.

    The first drops items below e, rounds those above capacity - e up to a whole bin and keeps
    the rest (all e at once from running sums); the second rounds to multiples of 1/k.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64), capacity)


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """lower_bound from the number of items of each size."""
    size = np.arange(capacity + 1, dtype=np.int64)
    items, volume = np.cumsum(count), np.cumsum(count * size)
    cut = np.arange(0, capacity // 2 + 1)
    below = np.where(cut > 0, volume[np.maximum(cut - 1, 0)], 0)
    best = int(np.max((items[-1] - items[capacity - cut]) - (-(volume[capacity - cut] - below) // capacity)))
    for k in range(1, 33):
        whole = ((k + 1) * size) % capacity == 0
        weight = np.where(whole, k * size, ((k + 1) * size // capacity) * capacity)  # times k * capacity
        best = max(best, -(-int((weight * count).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins): longest first, each into the fullest bin that has room."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: dict[int, list[int]] = {}
    rooms: list[int] = []  # distinct free rooms, ascending
    used = 0
    for k, need in zip(order.tolist(), lengths[order].tolist()):
        at = bisect.bisect_left(rooms, need)
        if at < len(rooms):
            room = rooms[at]
            stack = open_bins[room]
            b = stack.pop()
            if not stack:
                del open_bins[room], rooms[at]
        else:
            b, room, used = used, capacity, used + 1
        bins[k], offsets[k] = b, capacity - room
        if left := room - need:
            if left in open_bins:
                open_bins[left].append(b)
            else:
                open_bins[left] = [b]
                bisect.insort(rooms, left)
    return bins, offsets, used


PLACED = "uid long, part long, length long, bin long, offset long, fill long, bins long, bound long"


def _pack(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True])
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        return pd.DataFrame({"uid": pdf["uid"], "part": pdf["part"], "length": lengths, "bin": bins,
                             "offset": offsets, "fill": fill[bins], "bins": used,
                             "bound": lower_bound(lengths, capacity)})
    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_part: int = PIECES_PER_PART,
                rounds: int = ROUNDS) -> DataFrame:
    """pieces (with uid and length) plus sequence_id and offset; see pack_documents."""
    short = pieces.where(F.col("length") < capacity).select("uid", "length")

    def packed(items: DataFrame, salt: int) -> DataFrame:
        parts = max(1, -(-items.count() // pieces_per_part))
        dealt = items.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(parts)))
        return write_table(dealt.groupBy("part").applyInPandas(_pack(capacity), PLACED), f"packed-{salt}")[0]

    settled, open_items = [], short
    for salt in range(rounds + 1):
        placed = packed(open_items, salt)
        gap = placed.select("part", "bins", "bound").distinct().agg(
            F.coalesce(F.sum(F.col("bins") - F.col("bound")), F.lit(0))).first()[0]
        label = placed.withColumn("sequence_id", _sequence_id(salt, F.col("part"), F.col("bin")))
        if gap == 0 or salt == rounds or placed.select("part").distinct().count() < 2:
            settled.append(label)
            break
        # certified parts and the well-filled bins of the others stay; the rest change parts
        stays = (F.col("bins") <= F.col("bound")) | (F.col("fill") * 64 >= 63 * capacity)
        settled.append(label.where(stays))
        open_items = placed.where(~stays).select("uid", "length")
    chosen = settled[0]
    for more in settled[1:]:
        chosen = chosen.unionByName(more)
    full = pieces.where(F.col("length") >= capacity).select(
        "uid", (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.join(chosen.select("uid", "sequence_id", "offset").unionByName(full), "uid")


def _sequence_id(salt: int, part: F.Column, bin_: F.Column) -> F.Column:
    """An even number composed of the round, the part (34 bits) and the bin in it (24 bits); full pieces have odd ones."""
    return ((F.lit(salt).cast("long") * (1 << 34) + part) * (1 << 24) + bin_) * 2


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequences, bound): the sequences of a packing, and how many any packing of its pieces needs by
    the dual feasible functions. Only the number of pieces of each length comes to the driver."""
    spark = packed.sparkSession
    sizes = packed.groupBy("length").count().collect()  # at most capacity rows
    lengths = np.zeros(capacity + 1, np.int64)
    for row in sizes:
        lengths[row["length"]] = row["count"]
    used = packed.agg(F.count_distinct("sequence_id")).first()[0]
    return spark.createDataFrame([(used, bound_of_counts(lengths, capacity))], "sequences long, bound long")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                   pieces_per_part: int = PIECES_PER_PART, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Documents become token ids and are cut at capacity; full pieces are sequences of their own.
    The others are dealt by hash into parts of about pieces_per_part, each packed best-fit
    decreasing. A part whose bin count equals its dual-feasible-function bound is certified. The
    badly filled bins of the other parts are emptied, and their pieces are dealt anew among such
    parts and packed again, up to rounds times, until no part has a gap; certificate() tells how far the whole
    packing is from its bound. The parts have a fixed
    size whatever the data; lengths alone decide, so no source or copy group can be hot.

    A null text is an empty document (one piece, the end id alone). Null and repeated doc_ids are
    allowed: every row is packed on its own. Texts of any length are cut into as many pieces as they
    need. Other columns are ignored. An empty table gives no rows. Sequence ids are composed of
    (round, part, bin).
    """
    pieces, _ = write_table(token_pieces(docs, path, capacity).withColumn(
        "uid", F.monotonically_increasing_id()), "pieces")  # written once, so the uids stay
    return pack_pieces(pieces, capacity, pieces_per_part, rounds).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
