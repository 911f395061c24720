"""Repeated byte strings: interval trees over enhanced suffix arrays of the texts' repeated parts."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import xxhash

from mercato.llm.jaccard import _packed, _unpacked, mixed
from mercato.llm.words import batches_of, texts_of
from mercato.session import write_table

LENGTH = 100
GRAM = 32
BATCH_BYTES = 1 << 20    # of text: a batch packs to rows that the JVM need not hold as humongous objects
PIECE = 1 << 19           # bytes hashed at a time
COUNTED = np.uint64(16)   # low bits of a gram's hash that are left out where grams are only counted
CHUNK = 1 << 14           # contexts compared at a time
PART = 1 << 14            # contexts analysed, or suffixes sorted, at a time: more only where one gram, or one distance, has more
RANGES_PER_PARTITION = 2
HOT = 100_000             # occurrences of a gram beyond which its windows are dealt one by one: fewer contexts fit 100 MB
NO_ID = np.iinfo(np.int64).max  # a null doc_id comes last

# ---------------------------------------------------------------- anchors


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from every position."""
    h, span = data.astype(np.uint64) + np.uint64(1), 1
    while span < GRAM:
        odd = mixed(np.array([span], np.uint64))[0] | np.uint64(1)
        h = h[:-span] * odd + h[span:]
        span *= 2
    return mixed(h)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(position, first window, last window, document, hash) of each anchor of the concatenated texts.

    The anchor of a window of `length` bytes is the position of the leftmost of its grams with the
    smallest hash: it depends on the window's bytes alone, so equal windows have it at the same
    place. Neighbouring windows mostly share one, about every 35th position is an anchor.
    """
    width = length - GRAM + 1
    low32 = np.uint64(0xFFFFFFFF)
    stops = np.maximum(offsets[:-1], offsets[1:] - length + 1)  # first position after a text's windows
    parts = []
    for s in range(0, len(data) - length + 1, PIECE):
        part = data[s:s + PIECE + length - 1]
        h = gram_hashes(part)
        low, span = (h & ~low32) | np.arange(len(h), dtype=np.uint64), 1
        while span * 2 <= width:
            low, span = np.minimum(low[:-span], low[span:]), span * 2
        n = len(h) - width + 1
        at = (np.minimum(low[:n], low[width - span:width - span + n]) & low32).astype(np.int64)
        starts = np.concatenate(([True], at[1:] != at[:-1]))
        inside = offsets[(offsets >= s) & (offsets < s + n)] - s
        starts[inside] = True
        first = np.flatnonzero(starts)
        last = np.append(first[1:], n) - 1
        doc = np.searchsorted(offsets, first + s, side="right") - 1
        keep = first + s < stops[doc]
        first, last, doc = first[keep] + s, np.minimum(last[keep] + s, stops[doc[keep]] - 1), doc[keep]
        p = at[first - s]
        parts.append((p + s, first, last, doc, h[p]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    p, first, last, doc, h = (np.concatenate([x[i] for x in parts]) for i in range(5))
    again = np.concatenate(([False], p[1:] == p[:-1]))  # windows on both sides of a piece's end
    keep = np.flatnonzero(~again)
    last = last[np.append(keep[1:], len(p)) - 1] if len(p) else last
    return p[keep], first[keep], last, doc[keep], h[keep]


def contexts(data: np.ndarray, offsets: np.ndarray, p: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray,
             length: int):
    """(bytes around each anchor as far as its windows reach and one more to the left, bytes to the left, to the right).

    Beyond these and beyond the text the row is 0.
    """
    reach = length - GRAM + 1
    left, right = np.minimum(p - first + 1, p - offsets[doc]), last + length - p
    padded = np.concatenate((np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, reach + length)[p]
    column = np.arange(-reach, length)
    for s in range(0, len(p), CHUNK):
        rows[s:s + CHUNK] *= (column >= -left[s:s + CHUNK, None]) & (column < right[s:s + CHUNK, None])
    return rows, left, right


# ------------------------------------------------------------ suffix arrays


def _equal_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of the rows of a and b."""
    out = np.empty(len(a), np.int64)
    for s in range(0, len(a), CHUNK):
        differ = a[s:s + CHUNK] != b[s:s + CHUNK]
        out[s:s + CHUNK] = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return out


def branch_starts(group: np.ndarray, rows: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, reach: int):
    """(context, distance before the anchor) of the suffixes at which a repeat around an anchor can begin.

    Sorted by the bytes to the left, backwards, contexts with a common left part are neighbours;
    where such a part ends, the bytes before differ: left-extension diversity. Each context's first
    window is a start too, as its anchor reaches no further.
    """
    back = np.ascontiguousarray(rows[:, reach - 1::-1])
    wide = np.zeros((len(rows), -(-reach // 8) * 8), np.uint8)
    wide[:, :reach] = back
    words = wide.view(">u8")
    order = np.lexsort((*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), group))
    a, b = order[:-1], order[1:]
    common = np.minimum(np.minimum(_equal_run(back[a], back[b]), left[a]), left[b])
    common[group[a] != group[b]] = -1
    who, where = [np.arange(len(rows))], [high]
    for d in range(reach):
        at = common == d
        if at.any():
            node = np.concatenate(([0], np.cumsum(common < d)))  # contexts that agree on d bytes
            branches = np.zeros(node[-1] + 1, bool)
            branches[node[1:][at]] = True
            found = order[branches[node]]
            found = found[(low[found] <= d) & (d < high[found])]
            who.append(found)
            where.append(np.full(len(found), d))
    return np.concatenate(who), np.concatenate(where)


def suffix_array(group: np.ndarray, rows: np.ndarray, right: np.ndarray, who: np.ndarray, before: np.ndarray, reach: int):
    """(order, lcp): the suffixes sorted by group, distance and bytes, and the common prefix with the one before.

    Equal windows lie at one distance from their anchor, so suffixes at different distances have no repeat.
    """
    width, data = rows.shape[1], np.ascontiguousarray(rows).reshape(-1).data
    tags = np.empty(len(who), [("g", ">u8"), ("d", "u1")])
    tags["g"], tags["d"] = group[who], before
    tag = tags.tobytes()
    starts, ends = who * width + reach - before, who * width + reach + right[who]
    keys = [tag[9 * k:9 * k + 9] + data[s:e] for k, (s, e) in enumerate(zip(starts.tolist(), ends.tolist()))]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    lcp = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero((group[who[a]] == group[who[b]]) & (before[a] == before[b]))
    a, b = a[near], b[near]
    for s in range(0, len(near), CHUNK):
        x, y = a[s:s + CHUNK], b[s:s + CHUNK]
        differ = rows[who[x]] != rows[who[y]]
        differ &= np.arange(width) >= reach - before[x][:, None]
        end = np.where(differ.any(axis=1), differ.argmax(axis=1), width) - (reach - before[x])
        lcp[near[s:s + CHUNK] + 1] = np.minimum(end, before[x] + np.minimum(right[who[x]], right[who[y]]))
    return order, lcp


def interval_tree(lcp: list[int], age: list[int], previous: list[int], length: int):
    """Stack scan of a suffix array: (lost, repeats).

    The open intervals of the common-prefix interval tree lie on a stack, deeper ones on top; an
    interval closes when a shorter common prefix comes. Each holds its oldest suffix and whether the
    bytes before its suffixes differ. Where intervals meet, the younger of two oldest suffixes learns how
    long its text occurs earlier: lost[suffix] (0: nowhere). repeats are the intervals (first, last,
    length) of at least `length` bytes whose left extension is diverse: the maximal repeats, each
    with all its occurrences. previous is the byte before, below 0 where nothing, or nothing known, is.
    """
    lost, repeats = [0] * len(age), []
    stack: list[list] = []  # [depth, first, oldest, byte before or -1 if they differ]

    def absorb(node, child):
        if age[child[2]] < age[node[2]]:
            node[2], loser = child[2], node[2]
        else:
            loser = child[2]
        lost[loser] = node[0]
        if node[3] != child[3]:
            node[3] = -1

    for k in range(1, len(lcp) + 1):
        depth = lcp[k] if k < len(lcp) else 0
        carry = [0, k - 1, k - 1, previous[k - 1]]
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            absorb(top, carry)
            if top[3] < 0:
                repeats.append((top[1], k - 1, top[0]))
            carry = top
        if depth >= length:
            if stack and stack[-1][0] == depth:
                absorb(stack[-1], carry)
            else:
                stack.append([depth, carry[1], carry[2], carry[3]])
    return lost, repeats


def _whole_parts(first: np.ndarray):
    """(start, end) of parts of about PART entries, none of which cuts a group; first marks where groups begin."""
    starts, at = np.append(np.flatnonzero(first), len(first)), 0
    while at < len(first):
        end = int(starts[np.searchsorted(starts, min(at + PART, len(first)))])
        yield at, end
        at = end


def repeats_around(group, rows, left, right, low, high, age, length):
    """Of distinct contexts of anchors: (context, distance, lost length) and the maximal repeats among their suffixes.

    Returns (context, distance before the anchor, bytes that occur earlier) per suffix that has any, and
    (suffix contexts in order, their distances, repeats).
    """
    reach = length - GRAM + 1
    who, before = branch_starts(group, rows, left, low, high, reach)
    order = np.lexsort((before, group[who]))
    who, before = who[order], before[order]
    lost, repeats = np.zeros(len(who), np.int64), []
    differs = (group[who[1:]] != group[who[:-1]]) | (before[1:] != before[:-1])  # no repeat goes over such a border
    for a, b in _whole_parts(np.concatenate(([True], differs))):
        order, lcp = suffix_array(group, rows, right, who[a:b], before[a:b], reach)
        own, distance = who[a:b][order], before[a:b][order]
        at = np.maximum(reach - distance - 1, 0)
        known = (distance < left[own]) & (distance < high[own])
        previous = np.where(known, rows[own, at].astype(np.int64), -1)
        lost[a:b], found = interval_tree(lcp.tolist(), age[own].tolist(), previous.tolist(), length)
        who[a:b], before[a:b] = own, distance
        repeats += [(first + a, last + a, size) for first, last, size in found]
    some = np.flatnonzero(lost)
    return (who[some], before[some], lost[some]), (who, before, repeats)


# ------------------------------------------------------------------ tasks

READ = "range int, batch long, grams binary, texts binary"
DEALT = "key long, batch long, kind int, payload binary"
SPANS = "batch long, kind int, payload binary"
GRAMS, TEXTS, CONTEXTS, WINDOWS, SPAN = 0, 1, 2, 3, 4


def _dumped(*values) -> bytes:
    plain = pickle.dumps(values)
    return pa.Codec("zstd", compression_level=6).compress(plain, asbytes=True) + len(plain).to_bytes(8, "little")


def _loaded(payload: bytes):
    return pickle.loads(pa.decompress(payload[:-8], int.from_bytes(payload[-8:], "little"), codec="zstd", asbytes=True))


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    pa.default_memory_pool().release_unused()  # what the last group needed; workers go on for many groups
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _by_range(hashes: np.ndarray, ranges: int):
    """(range, rows in the order of their hashes) of the hashes' ranges.

    An anchor's hash is the smallest of its window's, so the ranges are of the hashes mixed anew: by the hashes
    themselves the lowest range of 204 would hold 29 % of all anchors.
    """
    where = ((mixed(hashes) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((hashes, where))
    cuts = np.searchsorted(where[order], np.arange(ranges + 1))
    for r in np.flatnonzero(np.diff(cuts)).tolist():
        yield r, order[cuts[r]:cuts[r + 1]]


def _read(batches, length: int, ranges: int):
    """(doc_id, text) batches -> each batch's texts, packed, and per hash range its anchors' grams with their counts."""
    part, sequence = TaskContext.get().partitionId(), 0
    for batch in batches_of(batches, BATCH_BYTES):
        name, sequence = (part << 32) | sequence, sequence + 1
        texts = texts_of(batch.column(1))
        _, ends, data = texts.buffers()
        offsets = np.frombuffer(ends, np.int64)[:len(texts) + 1].copy()
        data = np.frombuffer(data, np.uint8)[:offsets[-1]].copy() if data is not None else np.zeros(0, np.uint8)
        ids = batch.column(0).to_pylist()
        rows = [(None, name, None, _dumped(ids, offsets, data))]
        grams, counts = np.unique(anchors(data, offsets, length)[4] >> COUNTED, return_counts=True)
        for r, at in _by_range(grams, ranges):
            rows.append((r, name, _dumped(_packed(grams[at]), counts[at].astype(np.uint32)), None))
        yield from _table(READ, rows).to_batches()


def _count(table: pa.Table) -> pa.Table:
    """One hash range: the grams that occur more than once go back to their batches with their counts."""
    names = table.column("batch").to_pylist()
    lists = [_loaded(p) for p in table.column("grams").to_pylist()]
    grams = [_unpacked(g) for g, _ in lists]
    h = np.concatenate(grams)
    distinct, place = np.unique(h, return_inverse=True)
    total = np.bincount(place, np.concatenate([c for _, c in lists])).astype(np.int64)[place]
    rows, at = [], 0
    for name, own in zip(names, grams):
        mine = total[at:at + len(own)]
        at += len(own)
        if (mine > 1).any():
            rows.append((name, GRAMS, _dumped(_packed(own[mine > 1]), mine[mine > 1])))
    return _table(SPANS, rows)


def _batch(table: pa.Table):
    """The texts of a batch and the payloads of its other rows."""
    texts, others = None, []
    for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist()):
        if kind == TEXTS:
            texts = _loaded(payload)
        else:
            others.append(_loaded(payload))
    return texts, others


def _deal(length: int, ranges: int, hot: int, collapse: bool):
    def deal(table: pa.Table) -> pa.Table:
        """One batch: the contexts of its repeated grams, dealt by gram.

        Of equal contexts in the batch only the first is dealt; the others lose their bytes here.
        Contexts of a gram that is very frequent are dealt as single windows, by the hash of each.
        """
        (ids, offsets, data), lists = _batch(table)
        name = table.column("batch")[0].as_py()
        if not lists:
            return _table(DEALT, [])
        grams = np.concatenate([_unpacked(g) for g, _ in lists])
        counts = np.concatenate([c for _, c in lists])
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        p, first, last, doc, h = anchors(data, offsets, length)
        counted = h >> COUNTED
        at = np.minimum(np.searchsorted(grams, counted), len(grams) - 1)
        keep = grams[at] == counted
        p, first, last, doc, h, n = p[keep], first[keep], last[keep], doc[keep], h[keep], counts[at[keep]]
        own = np.array([NO_ID if d is None else d for d in ids], np.int64)[doc]
        order = np.lexsort((p, own))
        p, first, last, doc, h, n, own = (x[order] for x in (p, first, last, doc, h, n, own))
        rows, left, right = contexts(data, offsets, p, first, last, doc, length)
        starts, ends = [], []
        if collapse:
            whole = np.concatenate((rows, np.column_stack((left, right)).astype(np.uint8), h[:, None].view(np.uint8)), axis=1)
            size, raw = whole.shape[1], whole.tobytes()
            seen: dict[bytes, int] = {}
            oldest = np.array([seen.setdefault(raw[k * size:(k + 1) * size], k) for k in range(len(p))], np.int64)
            again = oldest != np.arange(len(p))
            starts.append(first[again])
            ends.append((p + right)[again])
            new = ~again
            p, first, last, h, n, own, rows, left, right = (x[new] for x in (p, first, last, h, n, own, rows, left, right))
        out = []
        usual = n <= hot
        for r, k in _by_range(h, ranges):
            k = k[usual[k]]
            if len(k):
                out.append((r, name, CONTEXTS, _dumped(h[k], rows[k], left[k].astype(np.uint8), right[k].astype(np.uint8),
                                                       (p - last)[k].astype(np.uint8), (p - first)[k].astype(np.uint8), own[k], p[k])))
        k = np.flatnonzero(~usual)
        if len(k):
            raw = data.tobytes()
            at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[k].tolist(), last[k].tolist())])
            of = np.repeat(own[k], (last - first)[k] + 1)
            names = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[i:i + length]) for i in at.tolist()]), "<u8").reshape(-1, 2)
            order = np.lexsort((at, of, names[:, 1], names[:, 0]))
            at, of, names = at[order], of[order], names[order]
            if collapse:
                again = np.concatenate(([False], (names[1:] == names[:-1]).all(axis=1)))
                starts.append(at[again])
                ends.append(at[again] + length)
                at, of, names = at[~again], of[~again], names[~again]
            for r, k in _by_range(names[:, 0], ranges):
                out.append((r, name, WINDOWS, _dumped(names[k], of[k], at[k])))
        if starts and any(map(len, starts)):
            out.append((name % ranges, name, SPAN, _dumped(np.concatenate(starts), np.concatenate(ends))))
        return _table(DEALT, out)
    return deal


def _payloads(table: pa.Table, kind: int) -> list[tuple]:
    """(batch, its columns) of each payload of one kind."""
    return [(b, _loaded(p)) for b, k, p in zip(table.column("batch").to_pylist(), table.column("kind").to_pylist(),
                                               table.column("payload").to_pylist()) if k == kind]


def _gathered(found: list[tuple]):
    """The columns of payloads, concatenated, with the batch of each row."""
    batch = np.repeat(np.array([b for b, _ in found], np.int64), [len(x[0]) for _, x in found])
    return [batch, *(np.concatenate([x[i] for _, x in found]) for i in range(len(found[0][1])))]


def _contexts_in_parts(table: pa.Table):
    """One hash range's contexts, gathered in parts of whole grams: a context takes a multiple of its bytes while it is analysed."""
    found = _payloads(table, CONTEXTS)
    hashes = np.sort(np.concatenate([x[0] for _, x in found]))
    for a, b in _whole_parts(np.concatenate(([True], hashes[1:] != hashes[:-1]))):
        part = []
        for batch, columns in found:  # in the order of their hashes
            of = slice(np.searchsorted(columns[0], hashes[a]), np.searchsorted(columns[0], hashes[b - 1], side="right"))
            if of.start < of.stop:
                part.append((batch, [x[of] for x in columns]))
        yield _gathered(part)


def _ages(own: np.ndarray, batch: np.ndarray, p: np.ndarray) -> np.ndarray:
    age = np.empty(len(p), np.int64)
    age[np.lexsort((p, batch, own))] = np.arange(len(p))
    return age


def _distinct(rows: np.ndarray, left, right, h, age):
    """(number of each row's context, first row of each distinct context by age)."""
    seen: dict[bytes, int] = {}
    same = np.empty(len(rows), np.int64)
    oldest, order = [], np.argsort(age)
    for s in range(0, len(order), CHUNK):
        part = order[s:s + CHUNK]
        whole = np.concatenate((rows[part], np.column_stack((left[part], right[part])), h[part, None].view(np.uint8)), axis=1)
        size, raw = whole.shape[1], whole.tobytes()
        for n, k in enumerate(part.tolist()):
            if (number := seen.setdefault(raw[n * size:(n + 1) * size], len(seen))) == len(oldest):
                oldest.append(k)
            same[k] = number
    return same, np.array(oldest, np.int64)


def _several(group: np.ndarray) -> np.ndarray:
    """Which entries belong to a group with more than one."""
    _, place, n = np.unique(group, return_inverse=True, return_counts=True)
    return n[place] > 1


def _analysed(part: list, length: int):
    """A part of a range's contexts: columns, distinct ones, what their suffixes lose, and the suffix array's repeats."""
    batch, h, rows, left, right, low, high, own, p = part
    age = _ages(own, batch, p)
    same, oldest = _distinct(rows, left, right, h, age)
    left, right, low, high = (x.astype(np.int64) for x in (left, right, low, high))
    some = oldest[_several(h[oldest])]  # alone in its group, a context has only exact copies
    around = repeats_around(h[some], rows[some], left[some], right[some], low[some], high[some], age[some], length) if len(some) else None
    return batch, own, p, right, high, same, oldest, some, around


def _lose(length: int):
    def lose(table: pa.Table) -> pa.Table:
        """One hash range: the spans that occur earlier, back to their batches."""
        spans = [(b, SPAN, p) for b, k, p in zip(table.column("batch").to_pylist(), table.column("kind").to_pylist(),
                                                 table.column("payload").to_pylist()) if k == SPAN]
        found = []
        if SPAN in (kinds := set(table.column("kind").to_pylist())) and len(kinds) == 1:
            return _table(SPANS, spans)
        for part in _contexts_in_parts(table) if CONTEXTS in kinds else ():
            batch, _, p, right, high, same, oldest, some, around = _analysed(part, length)
            copies = np.flatnonzero(oldest[same] != np.arange(len(p)))
            found.append((batch[copies], p[copies] - high[copies], p[copies] + right[copies]))
            if around:
                (who, before, lost), _ = around
                at = some[who]
                found.append((batch[at], p[at] - before, p[at] - before + lost))
        if WINDOWS in kinds:
            batch, names, own, at = _gathered(_payloads(table, WINDOWS))
            order = np.lexsort((at, batch, own, names[:, 1], names[:, 0]))
            again = order[1:][(names[order][1:] == names[order][:-1]).all(axis=1)]
            found.append((batch[again], at[again], at[again] + length))
        batch, starts, ends = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.argsort(batch, kind="stable")
        batch, starts, ends = batch[order], starts[order], ends[order]
        cuts = np.flatnonzero(np.concatenate(([True], batch[1:] != batch[:-1]))) if len(batch) else np.zeros(0, np.int64)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(batch)]):
            spans.append((int(batch[a]), SPAN, _dumped(starts[a:b], ends[a:b])))
        return _table(SPANS, spans)
    return lose


GROUPS = "repeat long, length int, batch long, position long"


def _list(length: int):
    def listed(table: pa.Table) -> pa.Table:
        """One hash range: every maximal repeat with all its occurrences."""
        key = table.column("key")[0].as_py() << 40
        kinds, out, number = set(table.column("kind").to_pylist()), [], 0
        for part in _contexts_in_parts(table) if CONTEXTS in kinds else ():
            batch, _, p, right, high, same, oldest, some, around = _analysed(part, length)
            order = np.argsort(same, kind="stable")
            cuts = np.searchsorted(same[order], np.arange(len(oldest) + 1))
            members = [order[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            number_of = {int(k): n for n, k in enumerate(oldest)}
            alone = [(m, np.full(len(m), high[m[0]]), int(high[m[0]] + right[m[0]])) for m in members if len(m) > 1]
            if around:
                _, (who, before, repeats) = around
                for a, b, size in repeats:
                    each = [members[number_of[int(some[w])]] for w in who[a:b + 1]]
                    alone.append((np.concatenate(each), np.repeat(before[a:b + 1], [len(m) for m in each]), size))
            for m, before, size in alone:
                out.append((np.full(len(m), key | number), np.full(len(m), size), batch[m], p[m] - before))
                number += 1
        if WINDOWS in kinds:
            batch, names, _, at = _gathered(_payloads(table, WINDOWS))
            _, place, n = np.unique(names, axis=0, return_inverse=True, return_counts=True)
            m = np.flatnonzero(n[place.ravel()] > 1)
            out.append((key | (number + place.ravel()[m]), np.full(len(m), length), batch[m], at[m]))
        arrays = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4)]
        return pa.table([pa.array(a, t) for a, t in zip(arrays, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        names=[c.split()[0] for c in GROUPS.split(", ")])
    return listed


KEPT = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _cut(table: pa.Table) -> pa.Table:
    """One batch: the spans of each text and what is left of it."""
    (ids, offsets, data), lists = _batch(table)
    depth = np.zeros(len(data) + 1, np.int32)
    for starts, ends in lists:
        np.add.at(depth, starts, 1)
        np.add.at(depth, ends, -1)
    covered = np.cumsum(depth[:-1]) > 0
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    padded = np.concatenate(([False], covered, [False]))
    starts = np.flatnonzero(covered & (~padded[:-2] | border[:-1]))
    ends = np.flatnonzero(covered & (~padded[2:] | border[1:])) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
    left = np.concatenate(([0], np.cumsum(~covered)))[offsets]
    rest = data[~covered].tobytes()
    base = offsets[doc]
    lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x - base)) for x in (starts, ends)]
    kept = pa.array([rest[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist())], pa.binary())
    return pa.table([pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), *lists, kept],
                    names=[c.split()[0] for c in KEPT.split(", ")])


# ---------------------------------------------------------------- operator


def _dealt(docs: DataFrame, length: int, hot: int, collapse: bool) -> tuple[DataFrame, DataFrame]:
    """(the texts by batch, contexts and windows by hash range)."""
    if not GRAM < length <= 255:
        raise ValueError(f"length must be {GRAM + 1} to 255 bytes")
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read, _ = write_table(source.mapInArrow(lambda it: _read(it, length, ranges), READ), "repeat-batches")
    texts = read.where("texts IS NOT NULL").select("batch", F.lit(TEXTS).alias("kind"), F.col("texts").alias("payload"))
    live = (read.where("grams IS NOT NULL").select("range", "batch", "grams")
            .groupBy("range").applyInArrow(_count, SPANS))
    dealt = texts.unionByName(live).groupBy("batch").applyInArrow(_deal(length, ranges, hot, collapse), DEALT)
    return texts, dealt


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept), one row per row of docs: its text without repeated bytes.

    Texts are UTF-8 bytes. A byte goes if a string of `length` bytes that covers it also starts earlier:
    in a smaller doc_id (null last), in an earlier row with the same doc_id, or earlier in the
    same text. Strings are judged on the input; matches never cross texts. starts and ends are
    the maximal removed runs, kept the bytes left, which need not be valid UTF-8.

    Any two equal strings of `length` bytes have their anchor (the gram with the smallest hash) at the same
    place. First the anchors' grams are counted over all texts; those that occur once can't be in a
    repeat. The bytes around the others, as far as their windows reach, are dealt by gram.
    There an enhanced suffix array (suffixes sorted, with common prefix lengths) is built over the
    suffixes where a repeat can begin, and its interval tree is scanned with a stack: at each
    interval all occurrences but the oldest lose the interval's length. Repeats longer than an
    anchor's reach are found in overlapping parts, one per anchor. Equal contexts of a batch are
    dealt once, so a group of copies takes one row per batch; a gram with more than `hot`
    occurrences is split into its single windows, dealt by their 128-bit hashes.

    Null texts are empty, empty and shorter ones stay as they are. A text of any length is read
    whole, in a batch of its own. Repeated rows are texts like others: the later ones lose what the first has. Other
    columns are ignored. An empty table gives no rows.
    """
    texts, dealt = _dealt(docs, length, hot, collapse=True)
    spans = dealt.groupBy("key").applyInArrow(_lose(length), SPANS)
    return texts.unionByName(spans).groupBy("batch").applyInArrow(_cut, KEPT)


def maximal_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(repeat, length, doc_id, start): every maximal repeat of at least `length` bytes with all its occurrences.

    A repeat is an interval of the common-prefix interval tree whose occurrences differ in the byte
    before them and in the byte after, as far as the windows of one anchor reach (`length` to 2 * length - GRAM
    bytes): a longer one is reported in overlapping parts, each with all its occurrences. Windows of grams with more than
    `hot` occurrences are reported as repeats of `length` bytes. One row per occurrence; start counts
    the bytes of its text. Nulls, empty and long texts, repeated rows and empty tables as in without_repeats.
    """
    texts, dealt = _dealt(docs, length, hot, collapse=False)
    found = dealt.groupBy("key").applyInArrow(_list(length), GROUPS)

    def places(repeats: pa.Table, texts: pa.Table) -> pa.Table:
        ids, offsets, _ = _loaded(texts.column("payload")[0].as_py())
        at = np.asarray(repeats.column("position"))
        doc = np.searchsorted(offsets, at, side="right") - 1
        return pa.table([repeats.column("repeat"), repeats.column("length"), pa.array(ids, pa.int64()).take(pa.array(doc)),
                         pa.array(at - offsets[doc])], names=["repeat", "length", "doc_id", "start"])

    return found.groupBy("batch").cogroup(texts.groupBy("batch")).applyInArrow(
        places, "repeat long, length int, doc_id long, start long")
