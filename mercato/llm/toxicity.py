"""Toxicity: string-kernel SVM on Nystroem landmarks."""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.labelled import by_label, sample_ids, texts_with
from mercato.llm.words import batches_of, texts_of, word_codes

TRAIN_DOCS = 1200  # per class
SURE = 0.05  # chance that any word of the training texts is taken for an insult by accident
AT_ONCE = 120  # candidate words that are compared at once, which bounds memory
AGAINST = 12  # landmarks from clean texts, at least; half as many as insults if that is more
INSERTED = "xe"  # letters put into the insults of the training table
DECAY = np.float32(0.6)  # of the kernel, for each letter that a match spans
LEAST = 0.4  # smaller kernel values count as zero
SAME = 0.999
NEAR = 0.6  # from here on a word is a variant of another
THRESHOLD = 0.3
WORD, MARK = 32, 16  # longest unit and landmark, in letters
RUN = 4  # single letters in a row that are read as one word
GAPS = (1, 2)  # steps between two letters of a longer unit that count as neighbours in a landmark
BLOCK = 1 << 14  # letters of longer units that are searched at once
OCCURRENCES = 1 << 14  # units near a landmark whose values are pooled at once

# ------------------------------------------------------------------ kernel


SIZES = (8, 12, 16, WORD)  # array widths, so that short words cost little


def _decay(n: int) -> np.ndarray:
    """Strictly lower Toeplitz matrix: what an earlier match is worth one step before position i."""
    gap = np.arange(n)[:, None] - np.arange(n)[None, :] - 1
    return np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0).astype(np.float32)


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common subsequences of three letters, gaps decayed (Lodhi et al. 2002), of rows of code points.

    a is (pairs, la), b (pairs, lb), padded with 0 and 1. For each length the matches that end at
    (i, j) are the equal letters times all shorter matches before, decayed; the decayed sums along
    both words are two matrix products over all pairs at once.
    """
    same = (a[:, :, None] == b[:, None, :]).astype(np.float32) * (DECAY * DECAY)
    left, right = _decay(a.shape[1]), _decay(b.shape[1]).T
    ends = same
    for _ in range(2):
        ends = same * np.matmul(left, ends @ right)
    return ends.sum(axis=(1, 2))


def kernels(words: np.ndarray, marks: np.ndarray, lengths: np.ndarray, chunk: int = 1024, cut: bool = False) -> np.ndarray:
    """subsequence_kernel of row pairs, chunk by chunk, with the words cut to their length class (marks too with cut)."""
    out = np.zeros(len(words), np.float32)
    class_of = np.searchsorted(SIZES, lengths)
    for k, size in enumerate(SIZES):
        rows = np.flatnonzero(class_of == k)
        for i in range(0, len(rows), chunk):
            part = rows[i:i + chunk]
            out[part] = subsequence_kernel(words[part, :size], marks[part, :size] if cut else marks[part])
    return out


def letters_of(words: list[str], width: int, pad: int) -> np.ndarray:
    """(words, width) code points, padded."""
    out = np.full((len(words), width), pad, np.uint32)
    for k, word in enumerate(words):
        own = np.frombuffer(word[:width].encode("utf-32-le", "surrogatepass"), np.uint32)
        out[k, : len(own)] = own
    return out


def letter_sets(words: pa.Array) -> np.ndarray:
    """A 64-bit set of hashed letters per word (large strings without empty ones)."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string())), "")[0].as_py()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.asarray(pc.utf8_length(words), dtype=np.int64)
    return np.bitwise_or.reduceat(np.uint64(1) << (points % 61).astype(np.uint64), np.cumsum(lengths) - lengths)


class Landmarks:
    """Kernel values between words and the landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.points = letters_of(words, max(map(len, words), default=1), 1)
        self.sets = letter_sets(pa.array(words, pa.large_string()))
        self.need = np.ceil(0.75 * np.bitwise_count(self.sets))
        self.longest = np.array([min(WORD, 2 * len(w) + 4) for w in words])
        self.norm = self._own(words, self.points)
        pairs = sorted({(self._pair(*map(ord, w[i:i + 2])), k) for k, w in enumerate(words) for i in range(len(w) - 1)})
        self.pairs, first = np.unique(np.array([p for p, _ in pairs], np.uint64), return_index=True)
        self.pair_ends = np.append(first, len(pairs)).astype(np.int64)
        self.pair_marks = np.array([k for _, k in pairs], np.int64)
        self.least_pairs = np.array([max(2, len(w) // 2) for w in words], np.int64)

    @staticmethod
    def _pair(a, b):
        return a << 21 | b

    def _own(self, words, points) -> np.ndarray:
        other = np.where(points == 1, 0, points)  # padding must not match itself
        return np.sqrt(np.maximum(subsequence_kernel(points, other), 1e-12)) if len(words) else np.zeros(0)

    def values(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words near some landmark, their kernel values with all landmarks).

        A value needs three quarters of the landmark's letters and a length that gaps could
        explain; it is zero otherwise, and where it is below LEAST. A word too long for a landmark
        has the largest value of its windows (see _windows).
        """
        lengths = np.asarray(pc.utf8_length(words), dtype=np.int64)
        usable = np.flatnonzero((lengths >= 3) & (lengths <= WORD))
        sets = letter_sets(words.take(pa.array(usable)))
        found = [np.zeros((2, 0), np.int64)]
        for k in range(0, len(usable), 16384):
            close = np.bitwise_count(sets[k:k + 16384, None] & self.sets[None, :]) >= self.need
            close &= lengths[usable[k:k + 16384]][:, None] <= self.longest[None, :]
            found.append(np.stack(np.nonzero(close)) + [[k], [0]])
        which, mark = np.concatenate(found, axis=1)
        near, row = np.unique(which, return_inverse=True)
        texts = words.take(pa.array(usable[near])).to_pylist()
        points, size = letters_of(texts, WORD, 0), lengths[usable][near]
        own = np.ones(len(texts))
        class_of = np.searchsorted(SIZES, size)
        for k, width in enumerate(SIZES):
            of = points[class_of == k, :width]
            own[class_of == k] = np.sqrt(np.maximum(kernels(of, np.where(of == 0, 1, of), size[class_of == k]), 1e-12))
        values = np.zeros((len(texts), len(self.words)), np.float32)
        for k in range(0, len(row), 65536):
            r, m = row[k:k + 65536], mark[k:k + 65536]
            got = kernels(points[r], self.points[m], size[r]) / (own[r] * self.norm[m])
            values[r, m] = np.where(got >= LEAST, got, 0)
        near = usable[near]
        long = np.flatnonzero(lengths > self.longest.min(initial=WORD))
        if len(long):
            word, mark, got = self._windows(words.take(pa.array(long)).to_pylist())
            every = np.union1d(near, long[word])
            both = np.zeros((len(every), len(self.words)), np.float32)
            both[np.searchsorted(every, near)] = values
            np.maximum.at(both, (np.searchsorted(every, long[word]), mark), got)
            near, values = every, both
        hot = values.any(axis=1)
        return near[hot], values[hot]

    def _windows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, kernel value) of the windows of words that are too long for the landmark.

        Windows start and end at letter pairs that are neighbours in the landmark, with at most one
        letter put in, and are no longer than the landmark's limit. All that hold enough pairs and
        three quarters of the landmark's letters are compared, at every place of the word.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(words)), sizes)
        limit, out = self.longest, [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        for base in range(0, len(flat), BLOCK) if len(self.pairs) else ():
            own, of = flat[base:base + BLOCK + WORD].astype(np.uint64), owner[base:base + BLOCK + WORD]
            hits = []
            for gap in GAPS:
                pair = self._pair(own[:-gap], own[gap:])
                at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                begin = np.flatnonzero((self.pairs[at] == pair) & (of[:-gap] == of[gap:]))
                at = at[begin]
                many = self.pair_ends[at + 1] - self.pair_ends[at]
                nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                begin = np.repeat(begin, many)
                hits.append(np.stack((self.pair_marks[np.repeat(self.pair_ends[at], many) + nth], begin, begin + gap)))
            mark, begin, end = np.concatenate(hits, axis=1)
            keep = sizes[of[begin]] > limit[mark]
            order = np.lexsort((end[keep], begin[keep], mark[keep]))
            mark, begin, end = mark[keep][order], begin[keep][order], end[keep][order]
            first, step = np.arange(len(mark)), 0
            while len(first):  # windows from each pair to the pairs after it
                step += 1
                first = first[first + step < len(mark)]
                last = first + step
                first = first[(mark[last] == mark[first]) & (begin[last] - begin[first] < limit[mark[first]])
                              & (of[begin[last]] == of[begin[first]])]
                last = first + step
                fits = (step + 1 >= self.least_pairs[mark[first]]) & (end[last] - begin[first] < limit[mark[first]])
                out += self._compared(own, of, mark[first[fits]], begin[first[fits]], end[last[fits]])
        return tuple(np.concatenate(x) for x in zip(*out))

    def _compared(self, flat, of, mark, begin, end):
        """Kernel values of the windows flat[begin:end + 1] with a landmark each, where at least LEAST."""
        for k in range(0, len(mark), 65536):
            m, a, n = mark[k:k + 65536], begin[k:k + 65536], (end - begin)[k:k + 65536] + 1
            place = np.arange(WORD)[None, :]
            points = np.where(place < n[:, None], flat[np.minimum(a[:, None] + place, len(flat) - 1)], 0).astype(np.uint32)
            bits = np.where(points > 0, np.uint64(1) << (points % 61).astype(np.uint64), np.uint64(0))
            close = (n >= 3) & (np.bitwise_count(np.bitwise_or.reduce(bits, axis=1) & self.sets[m]) >= self.need[m])
            m, a, n, points = m[close], a[close], n[close], points[close]
            # a word's own letter pairs give many equal windows: each is compared once
            distinct, back = np.unique(np.column_stack((m.astype(np.uint32), points)), axis=0, return_inverse=True)
            m0, own = distinct[:, 0].astype(np.int64), distinct[:, 1:]
            size = (own > 0).sum(axis=1)
            norm = np.sqrt(np.maximum(kernels(own, np.where(own == 0, 1, own)[:, :WORD], size, cut=True), 1e-12))
            got = (kernels(own, self.points[m0], size) / (norm * self.norm[m0]))[back.ravel()]
            hot = got >= LEAST
            yield of[a[hot]], m[hot], got[hot].astype(np.float32)


# --------------------------------------------------------------- sentences


class Sentences:
    """The words of a batch of texts as units (letters only, lower case), by sentence and text."""

    def __init__(self, texts: pa.Array):
        lines = pc.replace_substring(pc.utf8_lower(texts), "\n", " . ")
        words, codes, ends = word_codes(lines)
        stops = np.asarray(pc.match_substring_regex(words, r"[.!?][^\pL]*$"), dtype=bool)
        units = pc.replace_substring_regex(words, r"[^\pL]+", "")
        size = np.asarray(pc.utf8_length(units), dtype=np.int64)
        text = np.repeat(np.arange(len(texts)), np.diff(ends))
        stop = stops[codes] if len(codes) else np.zeros(0, bool)
        stop[ends[1:][np.diff(ends) > 0] - 1] = True  # a sentence ends with its text
        sentence = np.cumsum(stop) - stop
        single = size[codes] == 1 if len(codes) else np.zeros(0, bool)
        extra, at = self._runs(single, text, codes, units)
        code = np.concatenate((codes, np.arange(len(extra)) + len(units)))
        place = np.concatenate((np.arange(len(codes)), at)).astype(np.int64)
        units = pa.concat_arrays([units.cast(pa.large_string()), pa.array(extra, pa.large_string())])
        distinct = pc.dictionary_encode(units)
        self.units, unit_of = distinct.dictionary, np.asarray(distinct.indices, dtype=np.int64)
        self.code = unit_of[code] if len(code) else code
        self.sentence = sentence[place] if len(place) else place
        self.text = text[place] if len(place) else place
        self.texts = len(texts)

    @staticmethod
    def _runs(single, text, codes, units):
        """Runs of single letters ("i d i o t") as further units, each whole."""
        out, at = [], []
        if single.any():
            run = np.cumsum(np.concatenate(([True], (np.diff(single) != 0) | (np.diff(text) != 0))))
            starts = np.flatnonzero(np.concatenate(([True], np.diff(run) > 0)))
            ends = np.append(starts[1:], len(run))
            wanted = np.flatnonzero(single[starts] & (ends - starts >= RUN))
            letters = dict(zip(np.flatnonzero(pc.equal(pc.utf8_length(units), 1)).tolist(),
                               units.filter(pc.equal(pc.utf8_length(units), 1)).to_pylist())) if len(wanted) else {}
            for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist()):
                out.append("".join(letters[c] for c in codes[a:b].tolist()))
                at.append(a)
        return out, at

    def features(self, marks: Landmarks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sentence, its text, per landmark the largest kernel value of its units), where any is not zero."""
        hot, values = marks.values(self.units)
        row = np.full(len(self.units), -1, np.int64)
        row[hot] = np.arange(len(hot))
        at = np.flatnonzero(row[self.code] >= 0) if len(self.code) else np.zeros(0, np.int64)
        at = at[np.argsort(self.sentence[at], kind="stable")]
        if len(at) == 0:
            return at, at, np.zeros((0, len(marks.words)), np.float32)
        starts = np.flatnonzero(np.concatenate(([True], np.diff(self.sentence[at]) > 0)))
        pooled = np.empty((len(starts), len(marks.words)), np.float32)
        ends, k = np.append(starts[1:], len(at)), 0
        while k < len(starts):  # whole sentences, about OCCURRENCES units at a time
            last = max(k + 1, int(np.searchsorted(ends, starts[k] + OCCURRENCES, side="right")))
            part = at[starts[k]:ends[last - 1]]
            pooled[k:last] = np.maximum.reduceat(values[row[self.code[part]]], starts[k:last] - starts[k], axis=0)
            k = last
        return self.sentence[at[starts]], self.text[at[starts]], pooled


# ---------------------------------------------------------------- training


def without_copies(texts: list[str], sketch: int = 16) -> list[str]:
    """Texts that share less than half of a sketch (their smallest word hashes) with an earlier one.

    Copies of one text would make its own words look typical of the class.
    """
    chosen, holders = [], {}
    words, codes, ends = word_codes(texts_of(pa.array(texts, pa.large_string())))
    ranks = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words.to_pylist()], np.int64)
    for k, text in enumerate(texts):
        least = np.unique(ranks[codes[ends[k]:ends[k + 1]]])[:sketch].tolist()
        met = Counter(x for r in least for x in holders.get(r, ()))
        if not least or max(met.values(), default=0) * 2 < len(least):
            chosen.append(text)
            for r in least:
                holders.setdefault(r, []).append(k)
    return chosen


def _evidence(bad, good, n_bad: int, n_good: int):
    """Likelihood ratio statistic of (bad, good) document counts, where bad is at least 8 times as usual."""
    both = bad + good
    odds = [x * np.log(np.maximum(x, 1e-9) * (n_bad + n_good) / np.maximum(both * n, 1e-9))
            for x, n in ((bad, n_bad), (good, n_good))]
    often = bad * (n_good + 1) >= 8 * (good + 0.5) * n_bad
    return np.where(often, 2 * (odds[0] + odds[1]), 0.0)


def candidate_words(toxic: Sentences, clean: Sentences) -> tuple[list[str], float]:
    """(words that toxic texts may have far more often, by their counts of texts; the evidence that makes one sure)."""
    def counts(part: Sentences) -> Counter:
        pairs = np.unique(np.stack((part.text, part.code)), axis=1)
        n = np.bincount(pairs[1], minlength=len(part.units))
        return Counter({w: int(c) for w, c in zip(part.units.to_pylist(), n) if c > 0 and 3 <= len(w) <= MARK})

    bad, good = counts(toxic), counts(clean)
    words = sorted(w for w, n in bad.items() if n > 1)
    gain = _evidence(np.array([bad[w] for w in words], float), np.array([good[w] for w in words], float),
                     toxic.texts, clean.texts)
    order = np.lexsort((np.arange(len(words)), -gain))
    return [words[k] for k in order if gain[k] > 6], sure_evidence(bad + good, toxic.texts, clean.texts)


def sure_evidence(counts: Counter, n_bad: int, n_good: int) -> float:
    """The statistic that all words together reach by accident with probability SURE at most.

    Each word is tested twice (alone, with its variants). Words too rare to reach the statistic even
    if only toxic texts had them are no tests (Tarone 1990).
    """
    most = np.sort(2 * np.array(list(counts.values()), float) * np.log((n_bad + n_good) / max(1, n_bad)))
    low, high = 0.0, 100.0
    while high - low > 1e-6:
        least = (low + high) / 2
        tests = 2 * max(1, len(most) - int(np.searchsorted(most, least)))
        if NormalDist().inv_cdf(SURE / tests) ** 2 > least:  # a square of a normal variable, one side
            low = least
        else:
            high = least
    return high


def telling(values: tuple, n_bad: int, n_good: int, least_gain: float) -> np.ndarray:
    """Which candidates tell toxic texts apart, by themselves or together with their near variants.

    values: for both classes the text of each sentence and its pooled kernel values.
    """
    gains = []
    for least in (NEAR, SAME):
        counts = []
        for text, x in values:
            sentence, word = np.nonzero(x >= least)
            per_text = np.unique(np.stack((text[sentence], word)), axis=1)
            counts.append(np.bincount(per_text[1], minlength=x.shape[1]).astype(float))
        gains.append(_evidence(*counts, n_bad, n_good))
    return np.flatnonzero(np.maximum(*gains) > least_gain)


def _gram(words: list[str], marks: Landmarks) -> np.ndarray:
    """Normalised kernel of the landmark words with each other."""
    n, points = len(words), letters_of(words, WORD, 0)
    kernel = [kernels(np.repeat(points[k:k + 1], n, axis=0), marks.points, np.full(n, len(words[k]))) for k in range(n)]
    return np.array(kernel).reshape(n, n) / np.outer(marks.norm, marks.norm)


def pick_landmarks(words: list[str], most: int | None = None) -> list[str]:
    """Pivoted Cholesky on the kernel of the words: each pivot is the word worst explained so far.

    Ends when all words are explained, or at most landmarks.
    """
    if not words:
        return []
    marks = Landmarks(words)
    n, kernel = len(words), _gram(words, marks)
    left, rows, chosen = np.ones(n), [], []
    while len(chosen) < (n if most is None else min(most, n)) and left.max() > 0.2:
        p = int(np.argmax(left))
        row = (kernel[p] - sum(r[p] * r for r in rows)) / np.sqrt(left[p]) if rows else kernel[p].astype(float)
        rows.append(row)
        left = np.maximum(left - row**2, 0)
        left[p] = 0
        chosen.append(words[p])
    return chosen


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, squared_hinge: bool, ridge: float) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge) or a logistic fit, by damped Newton steps."""
    x = np.column_stack((x, np.ones(len(x)))).astype(float, copy=False)
    w, weighted = np.zeros(x.shape[1]), np.empty_like(x)
    penalty = np.full(len(w), ridge)
    penalty[-1] = ridge / 100
    for _ in range(60):
        margin = y * (x @ w)
        if squared_hinge:
            slack = np.maximum(0, 1 - margin)
            grad, curve = -2 * weight * y * slack, 2 * weight * (slack > 0)
        else:
            p = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
            grad, curve = -weight * y * p, weight * p * (1 - p) + 1e-9
        step = np.linalg.solve(np.multiply(x, curve[:, None], out=weighted).T @ x + np.diag(penalty + 1e-9), x.T @ grad + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """Model from up to train_docs whole texts of either class (the ones held out are never used).

    Words that tell toxic texts apart, together with their near variants, mark the toxic sentences.
    There are as many as the evidence makes sure, and as many landmarks as their kernel needs. All sentences of clean texts are clean. The SVM is linear on the Nystroem map of the pooled kernel values. Its document
    score, the largest of the sentences, is turned into a probability by a logistic fit.

    The sample is bounded, so one task trains on it; only the chosen ids and the model pass the driver.
    """
    names, chosen = sample_ids(labels.select("doc_id", F.col("toxic").cast("int").alias("label")), train_docs)

    def trained(batches):
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        model = train_texts(by_label(rows, names, chosen))
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = texts_with(docs, chosen).repartition(1).mapInArrow(trained, "model binary").collect() if chosen else []
    return pickle.loads(found[0].model) if found else train_texts({})


def train_texts(texts: dict[object, list[str]]) -> dict:
    """The model of texts by label, 1 and 0."""
    texts = {k: without_copies(texts.get(k, [])) for k in (1, 0)}
    toxic, clean = (Sentences(texts_of(pa.array(texts[k], pa.large_string()))) for k in (1, 0))
    return train_on(toxic, clean)


def train_on(toxic: Sentences, clean: Sentences) -> dict:
    """The model of both classes' sentences."""
    words, least_gain = candidate_words(toxic, clean)
    empty = {"words": [], "weights": [], "bias": 0.0, "fit": (0.0, -4.0)}
    sure, marked = [], [np.zeros(0, np.int64)]
    for k in range(0, len(words), AT_ONCE):
        part = words[k:k + AT_ONCE]
        marks = Landmarks(part)
        (sentence, bad_text, bad), (_, good_text, good) = toxic.features(marks), clean.features(marks)
        own = telling(((bad_text, bad), (good_text, good)), toxic.texts, clean.texts, least_gain)
        sure += [part[i] for i in own]
        marked.append(sentence[(bad[:, own] >= NEAR).any(axis=1)])
    chosen = pick_landmarks(sure)
    if not chosen:
        return empty
    marked = np.unique(np.concatenate(marked))
    spoilt = Sentences(pa.array([w[:k] + c + w[k:] for w in chosen for k in range(1, len(w)) for c in INSERTED],
                                pa.large_string()))
    parts, model = (toxic, clean, spoilt), None
    for further in (0, max(AGAINST, len(chosen) // 2)):
        if further:  # clean words that come nearest to an insult are landmarks as well
            hot, values = marks.values(clean.units)
            score = values @ np.array(model["weights"])
            nearest = hot[np.argsort(-score, kind="stable")[:further * 8]]
            words = [w for w in clean.units.take(pa.array(nearest)).to_pylist() if len(w) <= MARK]
            chosen = chosen + [w for w in pick_landmarks(words, further) if w not in chosen]
            marks = Landmarks(chosen)
        model = _fit(parts, marks, marked)
    return model


def _fit(parts: tuple, marks: Landmarks, marked: np.ndarray) -> dict:
    """SVM on sentences (those of toxic texts that are marked, all of the others), logistic fit on texts.

    parts: toxic, clean, and the landmark insults with a letter put in, which count as toxic too.
    """
    value, vector = np.linalg.eigh(_gram(marks.words, marks))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T  # the Nystroem map
    (own, _, bad), (_, _, good), (_, _, put) = (part.features(marks) for part in parts)
    bad = bad[np.isin(own, marked)]
    plain = np.zeros((max(1, len(good)), len(marks.words)))  # sentences near no landmark
    x = [np.concatenate((bad, put, good, plain)) @ root]
    sizes = [len(bad), len(put), len(good) + len(plain)]
    del bad, put, good, plain
    y = np.repeat([1.0, 1.0, -1.0], sizes)
    weight = np.repeat([0.25 / max(1, sizes[0]), 0.25 / max(1, sizes[1]), 0.5 / max(1, sizes[2])], sizes) * len(y)
    w = _newton(x.pop(), y, weight, True, 1.0)
    model = {"words": marks.words, "weights": (root @ w[:-1]).tolist(), "bias": float(w[-1])}
    best = [document_scores(part, marks, model) for part in parts]
    sizes = [len(b) for b in best]
    y = np.repeat([1.0, -1.0, 1.0], sizes)
    weight = np.repeat([1.0, 1.0, 0.25 * sizes[0] / max(1, sizes[2])], sizes)
    fit = _newton(np.concatenate(best)[:, None], y, weight, False, 0.05)
    return model | {"fit": (float(fit[0]), float(fit[1]))}


def document_scores(sentences: Sentences, marks: Landmarks, model: dict) -> np.ndarray:
    """The largest sentence score of each text; a text of plain sentences has the bias."""
    _, text, x = sentences.features(marks)
    scores = np.full(sentences.texts, model["bias"])
    np.maximum.at(scores, text, x @ np.array(model["weights"]) + model["bias"])
    return scores


def _score(batches, model: dict):
    marks = Landmarks(model["words"]) if model["words"] else None
    slope, shift = model["fit"]
    for batch in batches_of(batches, 4 << 20):
        if marks is None:
            scores = np.zeros(batch.num_rows)
        else:
            scores = document_scores(Sentences(texts_of(batch.column(1))), marks, model)
        p = 1 / (1 + np.exp(-np.clip(slope * scores + shift, -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score), one row per row of docs (doc_id, text): the probability that the text is toxic.

    Units are words reduced to their letters and runs of single letters, whole, so dots, stars or
    blanks between the letters of an insult vanish and other letters put in only cost kernel value.
    A unit that is too long for a landmark is read by windows around the landmark's letter pairs. A sentence's features are the largest values of the gapped
    three-letter subsequence kernel between its units and each landmark; a text's score is its
    worst sentence's, over the whole text.

    Null and empty texts have no words and score like any text without insults. Null and repeated
    doc_ids pass through; other columns are ignored. Without a usable label every score is the same.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda it: _score(it, model), "doc_id long, score double")


def _clean(batches, model: dict, threshold: float, text: int):
    for batch in batches_of(batches, 4 << 20):
        narrow = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(text)], names=["doc_id", "text"])
        for scored in _score([narrow], model):
            rows = np.asarray(scored.column(0))[np.asarray(scored.column(1)) < threshold]
            yield batch.take(pa.array(rows, pa.int64()))


def clean_documents(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text scores below the threshold, with all their columns, in one pass."""
    text = docs.columns.index("text")
    return docs.mapInArrow(lambda it: _clean(it, model, threshold, text), docs.schema)
