"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from mercato.llm.words import batches_of, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O",) + KINDS
WINDOW = 1  # neighbours whose shapes are features
CELLS = 1 << 20  # runs times tokens that are decoded in step

# Fixed patterns of the contract
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @, dotted domain; linear also in texts full of @ or letters."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then by kind."""
    out = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if HAS_DIGIT.search(text):
        for m in IP.finditer(text):
            # nine digits can only be a number over 255 or one with many leading zeros
            if all(int(p.lstrip("0")[:9] or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 37:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


HAS_DIGIT = re.compile("[0-9]")

# ------------------------------------------------------------------ features

_SHAPE = (("[0-9]", "9"), ("[A-Z]", "X"), (r"[^\x00-\x7f]", "u"), ("[a-z]", "x"))


def shapes(words: pa.Array) -> pa.Array:
    """Word shapes: character classes (9 X x u, others as they are), runs of letters cut to one."""
    for pattern, sign in _SHAPE:
        words = pc.replace_substring_regex(words, pattern, sign)
    for sign in "Xxu":
        words = pc.replace_substring_regex(words, sign + "+", sign)
    return words


def shape_features(shape: str) -> list[str]:
    """Features that follow from a word's shape alone."""
    core = shape.strip(".,;:!?\"'")
    return ["s=" + core[:24], "d=" + str(min(shape.count("9"), 20)), "c=" + "".join(sorted(set(shape)))[:12],
            "9=" + re.sub("9+", "9", core)[:16]]


def plain_words(words: pa.Array) -> pa.Array:
    """Words as the word feature has them: lower case, without outer punctuation."""
    return pc.ascii_lower(pc.utf8_trim(words, ".,;:()[]"))


# ------------------------------------------------------------------ training


def labelled_table(rows: int = 900, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: token sequences with a label per token, made by rule from templates.

    Written-out and spaced forms that the fixed patterns miss are labelled, and so are the plain
    ones; numbers of other kinds (counts, years, versions, hashes, keys, dates, prices) are not.
    """
    rng = np.random.default_rng(seed)
    syllables = "the an er on re th ti ha st in es de la que ou und ein der para con pour é ñ ó ß ü è".split()

    def word():
        return "".join(rng.choice(syllables, rng.integers(1, 4)))

    def dressed():
        """A plain word as running text has it."""
        out = word()
        out = out.upper() if rng.random() < 0.08 else out.capitalize() if rng.random() < 0.15 else out
        return out + rng.choice(["", "", "", "", ",", ".", "", "!!", "***", "&&&", "...", "%%%", "$$$", "###", ":", ".***"])

    def digits(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def octet():
        return str(rng.integers(1, 256))

    def email():
        user, host, end = word() + rng.choice(["", ".", "_"]) + digits(2), "mail" + digits(1), rng.choice(["com", "org", "net"])
        return rng.choice([f"{user}@{host}.example.{end}", f"{user} at {host} dot {end}", f"{user} [at] {host} [dot] {end}",
                           f"{user} (at) {host} (dot) {end}", f"{user}(at){host}.{end}", f"{user}[at]{host}[dot]{end}"])

    def ip():
        return rng.choice([".", " . ", "[.]", ". "]).join(octet() for _ in range(4))

    def card():
        sep = rng.choice(["", " ", "-", ".", "  "])
        return sep.join("4" + digits(3) if k == 0 else digits(4) for k in range(4))

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001 {a} {b} {c}", f"+49 {a} {b}{c}"])

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}

    def other():
        return rng.choice([digits(rng.integers(1, 5)), digits(6) + "ab" + digits(5), "v" + digits(1) + "." + digits(1) + "." + digits(1),
                           "20" + digits(2) + "-0" + digits(1) + "-1" + digits(1), "$" + digits(3) + "." + digits(2), "AKIA" + digits(4) + "ZX",
                           "password=" + digits(4) + "ab" + digits(3), digits(2) + ":" + digits(2), word() + digits(2), digits(9), "at", "dot",
                           digits(3) + " " + digits(3), digits(1) + "." + digits(2)])

    table = []
    for k in range(rows):
        tokens, labels = [], []
        for _ in range(rng.integers(1, 4)):
            for plain in [dressed() for _ in range(rng.integers(0, 8))]:
                tokens.append(plain)
                labels.append("O")
            kind = rng.choice(KINDS) if rng.random() < 0.6 else "O"
            own = (makers[kind]() if kind != "O" else str(other())).split()
            tokens += own
            labels += [kind] * len(own)
        tokens.append(word())
        labels.append("O")
        table.append((tokens, labels))
    return table


def sequence_features(tokens: list[str]) -> list[list[str]]:
    """Per token its own features and its neighbours' shapes."""
    marks = shapes(pa.array(tokens, pa.large_string())).to_pylist()
    plain = plain_words(pa.array(tokens, pa.large_string())).to_pylist()
    own = [shape_features(s) + ["w=" + p] for s, p in zip(marks, plain)]
    return [own[k] + [f"{d}{f}" for d in (-1, 1) if 0 <= k + d < len(tokens) for f in own[k + d]] for k in range(len(tokens))]


def train(table: list[tuple[list[str], list[str]]] | None = None, rounds: int = 8, rate: float = 0.3,
          decay: float = 1e-4, seed: int = 3) -> dict:
    """Feature and transition weights by stochastic gradient ascent on the log-likelihood (forward-backward)."""
    rng, n = np.random.default_rng(seed), len(LABELS)
    data = [(sequence_features(tokens), [LABELS.index(x) for x in labels]) for tokens, labels in table or labelled_table()]
    names = {f: k for k, f in enumerate(sorted({f for rows, _ in data for row in rows for f in row}))}
    data = [([[names[f] for f in row] for row in rows], y) for rows, y in data]
    w, t = np.zeros((len(names), n)), np.zeros((n, n))
    for epoch in range(rounds):
        step = rate / (1 + epoch)
        for k in rng.permutation(len(data)):
            rows, y = data[k]
            e = np.array([w[row].sum(axis=0) for row in rows])
            size = len(y)
            forward, back = np.zeros((size, n)), np.zeros((size, n))
            forward[0] = e[0]
            for i in range(1, size):
                forward[i] = e[i] + np.logaddexp.reduce(forward[i - 1][:, None] + t, axis=0)
            for i in range(size - 2, -1, -1):
                back[i] = np.logaddexp.reduce(t + (e[i + 1] + back[i + 1])[None, :], axis=1)
            total = np.logaddexp.reduce(forward[-1])
            single = np.exp(forward + back - total)
            gold = np.eye(n)[y]
            for row, g in zip(rows, gold - single):
                w[row] += step * g
            for i in range(1, size):
                pair = np.exp(forward[i - 1][:, None] + t + (e[i] + back[i])[None, :] - total)
                t -= step * pair
                t[y[i - 1], y[i]] += step
        w *= 1 - decay * len(data) * step
    return {"names": list(names), "weights": w, "transitions": t}


class Tagger:
    """Emissions of whole batches, and Viterbi over the tokens that are in doubt.

    A token whose O score leads every other label by more than the transitions on its two sides can
    make up is O on every best path (else O there would be better). Such tokens cut a text exactly into short runs; only these are decoded, in step.
    """

    def __init__(self, model: dict):
        self.weights = dict(zip(model["names"], model["weights"]))
        t = self.transitions = model["transitions"]
        # what a label can gain at most over O by the transitions on both sides
        sides = [(t[:, k] - t[:, 0]).max() + (t[k] - t[0]).max() for k in range(len(LABELS))]
        self.margin = np.array(sides)[None, 1:]
        known = sorted({n.split("w=")[1] for n in model["names"] if n.lstrip("-1").startswith("w=")})
        self.known = pa.array(known, pa.large_string())
        self.known_scores = np.array([self._score(["w=" + w]) for w in known])

    def _score(self, features: list[str]) -> np.ndarray:
        out = np.zeros((3, len(LABELS)))
        for f in features:
            for d, name in enumerate((f, "1" + f, "-1" + f)):
                if (got := self.weights.get(name)) is not None:
                    out[d] += got
        return out

    def scores(self, words: pa.Array) -> np.ndarray:
        """(distinct words, 3, labels): what a word adds to itself, to the word before, to the word after."""
        coded = pc.dictionary_encode(shapes(words))
        by_shape = np.array([self._score(shape_features(s)) for s in coded.dictionary.to_pylist()])
        out = by_shape[np.asarray(coded.indices, dtype=np.int64)]
        found = pc.index_in(plain_words(words), value_set=self.known)
        hit = np.flatnonzero(np.asarray(found.is_valid()))
        out[hit] += self.known_scores[np.asarray(found.drop_null(), dtype=np.int64)]
        return out

    def tag(self, texts: pa.Array) -> list[list[tuple[int, int, str]]]:
        """Per text the (start, end, kind) runs of tokens with one label, in code points."""
        lists = pc.ascii_split_whitespace(texts)
        ends = np.asarray(lists.offsets, dtype=np.int64)
        coded = pc.dictionary_encode(lists.values.slice(ends[0], ends[-1] - ends[0]))
        ends = ends - ends[0]
        codes = np.asarray(coded.indices, dtype=np.int64)
        out: list[list[tuple[int, int, str]]] = [[] for _ in range(len(texts))]
        if len(codes) == 0:
            return out
        score = self.scores(coded.dictionary)
        text = np.repeat(np.arange(len(texts)), np.diff(ends))
        e = score[codes, 0]
        inside = np.flatnonzero(text[1:] == text[:-1])
        e[inside] += score[codes[inside + 1], 1]
        e[inside + 1] += score[codes[inside], 2]
        doubt = np.flatnonzero((e[:, 1:] + self.margin >= e[:, :1]).any(axis=1))
        if len(doubt) == 0:
            return out
        cut = np.flatnonzero((np.diff(doubt) > 1) | (text[doubt[1:]] != text[doubt[:-1]])) + 1
        runs = np.split(doubt, cut)
        labels = np.zeros(len(codes), np.int64)
        for group in self._grouped(runs):
            for run, path in zip(group, self._viterbi(group, e, text)):
                labels[run] = path
        if labels.any():
            self._collect(labels, text, codes, coded.dictionary, ends, texts, out)
        return out

    @staticmethod
    def _grouped(runs):
        """Runs of about one length together, so that padding stays small; a long one alone."""
        group = []
        for run in sorted(runs, key=len):
            if group and (len(group) == 2048 or (len(group) + 1) * len(run) > CELLS):
                yield group
                group = []
            group.append(run)
        if group:
            yield group

    def _viterbi(self, runs, e, text):
        """Best label paths of the runs, all in step; neighbours inside the text are O."""
        t, n, size = self.transitions, len(runs), max(map(len, runs))
        first = np.array([r[0] for r in runs])
        last = np.array([r[-1] for r in runs])
        length = np.array([len(r) for r in runs])
        before = (first > 0) & (text[np.maximum(first - 1, 0)] == text[first])
        after = (last + 1 < len(text)) & (text[np.minimum(last + 1, len(text) - 1)] == text[last])
        best = e[first] + np.where(before[:, None], t[0][None, :], 0)
        back = np.zeros((size, n, t.shape[0]), np.int8)
        for k in range(1, size):
            live = length > k
            through = best[:, :, None] + t[None, :, :]
            back[k] = through.argmax(axis=1)
            best = np.where(live[:, None], through.max(axis=1) + e[np.minimum(first + k, last)], best)
        best = best + np.where(after[:, None], t[:, 0][None, :], 0)
        paths = np.zeros((n, size), np.int64)
        state = best.argmax(axis=1)
        for k in range(size - 1, -1, -1):
            paths[:, k] = state
            step = (length > k) & (k > 0)
            state = np.where(step, back[k][np.arange(n), state], state)
        return [paths[i, : length[i]] for i in range(n)]

    @staticmethod
    def _collect(labels, text, codes, words, ends, texts, out):
        """Runs of one label -> spans; only texts that have some are searched for the places."""
        for k in np.unique(text[labels > 0]).tolist():
            source, at, token = texts[k].as_py(), 0, []
            for c in codes[ends[k]:ends[k + 1]].tolist():
                word = words[c].as_py()
                at = source.index(word, at)
                token.append((at, at + len(word)))
                at += len(word)
            own, i = labels[ends[k]:ends[k + 1]], 0
            while i < len(own):
                j = i
                while j + 1 < len(own) and own[j + 1] == own[i]:
                    j += 1
                if own[i]:
                    out[k].append((token[i][0], token[j][1], LABELS[own[i]]))
                i = j + 1


PLAUSIBLE = {  # digits that a span of each kind has, at least and at most, and its longest length
    "email": (0, 20, 80), "ip": (4, 12, 30), "card": (14, 19, 45), "phone": (9, 15, 30)}
WRITTEN_EMAIL = re.compile(r"(?i)@.*(\.|\bdot\b)|\bat\b.*(\.\w|\bdot\b)")


EXACT = {  # the usual written forms of one entity
    "email": re.compile(r"(?i)\S+?\s*(@|\(at\)|\[at\]|\bat\b)\s*[^\s@]+(\s*(\.|\bdot\b|\[dot\]|\(dot\))\s*[^\s@]+)*"),
    "ip": re.compile(r"[0-9]{1,3}([^0-9]+[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9]{4}([^0-9]*[0-9]{4}){3}"),
    "phone": re.compile(r"((\+|00)[0-9]{1,3}[^0-9]*|1[^0-9]+)?\(?[0-9]{3}\)?[^0-9]*[0-9]{3}[^0-9]*[0-9]{4}|(\+|00)[^\n]+")}
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def _stripped(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without outer punctuation."""
    while start < end and text[start] in ".,;:!?\"'":
        start += 1
    while end > start and text[end - 1] in ".,;:!?\"'":
        end -= 1
    return start, end


def _cut(text: str, tokens: list[tuple[int, int]], kind: str) -> list[tuple[int, int]]:
    """The plausible spans of a run of tokens of one kind, which may hold several entities.

    Of all ways to cut it, the one that covers the most tokens; then the one with the least line
    ends, commas and semicolons inside a span; then the most tokens in usual forms, the least spans.
    """
    low, high, longest = PLAUSIBLE[kind]
    digits = [sum(c.isdigit() for c in text[a:b]) for a, b in tokens]
    best: list[tuple] = [((0, 0, 0, 0), None)]  # (value, where the last span begins) of the first tokens
    for j in range(1, len(tokens) + 1):
        value, begin = best[j - 1][0], None
        total = breaks = 0
        for i in range(j - 1, -1, -1):
            total += digits[i]
            if i < j - 1:
                between = text[tokens[i][1]:tokens[i + 1][0]]
                breaks += "\n" in between or text[tokens[i][1] - 1] in ",;"
            start, end = _stripped(text, tokens[i][0], tokens[j - 1][1])
            if total > high or end - start > longest:
                break
            if end > start and total >= low and (kind != "email" or WRITTEN_EMAIL.search(text[start:end])):
                n, v = j - i, best[i][0]
                usual = n if EXACT[kind].fullmatch(text[start:end]) else 0
                new = (v[0] + n, v[1] - breaks, v[2] + usual, v[3] - 1)
                if new > value:
                    value, begin = new, i
        best.append((value, begin))
    out, j = [], len(tokens)
    while j > 0:
        begin = best[j][1]
        if begin is not None:
            out.append(_stripped(text, tokens[begin][0], tokens[j - 1][1]))
        j = j - 1 if begin is None else begin
    return out[::-1]


def added_spans(text: str, tagged: list, base: list) -> list[tuple[int, int, str]]:
    """Plausible spans of the tagged runs, without outer punctuation.

    Words that touch a base span are left out, and what lies between them is cut into single
    entities (see _cut).
    """
    out, covered = [], sorted((a, b) for a, b, _ in base)
    merged: list[list[int]] = []
    for a, b in covered:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]
    for start, end, kind in tagged:
        part: list[tuple[int, int]] = []
        for m in TOKEN.finditer(text, start, end):
            k = bisect_left(starts, m.end()) - 1  # the last base span that begins before the word's end
            if k >= 0 and merged[k][1] > m.start():
                out += [(a, b, kind) for a, b in _cut(text, part, kind)]
                part = []
            else:
                part.append(m.span())
        out += [(a, b, kind) for a, b in _cut(text, part, kind)]
    return out


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(batches, model: dict):
    tagger = Tagger(model)
    for batch in batches_of(batches, 4 << 20):
        texts = texts_of(batch.column(1))
        rows = []
        for doc, text, tagged in zip(batch.column(0).to_pylist(), texts.to_pylist(), tagger.tag(texts)):
            base = base_spans(text)
            spans = base + added_spans(text, tagged, base) if tagged else base
            spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            counts = [sum(s[2] == kind for s in base) for kind in KINDS]
            rows.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                         names=[x.split()[0] for x in RESULT.split(", ")])


def find_personal_data(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row of docs.

    The counts and the hash are those of the fixed patterns; spans lists these and what the
    conditional random field adds (spaced or written-out forms), as kind:start:end in code points.
    Its features are a word's shape, digits and characters and those of its neighbours; it is
    trained on labelled_table(). Whole texts are tagged.

    Null and empty texts have no spans. Null and repeated doc_ids pass through; other columns are
    ignored. An empty table gives no rows.
    """
    model = model or train()
    return docs.select("doc_id", "text").mapInArrow(lambda it: _find(it, model), RESULT)
