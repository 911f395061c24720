"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.labelled import sample_texts
from mercato.llm.words import batches_of, texts_of, worker_cache

TRAIN_DOCS = 40
CHUNK = 512
NONE = "und"


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)
    return cache["letters"]


def code_points_as_they_are(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def code_points(text: str) -> np.ndarray:
    return code_points_as_they_are(text.lower())


class Alphabet:
    """Every letter of the training texts -> its symbol; other letters -> the last; runs of other characters -> one 0."""

    def __init__(self, letters: str):
        self.size = len(letters) + 2
        self.table = np.where(letter_table(), self.size - 1, 0).astype(np.int32)
        self.table[code_points_as_they_are(letters)] = np.arange(1, self.size - 1)

    def symbols(self, text: str) -> np.ndarray:
        out = self.table[code_points(text)]
        return out[np.concatenate(([True], (out[1:] != 0) | (out[:-1] != 0)))] if len(out) else out


def suffix_automaton(symbols: np.ndarray) -> tuple[int, np.ndarray]:
    """(states, (edges, 3) from, symbol, to) of the suffix automaton (Blumer et al. 1985); the root is 0."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = clone
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
        last = new
    sizes = np.fromiter(map(len, go), np.int64, len(go))
    edges = np.empty((sizes.sum(), 3), np.int64)
    edges[:, 0] = np.repeat(np.arange(len(go)), sizes)
    edges[:, 1] = np.fromiter((c for e in go for c in e), np.int64, len(edges))
    edges[:, 2] = np.fromiter((s for e in go for s in e.values()), np.int64, len(edges))
    return len(go), edges


class Transitions:
    """Hash table (open addressing) from state and symbol to the next state, for arrays of them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot, rest = self._slots(keys), np.arange(len(keys))
        while len(rest):  # the first key that comes to a free slot has it, the others go on
            free = rest[self.keys[slot[rest]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            rest = rest[self.keys[slot[rest]] != keys[rest]]
            slot[rest] = (slot[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def next(self, keys: np.ndarray) -> np.ndarray:
        """The next states; -1 where there is no transition."""
        slot = self._slots(keys)
        found, out = self.keys[slot], self.values[slot]  # the value of a free slot is -1
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            found, out[rest] = self.keys[slot[rest]], self.values[slot[rest]]
            rest = rest[(found != keys[rest]) & (found >= 0)]
        return out


class CrossParser:
    """Phrases of a text over each language's automaton: every phrase is a longest match.

    The transitions of all automata lie in one hash table, those of the roots in a dense one. At a
    step without a transition the open phrase ends; a symbol that does not occur in the language is a
    phrase of its own.
    """

    def __init__(self, model: dict):
        self.languages = list(model["symbols"])
        self.alphabet = Alphabet(model["letters"])
        keys, values, roots, base = [], [], [], 0
        self.starts = np.full((len(self.languages), self.alphabet.size), -1, np.int64)
        for k, symbols in enumerate(model["symbols"].values()):
            states, edges = suffix_automaton(np.frombuffer(symbols, np.int32))
            roots.append(base)
            keys.append((edges[:, 0] + base) * self.alphabet.size + edges[:, 1])
            values.append(edges[:, 2] + base)
            root = edges[edges[:, 0] == 0]
            self.starts[k, root[:, 1]] = root[:, 2] + base
            base += states
        self.transitions = Transitions(np.concatenate(keys), np.concatenate(values))
        self.roots = np.array(roots, np.int64)[:, None]
        # a phrase is a pointer into the training text
        self.bits = np.log2([max(2, len(s) // 4) for s in model["symbols"].values()])[:, None]

    def _step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(new states, phrases that end) for (languages, lanes) states and one symbol per lane."""
        n = len(symbol)
        new = self.transitions.next((state * self.alphabet.size + symbol).ravel()).astype(np.int64)
        ended = np.flatnonzero(new < 0)
        of, where = ended // n, ended % n
        start, root = self.starts[of, symbol[where]], self.roots[of, 0]
        count = np.zeros(len(new), np.int32)
        count[ended] = (state[of, where] != root).astype(np.int32) + (start < 0)
        new[ended] = np.where(start >= 0, start, root)
        return new.reshape(state.shape), count.reshape(state.shape)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """((languages, texts) phrase counts, whether each text has a letter).

        Texts are parsed whole. To go in step they are cut into chunks of CHUNK symbols, each parsed
        from the root first. Then every chunk is parsed again from the state in which the one before
        it ends, beside the first parse, until both are in one state: from there on they agree.
        """
        symbols = [self.alphabet.symbols(t) for t in texts]
        sizes = np.array([len(s) for s in symbols], np.int64)
        has_letter = np.array([bool(s.any()) for s in symbols], bool)
        pieces = -(-sizes // CHUNK)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.concatenate(([0], np.cumsum(sizes)))[:-1][owner] + nth * CHUNK
        length = np.minimum(CHUNK, sizes[owner] - nth * CHUNK)
        flat = np.concatenate(symbols) if symbols else np.zeros(0, np.int32)
        count, end = self._from_root(flat, begin, length)
        own_end, todo = end.copy(), np.flatnonzero(nth > 0)
        correction = np.zeros_like(count)
        while len(todo):
            found, state = self._carried(flat, begin[todo], length[todo], end[:, todo - 1], own_end[:, todo])
            changed = todo[(state != end[:, todo]).any(axis=0)]
            correction[:, todo], end[:, todo] = found, state
            todo = changed[(changed + 1 < len(owner))] + 1  # the next chunk starts in another state than thought
            todo = todo[nth[todo] > 0]
        total = np.zeros((len(self.languages), len(texts)), np.int64)
        last = np.flatnonzero(np.diff(owner, append=-1) != 0)
        for k in range(len(self.languages)):
            total[k] = np.bincount(owner, weights=count[k] + correction[k], minlength=len(texts))
            total[k, owner[last]] += end[k, last] != self.roots[k, 0]  # the phrase that ends with the text
        return total, has_letter

    def _from_root(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases that end inside, state at the end) of chunks parsed from the root, longest first in step."""
        order = np.argsort(-length, kind="stable")
        start, size = begin[order], length[order]
        alive = np.searchsorted(-size, -np.arange(CHUNK), side="left")  # chunks longer than each step
        state = np.repeat(self.roots, len(order), axis=1)
        count = np.zeros(state.shape, np.int32)
        for step, n in enumerate(alive.tolist()):
            if n == 0:
                break
            state[:, :n], found = self._step(state[:, :n], flat[start[:n] + step])
            count[:, :n] += found
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return count[:, back], state[:, back]

    def _carried(self, flat, begin, length, state, own_end) -> tuple[np.ndarray, np.ndarray]:
        """(phrases more than from the root, state at the end) of chunks that start in the given states."""
        more, end = np.zeros(state.shape, np.int32), own_end.copy()
        lanes, fresh = np.arange(len(begin)), np.repeat(self.roots, len(begin), axis=1)
        for step in range(CHUNK):
            going = (state != fresh).any(axis=0)
            out = going & (step == length[lanes])
            end[:, lanes[out]] = state[:, out]
            going &= ~out
            lanes, state, fresh = lanes[going], state[:, going], fresh[:, going]
            if not len(lanes):
                return more, end
            symbol = flat[begin[lanes] + step]
            (state, found), (fresh, other) = self._step(state, symbol), self._step(fresh, symbol)
            more[:, lanes] += found - other
        end[:, lanes] = state  # chunks of CHUNK symbols
        return more, end


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """Per language the symbols of up to train_docs whole labelled texts."""
    texts = sample_texts(docs, docs.select("doc_id", F.col("lang").alias("label")), train_docs)
    return model_of({lang: " ".join(t) for lang, t in texts.items()})


def model_of(texts: dict[str, str]) -> dict:
    """The model of one training text per language: all letters seen, and each text's symbols."""
    letters = "".join(sorted({c for text in texts.values() for c in text.lower() if c.isalpha()}))
    alphabet = Alphabet(letters)
    symbols = {lang: alphabet.symbols(text) for lang, text in sorted(texts.items())}
    return {"letters": letters, "symbols": {lang: s.tobytes() for lang, s in symbols.items() if s.any()}}


def _predict(batches, model: dict):
    cache = worker_cache()
    key = ("cross-parser", model["letters"], tuple(model["symbols"].items()))
    if model["symbols"] and cache.get("parser-key") != key:
        cache["parser-key"], cache["parser"] = key, CrossParser(model)
    for batch in batches_of(batches, 4 << 20):
        texts = texts_of(batch.column(1)).to_pylist()
        if not model["symbols"]:
            languages, scores = [NONE] * len(texts), [0.0] * len(texts)
        else:
            parser = cache["parser"]
            total, has_letter = parser.phrases(texts)
            cost = total * parser.bits
            best = np.argmin(cost, axis=0)
            score = 1.0 / np.exp(-(cost - cost.min(axis=0)) / parser.bits.mean()).sum(axis=0)
            languages = [parser.languages[b] if ok else NONE for b, ok in zip(best, has_letter)]
            scores = np.where(has_letter, score, 0.0).tolist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                                         names=["doc_id", "lang_pred", "score"])


def identify_languages(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of docs (doc_id, text).

    Each text is cut into the fewest phrases that occur in a language's training text (longest
    matches, found by its suffix automaton). The language with the least phrases times bits per
    phrase (log2 of its training length) wins, the first by name on a tie. score is the share of
    exp(-phrases) that the winner has among the languages. Case and non-letters don't matter.

    Null texts and texts without a letter are `und` with score 0, as are all texts if nothing was
    learned. Texts of any length are parsed whole. Null and repeated doc_ids pass through. Other
    columns are ignored. An empty table gives no rows.
    """
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _predict(it, model), "doc_id long, lang_pred string, score double")
