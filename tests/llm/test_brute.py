"""Operators that SQL can't express, against plain versions, and as Spark operators on odd tables."""
import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm import language, packing, pii, toxicity
from mercato.llm.labelled import sample_texts
from mercato.llm.words import texts_of

ODD = "doc_id long, text string, lang string, source string, label string, score string, spans string, length string"
ODD_ROWS = [(1, "mail bob@example.org or 10.0.0.1 you idiot", "en", "s", None, "x", None, "1"), (2, None, None, None, None, None, None, None),
            (3, "", "en", "s", "", "", "", ""), (1, "mail bob@example.org or 10.0.0.1 you idiot", "en", "s", None, "x", None, "1"),
            (None, "+1 555 123 4567", "de", None, "a", "b", "c", "d"), (5, "the cat " * 20000, "en", "s", "1", "2", "3", "4")]

# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        odd, even = d[-1::-2], d[-2::-2]
        return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0

    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], ["email", "ip", "card", "phone"].index(s[2])))


def test_base_spans_equal_plain_regexes():
    rng = random.Random(8)
    pieces = ["a@b.c", "x.y@z", "@", ".", "..", "10.0.0.1", "255.255.255.256", "1.2", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 555 123 4567",
              "+1", "(555) 123-4567", "é", "\n", " ", "  ", "-", "00", "7", "49927398716", "0000000000000000", "a_b%c+d@e-f.g-h.i", "+49.(0).30.1234567"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text
    for _ in range(3000):
        text = "".join(rng.choice("0123456789.+- ()@ab") for _ in range(rng.randrange(1, 60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data_on_odd_tables(spark):
    got = pii.find_personal_data(spark.createDataFrame(ODD_ROWS, ODD)).collect()
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == [
        ("1", 1, 1, 0, 0), ("1", 1, 1, 0, 0), ("2", 0, 0, 0, 0), ("3", 0, 0, 0, 0), ("5", 0, 0, 0, 0), ("None", 0, 0, 0, 1)]
    for r in got:
        text = dict((row[0], row[1]) for row in ODD_ROWS)[r.doc_id] or ""
        assert set(pii.joined(plain_spans(text)).split(",")) <= set(r.spans.split(","))  # base spans stay
    assert pii.find_personal_data(spark.createDataFrame([], ODD)).count() == 0


# ------------------------------------------------------------------ toxicity


def plain_kernel(s, t, decay=0.6):
    """All pairs of common subsequences of three letters, decayed by the letters they span."""
    return sum(decay ** (i[2] - i[0] + 1 + j[2] - j[0] + 1)
               for i in itertools.combinations(range(len(s)), 3) for j in itertools.combinations(range(len(t)), 3)
               if all(s[a] == t[b] for a, b in zip(i, j)))


def test_kernel_equals_plain_recursion():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(2))
        got = toxicity.subsequence_kernel(toxicity.letters_of([a], 9, 0), toxicity.letters_of([b], 9, 1))[0]
        assert got == pytest.approx(plain_kernel(a, b), rel=1e-4, abs=1e-6), (a, b)
    # normalised values of short words with a landmark, where the length and letter filters let them pass
    marks = toxicity.Landmarks(["idiot"])
    for word in ("idiot", "idxiot", "iddiot", "i" + "diot" * 2):
        want = plain_kernel(word, "idiot") / (plain_kernel(word, word) * plain_kernel("idiot", "idiot")) ** 0.5
        near, values = marks.values(pa.array([word], pa.large_string()))
        assert (values[0, 0] if len(near) else 0) == pytest.approx(want if want >= toxicity.LEAST else 0, abs=1e-4)


def toxic_tables(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices([a + b for a in "bdfgklmnprstvz" for b in "aeiou"], k=3)) for _ in range(300)]
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        own = rng.choices(words, k=20) + (["imbecile"] if bad else [])
        rng.shuffle(own)
        docs.append((k, " ".join(own) + ".", "en", "s", "x", "y", "z", "1"))
        labels.append((k, 1, int(bad)))
    return spark.createDataFrame(docs + [(k + 1000 if k is not None else None, *r) for k, *r in ODD_ROWS], ODD), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_odd_tables(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    held = {r.doc_id: r.score for r in scored if r.doc_id is not None and r.doc_id < 400}
    assert all((s >= toxicity.THRESHOLD) == (k % 4 == 0) for k, s in held.items())
    empty = {r.doc_id: r.score for r in scored if r.doc_id in (1002, 1003)}
    assert len(empty) == 2 and len(set(empty.values())) == 1 and max(empty.values()) < toxicity.THRESHOLD
    kept = toxicity.clean_documents(docs, model)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in scored if r.score < toxicity.THRESHOLD)
    none = spark.createDataFrame([], ODD)
    assert toxicity.score_toxicity(none, model).count() == toxicity.clean_documents(none, model).count() == 0
    unlearned = toxicity.train(none, labels.limit(0))
    assert len({r.score for r in toxicity.score_toxicity(docs, unlearned).collect()}) == 1


def test_toxicity_is_trained_in_a_task(spark, monkeypatch):
    docs, labels = toxic_tables(spark)

    driver, sentences = os.getpid(), toxicity.Sentences

    def elsewhere(texts):
        assert os.getpid() != driver, "texts are analysed on the driver"
        return sentences(texts)

    monkeypatch.setattr(toxicity, "Sentences", elsewhere)
    model = toxicity.train(docs, labels)
    monkeypatch.undo()
    kind = labels.select("doc_id", F.col("toxic").alias("label"))
    assert model["words"] and model["words"] == toxicity.train_texts(sample_texts(docs, kind, toxicity.TRAIN_DOCS))["words"]


def test_values_are_pooled_in_parts(monkeypatch):
    rng = random.Random(4)
    marks = toxicity.Landmarks(["idiot", "moron", "imbecile"])
    texts = [" ".join(rng.choice(["idiot", "idi0t.", "morons", "plain", "word.", "imbeciles!"]) for _ in range(rng.randrange(0, 60))) for _ in range(50)]
    sentences = toxicity.Sentences(texts_of(pa.array(texts, pa.large_string())))
    whole = sentences.features(marks)
    monkeypatch.setattr(toxicity, "OCCURRENCES", 3)
    assert len(whole[0]) > 100 and all(np.array_equal(a, b) for a, b in zip(whole, sentences.features(marks)))


# ------------------------------------------------------------------ language


def plain_phrases(text, known):
    """Greedy longest matches; a symbol that does not occur is a phrase of its own."""
    n, k = 0, 0
    while k < len(text):
        j = k
        while j < len(text) and text[k:j + 1] in known:
            j += 1
        n, k = n + 1, max(j, k + 1)
    return n


@pytest.mark.parametrize("chunk", [3, 8, 512])
def test_phrases_equal_plain_longest_matches(monkeypatch, chunk):
    monkeypatch.setattr(language, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = {"aa": "".join(rng.choice("abcd ") for _ in range(300)), "bb": "".join(rng.choice("aabce ") for _ in range(200)), "cc": "fgh " * 30}
    parser = language.CrossParser(language.model_of(texts))
    own = ["".join(rng.choice("abcdefgx ") for _ in range(rng.randrange(0, 70))) for _ in range(60)]
    own += [texts["aa"], texts["aa"][40:260] + texts["bb"], "zzz", "", " ", "fgh " * 50, "12 34", "A" * 40]
    total, has_letter = parser.phrases(own)

    def plain(text):  # as the alphabet reads it: lower case, runs of other characters one blank, unknown letters alike
        seen = set("".join(texts.values()))
        return re.sub(r"[^a-z]+", " ", "".join(c if not c.isalpha() or c in seen else "?" for c in text.lower()).replace("?", "z"))

    for k, lang in enumerate(parser.languages):
        assert total[k].tolist() == [plain_phrases(plain(t), plain(texts[lang])) for t in own]
    assert has_letter.tolist() == [any(c.isalpha() for c in t) for t in own]


def test_language_on_odd_tables(spark):
    docs = spark.createDataFrame(ODD_ROWS, ODD)
    got = language.identify_languages(docs, language.train(docs)).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in got)
    assert {str(r.doc_id): r.lang_pred for r in got}["2"] == "und"
    none = spark.createDataFrame([], ODD)
    assert language.identify_languages(none, language.train(docs)).count() == 0
    assert {r.lang_pred for r in language.identify_languages(docs, language.train(none)).collect()} == {"und"}


# ------------------------------------------------------------------ packing


def fewest_bins(lengths, capacity):
    best = [len(lengths)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1:]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best[0]


def test_bounds_and_packing_around_the_optimum():
    rng = np.random.default_rng(2)
    certified = 0
    for _ in range(80):
        lengths = np.sort(rng.integers(3, 21, rng.integers(1, 10)))[::-1]
        bound, (_, _, used) = packing.lower_bound(lengths, 24), packing.best_fit_decreasing(lengths, 24)
        best = fewest_bins(lengths.tolist(), 24)
        assert bound <= best <= used
        certified += bound == used
    assert certified > 40


def test_sequences_of_odd_tables(spark):
    docs = spark.createDataFrame(ODD_ROWS * 20, ODD)
    packed = packing.pack_documents(docs, capacity=256, pieces_per_part=15).cache()
    rows = packed.collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for own in places.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= 256
    assert len({r.doc_id for r in rows}) == 5 and min(places) >= 0
    sure = packing.certificate(packed, 256).first()
    assert sure.sequences == len(places) and sure.bound <= sure.sequences <= 1.02 * sure.bound + 2
    assert sure.bound >= -(-sum(r["length"] for r in rows) // 256)


def test_sequence_ids_do_not_collide(spark):
    grid = spark.range(3).select(F.explode(F.sequence(F.lit(0), F.lit(40))).alias("part"), F.col("id").alias("bin"))
    ids = [r[0] for salt in (0, 1, 2) for r in grid.select(packing._sequence_id(salt, F.col("part"), F.col("bin") * (2 ** 23 - 1))).collect()]
    assert len(set(ids)) == len(ids) == 3 * 41 * 3 and all(i % 2 == 0 for i in ids)
