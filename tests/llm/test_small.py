import hashlib
import math
import random
import zlib

import pyarrow as pa
import pytest

from mercato.llm import exact, language, line_dedup, mixing, packing, pii, toxicity

SCHEMA = "doc_id long, text string, source string, h string, block int"
ROWS = [(1, "a b c\nThe same long line\nx", "s1", "q", 1), (2, "THE SAME LONG LINE  \nown line of two", "s1", "q", 1),
        (3, None, None, None, None), (4, "", "s2", "q", 1), (5, "a b c\nThe same long line\nx", "s1", "q", 1),
        (5, "a b c\nThe same long line\nx", "s1", "q", 1), (None, "the same long line", "s3", "q", 1), (7, "w " * 30000, "s2", "q", 1)]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_exact_with_and_without_collisions(docs):
    from pyspark.sql import functions as F

    weak = exact.exact_duplicates(docs, "max", digest=lambda c: F.substring(F.md5(c), 1, 2)).collect()
    same = exact.exact_duplicates(docs, "max").collect()
    assert sorted(map(str, weak)) == sorted(map(str, same)) and len(same) == len(ROWS)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in same}
    assert got[1] == (5, 3, False) and got[5] == (5, 3, True) and got[3] == (4, 2, False)


def test_collided_hashes_are_told_apart_by_bytes(docs):
    from pyspark.sql import functions as F

    all_one = exact.exact_duplicates(docs, "max", digest=lambda c: F.lit("ab")).collect()
    assert sorted(map(str, all_one)) == sorted(map(str, exact.exact_duplicates(docs, "max").collect()))


def test_lines_keep_the_smallest_document(docs):
    got = {r.row.doc_id: (r.kept_text, r.n_dropped) for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got[1] == (ROWS[0][1], 0) and got[2] == ("own line of two", 1) and got[5] == ("a b c\nx", 1)
    assert got[None] == ("", 1) and got[3] == (None, 0)


def test_texts_are_not_sorted_to_meet_their_bitmaps(spark, docs):
    rows = line_dedup.without_repeated_lines(docs)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_lines_of_cut_batches(docs, monkeypatch):
    import pyarrow as pa

    table = pa.table({"doc": [1, 2, 3], "text": ["a line that is long\nshort", None, "x" * 40 + "\n" + "A LINE that is long "], "version": [7, 8, 9]})
    whole = [r for b in line_dedup._hash_lines(table.to_batches(), 10) for r in b.to_pylist()]
    monkeypatch.setattr(line_dedup, "BATCH_BYTES", 30)
    parts = list(line_dedup._hash_lines(table.to_batches(), 10))
    assert len(parts) == 3 and [r for b in parts for r in b.to_pylist()] == whole
    assert [(r["doc"], r["version"], r["pos"]) for r in whole] == [(1, 7, 0), (3, 9, 0), (3, 9, 1)]
    assert (whole[0]["hi"], whole[0]["lo"]) == (whole[2]["hi"], whole[2]["lo"])


def test_mix_comes_near_the_targets(spark):
    rng = random.Random(4)
    rows = [(k, "w " * rng.randrange(0, 60), rng.choice(["a", "a", "a", "b", "c", None]), "", 0) for k in range(4000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = [mixing.mix_sources(frame, rows_per_block=n).collect() for n in (300, 300)]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))
    taken, target = {}, {}
    for r in got[0]:
        assert 0 <= r.copies <= 3
        taken[r.row.source] = taken.get(r.row.source, 0) + r["size"] * r.copies
        target[r.row.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in target)
    assert math.isclose(sum(target.values()), sum(r["size"] for r in got[0]))


def test_tokens_and_packing(spark, docs):
    tokens = packing.tokenizer(packing.vocabulary_path())
    odd = ["it's WE'LL <|endoftext|> x", "ÀÉß Ñandú’s 12,5€ İs ΣΑΣ é", "", "a\x1cb  c\t中文 👍 ﬁ ² µ", "foo@bar.com!!! ... 'sx'S"]
    ids, ends = tokens.encode(pa.array(odd, pa.large_string()))
    for k, text in enumerate(odd):
        assert ids[ends[k]:ends[k + 1]].tolist() == tokens.slow.encode(text, add_special_tokens=False).ids
    got = packing.pack_documents(docs, capacity=64, pieces_per_part=50).collect()
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    whole = tokens.slow.encode(ROWS[0][1], add_special_tokens=False).ids + [1]
    first = next(r for r in got if r.doc_id == 1)
    assert first.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in whole)) and first["length"] == len(whole)
    assert sum(r["length"] for r in got if r.doc_id == 3) == 1


def test_lower_bound_never_exceeds_a_packing():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(1, 40, rng.integers(1, 60))
        bins, offsets, used = packing.best_fit_decreasing(lengths, 40)
        assert max(np.bincount(bins, weights=lengths)) <= 40 and packing.lower_bound(lengths, 40) <= used


def test_base_spans():
    text = "a@b.c_d@e.f 300.1.1.1 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111, +1 (555) 123-4567 é x@y"
    assert pii.joined(pii.base_spans(text)) == ("email:0:5,email:5:11,ip:22:29,ip:30:37,card:43:62,phone:64:81")
    assert pii.base_spans("") == [] and pii.emails("@" * 5000 + "a" * 5000) == []


@pytest.fixture(scope="module")
def tagger():
    return pii.Tagger(pii.train())


def added(tagger, text):
    tagged = tagger.tag(pa.array([text], pa.large_string()))[0]
    return [(kind, text[a:b]) for a, b, kind in pii.added_spans(text, tagged, pii.base_spans(text))]


@pytest.mark.parametrize("kind, entries", [
    ("phone", ["(555) 123-4567", "(555) 987-6543", "(212) 555-0199", "(646) 555-0142"]),
    ("phone", ["555-123-4567", "555-987-6543", "212-555-0199"]),
    ("card", ["4111.2222.3333.4444", "4555.6666.7777.8888", "4999.1234.5678.9012"])])
def test_lists_of_neighbours_are_single_spans(tagger, kind, entries):
    for glue in ("\n", " ", ", "):
        assert added(tagger, "la que " + glue.join(entries) + " und der") == [(kind, e) for e in entries]


def test_runs_are_cut_into_entities():
    def cut(text, kind):
        return [text[a:b] for a, b, _ in pii.added_spans(text, [(0, len(text), kind)], pii.base_spans(text))]

    assert cut("555 123 4567 " * 7, "phone") == ["555 123 4567"] * 7
    assert cut("4111 1111 1111 1112 4222 2222 2222 2222 4333 3333 3333 3333", "card") == [
        "4111 1111 1111 1112", "4222 2222 2222 2222", "4333 3333 3333 3333"]
    assert cut("10 . 0 . 0 . 1 10 . 0 . 0 . 2", "ip") == ["10 . 0 . 0 . 1", "10 . 0 . 0 . 2"]
    assert cut("bob at mail dot com ann at host dot org", "email") == ["bob at mail dot com", "ann at host dot org"]
    assert cut("+1 (555) 123-4567, (555) 987-6543", "phone") == ["(555) 987-6543"]  # the first is a base span
    assert cut("12 34", "phone") == []


def test_long_doubtful_runs_are_decoded_whole(tagger, monkeypatch):
    sizes, decode = [], tagger._viterbi
    monkeypatch.setattr(tagger, "_viterbi", lambda runs, e, text: sizes.extend(map(len, runs)) or decode(runs, e, text))
    assert added(tagger, "(555) 123-4567 " * 400) == [("phone", "(555) 123-4567")] * 400
    assert max(sizes) >= 798


def test_language_und_and_learning(spark):
    rows = [(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * 5, "en" if k % 2 else "de") for k in range(40)]
    frame = spark.createDataFrame(rows + [(100, None, "en"), (101, "12 !", "en"), (None, "the dog", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify_languages(frame, language.train(frame)).collect()}
    assert all(got[k].lang_pred == ("en" if k % 2 else "de") for k in range(40))
    assert got[100].lang_pred == got[101].lang_pred == "und" and got[None].lang_pred == "en"


def test_language_learns_from_all_sampled_texts(spark):
    long = [(k, "123 lorem " * 5000, "en" if k % 2 else "de") for k in range(2)]
    rows = [(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * 5, "en" if k % 2 else "de") for k in range(2, 30)]
    frame = spark.createDataFrame(long + rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify_languages(frame, language.train(frame)).collect()}
    assert all(got[k].lang_pred == ("en" if k % 2 else "de") for k in range(2, 30))
    model = language.train(frame)
    assert all(len(s) > 30_000 for s in model["symbols"].values())


def test_rare_letters_are_told_apart():
    rng = random.Random(7)
    scripts = {lang: "".join(rng.sample([chr(c) for c in range(a, a + 3000)], 2500)) for lang, a in (("ja", 0x4E00), ("zh", 0x6000))}
    texts = {"en": "the cat and the dog " * 50, "el": "η γάτα και ο σκύλος " * 50, "ru": "кошка и собака жили были " * 50, **scripts}
    parser = language.CrossParser(language.model_of(texts))
    parts = {lang: [text[k:k + 40] for k in range(0, 600, 60)] for lang, text in texts.items()}
    for lang, own in parts.items():
        total, _ = parser.phrases(own)
        assert [parser.languages[k] for k in (total * parser.bits).argmin(axis=0)] == [lang] * len(own)


def test_kernel_tolerates_inserted_letters():
    marks = toxicity.Landmarks(["idiot"])
    near, values = marks.values(pa.array(["idiot", "idxiot", "table"], pa.large_string()))
    assert near.tolist() == [0, 1] and abs(values[0, 0] - 1) < 1e-5 and 0.4 < values[1, 0] < 1
    units = toxicity.Sentences(pa.array(["you i d i o t!", "an i.d.i.o.t", None or ""], pa.large_string())).units.to_pylist()
    assert units.count("idiot") == 1


@pytest.mark.parametrize("text", [
    "y o u a r e s u c h a n i d i o t", "https://example.org/forum/what-an-idiot-you-are/page/of/many/words",
    "whatanidiotyouare", "you.are.all.the.same.and.he.is.such.an.i.d.i.o.t.as.nobody.saw", "q" * 70000 + "idiot" + "w" * 70000,
    "never.seen.such.an.idxiot.in.all.these.years.that.we.met"])
def test_insults_in_long_units_are_scored(text):
    marks = toxicity.Landmarks(["stupid", "idiot"])
    model = {"words": marks.words, "weights": [2.0, 2.0], "bias": -1.0}
    plain = "the-table-and-the-chairs-are-made-of-wood t h e t a b l e a n d t h e c h a i r s"
    got = toxicity.document_scores(toxicity.Sentences(pa.array([text, plain, "an idiot", "an idxiot", ""], pa.large_string())), marks, model)
    assert got[0] >= got[3 if "idxiot" in text else 2] - 1e-4 and got[1] < -0.2 and got[4] == -1


def test_windows_find_what_single_words_do():
    rng = random.Random(9)
    marks = toxicity.Landmarks(["disgusting", "idiot", "stupid", "moron"])
    for _ in range(40):
        word = rng.choice(marks.words)
        k = rng.randrange(1, len(word))
        word = word[:k] + rng.choice(["", "x", "e"]) + word[k:]
        alone = marks.values(pa.array([word], pa.large_string()))[1][0]
        inside = "".join(rng.choices("bcfhjkqvwz", k=40)) + word + "".join(rng.choices("bcfhjkqvwz", k=40))
        assert (marks.values(pa.array(["table", inside], pa.large_string()))[1][0].max() >= alone.max() - 1e-5)


def test_every_telling_insult_becomes_a_landmark():
    rng = random.Random(2)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    common = ["".join(rng.choices(syllables, k=3)) for _ in range(400)]
    insults = [w for w in dict.fromkeys("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(60)) if w not in common]

    def texts(own):
        return toxicity.Sentences(pa.array([" ".join(rng.choices(common, k=30) + [w] + rng.choices(common, k=30)) for w in own], pa.large_string()))

    toxic, clean = texts(insults * 15 + rng.choices(common, k=100)), texts(rng.choices(common, k=1000))
    model = toxicity.train_on(toxic, clean)
    assert set(insults) <= set(model["words"])
    marks = toxicity.Landmarks(model["words"])
    found = toxicity.document_scores(toxic, marks, model) * model["fit"][0] + model["fit"][1] > 0
    assert found[:len(insults) * 15].mean() > 0.99
    assert (toxicity.document_scores(clean, marks, model) * model["fit"][0] + model["fit"][1] > 0).mean() < 0.02


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(empty).count() == 0 and mixing.mix_sources(empty).count() == 0
    assert line_dedup.without_repeated_lines(empty).count() == 0 and packing.pack_documents(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest()
