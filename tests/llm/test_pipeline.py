"""The corpus pipeline on a small folder, stage by stage against plain versions."""
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from mercato.llm import oracle, packing, toxicity
from test_jaccard import brute as brute_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    words = ["".join(rng.choices([a + b for a in "bdfgklmnprstvz" for b in "aeiou"], k=3)) for _ in range(300)]
    footer = "all rights reserved by the house of papers"
    rows = []
    for k in range(240):
        lines = [" ".join(rng.choices(words, k=rng.randrange(6, 40))) for _ in range(rng.randrange(1, 4))]
        if k % 4 == 0:
            lines[0] += " imbecile"
        if k % 3 == 0:
            lines.append("  " + footer.upper() if k % 2 else footer)
        rows.append((k, "\n".join(lines), "en", rng.choice(["a", "b", "b", "b", None]), 0))
    for k in range(1, 60, 4):  # copies, near copies
        rows.append((1000 + k, rows[k][1], "en", "c", 0))
        rows.append((2000 + k, rows[k][1] + " " + words[0], "en", "a", 0))
    rows += [(3000, None, None, None, None), (3001, "", "en", "a", 0), (3001, "", "en", "a", 0), (None, "no id here at all " + words[1], "en", "b", 0)]
    return [(*r[:4], len(r[1] or "")) for r in rows], [(k, 1, int(k % 4 == 0)) for k in range(240)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus()
    spark.createDataFrame(docs, DOCS).coalesce(1).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def plain_lines(docs):
    keys = {}
    for doc, text, *_ in docs:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if len(key) >= 10 and doc is not None:
                keys.setdefault(key, set()).add(doc)
    out = []
    for doc, text, lang, source, n in docs:
        kept = []
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if not (len(keys.get(key, ())) >= 2 and doc != min(keys[key])):
                kept.append(line)
        out.append((doc, "\n".join(kept), lang, source, n))
    return out


def test_stages_are_as_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_whole_pipeline_against_plain_versions(spark, folder):
    docs, labels = corpus()
    got = corpus_pipeline.run(spark, folder).collect()
    clean = [r for r in docs if "imbecile" not in (r[1] or "")]
    lines = plain_lines(clean)
    low = dict(brute_components(lines))
    unique = [r for r in lines if r[0] is None or low[str(r[0])] == str(r[0])]
    documents = pd.DataFrame(unique, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})  # noqa: F841
    taken = duckdb.sql(oracle.MIX).fetchall()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    copies = {r[0]: r[4] // r[1] if r[1] else None for r in taken}
    tokens = packing.tokenizer(packing.vocabulary_path()).slow
    expected = []
    for doc, text, *_ in unique:
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [1]
        if size(text):  # documents without words are drawn or not, they take no words
            expected += [(str(doc), len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))] * copies[doc]
    blank = {str(d) for d, t, *_ in unique if not size(t)}
    assert sorted((str(r.doc_id), r["length"], r.ids_crc32) for r in got if str(r.doc_id) not in blank) == sorted(expected)
    assert len(unique) < len(clean) < len(docs) and expected
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_every_stage_takes_empty_and_extra_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    odd = docs.selectExpr("*", "'x' AS score", "1 AS row", "'y' AS kept_text", "2 AS n_dropped", "3 AS component_id", "'z' AS size")
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, odd, folder)
        assert got.columns == odd.columns and got.count() > 0, name


def test_toxic_documents_go_and_clean_ones_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()}
    assert kept == {(r[0], r[1]) for r in corpus()[0] if "imbecile" not in (r[1] or "")} and toxicity.THRESHOLD == 0.3
