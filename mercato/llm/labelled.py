"""Bounded, deterministic training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, mod 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sample_ids(labels: DataFrame, per_class: int) -> tuple[list, dict[int, object]]:
    """(labels in order, doc_id -> label) of up to per_class documents with each label, by the smallest hash of their id.

    labels has (doc_id, label). One bounded top-k per label on the narrow table.
    """
    usable = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").where(~held_out())
    names = sorted(r.label for r in usable.select("label").distinct().collect())
    chosen = {}
    for name in names:
        top = (usable.where(F.col("label") == name).select("doc_id").distinct()
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        chosen |= {r.doc_id: name for r in top.collect()}
    return names, chosen


def texts_with(docs: DataFrame, ids) -> DataFrame:
    """(doc_id, text) of the rows with these ids, null text as empty, in one scan."""
    return docs.where(F.col("doc_id").isin(list(ids))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def by_label(rows, names: list, chosen: dict[int, object]) -> dict[object, list[str]]:
    """label -> texts of (doc_id, text) rows, in the order of their ids."""
    out: dict[object, list[str]] = {name: [] for name in names}
    for doc_id, text in sorted(rows):
        out[chosen[doc_id]].append(text)
    return out


def sample_texts(docs: DataFrame, labels: DataFrame, per_class: int) -> dict[object, list[str]]:
    """label -> whole texts of the documents that sample_ids chooses. The driver holds per_class texts per label."""
    names, chosen = sample_ids(labels, per_class)
    return by_label(map(tuple, texts_with(docs, chosen).collect()) if chosen else [], names, chosen)
