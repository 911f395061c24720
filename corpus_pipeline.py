"""Corpus pipeline: toxicity, line dedup, near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import jaccard, line_dedup, mixing, packing, toxicity
from mercato.session import write_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model of the labels that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean_documents(docs, toxicity.train(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document has; n_chars follows the text."""
    rows = line_dedup.without_repeated_lines(docs)
    changed = {"text": F.col("kept_text").alias("text"),
               "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long"))
               .otherwise(F.col("row.n_chars")).alias("n_chars")}
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    groups = jaccard.jaccard_components(docs.select("doc_id", "text"))
    return docs.join(groups.where("component_id <> doc_id").select("doc_id").distinct(), "doc_id", "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources draws them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("ngram_jaccard", drop_near_duplicates),
          ("mixing", mix), ("packing", pack)]

ORACLE_SQL = None  # the first stage is a trained classifier


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
