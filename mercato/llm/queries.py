"""The registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import (embeddings, exact, jaccard, language, line_dedup, mixing, negatives, packing, pii, repeats, toxicity,
                         warc, whitening)
from mercato.llm.labelled import held_out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def op2_embedding_neardup(spark, sf_dir):
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"))


def op3_personal_data(spark, sf_dir):
    return pii.find_personal_data(read(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(read(spark, sf_dir, "documents"), keep="max")


def op6_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op7_pack_documents(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op8_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return language.identify_languages(docs, language.train(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark, sf_dir):
    rows = line_dedup.without_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("row.text", F.lit(""))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"), "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op10_warc(spark, sf_dir):
    return warc.archived_pages(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_whitening(spark, sf_dir):
    return whitening.whiten_embeddings(read(spark, sf_dir, "embeddings")).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained",
        "identity_error")


def op12_repeated_strings(spark, sf_dir):
    return repeats.without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.expr("aggregate(zip_with(starts, ends, (s, e) -> e - s), 0L, (a, b) -> a + b)").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        "embedding")
    return negatives.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_embedding_neardup, op3_personal_data, op4_toxicity, op5_exact_dedup, op6_ngram_jaccard,
    op7_pack_documents, op8_language, op9_line_dedup, op10_warc,
    op11_whitening, op12_repeated_strings, op13_hard_negatives)}
