"""Exact duplicates by 128-bit content hash, verified byte by byte."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import write_table


def exact_duplicates(docs: DataFrame, keep: str = "min", digest=F.md5) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of docs.

    Rows are grouped by the 128-bit hash of the text and, inside a hash, by the text itself:
    grouping compares the bytes, so a collision makes two groups. Copies are combined before the
    shuffle, so a group of any size sends one row per task. The groups are written without their
    texts and joined back on the hash; only hashes that hold several texts (collisions) are joined
    on the text as well.

    keep: "min" or "max" doc_id of a group stays. Null text equals empty text. A null doc_id stays
    only where the whole group has none. Repeated rows with one doc_id count singly and stay or go
    together. Other columns are ignored. An empty table gives no rows.
    """
    pick = {"min": F.min, "max": F.max}[keep]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.unhex(digest(F.col("text"))))

    def grouped(part: DataFrame) -> DataFrame:
        return part.groupBy("h", "text").agg(pick("doc_id").alias("keep_id"),
                                             F.count(F.lit(1)).alias("group_size"))

    sha = F.sha2("text", 256).alias("text_sha256")
    groups, _ = write_table(grouped(rows).select("h", "keep_id", "group_size", sha), "exact-groups")
    collided = groups.groupBy("h").count().where("count > 1").select("h")
    fields = ("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
              "text_sha256")
    if collided.isEmpty():
        return rows.select("doc_id", "h").join(groups, "h").select(*fields)
    plain = rows.select("doc_id", "h").join(collided, "h", "left_anti").join(groups, "h").select(*fields)
    mixed = rows.join(collided, "h", "left_semi")
    exact = mixed.join(grouped(mixed).withColumn("text_sha256", sha), ["h", "text"]).select(*fields)
    return plain.unionByName(exact)
