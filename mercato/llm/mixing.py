"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import write_table

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BLOCK = 50_000
SEED = 7


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def hex_number(text: F.Column, digits: int) -> F.Column:
    """The first hex digits of the text's md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources ordered by code point, null last, take the weights in turn and share the sum of all
    sizes by weight. A target stops at cap times its source's size; the excess goes to the others
    by weight. With the sources ordered by cap * size / weight the stopped ones come first, so the
    common level of the rest follows from running sums. The windows sort one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    rated = sources.withColumn("weight", weight)
    rated = rated.withColumn("ratio", F.col("source_size") * cap / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    level = (F.sum("source_size").over(every) - stopped) / F.sum("weight").over(after)
    rated = rated.withColumn("level", level)
    found = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(every)
    return rated.select("source", "source_size", F.when(
        F.col("ratio") < found, (F.col("source_size") * cap).cast("double")).otherwise(
        found * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, seed: int = SEED,
                rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Every row of docs as (row struct, size, source_size, target, copies).

    A row's expected copies are target / size of its source. Within a source the rows have one
    fixed order: bit length of the size, a hash block, size, doc_id. copies is the number of
    integers that (rows so far) * expected + offset crosses at the row, with one random offset per
    source taken from the seed. Near sizes lie together in the order, so the words taken come near
    the target. Blocks split a hot source: the row number is counted per block and the rows before
    a block come from a table of counts, one row per block. Reruns agree.

    Null text is empty, null source is a source of its own, null doc_id sorts first. Repeated rows
    share the copies of their place in the order, whichever of them gets which. Columns of any
    name pass through inside the struct. An empty table gives no rows.
    """
    blocks = max(1, -(-docs.count() // rows_per_block))
    rows = docs.select(F.struct(*docs.columns).alias("row")).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
        word_count("row.text").alias("size"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    # key: the source without nulls, so that the join and the window share one shuffle
    rows = (rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
            .withColumn("magnitude", F.length(F.bin("size")))
            .withColumn("block", hex_number(name, 8) % blocks))
    keys = ["key", "magnitude", "block"]
    counts, _ = write_table(rows.groupBy("source", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-blocks")
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")),
                             weights, cap)
    targets = targets.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")).alias("key"),
                             "source_size", "target")
    start = Window.partitionBy("key").orderBy("magnitude", "block").rowsBetween(
        Window.unboundedPreceding, -1)
    places = (counts.withColumn("before", F.coalesce(F.sum("n").over(start), F.lit(0)))
              .join(targets, "key")
              .select(*keys, "before", "source_size", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                      .otherwise(0.0).alias("expected"),
                      (hex_number(F.concat(F.lit(f"mix:{seed}:"), "key"), 5) / 1048576.0).alias("offset")))
    placed = rows.withColumn("nth", F.row_number().over(
        Window.partitionBy(*keys).orderBy("size", "doc_id"))).join(places, keys)
    nth = F.col("nth") + F.col("before")
    copies = (F.floor(nth * F.col("expected") + F.col("offset"))
              - F.floor((nth - 1) * F.col("expected") + F.col("offset")))
    return placed.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it was drawn (same columns)."""
    drawn = mix_sources(docs, **options).where("copies > 0")
    return (drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))
