"""Joins of a fact to a dimension when a few keys hold a large share of the fact.

A dimension below Spark's broadcast threshold is broadcast, so that the fact
is not shuffled and frequent keys do no harm. Beyond it both sides are shuffled by key. A
sketch of the frequent items finds the heavy keys, those with more rows than two average
partitions: their rows are dealt over several salts, and only their dimension
rows are repeated, once per salt. All other rows are joined as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mercato.session import write_table

TRACKED = 10_000       # items that the sketch follows: no key with more than this share of the rows is missed
PIECES = 4             # a heavy key's rows are cut into pieces of a quarter of an average partition


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` is within its broadcast threshold (exact for a written table)."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _sketch(key: str, partitions: int):
    """Up to ``partitions`` frequent keys with their counts: heavier than an average partition can only be so many."""
    return F.expr(f"approx_top_k(`{key}`, {min(TRACKED, max(1, partitions))}, {TRACKED})")


def heavy_keys(rows: DataFrame, found: list, n: int, key: str, partitions: int) -> DataFrame:
    """(key, __salts) of the keys with more rows than two average partitions, at most partitions / 2 of them."""
    heavy = [(r["item"], int(-(-PIECES * partitions * r["count"] // n))) for r in found or []
             if r["item"] is not None and r["count"] * partitions > 2 * n]
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, __salts int"
    return rows.sparkSession.createDataFrame(heavy, schema)


def join_dimension(fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner", materialised: bool = False) -> DataFrame:
    """``fact`` joined to ``dimension`` on ``key`` (inner or left), without a task that gets a heavy key alone.

    ``dimension`` should be a written table, whose size Spark knows. Unless it is
    broadcast, ``fact`` is written once (or is ``materialised`` already) while the frequent keys
    are counted; NULL keys, which match nothing, are dealt out too.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if broadcastable(dimension):
        return fact.join(F.broadcast(dimension), key, how)
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counters = F.count(F.lit(1)).alias("n"), _sketch(key, partitions).alias("top")
    if materialised:
        seen = fact.agg(*counters).first()
    else:
        obs = Observation()
        fact, _ = write_table(fact.observe(obs, *counters), "join-fact")
        seen = obs.get
    heavy = heavy_keys(fact, seen["top"], max(1, int(seen["n"])), key, partitions)
    turn = F.monotonically_increasing_id()  # of a written table: the same in every attempt
    left = fact.join(F.broadcast(heavy), key, "left").withColumn(
        "__salt", F.pmod(turn, F.coalesce("__salts", F.when(F.col(key).isNull(), PIECES * partitions), F.lit(1)))).drop("__salts")
    right = dimension.join(F.broadcast(heavy), key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("__salts"), F.lit(1)).cast("bigint") - 1))).drop("__salts")
    return left.join(right, [key, "__salt"], how).drop("__salt")
