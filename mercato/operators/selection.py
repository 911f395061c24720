"""Exact quantiles of groups of any size: distributed selection instead of sorting or sketching.

A quantile of n values is the value at rank ceil(p * n). The rank lies in a
bracket of values, at first from the group's smallest to its largest. Each
round cuts every bracket into CELLS equal cells and counts the rows of each in
one aggregation (combined before the shuffle); the cell that holds the rank is
the next bracket, until it is one value. A bracket of m values takes
log_8192(m) rounds: two for money up to 670,000.00, five for any 64-bit number.
A task holds counters, at most CELLS per bracket, whatever the number of rows or of
distinct values of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import drop_table_files, write_table

CELLS = 8192


def whole_number(c: Column, dtype: T.DataType) -> Column:
    """A whole number (bigint) in the order of a decimal, integral or date column."""
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (c * F.lit(10 ** dtype.scale)).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    raise TypeError(f"quantiles need a decimal of up to 18 digits, an integral or a date column, not {dtype.simpleString()}")


def original(c: Column, dtype: T.DataType) -> Column:
    """The value of a ``whole_number``."""
    if isinstance(dtype, T.DecimalType):
        return (c.cast("decimal(38,0)") / F.lit(10 ** dtype.scale).cast("decimal(19,0)")).cast(dtype)
    return F.date_from_unix_date(c.cast("int")) if isinstance(dtype, T.DateType) else c.cast(dtype)


def _renamed(df: DataFrame, columns: list[str], *others) -> DataFrame:
    """``df`` with its key columns named apart, for a join with a table that has them too."""
    return df.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(columns)], *others)


def _matches(columns: list[str]) -> Column:
    out = F.lit(True)
    for i, c in enumerate(columns):
        out = out & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return out


def values_at_ranks(rows: DataFrame, wanted: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``wanted`` (keys, rank, lo, hi) -> (keys, rank, value, before, here): the value at each rank of each group.

    ``rows`` (keys, value) are read once per round: pass written tables (``wanted`` is read twice). lo and hi are values
    between which the rank lies. before counts the group's rows with a smaller value, here those with
    that value. Ranks outside the group give no row; NULL values have no rank.
    """
    div = lambda a, b: F.call_function("div", a, b)  # noqa: E731 - whole-number division
    lo, hi, step, before = F.col("__lo"), F.col("__hi"), F.col("__step"), F.col("__before")
    bracket = [*keys, "__lo"]
    state, path = wanted.select(
        *keys, "rank", F.col("lo").cast("bigint").alias("__lo"), F.col("hi").cast("bigint").alias("__hi"),
        F.lit(0).cast("bigint").alias("__before"), F.lit(0).cast("bigint").alias("__here")), None
    widest = state.agg(F.max(hi - lo)).first()[0] or 0  # a round divides it by CELLS
    while True:
        last = widest < CELLS  # cells of one value each
        widest //= CELLS
        state = state.withColumn("__step", div(hi - lo, F.lit(CELLS)) + 1)
        brackets = _renamed(state.select(*bracket, "__hi", "__step").distinct(), keys, "__lo", "__hi", "__step")
        cells = (rows.join(brackets, _matches(keys) & F.col(value).between(lo, hi))
                 .groupBy(*bracket, div(F.col(value) - lo, step).alias("__cell")).agg(F.count(F.lit(1)).alias("__c")))
        upto = Window.partitionBy(*bracket).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)  # CELLS rows at most
        cells = _renamed(cells.withColumn("__end", F.sum("__c").over(upto)), bracket, "__cell", "__c", "__end")
        end = before + F.col("__end")
        found = (state.join(cells, _matches(bracket)).where((F.col("rank") > end - F.col("__c")) & (F.col("rank") <= end))
                 .select(*keys, "rank", (lo + F.col("__cell") * step).alias("__lo"),
                         F.least(hi, lo + (F.col("__cell") + 1) * step - 1).alias("__hi"),
                         (end - F.col("__c")).alias("__before"), F.col("__c").alias("__here")))
        done = path
        state, path = write_table(found, "selection")
        if done:
            drop_table_files(rows.sparkSession, done)
        if last:
            return state.select(*keys, "rank", lo.alias(value), before.alias("before"), F.col("__here").alias("here"))


def group_quantiles(rows: DataFrame, groups: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """``groups`` (keys, n, lo, hi) -> (keys, q0, q1, ...): the exact quantiles of ``value`` in each group.

    n, lo and hi are the number of non-null values of the group, the smallest and the largest. The
    quantile p is the smallest value that at least p * n values do not exceed, as SQL's
    discrete percentile has it. ``rows`` must be a written table. A group without values has no row.
    """
    dtype = rows.schema[value].dataType
    ranks = [F.greatest(F.ceil(F.lit(str(p)).cast("decimal(20,18)") * F.col("n")).cast("bigint"), F.lit(1)) for p in probabilities]
    groups = groups.where("n > 0").select(*keys, F.array(*ranks).alias("ranks"), whole_number(F.col("lo"), dtype).alias("lo"),
                                          whole_number(F.col("hi"), dtype).alias("hi"))
    wanted = groups.select(*keys, F.explode(F.array_distinct("ranks")).alias("rank"), "lo", "hi")
    whole = rows.select(*keys, whole_number(F.col(value), dtype).alias(value)).where(F.col(value).isNotNull())
    found = values_at_ranks(whole, wanted, keys, value)
    found = _renamed(found, keys, F.col("rank").alias("__rank"), original(F.col(value), dtype).alias("__v"))
    values = (groups.join(found, _matches(keys) & F.array_contains("ranks", F.col("__rank"))).groupBy(*keys, "ranks")
              .agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__m")))  # one entry per quantile
    return values.select(*keys, *[F.element_at("__m", F.get("ranks", F.lit(i))).alias(f"q{i}") for i in range(len(probabilities))])
