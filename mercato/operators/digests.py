"""Diff that skips equal parts: a tree of digests per key range.

Two large versions of a table that differ in few rows need not be shuffled in full. The rows
are divided by ranges of a key column. Each range of either side has a
digest (its number of rows and sums of two 64-bit row hashes, so repeated
rows count); where the digests are equal, so are the rows. A range that differs is
divided again, until ranges hold about LEAF_ROWS rows, and only the rows of differing
leaves are compared one by one (``operators.diff``).

A level is one pass with one aggregation, combined before the shuffle: with files
roughly in the order of the key a task meets few ranges, and little but the
rows of differing leaves crosses the network. Which key is chosen changes the cost, never the result.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.diff import (C_N, T_N, Comparison, Observed, _as_string, _q, check_schemas, diff_counts, groupable,
                                    round_fractional, row_counts, stringify)
from mercato.session import write_table

LEAF_ROWS = 32
FANOUT = 1024


def _whole_key(df: DataFrame, key: str) -> Column:
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.IntegralType):
        return _q(key).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(_q(key)).cast("bigint")
    raise TypeError(f"the key of a digest tree must be an integral or a date column, not {dtype.simpleString()}")


def _hashable(f: T.StructField) -> Column:
    """Equal values give equal hashes in almost every case; where not (maps inside, in another order), a range is compared in vain."""
    nested = f.dataType.simpleString()
    return _as_string(_q(f.name), f.dataType) if "map<" in nested or "variant" in nested else _q(f.name)


def _tagged(control: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Both sides' rows as key, side (1 control, -1 target) and two hashes."""
    sides = []
    for df, side in ((control, 1), (target, -1)):
        columns = [_hashable(f) for f in df.schema.fields]
        sides.append(df.select(_whole_key(df, key).alias("__key"), F.lit(side).alias("__side"), F.xxhash64(*columns).alias("__h1"),
                               F.xxhash64(F.lit(1), *columns).alias("__h2")))
    return sides[0].unionByName(sides[1])


def _digests(rows: DataFrame, node: Column) -> DataFrame:
    """Per node: the rows of either side, and whether the sides' digests differ."""
    side, low = F.col("__side"), F.lit(0xFFFFFFFF)
    sums = [F.sum(side)] + [F.sum(side * half) for h in ("__h1", "__h2")
                            for half in (F.col(h).bitwiseAND(low), F.shiftright(F.col(h), 32))]  # halves: no overflow
    changed = reduce(lambda a, b: a | b, [s != 0 for s in sums])
    return rows.groupBy(node.alias("__node")).agg(F.count_if(side == 1).alias("__control"), F.count_if(side == -1).alias("__target"),
                                                  changed.alias("__changed"))


def tree_levels(leaves: int, fanout: int = FANOUT) -> list[int]:
    """Numbers of ranges from the top level down to the leaves; the top may be up to 16 times the fanout."""
    sizes = [max(1, leaves)]
    while sizes[0] > 16 * fanout:
        sizes.insert(0, -(-sizes[0] // fanout))
    return sizes


def compare_by_digests(control: DataFrame, target: DataFrame, key: str, table_name: str = "unknown", precision: int | None = None,
                       tolerance: float = 0.0, mode: str = "set", run_timestamp: str | None = None,
                       leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> Comparison:
    """``compare_tables`` with the same record and the same differing rows, by a digest tree over ``key``.

    Runs here: a pass over the key for its range, one for each level of the tree, one for the rows of
    differing leaves. Rows with a NULL key form one range of their own. Where the grouped rule of ``set`` mode
    hangs on the distinct number of equal rows, these are counted too.
    """
    check_schemas(control, target)
    if mode not in ("set", "bag"):
        raise ValueError("mode must be 'set' or 'bag'")
    _whole_key(control, key)
    keys = [side.select(_whole_key(side, key).alias("__key")) for side in (control, target)]
    span = keys[0].unionByName(keys[1]).agg(F.min("__key").alias("lo"), F.max("__key").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, width = span.lo or 0, (span.hi or 0) - (span.lo or 0) + 1
    levels = tree_levels(min(width, -(-span.n // (2 * leaf_rows))), fanout)
    if precision is not None:
        control, target = (round_fractional(side, precision, keep_unheld=True) for side in (control, target))

    def node(count: int, whole: Column) -> Column:
        step = F.lit(-(-width // count)).cast("bigint")
        return F.coalesce(F.call_function("div", whole - F.lit(lo).cast("bigint"), step), F.lit(-1).cast("bigint"))

    def within(df: DataFrame, whole: Column, how: str = "left_semi") -> DataFrame:
        return df.withColumn("__node", node(above, whole)).join(changed, "__node", how).drop("__node")

    tagged = _tagged(control, target, key)
    rows, totals = tagged, None
    for count in levels:
        level, _ = write_table(_digests(rows, node(count, F.col("__key"))), "digests")
        totals = totals or level.agg(F.sum("__control"), F.sum("__target")).first()
        changed, above = level.where("__changed").select("__node"), count
        rows = within(tagged, F.col("__key"))
    sides = [within(side, _whole_key(side, key)) for side in (control, target)]
    if not groupable(control):
        sides = [stringify(side) for side in sides]
    counted, _ = write_table(row_counts(*sides), f"differing-{table_name}")
    stats = diff_counts(counted).first().asDict() | {"control_count": int(totals[0] or 0), "target_count": int(totals[1] or 0)}
    if mode == "set" and stats["control_count"] != stats["target_count"]:
        grouped = stats["missing_rows_count"] + stats["new_rows_count"] + 2 * stats["changed_multiplicity_count"]
        if tolerance * stats["distinct_control_count"] < grouped <= tolerance * stats["control_count"]:
            equal = within(control, _whole_key(control, key), "left_anti")
            stats["distinct_control_count"] += (equal if groupable(equal) else stringify(equal)).distinct().count()
    row = control.sparkSession.createDataFrame([tuple(int(v) for v in stats.values())], ", ".join(f"{c} bigint" for c in stats))
    return Observed(table_name, counted.where(F.col(C_N) != F.col(T_N)), tolerance, mode,
                    run_timestamp or _dt.datetime.now().isoformat(), row)
