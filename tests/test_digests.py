import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import digests
from mercato.operators.diff import compare_tables
from mercato.operators.digests import compare_by_digests, tree_levels

SCHEMA = "k long, s string, x double"


def _sides(spark, seed, n=800):
    rng = random.Random(seed)
    rows = [(rng.choice([None, k, k, k, 5]), rng.choice("ab") if k % 9 else None, rng.choice([0.5, 1.26, float("nan"), None])) for k in range(n)]
    other = [r for r in rows if rng.random() > 0.01]
    other += [rng.choice(rows) for _ in range(6)] + [(10 ** 9, "new", 1.0)]
    other = [(k, s, 2.0) if rng.random() < 0.01 else (k, s, x) for k, s, x in other]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"mode": "bag"}), (3, {"tolerance": 0.05}), (4, {"tolerance": 0.9}), (5, {"precision": 1})])
@pytest.mark.parametrize("fanout", [2, 1024])
def test_same_record_and_rows_as_the_full_compare(spark, seed, kw, fanout):
    a, b = _sides(spark, seed)
    got = compare_by_digests(a, b, "k", "t", run_timestamp="now", leaf_rows=3, fanout=fanout, **kw)
    exp = compare_tables(a, b, "t", run_timestamp="now", **kw)
    assert got.result.first().asDict() == exp.result.first().asDict()
    for x, y in ((got.missing, exp.missing), (got.new, exp.new), (got.changed, exp.changed)):
        assert sorted(map(str, x.select(*y.columns).collect())) == sorted(map(str, y.collect()))


def test_equal_tables_empty_tables_maps_and_dates(spark):
    def table(first, second):
        entries = {"a": F.col("id"), "b": F.lit(1).cast("long")}
        return spark.range(300).select(
            (F.col("id") % 50).alias("k"), F.create_map(F.lit(first), entries[first], F.lit(second), entries[second]).alias("m"),
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))

    df, other = table("a", "b"), table("b", "a")
    for key in ("k", "d"):
        r = compare_by_digests(df, other, key, leaf_rows=2).result.first()
        assert r.total_differences == 0 and r.control_count == 300
    assert compare_by_digests(df.limit(0), df.limit(0), "k").result.first().control_count == 0
    assert compare_by_digests(df.limit(0), df, "k").result.first().new_rows_count == 300
    with pytest.raises(TypeError):
        compare_by_digests(df, df, "m")


def test_only_rows_of_differing_ranges_are_compared(spark, monkeypatch):
    seen = []
    real = digests.row_counts
    monkeypatch.setattr(digests, "row_counts", lambda *sides: seen.append([s.count() for s in sides]) or real(*sides))
    base = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    target = base.withColumn("v", F.when(F.col("k") % 1000 == 3, 99).otherwise(F.col("v")))  # 0.1 % changed, scattered
    r = compare_by_digests(base, target, "k").result.first()
    assert (r.missing_rows_count, r.new_rows_count) == (20, 20)
    assert max(seen[0]) <= 20 * 2 * digests.LEAF_ROWS and max(seen[0]) < 0.1 * 20000


def test_tree_levels():
    assert tree_levels(1) == [1] and tree_levels(5000) == [5000]
    assert tree_levels(3 * 10 ** 7) == [29, 29297, 3 * 10 ** 7] and tree_levels(0) == [1]
