import pytest
from pyspark.sql import functions as F

from mercato.operators.diff import SchemaMismatch, compare_tables, round_fractional, stringify
from mercato.plans.inspect import count_exchanges

S = "k int, v double, s string"


def rec(spark, a, b, schema=S, **kw):
    return compare_tables(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "t", **kw)


def first(c):
    return c.result.first()


def test_identical_tables_pass(spark):
    rows = [(1, 1.0, "a"), (2, None, None), (2, None, None)]
    r = first(rec(spark, rows, rows))
    assert (r.missing_rows_count, r.new_rows_count, r.total_differences, r.passed) == (0, 0, 0, True)
    assert r.grouped_comparison is None


def test_missing_new_and_changed_value(spark):
    c = rec(spark, [(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c")], [(1, 1.0, "a"), (2, 2.5, "b"), (4, 4.0, "d")])
    r = first(c)
    assert (r.control_count, r.target_count, r.missing_rows_count, r.new_rows_count) == (3, 3, 2, 2)
    assert not r.passed and r.tolerance_threshold == 0.0
    assert sorted(x.k for x in c.missing.collect()) == [2, 3]
    assert sorted(x.k for x in c.new.collect()) == [2, 4]


def test_swapped_duplicates_set_vs_bag(spark):
    a = [(1, 1.0, "a"), (1, 1.0, "a"), (2, 2.0, "b")]
    b = [(1, 1.0, "a"), (2, 2.0, "b"), (2, 2.0, "b")]
    assert first(rec(spark, a, b)).passed                       # contract rule: counts equal, sets equal
    bag = first(rec(spark, a, b, mode="bag"))
    assert not bag.passed and bag.total_differences == 2


def test_unequal_duplicates_grouped_rule(spark):
    a = [(1, 1.0, "a"), (2, 2.0, "b")]
    b = [(1, 1.0, "a"), (1, 1.0, "a"), (2, 2.0, "b")]
    r = first(rec(spark, a, b, tolerance=0.9))
    # no distinct difference; the grouped check counts the changed row on both sides
    assert (r.total_differences, r.grouped_comparison, r.grouped_differences) == (0, True, 2)
    assert r.passed is False                                     # 2 > 0.9 * 2 distinct control rows
    assert first(rec(spark, a, b, tolerance=1.0)).passed


def test_values_the_precision_cannot_hold_stay_apart(spark):
    nan, inf = float("nan"), float("inf")
    a = [(1, 1e37, "x"), (2, inf, "x"), (3, nan, "x"), (4, 1e37, "same"), (5, -inf, "same"), (6, nan, "same"), (7, 1.004, "y")]
    b = [(1, -2e37, "x"), (2, -inf, "x"), (3, None, "x"), (4, 1e37, "same"), (5, -inf, "same"), (6, nan, "same"), (7, 1.001, "y")]
    c = rec(spark, a, b, precision=2)
    r = first(c)
    assert (r.missing_rows_count, r.new_rows_count, r.passed) == (3, 3, False)
    assert sorted(x.k for x in c.missing.collect()) == [1, 2, 3] and c.new.columns == ["k", "v", "s"]
    assert first(rec(spark, a, b, precision=2, mode="bag")).total_differences == 6


def test_precision_rounding_and_nan(spark):
    a = [(1, 1.004, "x"), (2, float("nan"), "y"), (3, 2.675, "z")]
    b = [(1, 1.001, "x"), (2, float("nan"), "y"), (3, 2.68, "z")]
    assert first(rec(spark, a, b)).total_differences == 4
    r = first(rec(spark, a, b, precision=2))
    assert r.total_differences == 0 and r.passed
    rounded = round_fractional(spark.createDataFrame(a, S), 2)
    assert rounded.schema["v"].dataType.simpleString() == "decimal(38,2)"
    assert [x.v for x in rounded.orderBy("k").collect()][1] is None   # NaN -> NULL, no failure


def test_null_equals_null(spark):
    r = first(rec(spark, [(None, None, None)], [(None, None, None)]))
    assert r.total_differences == 0


def test_map_column_key_order_ignored(spark):
    sch = "k int, m map<string,int>"
    a = spark.createDataFrame([(1, {"a": 1, "b": 2})], sch)
    b = spark.createDataFrame([(1, {"b": 2, "a": 1})], sch)
    assert first(compare_tables(a, b)).total_differences == 0
    s = stringify(a).first().m
    assert s == stringify(b).first().m


@pytest.mark.parametrize("other", ["k int, v double, x string", "k int, v float, s string",
                                   "v double, k int, s string"])
def test_schema_mismatch_raises(spark, other):
    a = spark.createDataFrame([], S)
    b = spark.createDataFrame([], other)
    with pytest.raises(SchemaMismatch):
        compare_tables(a, b)


def test_nullability_mismatch_raises(spark):
    a = spark.range(3)
    b = spark.range(3).select(F.when(F.col("id") >= 0, F.col("id")).alias("id"))
    with pytest.raises(SchemaMismatch):
        compare_tables(a, b)


def test_empty_vs_non_empty(spark):
    r = first(rec(spark, [], [(1, 1.0, "a")], tolerance=0.5))
    assert (r.control_count, r.new_rows_count, r.passed) == (0, 1, False)


def test_tolerance_met_and_exceeded(spark):
    a = [(i, float(i), "x") for i in range(100)]
    b = a[:98] + [(500, 1.0, "y"), (501, 1.0, "y")]
    assert first(rec(spark, a, b, tolerance=0.04)).passed      # 4 <= 4.0
    assert not first(rec(spark, a, b, tolerance=0.039)).passed


def test_missing_is_reverse_new(spark):
    a = [(i, float(i % 3), "x") for i in range(20)]
    b = [(i, float(i % 4), "x") for i in range(5, 25)]
    ab, ba = rec(spark, a, b), rec(spark, b, a)
    assert sorted(map(tuple, ab.missing.collect())) == sorted(map(tuple, ba.new.collect()))


def test_diff_is_one_shuffle(spark):
    a = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    c = compare_tables(a, a.filter("id % 5 <> 0"))
    assert count_exchanges(c.counts) == 1


def test_result_record_schema_is_the_contract(spark):
    from mercato.schemas import DIFF_RESULT_SCHEMA
    r = rec(spark, [(1, 1.0, "a")], [(1, 1.0, "a"), (2, 2.0, "b")]).result
    assert [(f.name, f.dataType) for f in r.schema.fields] == \
        [(f.name, f.dataType) for f in DIFF_RESULT_SCHEMA.fields]


def test_differences_only_keeps_record_and_rows(spark):
    a = [(i, float(i % 3), "x") for i in range(50)] + [(1, 1.0, "x")]
    b = [(i, float(i % 3), "x") for i in range(5, 55)]
    full = rec(spark, a, b, tolerance=0.5)
    small = full.differences_only()
    assert small.result.first().asDict() == full.result.first().asDict()
    assert sorted(map(tuple, small.missing.collect())) == sorted(map(tuple, full.missing.collect()))
    assert sorted(map(tuple, small.new.collect())) == sorted(map(tuple, full.new.collect()))
    assert sorted(map(tuple, small.changed.collect())) == sorted(map(tuple, full.changed.collect()))


def test_differences_only_record_needs_no_second_pass(spark):
    a = [(i, float(i), "x") for i in range(30)]
    small = rec(spark, a, a[:25]).differences_only()
    plan = small.result._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan" in plan          # a one-row local table, no re-aggregation
    assert small.counts.count() == 5                         # only the differing rows were written
