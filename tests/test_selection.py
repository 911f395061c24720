import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators import selection
from mercato.operators.selection import group_quantiles, values_at_ranks
from mercato.session import write_table

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def _quantile(values, p):
    values = sorted(values)
    return values[max(1, math.ceil(Decimal(str(p)) * len(values))) - 1]


def _check(spark, rows, schema, cells, monkeypatch):
    monkeypatch.setattr(selection, "CELLS", cells)
    df, _ = write_table(spark.createDataFrame(rows, schema), "test-selection")
    groups = df.groupBy("g").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    got = {r.g: [r[f"q{i}"] for i in range(len(PROBABILITIES))] for r in
           group_quantiles(df, groups, ["g"], "v", PROBABILITIES).collect()}
    exp = {}
    for g, v in rows:
        if v is not None:
            exp.setdefault(g, []).append(v)
    assert got == {g: [_quantile(vs, p) for p in PROBABILITIES] for g, vs in exp.items()}


@pytest.mark.parametrize("cells", [2, 7, 8192])  # many rounds, some, one
def test_money_with_ties_nulls_outliers_and_a_hot_value(spark, monkeypatch, cells):
    rng = random.Random(cells)
    rows = [(rng.choice(["a", "b", None]), Decimal(rng.choice([500, 500, rng.randrange(-300, 4000)])) / 100) for _ in range(600)]
    rows += [("a", Decimal("9999999999.99")), ("one", Decimal("-3.10")), ("none", None), ("same", Decimal("2.00")), ("same", Decimal("2.00"))]
    rows = [(g, None if v is None else v.quantize(Decimal("0.01"))) for g, v in rows]
    _check(spark, rows, "g string, v decimal(18,2)", cells, monkeypatch)


def test_whole_numbers_and_dates(spark, monkeypatch):
    rng = random.Random(1)
    _check(spark, [(rng.randrange(3), rng.randrange(-2 ** 40, 2 ** 40)) for _ in range(300)], "g int, v long", 64, monkeypatch)
    day = dt.date(2024, 1, 31)
    _check(spark, [(rng.randrange(2), day + dt.timedelta(rng.randrange(900))) for _ in range(200)], "g int, v date", 16, monkeypatch)
    with pytest.raises(TypeError):
        selection.whole_number(F.lit(1.5), spark.range(1).select(F.lit(1.5).alias("x")).schema["x"].dataType)


def test_ranks_tell_how_many_come_before_and_how_many_are_equal(spark):
    df, _ = write_table(spark.createDataFrame([("a", v) for v in [5, 5, 5, 1, 9, 2]], "g string, v long"), "test-selection")
    wanted = spark.createDataFrame([("a", 3, 1, 9), ("a", 6, 1, 9), ("a", 7, 1, 9), ("b", 1, 0, 5)], "g string, rank long, lo long, hi long")
    got = {(r.g, r["rank"]): (r.v, r.before, r.here) for r in values_at_ranks(df, wanted, ["g"], "v").collect()}
    assert got == {("a", 3): (5, 2, 3), ("a", 6): (9, 5, 1)}  # rank 7 and group b are not there


def test_counters_are_bounded_whatever_the_distinct_values(spark, monkeypatch):
    # every round counts at most CELLS cells per bracket, although all 20,000 values differ
    monkeypatch.setattr(selection, "CELLS", 50)
    seen = []
    real = selection.write_table
    monkeypatch.setattr(selection, "write_table", lambda df, name: seen.append(real(df, name)) or seen[-1])
    df, _ = real(spark.range(20000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 20011).alias("v")), "test-selection")
    wanted = df.groupBy("g").agg(F.lit(10000).cast("long").alias("rank"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    got = values_at_ranks(df, wanted, ["g"], "v").first()
    assert got.v == sorted(i * 7919 % 20011 for i in range(20000))[9999]
    assert len(seen) == math.ceil(math.log(20011, 50))
