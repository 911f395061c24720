import datetime as dt
import math
import statistics
from decimal import Decimal

from pyspark.sql import functions as F

from mercato.functions import (mean_of, month_label, months_since, parse_date, ratio_or_zero, round_ratio,
                               stddev_exact)


def test_round_ratio_half_up_and_sign(spark):
    df = spark.createDataFrame(
        [(Decimal("0.05"), 2), (Decimal("-0.05"), 2), (Decimal("10.00"), 0), (Decimal("12.34"), 3),
         (Decimal("1.00"), 8)], "x decimal(18,2), n long")
    got = [r.r for r in df.select(round_ratio("x", "n", num_scale=2).alias("r")).collect()]
    assert got == [0.03, -0.03, None, 4.11, 0.13]


def test_ratio_or_zero_guards(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (1, 3)], "a long, b long")
    got = [r.r for r in df.select(ratio_or_zero("a", "b", multiplier=100).alias("r")).collect()]
    assert got == [0.0, 0.0, 33.33]


def test_month_label_and_months_since(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 31), dt.date(2022, 2, 28)),
                                (dt.date(2022, 1, 1), dt.date(2022, 1, 17)),
                                (dt.date(2022, 1, 1), dt.date(2022, 1, 16)),
                                (dt.date(2021, 12, 5), dt.date(2023, 3, 5))], "a date, b date")
    rows = df.select(month_label("a").alias("m"), months_since("b", "a").alias("k")).collect()
    assert [r.m for r in rows] == ["2022-01", "2022-01", "2022-01", "2021-12"]
    # both month ends -> whole month; 16/31 rounds up; 15/31 rounds down
    assert [r.k for r in rows] == [1, 1, 0, 15]


def test_parse_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("2022-03-04",), ("not a date",), (None,)], "s string")
    assert [r.d for r in df.select(parse_date("s").alias("d")).collect()] == [dt.date(2022, 3, 4), None, None]


def test_stddev_exact_matches_python(spark):
    vals = ["10.25", "3.10", "7.77", "1000.01", "0.00", "55.55"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "x decimal(18,2)")
    r = df.agg(stddev_exact("x").alias("s"), mean_of("x").alias("m")).first()
    assert math.isclose(r.s, statistics.stdev([float(v) for v in vals]), rel_tol=1e-12)
    assert math.isclose(r.m, statistics.mean([float(v) for v in vals]), rel_tol=1e-15)
    one = spark.createDataFrame([(Decimal("1.00"),)], "x decimal(18,2)").agg(stddev_exact("x").alias("s")).first()
    assert one.s is None
    empty = df.filter(F.lit(False)).agg(mean_of("x").alias("m")).first()
    assert empty.m is None
