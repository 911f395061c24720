import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators.ranking import (RankSpec, add_ranks, add_tiles, ntile_over, ranks_of,
                                       row_number_over, top_k_per_group)


def _plain(spec):
    order = [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in spec.sort_keys()]
    w = Window.partitionBy(*spec.partition_by).orderBy(*order)
    return (F.ntile(spec.ntile) if spec.ntile else F.row_number()).over(w).alias("e_" + spec.out)


@pytest.fixture(scope="module")
def skewed(spark):
    # value 7 holds a third of all rows; NULLs and a second group column
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
         .otherwise(F.col("id") % 97).cast("long").alias("v"),
        (F.col("id") % 4).cast("string").alias("g"))


SPECS = [
    RankSpec("asc", (("v", True),), (), ("id",)),
    RankSpec("desc", (("v", False),), (), ("id",)),
    RankSpec("grp", (("v", False),), ("g",), ("id",)),
    RankSpec("tile", (("v", True),), (), ("id",), 5),
    RankSpec("gtile", (("v", False),), ("g",), ("id",), 3),
]


def _check(got, rows, specs, key="id"):
    exp = rows.select(key, *[_plain(s) for s in specs])
    j = got.join(exp, key)
    assert j.count() == got.count() == rows.count()
    for s in specs:
        assert j.filter(~F.col(s.out).eqNullSafe(F.col("e_" + s.out))).count() == 0, s.out


@pytest.mark.parametrize("rows_per_bucket", [50, 3000])  # 60 ranges and 1
def test_ranks_equal_plain_windows(spark, skewed, rows_per_bucket):
    _check(add_ranks(skewed, SPECS, rows_per_bucket=rows_per_bucket), skewed, SPECS)


@pytest.fixture(scope="module")
def typed(spark, skewed):
    # text and dates with ties and NULLs, doubles with NaN and NULL
    return skewed.select("id", F.concat(F.lit("s"), F.col("v").cast("string")).alias("s"),
                         F.date_add(F.lit("2024-01-01").cast("date"), F.col("v").cast("int")).alias("d"),
                         F.when(F.col("v") == 5, float("nan")).otherwise(F.col("v") / 7).alias("x"))


@pytest.mark.parametrize("rows_per_bucket,column", [(50, "s"), (3000, "s"), (50, "d"), (50, "x"), (3, "s")])
def test_descending_text_dates_and_nan(spark, typed, rows_per_bucket, column):  # up to 1000 ranges
    spec = RankSpec("r", ((column, False),), (), ("id",))
    _check(add_ranks(typed, [spec], rows_per_bucket=rows_per_bucket), typed, [spec])


def test_tiles_by_cut_keys_equal_plain_windows(spark, typed, monkeypatch):
    from mercato.operators import ranking
    monkeypatch.setattr(ranking, "BOUNDS", 3)  # several rounds of narrowing
    specs = [RankSpec(f"{c}{k}{asc}", ((c, asc),), (), ("id",), k)
             for c, k in (("s", 5), ("d", 4), ("x", 7)) for asc in (True, False)]
    for rows_per_task in (40, 250_000):
        _check(add_tiles(typed, specs, 3000, rows_per_task=rows_per_task), typed, specs)


def test_no_task_sorts_more_than_its_share(spark, monkeypatch):
    from mercato.operators import ranking
    from mercato.session import cut_lineage

    df = cut_lineage(spark.range(1_000_000).select("id", (F.col("id") * 7919 % 1009).alias("v")))  # 1,009 values: many ties
    specs = [RankSpec("up", (("v", True),), (), ("id",), 5), RankSpec("down", (("v", False),), (), ("id",), 4)]
    brackets = ranking._bounded_brackets(df, specs, 1_000_000, 5_000, 17)
    assert max(b.size for b in brackets) <= 5_000
    assert sorted(r for b in brackets for r in b.ranks) == sorted([200_000, 400_000, 600_000, 800_000, 250_000, 500_000, 750_000])
    key = lambda i: (i * 7919 % 1009, i)
    ordered = sorted(range(1_000_000), key=key)
    for b in brackets:  # the limits enclose the rows that they say
        if b.spec is specs[0]:
            low = ordered.index(b.low[1]) + 1 if b.low else 0
            assert low == b.start and (b.high is None or ordered[b.start + b.size - 1] == b.high[1])


def test_a_thousand_million_rows_are_narrowed_in_a_few_rounds(monkeypatch):
    # simulated: the keys are 0 .. 10^9 - 1, their sample and their counts are worked out instead of read
    import random

    from mercato.operators import ranking
    n, rounds, rng = 10 ** 9, [], random.Random(3)

    def narrowed(df, brackets, seed):
        out = []
        for b in brackets:
            first, last = (b.low[0] + 1 if b.low else 0), (b.high[0] if b.high else n - 1)
            keys = sorted({(rng.randint(first, last),) for _ in range(ranking.BOUNDS * ranking.BOUND_SAMPLE)})
            bounds = ranking._spread(keys, ranking.BOUNDS)
            edges = [first - 1, *[k[0] for k in bounds], last]
            out += b.split(bounds, {c: edges[c + 1] - edges[c] for c in range(len(bounds) + 1)})
        rounds.append(len(out))
        return out

    monkeypatch.setattr(ranking, "_narrowed", narrowed)
    spec = RankSpec("t", (("id", True),), (), (), 5)
    done = ranking._bounded_brackets(None, [spec], n, 250_000, 1)
    assert len(done) == 4 and max(b.size for b in done) <= 250_000 and len(rounds) <= 4
    for b, rank in zip(sorted(done, key=lambda b: b.start), [n // 5 * t for t in range(1, 5)]):
        assert b.ranks == [rank] and b.low[0] < rank - 1 <= b.high[0]


def test_tiles_of_few_rows(spark):
    for n in (0, 1, 3, 5, 6):
        df = spark.range(n).withColumn("v", F.lit(1))
        spec = RankSpec("t", (("v", False),), (), ("id",), 5)
        _check(add_tiles(df, [spec], n), df, [spec])


def test_tiles_do_not_shuffle_the_table(spark, typed):
    plan = add_tiles(typed, [RankSpec("t", (("x", False),), (), ("id",), 5)], 3000)
    lines = plan._jdf.queryExecution().sparkPlan().toString().splitlines()
    main = "".join(x for x in lines if not x.lstrip().startswith(":"))  # without the subqueries
    assert "Sort" not in main and "Window" not in main and "Exchange" not in main


@pytest.mark.parametrize("column,asc", [("s", False), ("d", True), ("x", False)])
def test_ranks_of_some_rows(spark, typed, column, asc):
    rows = typed.withColumn("g", F.when(F.col("id") % 5 > 0, F.col("id") % 4))  # a fifth without a group
    spec = RankSpec("r", ((column, asc),), (), ("id",))
    local = RankSpec("l", ((column, asc),), ("g",), ("id",))
    got = ranks_of(rows.filter("id % 271 = 3"), rows, spec, "g", "l")
    exp = rows.select("id", _plain(spec), _plain(local))
    j = got.join(exp, "id").filter("r = e_r and l = e_l")
    assert j.count() == got.count() == 12


def test_hot_value_is_split_across_ranges(spark, skewed):
    # no range holds a third of the rows although one value does
    order = [F.asc("v"), F.asc("id")]
    placed = skewed.repartitionByRange(10, *order).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(placed) == 10 and max(r["count"] for r in placed) < 600
    spec = RankSpec("r", (("v", True),), (), ("id",))
    _check(add_ranks(skewed, [spec], rows_per_bucket=300), skewed, [spec])


def test_ntile_sizes_differ_by_at_most_one(spark):
    for n in (1, 3, 4, 5, 13, 1001):
        df = spark.range(n).select("id", (F.col("id") % 7).alias("v"))
        out = ntile_over(df, "t", 5, [("v", True)], tiebreak=["id"], rows_per_bucket=50)
        sizes = [r["count"] for r in out.groupBy("t").count().collect()]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(g, i, float(i % 5)) for g in "ab" for i in range(10)], "g string, i int, x double")
    top = top_k_per_group(df, 2, ["g"], [("x", False)], tiebreak=["i"], rank_col="rk").collect()
    assert sorted((r.g, r.i, r.rk) for r in top) == [("a", 4, 1), ("a", 9, 2), ("b", 4, 1), ("b", 9, 2)]
