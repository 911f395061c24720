"""Property tests against brute force on small random tables."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.operators.diff import bag_changes, compare_tables
from mercato.operators.ranking import RankSpec, add_ranks, add_tiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None]))
TABLE = st.lists(ROW, max_size=25)


@SETTINGS
@given(a=TABLE, b=TABLE)
def test_diff_counts_match_brute_force(spark, a, b):
    sch = "x int, s string"
    c = compare_tables(spark.createDataFrame(a, sch), spark.createDataFrame(b, sch), "t")
    r = c.result.first()
    ca, cb = Counter(a), Counter(b)
    assert (r.control_count, r.target_count) == (len(a), len(b))
    assert r.missing_rows_count == len(set(ca) - set(cb))
    assert r.new_rows_count == len(set(cb) - set(ca))
    changed = sum(1 for k in set(ca) & set(cb) if ca[k] != cb[k])
    if len(a) != len(b):
        assert r.grouped_differences == r.missing_rows_count + r.new_rows_count + 2 * changed
    bag = compare_tables(spark.createDataFrame(a, sch), spark.createDataFrame(b, sch), mode="bag").result.first()
    assert bag.total_differences == sum(((ca - cb) + (cb - ca)).values())
    ch = bag_changes(spark.createDataFrame(a, sch), spark.createDataFrame(b, sch), chunk=2).collect()
    assert Counter((r.x, r.s) for r in ch if r._change_type == "INSERT") == cb - ca
    assert Counter((r.x, r.s) for r in ch if r._change_type == "DELETE") == ca - cb


@SETTINGS
@given(vals=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from("pq")), min_size=1,
                     max_size=40),
       rows_per_bucket=st.integers(1, 12), k=st.integers(1, 6))
def test_ranks_match_brute_force(spark, vals, rows_per_bucket, k):
    df = spark.createDataFrame([(i, v, g) for i, (v, g) in enumerate(vals)], "id long, v int, g string")
    got = add_ranks(df, [RankSpec("r", (("v", False),), (), ("id",)),
                         RankSpec("pr", (("v", True),), ("g",), ("id",)),
                         RankSpec("t", (("v", True),), (), ("id",), k)], rows_per_bucket=rows_per_bucket)
    got = add_tiles(got, [RankSpec("c", (("v", True),), (), ("id",), k)], len(vals))
    rows = {r.id: r for r in got.collect()}
    n = len(vals)
    # descending, NULLS LAST, then id
    desc = sorted(range(n), key=lambda i: (vals[i][0] is None, -(vals[i][0] or 0), i))
    asc = sorted(range(n), key=lambda i: (vals[i][0] is not None, vals[i][0] or 0, i))
    for pos, i in enumerate(desc):
        assert rows[i].r == pos + 1
    q, rem = divmod(n, k)
    sizes = [q + 1] * rem + [q] * (k - rem)
    tiles = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
    for pos, i in enumerate(asc):
        assert rows[i].t == rows[i].c == tiles[pos]
    for g in "pq":
        members = [i for i in asc if vals[i][1] == g]
        for pos, i in enumerate(members):
            assert rows[i].pr == pos + 1
