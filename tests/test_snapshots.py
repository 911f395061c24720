import pytest
from pyspark.sql import functions as F

from mercato.operators.diff import compare_changelogs, compare_tables
from mercato.plans.inspect import count_exchanges
from mercato.sources import snapshots as S


def _lineage(spark, rows):
    return spark.createDataFrame(rows, "table_name string, snapshot_id long, parent_id long")


@pytest.fixture(scope="module")
def fork(spark):
    # 1 <- 2 <- {3, 4}; 5 is an unrelated root; table u has 7 <- 8
    lin = _lineage(spark, [("t", 1, None), ("t", 2, 1), ("t", 3, 2), ("t", 4, 2), ("t", 5, None),
                           ("u", 7, None), ("u", 8, 7)])
    base = spark.range(200).select("id", (F.col("id") % 10).alias("v"))
    contents = {1: base.filter("id < 100"), 2: base.filter("id < 150"),
                3: base.filter("id < 150 and id % 7 <> 0"), 4: base.filter("id < 160"),
                5: base.filter("id >= 50")}
    return S.VersionedTable("t", lin, lambda s: contents[s])


def test_ancestors_linear_and_fork(spark, fork):
    anc = {(r.snapshot_id, r.depth): r.ancestor_id for r in S.ancestors(fork.lineage).collect()
           if r.table_name == "t"}
    assert [anc[(3, d)] for d in range(3)] == [3, 2, 1]
    assert [anc[(4, d)] for d in range(3)] == [4, 2, 1]
    assert (5, 1) not in anc


def test_common_ancestor_nearest_and_oldest(spark, fork):
    near = S.common_ancestor(fork.lineage, "t", 3, 4).first()
    old = S.common_ancestor(fork.lineage, "t", 3, 4, which="oldest").first()
    assert (near.ancestor_id, near.control_depth, near.target_depth) == (2, 1, 1)
    assert old.ancestor_id == 1
    assert S.common_ancestor(fork.lineage, "t", 3, 2).first().ancestor_id == 2
    assert S.common_ancestor(fork.lineage, "t", 3, 5).first() is None


def test_changelog_and_tracking_columns(spark, fork):
    ch = S.changelog(fork.at(2), fork.at(3))
    kinds = {r._change_type for r in ch.collect()}
    assert kinds == {"DELETE"} and ch.count() == len([i for i in range(150) if i % 7 == 0])
    df = spark.createDataFrame([(1, "INSERT", 5, 9)], "x int, _change_type string, `_change_ordinal` int, "
                                                      "`_commit_snapshot_id#2` long")
    assert S.drop_tracking_columns(df).columns == ["x", "_change_type"]


def test_changelog_diff_total_equals_snapshot_bag_diff(spark, fork):
    via_cdc = S.compare_snapshots(fork, 3, 4, mode="bag").result.first()
    full = S.compare_snapshots(fork, 3, 4, use_changelog=False, mode="bag").result.first()
    assert via_cdc.total_differences == full.total_differences > 0
    same = S.compare_snapshots(fork, 3, 3, mode="bag").result.first()
    assert same.total_differences == 0


def test_unrelated_roots_fall_back_to_full_compare(spark, fork):
    with pytest.raises(S.NoSharedAncestor):
        S.cdc_views(fork, 3, 5)
    r = S.compare_snapshots(fork, 3, 5).result.first()
    assert r.control_count == fork.at(3).count() and r.target_count == 150


def test_parse_qualified():
    assert S.parse_qualified("db.t@42") == ("db.t", 42)
    assert S.parse_qualified("db.t") == ("db.t", None)


def test_changelog_equals_except_all_with_hot_duplicates(spark):
    from mercato.operators.diff import bag_changes
    # one row repeated 2,500 times on one side (the hot group), others spread
    start = spark.range(3000).select((F.when(F.col("id") < 2500, 0).otherwise(F.col("id") % 97)).alias("v"))
    end = spark.range(2000).select((F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 89)).alias("v"))
    got = bag_changes(start, end, chunk=64)
    exp = (end.exceptAll(start).withColumn("_change_type", F.lit("INSERT"))
           .unionByName(start.exceptAll(end).withColumn("_change_type", F.lit("DELETE"))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    parts = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < 2400   # the 2,400 DELETE copies are spread


def test_deep_chain_doubling_matches_recursive_query(spark):
    rows = [("t", i, (i - 1) if i > 0 else None) for i in range(150)] + [("t", 1000 + i, 10 * i) for i in range(5)]
    lin = _lineage(spark, rows)
    one = S.ancestors_of(lin, "t", 149).collect()
    assert sorted((r.ancestor_id, r.depth) for r in one) == sorted((149 - d, d) for d in range(150))
    got = sorted(map(tuple, S.ancestors(lin).collect()))
    exp = sorted(map(tuple, S.ancestors_recursive(lin, max_depth=160).collect()))
    assert got == exp and len(got) == 150 * 151 // 2 + sum(10 * i + 2 for i in range(5))
    assert S.common_ancestor(lin, "t", 1004, 1003).first().ancestor_id == 30


def test_snapshot_folders_with_lineage_paths(spark, scratch):
    base = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    base.filter("id < 60").write.parquet(f"{scratch}/s1")
    base.filter("id < 80").write.parquet(f"{scratch}/s2")
    base.filter("id < 60 or id >= 90").write.parquet(f"{scratch}/s3")
    lin = spark.createDataFrame([("t", 1, None, f"{scratch}/s1"), ("t", 2, 1, f"{scratch}/s2"),
                                 ("t", 3, 1, f"{scratch}/s3")],
                                "table_name string, snapshot_id long, parent_id long, path string")
    table = S.from_snapshot_paths(spark, "t", lin)
    c, t, anc = S.cdc_views(table, 2, 3)
    assert anc == 1 and c.count() == 20 and t.count() == 10
    r = S.compare_snapshots(table, 2, 3).result.first()
    assert (r.missing_rows_count, r.new_rows_count) == (20, 10)


def test_catalog_pairs_with_snapshot_names(spark, fork):
    from mercato.plans import diff_job
    comps = diff_job.compare_catalog_pairs(spark, [("t@3", "t@4")], versioned={"t": fork}, mode="bag")
    direct = S.compare_snapshots(fork, 3, 4, mode="bag").result.first()
    r = comps[0].result.first()
    assert r.table_name == "t" and r.total_differences == direct.total_differences > 0
    with pytest.raises(ValueError):
        diff_job.compare_catalog_pairs(spark, [("t@3", "u@8")], versioned={"t": fork})


def _both_changelogs(fork, c, t, **kw):
    base = S.common_ancestor(fork.lineage, "t", c, t).first().ancestor_id
    return compare_tables(S.changelog(fork.at(base), fork.at(c)), S.changelog(fork.at(base), fork.at(t)), "t", **kw)


@pytest.mark.parametrize("kw", [{"mode": "set", "tolerance": 0.1}, {"mode": "bag"}, {"mode": "set", "precision": 0}, {"mode": "bag", "precision": 1}])
def test_three_way_counts_compare_as_the_two_changelogs(spark, kw):
    lin = _lineage(spark, [("t", 1, None), ("t", 2, 1), ("t", 3, 1)])
    rows = spark.range(300).select((F.col("id") % 20).alias("k"), (F.col("id") % 7 / 3).alias("x"))  # many repeated rows
    contents = {1: rows, 2: rows.filter("k <> 3").unionByName(rows.filter("k = 5")).withColumn("x", F.when(F.col("k") == 7, F.col("x") + 0.2).otherwise(F.col("x"))),
                3: rows.filter("k <> 4").unionByName(rows.filter("k = 5").limit(3)).withColumn("x", F.when(F.col("k") == 7, F.col("x") + 0.21).otherwise(F.col("x")))}
    table = S.VersionedTable("t", lin, lambda s: contents[s])
    got = S.compare_snapshots(table, 2, 3, run_timestamp="now", **kw)
    exp = _both_changelogs(table, 2, 3, run_timestamp="now", **kw)
    assert got.result.first().asDict() == exp.result.first().asDict() and got.result.first().total_differences > 0
    for a, b in ((got.missing, exp.missing), (got.new, exp.new), (got.changed, exp.changed)):
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_three_way_is_one_shuffle(spark, fork):
    both = S.three_way(fork, 3, 4)
    assert count_exchanges(both.counts) == 1
    assert count_exchanges(compare_changelogs(both.counts, "t").missing) == 1


def test_a_read_that_fails_while_it_runs_leads_to_the_full_compare(spark, fork, capsys):
    def reader(s):
        df = fork.at(s)
        return df.withColumn("v", F.when(F.col("id") < 0, F.col("v")).otherwise(F.raise_error(F.lit("expired file")).cast("long"))) if s == 2 else df

    broken = S.VersionedTable("t", fork.lineage, reader)
    got = S.compare_snapshots(broken, 3, 4, mode="bag").result.first()
    full = S.compare_snapshots(fork, 3, 4, use_changelog=False, mode="bag").result.first()
    assert got.total_differences == full.total_differences > 0 and got.control_count == fork.at(3).count()
    assert "expired file" in capsys.readouterr().err


def test_a_snapshot_without_a_folder_is_named(spark, scratch):
    lin = spark.createDataFrame([("t", 1, None, scratch)], "table_name string, snapshot_id long, parent_id long, path string")
    with pytest.raises(LookupError, match="no snapshot 7"):
        S.from_snapshot_paths(spark, "t", lin).at(7)
