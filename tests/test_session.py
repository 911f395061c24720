import os

from pyspark.sql import functions as F

from mercato.session import cut_lineage_counted, drop_table_files, ensure_checkpoint_dir, write_table


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir") and spark.sparkContext.getCheckpointDir()


def test_written_table_round_trip_and_cleanup(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("g"))
    table, path = write_table(df, "unit")
    assert path.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/tables/unit-")
    assert table.count() == 100 and "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()
    drop_table_files(spark, path)
    assert not os.path.exists(path.replace("file:", ""))


def test_counted_checkpoint_cuts_lineage(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    cut, n = cut_lineage_counted(df)
    assert n == 7 and cut.count() == 7
    assert "HashAggregate" not in cut._jdf.queryExecution().executedPlan().toString()


def test_written_tables_are_removed_at_the_end_of_the_block(spark):
    import os
    from mercato.session import written_tables
    outside, kept = write_table(spark.range(3), "test-kept")
    with written_tables(spark) as block:
        table, path = write_table(spark.range(5), "test-gone")
        assert table.count() == 5 and block == [path]
    assert not os.path.exists(path.removeprefix("file://")) and outside.count() == 3


def test_publish_replaces_and_keeps_the_old_when_it_cannot(spark, scratch):
    import os
    import pytest
    from mercato.session import publish
    for name, n in (("old", 2), ("new", 5)):
        spark.range(n).write.parquet(f"{scratch}/{name}")
    publish(spark, {f"{scratch}/old": f"{scratch}/new"})
    assert spark.read.parquet(f"{scratch}/old").count() == 5 and sorted(os.listdir(scratch)) == ["old"]
    with pytest.raises(Exception):
        publish(spark, {f"{scratch}/old": f"{scratch}/not-there"})
    assert spark.read.parquet(f"{scratch}/old").count() == 5
