import pytest
from pyspark.sql import functions as F

from mercato.operators import reports
from mercato.operators.joins import broadcastable, join_dimension
from mercato.session import write_table


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tables(spark, n=24000):
    # one product in a third of the orders, another in a tenth, NULL products in a tenth; some without a product row
    k = F.col("id")
    product = (F.when(k % 3 == 0, "hot").when(k % 10 == 1, "warm").when(k % 10 == 2, F.lit(None))
               .otherwise(F.concat(F.lit("p"), (k * 7919 % 997).cast("string"))))
    fact = spark.range(n).select(k.alias("order"), product.alias("product_id"))
    dim = (spark.range(900).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("product_id"), F.col("id").alias("brand"))
           .unionByName(spark.createDataFrame([("hot", -1), ("hot", -2), ("warm", -3), (None, -4)], "product_id string, brand long")))
    return fact, write_table(dim, "test-dimension")[0]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(spark, no_broadcast, how):
    fact, dim = _tables(spark, 6000)
    got = join_dimension(fact, dim, "product_id", how).select("order", "product_id", "brand")
    exp = fact.join(dim, "product_id", how).select("order", "product_id", "brand")
    key = lambda rows: sorted(map(str, rows))
    assert key(got.collect()) == key(exp.collect())


def test_no_task_gets_a_heavy_key_alone(spark, no_broadcast):
    fact, dim = _tables(spark)
    for how in ("inner", "left"):
        joined = join_dimension(fact, dim.dropDuplicates(["product_id"]).transform(lambda d: write_table(d, "test-dimension")[0]),
                                "product_id", how)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[len(sizes) // 2], sizes


def test_a_small_dimension_is_broadcast_and_the_fact_not_shuffled(spark):
    fact, dim = _tables(spark, 100)
    assert broadcastable(dim)
    plan = join_dimension(fact, dim, "product_id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_customer_360_is_the_same_with_a_split_join_and_many_brands(spark, no_broadcast, monkeypatch):
    from mercato.plans import catalog
    key = lambda df: sorted(map(str, df.collect()))
    split = key(catalog.customer_360(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert key(catalog.customer_360(spark, "/root/testdata/sf0.001")) == split
    monkeypatch.setattr(reports, "MAX_BRAND_WORDS", 0)  # more brands than the bit sets hold
    assert key(catalog.customer_360(spark, "/root/testdata/sf0.001")) == split
