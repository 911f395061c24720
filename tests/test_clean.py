import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from mercato.operators import clean
from mercato.plans.inspect import plan_text
from mercato.sources.files import read_orders_csv

HEADER = ("order_id,customer_id,order_date,delivery_date,product_id,product_type,category,quantity,unit_price,"
          "total_amount,discount_percent,discount_amount,final_amount,shipping_method,shipping_cost,tax_amount,"
          "grand_total,payment_method,region,city,customer_segment,order_status,rating,is_prime_member")


def _row(oid, cust="C1", date="2022-01-05", qty="2", total="10.50", status="Delivered", rating="4", prime="True"):
    return (f"{oid},{cust},{date},,P1,Laptop,Electronics,{qty},5.25,{total},0,0,{total},Standard,0,0,{total},"
            f"UPI,North,Boston,New,{status},{rating},{prime}")


def test_validation_filters_and_sanitiser(spark, scratch):
    lines = [HEADER,
             _row("O1"),                       # kept
             _row("O2", cust=""),              # NULL customer -> dropped
             _row("O3", date="2022-13-45"),    # bad date -> NULL -> dropped
             _row("O4", qty="0"),              # quantity 0 -> dropped
             _row("O5", total="-1.00"),        # negative total -> dropped
             _row("O6", rating="9"),           # rating outside [1,5] -> NULL, kept
             _row("O7", status="Returned"),    # kept by validation, not delivered
             _row("O8", qty="abc")]            # malformed int -> NULL -> dropped
    path = os.path.join(scratch, "orders.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    orders = read_orders_csv(spark, path)
    cleaned = clean.clean_orders(orders)
    ids = sorted(r.order_id for r in cleaned.collect())
    assert ids == ["O1", "O6", "O7"]
    ratings = {r.order_id: r.rating for r in cleaned.collect()}
    assert ratings["O6"] is None and ratings["O1"] == 4.0
    assert cleaned.schema["grand_total"].dataType.simpleString() == "decimal(18,2)"
    delivered = clean.delivered(orders)
    assert sorted(r.order_id for r in delivered.collect()) == ["O1", "O6"]
    assert delivered.first().order_date == dt.date(2022, 1, 5)


def test_validation_pushes_filters_into_scan(spark, scratch):
    path = os.path.join(scratch, "o.parquet")
    spark.range(10).select(F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
                           F.lit("p").alias("product_id"), F.current_date().alias("order_date"),
                           F.lit(1.5).alias("grand_total"), F.lit(1).alias("quantity"),
                           F.lit(3.0).alias("rating"), F.lit("Delivered").alias("order_status")
                           ).write.parquet(path)
    plan = plan_text(clean.delivered(spark.read.parquet(path)))
    assert "PushedFilters" in plan and "IsNotNull(order_id)" in plan and "EqualTo(order_status,Delivered)" in plan
    assert "GreaterThanOrEqual(grand_total,0.0)" in plan


def test_money_is_validated_before_it_is_converted(spark):
    schema = "order_id string, customer_id string, product_id string, order_date date, grand_total double, quantity int, rating double, order_status string"
    day = dt.date(2022, 1, 5)
    orders = spark.createDataFrame([(f"O{k}", "c", "p", day, v, 1, 3.0, "Delivered") for k, v in enumerate(
        [-0.004, 0.004, float("nan"), 12.5])], schema)
    assert sorted((r.order_id, float(r.grand_total)) for r in clean.clean_orders(orders).collect()) == [("O1", 0.0), ("O3", 12.5)]
    big = spark.createDataFrame([("O1", "c", "p", day, 1e17, 1, 3.0, "Delivered")], schema)
    with pytest.raises(Exception, match="does not fit"):
        clean.clean_orders(big).collect()


def test_reasons_are_built_for_rejected_rows_only(spark):
    schema = "k long, order_id string, customer_id string, product_id string, order_date date, grand_total double, quantity int"
    day = dt.date(2022, 1, 5)
    rows = [(k, f"O{k}", c, "p", d, t, q) for k, (c, d, t, q) in enumerate(
        [("c", day, 1.0, 1), (None, day, 1.0, 1), ("c", None, 1.0, 1), ("c", day, None, None), ("c", day, -1.0, 0),
         ("c", day, float("nan"), 1), ("c", day, 0.0, 1), (None, None, None, None)])]
    orders = spark.createDataFrame(rows, schema)
    # a join and computed columns, through which Spark moves a filter
    joined = orders.join(spark.range(8).withColumnRenamed("id", "j"), F.expr("k = j and quantity + j > -1 or j = 99"), "left")
    joined = joined.withColumn("grand_total", F.col("grand_total") * F.when(F.col("j") >= 0, 1).otherwise(1))
    rejected = clean.rejected_orders(joined)
    optimized = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("missing customer_id") == 1  # in the projection, not in a filter or a join condition
    got = {r.order_id: list(r._reasons) for r in rejected.collect()}
    assert got == {r.order_id: list(r._reasons) for r in joined.withColumn("_reasons", clean.rejections(joined)).collect() if r._reasons}
    assert sorted(got) == ["O1", "O2", "O3", "O4", "O5", "O7"]
    assert sorted(r.order_id for r in clean.validate_orders(joined).collect()) == ["O0", "O6"]


def test_defects_need_no_text_of_the_order_id(spark):
    from mercato.sources import testdata
    orders = testdata.defective_orders(spark, "/root/testdata/sf0.001")
    assert "_orderkey" not in orders.columns
    assert "split" not in clean.rejected_orders(orders)._jdf.queryExecution().optimizedPlan().toString()
