import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from mercato.plans import diff_job, report_job
from mercato.schemas import ORDERS_SCHEMA
from mercato.session import ensure_checkpoint_dir
from mercato.sources import generate as G


def _write_inputs(spark, root, n=4000):
    orders = G.generate_orders(spark.range(n), 500, 800)
    orders.write.mode("overwrite").option("header", "true").csv(f"{root}/orders.csv")
    G.generate_customers(orders).write.mode("overwrite").option("header", "true").csv(f"{root}/customers.csv")
    G.generate_products(orders).write.mode("overwrite").option("header", "true").csv(f"{root}/products.csv")
    return orders


def test_report_job_end_to_end(spark, scratch):
    orders = _write_inputs(spark, f"{scratch}/in")
    rc = report_job.main([f"{scratch}/in/", f"{scratch}/out/"], spark=spark)
    assert rc == 0
    for name in report_job.REPORT_NAMES:
        df = spark.read.option("header", "true").csv(f"{scratch}/out/{name}")
        assert df.count() > 0, name
    delivered = orders.filter("order_status = 'Delivered'").count()
    ts = spark.read.option("header", "true").option("inferSchema", "true").csv(f"{scratch}/out/time_series")
    assert ts.agg(F.sum("daily_orders")).first()[0] == delivered
    counts = report_job.run(spark, f"{scratch}/in", f"{scratch}/out2", single_file=True)
    assert counts["time_series"] == ts.count()
    assert len([f for f in os.listdir(f"{scratch}/out2/revenue_analysis") if f.endswith(".csv")]) == 1


def test_diff_job_directory_mode_writes_summary(spark, scratch):
    a, b = f"{scratch}/a", f"{scratch}/b"
    base = spark.range(500).select("id", (F.col("id") * 0.5).alias("x"))
    base.write.parquet(f"{a}/t1")
    base.write.parquet(f"{b}/t1")
    base.write.parquet(f"{a}/t2")
    base.filter("id % 50 <> 0").write.parquet(f"{b}/t2")
    rc = diff_job.main(["--tables", "t1", "t2", "--control-root", a, "--target-root", b,
                        "--row-diff-tolerance", "0.05", "--output-path", f"{scratch}/res"], spark=spark)
    assert rc == 0
    summaries = [d for d in os.listdir(f"{scratch}/res") if d.startswith("comparison_summary_")]
    assert len(summaries) == 1
    part = [f for f in os.listdir(f"{scratch}/res/{summaries[0]}") if f.startswith("part-")][0]
    doc = json.loads(open(f"{scratch}/res/{summaries[0]}/{part}").readline())
    assert doc["total_tables"] == 2 and doc["passed_tables"] == 2 and len(doc["results"]) == 2
    assert any(d.startswith("t2_") and d.endswith("_missing_rows.csv") for d in os.listdir(f"{scratch}/res"))
    rc = diff_job.main(["--tables", "t2", "--control-root", a, "--target-root", b], spark=spark)
    assert rc == 1


def test_diff_job_catalog_mode(spark):
    spark.range(10).createOrReplaceTempView("cat_a")
    spark.range(10).createOrReplaceTempView("cat_b")
    assert diff_job.main(["--control-tables", "cat_a", "--target-tables", "cat_b"], spark=spark) == 0


def test_diff_job_csv_directories_with_options(spark, scratch):
    a, b = f"{scratch}/ca", f"{scratch}/cb"
    rows = spark.range(300).select("id", (F.col("id") % 7).alias("g"), (F.col("id") / 4).alias("x"))
    rows.write.option("header", "false").option("sep", "|").csv(f"{a}/t")
    rows.filter("id <> 5").write.option("header", "false").option("sep", "|").csv(f"{b}/t")
    comps = diff_job.compare_directories(spark, ["t"], a, b, "csv",
                                         dict(csv_header=False, csv_infer_schema=True, csv_delimiter="|"))
    r = comps[0].result.first()
    assert (r.control_count, r.target_count, r.missing_rows_count, r.new_rows_count) == (300, 299, 1, 0)
    assert dict(comps[0].counts.dtypes)["_c2"] == "double"   # inferred, not string


def test_no_python_udf_in_any_registered_plan(spark):
    from mercato.plans import catalog
    from mercato.plans.inspect import has_python_udf
    for name, fn in catalog.QUERIES.items():
        assert not has_python_udf(fn(spark, "/root/testdata/sf0.001")), name


def test_report_job_custom_file_names(spark, scratch):
    orders = G.generate_orders(spark.range(800), 100, 150)
    orders.write.option("header", "true").csv(f"{scratch}/in/my_orders.csv")
    G.generate_customers(orders).write.option("header", "true").csv(f"{scratch}/in/my_customers.csv")
    G.generate_products(orders).write.option("header", "true").csv(f"{scratch}/in/my_products.csv")
    rc = report_job.main([f"{scratch}/in", f"{scratch}/out", "--orders-file", "my_orders.csv",
                          "--customers-file", "my_customers.csv", "--products-file", "my_products.csv"],
                         spark=spark)
    assert rc == 0 and spark.read.option("header", "true").csv(f"{scratch}/out/customer_360").count() > 0


def test_diff_job_goes_on_after_a_bad_table(spark, scratch, capsys):
    for side in ("a", "b"):
        for t in ("t1", "t3"):
            spark.range(5).write.parquet(f"{scratch}/{side}/{t}")
    spark.range(3).write.parquet(f"{scratch}/a/t2")
    spark.range(3).selectExpr("id AS other").write.parquet(f"{scratch}/b/t2")
    code = diff_job.main(["--tables", "t1", "t2", "t3", "t4", "--control-root", f"{scratch}/a", "--target-root", f"{scratch}/b",
                          "--output-path", f"{scratch}/out"], spark=spark)
    summary = spark.read.json(f"{scratch}/out/comparison_summary_*.json").first()
    assert code == 1 and (summary.passed_tables, summary.failed_tables) == (2, 2)
    errors = {r.table_name: r.asDict().get("grouped_comparison_error") for r in summary.results}
    assert "SchemaMismatch" in errors["t2"] and errors["t4"] and not errors["t1"] and not errors["t3"]


BAD_LINES = [
    "O1,C1,2022-01-05,,P1,Laptop,Electronics,2,5.25,10.5,0,0,10.5,Standard,0,0,10.5,UPI,North,Boston,New,Delivered,4,true",
    "O2,C1,2022-13-45,,P1,Laptop,Electronics,2,5.25,10.5,0,0,10.5,Standard,0,0,10.5,UPI,North,Boston,New,Delivered,4,true",
    "O3,,2022-01-05,,P1,Laptop,Electronics,two,5.25,10.5,0,0,10.5,Standard,0,0,-1,UPI,North,Boston,New,Delivered,4,true",
    "O4,C2,2022-01-06,,P1,Laptop,Electronics,0,5.25,10.5,0,0,10.5,Standard,0,0,NaN,UPI,North,Boston,New,Returned,4,true",
    "O5,C2,2022-01-06,,P2,Laptop,Electronics,1,5.25,10.5,0,0,10.5,Standard,0,0,7.25,UPI,North,Boston,New,Returned,4,true",
    "O6,C2",
]


def test_rejected_rows_and_counts(spark, scratch):
    os.makedirs(f"{scratch}/in")
    columns = ORDERS_SCHEMA.fieldNames()
    with open(f"{scratch}/in/orders.csv", "w") as f:
        f.write("\n".join([",".join(columns), *BAD_LINES]) + "\n")
    spark.createDataFrame([("C1", 30, "M", 100, 5, "UPI"), ("C2", 31, "F", 50, 2, "UPI")],
                          "customer_id string, age int, gender string, account_age_days int, total_lifetime_orders int, preferred_payment string"
                          ).write.option("header", "true").csv(f"{scratch}/in/customers.csv")
    spark.createDataFrame([(f"P{k}", "b", "s", 1, 4.0, 2) for k in range(3)],
                          "product_id string, brand string, seller_id string, stock_quantity int, avg_rating double, num_reviews int"
                          ).write.option("header", "true").csv(f"{scratch}/in/products.csv")
    tables = ensure_checkpoint_dir(spark).removeprefix("file://") + "/tables"
    before = set(os.listdir(tables)) if os.path.exists(tables) else set()
    counts = report_job.run(spark, f"{scratch}/in", f"{scratch}/out")
    assert {k: counts[k] for k in ("orders", "delivered", "rejected", "customers", "products", "rejected_orders")} == {
        "orders": 6, "delivered": 1, "rejected": 4, "customers": 2, "products": 3, "rejected_orders": 4}
    got = {r.order_id: r for r in spark.read.option("header", "true").csv(f"{scratch}/out/rejected_orders").collect()}
    assert {k: r.reasons for k, r in got.items()} == {
        "O2": "unreadable order_date",
        "O3": "missing customer_id; unreadable quantity; negative grand_total",
        "O4": "not a number grand_total; not positive quantity",
        "O6": "missing product_id; missing order_date; missing grand_total; missing quantity"}
    assert got["O2"].order_date_text == "2022-13-45" and got["O3"].line == BAD_LINES[2] and got["O2"].line is None
    written = {r.name: int(r.row_count) for r in spark.read.option("header", "true").csv(f"{scratch}/out/run_counts").collect()}
    assert written == counts
    assert set(os.listdir(tables)) == before  # intermediates are gone


def test_a_job_that_stops_halfway_leaves_the_old_reports(spark, scratch):
    good = {n: spark.range(3).withColumn("v", F.lit("old")) for n in ("a", "b")}
    report_job.write_reports(good, scratch)
    bad = {"a": spark.range(5).withColumn("v", F.lit("new")),
           "b": spark.range(5).withColumn("v", F.raise_error(F.lit("killed")))}
    with pytest.raises(Exception, match="killed"):
        report_job.write_reports(bad, scratch)
    assert sorted(os.listdir(scratch)) == ["a", "b"]
    for n in "ab":
        assert {r.v for r in spark.read.option("header", "true").csv(f"{scratch}/{n}").collect()} == {"old"}
    report_job.write_reports({n: spark.range(5).withColumn("v", F.lit("new")) for n in "ab"}, scratch)
    assert spark.read.option("header", "true").csv(f"{scratch}/a").count() == 5 and sorted(os.listdir(scratch)) == ["a", "b"]


def test_many_tables_are_compared_at_once(spark, scratch):
    for t in range(8):
        base = spark.range(200).withColumn("x", F.col("id") % 7)
        base.write.parquet(f"{scratch}/a/t{t}")
        base.filter(F.col("id") % 50 != t).write.parquet(f"{scratch}/b/t{t}")
    names = [f"t{t}" for t in range(8)]
    seen = {}
    for threads in (1, 8):
        comps = diff_job.compare_directories(spark, names, f"{scratch}/a", f"{scratch}/b", run=True, threads=threads, run_timestamp="now")
        seen[threads] = [c.result.first().asDict() for c in comps]
    assert seen[1] == seen[8] and [r["missing_rows_count"] for r in seen[8]] == [4] * 8

    together, peak, lock = [0], [0], threading.Lock()

    def task():
        with lock:
            together[0] += 1
            peak[0] = max(peak[0], together[0])
        time.sleep(0.3)
        with lock:
            together[0] -= 1
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    pools = diff_job._each(spark, [task] * 8, 4)
    assert peak[0] == 4 and set(pools) == {f"compare-{k}" for k in range(4)}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
