"""Report job (E1, K1): three inputs -> delivered working set -> seven reports -> CSV.

    python -m mercato.plans.report_job INPUT_PATH OUTPUT_PATH [--single-file]
        [--orders-file orders.csv] [--customers-file customers.csv] [--products-file products.csv]

The orders are read once: the delivered, validated ones are written as parquet to the
shared checkpoint folder (``spark.checkpoint.dir``), so the seven reports read
a compact columnar copy (each only its columns) instead of re-parsing the CSV
seven times, and a lost executor never forces a re-parse; beside them go the rejected
orders with their reasons. These and all other intermediate tables are removed when the job ends. Each report is computed once, by its
write; its row count is collected during that write with an ``Observation``
(no second job). Writers run in parallel -- one file per task -- unless
``single_file`` asks for one file per report.
"""

from __future__ import annotations

import argparse
import sys
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from mercato.operators import clean, reports
from mercato.session import cut_lineage, drop_table_files, publish, table_path, written_tables
from mercato.sources.files import CORRUPT, read_report_inputs

# Columns of the fact that any report reads.
WORKING_SET_COLUMNS = ["order_id", "customer_id", "order_date", "product_id", "product_type", "category",
                       "quantity", "discount_percent", "discount_amount", "grand_total", "payment_method",
                       "region", "rating", "is_prime_member"]

REPORT_NAMES = ("revenue_analysis", "product_performance", "rfm_analysis", "customer_360",
                "time_series", "cohort_analysis", "statistical_analysis")


# Columns of a rejected order, beside its reasons.
REJECTED_COLUMNS = ["order_id", "customer_id", "order_date_text", "product_id", "quantity", "grand_total_text", "order_status"]


def working_set(orders: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int], str]:
    """One pass over the orders: (delivered, rejected, counts, path).

    Delivered, validated orders, with only the columns the reports use, and rejected orders, with their reasons, are
    written as two partitions of one parquet table in the shared checkpoint folder; the numbers of
    orders, delivered and rejected orders are observed during that write.
    """
    spark = orders.sparkSession
    texts = {"order_date_text": F.col("order_date").cast("string"), CORRUPT: F.lit(None).cast("string")}
    orders = orders.withColumns({c: e for c, e in texts.items() if c not in orders.columns})
    obs = Observation()
    rows = clean.sorted_out(orders.withColumn("grand_total_text", F.col("grand_total").cast("string"))).observe(
        obs, F.count(F.lit(1)).alias("orders"), F.count_if(F.col("_kind") == "delivered").alias("delivered"),
        F.count_if(F.col("_kind") == "rejected").alias("rejected"))
    kept = rows.filter(F.col("_kind") != "other").select(*dict.fromkeys([*WORKING_SET_COLUMNS, *REJECTED_COLUMNS, CORRUPT, "_reasons", "_kind"]))
    path = table_path(spark, "working_set")
    kept.write.partitionBy("_kind").parquet(path)
    table = spark.read.schema(kept.schema).parquet(path)
    delivered = table.filter("_kind = 'delivered'").select(*WORKING_SET_COLUMNS)
    rejected = table.filter("_kind = 'rejected'").select(
        *REJECTED_COLUMNS, F.array_join("_reasons", "; ").alias("reasons"), F.col(CORRUPT).alias("line"))
    return delivered, rejected, {k: int(v) for k, v in obs.get.items()}, path


def build_reports(delivered: DataFrame, customers: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """The seven result sets; the RFM table, which two of them read, is written once."""
    rfm = cut_lineage(reports.rfm_analysis(delivered))
    return {
        "revenue_analysis": reports.revenue_analysis(delivered),
        "product_performance": reports.product_performance(delivered),
        "rfm_analysis": rfm,
        "customer_360": reports.customer_360(delivered, customers, products, rfm=rfm, materialised=True),
        "time_series": reports.daily_sales_moving_avg(delivered),
        "cohort_analysis": reports.sorted_cohorts(reports.cohort_retention(delivered)),
        "statistical_analysis": reports.statistical_profile(delivered, materialised=True),
    }


def write_reports(results: dict[str, DataFrame], output_path: str, single_file: bool = False) -> dict[str, int]:
    """K1: each result as CSV with header under ``{output_path}/{name}``, replacing what is there.

    All results are written to a staging folder beside them first and moved when the last one is complete: a job
    that stops halfway leaves the old reports. Returns the row count of each report, observed
    during its write.
    """
    root = output_path.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    spark, counts = next(iter(results.values())).sparkSession, {}
    try:
        for name, df in results.items():
            obs = Observation(name)
            text = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema if isinstance(f.dataType, NullType)}
            out = df.withColumns(text).observe(obs, F.count(F.lit(1)).alias("rows"))  # CSV has no columns without a type
            if single_file:
                out = out.coalesce(1)
            out.write.option("header", "true").csv(f"{staging}/{name}")
            counts[name] = int(obs.get["rows"])
        publish(spark, {f"{root}/{name}": f"{staging}/{name}" for name in results})
    finally:
        drop_table_files(spark, staging)
    return counts


def input_counts(seen: dict[str, int], customers: DataFrame, products: DataFrame) -> dict[str, int]:
    """T0's counts: orders, delivered and rejected ones (observed), customers, products."""
    return {**seen, "customers": customers.count(), "products": products.count()}


def run(spark: SparkSession, input_path: str, output_path: str, single_file: bool = False,
        file_names: dict[str, str] | None = None) -> dict[str, int]:
    """The job: seven reports, ``rejected_orders`` with the reasons, and ``run_counts`` with the row
    counts of the inputs and of every output. Returns these counts."""
    orders, customers, products = read_report_inputs(spark, input_path, file_names, keep_corrupt=True)
    with written_tables(spark):
        delivered, rejected, seen, _ = working_set(orders)
        counts = input_counts(seen, customers, products)
        results = {**build_reports(delivered, customers, products), "rejected_orders": rejected}
        counts |= write_reports(results, output_path, single_file)
        summary = spark.createDataFrame(sorted(counts.items()), "name string, row_count long").coalesce(1)
        write_reports({"run_counts": summary}, output_path)
    return counts


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from mercato.session import get_session

    p = argparse.ArgumentParser(description="Sales reports from orders, customers and products CSV files.")
    p.add_argument("input_path")
    p.add_argument("output_path")
    p.add_argument("--single-file", action="store_true", help="one CSV file per report")
    p.add_argument("--orders-file", default="orders.csv")
    p.add_argument("--customers-file", default="customers.csv")
    p.add_argument("--products-file", default="products.csv")
    args = p.parse_args(argv)
    spark = spark or get_session(app_name="mercato-reports")
    t0 = time.time()
    names = {"orders": args.orders_file, "customers": args.customers_file, "products": args.products_file}
    counts = run(spark, args.input_path.rstrip("/"), args.output_path.rstrip("/"), args.single_file, names)
    for name, n in counts.items():
        print(f"{name}: {n} rows", file=sys.stderr)
    print(f"done in {time.time() - t0:.2f} s", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
