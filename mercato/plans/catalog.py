"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, and their oracle SQL.

Every query reads the driver's parquet tables at ``sf_dir`` (through the
adapter in ``mercato.sources.testdata``) and runs over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import clean, diff, digests, reports
from mercato.plans import diff_job, report_job
from mercato.plans import oracle_sql as osql
from mercato.sources import snapshots, testdata

# Run label of the registered diff checks (the jobs stamp the current time).
RUN_TS = osql.RUN_TS
TOL = osql.DIFF_TOLERANCE


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.delivered(testdata.fact(spark, sf_dir, status=clean.DELIVERED))


def validated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.clean_orders(testdata.fact(spark, sf_dir))
    money = ("total_amount", "discount_amount", "grand_total")
    return cleaned.withColumns({c: F.col(c).cast("double") for c in money})


def revenue_analysis(spark, sf_dir):
    return reports.revenue_analysis(_delivered(spark, sf_dir))


def product_performance(spark, sf_dir):
    return reports.product_performance(_delivered(spark, sf_dir))


def rfm_analysis(spark, sf_dir):
    return reports.rfm_analysis(_delivered(spark, sf_dir))


def customer_360(spark, sf_dir):
    return reports.customer_360(_delivered(spark, sf_dir), testdata.customers(spark, sf_dir),
                                testdata.products(spark, sf_dir))


def daily_sales_moving_avg(spark, sf_dir):
    return reports.daily_sales_moving_avg(_delivered(spark, sf_dir))


def daily_sales_calendar(spark, sf_dir):
    return reports.daily_sales_moving_avg(_delivered(spark, sf_dir), calendar=True)


def rejected_orders(spark, sf_dir):
    rejected = clean.rejected_orders(testdata.defective_orders(spark, sf_dir))
    return rejected.select("order_id", F.array_join("_reasons", "; ").alias("reasons"))


def input_counts(spark, sf_dir):
    """The job's counts, from the same single pass that writes its working set."""
    _, _, seen, _ = report_job.working_set(testdata.defective_orders(spark, sf_dir))
    counts = report_job.input_counts(seen, testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def cohort_retention(spark, sf_dir):
    return reports.cohort_retention(_delivered(spark, sf_dir))


def statistical_profile(spark, sf_dir):
    return reports.statistical_profile(_delivered(spark, sf_dir))


def _orders_comparison(spark, sf_dir, **kw) -> diff.Comparison:
    control, target = testdata.orders_diff_pair(spark, sf_dir)
    return diff.compare_tables(control, target, "orders", tolerance=TOL, run_timestamp=RUN_TS, **kw)


def diff_missing(spark, sf_dir):
    return _orders_comparison(spark, sf_dir).missing


def diff_new(spark, sf_dir):
    return _orders_comparison(spark, sf_dir).new


def diff_multiplicity(spark, sf_dir):
    return _orders_comparison(spark, sf_dir).changed


def diff_result(spark, sf_dir):
    return _orders_comparison(spark, sf_dir).result


def diff_by_digests(spark, sf_dir):
    control, target = testdata.orders_few_changes(spark, sf_dir)
    return digests.compare_by_digests(control, target, "o_orderkey", "orders", tolerance=TOL, run_timestamp=RUN_TS).result


def diff_rounded(spark, sf_dir):
    return _orders_comparison(spark, sf_dir, precision=osql.ROUND_PRECISION).result


def diff_stringified(spark, sf_dir):
    control, target = testdata.orders_diff_pair(spark, sf_dir)
    return diff.compare_tables(diff.stringify(control), diff.stringify(target), "orders",
                               tolerance=TOL, run_timestamp=RUN_TS).result


def _register_pairs(spark, sf_dir) -> list[tuple[str, str]]:
    pairs = []
    for name, pair in (("orders", testdata.orders_diff_pair), ("customer", testdata.customer_diff_pair)):
        control, target = pair(spark, sf_dir)
        control.createOrReplaceTempView(f"{name}_control")
        target.createOrReplaceTempView(f"{name}_target")
        pairs.append((f"{name}_control", f"{name}_target"))
    return pairs


def diff_multi_table(spark, sf_dir):
    comps = diff_job.compare_catalog_pairs(spark, _register_pairs(spark, sf_dir), tolerance=TOL,
                                           run_timestamp=RUN_TS)
    return diff_job.results_frame(comps)


def diff_summary(spark, sf_dir):
    summary = diff_job.run_summary(diff_multi_table(spark, sf_dir), TOL, run_timestamp=RUN_TS)
    # the nested records as JSON text, which both engines compare by value
    return summary.withColumn("results", F.to_json("results", {"ignoreNullFields": "false"}))


def diff_directories(spark, sf_dir):
    tables = [f"{t}.parquet" for t in osql.DIRECTORY_TABLES]
    target = testdata.directory_target(spark, sf_dir, osql.DIRECTORY_TABLES)
    comps = diff_job.compare_directories(spark, tables, sf_dir, target, "parquet", tolerance=TOL,
                                         run_timestamp=RUN_TS)
    return diff_job.results_frame(comps)


def snapshot_ancestors(spark, sf_dir):
    return snapshots.ancestors(testdata.orders_history(spark, sf_dir).lineage)


def common_ancestor(spark, sf_dir):
    history = testdata.orders_history(spark, sf_dir)
    ctrl, tgt = testdata.history_pair(spark, sf_dir)
    return snapshots.common_ancestor(history.lineage, history.name, ctrl, tgt)


def changelog(spark, sf_dir):
    history = testdata.orders_history(spark, sf_dir)
    ctrl, tgt = testdata.history_pair(spark, sf_dir)
    control_changes, _, _ = snapshots.cdc_views(history, ctrl, tgt)
    return control_changes


def cdc_diff(spark, sf_dir):
    history = testdata.orders_history(spark, sf_dir)
    ctrl, tgt = testdata.history_pair(spark, sf_dir)
    return snapshots.compare_snapshots(history, ctrl, tgt, tolerance=TOL, run_timestamp=RUN_TS).result


QUERIES = {
    "validated_orders": validated_orders,
    "revenue_analysis": revenue_analysis,
    "product_performance": product_performance,
    "rfm_analysis": rfm_analysis,
    "customer_360": customer_360,
    "daily_sales_moving_avg": daily_sales_moving_avg,
    "daily_sales_calendar": daily_sales_calendar,
    "rejected_orders": rejected_orders,
    "input_counts": input_counts,
    "cohort_retention": cohort_retention,
    "statistical_profile": statistical_profile,
    "diff_missing": diff_missing,
    "diff_new": diff_new,
    "diff_multiplicity": diff_multiplicity,
    "diff_result": diff_result,
    "diff_by_digests": diff_by_digests,
    "diff_rounded": diff_rounded,
    "diff_stringified": diff_stringified,
    "diff_multi_table": diff_multi_table,
    "diff_summary": diff_summary,
    "diff_directories": diff_directories,
    "snapshot_ancestors": snapshot_ancestors,
    "common_ancestor": common_ancestor,
    "changelog": changelog,
    "cdc_diff": cdc_diff,
}

ORACLE_SQL = {**osql.REPORT_SQL, **osql.DIFF_SQL}


# ------------------------------------------------------------- generator
def _generated_orders(spark, sf_dir):
    from mercato.sources import generate
    ids = testdata.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    n = ids.count()
    return generate.generate_orders(ids, max(1, n // 5), max(1, n // 2))


def generated_orders(spark, sf_dir):
    return _generated_orders(spark, sf_dir)


def generated_customers(spark, sf_dir):
    from mercato.sources import generate
    return generate.generate_customers(_generated_orders(spark, sf_dir))


def generated_products(spark, sf_dir):
    from mercato.sources import generate
    return generate.generate_products(_generated_orders(spark, sf_dir))


def _generator_sql(which: str) -> str:
    from mercato.sources import generate
    return generate.oracle_sql("SELECT o_orderkey AS id FROM orders",
                               "SELECT greatest(1, COUNT(*) // 5) FROM orders",
                               "SELECT greatest(1, COUNT(*) // 2) FROM orders", which)


QUERIES.update({
    "generated_orders": generated_orders,
    "generated_customers": generated_customers,
    "generated_products": generated_products,
})
ORACLE_SQL.update({
    "generated_orders": _generator_sql("orders"),
    "generated_customers": _generator_sql("customers"),
    "generated_products": _generator_sql("products"),
})


# ------------------------------------------------------ ranking operators
# Small buckets so that even the sf0.01 tables are ranked across several tasks.
RANK_DEMO_ROWS_PER_BUCKET = 10_000
_LI_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def global_rank(spark, sf_dir):
    from mercato.operators.ranking import row_number_over
    li = testdata.read(spark, sf_dir, "lineitem").select(*_LI_KEYS, "l_extendedprice")
    return row_number_over(li, "price_rank", [("l_extendedprice", False)], tiebreak=_LI_KEYS,
                           rows_per_bucket=RANK_DEMO_ROWS_PER_BUCKET)


def global_ntile(spark, sf_dir):
    from mercato.operators.ranking import ntile_over
    li = testdata.read(spark, sf_dir, "lineitem").select(*_LI_KEYS, "l_quantity")
    return ntile_over(li, "quantity_quintile", 5, [("l_quantity", True)], tiebreak=_LI_KEYS,
                      rows_per_bucket=RANK_DEMO_ROWS_PER_BUCKET)


_LI_ORDER = ", ".join(f"{k} ASC NULLS FIRST" for k in _LI_KEYS)
QUERIES.update({"global_rank": global_rank, "global_ntile": global_ntile})
ORACLE_SQL.update({
    "global_rank": f"""SELECT {', '.join(_LI_KEYS)}, l_extendedprice,
       CAST(row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, {_LI_ORDER}) AS BIGINT) AS price_rank
FROM lineitem""",
    "global_ntile": f"""SELECT {', '.join(_LI_KEYS)}, l_quantity,
       CAST(ntile(5) OVER (ORDER BY l_quantity ASC NULLS FIRST, {_LI_ORDER}) AS INTEGER) AS quantity_quintile
FROM lineitem""",
})
