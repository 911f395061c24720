"""The seven sales reports (T1-T7) as DataFrame -> DataFrame operators.

Every report reads the *delivered* working set (``operators.clean.delivered``).
Money is exact ``decimal(18,2)`` inside and ``double`` in the output; every
tie is broken by the report's grain keys, so results do not depend on
partitioning or task order.

Scale notes (one line each, details in README):
* aggregations run partial + final, so a hot key is combined map-side;
* global ranks and ntiles compare rows with a few exact keys (``operators.ranking``):
  no single task, no sort of the whole table;
* ``daily_sales_moving_avg`` uses one global window over one row per *day*:
  its size is bounded by the calendar, not by the data;
* ``cohort_retention`` pre-aggregates per customer and day; ``customer_360``
  fetches the brand by a join that splits heavy products (``operators.joins``)
  and counts brands in bit sets, all combined before one shuffle by customer;
* ``statistical_profile`` selects its quantiles by counting (``operators.selection``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import (count_when, mean_of, month_label, months_since,
                               ratio_or_zero, round_ratio, stddev_exact)
from mercato.operators.joins import join_dimension
from mercato.operators.ranking import RankSpec, add_tiles, ranks_of, top_k_per_group
from mercato.operators.selection import group_quantiles
from mercato.session import cut_lineage, cut_lineage_counted, write_table

MONEY_SCALE = 2
QUANTILES = (0.25, 0.5, 0.75)

# Segment rule, first match wins (fixed values of the report contract):
#   r >= 4 and f >= 4 and m >= 4 -> Champions
#   r >= 3 and f >= 3            -> Loyal Customers
#   r >= 4 and f <= 2            -> Promising
#   r <= 2 and f >= 3            -> At Risk
#   r <= 2 and f <= 2            -> Lost
#   otherwise                    -> Regular
SEGMENTS = ("Champions", "Loyal Customers", "Promising", "At Risk", "Lost", "Regular")


def _money(c: str):
    return F.col(c).cast("double")


# --------------------------------------------------------------------- T1
def revenue_analysis(delivered: DataFrame) -> DataFrame:
    """Revenue by region x category x payment method."""
    keys = ["region", "category", "payment_method"]
    g = delivered.groupBy(*keys).agg(
        F.sum("grand_total").alias("_rev"),
        F.count("order_id").alias("order_count"),
        mean_of("grand_total").alias("avg_order_value"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        mean_of("discount_percent").alias("avg_discount_pct"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    return g.select(
        *keys,
        _money("_rev").alias("total_revenue"),
        "order_count", "avg_order_value", "total_quantity", "avg_discount_pct", "unique_customers",
        ratio_or_zero("_rev", "unique_customers", num_scale=MONEY_SCALE).alias("revenue_per_customer"),
    )


# --------------------------------------------------------------------- T2
def product_performance(delivered: DataFrame, top_k: int = 5) -> DataFrame:
    """Products ranked by revenue in their category, region and overall; top k per category.

    All ranks and the category share are over the *whole* set. The top k are
    taken first; their other ranks are counts of the rows before them.
    """
    grain = ["product_id", "product_type", "category", "region"]
    perf = delivered.groupBy(*grain).agg(
        F.sum("grand_total").alias("_rev"),
        F.sum("quantity").cast("bigint").alias("total_sold"),
        F.countDistinct("customer_id").alias("unique_buyers"),
    )
    # Written once to the shared checkpoint folder: read for the top k, the counts and the shares.
    perf = cut_lineage(perf)
    order = (("_rev", False),)
    top = cut_lineage(top_k_per_group(perf, top_k, ["category"], list(order), grain, "rank_in_category"))
    ranked = ranks_of(top, perf, RankSpec("overall_rank", order, (), tuple(grain)), "region", "rank_in_region")
    totals = perf.groupBy(F.col("category").alias("_cat")).agg(F.sum("_rev").alias("_cat_rev"))
    joined = ranked.join(totals, ranked["category"].eqNullSafe(totals["_cat"]))
    return joined.select(
        *grain,
        _money("_rev").alias("product_revenue"), "total_sold", "unique_buyers",
        "rank_in_category", "rank_in_region", "overall_rank",
        round_ratio("_rev", "_cat_rev", multiplier=100, num_scale=MONEY_SCALE,
                    den_scale=MONEY_SCALE).alias("category_revenue_pct"),
    )


# --------------------------------------------------------------------- T3
def _segment(r, f, m):
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), SEGMENTS[0])
            .when((r >= 3) & (f >= 3), SEGMENTS[1])
            .when((r >= 4) & (f <= 2), SEGMENTS[2])
            .when((r <= 2) & (f >= 3), SEGMENTS[3])
            .when((r <= 2) & (f <= 2), SEGMENTS[4])
            .otherwise(SEGMENTS[5]))


def rfm_analysis(delivered: DataFrame, best_is_high: bool = False) -> DataFrame:
    """Recency / frequency / monetary quintiles and a segment per customer.

    Default scoring is the contract's: ntile(5) by recency ascending and by
    frequency / monetary descending, so score 1 is the *best* customers while
    the segment rule treats >= 4 as best. ``best_is_high=True`` flips the three
    orders to the usual RFM convention (5 = best).
    """
    per_customer = delivered.groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        F.count("order_id").alias("frequency"),
        F.sum("grand_total").alias("_monetary"),
    )
    return rfm_scores(*cut_lineage_counted(per_customer), best_is_high)


def rfm_scores(per_customer: DataFrame, n_rows: int, best_is_high: bool = False) -> DataFrame:
    """RFM from a materialised table of ``n_rows`` customers: ``customer_id, _last, frequency, _monetary``.

    Recency is measured from the latest order date of the whole set = the
    latest of the customers' last dates: a scalar subquery over this small
    table (no driver round trip, no join, no second pass over the orders).
    """
    asc_r, asc_fm = (False, True) if best_is_high else (True, False)
    tie = ("customer_id",)
    scored = add_tiles(per_customer, [  # a recent last date is a small recency
        RankSpec("r_score", (("_last", not asc_r),), (), tie, 5),
        RankSpec("f_score", (("frequency", asc_fm),), (), tie, 5),
        RankSpec("m_score", (("_monetary", asc_fm),), (), tie, 5),
    ], n_rows)
    ref_date = per_customer.select(F.max("_last")).scalar()
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "customer_id", F.datediff(ref_date, F.col("_last")).alias("recency"), "frequency",
        _money("_monetary").alias("monetary"), "r_score", "f_score", "m_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_score"),
        _segment(r, f, m).alias("customer_value"),
    )


# --------------------------------------------------------------------- T4
CUSTOMER_KEYS = ["customer_id", "age", "gender", "customer_value", "account_age_days",
                 "total_lifetime_orders", "preferred_payment"]


MAX_BRAND_WORDS = 16  # brands up to 1,024 are counted in bit sets of 64


def _numbered_brands(products: DataFrame) -> tuple[DataFrame, int]:
    """(product_id, _brand, _times, _nth[, _number]) per product and brand, written, and the number of words of the bit sets.

    _times counts the product's rows of the brand, _nth numbers its brands. Up to 64 * MAX_BRAND_WORDS brands
    have a dense number; with more there are no words.
    """
    most = 64 * MAX_BRAND_WORDS
    known = sorted(r[0] for r in products.select("brand").where("brand IS NOT NULL").distinct().limit(most + 1).collect())
    listed = products.groupBy("product_id", F.col("brand").alias("_brand")).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    listed = listed.withColumn("_nth", F.row_number().over(Window.partitionBy("product_id").orderBy("_brand")))
    if len(known) > most:
        return write_table(listed, "product-brands")[0], 0
    numbers = listed.sparkSession.createDataFrame(list(zip(known, range(len(known)))), "_brand string, _number int")
    return write_table(listed.join(F.broadcast(numbers), "_brand", "left"), "product-brands")[0], -(-len(known) // 64)


def customer_360(delivered: DataFrame, customers: DataFrame, products: DataFrame,
                 rfm: DataFrame | None = None, materialised: bool = False) -> DataFrame:
    """One row per customer (and attribute set): orders, value, brands, rating, discounts.

    Orders without a customer or product row drop out (inner joins); customers
    without an RFM row keep a NULL segment (left join). Duplicate dimension
    rows fan out exactly as a row-level join would: a customer listed twice with
    the same attributes has every additive measure doubled.

    Plan: one pass over the orders. Each fetches its product's brands (listed
    with their number of rows) by a join that splits heavy products, then one
    aggregation per customer gives the sums of the report, over orders with a product,
    and those of the RFM table, over all orders. The distinct brands are bits of
    numbered brands, merged by ``bit_or``, so everything is combined before one shuffle by
    customer (with more than 1,024 brands: Spark's two-stage distinct count). The
    per-customer rows are written once and joined to the customers and the RFM segments.
    """
    listed, words = _numbered_brands(products)
    rows = join_dimension(delivered.select("customer_id", "product_id", "order_id", "order_date", "grand_total", "rating",
                                           "discount_percent", "discount_amount"), listed, "product_id", "left", materialised)
    once = F.coalesce(F.col("_nth"), F.lit(1)) == 1  # an order counts once for RFM, with a product or without
    times = F.col("_times")                          # NULL without a product row
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_number") % 64)
    brands = ([F.bit_or(F.when(F.floor(F.col("_number") / 64) == w, bit)).alias(f"_word{w}") for w in range(words)]
              or [F.countDistinct("_brand").alias("brands_purchased")])
    grouped = rows.groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        count_when(once & F.col("order_id").isNotNull()).alias("frequency"),
        F.sum(F.when(once, F.col("grand_total"))).alias("_monetary"),
        F.count(times).alias("_matched"),
        F.sum(F.when(F.col("order_id").isNotNull(), times).otherwise(0)).alias("_n"),
        F.sum(F.col("grand_total") * times).alias("_value"),
        F.sum(F.col("rating") * times).alias("_rating_sum"),
        F.sum(F.when(F.col("rating").isNotNull(), times).otherwise(0)).alias("_rating_n"),
        F.sum(F.when(F.col("discount_percent") > 0, times).otherwise(0)).alias("_disc_n"),
        F.sum(F.col("discount_amount") * times).alias("_disc_amt"), *brands)
    if words:
        bits = [F.coalesce(F.bit_count(f"_word{w}"), F.lit(0)) for w in range(words)]
        grouped = grouped.withColumn("brands_purchased", reduce(lambda a, b: a + b, bits).cast("bigint")).drop(
            *[f"_word{w}" for w in range(words)])
    per_c, n = cut_lineage_counted(grouped)
    if rfm is None:
        rfm = rfm_scores(per_c, n)
    per_c = per_c.filter(F.col("_matched") > 0).drop("_last", "frequency", "_monetary", "_matched")
    segs = rfm.select("customer_id", "customer_value")
    # Joined on customer_id (one row per customer on the left), then grouped by
    # the customer attributes: a customer listed twice with equal attributes
    # has its measures summed twice, as a row-level join would. The grouping
    # reuses the join's partitioning by customer_id (no further exchange).
    j = per_c.join(customers, "customer_id").join(segs, "customer_id", "left")
    g = j.groupBy(*CUSTOMER_KEYS).agg(
        F.sum("_n").alias("total_orders"),
        F.sum("_value").alias("_value"),
        F.max("brands_purchased").alias("brands_purchased"),
        F.sum("_rating_sum").alias("_rating_sum"),
        F.sum("_rating_n").alias("_rating_n"),
        F.sum("_disc_n").alias("_disc_n"),
        F.sum("_disc_amt").alias("_disc_amt"),
    )
    n = F.col("total_orders")
    return g.select(
        *CUSTOMER_KEYS,
        "total_orders",
        F.col("_value").cast("double").alias("lifetime_value"),
        (F.col("_value").cast("double") / n).alias("avg_order_value"),
        "brands_purchased",
        F.when(F.col("_rating_n") > 0, F.col("_rating_sum") / F.col("_rating_n")).alias("avg_rating_given"),
        F.col("_disc_n").cast("bigint").alias("orders_with_discount"),
        F.col("_disc_amt").cast("double").alias("total_discounts_availed"),
        ratio_or_zero("_disc_n", n, multiplier=100).alias("discount_affinity"),
        ratio_or_zero("_value", F.col("account_age_days"), num_scale=MONEY_SCALE).alias("daily_value"),
    )


# --------------------------------------------------------------------- T5
def daily_sales_moving_avg(delivered: DataFrame, calendar: bool = False) -> DataFrame:
    """Daily revenue and orders with 7- and 30-row moving averages.

    Frames count rows (days that have sales), not calendar days, and the
    first rows use the shorter frame they have. With ``calendar`` every day from the
    first sale to the last has a row (without sales: 0 orders, no average value)
    and the frames are the last 7 and 30 calendar days.
    """
    daily = delivered.groupBy("order_date").agg(
        F.sum("grand_total").alias("_rev"),
        F.count("order_id").alias("daily_orders"),
        mean_of("grand_total").alias("avg_order_value"),
    )
    # One row per calendar day: a single ordered partition is bounded by the
    # date range (about 366 rows per year of data), whatever the data volume.
    if calendar:
        daily = cut_lineage(daily)  # the spine and the sales read the same few rows
        spine = daily.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).where("lo IS NOT NULL").select(
            F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("order_date"))
        daily = spine.join(daily, "order_date", "left").withColumns({
            "_rev": F.coalesce("_rev", F.lit(0).cast(daily.schema["_rev"].dataType)),
            "daily_orders": F.coalesce("daily_orders", F.lit(0).cast("bigint"))})
        days = Window.orderBy(F.unix_date("order_date"))
        w7, w30 = days.rangeBetween(-6, 0), days.rangeBetween(-29, 0)
    else:
        w7 = Window.orderBy("order_date").rowsBetween(-6, 0)
        w30 = Window.orderBy("order_date").rowsBetween(-29, 0)
    return daily.select(
        "order_date",
        _money("_rev").alias("daily_revenue"),
        "daily_orders", "avg_order_value",
        round_ratio(F.sum("_rev").over(w7), F.count("_rev").over(w7),
                    num_scale=MONEY_SCALE).alias("revenue_7day_ma"),
        round_ratio(F.sum("_rev").over(w30), F.count("_rev").over(w30),
                    num_scale=MONEY_SCALE).alias("revenue_30day_ma"),
        round_ratio(F.sum("daily_orders").over(w7), F.count("daily_orders").over(w7)).alias("orders_7day_ma"),
        F.month("order_date").alias("month"),
        F.year("order_date").alias("year"),
        F.dayofweek("order_date").alias("day_of_week"),
    )


# --------------------------------------------------------------------- T6
def cohort_retention(delivered: DataFrame) -> DataFrame:
    """Distinct active customers by first-purchase month and months since it.

    One pass per customer: the set of the customer's distinct order *days*
    (merged map-side, and bounded by the calendar even for a customer with a
    third of all orders) gives the first purchase and every distinct month
    offset; the second shuffle only counts customers per (cohort, offset).
    """
    days = delivered.groupBy("customer_id").agg(F.collect_set("order_date").alias("_days"))
    first = F.array_min("_days")
    offsets = F.array_distinct(F.transform("_days", lambda d: months_since(d, first)))
    return (days.select(month_label(first).alias("cohort_month"),
                        F.explode(offsets).alias("months_since_first"))
            .groupBy("cohort_month", "months_since_first")
            .agg(F.count(F.lit(1)).alias("active_customers")))


def sorted_cohorts(cohorts: DataFrame) -> DataFrame:
    """Sink order: by cohort month, then offset."""
    return cohorts.orderBy("cohort_month", "months_since_first")


# --------------------------------------------------------------------- T7
def statistical_profile(delivered: DataFrame, materialised: bool = False) -> DataFrame:
    """Order-value distribution by category x region, with exact quantiles.

    The quantiles are selected by counting (``operators.selection``): memory per
    group depends neither on its rows nor on its distinct values. That reads the
    few columns of the report several times, so they are written once,
    unless ``delivered`` is ``materialised`` already.
    """
    keys, gt = ["category", "region"], F.col("grand_total")
    rows = delivered.select(*keys, F.col("order_id").isNotNull().alias("_ordered"), "grand_total", "rating", "is_prime_member")
    if not materialised:
        rows, _ = write_table(rows, "profile-values")
    g, _ = write_table(rows.groupBy(*keys).agg(
        count_when(F.col("_ordered")).alias("order_count"),
        F.count(gt).alias("_n"),
        F.sum(gt).alias("_rev"),
        mean_of(gt).alias("mean_order_value"),
        stddev_exact(gt).alias("stddev_order_value"),
        F.min(gt).alias("_min"),
        F.max(gt).alias("_max"),
        mean_of("rating").alias("avg_rating"),
        count_when(F.col("is_prime_member") == True).alias("prime_orders"),  # noqa: E712
        count_when(F.col("is_prime_member") == False).alias("non_prime_orders"),  # noqa: E712
    ), "profile-groups")
    q = group_quantiles(rows, g.select(*keys, F.col("_n").alias("n"), F.col("_min").alias("lo"), F.col("_max").alias("hi")),
                        keys, "grand_total", list(QUANTILES))
    q = q.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "q0", "q1", "q2")
    g = g.join(q, F.col("category").eqNullSafe(F.col("_k0")) & F.col("region").eqNullSafe(F.col("_k1")), "left")
    mean, sd = F.col("mean_order_value"), F.col("stddev_order_value")
    return g.select(
        "category", "region", "order_count",
        _money("_rev").alias("total_revenue"),
        "mean_order_value", "stddev_order_value",
        _money("_min").alias("min_order_value"),
        _money("q0").alias("q1_order_value"),
        _money("q1").alias("median_order_value"),
        _money("q2").alias("q3_order_value"),
        _money("_max").alias("max_order_value"),
        "avg_rating", "prime_orders", "non_prime_orders",
        ratio_or_zero("prime_orders", "order_count", multiplier=100).alias("prime_order_pct"),
        F.when(mean.isNotNull() & (mean > 0), F.round(sd / mean * 100, 2)).alias("cv_order_value"),
    )


REPORTS = {
    "revenue_analysis": revenue_analysis,
    "product_performance": product_performance,
    "rfm_analysis": rfm_analysis,
    "customer_360": customer_360,
    "time_series": daily_sales_moving_avg,
    "cohort_analysis": cohort_retention,
    "statistical_analysis": statistical_profile,
}
