import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import reports

SCHEMA = ("order_id string, customer_id string, order_date date, product_id string, product_type string, "
          "category string, quantity int, discount_percent int, discount_amount decimal(18,2), "
          "grand_total decimal(18,2), payment_method string, region string, rating double, is_prime_member boolean")


def _orders(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _o(i, cust, day, prod="P1", cat="A", region="N", total="10.00", disc=0, rating=4.0, prime=True, qty=1):
    return (f"O{i}", cust, dt.date(2023, 1, 1) + dt.timedelta(days=day), prod, "t", cat, qty, disc,
            Decimal(total) * disc / 100, Decimal(total), "UPI", region, rating, prime)


@pytest.fixture(scope="module")
def orders(spark):
    rows = []
    i = 0
    # 12 customers with tied recencies / frequencies / monetary values
    for c in range(12):
        for k in range(1 + c % 3):
            i += 1
            rows.append(_o(i, f"C{c:02d}", day=(c % 4) * 10 + k, prod=f"P{(c + k) % 5}", cat="AB"[c % 2],
                           region="NS"[k % 2], total=f"{10 + (c % 3) * 5}.00", disc=(5 if k else 0),
                           rating=(None if c == 3 else float(1 + c % 5)), prime=(None if c % 4 == 0 else c % 2 == 0)))
    return _orders(spark, rows)


def test_rfm_matches_plain_windows_with_tiebreak(spark, orders):
    got = {r.customer_id: r for r in reports.rfm_analysis(orders).collect()}
    base = orders.groupBy("customer_id").agg(F.max("order_date").alias("last"), F.count("*").alias("f"),
                                             F.sum("grand_total").alias("m"))
    ref = base.agg(F.max("last")).first()[0]
    base = base.withColumn("rec", F.datediff(F.lit(ref), "last"))
    exp = base.select("customer_id", "rec", "f",
                      F.ntile(5).over(Window.orderBy("rec", "customer_id")).alias("r"),
                      F.ntile(5).over(Window.orderBy(F.desc("f"), "customer_id")).alias("fs"),
                      F.ntile(5).over(Window.orderBy(F.desc("m"), "customer_id")).alias("ms")).collect()
    assert len(got) == 12
    for e in exp:
        g = got[e.customer_id]
        assert (g.recency, g.frequency, g.r_score, g.f_score, g.m_score) == (e.rec, e.f, e.r, e.fs, e.ms)
        assert g.rfm_score == f"{e.r}{e.fs}{e.ms}"


def test_rfm_segments_and_best_is_high(spark, orders):
    default = {r.customer_id: r for r in reports.rfm_analysis(orders).collect()}
    flipped = {r.customer_id: r for r in reports.rfm_analysis(orders, best_is_high=True).collect()}
    for c, r in default.items():
        s = r.r_score, r.f_score, r.m_score
        if s[0] >= 4 and s[1] >= 4 and s[2] >= 4:
            assert r.customer_value == "Champions"
        elif s[0] >= 3 and s[1] >= 3:
            assert r.customer_value == "Loyal Customers"
        # flipping the three orders (no ties in the tiebreak order) reverses the quintiles
        assert flipped[c].recency == r.recency
    assert {r.customer_value for r in default.values()} <= set(reports.SEGMENTS)


def test_customer_360_fan_out_equals_row_level_join(spark, orders):
    customers = spark.createDataFrame(
        [(f"C{c:02d}", 30 + c, "MF"[c % 2], 100 + c, 5, "UPI") for c in range(11)]      # C11 missing
        + [("C01", 31, "F", 101, 5, "UPI")]                                            # exact duplicate
        + [("C02", 99, "M", 0, 5, "Card")],                                            # second attribute set
        "customer_id string, age int, gender string, account_age_days int, total_lifetime_orders int, "
        "preferred_payment string")
    products = spark.createDataFrame(
        [(f"P{p}", f"B{p % 2}", "S1", 1, 4.0, 1) for p in range(4)] + [("P0", "B9", "S2", 1, 4.0, 1)],  # P4 missing
        "product_id string, brand string, seller_id string, stock_quantity int, avg_rating double, num_reviews int")
    got = reports.customer_360(orders, customers, products)
    rfm = reports.rfm_analysis(orders).select("customer_id", "customer_value")
    j = (orders.join(customers, "customer_id").join(products.select("product_id", F.col("brand").alias("pb")),
                                                     "product_id").join(rfm, "customer_id", "left"))
    exp = j.groupBy(*reports.CUSTOMER_KEYS).agg(
        F.count("order_id").alias("total_orders"), F.sum("grand_total").cast("double").alias("lifetime_value"),
        F.countDistinct("pb").alias("brands_purchased"),
        F.sum(F.when(F.col("discount_percent") > 0, 1).otherwise(0)).cast("bigint").alias("orders_with_discount"),
        F.sum("discount_amount").cast("double").alias("total_discounts_availed"),
        F.avg("rating").alias("avg_rating_given"))
    cols = reports.CUSTOMER_KEYS + ["total_orders", "lifetime_value", "brands_purchased", "orders_with_discount",
                                    "total_discounts_availed", "avg_rating_given"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == \
        sorted(map(tuple, exp.select(*cols).collect()), key=str)
    c02 = [r for r in got.collect() if r.customer_id == "C02"]
    assert len(c02) == 2 and {r.daily_value for r in c02 if r.account_age_days == 0} == {0.0}


def test_statistical_profile_edge_groups(spark):
    rows = [_o(1, "C1", 0, cat="solo", total="5.00", prime=None),
            _o(2, "C1", 0, cat="zero", total="0.00", prime=True),
            _o(3, "C2", 1, cat="zero", total="0.00", prime=False),
            _o(4, "C3", 2, cat="many", total="1.00", rating=None),
            _o(5, "C4", 2, cat="many", total="2.00"), _o(6, "C5", 2, cat="many", total="4.00")]
    got = {r.category: r for r in reports.statistical_profile(_orders(spark, rows)).collect()}
    assert got["solo"].stddev_order_value is None and got["solo"].prime_orders == 0
    assert got["solo"].non_prime_orders == 0 and got["solo"].prime_order_pct == 0.0
    assert got["zero"].cv_order_value is None and got["zero"].prime_order_pct == 50.0
    m = got["many"]
    assert (m.min_order_value, m.median_order_value, m.max_order_value) == (1.0, 2.0, 4.0)
    assert m.avg_rating == 4.0 and abs(m.stddev_order_value - 1.5275252316519468) < 1e-12


def test_daily_series_properties(spark, orders):
    ts = reports.daily_sales_moving_avg(orders).orderBy("order_date").collect()
    total = float(orders.agg(F.sum("grand_total")).first()[0])
    assert abs(sum(r.daily_revenue for r in ts) - total) < 1e-6
    assert ts[0].revenue_7day_ma == round(ts[0].daily_revenue, 2)
    first7 = [r.daily_revenue for r in ts[:7]]
    assert abs(ts[6].revenue_7day_ma - round(sum(first7) / 7, 2)) < 1e-9
    assert ts[0].day_of_week == (ts[0].order_date.isoweekday() % 7) + 1


def test_cohort_offset_zero_is_cohort_size(spark, orders):
    cohorts = reports.cohort_retention(orders)
    firsts = orders.groupBy("customer_id").agg(F.min("order_date").alias("f"))
    sizes = {r.m: r.n for r in firsts.groupBy(F.date_format("f", "yyyy-MM").alias("m"))
             .agg(F.count("*").alias("n")).collect()}
    zero = {r.cohort_month: r.active_customers for r in cohorts.filter("months_since_first = 0").collect()}
    assert zero == sizes


def test_product_performance_ranks_over_whole_set(spark, orders):
    pp = reports.product_performance(orders, top_k=2).collect()
    assert all(r.rank_in_category <= 2 for r in pp)
    overall = sorted(r.overall_rank for r in pp)
    assert overall[0] == 1 and len(set(overall)) == len(overall)
    for cat in {r.category for r in pp}:
        pct = [r.category_revenue_pct for r in pp if r.category == cat]
        assert 0 < sum(pct) <= 100.01


def test_reports_on_empty_input(spark, orders):
    empty = orders.filter(F.lit(False))
    for fn in (reports.revenue_analysis, reports.product_performance, reports.rfm_analysis,
               reports.daily_sales_moving_avg, reports.cohort_retention, reports.statistical_profile):
        assert fn(empty).count() == 0


def test_plan_shapes(spark, orders):
    from mercato.plans.inspect import plan_text
    cohort = plan_text(reports.cohort_retention(orders), "simple")
    assert "Window" not in cohort and "partial_collect_set" in cohort
    revenue = plan_text(reports.revenue_analysis(orders), "simple")
    assert "partial_sum" in revenue and "SinglePartition" not in revenue
    daily = plan_text(reports.daily_sales_moving_avg(orders), "simple")
    # the single ordered window runs after the per-day aggregation
    assert daily.index("Window") < daily.index("HashAggregate")


def test_calendar_averages_count_days_without_sales(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 12)]
    rows = [(f"O{k}", d, Decimal("7.00") * (k + 1)) for k, d in enumerate(days)]
    orders = spark.createDataFrame(rows, "order_id string, order_date date, grand_total decimal(18,2)")
    got = {r.order_date: r for r in reports.daily_sales_moving_avg(orders, calendar=True).collect()}
    assert len(got) == 12 and got[dt.date(2024, 1, 5)].daily_orders == 0 and got[dt.date(2024, 1, 5)].avg_order_value is None
    assert got[dt.date(2024, 1, 7)].revenue_7day_ma == 3.0      # 21 over the 7 days of the month
    assert got[dt.date(2024, 1, 12)].revenue_7day_ma == 3.0     # 21 on one of 7 days
    assert got[dt.date(2024, 1, 12)].revenue_30day_ma == 3.5    # 42 over the 12 days there are
    assert got[dt.date(2024, 1, 12)].orders_7day_ma == 0.14
    assert reports.daily_sales_moving_avg(orders.limit(0), calendar=True).count() == 0
