from pyspark.sql import functions as F

from mercato.sources import generate as G


def test_generator_is_deterministic_and_consistent(spark):
    ids = spark.range(5000)
    o1 = G.generate_orders(ids, 400, 900)
    o2 = G.generate_orders(ids.repartition(7), 400, 900)
    assert sorted(map(tuple, o1.collect())) == sorted(map(tuple, o2.collect()))
    rows = o1.collect()
    assert len({r.order_id for r in rows}) == 5000
    for r in rows[:500]:
        assert abs(r.final_amount + r.shipping_cost + r.tax_amount - r.grand_total) < 1e-6
        assert abs(r.total_amount - r.discount_amount - r.final_amount) < 1e-6
        assert (r.rating is not None) == (r.order_status == "Delivered")
        assert (r.delivery_date is None) == (r.order_status == "Cancelled")
        assert r.shipping_method != "Prime" or r.shipping_cost == 0.0
        cats = dict(G.CATEGORIES)
        assert r.product_type in cats[r.category]
        assert r.city in dict(G.REGIONS)[r.region]
        lo, hi, qmax = G.PRICE_QTY.get(r.category, G.DEFAULT_PRICE_QTY)
        assert lo <= r.unit_price <= hi and 1 <= r.quantity <= qmax
    share = sum(r.order_status == "Delivered" for r in rows) / len(rows)
    assert 0.65 < share < 0.75
    assert o1.schema.simpleString() == G.generate_orders(spark.range(1), 1, 1).schema.simpleString()


def test_dimensions_cover_the_orders(spark):
    orders = G.generate_orders(spark.range(3000), 300, 700)
    cust = G.generate_customers(orders)
    prod = G.generate_products(orders)
    assert cust.count() == orders.select("customer_id").distinct().count()
    assert prod.count() == orders.select("product_id").distinct().count()
    c = cust.agg(F.min("age"), F.max("age"), F.min("account_age_days"), F.max("account_age_days")).first()
    assert 18 <= c[0] and c[1] <= 70 and 30 <= c[2] and c[3] <= 1825
    p = prod.agg(F.min("avg_rating"), F.max("avg_rating")).first()
    assert 2.5 <= p[0] and p[1] <= 5.0
    assert orders.join(cust, "customer_id", "left_anti").count() == 0


def test_seed_changes_draws_and_tables_write(spark, scratch):
    a = G.generate_orders(spark.range(200), 50, 80, seed=1).collect()
    b = G.generate_orders(spark.range(200), 50, 80, seed=2).collect()
    assert [r.order_id for r in a] == [r.order_id for r in b]
    assert [r.customer_id for r in a] != [r.customer_id for r in b]
    G.write_tables(G.generate_tables(spark, 300, 40, 60), scratch)
    back = spark.read.option("header", "true").csv(f"{scratch}/orders.csv")
    assert back.count() == 300 and len(back.columns) == 24
