"""Distributed test-data generator (S14-S16, N1): orders, customers, products.

Every value is a pure function of a row id and a field salt, computed with
SQL expressions in one projection -- no Python per row, no driver-side loop,
and any partition can be recomputed to the same rows. Feed it any id column:
``spark.range(n)`` for a fixed size, or the keys of an existing table so the
generated volume follows that table.

Pseudo-random draws use integer arithmetic modulo the prime 2^31 - 1 (two
rounds of an affine step followed by squaring); every intermediate stays
below 2^62, so there is no overflow under ANSI mode. The expressions only use
``%``, ``*``, ``+``, ``CASE``, ``lpad``, ``||`` and casts, so the same text runs
unchanged in other SQL engines (the tests check it against one).

Money is generated in integer cents and rounded half-up, then exposed as
double, the type of the report job's CSV contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

P = 2_147_483_647

# Fixed domain values of the generated data.
START_DATE = "2022-01-01"
DAYS = 730
CATEGORIES = [
    ("Electronics", ["Laptop", "Phone", "Tablet", "Headphones", "Camera", "Smart Watch"]),
    ("Clothing", ["Shirt", "Pants", "Dress", "Jacket", "Shoes", "Accessories"]),
    ("Home & Kitchen", ["Cookware", "Furniture", "Bedding", "Decor", "Appliances"]),
    ("Books", ["Fiction", "Non-Fiction", "Textbook", "Comics", "Magazine"]),
    ("Sports", ["Equipment", "Clothing", "Supplements", "Accessories"]),
    ("Beauty", ["Skincare", "Makeup", "Haircare", "Fragrance"]),
    ("Grocery", ["Snacks", "Beverages", "Organic", "Dairy", "Frozen"]),
]
# unit price range in dollars and maximum quantity, by category (others: 20-500, 4)
PRICE_QTY = {"Electronics": (200, 2000, 3), "Clothing": (15, 150, 5), "Books": (10, 50, 4),
             "Grocery": (5, 100, 10)}
DEFAULT_PRICE_QTY = (20, 500, 4)
REGIONS = [
    ("North", ["New York", "Boston", "Chicago", "Detroit"]),
    ("South", ["Miami", "Houston", "Atlanta", "Dallas"]),
    ("East", ["Philadelphia", "Charlotte", "Washington DC"]),
    ("West", ["Los Angeles", "San Francisco", "Seattle", "Phoenix"]),
]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "UPI", "Net Banking", "Amazon Pay", "Cash on Delivery"]
SHIPPING_METHODS = ["Standard", "Express", "Same Day", "Prime"]
DELIVERY_DAYS = {"Standard": 5, "Express": 3, "Same Day": 1, "Prime": 2}
SHIPPING_COSTS = [0, 5, 10, 15]
SEGMENTS = ["Premium", "Regular", "Occasional", "New"]
DISCOUNTS = [0, 0, 0, 0, 5, 10, 15, 20, 25]
STATUS_WEIGHTS = [("Delivered", 70), ("Shipped", 15), ("Processing", 5), ("Cancelled", 5), ("Returned", 5)]
GENDERS = ["M", "F", "Other"]
BRAND_LETTERS = ["A", "B", "C", "D", "E", "F", "G", "H"]
TAX_PERCENT = 8


DEFAULT_SEED = 42
_SEED = [DEFAULT_SEED]   # the seed in effect while expressions are built


def mix(salt: int, id_expr: str = "id") -> str:
    """SQL: a pseudo-random integer in [0, P) from the id, a field salt and the seed."""
    salt = salt + 1000 * _SEED[0]
    h1 = f"((({id_expr}) % {P}) * 48271 + {salt}) % {P}"
    h2 = f"(({h1}) * ({h1}) + 12345) % {P}"
    h3 = f"(({h2}) * 16807 + {salt * 7 + 1}) % {P}"
    return f"(({h3}) * ({h3}) + {salt}) % {P}"


def draw(salt: int, n: int | str, id_expr: str = "id") -> str:
    """SQL: a pseudo-random integer in [0, n) (``n`` a number or SQL text)."""
    return f"(({mix(salt, id_expr)}) % {n})"


def _case(index_sql: str, values: list, quote: bool = True) -> str:
    arms = " ".join(f"WHEN {i} THEN {_lit(v) if quote else v}" for i, v in enumerate(values))
    return f"(CASE {index_sql} {arms} END)"


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _padded(prefix: str, number_sql: str, width: int) -> str:
    s = f"CAST({number_sql} AS STRING)"
    return f"('{prefix}' || lpad({s}, CAST(greatest({width}, length({s})) AS INT), '0'))"


def _idiv(a: str, b: int) -> str:
    """Exact integer division of a non-negative integer by a positive constant."""
    return f"CAST((({a}) - ({a}) % {b}) / {b} AS BIGINT)"


def order_draws(n_customers: int | str, n_products: int | str) -> list[tuple[str, str]]:
    """Stage 1: raw integer draws per order (name, SQL)."""
    cat_n = len(CATEGORIES)
    price_span = " ".join(
        f"WHEN {i} THEN {(PRICE_QTY.get(c, DEFAULT_PRICE_QTY)[1] - PRICE_QTY.get(c, DEFAULT_PRICE_QTY)[0]) * 100 + 1}"
        for i, (c, _) in enumerate(CATEGORIES))
    qty_max = " ".join(f"WHEN {i} THEN {PRICE_QTY.get(c, DEFAULT_PRICE_QTY)[2]}"
                       for i, (c, _) in enumerate(CATEGORIES))
    type_n = " ".join(f"WHEN {i} THEN {len(t)}" for i, (_, t) in enumerate(CATEGORIES))
    city_n = " ".join(f"WHEN {i} THEN {len(c)}" for i, (_, c) in enumerate(REGIONS))
    return [
        ("id", "id"),
        ("d_customer", draw(1, n_customers)),
        ("d_day", draw(2, DAYS)),
        ("d_region", draw(3, len(REGIONS))),
        ("d_city_raw", mix(4)),
        ("d_category", draw(5, cat_n)),
        ("d_type_raw", mix(6)),
        ("d_product", draw(7, n_products)),
        ("d_price_raw", mix(8)),
        ("d_qty_raw", mix(9)),
        ("d_discount", draw(10, len(DISCOUNTS))),
        ("d_shipping", draw(11, len(SHIPPING_METHODS))),
        ("d_ship_cost", draw(12, len(SHIPPING_COSTS))),
        ("d_payment", draw(13, len(PAYMENT_METHODS))),
        ("d_segment", draw(14, len(SEGMENTS))),
        ("d_status", draw(15, 100)),
        ("d_rating", draw(16, 5)),
        ("d_prime", draw(17, 2)),
        # per-row moduli for the dependent draws
        ("n_city", f"(CASE {draw(3, len(REGIONS))} {city_n} END)"),
        ("n_type", f"(CASE {draw(5, cat_n)} {type_n} END)"),
        ("n_price", f"(CASE {draw(5, cat_n)} {price_span} END)"),
        ("n_qty", f"(CASE {draw(5, cat_n)} {qty_max} END)"),
    ]


def order_values() -> list[tuple[str, str]]:
    """Stage 2: the typed order columns from the draws (name, SQL)."""
    city = "(CASE d_region " + " ".join(
        f"WHEN {i} THEN {_case('(d_city_raw % n_city)', cities)}" for i, (_, cities) in enumerate(REGIONS)) + " END)"
    ptype = "(CASE d_category " + " ".join(
        f"WHEN {i} THEN {_case('(d_type_raw % n_type)', types)}" for i, (_, types) in enumerate(CATEGORIES)) + " END)"
    price_lo = "(CASE d_category " + " ".join(
        f"WHEN {i} THEN {PRICE_QTY.get(c, DEFAULT_PRICE_QTY)[0] * 100}" for i, (c, _) in enumerate(CATEGORIES)) + " END)"
    price_cents = f"({price_lo} + d_price_raw % n_price)"
    qty = "(1 + d_qty_raw % n_qty)"
    total = f"({price_cents} * {qty})"
    pct = _case("d_discount", DISCOUNTS, quote=False)
    disc = _idiv(f"{total} * {pct} * 2 + 100", 200)
    final = f"({total} - {disc})"
    shipping = _case("d_shipping", SHIPPING_METHODS)
    prime_idx = SHIPPING_METHODS.index("Prime")
    ship = f"(CASE WHEN d_shipping = {prime_idx} THEN 0 ELSE {_case('d_ship_cost', SHIPPING_COSTS, False)} * 100 END)"
    tax = _idiv(f"{final} * {TAX_PERCENT} * 2 + 100", 200)
    grand = f"({final} + {ship} + {tax})"
    status_arms, acc = [], 0
    for name, w in STATUS_WEIGHTS:
        acc += w
        status_arms.append(f"WHEN d_status < {acc} THEN {_lit(name)}")
    status = "(CASE " + " ".join(status_arms) + " END)"
    order_date = f"(DATE '{START_DATE}' + CAST(d_day AS INT))"
    delivery = "(CASE d_shipping " + " ".join(
        f"WHEN {i} THEN {DELIVERY_DAYS[m]}" for i, m in enumerate(SHIPPING_METHODS)) + " END)"
    cancelled = f"{status} = 'Cancelled'"
    delivered = f"{status} = 'Delivered'"

    def money(cents: str) -> str:
        return f"CAST({cents} AS DOUBLE) / 100.0"

    return [
        ("order_id", _padded("ORD", "id + 1", 6)),
        ("customer_id", _padded("CUST", "d_customer + 1", 5)),
        ("order_date", f"CAST({order_date} AS STRING)"),
        ("delivery_date", f"CASE WHEN {cancelled} THEN NULL ELSE CAST({order_date} + CAST({delivery} AS INT) AS STRING) END"),
        ("product_id", _padded("PROD", "d_product + 1", 5)),
        ("product_type", ptype),
        ("category", _case("d_category", [c for c, _ in CATEGORIES])),
        ("quantity", f"CAST({qty} AS INT)"),
        ("unit_price", money(price_cents)),
        ("total_amount", money(total)),
        ("discount_percent", f"CAST({pct} AS DOUBLE)"),
        ("discount_amount", money(disc)),
        ("final_amount", money(final)),
        ("shipping_method", shipping),
        ("shipping_cost", money(ship)),
        ("tax_amount", money(tax)),
        ("grand_total", money(grand)),
        ("payment_method", _case("d_payment", PAYMENT_METHODS)),
        ("region", _case("d_region", [r for r, _ in REGIONS])),
        ("city", city),
        ("customer_segment", _case("d_segment", SEGMENTS)),
        ("order_status", status),
        ("rating", f"CASE WHEN {delivered} THEN CAST(1 + d_rating AS DOUBLE) END"),
        ("is_prime_member", "d_prime = 0"),
    ]


def customer_values() -> list[tuple[str, str]]:
    """Customer attributes from the numeric part of the id (column ``id``)."""
    return [
        ("customer_id", "customer_id"),
        ("age", f"CAST(18 + {draw(21, 53)} AS INT)"),
        ("gender", _case(draw(22, len(GENDERS)), GENDERS)),
        ("account_age_days", f"CAST(30 + {draw(23, 1796)} AS INT)"),
        ("total_lifetime_orders", f"CAST(1 + {draw(24, 50)} AS INT)"),
        ("preferred_payment", _case(draw(25, len(PAYMENT_METHODS)), PAYMENT_METHODS)),
    ]


def product_values() -> list[tuple[str, str]]:
    """Product attributes from the numeric part of the id (column ``id``)."""
    return [
        ("product_id", "product_id"),
        ("brand", "('Brand_' || " + _case(draw(31, len(BRAND_LETTERS)), BRAND_LETTERS) + ")"),
        ("seller_id", _padded("SELLER", f"1 + {draw(32, 100)}", 3)),
        ("stock_quantity", f"CAST({draw(33, 1001)} AS INT)"),
        ("avg_rating", f"CAST(25 + {draw(34, 26)} AS DOUBLE) / 10.0"),
        ("num_reviews", f"CAST({draw(35, 5001)} AS INT)"),
    ]


def _select(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in exprs])


class _seeded:
    def __init__(self, seed: int):
        self.seed = seed

    def __enter__(self):
        self.old, _SEED[0] = _SEED[0], int(self.seed)

    def __exit__(self, *exc):
        _SEED[0] = self.old


def generate_orders(ids: DataFrame, n_customers: int = 2000, n_products: int = 5000,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """One order per row of ``ids`` (a bigint column ``id``), in the orders CSV contract."""
    if n_customers < 1 or n_products < 1:
        raise ValueError("n_customers and n_products must be positive")
    ids = ids.select(F.col("id").cast("bigint").alias("id"))
    # Generation is CPU work per row: an id source narrower than the cluster
    # (one file, one row group) is hash-spread first; wide sources are used as is.
    width = ids.sparkSession.sparkContext.defaultParallelism
    if ids.rdd.getNumPartitions() < width:
        ids = ids.repartition(width, "id")
    with _seeded(seed):
        return _select(_select(ids, order_draws(n_customers, n_products)), order_values())


def generate_customers(orders: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """One customer row per distinct customer id of the generated orders."""
    ids = orders.select("customer_id").distinct().select(
        "customer_id", F.expr("CAST(substring(customer_id, 5) AS BIGINT)").alias("id"))
    with _seeded(seed):
        return _select(ids, customer_values())


def generate_products(orders: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """One product row per distinct product id of the generated orders."""
    ids = orders.select("product_id").distinct().select(
        "product_id", F.expr("CAST(substring(product_id, 5) AS BIGINT)").alias("id"))
    with _seeded(seed):
        return _select(ids, product_values())


def generate_tables(spark, n_orders: int = 10_000, n_customers: int = 2000, n_products: int = 5000,
                    seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """N1: the three related tables, ``n_orders`` orders over ``spark.range``."""
    orders = generate_orders(spark.range(n_orders), n_customers, n_products, seed)
    return orders, generate_customers(orders, seed), generate_products(orders, seed)


def write_tables(tables: tuple[DataFrame, DataFrame, DataFrame], out: str,
                 names: tuple[str, str, str] = ("orders.csv", "customers.csv", "products.csv")) -> None:
    """K4: each table as CSV with header under ``out`` (parallel writers)."""
    for df, name in zip(tables, names):
        df.write.mode("overwrite").option("header", "true").csv(f"{out.rstrip('/')}/{name}")


def oracle_sql(ids_sql: str, n_customers_sql: str, n_products_sql: str, which: str = "orders",
               seed: int = DEFAULT_SEED) -> str:
    """The same generator as plain SQL over ``ids_sql`` (a query with column ``id``)."""
    with _seeded(seed):
        return _oracle_sql(ids_sql, n_customers_sql, n_products_sql, which)


def _oracle_sql(ids_sql: str, n_customers_sql: str, n_products_sql: str, which: str) -> str:
    stage1 = ", ".join(f"{s} AS {n}" for n, s in order_draws(f"({n_customers_sql})", f"({n_products_sql})"))
    stage2 = ", ".join(f"{s} AS {n}" for n, s in order_values())
    orders = f"SELECT {stage2} FROM (SELECT {stage1} FROM ({ids_sql}) ids) d"
    if which == "orders":
        return orders
    if which == "customers":
        cols = ", ".join(f"{s} AS {n}" for n, s in customer_values())
        return (f"SELECT {cols} FROM (SELECT customer_id, CAST(substring(customer_id, 5) AS BIGINT) AS id "
                f"FROM (SELECT DISTINCT customer_id FROM ({orders}) o) x) c")
    cols = ", ".join(f"{s} AS {n}" for n, s in product_values())
    return (f"SELECT {cols} FROM (SELECT product_id, CAST(substring(product_id, 5) AS BIGINT) AS id "
            f"FROM (SELECT DISTINCT product_id FROM ({orders}) o) x) p")


def main(argv: list[str] | None = None) -> int:
    """``python -m mercato.sources.generate OUT [--orders N] [--customers N] [--products N] [--seed S]``"""
    import argparse

    from mercato.session import get_session

    p = argparse.ArgumentParser(description="Write generated orders, customers and products as CSV.")
    p.add_argument("out")
    p.add_argument("--orders", type=int, default=10_000)
    p.add_argument("--customers", type=int, default=2000)
    p.add_argument("--products", type=int, default=5000)
    p.add_argument("--seed", type=int, default=DEFAULT_SEED)
    a = p.parse_args(argv)
    spark = get_session(app_name="mercato-datagen")
    write_tables(generate_tables(spark, a.orders, a.customers, a.products, a.seed), a.out)
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main())
