"""Adapter: the TPC-H-like tables -> the report job's orders / customers / products.

The driver's tables have no orders fact of the report shape, so the fact is
one row per lineitem, joined to its order, part, customer, nation and region.
Column mapping (fixed; the oracle SQL uses the same expressions):

  order_id        l_orderkey-l_linenumber-l_partkey-l_suppkey (only all four are unique)
  customer_id     o_custkey as string        product_id   l_partkey as string
  order_date      o_orderdate as date         delivery_date l_shipdate as date
  category        p_type                      product_type  p_name
  quantity        l_quantity as int
  total_amount    extendedprice as decimal(12,2) -> decimal(18,2)
  discount_percent discount as decimal(4,2) * 100, int
  discount_amount price * discount            grand_total   price * (1-discount) * (1+tax)
  payment_method  o_orderpriority             region/city/segment  r_name / n_name / c_mktsegment
  order_status    Returned if l_returnflag = 'R', Processing if o_orderstatus = 'P', else Delivered
  rating          1 + (l_orderkey + l_linenumber + l_partkey) % 7 (6 and 7 exercise the sanitiser)
  is_prime_member true when o_custkey % 3 = 0, false when 1, NULL when 2

Customers drop keys divisible by 11 and products keys divisible by 13, so the
inner joins of customer_360 really drop orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


_SCHEMAS: dict[str, object] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer schema is read once per path and reused."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) have a fixed size by the TPC-H
    # definition, so broadcasting them is bounded whatever the scale factor.
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def _status_filters(status: str | None):
    """Per-side predicates equivalent to ``order_status = status`` (the status is
    derived from both tables, so Catalyst cannot split the filter itself)."""
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    pending = F.coalesce(F.col("o_orderstatus") == "P", F.lit(False))
    if status is None:
        return None, None
    if status == "Returned":
        return returned, None
    if status == "Processing":
        return ~returned, pending
    if status == "Delivered":
        return ~returned, ~pending
    return F.lit(False), None


def fact(spark: SparkSession, sf_dir: str, status: str | None = None, key: str | None = None) -> DataFrame:
    """One order line per lineitem, in the orders-fact contract.

    ``status``: keep only lines with that ``order_status``; the condition is
    applied to each table before the joins. ``key``: name of a further column with the order key.
    """
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    # lineitem x orders: both sides grow with the scale factor, so they are
    # joined by shuffling on the order key (sort-merge, spills), never by
    # broadcasting |orders| rows (hint on the enriched orders below).
    li_cond, o_cond = _status_filters(status)
    if li_cond is not None:
        li = li.filter(li_cond)
    if o_cond is not None:
        orders = orders.filter(o_cond)
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = _geo(spark, sf_dir)
    cust = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name")

    # Orders are enriched with their customer first (orders-sized join), so the
    # lineitem-sized data is shuffled only by order key and by part key.
    enriched = orders.join(cust, orders.o_custkey == cust.c_custkey).hint("merge")
    joined = (li.join(enriched, li.l_orderkey == enriched.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey))

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return joined.select(
        F.concat_ws("-", *(F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("delivery_date"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_type"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.cast("decimal(18,2)").alias("total_amount"),
        (disc * 100).cast("int").alias("discount_percent"),
        (price * disc).cast("decimal(18,2)").alias("discount_amount"),
        (price * (1 - disc) * (1 + tax)).cast("decimal(18,2)").alias("grand_total"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.when(F.col("l_returnflag") == "R", "Returned")
         .when(F.col("o_orderstatus") == "P", "Processing")
         .otherwise("Delivered").alias("order_status"),
        (1 + (F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey")) % 7)
        .cast("double").alias("rating"),
        F.when(F.col("o_custkey") % 3 == 0, True)
         .when(F.col("o_custkey") % 3 == 1, False).alias("is_prime_member"),
        *([F.col("l_orderkey").alias(key)] if key else []),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension in the report contract (keys divisible by 11 left out)."""
    k = F.col("c_custkey")
    return (read(spark, sf_dir, "customer").filter(k % 11 != 0).select(
        k.cast("string").alias("customer_id"),
        (18 + k % 53).cast("int").alias("age"),
        F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("Other").alias("gender"),
        (30 + (k * 37) % 1796).cast("int").alias("account_age_days"),
        (1 + k % 50).cast("int").alias("total_lifetime_orders"),
        F.col("c_mktsegment").alias("preferred_payment"),
    ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension in the report contract (keys divisible by 13 left out)."""
    k = F.col("p_partkey")
    return (read(spark, sf_dir, "part").filter(k % 13 != 0).select(
        k.cast("string").alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("S"), (k % 100).cast("string")).alias("seller_id"),
        F.col("p_size").alias("stock_quantity"),
        ((25 + k % 26) / 10.0).cast("double").alias("avg_rating"),
        (k % 5001).cast("int").alias("num_reviews"),
    ))


def report_inputs(spark: SparkSession, sf_dir: str, status: str | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fact(spark, sf_dir, status), customers(spark, sf_dir), products(spark, sf_dir)


# ---------------------------------------------------------------- diff inputs
# Fixed perturbation of the orders table used as the "target" version:
#   rows with o_orderkey % 101 = 0 are dropped,
#   o_totalprice + 0.01 where o_orderkey % 97 = 0,
#   rows with o_orderkey % 103 = 0 appear twice.
def orders_diff_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    control = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kept = control.filter(k % 101 != 0).withColumn(
        "o_totalprice", F.when(k % 97 == 0, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    kept = kept.select(*control.columns)
    return control, kept.unionByName(kept.filter(k % 103 == 0))


# Fixed perturbation of the customer table: keys divisible by 89 are dropped.
def customer_diff_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    control = read(spark, sf_dir, "customer")
    return control, control.filter(F.col("c_custkey") % 89 != 0)


# A target with few changes, for the diff that skips equal parts: price + 1 where o_orderkey is 7 modulo 1999,
# dropped where it is 5 modulo 4001, twice where it is 11 modulo 6007 (together about 0.1 % of the rows).
def orders_few_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    control = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kept = control.filter(k % 4001 != 5).withColumn(
        "o_totalprice", F.when(k % 1999 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).select(*control.columns)
    return control, kept.unionByName(kept.filter(k % 6007 == 11))


# The second folder of the directory diff, written by Spark: of every table, rows whose first column is 3 modulo
# 89 are dropped and rows whose first column is 1 modulo 97 appear twice.
def directory_target(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    from mercato.session import table_path

    root = table_path(spark, "directory-target")
    for name in tables:
        table = read(spark, sf_dir, name)
        k = F.col(table.columns[0])
        kept = table.filter(k % 89 != 3)
        kept.unionByName(kept.filter(k % 97 == 1)).write.parquet(f"{root}/{name}.parquet")
    return root


# Fixed defects of the order fact for the rejection queries, by the order key: the date is text
# that is no date (modulo 29 = 1), the customer is missing (31 = 2), the quantity is 0 (37 = 3), the total
# is negative (41 = 4) or not a number (43 = 5). A row can have several.
def defective_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("_orderkey")  # a column of its own: the conditions would each build the id's text and split it again
    total = F.col("grand_total").cast("double")
    text = F.when(k % 29 == 1, F.lit("2024-13-45")).otherwise(F.col("order_date").cast("string"))
    return fact(spark, sf_dir, key="_orderkey").withColumns({
        "order_date_text": text,
        "order_date": F.try_to_date(text),
        "customer_id": F.when(k % 31 != 2, F.col("customer_id")),
        "quantity": F.when(k % 37 == 3, F.lit(0)).otherwise(F.col("quantity")),
        "grand_total": F.when(k % 43 == 5, F.lit(float("nan"))).when(k % 41 == 4, -total - 1).otherwise(total)}).drop("_orderkey")


# ------------------------------------------------------------ orders history
# A versioned "orders" table derived from the data: one snapshot per order
# year y (snapshot id y, parent = previous year) holding the orders up to y,
# and one restated branch per year (id RESTATED_BASE + y, parent y) holding
# the same orders without the pending ('P') ones.
RESTATED_BASE = 10_000


def orders_history(spark: SparkSession, sf_dir: str):
    from pyspark.sql import Window

    from mercato.session import cut_lineage
    from mercato.sources.snapshots import VersionedTable

    orders = read(spark, sf_dir, "orders")
    years = orders.select(F.year("o_orderdate").cast("bigint").alias("y")).distinct()
    # one row per calendar year: the ordered window is bounded by the date range
    main = years.select(F.lit("orders").alias("table_name"), F.col("y").alias("snapshot_id"),
                        F.lag("y").over(Window.orderBy("y")).alias("parent_id"))
    fork = years.select(F.lit("orders").alias("table_name"),
                        (F.col("y") + RESTATED_BASE).alias("snapshot_id"), F.col("y").alias("parent_id"))
    # Written once to the shared checkpoint folder: the recursive ancestry
    # query re-reads its lineage on every iteration, which must not mean a
    # scan of the whole orders table per iteration.
    lineage = cut_lineage(main.unionByName(fork))

    def reader(snapshot_id: int) -> DataFrame:
        year = snapshot_id - RESTATED_BASE if snapshot_id >= RESTATED_BASE else snapshot_id
        upto = orders.filter(F.col("o_orderdate") < F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz"))
        if snapshot_id >= RESTATED_BASE:
            upto = upto.filter(F.col("o_orderstatus") != "P")
        return upto

    return VersionedTable("orders", lineage, reader)


def history_pair(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """(control, target) snapshots: the latest year vs the restated branch of the year before."""
    last = read(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate"))).first()[0]
    return int(last), int(RESTATED_BASE + last - 1)
