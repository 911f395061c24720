"""Fixed schemas: the three report inputs and the diff result records."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed input contract of the report job (column names, order and types must
# equal the published CSV layout; the non-null flags document intent only --
# file sources relax them, so ``operators.clean.validate_orders`` enforces them).
ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("order_date", T.StringType(), False),
    T.StructField("delivery_date", T.StringType(), True),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_type", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DoubleType(), True),
    T.StructField("total_amount", T.DoubleType(), True),
    T.StructField("discount_percent", T.DoubleType(), True),
    T.StructField("discount_amount", T.DoubleType(), True),
    T.StructField("final_amount", T.DoubleType(), True),
    T.StructField("shipping_method", T.StringType(), True),
    T.StructField("shipping_cost", T.DoubleType(), True),
    T.StructField("tax_amount", T.DoubleType(), True),
    T.StructField("grand_total", T.DoubleType(), False),
    T.StructField("payment_method", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("customer_segment", T.StringType(), True),
    T.StructField("order_status", T.StringType(), False),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("is_prime_member", T.BooleanType(), True),
])

CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("account_age_days", T.IntegerType(), True),
    T.StructField("total_lifetime_orders", T.IntegerType(), True),
    T.StructField("preferred_payment", T.StringType(), True),
])

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("brand", T.StringType(), True),
    T.StructField("seller_id", T.StringType(), True),
    T.StructField("stock_quantity", T.IntegerType(), True),
    T.StructField("avg_rating", T.DoubleType(), True),
    T.StructField("num_reviews", T.IntegerType(), True),
])

# One compared table (D1). The optional grouped_* fields are NULL unless the
# row counts of the two sides differ.
DIFF_RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("control_count", T.LongType(), False),
    T.StructField("target_count", T.LongType(), False),
    T.StructField("missing_rows_count", T.LongType(), False),
    T.StructField("new_rows_count", T.LongType(), False),
    T.StructField("total_differences", T.LongType(), False),
    T.StructField("tolerance", T.DoubleType(), False),
    T.StructField("tolerance_threshold", T.DoubleType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("grouped_comparison", T.BooleanType(), True),
    T.StructField("grouped_differences", T.LongType(), True),
    T.StructField("grouped_comparison_error", T.StringType(), True),
])
