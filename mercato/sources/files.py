"""Table readers: typed CSV inputs of the report job, and the diff job's
format-generic, catalog and directory readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import parse_date
from mercato.schemas import CUSTOMERS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA

DEFAULT_FILE_NAMES = {"orders": "orders.csv", "customers": "customers.csv", "products": "products.csv"}


CORRUPT = "_corrupt_record"  # the text of a line with a field that is not of its type


def _typed_csv(spark: SparkSession, path: str, schema, keep_corrupt: bool = False) -> DataFrame:
    # Fixed schema, header row, no inference: one pass over the files.
    # PERMISSIVE mode turns a malformed field into NULL; validation drops it later.
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_orders_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Orders fact with ``order_date`` parsed to a date (bad text -> NULL).

    With ``keep_corrupt`` the texts of the date and of malformed lines stay in
    ``order_date_text`` and ``_corrupt_record``, for ``operators.clean.rejections``.
    """
    orders = _typed_csv(spark, path, ORDERS_SCHEMA, keep_corrupt)
    if keep_corrupt:
        orders = orders.withColumn("order_date_text", F.col("order_date"))
    return orders.withColumn("order_date", parse_date("order_date"))


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    return _typed_csv(spark, path, CUSTOMERS_SCHEMA)


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    return _typed_csv(spark, path, PRODUCTS_SCHEMA)


def read_report_inputs(spark: SparkSession, input_path: str, file_names: dict[str, str] | None = None,
                       keep_corrupt: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three report inputs under one folder: (orders, customers, products)."""
    names = {**DEFAULT_FILE_NAMES, **(file_names or {})}
    root = input_path.rstrip("/")
    return (read_orders_csv(spark, f"{root}/{names['orders']}", keep_corrupt),
            read_customers_csv(spark, f"{root}/{names['customers']}"),
            read_products_csv(spark, f"{root}/{names['products']}"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", csv_header: bool = True,
               csv_infer_schema: bool = True, csv_delimiter: str = ",") -> DataFrame:
    """Any Spark file format; CSV gets the header / inferSchema / delimiter options."""
    reader = spark.read.format(fmt)
    if fmt.lower() == "csv":
        reader = (reader.option("header", str(csv_header).lower())
                  .option("inferSchema", str(csv_infer_schema).lower())
                  .option("sep", csv_delimiter))
    return reader.load(path)


def read_table_pair(spark: SparkSession, table: str, control_root: str, target_root: str,
                    fmt: str = "parquet", **csv_options) -> tuple[DataFrame, DataFrame]:
    """``{control_root}/{table}`` and ``{target_root}/{table}`` read the same way."""
    if not control_root or not target_root:
        raise ValueError("both control_root and target_root are required")
    return (read_table(spark, f"{control_root.rstrip('/')}/{table}", fmt, **csv_options),
            read_table(spark, f"{target_root.rstrip('/')}/{table}", fmt, **csv_options))


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view registered in the session catalog."""
    return spark.read.table(name)


def with_money_as_decimal(df: DataFrame, columns=("total_amount", "discount_amount", "grand_total"),
                          only: Column | None = None) -> DataFrame:
    """Cast money columns to ``decimal(18,2)`` so sums are exact.

    ``grand_total`` is a validated amount: one that the type cannot hold raises (with ``only``, in
    the rows where that holds). The optional amounts become NULL then.
    """
    money = "decimal(18,2)"
    amount = F.col("grand_total")
    checked = F.lit(True) if only is None else only
    fits = F.when(checked & amount.isNotNull() & amount.try_cast(money).isNull(),
                  F.raise_error(F.concat(F.lit("grand_total does not fit decimal(18,2): "), amount.cast("string"))))
    strict = fits.otherwise(amount.try_cast(money)).cast(money)
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: strict if c == "grand_total" else F.col(c).try_cast(money) for c in present})
