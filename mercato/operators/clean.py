"""T0: validate, sanitise and select the delivered working set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.sources.files import CORRUPT, with_money_as_decimal

# Fixed values of the input contract.
REQUIRED_NOT_NULL = ("order_id", "customer_id", "product_id", "order_date", "grand_total", "quantity")
RATING_MIN, RATING_MAX = 1, 5
DELIVERED = "Delivered"


def _is_valid() -> Column:
    """All required fields, ``grand_total >= 0`` (not NaN) and ``quantity > 0``."""
    cond = F.lit(True)
    for c in REQUIRED_NOT_NULL:
        cond = cond & F.col(c).isNotNull()
    return cond & (F.col("grand_total") >= 0) & ~F.isnan(F.col("grand_total").cast("double")) & (F.col("quantity") > 0)


def validate_orders(orders: DataFrame) -> DataFrame:
    """Keep rows with all required fields, ``grand_total >= 0`` (not NaN) and ``quantity > 0``.

    A plain conjunctive filter: Catalyst pushes the null checks and comparisons
    into the scan (``PushedFilters``) when the input is a file source.
    """
    return orders.filter(_is_valid())


def rejections(orders: DataFrame) -> Column:
    """Why a row is no valid order: an array of reason codes, empty for a valid one.

    ``missing <column>``, ``unreadable <column>`` (the field has text that is not of its type; known of a
    source that keeps the date's text and the malformed lines), ``negative grand_total``, ``not a number grand_total``,
    ``not positive quantity``. The array is empty exactly for the rows that ``validate_orders`` keeps.
    """
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in orders.columns else F.lit(False)
    reasons = []
    for c in REQUIRED_NOT_NULL:
        text = f"{c}_text"
        unreadable = F.col(text).isNotNull() if text in orders.columns else (
            corrupt if not isinstance(orders.schema[c].dataType, T.StringType) else F.lit(False))
        reasons.append(F.when(F.col(c).isNull(), F.concat(F.when(unreadable, F.lit("unreadable ")).otherwise("missing "), F.lit(c))))
    total = F.col("grand_total")
    not_a_number = F.isnan(total.cast("double"))
    reasons += [F.when(not_a_number, F.lit("not a number grand_total")),
                F.when(~not_a_number & (total < 0), F.lit("negative grand_total")),
                F.when(F.col("quantity") <= 0, F.lit("not positive quantity"))]
    return F.array_compact(F.array(*reasons))


def sorted_out(orders: DataFrame) -> DataFrame:
    """Every order with its ``_reasons`` and what becomes of it, ``_kind``: delivered, other (valid, of
    another status) or rejected. Valid orders are cleaned as by ``clean_orders``; of a rejected order the
    money that the type cannot hold is NULL."""
    reasons = orders.withColumn("_reasons", rejections(orders))
    valid = F.size("_reasons") == 0
    kind = F.when(~valid, "rejected").when(F.col("order_status") == DELIVERED, "delivered").otherwise("other")
    return sanitize_rating(with_money_as_decimal(reasons.withColumn("_kind", kind), only=valid))


def rejected_orders(orders: DataFrame) -> DataFrame:
    """The orders that ``validate_orders`` drops, with their ``_reasons``, as they came.

    The filter is the plain condition: Catalyst moves it below the projection and into joins, where the array of
    reasons would be built for every row, with the columns' own expressions copied into each reason.
    """
    return orders.filter(~F.coalesce(_is_valid(), F.lit(False))).withColumn("_reasons", rejections(orders))


def sanitize_rating(orders: DataFrame) -> DataFrame:
    """A rating outside [1, 5] becomes NULL; the row is kept."""
    r = F.col("rating")
    return orders.withColumn("rating", F.when(r.between(RATING_MIN, RATING_MAX), r))


def clean_orders(orders: DataFrame) -> DataFrame:
    """Validated and sanitised fact with money as exact ``decimal(18,2)``.

    The input values are validated, then converted: a small negative amount is not
    rounded into a valid one, and a valid amount that the money type cannot hold
    fails the job instead of dropping its row.
    """
    return sanitize_rating(with_money_as_decimal(validate_orders(orders)))


def delivered(orders: DataFrame) -> DataFrame:
    """The working set every report reads: clean rows with status Delivered."""
    return clean_orders(orders).filter(F.col("order_status") == DELIVERED)
