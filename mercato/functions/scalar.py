"""Column expressions shared by the reports.

Everything here is a plain ``pyspark.sql.functions`` expression: it stays in
whole-stage codegen and no Python worker starts.

Money arrives as ``decimal(18,2)``. Sums stay exact decimals and are turned
into ``double`` only at the end, so the result is the correctly rounded double
of the exact value -- the same bits any engine gives. Ratios that the reports
round to cents use integer half-up arithmetic for the same reason: rounding a
double that was already rounded can land on the wrong side of a half cent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column) -> Column:
    """String -> date; text that is not a date gives NULL (ANSI ``to_date`` would raise)."""
    return F.try_to_date(col_of(c))


def month_label(d: str | Column) -> Column:
    """``yyyy-MM`` label built as year, '-', zero-padded month."""
    d = col_of(d)
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0"))


def months_since(later: str | Column, earlier: str | Column) -> Column:
    """``months_between`` rounded half-up to a whole number (16 days of 31 count as a month)."""
    return F.round(F.months_between(col_of(later), col_of(earlier)), 0).cast("int")


def money_sum(c: str | Column) -> Column:
    """Exact decimal sum of a money column, as double."""
    return F.sum(col_of(c)).cast("double")


def mean_of(c: str | Column) -> Column:
    """Mean as ``double(sum) / count``; NULL when the group has no non-null value.

    For decimal input the sum is exact, so the quotient is one IEEE division of
    two exact numbers and does not depend on how the rows were partitioned.
    """
    c = col_of(c)
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)


def stddev_exact(c: str | Column, scale: int = 2) -> Column:
    """Sample standard deviation of a decimal column (NULL for fewer than 2 rows).

    Uses the exact decimal sums n, S = sum(x), Q = sum(x^2):
    var = (n*Q - S^2) / (n*(n-1)). The numerator is exact, so there is no
    cancellation error and partial aggregates merge without rounding drift.
    """
    c = col_of(c)
    n = F.count(c)
    s = F.sum(c)
    q = F.sum(c * c)
    num = (n.cast(_WIDE) * q - s * s).cast("double")
    return F.when(n > 1, F.sqrt(num / (n * (n - 1)).cast("double")))


def round_ratio(num: str | Column, den: str | Column, digits: int = 2,
                multiplier: int = 1, num_scale: int = 0, den_scale: int = 0) -> Column:
    """``round(num / den * multiplier, digits)`` with exact HALF_UP rounding, as double.

    ``num``/``den`` must be exact numbers (integers or decimals); ``num_scale``
    and ``den_scale`` are their decimal scales. The quotient is never formed
    in floating point: with A, B the unscaled integers,
    R = (2P + Q) div (2Q), P = |A| * multiplier * 10^(digits + den_scale),
    Q = |B| * 10^num_scale, and the result is sign * R / 10^digits.
    NULL when ``den`` is 0 or NULL.
    """
    a = (col_of(num) * F.lit(10 ** num_scale)).cast(_WIDE)
    b = (col_of(den) * F.lit(10 ** den_scale)).cast(_WIDE)
    p = F.abs(a) * F.lit(multiplier * 10 ** (digits + den_scale)).cast(_WIDE)
    q = F.abs(b) * F.lit(10 ** num_scale).cast(_WIDE)
    # SQL ``div``: exact truncating integer division (non-negative operands here)
    rounded = F.call_function("div", (p * 2 + q).cast(_WIDE), (q * 2).cast(_WIDE))
    sign = F.signum(a).cast("bigint") * F.signum(b).cast("bigint")
    return F.when(b != 0, (sign * rounded).cast("double") / F.lit(float(10 ** digits)))


def ratio_or_zero(num: str | Column, den: str | Column, **kw) -> Column:
    """``when(den > 0, round(num/den, 2)).otherwise(0)`` -- the reports' guarded ratio."""
    return F.when(col_of(den) > 0, round_ratio(num, den, **kw)).otherwise(F.lit(0.0))


def count_when(cond: Column) -> Column:
    """Count of rows where ``cond`` is true (NULL counts as false), as bigint."""
    return F.count_if(cond).cast("bigint")
