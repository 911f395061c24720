"""Scalar column helpers (dates, guarded and exactly rounded ratios, money sums)."""

from mercato.functions.scalar import (  # noqa: F401
    count_when,
    mean_of,
    money_sum,
    month_label,
    months_since,
    parse_date,
    ratio_or_zero,
    round_ratio,
    stddev_exact,
)
