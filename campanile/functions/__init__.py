"""Column expressions shared by operators and reports."""

from campanile.functions.labels import category_bucket, ctr_tier, quadrant
from campanile.functions.metrics import (
    count_where, from_micros, in_percent, in_thousands, micros, pivot_count,
    pivot_count_or_null, performance_score, ratio, rounded_ratio, safe_div, sum_money,
)
from campanile.functions.once import with_parsed

__all__ = [
    "category_bucket", "count_where", "ctr_tier", "from_micros", "in_percent",
    "in_thousands", "micros", "performance_score", "pivot_count",
    "pivot_count_or_null", "quadrant", "ratio", "rounded_ratio", "safe_div", "sum_money", "with_parsed",
]
