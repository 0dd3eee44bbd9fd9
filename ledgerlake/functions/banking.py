"""Domain expressions: credit tiers, calendar keys, month/year starts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's models and tests.
# Credit tiers, lower bound inclusive, checked from the top: 800 super_prime,
# 740 prime, 670 near_prime, 580 subprime, below that deep_subprime.
CREDIT_TIER_BOUNDS = [
    (800, "super_prime"),
    (740, "prime"),
    (670, "near_prime"),
    (580, "subprime"),
]
CREDIT_TIER_FLOOR = "deep_subprime"
# Sort order of the tiers in reports; anything else (incl. NULL) sorts as 99.
CREDIT_TIER_ORDER = ["deep_subprime", "subprime", "near_prime", "prime", "super_prime"]
CREDIT_TIER_OTHER = 99
ACCOUNT_TYPES = ["Business", "Checking", "Savings"]
CARD_TYPES = ["Credit", "Debit"]
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"
CREDIT_SCORE_RANGE = (300, 850)
INTEREST_RATE_RANGE = (0, 100)
OPEN_END_TS = "9999-12-31 00:00:00"
CARD_EXPIRY_BUCKETS = [30, 60, 90]


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def credit_tier(score) -> Column:
    s = _c(score)
    expr = F.when(s.isNull(), F.lit(None).cast("string"))
    for bound, label in CREDIT_TIER_BOUNDS:
        expr = expr.when(s >= bound, F.lit(label))
    return expr.otherwise(F.lit(CREDIT_TIER_FLOOR))


def tier_sort_order(tier) -> Column:
    t = _c(tier)
    expr = None
    for i, label in enumerate(CREDIT_TIER_ORDER, start=1):
        expr = F.when(t == label, F.lit(i)) if expr is None else expr.when(t == label, F.lit(i))
    return expr.otherwise(F.lit(CREDIT_TIER_OTHER))


def date_key(d) -> Column:
    """``yyyymmdd`` as int, computed arithmetically (no string formatting)."""
    x = _c(d)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def month_start(d) -> Column:
    """``date_trunc('month', d)::date`` (Spark ``trunc`` returns a date)."""
    return F.trunc(_c(d).cast("date"), "month")


def year_start(d) -> Column:
    return F.trunc(_c(d).cast("date"), "year")


def open_end_ts() -> Column:
    return F.lit(OPEN_END_TS).cast("timestamp_ntz")
