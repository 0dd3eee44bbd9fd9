from ledgerlake.functions.banking import (credit_tier, date_key, month_start,
                                         tier_sort_order, year_start)
from ledgerlake.functions.keys import hash_diff, hash_key, link_hash_key, surrogate_key
from ledgerlake.functions.text import clean_lower, clean_text, clean_title, pg_initcap

__all__ = [
    "credit_tier", "date_key", "month_start", "tier_sort_order", "year_start",
    "hash_diff", "hash_key", "link_hash_key", "surrogate_key",
    "clean_lower", "clean_text", "clean_title", "pg_initcap",
]
