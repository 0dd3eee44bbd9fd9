"""Explicit schemas of the seven OLTP source tables (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
RATE = T.DecimalType(5, 2)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": _s(
        ("customer_id", T.StringType()), ("first_name", T.StringType()),
        ("last_name", T.StringType()), ("email", T.StringType()),
        ("city", T.StringType()), ("credit_score", T.IntegerType()),
        ("created_at", T.TimestampNTZType())),
    "accounts": _s(
        ("account_id", T.StringType()), ("customer_id", T.StringType()),
        ("account_type", T.StringType()), ("balance_usd", MONEY),
        ("open_date", T.DateType())),
    "cards": _s(
        ("card_id", T.StringType()), ("account_id", T.StringType()),
        ("card_type", T.StringType()), ("expiration_date", T.DateType())),
    "merchants": _s(
        ("merchant_id", T.StringType()), ("merchant_name", T.StringType()),
        ("city", T.StringType())),
    "branches": _s(
        ("branch_id", T.StringType()), ("branch_name", T.StringType()),
        ("manager_name", T.StringType()), ("city", T.StringType()),
        ("country", T.StringType())),
    "loans": _s(
        ("loan_id", T.StringType()), ("customer_id", T.StringType()),
        ("loan_amount", MONEY), ("interest_rate", RATE),
        ("start_date", T.DateType())),
    "transactions": _s(
        ("transaction_id", T.StringType()), ("account_id", T.StringType()),
        ("merchant_id", T.StringType()), ("amount_usd", MONEY),
        ("transaction_date", T.TimestampNTZType())),
}

SOURCE_TABLES = list(SOURCE_SCHEMAS)


def columns(table: str) -> list[str]:
    return [f.name for f in SOURCE_SCHEMAS[table].fields]
