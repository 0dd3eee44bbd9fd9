"""Dashboard metric queries C1-C21: one aggregate over one report each.

Rule of the reference's dashboard guide: MAX on one-row KPI tables, SUM on
pre-aggregated rows, COUNT on entity rows.  Sums of money re-enter exact
decimal arithmetic (the report carries two-decimal values as double), so the
result does not depend on the summation order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    agg: str        # "max" | "sum" | "count" | "sum_money" (decimal) | "sum_exact" (2-decimal percentages) | "min"
    column: str
    alias: str


@dataclass(frozen=True)
class Chart:
    id: str
    title: str
    report: str
    metrics: tuple[Metric, ...]
    group_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    where: str | None = None


def _metric(m: Metric) -> Column:
    c = F.col(m.column)
    if m.agg == "max":
        return F.max(c).alias(m.alias)
    if m.agg == "min":
        return F.min(c).alias(m.alias)
    if m.agg == "count":
        return F.count(c).alias(m.alias)
    if m.agg == "sum":
        return F.sum(c).cast("long").alias(m.alias)
    if m.agg == "sum_money":
        return F.sum(c).cast("decimal(38,2)").alias(m.alias)
    if m.agg == "sum_exact":
        return F.sum(c.cast("decimal(38,2)")).cast("double").alias(m.alias)
    raise ValueError(m.agg)


def _m(agg, col, alias=None):
    return Metric(agg, col, alias or col)


# Catalogue of the 21 charts (titles, datasets and aggregates as in the
# reference's dashboard guide).
CHARTS: dict[str, Chart] = {c.id: c for c in [
    Chart("c01", "Total Customers", "customer_kpis", (_m("max", "total_customers"),)),
    Chart("c02", "Total Deposits", "customer_kpis", (_m("max", "total_deposits_usd"),)),
    Chart("c03", "Total Loan Book", "customer_kpis", (_m("max", "total_loan_book_usd"),)),
    Chart("c04", "Total Transaction Volume", "customer_kpis",
          (_m("max", "total_transaction_volume_usd"),)),
    Chart("c05", "New Customers per Month", "monthly_customer_growth",
          (_m("sum", "new_customers"),), ("acquisition_month",), ("acquisition_month",)),
    Chart("c06", "New Accounts per Year by Type", "yearly_account_openings_by_type",
          (_m("sum", "new_accounts"),), ("open_year", "account_type"), ("open_year", "account_type")),
    Chart("c07", "% Customers with Multiple Accounts", "customer_kpis",
          (_m("max", "pct_customers_with_multiple_accounts"),)),
    Chart("c08", "Total Deposits by Account Type", "account_type_deposits",
          (_m("sum_money", "total_balance_usd"),), ("account_type",), ("account_type",)),
    Chart("c09", "Account Opening Trend by Cohort", "account_opening_cohort_trend",
          (_m("sum_money", "total_balance_usd"),), ("open_month", "account_type"),
          ("open_month", "account_type")),
    Chart("c10", "Average Balance per Customer", "customer_balance_kpis",
          (_m("max", "avg_balance_usd"),)),
    Chart("c11", "Median Balance per Customer", "customer_balance_kpis",
          (_m("max", "median_balance_usd"),)),
    Chart("c12", "Deposit Concentration", "customer_balance_summary",
          (_m("sum_money", "total_balance_usd"), _m("min", "balance_rank")),
          ("customer_id",), ("balance_rank",)),
    Chart("c13", "Loan Originations Trend", "loan_monthly_trend",
          (_m("sum_money", "total_loan_amount_usd"),), ("origination_month",), ("origination_month",)),
    Chart("c14", "Interest Rate vs Credit Tier", "interest_rate_by_credit_tier",
          (_m("max", "avg_interest_rate"),), ("credit_tier", "credit_tier_sort_order"),
          ("credit_tier_sort_order",)),
    Chart("c15", "Loan Penetration by Credit Tier", "loan_penetration_by_credit_tier",
          (_m("max", "loan_penetration_pct"),), ("credit_tier", "credit_tier_sort_order"),
          ("credit_tier_sort_order",)),
    Chart("c16", "Credit Tier Mix Over Time", "customer_credit_mix_monthly",
          (_m("sum_exact", "pct_of_month_total"),), ("acquisition_month", "credit_tier"),
          ("acquisition_month", "credit_tier")),
    Chart("c17", "Debit vs Credit Mix by Account Type", "dim_card_enriched",
          (_m("count", "card_id", "card_count"),), ("account_type", "card_type"),
          ("account_type", "card_type")),
    Chart("c18", "Cards Expiring Soon", "card_expiry_buckets",
          (_m("max", "cards_expiring_count"),), ("bucket_days",), ("bucket_days",),
          "bucket_days in (30, 60, 90)"),
    Chart("c19", "Transaction Volume and Count by Month", "transaction_monthly_summary",
          (_m("sum_money", "total_transaction_volume_usd"), _m("sum", "transaction_count")),
          ("transaction_month",), ("transaction_month",)),
    Chart("c20", "Top Merchants by Volume", "top_merchants",
          (_m("sum_money", "total_transaction_volume_usd"),), ("merchant_name",),
          ("total_transaction_volume_usd",)),
    Chart("c21", "Average Transaction Size by Account Type", "avg_transaction_by_account_type",
          (_m("max", "avg_transaction_amount_usd"),), ("account_type",), ("account_type",)),
]}


def chart(report_df: DataFrame, spec: Chart) -> DataFrame:
    """Run one chart's metric query over its report."""
    df = report_df.filter(spec.where) if spec.where else report_df
    metrics = [_metric(m) for m in spec.metrics]
    out = df.groupBy(*spec.group_by).agg(*metrics) if spec.group_by else df.agg(*metrics)
    if spec.order_by:
        desc = spec.id == "c20"
        out = out.orderBy(*[F.col(c).desc() if desc else F.col(c).asc_nulls_last()
                            for c in spec.order_by])
    return out
