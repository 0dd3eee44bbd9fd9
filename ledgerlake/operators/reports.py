"""Reporting models R1-R18: flat, pre-aggregated tables behind the charts.

Result types: counts are bigint; money totals are exact decimal sums
exact decimals with cents; averages are ``double(sum) / count``; percentages are
rounded half-up to two places with integer arithmetic, so every engine gets
the same digits.

Big fact tables are reduced by a partial aggregate on the join key before
they meet a dimension (R9, R16, R17): the shuffle then carries one row per key
and map task instead of one per event, and a hot key cannot overload a join task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.banking import (CARD_EXPIRY_BUCKETS, month_start, tier_sort_order,
                                          year_start)
from ledgerlake.operators.ranking import approximate_quantiles, global_rank, value_quantiles
from ledgerlake.params import RunParams


# ---- result-type helpers -----------------------------------------------------

MONEY = "decimal(38,2)"


def money_total(col: str | Column) -> Column:
    """``coalesce(sum(x), 0)`` as an exact decimal with cents."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)


def mean(sum_col: Column, count_col: Column) -> Column:
    """``coalesce(avg, 0)`` from a sum and a non-null count."""
    return F.coalesce(F.try_divide(sum_col.cast("double"), count_col), F.lit(0.0))


def money_avg(col: str) -> Column:
    return mean(F.sum(col), F.count(col))


def pct(part: Column, whole: Column) -> Column:
    """``round(part / nullif(whole, 0) * 100, 2)`` for non-negative counts,
    exact half-up rounding: ``(20000 * part + whole) div (2 * whole) / 100``."""
    part_l, whole_l = part.cast("long"), whole.cast("long")
    return F.when(whole_l == 0, F.lit(None).cast("double")).otherwise(
        F.call_function("div", part_l * 20000 + whole_l, whole_l * 2).cast("double") / 100.0)


def _current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


# ---- reports -----------------------------------------------------------------

def _customer_balances(fab: DataFrame) -> DataFrame:
    return (fab.groupBy("customer_hub_key")
            .agg(F.sum("balance_usd").alias("total_balance_usd"),
                 F.count(F.lit(1)).alias("account_count")))


def customer_kpis(dim_customer: DataFrame, fab: DataFrame, fact_loans: DataFrame,
                  fact_tx: DataFrame, params: RunParams) -> DataFrame:
    """One KPI row.  The two fact totals are one-row aggregates joined to
    the one-row customer aggregate (bounded broadcasts).  With no current
    customers the reference's cross join yields no rows, so the fact totals
    read NULL while counts read 0; reproduced with a guard."""
    cur = _current(dim_customer).select("customer_hub_key")
    cb = _customer_balances(fab)
    multi = F.when(F.col("account_count") > 1, 1).otherwise(0)
    base = cur.join(cb, "customer_hub_key", "left").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum("account_count"), F.lit(0)).cast("long").alias("total_accounts"),
        money_total("total_balance_usd").alias("total_deposits_usd"),
        F.coalesce(F.sum(multi), F.lit(0)).cast("long").alias("customers_with_multiple_accounts"))
    lt = fact_loans.agg(money_total("loan_amount").alias("_loans"))
    tt = fact_tx.agg(money_total("amount_usd").alias("_tx"))
    has = F.col("total_customers") > 0
    return base.crossJoin(F.broadcast(lt)).crossJoin(F.broadcast(tt)).select(
        "total_customers", "total_accounts", "total_deposits_usd",
        "customers_with_multiple_accounts",
        F.coalesce(pct(F.col("customers_with_multiple_accounts"), F.col("total_customers")),
                   F.lit(0.0)).alias("pct_customers_with_multiple_accounts"),
        F.when(has, F.col("_loans")).alias("total_loan_book_usd"),
        F.when(has, F.col("_tx")).alias("total_transaction_volume_usd"),
        params.as_of_col.alias("snapshot_date"))


def monthly_customer_growth(dim_customer: DataFrame) -> DataFrame:
    """R2."""
    return (_current(dim_customer).groupBy("acquisition_month")
            .agg(F.count(F.lit(1)).alias("new_customers")))


def yearly_account_openings_by_type(dim_account: DataFrame) -> DataFrame:
    """R3."""
    return (_current(dim_account)
            .groupBy(year_start("open_date").alias("open_year"), "account_type")
            .agg(F.count(F.lit(1)).alias("new_accounts")))


def _balances_by(fab: DataFrame, dim_account: DataFrame, keys: list[Column]) -> DataFrame:
    ca = _current(dim_account).select("account_hub_key", "account_type", "open_date")
    f = fab.select("account_hub_key", "balance_usd")
    return (f.join(ca, "account_hub_key").groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("account_count"),
                 money_total("balance_usd").alias("total_balance_usd"),
                 money_avg("balance_usd").alias("avg_balance_usd")))


def account_type_deposits(fab: DataFrame, dim_account: DataFrame) -> DataFrame:
    """R4."""
    return _balances_by(fab, dim_account, [F.col("account_type")])


def account_opening_cohort_trend(fab: DataFrame, dim_account: DataFrame) -> DataFrame:
    """R5."""
    return _balances_by(fab, dim_account,
                        [month_start("open_date").alias("open_month"), F.col("account_type")])


def customer_balance_summary(dim_customer: DataFrame, fab: DataFrame) -> DataFrame:
    """Every current customer with balance totals and a global rank by
    total balance (desc), then customer id.  The id makes the order total, so
    the rank is computed by the range-partitioned numbering, not in one task."""
    cc = _current(dim_customer).select("customer_hub_key", "customer_id", "first_name",
                                       "last_name", "city", "credit_tier")
    cb = _customer_balances(fab)
    j = cc.join(cb, "customer_hub_key", "left").select(
        "customer_hub_key", "customer_id", "first_name", "last_name", "city", "credit_tier",
        F.coalesce(F.col("account_count"), F.lit(0)).cast("long").alias("account_count"),
        F.coalesce(F.col("total_balance_usd"), F.lit(0)).alias("_total"))
    ranked = global_rank(j, [F.col("_total").desc(), F.col("customer_id").asc_nulls_last()],
                         out="balance_rank")
    return ranked.select(
        "customer_hub_key", "customer_id", "first_name", "last_name", "city", "credit_tier",
        "account_count", F.col("_total").cast(MONEY).alias("total_balance_usd"),
        "balance_rank")


def customer_balance_kpis(fab: DataFrame, params: RunParams, accuracy: int | None = None) -> DataFrame:
    """Per-customer totals, then count / mean / median / total.

    The median is exact, from (value, count) pairs; with ``accuracy`` it comes
    from a mergeable summary, its rank off by at most 1 / ``accuracy``.
    """
    cb = fab.groupBy("customer_hub_key").agg(F.sum("balance_usd").alias("total_balance_usd"))
    kpis = cb.agg(
        F.count(F.lit(1)).alias("customers_with_balance_rows"),
        money_avg("total_balance_usd").alias("avg_balance_usd"),
        money_total("total_balance_usd").alias("total_balance_usd"))
    values, middle = {"total": F.col("total_balance_usd")}, {"_median": 0.5}
    med = (approximate_quantiles(cb, values, middle, accuracy) if accuracy else value_quantiles(cb, values, middle))
    return kpis.join(F.broadcast(med), F.lit(True), "left").select(      # one row, or none without balances
        "customers_with_balance_rows", "avg_balance_usd",
        F.coalesce(F.col("_median"), F.lit(0.0)).alias("median_balance_usd"),
        "total_balance_usd", params.as_of_col.alias("snapshot_date"))


def loan_monthly_trend(fact_loans: DataFrame) -> DataFrame:
    """R8."""
    return (fact_loans.groupBy(month_start("start_date").alias("origination_month"))
            .agg(F.count(F.lit(1)).alias("loan_count"),
                 money_total("loan_amount").alias("total_loan_amount_usd"),
                 money_avg("interest_rate").alias("avg_interest_rate")))


def interest_rate_by_credit_tier(fact_loans: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Loans pre-aggregated per customer, joined to current customers."""
    per_cust = fact_loans.groupBy("customer_hub_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("loan_amount").alias("_amt"),
        F.sum("interest_rate").alias("_rate_sum"), F.count("interest_rate").alias("_rate_n"))
    cc = _current(dim_customer).select("customer_hub_key", "credit_tier")
    j = per_cust.join(cc, "customer_hub_key")
    return (j.groupBy("credit_tier", tier_sort_order("credit_tier").alias("credit_tier_sort_order"))
            .agg(F.sum("_n").cast("long").alias("loan_count"),
                 money_total("_amt").alias("total_loan_amount_usd"),
                 mean(F.sum("_rate_sum"), F.sum("_rate_n")).alias("avg_interest_rate")))


def loan_penetration_by_credit_tier(dim_customer: DataFrame, fact_loans: DataFrame) -> DataFrame:
    """Share of current customers with at least one loan, per tier."""
    cc = _current(dim_customer).select("customer_hub_key", "credit_tier")
    borrowers = fact_loans.select(F.col("customer_hub_key").alias("_borrower")).distinct()
    j = cc.join(borrowers, cc.customer_hub_key == borrowers._borrower, "left")
    has = F.when(F.col("_borrower").isNotNull(), 1).otherwise(0)
    agg = (j.groupBy("credit_tier", tier_sort_order("credit_tier").alias("credit_tier_sort_order"))
           .agg(F.count(F.lit(1)).alias("total_customers"),
                F.sum(has).cast("long").alias("customers_with_loans")))
    return agg.withColumn("loan_penetration_pct",
                          pct(F.col("customers_with_loans"), F.col("total_customers")))


def customer_credit_mix_monthly(dim_customer: DataFrame) -> DataFrame:
    """Tier counts per acquisition month and their share of the month.
    The window runs over the (month, tier) aggregate, not over customers."""
    counts = (_current(dim_customer).groupBy("acquisition_month", "credit_tier")
              .agg(F.count(F.lit(1)).alias("customer_count")))
    month_total = F.sum("customer_count").over(Window.partitionBy("acquisition_month"))
    return counts.select(
        "acquisition_month", "credit_tier",
        tier_sort_order("credit_tier").alias("credit_tier_sort_order"),
        "customer_count",
        pct(F.col("customer_count"), month_total).alias("pct_of_month_total"))


def card_portfolio_summary(dim_card: DataFrame, dim_account: DataFrame) -> DataFrame:
    """R12."""
    cc = _current(dim_card).select("account_hub_key", "card_type")
    ca = _current(dim_account).select("account_hub_key", "account_type")
    return (cc.join(ca, "account_hub_key").groupBy("account_type", "card_type")
            .agg(F.count(F.lit(1)).alias("card_count")))


def dim_card_enriched(dim_card: DataFrame, dim_account: DataFrame, dim_customer: DataFrame,
                      params: RunParams) -> DataFrame:
    """Current cards with account and customer attributes and expiry flags."""
    cc = _current(dim_card).select("card_hub_key", "card_id", "account_hub_key", "card_type",
                                   F.col("expiration_date").cast("date").alias("expiration_date"))
    ca = _current(dim_account).select("account_hub_key", "account_id", "customer_hub_key",
                                      "account_type")
    cu = _current(dim_customer).select("customer_hub_key", "customer_id", "credit_tier",
                                       F.col("city").alias("customer_city"))
    j = cc.join(ca, "account_hub_key").join(cu, "customer_hub_key", "left")
    today = params.as_of_col
    flags = [F.coalesce(F.col("expiration_date") <= F.date_add(today, n), F.lit(False))
             .alias(f"expires_within_{n}_days") for n in CARD_EXPIRY_BUCKETS]
    return j.select(
        "card_hub_key", "card_id", "account_hub_key", "account_id", "account_type",
        "customer_hub_key", "customer_id", "credit_tier", "customer_city", "card_type",
        "expiration_date",
        F.datediff(F.col("expiration_date"), today).alias("days_to_expiration"),
        *flags, today.alias("snapshot_date"))


def card_expiry_buckets(dim_card: DataFrame, params: RunParams) -> DataFrame:
    """Cumulative counts of current cards expiring by as_of + 30/60/90.

    The reference writes a ``<=`` theta left join from a three-row bucket
    table to all cards (a nested-loop join).  One pass with three conditional
    counts gives the same three rows (zero buckets included) and then
    ``stack`` turns the columns into rows.
    """
    cc = _current(dim_card).select("card_id", F.col("expiration_date").cast("date").alias("e"))
    today = params.as_of_col
    counts = cc.agg(*[
        F.count(F.when(F.col("e") <= F.date_add(today, n), F.col("card_id"))).alias(f"c{n}")
        for n in CARD_EXPIRY_BUCKETS])
    stack = "stack({k}, {rows}) as (bucket_days, cards_expiring_count)".format(
        k=len(CARD_EXPIRY_BUCKETS),
        rows=", ".join(f"{n}, c{n}" for n in CARD_EXPIRY_BUCKETS))
    return counts.selectExpr(stack).select(
        F.col("bucket_days").cast("int").alias("bucket_days"),
        F.concat(F.lit("<= "), F.col("bucket_days").cast("string"), F.lit(" days")).alias("bucket_label"),
        F.col("cards_expiring_count").cast("long").alias("cards_expiring_count"),
        today.alias("snapshot_date"))


def transaction_monthly_summary(fact_tx: DataFrame) -> DataFrame:
    """R15."""
    return (fact_tx.groupBy(month_start("transaction_date").alias("transaction_month"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_total("amount_usd").alias("total_transaction_volume_usd"),
                 money_avg("amount_usd").alias("avg_transaction_amount_usd")))


def top_merchants(fact_tx: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Volume per current merchant, ranked globally by volume then id.

    Facts are aggregated per merchant before the join (the reference joins
    first); merchants without transactions do not appear, as in the reference.
    """
    per_m = fact_tx.groupBy("merchant_hub_key").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount_usd").alias("_vol"))
    cm = _current(dim_merchant).select("merchant_hub_key", "merchant_id", "merchant_name", "city")
    # one current row per merchant, but keep the reference's per-row grouping
    j = (per_m.join(cm, "merchant_hub_key")
         .groupBy("merchant_hub_key", "merchant_id", "merchant_name", "city")
         .agg(F.sum("transaction_count").cast("long").alias("transaction_count"),
              F.coalesce(F.sum("_vol"), F.lit(0)).alias("_vol")))
    ranked = global_rank(j, [F.col("_vol").desc(), F.col("merchant_id").asc_nulls_last()],
                         out="volume_rank")
    return ranked.select("merchant_hub_key", "merchant_id", "merchant_name", "city",
                         "transaction_count",
                         F.col("_vol").cast(MONEY).alias("total_transaction_volume_usd"),
                         "volume_rank")


def avg_transaction_by_account_type(fact_tx: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Transactions pre-aggregated per account, then by account type."""
    per_acct = fact_tx.groupBy("account_hub_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount_usd").alias("_amt"),
        F.count("amount_usd").alias("_amt_n"))
    ca = _current(dim_account).select("account_hub_key", "account_type")
    j = per_acct.join(ca, "account_hub_key")
    return (j.groupBy("account_type")
            .agg(F.sum("_n").cast("long").alias("transaction_count"),
                 money_total("_amt").alias("total_transaction_volume_usd"),
                 mean(F.sum("_amt"), F.sum("_amt_n")).alias("avg_transaction_amount_usd")))


def signups_by_month(dim_customer: DataFrame) -> DataFrame:
    """Customer versions (all, not only current) by created month."""
    return (dim_customer.groupBy(month_start("created_date").alias("signup_month"))
            .agg(F.count(F.lit(1)).alias("customer_count")))


# report -> builder over (models by name, run parameters)
BUILDERS = {
    "customer_kpis": lambda t, p: customer_kpis(t["dim_customer"], t["fact_account_balance"],
                                                        t["fact_loans"], t["fact_transactions"], p),
    "monthly_customer_growth": lambda t, p: monthly_customer_growth(t["dim_customer"]),
    "yearly_account_openings_by_type": lambda t, p: yearly_account_openings_by_type(t["dim_account"]),
    "account_type_deposits": lambda t, p: account_type_deposits(t["fact_account_balance"], t["dim_account"]),
    "account_opening_cohort_trend": lambda t, p: account_opening_cohort_trend(
        t["fact_account_balance"], t["dim_account"]),
    "customer_balance_summary": lambda t, p: customer_balance_summary(t["dim_customer"],
                                                                              t["fact_account_balance"]),
    "customer_balance_kpis": lambda t, p: customer_balance_kpis(t["fact_account_balance"], p),
    "loan_monthly_trend": lambda t, p: loan_monthly_trend(t["fact_loans"]),
    "interest_rate_by_credit_tier": lambda t, p: interest_rate_by_credit_tier(t["fact_loans"],
                                                                                      t["dim_customer"]),
    "loan_penetration_by_credit_tier": lambda t, p: loan_penetration_by_credit_tier(
        t["dim_customer"], t["fact_loans"]),
    "customer_credit_mix_monthly": lambda t, p: customer_credit_mix_monthly(t["dim_customer"]),
    "card_portfolio_summary": lambda t, p: card_portfolio_summary(t["dim_card"], t["dim_account"]),
    "dim_card_enriched": lambda t, p: dim_card_enriched(t["dim_card"], t["dim_account"],
                                                                t["dim_customer"], p),
    "card_expiry_buckets": lambda t, p: card_expiry_buckets(t["dim_card"], p),
    "transaction_monthly_summary": lambda t, p: transaction_monthly_summary(t["fact_transactions"]),
    "top_merchants": lambda t, p: top_merchants(t["fact_transactions"], t["dim_merchant"]),
    "avg_transaction_by_account_type": lambda t, p: avg_transaction_by_account_type(
        t["fact_transactions"], t["dim_account"]),
    "signups_by_month": lambda t, p: signups_by_month(t["dim_customer"]),
}

#: Models that each report reads.
INPUTS = {
    "customer_kpis": ("dim_customer", "fact_account_balance", "fact_loans", "fact_transactions"),
    "monthly_customer_growth": ("dim_customer",),
    "yearly_account_openings_by_type": ("dim_account",),
    "account_type_deposits": ("fact_account_balance", "dim_account"),
    "account_opening_cohort_trend": ("fact_account_balance", "dim_account"),
    "customer_balance_summary": ("dim_customer", "fact_account_balance"),
    "customer_balance_kpis": ("fact_account_balance",),
    "loan_monthly_trend": ("fact_loans",),
    "interest_rate_by_credit_tier": ("fact_loans", "dim_customer"),
    "loan_penetration_by_credit_tier": ("dim_customer", "fact_loans"),
    "customer_credit_mix_monthly": ("dim_customer",),
    "card_portfolio_summary": ("dim_card", "dim_account"),
    "dim_card_enriched": ("dim_card", "dim_account", "dim_customer"),
    "card_expiry_buckets": ("dim_card",),
    "transaction_monthly_summary": ("fact_transactions",),
    "top_merchants": ("fact_transactions", "dim_merchant"),
    "avg_transaction_by_account_type": ("fact_transactions", "dim_account"),
    "signups_by_month": ("dim_customer",),
}
