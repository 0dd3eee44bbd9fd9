"""Query registry: every operator as ``(spark, sf_dir) -> DataFrame`` plus its
reference SQL.  All queries read the driver tables of ``sf_dir`` in full."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.keys import unpacked_keys
from ledgerlake.operators import charts as ch
from ledgerlake.operators import checks as chk
from ledgerlake.operators import gold, profile, reports
from ledgerlake.operators.skew import HOT_SHARE
from ledgerlake.params import DRIVER_RUN, EVENT_LOADS, ts_literal
from ledgerlake.plans import oracle, oracle_checks
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.plans.incremental import account_history, account_upkeep, packed_account_history, three_batches
from ledgerlake.plans.layers import Lakehouse
from ledgerlake.session import staged
from ledgerlake.sources.driver_tables import account_batches
from ledgerlake.sources.schemas import SOURCE_SCHEMAS

Builder = Callable[[Lakehouse], DataFrame]

class _Models:
    """Model name -> lazily built table, for the shared report builders."""

    def __init__(self, lh: Lakehouse):
        self.lh = lh

    def __getitem__(self, name: str) -> DataFrame:
        return self.lh.table(name)


REPORTS: dict[str, Builder] = {
    name: (lambda build: lambda lh: build(_Models(lh), lh.params))(build)
    for name, build in reports.BUILDERS.items()}


def _registry() -> tuple[dict[str, Builder], dict[str, str]]:
    q: dict[str, Builder] = {}
    sql: dict[str, str] = {}

    # bronze, vault
    for src in ["customers", "accounts", "cards", "merchants", "branches", "loans", "transactions"]:
        q[f"bronze_{src}"] = (lambda s: lambda lh: lh.bronze(s))(src)
        sql[f"bronze_{src}"] = oracle.table(f"bronze_{src}")
    for e in ENTITIES:
        q[f"hub_{e}"] = (lambda n: lambda lh: lh.hub(n))(e)
        sql[f"hub_{e}"] = oracle.table(f"hub_{e}")
        q[f"sat_{e}"] = (lambda n: lambda lh: lh.sat(n))(e)
        sql[f"sat_{e}"] = oracle.table(f"sat_{e}")
    for name in LINKS:
        q[f"link_{name}"] = (lambda n: lambda lh: lh.link(n))(name)
        sql[f"link_{name}"] = oracle.table(f"link_{name}")
    q["quarantine"] = lambda lh: lh.quarantine
    sql["quarantine"] = oracle.table("quarantine")

    # incremental (two batches of accounts)
    q["hub_account_incremental"] = lambda lh: account_history(lh).hub
    sql["hub_account_incremental"] = oracle.table("hub_account_incremental")
    q["sat_account_incremental"] = lambda lh: account_history(lh).sat
    sql["sat_account_incremental"] = oracle.table("sat_account_incremental")
    q["link_customer_account_incremental"] = lambda lh: account_history(lh).link
    sql["link_customer_account_incremental"] = oracle.table("link_customer_account_incremental")
    q["sat_account_three_batches"] = three_batches
    sql["sat_account_three_batches"] = oracle.table("sat_account_three_batches")
    q["dim_account_upkeep"] = account_upkeep
    sql["dim_account_upkeep"] = oracle.table("dim_account_upkeep")
    q["dim_account_history"] = lambda lh: account_history(lh).dim
    sql["dim_account_history"] = oracle.table("dim_account_history")

    # gold
    for name in ["dim_customer", "dim_account", "dim_card", "dim_merchant", "dim_branch",
                 "fact_transactions", "fact_loans", "fact_account_balance"]:
        q[name] = (lambda n: lambda lh: getattr(lh, n))(name)
        sql[name] = oracle.table(name)

    # the same fact, and the two joins on a possibly hot key, with hot keys split explicitly
    q["fact_transactions_salted"] = lambda lh: lh.transactions_fact(hot_share=HOT_SHARE)
    sql["fact_transactions_salted"] = oracle.table("fact_transactions")

    # documented joins
    q["join_current_customer"] = lambda lh: gold.join_current(
        lh.fact_transactions.select("transaction_hub_key", "customer_hub_key", "amount_usd"),
        lh.dim_customer.select("customer_hub_key", "customer_id", "city", "credit_tier", "is_current"),
        "customer_hub_key").drop("is_current")
    sql["join_current_customer"] = oracle.build("""
    SELECT f.customer_hub_key, f.transaction_hub_key, f.amount_usd, c.customer_id, c.city, c.credit_tier
    FROM fact_transactions f JOIN dim_customer c ON c.customer_hub_key = f.customer_hub_key AND c.is_current""")

    # the account history was loaded while the transactions happened, so both versions are met
    def point_in_time(lh, hot_share=None):
        hot = lh.hot_accounts.withColumnRenamed("hk_account", "account_hub_key")
        return gold.join_point_in_time(
            lh.transactions_fact(dealt=True).select("transaction_hub_key", "account_hub_key", "transaction_date", "amount_usd", "_salt"),
            packed_account_history(lh, EVENT_LOADS), "account_hub_key", "transaction_date", ["account_key", "account_type"],
            hot_share=hot_share, dealt_by=hot)

    q["join_point_in_time"] = point_in_time
    sql["join_point_in_time"] = oracle.build("""
    SELECT transaction_hub_key, f.account_hub_key, transaction_date, amount_usd, effective_start_date,
           effective_end_date, account_key, account_type
    FROM fact_transactions f ASOF JOIN event_dim_account d
      ON d.account_hub_key = f.account_hub_key AND f.transaction_date >= d.effective_start_date""")

    q["join_point_in_time_salted"] = lambda lh: point_in_time(lh, hot_share=HOT_SHARE)
    sql["join_point_in_time_salted"] = sql["join_point_in_time"]
    q["join_current_customer_salted"] = lambda lh: gold.join_current(
        lh.fact_transactions.select("transaction_hub_key", "customer_hub_key", "amount_usd"),
        lh.dim_customer.select("customer_hub_key", "customer_id", "city", "credit_tier", "is_current"),
        "customer_hub_key", hot_share=HOT_SHARE,
        hot_from=lh.customer_activity.withColumnRenamed("hk_customer", "customer_hub_key"), weight="_rows").drop("is_current")
    sql["join_current_customer_salted"] = sql["join_current_customer"]

    q["join_fact_calendar"] = lambda lh: gold.join_calendar(
        lh.fact_transactions.select("transaction_hub_key", "date_key", "amount_usd"), lh.dim_date)
    sql["join_fact_calendar"] = oracle.build("""
    SELECT f.date_key, f.transaction_hub_key, f.amount_usd, d.date_day, d.year, d.quarter, d.month, d.month_name,
           d.day_of_month, d.day_of_week, d.day_name, d.is_weekend, d.week_of_year, d.day_of_year, d.is_month_end
    FROM fact_transactions f JOIN dim_date d ON d.date_key = f.date_key""")

    q["spend_by_city_quarter"] = lambda lh: gold.spend_by_city_quarter(
        lh.fact_transactions, lh.dim_customer, lh.dim_date)
    sql["spend_by_city_quarter"] = oracle.build("""
    SELECT c.city, d.year, d.quarter, CAST(sum(f.amount_usd) AS DECIMAL(38,2)) AS total_spend
    FROM fact_transactions f JOIN dim_customer c ON c.customer_hub_key = f.customer_hub_key AND c.is_current
    JOIN dim_date d ON d.date_key = f.date_key
    GROUP BY c.city, d.year, d.quarter ORDER BY d.year, d.quarter, c.city""")

    # reports
    for name, fn in REPORTS.items():
        q[f"report_{name}"] = fn
        sql[f"report_{name}"] = oracle.table(name)

    # charts
    for cid, spec in ch.CHARTS.items():
        q[f"chart_{cid}"] = (lambda s: lambda lh: ch.chart(REPORTS[s.report](lh), s))(spec)
        sql[f"chart_{cid}"] = oracle.build(chart_sql(spec))

    # data-quality assertions, by layer (166 with the three cross-entity ones)
    for layer, checks in chk.catalogue().items():
        q[f"checks_{layer}"] = checks_query(checks)
        sql[f"checks_{layer}"] = oracle_checks.run_checks_sql(checks)
    cross = list(chk.CROSS_ENTITY)
    q["checks_cross_entity"] = checks_query([], cross)
    sql["checks_cross_entity"] = oracle_checks.run_checks_sql([], cross)
    for name, (fn, inputs) in chk.CROSS_ENTITY.items():
        child, parent = inputs[0].removeprefix("sat_"), inputs[2].removeprefix("sat_")
        q[f"check_{name}"] = (lambda f, c, p: lambda lh: unpacked_keys(f(*lh.packed_versions(c, p))))(fn, child, parent)
        sql[f"check_{name}"] = oracle.build(oracle_checks.CROSS_SQL[name])
    for check in FAILING_ROW_CHECKS:
        name = f"check_rows_{check.kind}_{check.table}_{check.column}"
        q[name] = (lambda c: lambda lh: chk.failing_rows(c, LakeTables(lh), lh.params.load_ts_col))(check)
        sql[name] = oracle.build(oracle_checks.failing_sql(check))

    for name, (check, tables, now, text) in FAILING_CHECKS.items():
        q[f"check_hits_{name}"] = (lambda c, t, n: lambda lh: chk.failing_rows(
            c, t(lh), lh.params.load_ts_col if n is None else ts_literal(n)))(check, tables, now)
        sql[f"check_hits_{name}"] = oracle.build(text)

    # profiling of the sources
    src_cols = {t: [(f.name, f.dataType.simpleString()) for f in SOURCE_SCHEMAS[t].fields]
                for t in profile.PROFILED_TABLES}
    q["profile_shape"] = lambda lh: profile.shape(lh.sources)
    sql["profile_shape"] = oracle_checks.profile_shape_sql({t: len(c) for t, c in src_cols.items()})
    for t, key in profile.PROFILED_TABLES.items():
        q[f"profile_head_{t}"] = (lambda t_, k_: lambda lh: profile.head(lh.sources[t_], k_))(t, key)
        sql[f"profile_head_{t}"] = oracle.build(f"SELECT * FROM {t} ORDER BY {key} LIMIT 3")
    q["profile_column_summary"] = lambda lh: profile.column_summaries(lh.sources)
    sql["profile_column_summary"] = oracle_checks.column_summary_sql(src_cols)
    for name, fn in [("value_counts", profile.value_counts), ("numeric_describe", profile.numeric_describe),
                     ("relationships", profile.relationship_summary), ("multiplicity", profile.multiplicity),
                     ("quality_counters", profile.quality_counters), ("date_ranges", profile.date_ranges),
                     ("coverage", profile.coverage)]:
        q[f"profile_{name}"] = (lambda f: lambda lh: f(lh.sources))(fn)
        sql[f"profile_{name}"] = oracle.build(oracle_checks.PROFILE_SQL[name])
    q["profile_constraints"] = lambda lh: profile.constraint_report(lh.sources, lh.params.load_ts_col)
    sql["profile_constraints"] = oracle_checks.run_checks_sql(oracle_checks.CONSTRAINTS)
    return q, sql


class LakeTables(dict):
    """Mapping from model name to the Lakehouse table, built on first use.

    With ``materialize`` each table is written into the session's checkpoint
    folder the first time it is needed, so the many
    assertions over one table read it instead of re-deriving it, as the
    pipeline does with its written tables; ``columns`` names those that are
    kept of a table.
    """

    def __init__(self, lh: Lakehouse, materialize: bool = False, columns: dict[str, set[str]] | None = None):
        super().__init__()
        self.lh = lh
        self.materialize = materialize
        self.columns = columns or {}

    def __missing__(self, name: str) -> DataFrame:
        df = self.lh.table(name)
        if name in self.columns:
            df = df.select(*[c for c in df.columns if c in self.columns[name]])
        if self.materialize:
            df = staged(df, name)
        self[name] = df
        return df

    def prefetch(self, names: list[str], workers: int = 8) -> "LakeTables":
        """Build (and with ``materialize``, write) several tables at
        once from driver threads."""
        from concurrent.futures import ThreadPoolExecutor
        todo = [n for n in dict.fromkeys(names) if n not in self]
        with ThreadPoolExecutor(max_workers=max(1, min(workers, len(todo) or 1))) as pool:
            for n, df in zip(todo, pool.map(self.__missing__, todo)):
                self[n] = df
        return self


def checks_query(checks: list, cross: list[str] | None = None) -> Builder:
    """A layer's assertions over its tables: the tables are written once
    (concurrently) and every assertion reads what was written, as the pipeline's
    assertions read the written tables."""
    def run(lh: Lakehouse) -> DataFrame:
        if not checks:
            # each table is read once, by inner joins on its hub key: nothing to write
            tables = {n: lh.keyed_table(n) for name in cross for n in chk.CROSS_ENTITY[name][1]}
            return chk.run_checks(checks, tables, lh.params.load_ts_col, cross)
        needed = chk.needed_columns(checks, cross)
        tables = LakeTables(lh, materialize=True, columns=needed).prefetch(list(needed))
        return chk.run_checks(checks, tables, lh.params.load_ts_col, cross)
    return run


# Failing-row queries registered one by one (one per rule kind on its satellite).
FAILING_ROW_CHECKS = [
    chk.Check("valid_email", "sat_customer", "email"),
    chk.Check("in_range", "sat_customer", "credit_score", (300, 850)),
    chk.Check("in_range", "sat_account", "balance_usd", (0,)),
    chk.Check("accepted_values", "sat_card", "card_type", ("Credit", "Debit"), where="card_type is not null"),
    chk.Check("not_empty_string", "sat_merchant", "merchant_name"),
    chk.Check("not_in_future", "sat_transaction", "transaction_date"),
    chk.Check("positive_value", "sat_loan", "loan_amount"),
    chk.Check("single_current_version", "dim_account_history", "account_hub_key"),
    chk.Check("unique", "bronze_transactions", "transaction_id"),
    chk.Check("not_null", "fact_transactions", "customer_hub_key"),
    chk.Check("relationships", "fact_transactions", "date_key", ("dim_date", "date_key")),
    chk.Check("not_empty_string", "sat_branch", "branch_name"),
    chk.Check("positive_value", "fact_transactions", "amount_usd"),
    chk.Check("accepted_values", "dim_customer", "credit_tier",
              ("super_prime", "prime", "near_prime", "subprime", "deep_subprime"),
              where="credit_tier is not null"),
]


def _line_ids(lh: Lakehouse) -> dict[str, DataFrame]:
    """Order lines under (order, line number), which is not a key of the driver's table."""
    lines = lh.spark.read.parquet(f"{lh.sf_dir}/lineitem.parquet")
    return {"lines": lines.select(F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                              F.col("l_linenumber").cast("string")).alias("line_id"))}


def _two_loads(lh: Lakehouse) -> dict[str, DataFrame]:
    first, second = account_batches(lh.spark, lh.sf_dir)
    return {"accounts_b1": first, "accounts_b2": second}


def _all_current(lh: Lakehouse) -> dict[str, DataFrame]:
    return {"versions": account_history(lh).dim.withColumn("is_current", F.lit(True))}


# Assertion kinds on tables in which they find something: (assertion, tables, "now", SQL).
FAILING_CHECKS = {
    "unique": (chk.Check("unique", "lines", "line_id"), _line_ids, None, """
    SELECT l_orderkey || '-' || l_linenumber AS line_id, count(*) AS n_records
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) >= 2"""),
    "relationships": (chk.Check("relationships", "accounts_b2", "account_id", ("accounts_b1", "account_id")),
                      _two_loads, None, """
    SELECT account_id FROM accounts_b2 ANTI JOIN accounts_b1 USING (account_id)"""),
    "not_null": (chk.Check("not_null", "customers", "credit_score"), lambda lh: lh.sources, None,
                 "SELECT * FROM customers WHERE credit_score IS NULL"),
    "not_in_future": (chk.Check("not_in_future", "transactions", "transaction_date"), lambda lh: lh.sources,
                      dt.datetime(2018, 1, 1),
                      "SELECT * FROM transactions WHERE transaction_date > TIMESTAMP '2018-01-01 00:00:00'"),
    "positive_value": (chk.Check("positive_value", "accounts", "balance_usd"), lambda lh: lh.sources, None,
                       "SELECT * FROM accounts WHERE NOT balance_usd > 0"),
    "single_current_version": (chk.Check("single_current_version", "versions", "account_hub_key"), _all_current, None,
                               """SELECT hk_account AS account_hub_key FROM sat_account_incremental
                               GROUP BY hk_account HAVING count(*) >= 2"""),
}


def chart_sql(spec: ch.Chart) -> str:
    def m(x: ch.Metric) -> str:
        if x.agg == "sum":
            return f"CAST(sum({x.column}) AS BIGINT) AS {x.alias}"
        if x.agg == "sum_money":
            return f"CAST(sum({x.column}) AS DECIMAL(38,2)) AS {x.alias}"
        if x.agg == "sum_exact":
            return f"CAST(sum(CAST({x.column} AS DECIMAL(38,2))) AS DOUBLE) AS {x.alias}"
        return f"{x.agg}({x.column}) AS {x.alias}"
    cols = [*spec.group_by, *[m(x) for x in spec.metrics]]
    s = f"SELECT {', '.join(cols)} FROM {spec.report}"
    if spec.where:
        s += f" WHERE {spec.where}"
    if spec.group_by:
        s += f" GROUP BY {', '.join(spec.group_by)}"
    return s


QUERIES, ORACLE_SQL = _registry()


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    builder = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(Lakehouse.from_driver(spark, sf_dir, DRIVER_RUN))
    run.__name__ = name
    return run
