"""Data-quality assertions (V1-V14): each returns the failing rows, and a
runner evaluates a whole catalogue into one result table.

Evaluation is grouped by cost: every row-level assertion on one table
(not_null, valid_email, in_range, ...) becomes one conditional count inside a
single aggregate, so a table is scanned once for all of them; set-level
assertions (unique, relationships, accepted_values, single_current_version)
are one aggregate or anti-join each.  All of them are partial aggregates,
so hot keys are collapsed map-side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.banking import EMAIL_PATTERN
from ledgerlake.functions.keys import packed

ROW_LEVEL = {"not_null", "valid_email", "not_in_future", "positive_value", "in_range",
             "not_empty_string"}


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str | None = None
    args: tuple = ()            # kind-specific: (parent_table, parent_field) / values / (min, max)
    where: str | None = None
    severity: str = "error"

    @property
    def id(self) -> str:
        tail = f"__{self.args[0]}" if self.kind == "relationships" else ""
        return f"{self.kind}__{self.table}__{self.column}{tail}"


# ---- failing-row predicates / queries ----------------------------------------

def failing_predicate(check: Check, now: Column) -> Column:
    """Row-level assertion -> condition that marks a failing row."""
    c = F.col(check.column)
    k = check.kind
    if k == "not_null":
        return c.isNull()
    if k == "valid_email":
        return c.isNotNull() & ~c.rlike(EMAIL_PATTERN)
    if k == "not_in_future":
        return c.isNotNull() & (c > now)
    if k == "positive_value":
        return c.isNotNull() & (c <= 0)
    if k == "in_range":
        lo, hi = (check.args + (None,))[:2]
        out = c < lo
        if hi is not None:
            out = out | (c > hi)
        return c.isNotNull() & out
    if k == "not_empty_string":
        return c.isNull() | (F.trim(c) == "")
    raise ValueError(k)


def failing_rows(check: Check, tables: dict[str, DataFrame], now: Column) -> DataFrame:
    """The rows the assertion reports (its number of rows = failures)."""
    df = tables[check.table]
    if check.where:
        df = df.filter(check.where)
    c = check.column
    if check.kind in ROW_LEVEL:
        return df.filter(failing_predicate(check, now))
    if check.kind == "unique":
        return (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))
                .filter("n_records > 1"))
    if check.kind == "relationships":
        parent_table, parent_field = check.args
        parent = tables[parent_table].select(F.col(parent_field).alias(c))
        return df.filter(F.col(c).isNotNull()).select(c).join(parent, c, "left_anti")
    if check.kind == "accepted_values":
        return (df.groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(~F.col(c).isin(*check.args)))
    if check.kind == "single_current_version":
        return (df.filter(F.col("is_current")).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select(c))
    if check.kind == "at_least_one_current":
        # optional, not in the reference's catalogue: the prose's "exactly one
        # current row" needs this together with single_current_version
        return (df.filter(F.col(c).isNotNull()).groupBy(c)
                .agg(F.max(F.col("is_current").cast("int")).alias("_any"))
                .filter("_any = 0").select(c))
    raise ValueError(check.kind)


# ---- cross-entity warnings (V11-V13) ------------------------------------------

def _latest(sat: DataFrame, hk: str) -> DataFrame:
    w = Window.partitionBy(hk).orderBy(F.col("load_dts").desc(), F.col("hash_diff").desc())
    return sat.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def account_opened_before_customer(sat_account, link_customer_account, sat_customer) -> DataFrame:
    """V11 (warn): latest account version opened before its customer's creation."""
    a = _latest(sat_account, "hk_account").select("hk_account", "open_date")
    c = _latest(sat_customer, "hk_customer").select("hk_customer", F.col("created_at").alias("customer_created_at"))
    j = a.join(link_customer_account.select("hk_account", "hk_customer"), "hk_account").join(c, "hk_customer")
    return j.filter(F.col("open_date") < F.col("customer_created_at")).select(
        "hk_account", "open_date", "hk_customer", "customer_created_at")


def loan_started_before_customer(sat_loan, link_customer_loan, sat_customer) -> DataFrame:
    """V12 (warn)."""
    lo = _latest(sat_loan, "hk_loan").select("hk_loan", "start_date")
    c = _latest(sat_customer, "hk_customer").select("hk_customer", F.col("created_at").alias("customer_created_at"))
    j = lo.join(link_customer_loan.select("hk_loan", "hk_customer"), "hk_loan").join(c, "hk_customer")
    return j.filter(F.col("start_date") < F.col("customer_created_at")).select(
        "hk_loan", "start_date", "hk_customer", "customer_created_at")


def transaction_before_account_opened(sat_transaction, link_account_transaction, sat_account) -> DataFrame:
    """V13 (warn)."""
    t = _latest(sat_transaction, "hk_transaction").select("hk_transaction", "transaction_date")
    a = _latest(sat_account, "hk_account").select("hk_account", F.col("open_date").alias("account_open_date"))
    j = t.join(link_account_transaction.select("hk_transaction", "hk_account"), "hk_transaction").join(a, "hk_account")
    return j.filter(F.col("transaction_date") < F.col("account_open_date")).select(
        "hk_transaction", "transaction_date", "hk_account", "account_open_date")


CROSS_ENTITY = {
    "account_opened_before_customer": (account_opened_before_customer,
                                       ("sat_account", "link_customer_account", "sat_customer")),
    "loan_started_before_customer": (loan_started_before_customer,
                                     ("sat_loan", "link_customer_loan", "sat_customer")),
    "transaction_before_account_opened": (transaction_before_account_opened,
                                          ("sat_transaction", "link_account_transaction", "sat_account")),
}


def _early_children(child: DataFrame, link: DataFrame, parent: DataFrame, child_hk: str, parent_hk: str,
                    child_day: str, parent_day: str) -> DataFrame:
    """``_n`` rows of children dated before their parent.  Children are counted by (parent key, day) first, so a
    parent with a third of all children is a row per day and map task before it meets its own row."""
    c = _latest(child, child_hk).select(child_hk, F.to_date(child_day).alias("_day"))
    days = (c.join(link.select(child_hk, parent_hk), child_hk).groupBy(parent_hk, "_day")
            .agg(F.count(F.lit(1)).alias("_n")))
    p = _latest(parent, parent_hk).select(parent_hk, F.col(parent_day).alias("_since"))
    return days.join(p, parent_hk).where(F.col("_day") < F.col("_since"))


#: What the cross-entity warnings read, and how the runner counts them: (child key, parent key, dates).
CROSS_KEYS = {
    "account_opened_before_customer": ("hk_account", "hk_customer", "open_date", "created_at"),
    "loan_started_before_customer": ("hk_loan", "hk_customer", "start_date", "created_at"),
    "transaction_before_account_opened": ("hk_transaction", "hk_account", "transaction_date", "open_date"),
}


def cross_columns(name: str) -> dict[str, set[str]]:
    """Columns that a cross-entity warning reads of each of its tables."""
    child, link, parent = CROSS_ENTITY[name][1]
    child_hk, parent_hk, child_day, parent_day = CROSS_KEYS[name]
    version = {"load_dts", "hash_diff"}
    return {child: {child_hk, child_day, *version}, link: {child_hk, parent_hk}, parent: {parent_hk, parent_day, *version}}


# ---- runner -------------------------------------------------------------------

def _label(check_id: str, kind: str, table: str, column: str | None, severity: str,
           failures: Column) -> list[Column]:
    return [F.lit(check_id).alias("test_id"), F.lit(kind).alias("kind"),
            F.lit(table).alias("table_name"), F.lit(column).cast("string").alias("column_name"),
            F.lit(severity).alias("severity"), failures.cast("long").alias("failures")]


def needed_columns(checks: list[Check], cross_entity: list[str] | None = None) -> dict[str, set[str]]:
    """Columns that the assertions read, by table (names in a ``where`` are told by the table's own columns)."""
    out: dict[str, set[str]] = {}
    for ch in checks:
        mine = out.setdefault(ch.table, set())
        mine |= {ch.column, *re.findall(r"\w+", ch.where or "")}
        if ch.kind in ("single_current_version", "at_least_one_current"):
            mine.add("is_current")
        if ch.kind == "relationships":
            out.setdefault(ch.args[0], set()).add(ch.args[1])
    for name in cross_entity or []:
        for table, columns in cross_columns(name).items():
            out.setdefault(table, set()).update(columns)
    return out


def check_parts(checks: list[Check], tables: dict[str, DataFrame], now: Column,
                cross_entity: list[str] | None = None) -> list[DataFrame]:
    """The runner's independent jobs as DataFrames (see :func:`check_jobs`)."""
    return [job() for job in check_jobs(checks, tables, now, cross_entity)]


def check_jobs(checks: list[Check], tables: dict[str, DataFrame], now: Column,
               cross_entity: list[str] | None = None) -> list:
    """The runner's independent jobs, each a function building a small
    DataFrame of result rows (without ``status``), so callers can build and
    run them from several driver threads.

    * all row-level assertions of a table: one aggregate (one scan);
    * all ``unique`` assertions of a table: one aggregate over exploded
      (column, value) pairs (one scan, one shuffle);
    * every other set-level assertion: one aggregate or anti-join.
    """
    jobs: list = []
    row_level: dict[str, list[Check]] = {}
    uniques: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ROW_LEVEL and ch.where is None:
            row_level.setdefault(ch.table, []).append(ch)
        elif ch.kind == "unique" and ch.where is None:
            uniques.setdefault(ch.table, []).append(ch)
        elif ch.kind == "relationships" and ch.where is None:
            jobs.append(lambda ch=ch: _orphan_count(ch, tables))
        else:
            jobs.append(lambda ch=ch: failing_rows(ch, tables, now).agg(
                *_label(ch.id, ch.kind, ch.table, ch.column, ch.severity, F.count(F.lit(1)))))
    for table, group in row_level.items():
        jobs.append(lambda table=table, group=group: _row_level_counts(tables[table], group, now))
    for table, group in uniques.items():
        jobs.append(lambda table=table, group=group: _unique_counts(tables[table], group))
    for name in cross_entity or []:
        _, inputs = CROSS_ENTITY[name]
        jobs.append(lambda name=name, inputs=inputs: _early_children(*[tables[t] for t in inputs], *CROSS_KEYS[name]).agg(
            *_label(name, "singular", inputs[0], None, "warn", F.coalesce(F.sum("_n"), F.lit(0)))))
    return jobs


def _orphan_count(ch: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose key is missing in the parent.  Child keys are counted
    first (a partial aggregate: a key holding a third of the rows becomes one
    row per map task), so the anti-join shuffles distinct keys, not rows."""
    parent_table, parent_field = ch.args
    c = ch.column
    child, parent = tables[ch.table].select(c), tables[parent_table].select(F.col(parent_field).alias(c))
    if dict(child.dtypes)[c] == dict(parent.dtypes)[c] == "string":       # shuffled packed
        child, parent = child.select(packed(c).alias(c)), parent.select(packed(c).alias(c))
    keys = child.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    return keys.join(parent, c, "left_anti").agg(
        *_label(ch.id, ch.kind, ch.table, ch.column, ch.severity, F.coalesce(F.sum("_n"), F.lit(0))))


def _row_level_counts(df: DataFrame, group: list[Check], now: Column) -> DataFrame:
    """All row-level assertions of one table: one aggregate, one row each."""
    counts = df.agg(*[F.count_if(failing_predicate(ch, now)).alias(f"_f{i}") for i, ch in enumerate(group)])
    rows = F.array(*[F.struct(*_label(ch.id, ch.kind, ch.table, ch.column, ch.severity, F.col(f"_f{i}")))
                     for i, ch in enumerate(group)])
    return counts.select(F.explode(rows).alias("_r")).select("_r.*")


def _unique_counts(df: DataFrame, group: list[Check]) -> DataFrame:
    """All ``unique`` assertions of one table: one aggregate over exploded
    (column, value) pairs; failures = number of repeated values."""
    pairs = F.array(*[F.struct(F.lit(i).alias("_i"), packed(F.col(ch.column).cast("string")).alias("_v"))
                      for i, ch in enumerate(group)])
    dup_values = (df.select(F.explode(pairs).alias("_p")).select("_p._i", "_p._v")
                  .filter(F.col("_v").isNotNull())
                  .groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_n"))
                  .filter("_n > 1")
                  .groupBy("_i").agg(F.count(F.lit(1)).alias("_dups")))
    labels = F.array(*[F.struct(F.lit(i).alias("_i"), *_label(ch.id, ch.kind, ch.table, ch.column,
                                                               ch.severity, F.lit(0)))
                       for i, ch in enumerate(group)])
    # a literal table with one row per assertion; the counts have at most as many rows
    lab = df.sparkSession.range(1).select(F.explode(labels).alias("_l")).select("_l.*").drop("failures")
    return (lab.join(F.broadcast(dup_values), "_i", "left")
            .select("test_id", "kind", "table_name", "column_name", "severity",
                    F.coalesce(F.col("_dups"), F.lit(0)).cast("long").alias("failures")))


def status_of(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, "pass").when(severity == "warn", "warn").otherwise("fail")


def run_checks(checks: list[Check], tables: dict[str, DataFrame], now: Column,
               cross_entity: list[str] | None = None) -> DataFrame:
    """Evaluate a catalogue; one result row per assertion with its failure
    count and status (pass / fail / warn; ``error`` severity fails)."""
    out = reduce(DataFrame.unionByName, check_parts(checks, tables, now, cross_entity))
    return out.withColumn("status", status_of(F.col("failures"), F.col("severity")))


# ---- the catalogue (166 assertions, as declared by the reference) -------------

ENTITY_KEYS = {"customer": "customer_id", "account": "account_id", "card": "card_id",
               "merchant": "merchant_id", "branch": "branch_id", "loan": "loan_id",
               "transaction": "transaction_id"}
SOURCE_OF = {"customer": "customers", "account": "accounts", "card": "cards", "merchant": "merchants",
             "branch": "branches", "loan": "loans", "transaction": "transactions"}
LINK_PAIRS = [("customer", "account"), ("account", "card"), ("customer", "loan"),
              ("account", "transaction"), ("merchant", "transaction")]
DIMS = ["customer", "account", "card", "merchant", "branch"]


def catalogue() -> dict[str, list[Check]]:
    """Assertions by layer."""
    bronze = []
    for e, key in ENTITY_KEYS.items():
        t = f"bronze_{SOURCE_OF[e]}"
        bronze += [Check("unique", t, key), Check("not_null", t, key)]
    hubs = []
    for e, key in ENTITY_KEYS.items():
        t = f"hub_{e}"
        hubs += [Check("unique", t, f"hk_{e}"), Check("not_null", t, f"hk_{e}"),
                 Check("unique", t, key), Check("not_null", t, key)]
    links = []
    for a, b in LINK_PAIRS:
        t = f"link_{a}_{b}"
        links += [Check("unique", t, f"hk_link_{a}_{b}"), Check("not_null", t, f"hk_link_{a}_{b}"),
                  Check("relationships", t, f"hk_{a}", (f"hub_{a}", f"hk_{a}")),
                  Check("relationships", t, f"hk_{b}", (f"hub_{b}", f"hk_{b}"))]
    sats = []
    for e in ENTITY_KEYS:
        t = f"sat_{e}"
        sats += [Check("not_null", t, f"hk_{e}"),
                 Check("relationships", t, f"hk_{e}", (f"hub_{e}", f"hk_{e}")),
                 Check("not_null", t, "load_dts")]
    sats += [
        Check("valid_email", "sat_customer", "email"),
        Check("in_range", "sat_customer", "credit_score", (300, 850)),
        Check("not_in_future", "sat_customer", "created_at"),
        Check("accepted_values", "sat_account", "account_type", ("Business", "Checking", "Savings"),
              where="account_type is not null"),
        Check("in_range", "sat_account", "balance_usd", (0,)),
        Check("accepted_values", "sat_card", "card_type", ("Credit", "Debit"), where="card_type is not null"),
        Check("not_empty_string", "sat_merchant", "merchant_name"),
        Check("not_empty_string", "sat_branch", "branch_name"),
        Check("positive_value", "sat_loan", "loan_amount"),
        Check("in_range", "sat_loan", "interest_rate", (0, 100)),
        Check("positive_value", "sat_transaction", "amount_usd"),
        Check("not_in_future", "sat_transaction", "transaction_date"),
    ]
    dims = []
    for e in DIMS:
        t = f"dim_{e}"
        dims += [Check("unique", t, f"{e}_key"), Check("not_null", t, f"{e}_key"),
                 Check("not_null", t, f"{e}_hub_key"), Check("single_current_version", t, f"{e}_hub_key"),
                 Check("not_null", t, ENTITY_KEYS[e]), Check("not_null", t, "is_current")]
    dims += [
        Check("accepted_values", "dim_customer", "credit_tier",
              ("super_prime", "prime", "near_prime", "subprime", "deep_subprime"),
              where="credit_tier is not null"),
        Check("accepted_values", "dim_account", "account_type", ("Business", "Checking", "Savings"),
              where="account_type is not null"),
        Check("accepted_values", "dim_card", "card_type", ("Credit", "Debit"), where="card_type is not null"),
        Check("not_null", "dim_account", "customer_hub_key"),
        Check("relationships", "dim_account", "customer_hub_key", ("dim_customer", "customer_hub_key")),
        Check("not_null", "dim_card", "account_hub_key"),
        Check("relationships", "dim_card", "account_hub_key", ("dim_account", "account_hub_key")),
        Check("unique", "dim_date", "date_key"), Check("not_null", "dim_date", "date_key"),
        Check("unique", "dim_date", "date_day"), Check("not_null", "dim_date", "date_day"),
    ]
    facts = [
        Check("unique", "fact_transactions", "transaction_hub_key"),
        Check("not_null", "fact_transactions", "transaction_hub_key"),
    ]
    for col, parent in [("account_hub_key", "dim_account"), ("merchant_hub_key", "dim_merchant"),
                        ("customer_hub_key", "dim_customer"), ("date_key", "dim_date")]:
        facts += [Check("not_null", "fact_transactions", col),
                  Check("relationships", "fact_transactions", col, (parent, col))]
    facts += [Check("positive_value", "fact_transactions", "amount_usd"),
              Check("unique", "fact_loans", "loan_hub_key"), Check("not_null", "fact_loans", "loan_hub_key")]
    for col, parent in [("customer_hub_key", "dim_customer"), ("date_key", "dim_date")]:
        facts += [Check("not_null", "fact_loans", col),
                  Check("relationships", "fact_loans", col, (parent, col))]
    facts += [Check("positive_value", "fact_loans", "loan_amount"),
              Check("in_range", "fact_loans", "interest_rate", (0, 100)),
              Check("unique", "fact_account_balance", "account_hub_key"),
              Check("not_null", "fact_account_balance", "account_hub_key"),
              Check("relationships", "fact_account_balance", "account_hub_key",
                    ("dim_account", "account_hub_key"))]
    for col, parent in [("customer_hub_key", "dim_customer"), ("date_key", "dim_date")]:
        facts += [Check("not_null", "fact_account_balance", col),
                  Check("relationships", "fact_account_balance", col, (parent, col))]
    facts += [Check("in_range", "fact_account_balance", "balance_usd", (0,))]
    return {"bronze": bronze, "hubs": hubs, "links": links, "satellites": sats,
            "dimensions": dims, "facts": facts}


def all_checks() -> list[Check]:
    return [c for group in catalogue().values() for c in group]
