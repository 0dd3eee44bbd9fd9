"""Table profiling (P1-P11), re-aimed from a single-machine notebook to Spark jobs.

Every profile is an aggregate over the source tables: one wide aggregate per
table for the column summary, conditional counts for the quality counters,
semi / anti joins for relationship coverage, and the distributed exact
percentile for quartiles (no single-task percentile buffer).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.checks import Check, run_checks
from ledgerlake.operators.ranking import value_quantiles
from ledgerlake.operators.reports import pct

# The tables, relations and columns the exploratory profile covers.
PROFILED_TABLES = {"customers": "customer_id", "accounts": "account_id", "cards": "card_id",
                   "loans": "loan_id", "branches": "branch_id", "merchants": "merchant_id"}
RELATIONS = [("accounts -> customers", "accounts", "customer_id", "customers", "customer_id"),
             ("cards -> accounts", "cards", "account_id", "accounts", "account_id"),
             ("loans -> customers", "loans", "customer_id", "customers", "customer_id")]
MULTIPLICITY = [("accounts_per_customer", "accounts", "customer_id"),
                ("cards_per_account", "cards", "account_id"),
                ("loans_per_customer", "loans", "customer_id")]
NUMERIC = [("customers.credit_score", "customers", "credit_score"),
           ("accounts.balance_usd", "accounts", "balance_usd"),
           ("loans.loan_amount", "loans", "loan_amount"),
           ("loans.interest_rate", "loans", "interest_rate")]
VALUE_COUNTS = [("accounts", "account_type"), ("cards", "card_type")]
DATE_FIELDS = [("customers.created_at", "customers", "created_at"),
               ("accounts.open_date", "accounts", "open_date"),
               ("cards.expiration_date", "cards", "expiration_date"),
               ("loans.start_date", "loans", "start_date")]
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def shape(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows x columns per table."""
    return _union([df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                          F.lit(len(df.columns)).alias("column_count"))
                   for t, df in ((t, sources[t]) for t in PROFILED_TABLES)])


def head(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first ``n`` rows by key (a top-n: ``TakeOrderedAndProject``)."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def column_summary(df: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """Per column dtype, non-null / null counts, null percentage, distinct
    values.  One aggregate pass per table; the result is unpivoted by an
    explode of one struct per column.

    Exact distinct counts of many columns expand every row once per column
    before the shuffle; ``exact=False`` uses HyperLogLog sketches instead
    (``approx_count_distinct``, ~1% error, merged map-side, no expansion).
    """
    distinct = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.01))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.col(c)).alias(f"_nn{i}"), distinct(F.col(c)).alias(f"_u{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, f in enumerate(df.schema.fields):
        nulls = F.col("_rows") - F.col(f"_nn{i}")
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"_nn{i}").cast("long").alias("non_null"), nulls.cast("long").alias("nulls"),
            F.coalesce(pct(nulls, F.col("_rows")), F.lit(0.0)).alias("null_pct"),
            F.col(f"_u{i}").cast("long").alias("unique_values")))
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def column_summaries(sources: dict[str, DataFrame], exact: bool = True) -> DataFrame:
    return _union([column_summary(sources[t], t, exact) for t in PROFILED_TABLES])


def value_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Category counts (NULL dropped), most frequent first."""
    counts = _union([sources[t].filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("value"))
                   .agg(F.count(F.lit(1)).alias("value_count"))
                   .select(F.lit(f"{t}.{c}").alias("column_name"), "value", "value_count")
                   for t, c in VALUE_COUNTS])
    return counts.orderBy("column_name", F.col("value_count").desc(), "value")


def describe(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """P5: count, mean, sample std, min, quartiles (exact, linear
    interpolation), max of numeric columns of one table; one row per label.
    One aggregate and one set of (value, count) pairs serve all columns."""
    stats = []
    for i, c in enumerate(columns.values()):
        v = c.cast("double")
        stats += [F.count(c).alias(f"_n{i}"), F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(f"_mean{i}"),
                  F.round(F.stddev_samp(v), 6).alias(f"_std{i}"), F.min(v).alias(f"_min{i}"), F.max(v).alias(f"_max{i}")]
    rows = F.array(*[F.struct(F.lit(label).alias("label"), F.col(f"_n{i}").cast("long").alias("count"),
                              *[F.col(f"_{x}{i}").alias(x) for x in ("mean", "std", "min", "max")])
                     for i, label in enumerate(columns)])
    base = df.agg(*stats).select(F.explode(rows).alias("_r")).select("_r.*")
    q = value_quantiles(df, columns, QUARTILES)
    return base.join(F.broadcast(q), "label", "left").select(            # a row per column
        F.col("label").alias("field"), "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def numeric_describe(sources: dict[str, DataFrame]) -> DataFrame:
    tables: dict[str, dict[str, Column]] = {}
    for label, t, c in NUMERIC:
        tables.setdefault(t, {})[label] = F.col(c)
    return _union([describe(sources[t], columns) for t, columns in tables.items()])


def relationship_summary(sources: dict[str, DataFrame]) -> DataFrame:
    """Child rows, parent rows, orphan children (NULL keys count as
    orphans, as ``~isin`` does), parents with at least one child."""
    parts = []
    for name, child, fk, parent, pk in RELATIONS:
        c = sources[child].select(F.col(fk).alias("_k"))
        p = sources[parent].select(F.col(pk).alias("_k"))
        # child keys counted first: a hot key is one row per map task before any join
        keys = c.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
        orphans = keys.join(p, "_k", "left_anti").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_child_rows"))
        with_kids = p.join(keys.select("_k"), "_k", "left_semi").agg(
            F.count(F.lit(1)).alias("parents_with_children"))
        parts.append(c.agg(F.count(F.lit(1)).alias("child_rows"))
                     .crossJoin(p.agg(F.count(F.lit(1)).alias("parent_rows")))
                     .crossJoin(orphans).crossJoin(with_kids)
                     .select(F.lit(name).alias("relationship"), "child_rows", "parent_rows",
                             "orphan_child_rows", "parents_with_children"))
    return _union(parts)


def multiplicity(sources: dict[str, DataFrame]) -> DataFrame:
    """Describe of the number of children per parent key."""
    parts = []
    for label, child, fk in MULTIPLICITY:
        sizes = sources[child].filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(describe(sizes, {label: F.col("_n")}))
    return _union(parts)


def _duplicated(c: Column) -> Column:
    """Rows repeating an earlier value (NULLs equal to each other, as pandas)."""
    return (F.count(F.lit(1)) - F.count_distinct(c)
            - F.when(F.count_if(c.isNull()) > 0, 1).otherwise(0))


def quality_counters(sources: dict[str, DataFrame]) -> DataFrame:
    """Seven counters."""
    cu, br, me, ac, lo = (sources[t] for t in ["customers", "branches", "merchants", "accounts", "loans"])
    parts = [
        ("duplicate customer emails", cu.agg(_duplicated(F.col("email")).alias("v"))),
        ("duplicate branch names", br.agg(_duplicated(F.col("branch_name")).alias("v"))),
        ("duplicate merchant names", me.agg(_duplicated(F.col("merchant_name")).alias("v"))),
        ("negative account balances", ac.agg(F.count_if(F.col("balance_usd") < 0).alias("v"))),
        ("negative loan amounts", lo.agg(F.count_if(F.col("loan_amount") < 0).alias("v"))),
        ("credit scores outside 300-850",
         cu.agg(F.count_if((F.col("credit_score") < 300) | (F.col("credit_score") > 850)).alias("v"))),
        ("interest rates outside 0-100",
         lo.agg(F.count_if((F.col("interest_rate") < 0) | (F.col("interest_rate") > 100)).alias("v"))),
    ]
    return _union([df.select(F.lit(name).alias("check"), F.col("v").cast("long").alias("value"))
                   for name, df in parts])


def date_ranges(sources: dict[str, DataFrame]) -> DataFrame:
    """Min / max of the four date columns (rendered as text)."""
    return _union([sources[t].agg(F.lit(label).alias("field"),
                                  F.min(c).cast("string").alias("min"),
                                  F.max(c).cast("string").alias("max"))
                   for label, t, c in DATE_FIELDS])


def coverage(sources: dict[str, DataFrame]) -> DataFrame:
    """P10: parents having at least one child (semi joins)."""
    cu, ac, ca, lo = (sources[t] for t in ["customers", "accounts", "cards", "loans"])
    spec = [("customers with accounts", cu, "customer_id", ac, "customer_id"),
            ("customers with loans", cu, "customer_id", lo, "customer_id"),
            ("accounts with cards", ac, "account_id", ca, "account_id")]
    # distinct child keys (partial aggregate) on the build side of each semi join
    return _union([p.select(F.col(pk).alias("_k"))
                   .join(c.select(F.col(fk).alias("_k")).distinct(), "_k", "left_semi")
                   .agg(F.lit(name).alias("metric"), F.count(F.lit(1)).cast("long").alias("value"))
                   for name, p, pk, c, fk in spec])


# Columns that the suggested tables declare NOT NULL besides keys and references
REQUIRED = {
    "customers": ("first_name", "last_name", "email", "city", "credit_score", "created_at"),
    "accounts": ("account_type", "balance_usd", "open_date"),
    "cards": ("card_type", "expiration_date"),
    "loans": ("loan_amount", "interest_rate", "start_date"),
    "branches": ("branch_name", "manager_name"),
    "merchants": ("merchant_name", "city"),
}


def suggested_constraints() -> list[Check]:
    """The 42 suggested constraints as assertions on the sources."""
    checks = []
    for t, key in PROFILED_TABLES.items():
        checks += [Check("unique", t, key), Check("not_null", t, key)]
        checks += [Check("not_null", t, c) for c in REQUIRED[t]]
    for _, child, fk, parent, pk in RELATIONS:
        checks += [Check("not_null", child, fk), Check("relationships", child, fk, (parent, pk))]
    checks += [Check("accepted_values", "accounts", "account_type", ("Checking", "Savings", "Business")),
               Check("accepted_values", "cards", "card_type", ("Debit", "Credit")),
               Check("in_range", "customers", "credit_score", (300, 850)),
               Check("in_range", "accounts", "balance_usd", (0,)),
               Check("in_range", "loans", "loan_amount", (0,)),
               Check("in_range", "loans", "interest_rate", (0, 100))]
    return checks


def constraint_report(sources: dict[str, DataFrame], now: Column) -> DataFrame:
    return run_checks(suggested_constraints(), sources, now)
