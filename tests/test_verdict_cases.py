"""Cases the registered queries alone would not show: counts, exact money, hits of every assertion kind."""

import datetime as dt
from decimal import Decimal as D

from ledgerlake.operators import profile, reports
from ledgerlake.plans import registry
from ledgerlake.plans.oracle_checks import CONSTRAINTS

from conftest import SF_SMALL


def test_constraint_lists_are_complete_and_equal():
    own = {(c.kind, c.table, c.column, frozenset(map(str, c.args))) for c in profile.suggested_constraints()}
    by_hand = {(c.kind, c.table, c.column, frozenset(map(str, c.args))) for c in CONSTRAINTS}
    assert len(profile.suggested_constraints()) == len(CONSTRAINTS) == 42 and own == by_hand


def test_money_totals_keep_their_cents(spark):
    rows = [(k, dt.date(2020, 1, 1), D("999999999999.99")) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, start_date date, loan_amount decimal(14,2)")
    total = df.agg(reports.money_total("loan_amount").alias("t")).first().t
    assert total == D("999999999999.99") * 200 and total > 10**14


def test_every_assertion_kind_finds_something(spark):
    for name in registry.FAILING_CHECKS:
        assert registry.spark_query(f"check_hits_{name}")(spark, SF_SMALL).count() > 0, name


def test_point_in_time_join_meets_both_versions(spark):
    rows = registry.spark_query("join_point_in_time")(spark, SF_SMALL)
    starts = {r.effective_start_date for r in rows.select("effective_start_date").distinct().collect()}
    assert starts == {dt.datetime(2017, 1, 1), dt.datetime(2019, 1, 1)}


def test_value_counts_are_descending(spark):
    rows = registry.spark_query("profile_value_counts")(spark, SF_SMALL).collect()
    for column in {r.column_name for r in rows}:
        counts = [r.value_count for r in rows if r.column_name == column]
        assert counts == sorted(counts, reverse=True)
