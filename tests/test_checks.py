"""Assertion semantics on hand-made tables (failure counts = rows the
reference's test SQL would return)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators.checks import Check, all_checks, failing_rows, run_checks
from ledgerlake.params import RunParams

from conftest import SF_SMALL

PARAMS = RunParams(load_ts=dt.datetime(2024, 1, 1))


def _tables(spark):
    child = spark.createDataFrame(
        [("a", "p1", "x@y.z", 5, "Credit", dt.datetime(2023, 1, 1)),
         ("a", "p1", "bad", -1, "Gold", dt.datetime(2025, 1, 1)),
         ("b", None, None, None, None, None),
         (None, "p9", "a@b.c", 0, " ", dt.datetime(2024, 1, 1)),
         (None, "p9", "a@@b.c", 101, "Debit", None)],
        "k string, fk string, email string, v int, t string, ts timestamp_ntz")
    parent = spark.createDataFrame([("p1",), ("p1",), ("p2",)], "pk string")
    dim = spark.createDataFrame([("h1", True), ("h1", True), ("h2", True), ("h2", False), (None, True)],
                                "hub string, is_current boolean")
    return {"child": child, "parent": parent, "dim": dim}


CASES = [
    (Check("unique", "child", "k"), 1),                    # 'a' twice; NULLs ignored
    (Check("unique", "child", "fk"), 2),                   # 'p1', 'p9'
    (Check("not_null", "child", "k"), 2),
    (Check("relationships", "child", "fk", ("parent", "pk")), 2),   # two 'p9' rows; NULL fk ignored
    (Check("accepted_values", "child", "t", ("Credit", "Debit"), where="t is not null"), 2),  # 'Gold', ' '
    (Check("valid_email", "child", "email"), 2),
    (Check("not_in_future", "child", "ts"), 1),
    (Check("positive_value", "child", "v"), 2),
    (Check("in_range", "child", "v", (0, 100)), 2),
    (Check("in_range", "child", "v", (0,)), 1),
    (Check("not_empty_string", "child", "t"), 2),          # NULL and ' '
    (Check("single_current_version", "dim", "hub"), 1),    # h1
    (Check("at_least_one_current", "dim", "hub"), 0),
]


def test_at_least_one_current(spark):
    dim = spark.createDataFrame([("h1", False), ("h1", False), ("h2", True), ("h2", False)],
                                "hub string, is_current boolean")
    rows = failing_rows(Check("at_least_one_current", "dim", "hub"), {"dim": dim}, PARAMS.load_ts_col)
    assert [r.hub for r in rows.collect()] == ["h1"]


def test_failing_rows_counts(spark):
    tables = _tables(spark)
    for check, want in CASES:
        assert failing_rows(check, tables, PARAMS.load_ts_col).count() == want, check.id


def test_runner_matches_failing_rows_and_sets_status(spark):
    tables = _tables(spark)
    cases = [(c, w) for c, w in CASES if c.args != (0,)]      # one id per (kind, table, column)
    checks = [c for c, _ in cases] + [Check("not_null", "child", "email", severity="warn"),
                                      Check("unique", "parent", "pk", severity="warn")]
    got = {r.test_id: (r.failures, r.status) for r in run_checks(checks, tables, PARAMS.load_ts_col).collect()}
    for check, want in cases:
        assert got[check.id] == (want, "fail" if want else "pass"), check.id
    assert got["not_null__child__email"] == (1, "warn")
    assert got["unique__parent__pk"] == (1, "warn")


def test_catalogue_has_the_reference_count():
    checks = all_checks()
    assert len(checks) == 163
    assert len({c.id for c in checks}) == 163
    kinds = {}
    for c in checks:
        kinds[c.kind] = kinds.get(c.kind, 0) + 1
    assert kinds == {"unique": 36, "not_null": 75, "relationships": 28, "accepted_values": 5,
                     "valid_email": 1, "not_in_future": 2, "positive_value": 4, "in_range": 5,
                     "not_empty_string": 2, "single_current_version": 5}


def test_cross_entity_counts_equal_failing_rows(spark):
    """The runner counts children by (parent, day); the failing-row queries join them one by one."""
    from ledgerlake.operators import checks as chk
    from ledgerlake.params import DRIVER_RUN
    from ledgerlake.plans.layers import Lakehouse

    lh = Lakehouse.from_driver(spark, SF_SMALL)
    names = list(chk.CROSS_ENTITY)
    tables = {t: lh.table(t) for n in names for t in chk.CROSS_ENTITY[n][1]}
    got = {r.test_id: r.failures for r in chk.run_checks([], tables, DRIVER_RUN.load_ts_col, names).collect()}
    for n in names:
        fn, inputs = chk.CROSS_ENTITY[n]
        assert got[n] == fn(*[tables[t] for t in inputs]).count()
    assert max(got.values()) > 0
    narrow = chk.needed_columns([c for c in chk.all_checks() if c.table == "dim_card"], names)
    assert narrow["dim_account"] == {"account_hub_key"} and "is_current" in narrow["dim_card"]
