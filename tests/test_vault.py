"""Hub / link / satellite semantics on hand-made batches."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.vault import load_hub, load_link, load_sat, quarantine
from ledgerlake.params import RunParams
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.sources.schemas import SOURCE_SCHEMAS

T1 = RunParams(load_ts=dt.datetime(2024, 1, 1))
T2 = RunParams(load_ts=dt.datetime(2024, 2, 1))
T3 = RunParams(load_ts=dt.datetime(2024, 3, 1))


def accounts(spark, rows):
    return spark.createDataFrame(rows, SOURCE_SCHEMAS["accounts"])


def acct(aid, cust="C1", typ="Checking", bal="10.00", day=dt.date(2020, 1, 1)):
    return (aid, cust, typ, None if bal is None else D(bal), day)


def test_hub_normalised_keys_and_null(spark):
    b = bronze(accounts(spark, [acct(" a1 "), acct("A1"), acct(None), acct("a2")]), "accounts", T1)
    hub = load_hub(b, ENTITIES["account"], T1)
    rows = {r.account_id: r for r in hub.collect()}
    assert set(rows) == {" a1 ", None, "a2"}         # ' a1 ' < 'A1' (binary order)
    assert rows[None].hk_account is None
    # rerun: non-NULL keys are not re-added, the NULL key is (never matches)
    again = load_hub(b, ENTITIES["account"], T2, existing=hub)
    assert [r.account_id for r in again.collect()] == [None]


def test_link_with_null_side(spark):
    b = bronze(accounts(spark, [acct("A1", cust=None), acct("A2", cust="C2")]), "accounts", T1)
    link = load_link(b, LINKS["customer_account"], T1).collect()
    by_acct = {r.hk_account: r for r in link}
    assert len(link) == 2
    nulls = [r for r in link if r.hk_customer is None]
    assert len(nulls) == 1 and nulls[0].hk_link_customer_account is not None


def _load(spark, batches):
    e = ENTITIES["account"]
    stored = None
    for rows, params in batches:
        new = load_sat(bronze(accounts(spark, rows), "accounts", params), e, params, stored)
        stored = new if stored is None else stored.unionByName(new)
    return stored


def test_sat_noop_change_and_change_back(spark):
    stored = _load(spark, [([acct("A1", bal="10.00")], T1),
                           ([acct("A1", bal="10.00")], T2)])      # no-op rerun
    assert stored.count() == 1
    stored = _load(spark, [([acct("A1", bal="10.00")], T1),
                           ([acct("A1", bal="20.00")], T2),
                           ([acct("A1", bal="10.00")], T3)])      # A -> B -> A
    got = sorted((r.load_dts, str(r.balance_usd)) for r in stored.collect())
    assert got == [(T1.load_ts, "10.00"), (T2.load_ts, "20.00"), (T3.load_ts, "10.00")]


def test_sat_two_versions_in_one_batch_and_null_attribute(spark):
    stored = _load(spark, [([acct("A1", bal="10.00"), acct("A1", bal="30.00"), acct("A1", bal="10.00"),
                             acct("A2", typ=None)], T1)])
    rows = stored.collect()
    assert len(rows) == 3       # A1 twice (both versions, same load time), A2 once
    a1 = sorted(str(r.balance_usd) for r in rows if r.account_type == "Checking")
    assert a1 == ["10.00", "30.00"]
    assert len({r.load_dts for r in rows}) == 1
    a2 = [r for r in rows if r.account_type is None][0]
    assert a2.hash_diff is not None


def test_validity_rules(spark):
    rows = [acct("A1", bal="-0.01"), acct("A2", bal="0"), acct("A3", bal=None), acct("A4", typ="Gold"),
            acct("A5", typ=" Savings ")]
    sat = _load(spark, [(rows, T1)])
    valid = {r.hk_account: r._is_valid for r in sat.collect()}
    hub = {r.account_id: r.hk_account for r in
           load_hub(bronze(accounts(spark, rows), "accounts", T1), ENTITIES["account"], T1).collect()}
    assert [valid[hub[a]] for a in ["A1", "A2", "A3", "A4", "A5"]] == [False, True, True, False, True]


def test_customer_rules(spark):
    schema = SOURCE_SCHEMAS["customers"]
    now = T1.load_ts
    rows = [("C1", "ann", "o'brien-smith", "a@b.c", "paris", 300, now),
            ("C2", "x", "y", "a.b", "x", 850, now),
            ("C3", "x", "y", "a@@b.c", "x", 299, None),
            ("C4", "x", "y", None, "x", None, now + dt.timedelta(seconds=1)),
            ("C5", "x", "y", None, None, 851, None)]
    b = bronze(spark.createDataFrame(rows, schema), "customers", T1)
    sat = load_sat(b, ENTITIES["customer"], T1)
    hub = load_hub(b, ENTITIES["customer"], T1)
    got = {r.customer_id: r for r in sat.join(hub, "hk_customer").collect()}
    assert got["C1"]._is_valid and got["C1"].last_name == "O'Brien-Smith" and got["C1"].city == "Paris"
    assert [got[c]._is_valid for c in ["C2", "C3", "C4", "C5"]] == [False, False, False, False]
    q = quarantine({"customer": sat}, {"customer": hub})
    assert sorted(r.source_business_key for r in q.collect()) == ["C2", "C3", "C4", "C5"]


def test_merchant_name_rule(spark):
    schema = SOURCE_SCHEMAS["merchants"]
    rows = [("M1", "", "x"), ("M2", "  ", "x"), ("M3", None, "x"), ("M4", "Shop", "x")]
    b = bronze(spark.createDataFrame(rows, schema), "merchants", T1)
    sat = load_sat(b, ENTITIES["merchant"], T1)
    hub = load_hub(b, ENTITIES["merchant"], T1)
    got = {r.merchant_id: r._is_valid for r in sat.join(hub, "hk_merchant").collect()}
    assert got == {"M1": False, "M2": False, "M3": False, "M4": True}


def test_dedupe_versions_is_deterministic_on_hash_collisions(spark):
    from ledgerlake.operators.vault import dedupe_versions
    rows = [("h", "Savings", D("1.00"), dt.date(2020, 1, 1), "x", True, T1.load_ts, "s"),
            ("h", "Checking", D("2.00"), dt.date(2020, 1, 1), "x", True, T1.load_ts, "s"),
            ("h", "Checking", D("2.00"), dt.date(2020, 1, 1), "x", True, T1.load_ts, "s")]
    staged = spark.createDataFrame(rows, "hk_account string, account_type string, balance_usd decimal(14,2), "
                                         "open_date date, hash_diff string, _is_valid boolean, "
                                         "load_dts timestamp_ntz, rec_src string")
    for df in [staged, staged.repartition(3), staged.orderBy(F.desc("account_type"))]:
        out = sorted((r.account_type, str(r.balance_usd)) for r in dedupe_versions(df, ENTITIES["account"]).collect())
        # one version per (hk, hash_diff): the smallest tuple stands for both
        assert out == [("Checking", "2.00")]


def test_sat_colliding_hash_is_one_version(spark):
    """('12', '34') and ('123', '4') have one undelimited hash: one row, in a batch and across batches."""
    schema = SOURCE_SCHEMAS["merchants"]

    def batch(rows, params, stored=None):
        return load_sat(bronze(spark.createDataFrame(rows, schema), "merchants", params), ENTITIES["merchant"],
                        params, stored)

    both = batch([("M1", "123", "4"), ("M1", "12", "34")], T1)
    assert [(r.merchant_name, r.city) for r in both.collect()] == [("12", "34")]
    assert batch([("M1", "123", "4")], T2, both).count() == 0
