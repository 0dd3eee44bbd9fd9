"""SCD2, calendar and report edge cases on hand-made data."""

import datetime as dt
from decimal import Decimal as D

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.operators import gold, reports
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.ranking import exact_percentile, global_rank
from ledgerlake.operators.vault import load_hub, load_link, load_sat
from ledgerlake.params import DRIVER_RUN, RunParams
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.sources.schemas import SOURCE_SCHEMAS

T1 = RunParams(load_ts=dt.datetime(2024, 1, 1))
T2 = RunParams(load_ts=dt.datetime(2024, 2, 1))


def test_scd2_closes_previous_version(spark):
    e, l = ENTITIES["account"], LINKS["customer_account"]
    hub = link = sat = None
    for bal, p in [("10.00", T1), ("20.00", T2)]:
        df = spark.createDataFrame([("A1", "C1", "Checking", D(bal), dt.date(2020, 1, 1))],
                                   SOURCE_SCHEMAS["accounts"])
        b = bronze(df, "accounts", p)
        nh, nl, ns = load_hub(b, e, p, hub), load_link(b, l, p, link), load_sat(b, e, p, sat)
        hub = nh if hub is None else hub.unionByName(nh)
        link = nl if link is None else link.unionByName(nl)
        sat = ns if sat is None else sat.unionByName(ns)
    dim = gold.dim_account(sat, hub, link).orderBy("effective_start_date").collect()
    assert len(dim) == 2
    assert dim[0].effective_end_date == T2.load_ts and not dim[0].is_current
    assert dim[1].effective_end_date == dt.datetime(9999, 12, 31) and dim[1].is_current
    assert dim[0].account_key != dim[1].account_key
    fab = gold.fact_account_balance(sat, link).collect()
    assert len(fab) == 1 and str(fab[0].balance_usd) == "20.00" and fab[0].date_key == 20240201


def test_dim_date(spark):
    d = gold.dim_date(spark)
    assert d.count() == 5480
    r = {x.date_day: x for x in d.filter(F.col("date_key").isin(20210101, 20240229, 20300101)).collect()}
    a = r[dt.date(2021, 1, 1)]
    assert (a.week_of_year, a.day_of_week, a.day_name, a.month_name, a.quarter) == (53, 5, "Friday", "January", 1)
    assert r[dt.date(2024, 2, 29)].is_month_end and not r[dt.date(2030, 1, 1)].is_month_end


def test_card_expiry_buckets_keep_zero_and_null(spark):
    as_of = dt.date(2021, 8, 1)
    rows = [("K1", as_of - dt.timedelta(days=1)), ("K2", as_of + dt.timedelta(days=30)),
            ("K3", as_of + dt.timedelta(days=31)), ("K4", None)]
    dim = spark.createDataFrame([(k, "A", "Debit", d, True) for k, d in rows],
                                "card_id string, account_hub_key string, card_type string, "
                                "expiration_date date, is_current boolean")
    out = {r.bucket_days: (r.bucket_label, r.cards_expiring_count)
           for r in reports.card_expiry_buckets(dim, RunParams(as_of=as_of)).collect()}
    assert out == {30: ("<= 30 days", 2), 60: ("<= 60 days", 3), 90: ("<= 90 days", 3)}
    empty = reports.card_expiry_buckets(dim.limit(0), RunParams(as_of=as_of)).collect()
    assert [r.cards_expiring_count for r in empty] == [0, 0, 0]


def _dim_customer(spark, rows):
    return spark.createDataFrame(rows, "customer_hub_key string, customer_id string, first_name string, "
                                       "last_name string, city string, credit_tier string, is_current boolean")


def _fab(spark, rows):
    return spark.createDataFrame([(c, D(b)) for c, b in rows], "customer_hub_key string, balance_usd decimal(14,2)")


def test_customer_kpis_without_customers(spark):
    dim = _dim_customer(spark, [])
    fab = _fab(spark, [])
    loans = spark.createDataFrame([(D("5.00"),)], "loan_amount decimal(14,2)")
    tx = spark.createDataFrame([(D("7.00"),)], "amount_usd decimal(14,2)")
    r = reports.customer_kpis(dim, fab, loans, tx, DRIVER_RUN).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.total_customers, r.total_accounts, r.total_deposits_usd, r.pct_customers_with_multiple_accounts) \
        == (0, 0, 0.0, 0.0)
    assert r.total_loan_book_usd is None and r.total_transaction_volume_usd is None


def test_balance_summary_ranks_customer_without_account_last(spark):
    dim = _dim_customer(spark, [("h1", "C1", "a", "b", "x", "prime", True),
                                ("h2", "C2", "a", "b", "x", "prime", True),
                                ("h3", "C3", "a", "b", "x", "prime", True)])
    fab = _fab(spark, [("h2", "5.00"), ("h2", "1.00"), ("h3", "6.00")])
    out = {r.customer_id: (r.account_count, r.total_balance_usd, r.balance_rank)
           for r in reports.customer_balance_summary(dim, fab).collect()}
    assert out == {"C2": (2, 6.0, 1), "C3": (1, 6.0, 2), "C1": (0, 0.0, 3)}


def test_median_even_count(spark):
    fab = _fab(spark, [("h1", "1.00"), ("h2", "2.00")])
    r = reports.customer_balance_kpis(fab, DRIVER_RUN).first()
    assert r.median_balance_usd == 1.5 and r.customers_with_balance_rows == 2 and r.avg_balance_usd == 1.5


def test_distributed_rank_and_percentile_match_single_task(spark):
    rng = np.random.default_rng(7)
    # a hot value holding a third of the rows, to exercise splitting equal keys
    vals = np.concatenate([np.zeros(1000), rng.integers(-500, 500, 2000)]).astype(float)
    df = spark.createDataFrame([(float(v), f"k{i:05d}") for i, v in enumerate(vals)], "v double, k string")
    ranked = global_rank(df, [F.col("v").desc(), F.col("k")], out="r", num_partitions=7)
    from pyspark.sql import Window
    want = df.withColumn("w", F.rank().over(Window.orderBy(F.col("v").desc(), F.col("k"))))
    diff = ranked.join(want, ["v", "k"]).filter("r != w").count()
    assert diff == 0 and ranked.count() == len(vals)
    for q in [0.25, 0.5, 0.75, 0.9]:
        got = exact_percentile(df, F.col("v"), q, [F.col("k")], out="p", num_partitions=5).first().p
        assert abs(got - np.quantile(vals, q)) < 1e-9


def test_valid_only_and_latest_only_options(spark):
    e = ENTITIES["transaction"]
    rows = [("T1", "A1", "M1", D("5.00"), dt.datetime(2020, 1, 1)),
            ("T2", "A1", "M1", D("-1.00"), dt.datetime(2020, 1, 1))]
    stored = None
    links = {}
    for amt, p in [("5.00", T1), ("6.00", T2)]:
        df = spark.createDataFrame([(r[0], r[1], r[2], D(amt) if r[0] == "T1" else r[3], r[4]) for r in rows],
                                   SOURCE_SCHEMAS["transactions"])
        b = bronze(df, "transactions", p)
        new = load_sat(b, e, p, stored)
        stored = new if stored is None else stored.unionByName(new)
        for n in ["account_transaction", "merchant_transaction"]:
            links[n] = links.get(n) or load_link(b, LINKS[n], p)
    lca = spark.createDataFrame([], "hk_account string, hk_customer string")
    acc = spark.createDataFrame([("A1", "C1", "Checking", D("1.00"), dt.date(2019, 1, 1))],
                                SOURCE_SCHEMAS["accounts"])
    lca = load_link(bronze(acc, "accounts", T1), LINKS["customer_account"], T1)
    all_versions = gold.fact_transactions(stored, links["account_transaction"],
                                          links["merchant_transaction"], lca)
    latest = gold.fact_transactions(stored, links["account_transaction"],
                                    links["merchant_transaction"], lca, latest_only=True)
    assert all_versions.count() == 3 and latest.count() == 2
    assert sorted(str(r.amount_usd) for r in latest.collect()) == ["-1.00", "6.00"]
    hub = load_hub(bronze(spark.createDataFrame(rows, SOURCE_SCHEMAS["transactions"]), "transactions", T1), e, T1)
    v = gold.versioned(stored, hub, "transaction", ["amount_usd"], valid_only=True)
    assert v.count() == 2     # T2 (negative amount) dropped


def test_salted_join_equals_plain_join_with_a_hot_key(spark):
    from ledgerlake.operators.skew import hot_keys, salted_join
    big = spark.createDataFrame([(f"t{i}", "hot" if i % 3 else f"k{i}", i) for i in range(3000)] +
                                [("tn", None, 0)], "t string, k string, v int")
    small = spark.createDataFrame([("hot", "c1"), ("hot", "c2")] +
                                  [(f"k{i}", f"c{i}") for i in range(0, 3000, 3)], "k string, c string")
    assert [r.k for r in hot_keys(big, "k", 0.03).collect()] == ["hot"]
    for how in ["inner", "left"]:
        want = big.join(small, "k", how)
        got = salted_join(big, small, "k", share=0.03, salts=8, how=how)
        assert got.count() == want.count()
        assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_distributed_rank_with_ties(spark):
    from pyspark.sql import Window
    rows = [(None if v is None else float(v), f"k{i}") for i, v in enumerate([3, 1, 3, None, 2, 3, 1, None, 5])]
    df = spark.createDataFrame(rows, "v double, k string")
    got = global_rank(df, [F.col("v").desc_nulls_last()], out="r", unique=False,
                      tiebreak=[F.col("k")], keys=["v"], num_partitions=3)
    want = df.withColumn("w", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert got.count() == len(rows)
    assert got.join(want, "k").filter("r != w").count() == 0


def test_point_in_time_join_boundaries(spark):
    dim = spark.createDataFrame(
        [("h1", "v1", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)),
         ("h1", "v2", dt.datetime(2024, 2, 1), dt.datetime(9999, 12, 31))],
        "account_hub_key string, account_key string, effective_start_date timestamp_ntz, "
        "effective_end_date timestamp_ntz")
    fact = spark.createDataFrame(
        [("f0", "h1", dt.datetime(2023, 12, 31)),     # before the first load: no version
         ("f1", "h1", dt.datetime(2024, 1, 15)),
         ("f2", "h1", dt.datetime(2024, 2, 1)),       # boundary belongs to the newer version
         ("f3", "h1", dt.datetime(2030, 1, 1)),
         ("f4", "h2", dt.datetime(2024, 1, 15))],     # unknown key
        "f string, account_hub_key string, t timestamp_ntz")
    got = {r.f: r.account_key for r in
           gold.join_point_in_time(fact, dim, "account_hub_key", "t", ["account_key"]).collect()}
    assert got == {"f1": "v1", "f2": "v2", "f3": "v2"}
