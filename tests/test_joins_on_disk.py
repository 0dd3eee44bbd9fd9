"""Joins over facts and stored loads that move their rows once; hot keys stay split."""

import datetime as dt
import os
import random
import re
import time
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.keys import packed, unpacked_keys
from ledgerlake.operators import checks as chk
from ledgerlake.operators import gold
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.skew import dealt, hot_keys
from ledgerlake.operators.vault import current_hashes, load_hub, load_link, load_sat
from ledgerlake.params import DRIVER_RUN, RunParams
from ledgerlake.plans import incremental, registry
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.plans.layers import Lakehouse
from ledgerlake.plans.loading import load_jobs
from ledgerlake.plans.upkeep import keep_dimension
from ledgerlake.session import staged
from ledgerlake.sources import sinks
from ledgerlake.sources.schemas import SOURCE_SCHEMAS
from ledgerlake.sources.sinks import TableStore
from tests.conftest import SF_SMALL

T0, END = dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", ["join_point_in_time", "join_point_in_time_salted"])
def test_point_in_time_moves_each_fact_row_twice(spark, static_plans, name):
    """Before, the salted join had 21 exchanges; the stream was moved twice after the fact's and kept as a checkpoint."""
    plan = static_plans(registry.spark_query(name)(spark, SF_SMALL))
    assert "ExistingRDD" not in plan and "Exchange rangepartitioning" not in plan
    # transactions, their lookup by account, accounts of the lookup (2), two batches, versions, hot slots and keys
    assert len(re.findall(r"(?<!, )Exchange hashpartitioning", plan)) == 9


def test_hot_key_of_a_dealt_fact_is_split_and_swept(spark):
    r = random.Random(3)
    versions = [("hot", at(k), at(k + 1), str(k)) for k in range(300)]
    for k in range(40):
        starts = sorted(r.sample(range(500), 4))
        versions += [(f"c{k}", at(s), END if n == 3 else at(starts[n + 1]), f"{k}.{n}") for n, s in enumerate(starts)]
        versions.append((f"c{k}", at(starts[1]), at(starts[1]), "never"))
    events = [(i, "hot", at(r.randrange(320))) for i in range(1000)]
    events += [(1000 + i, r.choice([None, "none", *(f"c{k}" for k in range(40))]), r.choice([None, at(r.randrange(520))]))
               for i in range(2000)]
    dim = spark.createDataFrame(versions, "k string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, a string")
    fact = spark.createDataFrame(events, "id long, k string, t timestamp_ntz")
    dim, fact = (df.withColumn("k", packed("k")) for df in (dim, fact))
    hot = hot_keys(fact, "k", 0.2)
    assert hot.count() == 1
    lying = dealt(fact, "k", hot)
    sizes = [x["count"] for x in lying.join(hot, "k", "left_semi").groupBy("_salt").count().collect()]
    assert len(sizes) > 16 and max(sizes) < 100
    want = sorted((i, a) for i, k, t in events if k and t for key, s, e, a in versions if key == k and s <= t < e)
    for share in (None, 0.2):
        got = gold.join_point_in_time(lying, dim, "k", "t", ["a"], hot_share=share, dealt_by=hot)
        assert got.columns == ["k", "id", "t", "effective_start_date", "effective_end_date", "a"]
        assert sorted((x.id, x.a) for x in got.collect()) == want
    assert {x.k for x in got.select("k").distinct().collect()} <= {"hot", *(f"c{k}" for k in range(40))}


def account_rows(spark, rows):
    return spark.createDataFrame([(a, c, t, None if b is None else D(b), d) for a, c, t, b, d in rows], SOURCE_SCHEMAS["accounts"])


def test_packed_account_history_is_the_history(spark, monkeypatch):
    """Keys that normalise alike, several versions and owners in one batch, a change back, late and NULL keys."""
    day, r = dt.date(2019, 5, 1), random.Random(4)
    batches = []
    for _ in range(3):
        rows = [(r.choice(["A1", " a1 ", "A2", "a3", "", None, f"A{r.randrange(9)}"]), r.choice(["C1", "C2", None]),
                 r.choice(["Savings", " Savings", None, "Business"]), r.choice(["1.00", "2.00", None]), r.choice([day, None]))
                for _ in range(14)]
        batches.append(rows + rows[:3])
    monkeypatch.setattr(incremental, "account_batches", lambda *_: [account_rows(spark, b) for b in batches])
    lake = Lakehouse(spark, {}, DRIVER_RUN, "unused")
    loads = (dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1))
    want = incremental.account_history(lake, loads).dim.where("account_hub_key is not null")
    got = unpacked_keys(incremental.packed_account_history(lake, loads))
    assert want.count() > 20 and rows_of(got) == rows_of(want)


def test_batches_of_the_history_are_shuffled_once(spark, static_plans):
    lake = Lakehouse.from_driver(spark, SF_SMALL)
    plan = static_plans(incremental.packed_account_history(lake, (dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1))))
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_cross_entity_rows_of_packed_versions(spark, static_plans):
    """Before, the transactions' check had 7 exchanges: each dedupe, latest version and join its own, keys as text."""
    day = dt.datetime(2019, 1, 1)
    tx = [("T1", "A1", "M1", D("5.00"), day), (" t1", "A1", "M1", D("6.00"), dt.datetime(2022, 1, 1)), ("T2", "A1", "M2", None, day),
          ("T2", "A2", None, D("7.00"), None), (None, "A1", "M1", D("5.00"), day), ("T3", None, "M1", D("1.00"), day),
          ("T4", "A2", "M1", D("1.00"), day), ("T4", "A2", "M1", D("1.00"), day), ("T5", "A9", "M1", D("1.00"), day), ("T6", "", "M1", D("1.00"), day)]
    acc = [("A1", "C1", "Savings", "1.00", dt.date(2020, 1, 1)), ("a1 ", "C1", "Savings", "2.00", dt.date(2021, 1, 1)),
           ("A2", "C2", None, None, dt.date(2020, 1, 1)), ("A2", None, None, None, dt.date(2020, 1, 1)), (None, "C1", None, None, dt.date(2022, 1, 1)),
           ("", "C1", "Savings", "1.00", dt.date(2022, 1, 1)), ("A7", "C2", "Savings", "1.00", None)]
    cust = [(c, "a", "b", "e@x.y", "z", 500, t) for c, t in (("C1", dt.datetime(2020, 6, 1)), ("C1", dt.datetime(2021, 6, 1)),
                                                            ("c2", dt.datetime(2023, 1, 1)), (None, dt.datetime(2025, 1, 1)))]
    sources = {"transactions": spark.createDataFrame(tx, SOURCE_SCHEMAS["transactions"]), "accounts": account_rows(spark, acc),
               "customers": spark.createDataFrame(cust, SOURCE_SCHEMAS["customers"])}
    lake = Lakehouse(spark, sources, DRIVER_RUN)
    for name, least in (("transaction_before_account_opened", 3), ("account_opened_before_customer", 1)):
        check, inputs = chk.CROSS_ENTITY[name]
        want = check(*[lake.table(t) for t in inputs])
        got = unpacked_keys(check(*lake.packed_versions(inputs[0][4:], inputs[2][4:])))
        assert want.count() >= least and rows_of(got) == rows_of(want) and got.dtypes == want.dtypes
    plan = static_plans(registry.spark_query("check_transaction_before_account_opened")(spark, SF_SMALL))
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert len(re.findall(r"(?<!, )Exchange hashpartitioning", plan)) == 3


def test_narrow_loads_store_the_same_rows(spark):
    """Keys that normalise alike, repeated and NULL keys, a stored history with changes: as loaded by text keys."""
    day, r = dt.date(2019, 5, 1), random.Random(5)

    def batch():
        rows = [(r.choice(["A1", " a1 ", "A2", "", None, f"A{r.randrange(9)}"]), r.choice(["A1", "C1", "C2", None]),
                 r.choice(["Savings", None, "Business"]), r.choice(["1.00", "2.00", None]), r.choice([day, None])) for _ in range(20)]
        return account_rows(spark, rows + rows[:4] + [(None, None, None, None, None)] * 2)
    e, l = ENTITIES["account"], LINKS["customer_account"]
    hub = link = sat = snap = None
    for month in (1, 2, 3):
        run = DRIVER_RUN.with_load_ts(dt.datetime(2020, month, 1))
        b = bronze(batch(), e.source, run)
        new = [load_hub(b, e, run, hub), load_link(b, l, run, link), load_sat(b, e, run, sat)]
        assert rows_of(load_hub(b, e, run, hub, narrow=True)) == rows_of(new[0])
        assert rows_of(load_sat(b, e, run, sat, narrow=True)) == rows_of(new[2])
        assert rows_of(current_hashes(snap, new[2], e.hk, narrow=True)) == rows_of(current_hashes(snap, new[2], e.hk))
        if link is not None:
            keys = {x[0] for x in link.select(l.hk).collect()}
            assert all(x[0] not in keys for x in new[1].select(l.hk).collect())
        snap = current_hashes(snap, new[2], e.hk).localCheckpoint()
        hub, link, sat = [(n if o is None else o.unionByName(n)).localCheckpoint() for o, n in zip((hub, link, sat), new)]
    assert sat.where("hk_account is null").count() > 3 and link.count() == link.select(l.hk).distinct().count()


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for top in manager.localDirs() for _, _, names in os.walk(top.getPath())
            for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_writes_leave_no_shuffle_files(spark, scratch):
    """Before, they stayed until the driver collected its garbage: those of all jobs of a query at once."""
    before = shuffle_files(spark)
    rows = spark.range(2000).select((F.col("id") % 50).alias("k"), F.col("id").cast("string").alias("x_key"))
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    store, run = TableStore(spark, scratch), RunParams(load_ts=dt.datetime(2024, 1, 1))
    for _, job in load_jobs(store, {"accounts": bronze(account_rows(spark, [(f"A{k}", "C1", "Savings", "1.00", None) for k in range(40)]),
                                                       "accounts", run)}, run):
        job()
    dim = keep_dimension(store, "dim_account", "account_hub_key", ("sat_account", "hub_account", "link_customer_account"),
                         "hk_account", gold.dim_account, 4)
    table = staged(rows.groupBy("k").agg(F.count("*").alias("n")), "t")
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:         # removed in the background
        time.sleep(0.1)
    assert not left
    assert dim.count() == 40 and table.count() == 50
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == kept


def test_parts_are_not_shuffled_for_the_write_and_old_buckets_are_rebuilt(spark, scratch):
    store, inputs = TableStore(spark, scratch), ("sat_account", "hub_account", "link_customer_account")

    def load(day, rows):
        run = RunParams(load_ts=dt.datetime(2024, 1, day))
        for _, job in load_jobs(store, {"accounts": bronze(account_rows(spark, rows), "accounts", run)}, run):
            job()
        return keep_dimension(store, "dim_account", "account_hub_key", inputs, "hk_account", gold.dim_account, 4)
    base = [(f"A{k}", f"C{k % 3}", "Savings", "1.00", None) for k in range(60)]
    load(1, base)
    path = store.table_path("dim_account")
    # a version whose buckets were found in another way is not added to
    told = sinks.published_parts(spark, path)
    sinks.switch(spark, path, next(iter(told["parts"].values())), {k: v for k, v in told.items() if k != "by"})
    dim = load(2, [("A5", "C2", "Business", "1.00", None)])
    assert dim.count() == 61 and dim.where("is_current").count() == 60
    assert rows_of(dim) == rows_of(gold.dim_account(*[store.stored("silver", t) for t in inputs]))
    for part, version in sinks.published_parts(spark, path)["parts"].items():
        rows = spark.read.parquet(sinks.part_path(path, part, version))
        assert {x.b for x in rows.select(sinks.bucket_of(rows, "account_hub_key", 4).alias("b")).distinct().collect()} == {int(part)}


def test_dimensions_and_facts_read_their_source_once(spark, static_plans):
    """Before, satellite, hub and link each read and shuffled it, the hub's keys as text."""
    lake = Lakehouse.from_driver(spark, SF_SMALL)
    for df in (lake.dim_account, lake.dim_card, lake.fact_loans, lake.fact_account_balance):
        plan = static_plans(df)
        assert len(re.findall(r"FileScan parquet", plan)) == 1
        assert len(re.findall(r"(?<!, )Exchange hashpartitioning", plan)) == 1


def test_dimensions_and_facts_of_odd_rows(spark):
    """Keys that normalise alike, several versions, owners and NULLs: as built from the stored tables' loads."""
    day, r = dt.date(2019, 5, 1), random.Random(6)

    def some(*values):
        return r.choice([*values, None])
    when = dt.datetime(2020, 1, 1)
    accounts = [(some("A1", " a1", "A2", ""), some("C1", "C2"), some("Savings", "x"), some("1.00", "2.00"), some(day)) for _ in range(25)]
    cards = [(some("D1", "d1 ", "D2"), some("A1", "A2"), some("Credit", " Debit"), some(day)) for _ in range(25)]
    loans = [(some("L1", "L2", " l2"), some("C1", "C2"), some(D("1.00"), D("2.00")), some(D("1.50")), some(day)) for _ in range(25)]
    people = [(some("C1", "c1", "C2"), some("o'neil"), some("b"), some("E@x.y"), some("z"), some(300), some(when)) for _ in range(25)]
    shops = [(some("M1", "m1", "M2"), some("shop", ""), some("z")) for _ in range(25)]
    offices = [(some("B1", "b1", "B2"), some("n"), some("m"), some("z"), some("X")) for _ in range(25)]
    sources = {"accounts": account_rows(spark, accounts)}
    for name, rows in (("cards", cards), ("loans", loans), ("customers", people), ("merchants", shops), ("branches", offices)):
        sources[name] = spark.createDataFrame(rows, SOURCE_SCHEMAS[name])
    lake = Lakehouse(spark, sources, DRIVER_RUN)
    for got, build, names in (
            (lake.dim_account, gold.dim_account, ("sat_account", "hub_account", "link_customer_account")),
            (lake.dim_card, gold.dim_card, ("sat_card", "hub_card", "link_account_card")),
            (lake.dim_customer, gold.dim_customer, ("sat_customer", "hub_customer")),
            (lake.dim_merchant, gold.dim_merchant, ("sat_merchant", "hub_merchant")),
            (lake.dim_branch, gold.dim_branch, ("sat_branch", "hub_branch")),
            (lake.fact_loans, gold.fact_loans, ("sat_loan", "link_customer_loan")),
            (lake.fact_account_balance, gold.fact_account_balance, ("sat_account", "link_customer_account"))):
        want = build(*[lake.table(n) for n in names])
        assert want.count() > 2 and rows_of(got) == rows_of(want) and got.dtypes == want.dtypes
