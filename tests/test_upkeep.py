"""Dimensions kept up by touched keys: equal to the full rebuild, and only the buckets of these keys are rewritten."""

import datetime as dt
import os
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.operators.bronze import bronze
from ledgerlake.params import RunParams
from ledgerlake.plans.loading import load_jobs
from ledgerlake.plans.upkeep import keep_dimension
from ledgerlake.sources import files, sinks
from ledgerlake.sources.schemas import SOURCE_SCHEMAS
from ledgerlake.sources.sinks import TableStore

INPUTS = ("sat_account", "hub_account", "link_customer_account")
BUCKETS = 8


def accounts(spark, rows):
    rows = [(f"A{k}", c, t, D("1.00"), dt.date(2020, 1, 1)) for k, c, t in rows]
    return spark.createDataFrame(rows, SOURCE_SCHEMAS["accounts"])


def load(store, df, day, only=None):
    run = RunParams(load_ts=dt.datetime(2024, 1, day))
    for name, job in load_jobs(store, {"accounts": bronze(df, "accounts", run)}, run):
        if only is None or name in only:
            job()
    return run


def keep(store):
    return keep_dimension(store, "dim_account", "account_hub_key", INPUTS, "hk_account", gold.dim_account, BUCKETS)


def rebuilt(store):
    return gold.dim_account(*[store.stored("silver", t) for t in INPUTS])


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.columns == b.columns


def parts(store):
    return sinks.published_parts(store.spark, store.table_path("dim_account"))["parts"]


def test_upkeep_equals_rebuild_over_three_batches_and_rewrites_few_rows(spark, scratch):
    store = TableStore(spark, scratch)
    base = [(k, f"C{k % 7}", "Savings") for k in range(400)]
    load(store, accounts(spark, base), 1)
    assert same(keep(store), rebuilt(store)) and len(parts(store)) == BUCKETS
    first = parts(store)
    # one account changes, then changes back; one more gets a second owner
    load(store, accounts(spark, [(3, "C3", "Checking"), *base[4:6]]), 2)
    assert same(keep(store), rebuilt(store))
    second = parts(store)
    changed = [b for b in second if second[b] != first[b]]
    assert len(changed) == 1
    written = spark.read.parquet(sinks.part_path(store.table_path("dim_account"), changed[0], second[changed[0]]))
    whole = keep(store)
    assert written.count() < whole.count() / 3
    load(store, accounts(spark, [(3, "C3", "Savings"), (4, "C9", "Savings")]), 3)
    dim = keep(store)
    assert same(dim, rebuilt(store)) and dim.where("account_id = 'A3'").count() == 3
    assert dim.where("account_id = 'A4'").count() == 2
    assert sum(parts(store)[b] != second[b] for b in second) <= 2
    # nothing new: nothing written
    before = parts(store)
    assert same(keep(store), rebuilt(store)) and parts(store) == before
    left = [n for n in os.listdir(store.table_path("dim_account")) if n.startswith("version=")]
    assert len(left) <= 3                                    # what no published version reads is gone


def test_batch_of_a_run_that_died_before_the_dimension_is_caught_up(spark, scratch):
    store = TableStore(spark, scratch)
    load(store, accounts(spark, [(k, "C1", "Savings") for k in range(50)]), 1)
    keep(store)
    load(store, accounts(spark, [(7, "C1", "Checking")]), 2)                   # stored, but the dimension was not kept
    load(store, accounts(spark, [(8, "C1", "Business"), (60, "C2", "Savings")]), 3)
    dim = keep(store)
    assert same(dim, rebuilt(store))
    assert dim.where("account_id = 'A7'").count() == 2 and dim.where("account_id = 'A60'").count() == 1


def test_unfinished_batches_and_new_bucket_numbers(spark, scratch):
    store = TableStore(spark, scratch)
    load(store, accounts(spark, [(k, "C1", "Savings") for k in range(20)]), 1)
    keep(store)
    run = load(store, accounts(spark, [(1, "C1", "Business")]), 2)
    for t in INPUTS:
        files.delete(spark, f"{store.table_path(t)}/_finished/_{sinks.batch_tag(run)}")
    before = parts(store)
    assert keep(store).count() == 20 and parts(store) == before
    again = keep_dimension(store, "dim_account", "account_hub_key", INPUTS, "hk_account", gold.dim_account, 3)
    assert again.count() == 20 and set(parts(store)) <= {"0", "1", "2"}


def test_merchants_without_a_link(spark, scratch):
    store = TableStore(spark, scratch)
    for day, name in ((1, "one"), (2, "two")):
        run = RunParams(load_ts=dt.datetime(2024, 1, day))
        df = spark.createDataFrame([(f"M{k}", name if k == 2 else "m", "x") for k in range(9)], SOURCE_SCHEMAS["merchants"])
        for _, job in load_jobs(store, {"merchants": bronze(df, "merchants", run)}, run):
            job()
        dim = keep_dimension(store, "dim_merchant", "merchant_hub_key", ("sat_merchant", "hub_merchant"), "hk_merchant",
                             gold.dim_merchant, 4)
    assert dim.count() == 10 and dim.where(F.col("is_current")).count() == 9


def test_pipeline_keeps_dimensions_by_touched_keys(spark, scratch):
    import pytest

    from ledgerlake.params import DRIVER_RUN, SECOND_LOAD_TS
    from ledgerlake.plans.pipeline import run_pipeline
    from ledgerlake.sources.driver_tables import account_batches, banking_sources

    from conftest import SF_SMALL

    src = dict(banking_sources(spark, SF_SMALL).items())
    b1, b2 = account_batches(spark, SF_SMALL)
    run_pipeline(spark, {**src, "accounts": b1}, scratch, DRIVER_RUN, run_checks=False, dim_buckets=4)
    run_pipeline(spark, {**src, "accounts": b2}, scratch, RunParams(load_ts=SECOND_LOAD_TS), run_checks=False, dim_buckets=4)
    store = TableStore(spark, scratch)
    assert same(store.published("gold", "dim_account"), rebuilt(store))
    merchants = sinks.published_parts(spark, store.table_path("dim_merchant"))
    assert len(set(merchants["parts"].values())) == 1        # no merchant changed: the first run's files
    assert same(store.published("gold", "dim_merchant"),
                gold.dim_merchant(store.stored("silver", "sat_merchant"), store.stored("silver", "hub_merchant")))
    with pytest.raises(ValueError, match="one location"):
        run_pipeline(spark, src, scratch, RunParams(), dim_buckets=4, database="d")
