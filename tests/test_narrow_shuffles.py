"""Rows that are shuffled once and narrow: packed keys, keyed loads, staged tables."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.keys import packed, unpacked
from ledgerlake.operators import checks as chk
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.gold import fact_transactions
from ledgerlake.operators.skew import hot_keys
from ledgerlake.operators.vault import first_rows, load_link, load_sat
from ledgerlake.params import DRIVER_RUN
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.plans.layers import Lakehouse
from ledgerlake.plans.registry import LakeTables
from ledgerlake.sources.schemas import SOURCE_SCHEMAS
from tests.conftest import SF_SMALL

DAY = dt.datetime(2020, 1, 2)
ROWS = [  # repeated, re-versioned and shared ids, ids that normalise alike, nulls on either side
    ("T1", "A1", "M1", Decimal("5.00"), DAY), ("T1", "A1", "M1", Decimal("5.00"), DAY),
    (" t1 ", "A1", "M1", Decimal("6.00"), DAY), ("T2", "A1", "M2", None, DAY), ("T2", "A2", None, Decimal("7.00"), None),
    (None, "A1", "M1", Decimal("5.00"), DAY), ("T3", None, "M1", Decimal("-1.00"), DAY), ("X", None, "M1", None, None),
    (None, "X", "M1", None, None), (None, None, None, None, None), ("", "", "", Decimal("1.00"), DAY)]


@pytest.fixture()
def transactions(spark):
    return bronze(spark.createDataFrame(ROWS, SOURCE_SCHEMAS["transactions"]), "transactions", DRIVER_RUN)


def test_packed_is_one_to_one(spark):
    digest = "0123456789abcdef" * 2
    keys = [digest, digest.upper(), digest[:-1] + "g", "0123456789abcdef", "", "é", "a" * 33, bytes.fromhex(digest)[:0].decode(), None]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed("k").alias("p"))
    got = rows.select("k", "p", unpacked("p").alias("back")).collect()
    assert all(r.back == r.k for r in got)
    assert {r.k: len(r.p) for r in got if r.k}[digest] == 16
    assert len({bytes(r.p) for r in got if r.p is not None}) == len({r.k for r in got if r.k is not None})


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", ["account_transaction", "merchant_transaction"])
def test_keyed_link_is_the_link_that_joins(spark, transactions, name):
    want = load_link(transactions, LINKS[name], DRIVER_RUN)
    got = load_link(transactions, LINKS[name], DRIVER_RUN, keyed=True)
    assert rows_of(got) == rows_of(want.where("hk_transaction is not null"))
    stored = want.where("hk_transaction is not null").limit(2).localCheckpoint()
    assert (rows_of(load_link(transactions, LINKS[name], DRIVER_RUN, stored, keyed=True))
            == rows_of(load_link(transactions, LINKS[name], DRIVER_RUN, stored).where("hk_transaction is not null")))


def test_keyed_sat_is_the_satellite_that_joins(spark, transactions):
    e = ENTITIES["transaction"]
    want = load_sat(transactions, e, DRIVER_RUN)
    assert rows_of(load_sat(transactions, e, DRIVER_RUN, keyed=True)) == rows_of(want.where("hk_transaction is not null"))


def test_fact_rows_are_shuffled_once_per_input_and_once_for_the_lookup(spark):
    """Before, each dedupe and each join had an exchange of its own (9), and the keys travelled as text."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lake = Lakehouse.from_driver(spark, SF_SMALL)
        plan = lake.fact_transactions._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 6
        want = fact_transactions(lake.sat("transaction"), lake.link("account_transaction"),
                                 lake.link("merchant_transaction"), lake.link("customer_account"))
        assert rows_of(lake.fact_transactions) == rows_of(want)
        assert rows_of(lake.transactions_fact(hot_share=0.001)) == rows_of(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checked_tables_are_stored_as_parquet(spark):
    """Before, they were checkpoints, whose rows are not compressed."""
    table = LakeTables(Lakehouse.from_driver(spark, SF_SMALL), materialize=True)["link_customer_account"]
    assert table.inputFiles() and all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_cross_entity_counts_of_keyed_tables(spark):
    lake = Lakehouse.from_driver(spark, SF_SMALL)
    names = {t for _, inputs in chk.CROSS_ENTITY.values() for t in inputs}
    now = lake.params.load_ts_col
    want = chk.run_checks([], {n: lake.table(n) for n in names}, now, list(chk.CROSS_ENTITY))
    got = chk.run_checks([], {n: lake.keyed_table(n) for n in names}, now, list(chk.CROSS_ENTITY))
    assert rows_of(got) == rows_of(want)


def test_hot_keys_from_counts(spark):
    rows = spark.createDataFrame([("a", 90), ("b", 5), ("c", 5)], "k string, n long")
    assert [r.k for r in hot_keys(rows, "k", 0.5, "n").collect()] == ["a"]


def test_hub_keys_of_any_text_survive_the_fact(spark):
    """Hub keys that are not digests go through the packed lookup unchanged."""
    sat = spark.createDataFrame([("t1", Decimal("1.00"), DAY, DAY, "s", "h")],
                                "hk_transaction string, amount_usd decimal(15,2), transaction_date timestamp_ntz, "
                                "load_dts timestamp_ntz, rec_src string, hash_diff string")
    lat = spark.createDataFrame([("t1", "a1")], "hk_transaction string, hk_account string")
    lmt = spark.createDataFrame([("t1", None)], "hk_transaction string, hk_merchant string")
    lca = spark.createDataFrame([("a1", "c1")], "hk_account string, hk_customer string")
    row = fact_transactions(sat, lat, lmt, lca).select(F.struct("*").alias("r")).first().r
    assert (row.transaction_hub_key, row.account_hub_key, row.merchant_hub_key, row.customer_hub_key) == ("t1", "a1", None, "c1")


def test_fact_reads_its_transactions_once(spark):
    """Before, satellite and links each read, hashed and shuffled the transactions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lake = Lakehouse.from_driver(spark, SF_SMALL)
        # a consumer's join on a link's key must not change what is shuffled for that link
        for df in (lake.fact_transactions, lake.table("fact_transactions").join(lake.dim_merchant, "merchant_hub_key"),
                   lake.fact_transactions.where("account_hub_key is not null").groupBy("account_hub_key").count()):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
            # joined keys are hashed once per row, not once more per use to drop NULLs
            assert not re.findall(r"Filter [^\n]*md5", plan.partition("FileScan parquet [l_orderkey")[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_fact_of_odd_rows(spark, transactions):
    """Versions, accounts and merchants of one transaction are all paired; rows without an account are dropped."""
    accounts = spark.createDataFrame([("A1", "C1"), ("A1", "C1"), (" a2", None), ("A2", "C2"), (None, "C3"), ("", "C4")],
                                     "account_id string, customer_id string")
    accounts = accounts.select(*[F.col(f.name) if f.name in accounts.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                 for f in SOURCE_SCHEMAS["accounts"]])
    sources = {"transactions": transactions.select(*SOURCE_SCHEMAS["transactions"].names), "accounts": accounts}
    lake = Lakehouse(spark, sources, DRIVER_RUN)
    want = fact_transactions(lake.sat("transaction"), lake.link("account_transaction"),
                             lake.link("merchant_transaction"), lake.link("customer_account"))
    assert len(rows_of(want)) > 8 and rows_of(lake.fact_transactions) == rows_of(want)
    assert rows_of(lake.transactions_fact(hot_share=0.001)) == rows_of(want)


def test_first_rows_keep_a_null_key(spark):
    rows = spark.createDataFrame([(1, None, 5), (1, None, 4), (1, "b", 3), (1, "b", 2), (2, "b", 1)], "t int, k string, v int")
    assert rows_of(first_rows(rows, "t", "k")) == rows_of(
        spark.createDataFrame([(1, None, 4), (1, "b", 2), (2, "b", 1)], rows.schema))
