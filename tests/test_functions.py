"""Expression semantics (keys, initcap, tiers, percentages, calendar keys)."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from ledgerlake.functions import credit_tier, date_key, hash_diff, hash_key, pg_initcap, tier_sort_order
from ledgerlake.operators.reports import pct
from ledgerlake.plans.oracle import initcap as sql_initcap


def test_initcap_postgres_semantics(spark):
    words = ["o'brien-smith mc.donald 3rd nation_7", "  MIXED case  ", "", None, "élan vital", "a1b c-d"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "x string")
           .select(pg_initcap("x")).collect()]
    assert got[0] == "O'Brien-Smith Mc.Donald 3rd Nation_7"
    assert got[1] == "  Mixed Case  "
    assert got[2] == ""
    assert got[3] is None
    assert got[4] == "Élan Vital"
    con = duckdb.connect()
    for w, g in zip(words, got):
        want = con.execute(f"SELECT {sql_initcap('?')}", [w]).fetchone()[0]
        assert g == want, (w, g, want)


def test_hash_key_normalises_and_keeps_null(spark):
    rows = spark.createDataFrame([(" c1 ",), ("C1",), (None,)], "k string").select(hash_key("k")).collect()
    assert rows[0][0] == rows[1][0] and len(rows[0][0]) == 32
    assert rows[2][0] is None


def test_hash_diff_skips_null_and_has_no_delimiter(spark):
    df = spark.createDataFrame([("ab", "c", None), ("a", "bc", None)], "a string, b string, c string")
    h = [r[0] for r in df.select(hash_diff("a", "b", "c")).collect()]
    assert h[0] == h[1] is not None
    allnull = spark.createDataFrame([(None,)], "a string").select(hash_diff("a")).first()[0]
    assert allnull == "d41d8cd98f00b204e9800998ecf8427e"  # md5('')


def test_credit_tier_bounds(spark):
    scores = [579, 580, 669, 670, 739, 740, 799, 800, None]
    want = ["deep_subprime", "subprime", "subprime", "near_prime", "near_prime", "prime", "prime",
            "super_prime", None]
    df = spark.createDataFrame([(s,) for s in scores], "s int")
    got = df.select(credit_tier("s").alias("t")).select("t", tier_sort_order("t")).collect()
    assert [r[0] for r in got] == want
    assert [r[1] for r in got] == [1, 2, 2, 3, 3, 4, 4, 5, 99]


def test_pct_rounds_half_up_exactly(spark):
    cases = [(1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (1, 200000, 0.0), (1, 0, None), (0, 5, 0.0),
             (12345, 100000, 12.35), (5, 7, 71.43)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a long, b long")
    got = [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()]
    assert got == [c[2] for c in cases]


def test_date_key(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.datetime(2016, 2, 29, 13, 0),)], "d date")
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20210101, 20160229]
