"""Point-in-time join as a sorted stream, quantiles from (value, count) pairs, quarantine behind its filter."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.profile import describe
from ledgerlake.operators.ranking import approximate_quantiles, value_quantiles
from ledgerlake.operators.reports import customer_balance_kpis
from ledgerlake.operators.vault import load_hub, load_sat, quarantine, quarantine_of_batch
from ledgerlake.params import DRIVER_RUN
from ledgerlake.plans.entities import ENTITIES
from ledgerlake.plans.layers import Lakehouse
from ledgerlake.sources.driver_tables import banking_sources

from conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
END = dt.datetime(9999, 12, 31)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def pit(spark, versions, events, **k):
    dim = spark.createDataFrame(versions, "k string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, a string")
    fact = spark.createDataFrame(events, "id long, k string, t timestamp_ntz")
    return gold.join_point_in_time(fact, dim, "k", "t", ["a"], **k)


def brute(versions, events):
    by = {}
    for k, s, e, a in versions:
        by.setdefault(k, []).append((s, e, a))
    return sorted((i, a) for i, k, t in events if k is not None and t is not None
                  for s, e, a in by.get(k, []) if s <= t < e)


def test_sweep_equals_the_join_by_time(spark):
    r = random.Random(1)
    versions, events = [], []
    for k in range(40):
        starts = sorted(r.sample(range(500), r.randrange(1, 8)))
        for n, s in enumerate(starts):
            # gaps, versions without length, several of one start
            end = at(starts[n + 1]) if n + 1 < len(starts) else (END if r.random() < 0.8 else at(s + 20))
            if r.random() < 0.1:
                versions.append((f"k{k}", at(s), at(s), "never"))
            versions.append((f"k{k}", at(s), at(s + 1) if r.random() < 0.1 else end, f"{k}.{n}"))
    versions.append((None, at(0), END, "null key"))
    for i in range(900):
        events.append((i, r.choice([None, "none", *(f"k{k}" for k in range(40))]), r.choice([None, at(r.randrange(520))])))
    events += [(900 + i, "k0", at(7)) for i in range(50)]
    want = brute(versions, events)
    assert sorted((x.id, x.a) for x in pit(spark, versions, events).collect()) == want
    assert sorted((x.id, x.a) for x in pit(spark, versions, events, hot_share=0.01).collect()) == want
    assert pit(spark, [], events).count() == 0 and pit(spark, versions, []).count() == 0


def test_hot_key_with_many_versions_is_split(spark, monkeypatch):
    """10,000 versions and a third of the events on one key, spread over the partitions."""
    versions = [("hot", at(k), at(k + 1), str(k)) for k in range(10_000)] + [(f"c{k}", at(0), END, "c") for k in range(2000)]
    events = [(k, "hot", at(k * 5 % 10_000)) for k in range(3000)] + [(3000 + k, f"c{k % 2000}", at(k)) for k in range(6000)]
    frame = type(spark.range(0))
    kept, real = [], frame.checkpoint

    def checkpoint(self, *a, **k):
        kept.append(real(self, *a, **k))
        return kept[-1]

    monkeypatch.setattr(frame, "checkpoint", checkpoint)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # small data: keep the partitions apart
    try:
        out = pit(spark, versions, events)
        assert sorted((x.id, x.a) for x in out.collect()) == brute(versions, events)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in kept[0].where("_key = 'hot'").groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.4 * sum(sizes)


def test_quantiles_equal_numpy(spark, monkeypatch):
    r = random.Random(2)
    rows = [(r.choice([None, 1.5, 2.5, float(r.randrange(40))]), r.gauss(0, 5), None) for _ in range(3000)]
    df = spark.createDataFrame(rows, "few double, many double, none double").repartition(6)
    frame = type(spark.range(0))
    kept, real = [], frame.checkpoint

    def checkpoint(self, *a, **k):
        kept.append(real(self, *a, **k))
        return kept[-1]

    monkeypatch.setattr(frame, "checkpoint", checkpoint)
    fractions = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p999": 0.999, "p100": 1.0}
    columns = {c: F.col(c) for c in df.columns}
    got = {x.label: x for x in value_quantiles(df, columns, fractions).collect()}
    assert set(got) == {"few", "many"}
    for i, label in enumerate(("few", "many")):
        values = [x[i] for x in rows if x[i] is not None]
        for name, f in fractions.items():
            assert got[label][name] == pytest.approx(np.quantile(values, f), abs=1e-12)
    # one kept table of distinct values for all columns, no rows
    assert len(kept) == 1
    assert kept[0].where("label = 'few'").count() == len({x[0] for x in rows if x[0] is not None})


def test_quantile_plan_shuffles_values_once_per_table(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    plan = describe(df, {"a": F.col("a"), "b": F.col("b")})._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan.split("LogicalRDD")[0] or plan.count("LogicalRDD") >= 1
    got = {x.field: x for x in describe(df, {"a": F.col("a"), "b": F.col("b")}).collect()}
    assert got["b"].p25 == 24.75 and got["b"]["count"] == 100 and got["a"].max == 6
    empty = describe(df.limit(0), {"a": F.col("a")}).first()
    assert empty["count"] == 0 and empty.p50 is None and empty["mean"] is None


def test_approximate_quantiles_keep_their_rank(spark):
    r = random.Random(4)
    values = sorted(r.lognormvariate(0, 2) for _ in range(20_000))
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    for accuracy in (100, 1000):
        got = approximate_quantiles(df, {"v": F.col("v")}, {"p50": 0.5, "p90": 0.9}, accuracy).first()
        for name, f in (("p50", 0.5), ("p90", 0.9)):
            assert abs(np.searchsorted(values, got[name]) / len(values) - f) <= 1 / accuracy + 1e-4


def test_median_of_report_exact_and_approximate(spark):
    lh = Lakehouse.from_driver(spark, SF_SMALL)
    exact = customer_balance_kpis(lh.fact_account_balance, DRIVER_RUN).first()
    near = customer_balance_kpis(lh.fact_account_balance, DRIVER_RUN, accuracy=1000).first()
    assert near.total_balance_usd == exact.total_balance_usd
    assert near.median_balance_usd == pytest.approx(exact.median_balance_usd, rel=0.05)
    none = customer_balance_kpis(lh.fact_account_balance.limit(0), DRIVER_RUN).first()
    assert none.customers_with_balance_rows == 0 and none.median_balance_usd == 0.0


def test_quarantine_from_bronze_equals_quarantine_of_all(spark):
    src = banking_sources(spark, SF_SMALL)
    tables = {s: bronze(df, s, DRIVER_RUN) for s, df in src.items()}
    want = quarantine({n: load_sat(tables[e.source], e, DRIVER_RUN) for n, e in ENTITIES.items()},
                      {n: load_hub(tables[e.source], e, DRIVER_RUN) for n, e in ENTITIES.items()})
    got = quarantine_of_batch(tables, DRIVER_RUN)
    assert got.columns == want.columns and want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_quarantine_filters_below_its_dedupe(spark):
    """No transaction is rejected here, so no transaction row may reach a shuffle."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = Lakehouse.from_driver(spark, SF_SMALL).quarantine._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("LeftSemi") >= 2 * len(ENTITIES)        # each dedupe reads semi-joined rows
