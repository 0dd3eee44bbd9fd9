"""Lease, resumable runs, order of models, finished batches and published versions."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.params import DRIVER_RUN, RunParams
from ledgerlake.plans import pipeline
from ledgerlake.plans.pipeline import run_pipeline
from ledgerlake.plans.runs import (CheckFailure, LeaseLost, Manifest, RunActive, RunLease, Step, attempt,
                                   run_steps)
from ledgerlake.sources import files, sinks
from ledgerlake.sources.driver_tables import banking_sources
from ledgerlake.sources.sinks import TableStore, batch_tag

from conftest import SF_SMALL


# ---- order ---------------------------------------------------------------------

def test_steps_follow_their_inputs_and_failures_hold_back_only_dependants():
    order, lock = [], threading.Lock()

    def step(name, after=(), error=None):
        def run():
            with lock:
                order.append(name)
            if error:
                raise error
        return Step(name, after, run)

    out = run_steps([step("c", ("a", "b")), step("a"), step("b"), step("bad", ("a",), CheckFailure("x")),
                     step("below", ("bad", "c")), step("further", ("below",)), step("free", ("c",))], workers=3)
    assert order.index("c") > max(order.index("a"), order.index("b")) and order.index("free") > order.index("c")
    assert set(out.done) == {"a", "b", "c", "free"} and list(out.failed) == ["bad"]
    assert sorted(out.held_back) == ["below", "further"]


def test_cycles_and_unknown_steps_are_errors():
    nothing = lambda: None
    with pytest.raises(ValueError, match="do not exist"):
        run_steps([Step("a", ("z",), nothing)])
    with pytest.raises(ValueError, match="depend on each other"):
        run_steps([Step("a", ("b",), nothing), Step("b", ("a",), nothing), Step("c", (), nothing)])


def test_retries_wait_longer_each_time():
    calls, pauses = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("executor lost")
        return "ok"

    assert attempt(flaky, 2, 120.0, pauses.append, ()) == "ok" and pauses == [120.0, 240.0]
    calls.clear()
    with pytest.raises(OSError):
        attempt(flaky, 1, 1.0, lambda s: None, ())
    calls.clear()
    with pytest.raises(OSError):                              # what another attempt cannot mend
        attempt(flaky, 5, 1.0, lambda s: None, (OSError,))
    assert len(calls) == 1


# ---- lease and manifest ---------------------------------------------------------

def test_second_run_is_refused_until_the_lease_ends(spark, scratch):
    now = [1000.0]
    first = RunLease(spark, scratch, "one", ttl=60, clock=lambda: now[0])
    first.acquire()
    second = RunLease(spark, scratch, "two", ttl=60, clock=lambda: now[0])
    with pytest.raises(RunActive, match="run one"):
        second.acquire()
    with pytest.raises(RunActive):                           # nor a second attempt of the same run
        RunLease(spark, scratch, "one", ttl=60, clock=lambda: now[0]).acquire()
    now[0] += 50
    first.renew()
    now[0] += 50
    with pytest.raises(RunActive):
        second.acquire()
    now[0] += 20                                             # first was killed: not renewed any more
    second.acquire()
    with pytest.raises(LeaseLost):
        first.verify()
    first.release()                                          # not its own any more: stays
    assert second.holder()["run"] == "two"
    second.release()
    assert second.holder() is None
    with RunLease(spark, scratch, "three", ttl=60):
        pass


def test_pipeline_is_refused_while_another_run_is_active(spark, scratch):
    src = banking_sources(spark, SF_SMALL)
    with RunLease(spark, scratch, "other"):
        with pytest.raises(RunActive):
            run_pipeline(spark, src, scratch, DRIVER_RUN, run_checks=False)
    assert not os.path.exists(os.path.join(scratch, "bronze"))


def _files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names}


@pytest.mark.parametrize("catalog", [False, True])
def test_run_killed_in_gold_resumes_without_rewriting_silver(spark, scratch, monkeypatch, catalog):
    out, src = os.path.join(scratch, "lake"), banking_sources(spark, SF_SMALL)
    db = "ll_resume_" + os.path.basename(scratch).replace("-", "_") if catalog else None
    arguments = dict(run_checks=True, fail_on_error=False, database=db, buckets=2, retries=1, retry_delay=0.0)
    real, calls = gold.fact_transactions, []

    def dies(*a, **k):
        calls.append(1)
        raise OSError("driver lost its cluster")

    monkeypatch.setattr(pipeline.gold, "fact_transactions", dies)
    with pytest.raises(OSError):
        run_pipeline(spark, src, out, DRIVER_RUN, **arguments)
    assert len(calls) == 2                                   # one retry
    before = _files(os.path.join(out, "silver")), _files(os.path.join(out, "bronze"))
    monkeypatch.setattr(pipeline.gold, "fact_transactions", real)
    done = run_pipeline(spark, src, out, DRIVER_RUN, **arguments)
    assert (_files(os.path.join(out, "silver")), _files(os.path.join(out, "bronze"))) == before
    assert {"hub_account", "sat_transaction", "bronze_accounts", "quarantine", "dim_account"} <= set(done.resumed)
    assert "fact_transactions" not in done.resumed and "customer_kpis" not in done.resumed
    assert len(done.check_results) == 166
    assert spark.read.parquet(done.tables["fact_transactions"]).count() == src["transactions"].count()
    again = run_pipeline(spark, src, out, DRIVER_RUN, **arguments)
    assert not again.seconds and len(again.check_results) == 166      # nothing left to do


def test_failed_test_holds_back_only_what_depends_on_it(spark, scratch):
    out = os.path.join(scratch, "lake")
    src = dict(banking_sources(spark, SF_SMALL).items())
    # rows that pass all rules, but a branch that is there twice
    src["customers"] = src["customers"].withColumn("email", F.lit("a@b.cd")).withColumn("credit_score", F.lit(700))
    src["branches"] = src["branches"].limit(1).unionAll(src["branches"])
    with pytest.raises(CheckFailure, match="unique__bronze_branches__branch_id") as e:
        run_pipeline(spark, src, out, DRIVER_RUN)
    store = TableStore(spark, out)
    stored = {m for m in ("hub_branch", "sat_branch", "hub_customer", "sat_customer") if store.tags("silver", m)}
    assert stored == {"hub_customer", "sat_customer"}
    assert "dim_branch" in str(e.value) and "dim_customer" not in str(e.value)
    assert sinks.current_path(spark, store.table_path("dim_branch")) is None
    assert spark.read.parquet(store.location("dim_customer")).count() == src["customers"].count()
    assert spark.read.parquet(store.location("signups_by_month")).count() > 0


# ---- batches --------------------------------------------------------------------

@pytest.mark.parametrize("catalog", [False, True])
def test_half_written_batch_of_a_run_that_never_returns(spark, scratch, catalog):
    db = "ll_half_" + os.path.basename(scratch).replace("-", "_") if catalog else None
    store = TableStore(spark, scratch, db, 2)
    runs = [RunParams(load_ts=dt.datetime(2024, 1, d)) for d in (1, 2, 3)]
    rows = lambda *ks: spark.createDataFrame([(f"k{k}",) for k in ks], "hk_account string")

    def half_written(run, df):
        """As a killed driver leaves it: rows are there, the marker is not."""
        store.append_batch(df, "silver", "hub_account", run, "hk_account")
        files.delete(spark, f"{store.table_path('hub_account')}/_finished/_{batch_tag(run)}")

    half_written(runs[0], rows(1, 2))                        # the very first batch
    assert store.existing("silver", "hub_account", runs[1], "hk_account") is None
    assert store.append_batch(rows(3), "silver", "hub_account", runs[1], "hk_account").count() == 1
    half_written(runs[2], rows(4, 5))
    later = RunParams(load_ts=dt.datetime(2024, 1, 4))
    assert [r.hk_account for r in store.existing("silver", "hub_account", later, "hk_account").collect()] == ["k3"]
    store.check_newer("hub_account", RunParams(load_ts=dt.datetime(2024, 1, 2, 12)))     # run three never stored anything
    assert store.append_batch(rows(4, 5), "silver", "hub_account", runs[2], "hk_account").count() == 3      # its retry


def test_unfinished_snapshot_is_not_used(spark, scratch):
    """A satellite whose snapshot was cut off compares with its history."""
    from ledgerlake.operators.bronze import bronze
    from ledgerlake.plans.loading import load_jobs
    from test_pipeline import ONE, TWO, three

    store = TableStore(spark, scratch)
    for day, balances in ((1, ONE), (2, TWO), (3, TWO)):
        run = RunParams(load_ts=dt.datetime(2024, 1, day))
        dict(load_jobs(store, {"accounts": bronze(three(spark, balances), "accounts", run)}, run))["sat_account"]()
        if day == 2:
            files.delete(spark, f"{store.table_path('sat_account')}__current/_finished/_{batch_tag(run)}")
    assert store.stored("silver", "sat_account").count() == 6


# ---- publishing -----------------------------------------------------------------

class Crash(Exception):
    pass


@pytest.mark.parametrize("catalog", [False, True])
@pytest.mark.parametrize("where", ["switch", "tidy", "published"])
def test_readers_see_the_old_or_the_new_table_after_a_crash(spark, scratch, monkeypatch, catalog, where):
    db = f"ll_{where}_" + os.path.basename(scratch).replace("-", "_") if catalog else None
    store = TableStore(spark, scratch, db, 2)
    key = "k" if catalog else None

    def read():
        if catalog:
            return [r.k for r in spark.table(f"{db}.gold__dim_x").orderBy("k").collect()]
        return [r.k for r in sinks.read_full(spark, store.table_path("dim_x")).orderBy("k").collect()]

    store.write_full(spark.range(2).select(F.col("id").alias("k")), "gold", "dim_x", key)
    reader = spark.read.parquet(store.location("dim_x"))     # has started, goes on during the refresh
    with monkeypatch.context() as m:
        def crash(*a, **k):
            raise Crash

        if where == "published":
            m.setattr(TableStore, "published", crash)
        else:
            m.setattr(sinks, where, crash)
        new = spark.range(5, 8).select(F.col("id").alias("k"))
        if where == "published" and not catalog:
            store.write_full(new, "gold", "dim_x", key)      # this mode has no such step
        else:
            with pytest.raises(Crash):
                store.write_full(new, "gold", "dim_x", key)
    assert read() in ([0, 1], [5, 6, 7])
    assert read() == ([0, 1] if where == "switch" or (where == "published" and catalog) else [5, 6, 7])
    assert reader.count() == 2
    if where != "switch":                                    # the retry finds it published
        assert sorted(r.k for r in store.published("gold", "dim_x", key).collect()) == [5, 6, 7]
    for k in range(3):
        store.write_full(spark.range(k, k + 1).select(F.col("id").alias("k")), "gold", "dim_x", key)
        assert read() == [k]
    left = [n for n in os.listdir(store.table_path("dim_x")) if n.startswith("version=")]
    assert len(left) == sinks.KEEP


def test_refresh_with_another_schema(spark, scratch):
    db = "ll_schema_" + os.path.basename(scratch).replace("-", "_")
    store = TableStore(spark, scratch, db, 2)
    store.write_full(spark.range(2), "gold", "dim_x", "id")
    store.write_full(spark.range(2).withColumn("name", F.lit("n")), "gold", "dim_x", "id")
    assert spark.table(f"{db}.gold__dim_x").columns == ["id", "name"]
    assert store._exists("gold", "dim_x")


def test_manifest_values(spark, scratch):
    m = Manifest(spark, scratch, "r")
    m.finish("checks_x", [{"test_id": "a", "failures": 0}])
    assert Manifest(spark, scratch, "r").done == {"checks_x"} and m.value("checks_x")[0]["failures"] == 0
    assert Manifest(spark, scratch, "other").done == set()
