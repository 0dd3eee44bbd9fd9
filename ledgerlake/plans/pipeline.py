"""Pipeline runner: source check -> bronze -> silver -> gold -> reporting, each
model tested as soon as it is stored.

Every model is a step that starts when the models it reads are stored (and,
where assertions gate, when their tests have passed); steps run from driver
threads, so small tables do not leave the cluster idle while a large one finishes its last
tasks.  A failed test holds back only what depends on its model.

Writing every model cuts the lineage between layers: a downstream job starts
from files, a lost executor re-reads a file instead of recomputing upstream
joins, and no layer is computed twice.  Silver tables are append-only: each
run writes its own batch, named by load time and run id, so a retried run
replaces exactly what it wrote before, and "existing rows" are the finished
batches of all other runs.  A run that is not newer than what is stored is
refused.

One run at a time has the lake (``RunLease``), and a retry of a run goes on
after its last finished step (``Manifest``); see :mod:`ledgerlake.plans.runs`.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import checks as chk
from ledgerlake.operators import gold, reports
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.vault import quarantine
from ledgerlake.params import RunParams
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.plans.loading import SILVER_BUCKET_KEYS, check_order, load_jobs
from ledgerlake.plans.runs import FINAL, CheckFailure, Manifest, RunLease, Step, run_steps
from ledgerlake.plans.upkeep import keep_dimension
from ledgerlake.sources.readers import check_sources
from ledgerlake.sources.sinks import StaleBatch, TableStore, batch_tag

# Gold dimensions are joined by reports on their durable hub key.
GOLD_BUCKET_KEYS = {f"dim_{e}": f"{e}_hub_key" for e in ["customer", "account", "card", "merchant", "branch"]}

#: Models that each gold model reads.
GOLD_INPUTS = {
    "dim_customer": ("sat_customer", "hub_customer"),
    "dim_account": ("sat_account", "hub_account", "link_customer_account"),
    "dim_card": ("sat_card", "hub_card", "link_account_card"),
    "dim_merchant": ("sat_merchant", "hub_merchant"),
    "dim_branch": ("sat_branch", "hub_branch"),
    "dim_date": (),
    "fact_transactions": ("sat_transaction", "link_account_transaction", "link_merchant_transaction",
                          "link_customer_account"),
    "fact_loans": ("sat_loan", "link_customer_loan"),
    "fact_account_balance": ("sat_account", "link_customer_account"),
}


@dataclass
class RunResult:
    tables: dict[str, str] = field(default_factory=dict)       # model -> folder
    check_results: list = field(default_factory=list)           # rows of the check runner
    seconds: dict[str, float] = field(default_factory=dict)     # wall time per step
    resumed: list[str] = field(default_factory=list)            # steps finished by an earlier attempt

    @contextmanager
    def timed(self, step: str):
        t0 = time.perf_counter()
        yield
        self.seconds[step] = round(time.perf_counter() - t0, 3)


def gold_model(name: str, spark: SparkSession, t: dict[str, DataFrame], hot_key_share: float | None) -> DataFrame:
    if name == "dim_date":
        return gold.dim_date(spark)
    build = getattr(gold, name)
    inputs = [t[m] for m in GOLD_INPUTS[name]]
    return build(*inputs, hot_share=hot_key_share) if name == "fact_transactions" else build(*inputs)


class _Run:
    """The steps of one run over one store."""

    def __init__(self, spark, sources, store: TableStore, params: RunParams, lease: RunLease, manifest: Manifest,
                 run_checks: bool, fail_on_error: bool, hot_key_share: float | None, dim_buckets: int):
        self.spark, self.sources, self.store, self.params = spark, sources, store, params
        self.lease, self.manifest, self.dim_buckets = lease, manifest, dim_buckets
        self.run_checks, self.gating, self.hot_key_share = run_checks, run_checks and fail_on_error, hot_key_share
        self.result, self.tables = RunResult(), {}
        self.checks: dict[str, list] = {}
        for group in chk.catalogue().values():
            for c in group:
                self.checks.setdefault(c.table, []).append(c)

    def model(self, name: str, after: tuple[str, ...], write: Callable[[], DataFrame],
              read: Callable[[], DataFrame]) -> Step:
        """A step that stores a model, or reads what an earlier attempt stored."""
        def run():
            if name in self.manifest.done:
                self.tables[name] = read()
                self.result.resumed.append(name)
                return
            self.lease.verify()
            with self.result.timed(name):
                self.tables[name] = write()
            self.lease.verify()
            self.manifest.finish(name)

        return Step(name, after, run)

    def full(self, layer: str, name: str, after: tuple[str, ...], build: Callable[[], DataFrame],
             key: str | None = None, model: str | None = None) -> Step:
        return self.model(model or name, after, lambda: self.store.write_full(build(), layer, name, key),
                          lambda: self.store.published(layer, name, key))

    def test(self, name: str, after: tuple[str, ...], checks: list, cross: list[str]) -> Step:
        """A step that evaluates assertions; fails on error-severity ones if they gate."""
        step = f"checks_{name}"

        def run():
            if step in self.manifest.done:
                self.result.check_results.extend(self.manifest.value(step))
                self.result.resumed.append(step)
                return
            rows = []
            with self.result.timed(step):
                for job in chk.check_jobs(checks, self.tables, self.params.load_ts_col, cross):
                    # each job returns one row per assertion: bounded by the catalogue, not the data
                    rows += [r.asDict() for r in job().collect()]
            for d in rows:
                d["status"] = "pass" if d["failures"] == 0 else ("warn" if d["severity"] == "warn" else "fail")
            failed = [d["test_id"] for d in rows if d["status"] == "fail"]
            if failed and self.gating:
                self.result.check_results.extend(rows)
                raise CheckFailure(f"{len(failed)} assertion(s) failed: {failed}")
            self.manifest.finish(step, rows)
            self.result.check_results.extend(rows)

        return Step(step, after, run)

    def passed(self, *models: str) -> tuple[str, ...]:
        """What a consumer of the models waits for."""
        return tuple(f"checks_{m}" if self.gating and m in self.checks else m for m in models)

    def steps(self) -> list[Step]:
        store, t = self.store, self.tables
        out = [self.full("bronze", s, (), lambda s=s, df=df: bronze(df, s, self.params), model=f"bronze_{s}")
               for s, df in self.sources.items()]
        feeds = {**{f"{kind}_{e.name}": e.source for e in ENTITIES.values() for kind in ("hub", "sat")},
                 **{f"link_{l.name}": l.source for l in LINKS.values()}}
        for name, source in feeds.items():
            def write(name=name, source=source):
                return dict(load_jobs(store, {source: t[f"bronze_{source}"]}, self.params))[name]()

            out.append(self.model(name, self.passed(f"bronze_{source}"), write,
                                  lambda name=name: store.stored("silver", name, SILVER_BUCKET_KEYS[name])))
        # quarantine reports the rows that fail the satellites' tests, so it does not wait for these
        both = [f"{kind}_{e}" for e in ENTITIES for kind in ("sat", "hub")]
        out.append(self.full("silver", "quarantine", tuple(both), lambda: quarantine(
            {e: t[f"sat_{e}"] for e in ENTITIES}, {e: t[f"hub_{e}"] for e in ENTITIES})))
        for name, inputs in GOLD_INPUTS.items():
            if self.dim_buckets and name in GOLD_BUCKET_KEYS:
                out.append(self.model(name, self.passed(*inputs), lambda name=name, inputs=inputs: keep_dimension(
                    store, name, GOLD_BUCKET_KEYS[name], inputs, "hk_" + name.removeprefix("dim_"), getattr(gold, name),
                    self.dim_buckets), lambda name=name: store.published("gold", name)))
                continue
            out.append(self.full("gold", name, self.passed(*inputs), lambda name=name: gold_model(
                name, self.spark, t, self.hot_key_share), GOLD_BUCKET_KEYS.get(name)))
        for name, build in reports.BUILDERS.items():
            out.append(self.full("reporting", name, self.passed(*reports.INPUTS[name]),
                                 lambda build=build: build(t, self.params)))
        if self.run_checks:
            models = {s.name for s in out}
            for name, checks in self.checks.items():
                parents = {c.args[0] for c in checks if c.kind == "relationships"}
                out.append(self.test(name, (name, *sorted(parents & models)), checks, []))
            for name, (_, inputs) in chk.CROSS_ENTITY.items():
                out.append(self.test(name, inputs, [], [name]))
        return out


def run_pipeline(spark: SparkSession, sources: dict[str, DataFrame], out: str,
                 params: RunParams | None = None, run_checks: bool = True,
                 fail_on_error: bool = True, workers: int = 8,
                 database: str | None = None, buckets: int = 0,
                 hot_key_share: float | None = None, retries: int = 2, retry_delay: float = 120.0,
                 lease_seconds: float = 600.0, dim_buckets: int = 0) -> RunResult:
    """One scheduled run (the reference's daily DAG, without the scheduler).

    ``fail_on_error``: a model whose error-severity assertions fail holds back
    what depends on it (warn-severity ones only report), the rest of the run is
    finished, then CheckFailure is raised; without it all assertions only
    report.  ``workers`` is the number of steps submitted at the same time.  With
    ``database`` the models are catalog tables and silver is bucketed by join
    key (``buckets``, default the shuffle partition count), see
    :class:`~ledgerlake.sources.sinks.TableStore`.  ``hot_key_share`` splits
    accounts with more than that share of the transactions in the fact build explicitly
    (see :mod:`ledgerlake.operators.skew`); by default AQE splits them.
    ``dim_buckets`` keeps the SCD2 dimensions in so many parts and rewrites only
    those of touched keys (:mod:`ledgerlake.plans.upkeep`; folders, not catalog
    tables); by default they are rebuilt.

    A step that fails is tried ``retries`` times more, after ``retry_delay``
    seconds and then twice as long each time.  A run that was stopped resumes after its finished
    steps when called again with the same ``params``; while another run has the
    lake, RunActive is raised (a killed driver's lease ends after ``lease_seconds``).
    """
    params = params or RunParams()
    if dim_buckets and database:
        raise ValueError("dim_buckets needs tables in folders: a catalog table has one location")
    check_sources(sources)
    tag = batch_tag(params)
    with RunLease(spark, out, tag, lease_seconds) as lease:
        store = TableStore(spark, out, database, buckets)
        check_order(store, params, sources)
        run = _Run(spark, sources, store, params, lease, Manifest(spark, out, tag), run_checks, fail_on_error,
                   hot_key_share, dim_buckets)
        outcome = run_steps(run.steps(), workers, retries, retry_delay, final=(*FINAL, StaleBatch))
        errors = [e for e in outcome.failed.values() if not isinstance(e, CheckFailure)]
        if errors:
            raise errors[0]
        if outcome.failed:
            raise CheckFailure("; ".join(str(e) for e in outcome.failed.values())
                               + f"; held back: {sorted(outcome.held_back)}")
        run.result.tables = {name: store.location(name) for name in run.tables}
        return run.result
