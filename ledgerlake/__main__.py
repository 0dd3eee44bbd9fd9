"""Command line / spark-submit entry point: one pipeline run.

    spark-submit --py-files ledgerlake.zip -m ledgerlake \\
        --sources parquet:/data/raw --out s3://bucket/lake --load-ts 2024-01-01T00:00:00

``--sources`` is ``parquet:<dir>`` / ``csv:<dir>`` (one ``<table>.<fmt>`` per
source table, read with the explicit schemas) or ``driver:<dir>`` (the TPC-H
style test tables, mapped to the banking sources).  Prints one JSON line with
the written tables, step times and the assertion summary.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from ledgerlake.params import DEFAULT_SOURCE, RunParams
from ledgerlake.plans.pipeline import run_pipeline
from ledgerlake.plans.runs import CheckFailure, RunActive
from ledgerlake.session import get_session
from ledgerlake.sources.driver_tables import banking_sources
from ledgerlake.sources.readers import read_source
from ledgerlake.sources.schemas import SOURCE_TABLES


def _sources(spark, spec: str):
    kind, _, where = spec.partition(":")
    if kind == "driver":
        return banking_sources(spark, where)
    if kind in ("parquet", "csv", "json", "orc"):
        return {t: read_source(spark, t, f"{where.rstrip('/')}/{t}.{kind}", kind) for t in SOURCE_TABLES}
    raise SystemExit(f"unknown source kind {kind!r}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlake", description=__doc__.splitlines()[0])
    ap.add_argument("--sources", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--load-ts", default=None, help="load time (ISO, UTC); default: now")
    ap.add_argument("--as-of", default=None, help="report date; default: today (UTC)")
    ap.add_argument("--run-id", default=None, help="repeat a failed run: its id, with its --load-ts and --as-of")
    ap.add_argument("--source-tag", default=DEFAULT_SOURCE)
    ap.add_argument("--database", default=None, help="catalog database: bucketed silver tables")
    ap.add_argument("--buckets", type=int, default=0)
    ap.add_argument("--hot-key-share", type=float, default=None)
    ap.add_argument("--dim-buckets", type=int, default=0, help="keep dimensions in parts, rewrite those of touched keys")
    ap.add_argument("--workers", type=int, default=8)
    ap.add_argument("--retries", type=int, default=2, help="further attempts of a failed step")
    ap.add_argument("--retry-delay", type=float, default=120.0, help="seconds before the first; doubled each time")
    ap.add_argument("--lease-seconds", type=float, default=600.0,
                    help="a killed run's hold on the output ends after this time")
    ap.add_argument("--no-checks", action="store_true")
    ap.add_argument("--report-only", action="store_true", help="failed assertions do not stop the run")
    ap.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    given = {"load_ts": a.load_ts and dt.datetime.fromisoformat(a.load_ts),
             "as_of": a.as_of and dt.date.fromisoformat(a.as_of), "run_id": a.run_id}
    params = RunParams(source_tag=a.source_tag, **{k: v for k, v in given.items() if v})
    run = {"run_id": params.run_id, "load_ts": params.load_ts.isoformat(), "as_of": params.as_of.isoformat()}
    print(json.dumps({"status": "started", **run}), flush=True)
    try:
        result = run_pipeline(spark, _sources(spark, a.sources), a.out, params,
                              run_checks=not a.no_checks, fail_on_error=not a.report_only,
                              workers=a.workers, database=a.database, buckets=a.buckets,
                              hot_key_share=a.hot_key_share, retries=a.retries, retry_delay=a.retry_delay, dim_buckets=a.dim_buckets,
                              lease_seconds=a.lease_seconds)
    except (CheckFailure, RunActive) as e:
        print(json.dumps({"status": "failed", **run, "error": str(e)}))
        return 1
    summary = {}
    for r in result.check_results:
        summary[r["status"]] = summary.get(r["status"], 0) + 1
    print(json.dumps({"status": "ok", **run, "tables": result.tables, "seconds": result.seconds,
                      "assertions": summary}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
