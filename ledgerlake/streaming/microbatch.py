"""Feed the incremental vault loaders from a Structured Streaming source.

The reference loads in scheduled batches; a stream of source rows can drive
the same append-only loaders through ``foreachBatch``.  Each micro-batch is
one vault batch: bronze audit columns, then hub / link / satellite appends
against what earlier batches stored.

Exactly-once: the load time of an epoch is recorded in the output folder the
first time the epoch runs and read back on a retry; it is later than every
stored batch of the satellites it feeds, whatever the clock says.  The epoch's
run id is ``<source>-<epoch>``, so a replayed epoch rewrites its own batches
and two epochs never share one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.bronze import bronze
from ledgerlake.params import RunParams, utc_now
from ledgerlake.plans.entities import ENTITIES
from ledgerlake.plans.loading import load_jobs
from ledgerlake.sources.sinks import TableStore, exists


def _newest(store: TableStore, source: str) -> dt.datetime | None:
    """Load time of the newest stored satellite batch fed by ``source``."""
    tags = [t for e in ENTITIES.values() if e.source == source for t in store.tags("silver", f"sat_{e.name}")]
    return dt.datetime.strptime(max(tags).split("-", 1)[0], "%Y%m%dT%H%M%S%f") if tags else None


def _epoch_load_ts(spark: SparkSession, store: TableStore, source: str, epoch_id: int,
                   clock: Callable[[], dt.datetime]) -> dt.datetime:
    path = f"{store.base}/_epochs/{source}/epoch={epoch_id}"
    if exists(spark, f"{path}/_SUCCESS"):
        return dt.datetime.fromisoformat(spark.read.schema("load_ts string").json(path).first()["load_ts"])
    ts, newest = clock(), _newest(store, source)
    if newest is not None and ts <= newest:
        ts = newest + dt.timedelta(microseconds=1)
    spark.createDataFrame([(ts.isoformat(),)], "load_ts string").coalesce(1).write.mode("overwrite").json(path)
    return ts


def vault_batch_writer(out: str, source: str, base: RunParams | None = None,
                       clock: Callable[[], dt.datetime] | None = None,
                       database: str | None = None, buckets: int = 0):
    """A ``foreachBatch`` function loading micro-batches of one source table
    (e.g. ``accounts``) into every hub, link and satellite fed by it, stored
    like the pipeline stores them (folders, or bucketed catalog tables with
    ``database``)."""
    base = base or RunParams()
    clock = clock or utc_now

    def write(batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        store = TableStore(spark, out, database, buckets)
        run = replace(base, load_ts=_epoch_load_ts(spark, store, source, epoch_id, clock),
                      run_id=f"{source}-{epoch_id}")
        for _, job in load_jobs(store, {source: bronze(batch_df, source, run)}, run):
            job()

    return write
