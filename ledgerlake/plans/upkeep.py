"""SCD2 dimensions kept up to date by the keys that a batch touches.

A dimension row depends on its own hub key's satellite, hub and link rows
only.  So after a batch the intervals of the touched keys are computed again,
and only the buckets that hold one are rewritten: their other rows are copied,
all other buckets stay as published (:func:`ledgerlake.sources.sinks.write_parts`).

The published version says which batches it covers.  Touched are the keys of
all finished batches that it does not, so a run that stored its satellites and
then died is caught up by the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.keys import packed_keys
from ledgerlake.plans.loading import SILVER_BUCKET_KEYS
from ledgerlake.session import shuffles_freed
from ledgerlake.sources import sinks
from ledgerlake.sources.sinks import TableStore


def keep_dimension(store: TableStore, name: str, key: str, inputs: tuple[str, ...], hk: str,
                   build: Callable[..., DataFrame], buckets: int) -> DataFrame:
    """Bring the dimension ``name`` (rows of hub key ``key``) up to the stored batches of its silver ``inputs``.

    ``build`` makes the dimension from the inputs' rows; ``hk`` is the hub key's
    name in them; it gets them with their keys packed.  Returns the published table.
    """
    spark, path = store.spark, store.table_path(name)
    tags = {t: store.tags("silver", t) for t in inputs}
    told = sinks.published_parts(spark, path)
    stored = {t: store.stored("silver", t, SILVER_BUCKET_KEYS[t]) for t in inputs}
    if any(df is None for df in stored.values()):
        raise ValueError(f"{name}: nothing is stored of {[t for t, df in stored.items() if df is None]}")
    packed = {t: packed_keys(df, hk) for t, df in stored.items()}
    if (told.get("buckets"), told.get("by")) != (buckets, sinks.BUCKETED_BY):    # first version, or other buckets
        sinks.write_parts(build(*packed.values()), path, key, buckets, None, {"covers": tags})
        return sinks.read_full(spark, path)
    new = {t: [x for x in tags[t] if x not in told["covers"].get(t, [])] for t in inputs}
    batches = [store.batch("silver", t, tag, SILVER_BUCKET_KEYS[t]).select(hk) for t in inputs for tag in new[t]]
    if not batches:
        return sinks.read_full(spark, path)
    touched = packed_keys(reduce(DataFrame.unionByName, batches), hk).distinct()
    with shuffles_freed(spark):
        hit = [r.b for r in touched.select(sinks.bucket_of(touched, hk, buckets).alias("b")).distinct().collect()]   # at most ``buckets``
    rebuilt = packed_keys(build(*[df.join(touched, hk, "left_semi") for df in packed.values()]))
    here = [sinks.part_path(path, b, v) for b, v in told["parts"].items() if int(b) in hit]
    rows = rebuilt
    if here:
        copied = packed_keys(spark.read.parquet(*here), key).join(touched.withColumnRenamed(hk, key), key, "left_anti")
        rows = rebuilt.unionByName(copied)
    if hit:
        sinks.write_parts(rows, path, key, buckets, hit, {"covers": tags})
    return sinks.read_full(spark, path)
