"""Helpers shared by the text operators: reading tables, scratch tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import ensure_checkpoint_dir

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """A null text counts as the empty text everywhere in this package."""
    return F.coalesce(F.col(col), F.lit(""))


#: Spark's settings: a query's shuffle files go when it ends; rows that a Python worker gets at a time.
_CLEANUP, _BATCH = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch(spark: SparkSession, df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage and, unlike ``checkpoint()``, keeps column pruning; a lost
    executor re-reads files.  The write's shuffle files go with it; else they
    stay until the driver happens to collect its garbage.  ``batch``: Python
    workers get so many rows at a time (long texts).
    """
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    wanted = {_CLEANUP: "true", **({_BATCH: str(batch)} if batch else {})}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a ``scratch`` table whose last reader has been written."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: int, rows: int = 1024, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and, unless one row alone is longer, ``size`` bytes of ``column``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, to - at)
        at = to


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str | StructType,
             rows: int = 256) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` input rows.

    ``fn`` takes and returns columns as lists; it may return any number of
    rows.  Small slices bound the worker's memory for very long texts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    want = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    arrow = to_arrow_schema(want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pydict())
                got = pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
                if got.num_rows:
                    yield got

    return df.mapInArrow(run, want)


#: Most slots of ``possibly_in``; what is broadcast has this many rows at any scale.
SLOTS = 1 << 20


def possibly_in(rows: DataFrame, ids: DataFrame, key: str, absent: bool = False) -> DataFrame:
    """The rows whose key shares a hash slot with one of ``ids`` (or, ``absent``, with none).

    Thins out rows before an exact join; at most ``SLOTS`` integers are broadcast.
    """
    slot = F.xxhash64(key).bitwiseAND(F.lit(SLOTS - 1)).alias("slot__")
    slots = F.broadcast(ids.select(slot).distinct())
    return rows.select("*", slot).join(slots, "slot__", "left_anti" if absent else "left_semi").drop("slot__")


_LOCAL_BITS = 33                                             # monotonically_increasing_id: partition, then row


def placed(spark: SparkSession, rows: DataFrame, keys: list[str], order: list[str], weight: Column, label: str) -> DataFrame:
    """``rows`` with ``offset``, the sum of ``weight`` before the row among those of its ``keys``, by ``order`` (unique).

    Rows are range-partitioned and sorted, so a key with a third of all rows is
    spread over many partitions; a sum per partition and key is carried over.
    """
    sort = [*keys, *order]
    rows = scratch(spark, rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
                   .withColumn("row__", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("part__", F.shiftright("row__", _LOCAL_BITS)).withColumn("weight__", weight.cast("long"))
    before = Window.partitionBy(*keys).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*keys, "part__").agg(F.sum("weight__").alias("sum__"))
               .select(*keys, "part__", F.coalesce(F.sum("sum__").over(before), F.lit(0)).alias("before__")))
    inside = Window.partitionBy("part__", *keys).orderBy("row__").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside__", F.coalesce(F.sum("weight__").over(inside), F.lit(0)))
            .join(offsets, [*keys, "part__"]).withColumn("offset", F.col("before__") + F.col("inside__"))
            .drop("row__", "part__", "weight__", "inside__", "before__"))


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(values of the first ``keys`` columns, rows) of each run of equal ones in a sorted stream of batches."""
    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_pylist() for c in range(keys)]
        rows = list(zip(*values, strict=True))
        at = 0
        for k in range(1, len(rows) + 1):
            if k == len(rows) or rows[k] != rows[at]:
                if last is not None and rows[at] != last:
                    yield last, pa.Table.from_batches(held)
                    held = []
                last = rows[at]
                held.append(batch.slice(at, k - at))
                at = k
    if last is not None:
        yield last, pa.Table.from_batches(held)


#: Columns of the matrices multiplied at a time.
WIDE = 4096


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets (sorted distinct integers) of ``a`` with sets of ``b``, by matrix products."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))

    def places(sets):
        at = [np.searchsorted(both, s) for s in sets]
        at = [p[(p < len(both)) & (both[np.minimum(p, len(both) - 1)] == s)] for p, s in zip(at, sets, strict=True)]
        return np.repeat(np.arange(len(sets)), [len(p) for p in at]), np.concatenate(at)

    out = np.zeros((len(a), len(b)), np.int64)
    if len(both):
        (ra, ca), (rb, cb) = places(a), places(b)
        for at in range(0, len(both), WIDE):
            wide = min(WIDE, len(both) - at)
            x, y = np.zeros((len(a), wide), np.float32), np.zeros((len(b), wide), np.float32)
            for m, r, c in ((x, ra, ca), (y, rb, cb)):
                inside = (c >= at) & (c < at + wide)
                m[r[inside], c[inside] - at] = 1
            out += np.rint(x @ y.T).astype(np.int64)         # at most WIDE: exact
    return out


def crc_mod(k: int, col: str = "doc_id") -> Column:
    """``crc32`` of the id's decimal text, modulo ``k`` (fold assignment)."""
    return F.crc32(F.col(col).cast("string")) % F.lit(k)


class Memo(dict):
    """Dict that computes missing values with ``fn``; emptied by ``trim`` beyond ``limit``."""

    def __init__(self, fn: Callable, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        value = self[key] = self.fn(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
