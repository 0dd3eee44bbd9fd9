"""Sinks: layer routing (S7), full-refresh (S4) and batch-append (S5) writes.

Incremental tables are stored as one directory per batch, named by load time
and run id (``<table>/batch=<load time>-<run id>/``).  Only the same run writes
the same directory, so a retried batch replaces its own rows and never another
run's; "existing" rows for a batch are all *finished* batches of other runs.  A
batch is finished once its marker ``<table>/_finished/_<tag>`` exists, which is
written last: what a killed run left half-written is never read.

Full-refresh tables are published by a switch: every write goes to a version
folder of its own, and one empty marker file whose name carries the version,
``<table>/_published/_<number>.<version>``, makes it the current one.  Readers
resolve the highest number, so they see the old or the new table, never a
part.  The last ``KEEP`` versions stay for readers that are under way; older
ones and folders of writes that never came to their marker are removed by the next write.

A table may also be published in parts (buckets of a key): the marker then
holds which version each bucket is read from, so a refresh writes the buckets
that change and takes the others from where they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.keys import is_key, key_text, packed
from ledgerlake.params import RunParams
from ledgerlake.session import shuffles_freed
from ledgerlake.sources import files
from ledgerlake.sources.files import exists  # noqa: F401  (part of this module's interface)

LAYERS = ("bronze", "silver", "gold", "reporting")
#: Published versions of a full-refresh table that stay.
KEEP = 2
#: Codec of stored tables: it halves MD5 digests in hex, which Spark's default (snappy) leaves as they are.
COMPRESSION = "zstd"


#: How parts' buckets are found; parts of another kind are not added to.
BUCKETED_BY = "hash of the packed key"


def table_path(base: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{base.rstrip('/')}/{layer}/{name}"


class StaleBatch(RuntimeError):
    """A batch is not newer than what other runs have stored."""


def batch_tag(run: RunParams) -> str:
    """Sorts by load time; unique per run."""
    return f"{run.load_ts.strftime('%Y%m%dT%H%M%S%f')}-{run.run_id}"


def _load_time(tag: str) -> str:
    return tag.split("-", 1)[0]


# ---- full refresh: version folders and a switch ---------------------------------

def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, version, marker name) of the published versions, oldest first."""
    out = []
    for name in files.names(spark, f"{path}/_published"):
        number, _, version = name[1:].partition(".")
        out.append((int(number), version, name))
    return sorted(out)


def version_path(path: str, version: str) -> str:
    return f"{path}/version={version}"


def current_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the published version; None before the first."""
    versions = _versions(spark, path)
    return version_path(path, versions[-1][1]) if versions else None


def _content(spark: SparkSession, path: str, marker: str) -> dict:
    text = files.read_text(spark, f"{path}/_published/{marker}")
    return json.loads(text) if text else {}


def published_parts(spark: SparkSession, path: str) -> dict:
    """What the current marker says of a table in parts: ``parts`` (bucket -> version) and whatever else was told."""
    versions = _versions(spark, path)
    return _content(spark, path, versions[-1][2]) if versions else {}


def part_path(path: str, bucket: str, version: str) -> str:
    return f"{version_path(path, version)}/bucket={bucket}"


def current_paths(spark: SparkSession, path: str) -> list[str]:
    """Folders that make up the published table."""
    parts = published_parts(spark, path).get("parts")
    if parts is not None:
        return [part_path(path, b, v) for b, v in sorted(parts.items())]
    where = current_path(spark, path)
    return [where] if where else []


def switch(spark: SparkSession, path: str, version: str, content: dict | None = None) -> None:
    """Make a completely written version the current one."""
    versions = _versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    files.write_text(spark, f"{path}/_published/_{number:010d}.{version}", json.dumps(content) if content else "",
                     overwrite=False)


def tidy(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove superseded versions (marker first), parts that no version uses, and what was never published."""
    versions = _versions(spark, path)
    for _, _, marker in versions[:-keep]:
        files.delete(spark, f"{path}/_published/{marker}")
    stay: dict[str, set[str] | None] = {}                    # version -> buckets in use, None for the whole folder
    for _, version, marker in versions[-keep:]:
        parts = _content(spark, path, marker).get("parts")
        if parts is None:
            stay[version] = None
        else:
            for bucket, source in parts.items():
                stay.setdefault(source, set()).add(f"bucket={bucket}")
    for name in files.names(spark, path):
        if not name.startswith("version="):
            continue
        used = stay.get(name[len("version="):], set())
        if used is None:
            continue
        for part in files.names(spark, f"{path}/{name}") if used else []:
            if part.startswith("bucket=") and part not in used:
                files.delete(spark, f"{path}/{name}/{part}")
        if not used:
            files.delete(spark, f"{path}/{name}")


def write_full(df: DataFrame, path: str) -> None:
    """Full refresh of a table with one writer at a time (see the module's text)."""
    spark, version = df.sparkSession, uuid.uuid4().hex[:12]
    with shuffles_freed(spark):
        df.write.option("compression", COMPRESSION).parquet(version_path(path, version))
    switch(spark, path, version)
    tidy(spark, path)


def bucket_of(df: DataFrame, key: str, buckets: int) -> Column:
    """Bucket of a key, by the hash of its packed form by which Spark also partitions rows that are joined on it: with
    a number of partitions that ``buckets`` divides, each holds rows of one bucket."""
    raw = F.col(key) if dict(df.dtypes)[key] == "binary" else packed(key)
    return F.pmod(F.hash(raw), F.lit(buckets))


def write_parts(df: DataFrame, path: str, key: str, buckets: int, replaced: list[int] | None, more: dict) -> None:
    """Publish ``df`` as the content of the buckets ``replaced`` (None: of all); the others stay as they are.
    Keys, which ``df`` may have packed, are stored as text.  Rows are written where they lie, by the key after the
    joins that made them, and not shuffled once more."""
    spark, version = df.sparkSession, uuid.uuid4().hex[:12]
    where = version_path(path, version)
    rows = df.withColumn("bucket", bucket_of(df, key, buckets))
    rows = rows.select(*[key_text(rows, c).alias(c) if is_key(c) else c for c in rows.columns])
    with shuffles_freed(spark):
        rows.write.option("compression", COMPRESSION).partitionBy("bucket").parquet(where)
    parts = {} if replaced is None else {b: v for b, v in published_parts(spark, path).get("parts", {}).items()
                                         if int(b) not in replaced}
    parts |= {n.split("=")[1]: version for n in files.names(spark, where) if n.startswith("bucket=")}
    switch(spark, path, version, {"parts": parts, "buckets": buckets, "by": BUCKETED_BY, **more})
    tidy(spark, path)


def read_full(spark: SparkSession, path: str) -> DataFrame:
    """The published version of a full-refresh table."""
    where = current_paths(spark, path)
    if not where:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(*where)


# ---- batches --------------------------------------------------------------------

def finish_batch(spark: SparkSession, path: str, tag: str) -> None:
    files.write_text(spark, f"{path}/_finished/_{tag}", "")


def reopen_batch(spark: SparkSession, path: str, tag: str) -> None:
    """Take a batch out of sight before its rows change."""
    files.delete(spark, f"{path}/_finished/_{tag}")


def write_batch(df: DataFrame, path: str, run: RunParams) -> None:
    """Idempotent append: (re)write this run's own directory only, then mark it finished."""
    spark, tag = df.sparkSession, batch_tag(run)
    reopen_batch(spark, path, tag)
    with shuffles_freed(spark):
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/batch={tag}")
    finish_batch(spark, path, tag)


def batch_tags(spark: SparkSession, path: str) -> list[str]:
    """Tags of the finished batches stored at ``path``, oldest first."""
    return [name[1:] for name in files.names(spark, f"{path}/_finished")]


def read_batches(spark: SparkSession, path: str, other_than: RunParams | None = None,
                 schema=None) -> DataFrame | None:
    """Union of finished batches (optionally only those of other runs).
    Returns None when nothing is stored yet (first run)."""
    tags = batch_tags(spark, path)
    if other_than is not None:
        tags = [t for t in tags if t != batch_tag(other_than)]
    if not tags:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{path.rstrip('/')}/batch={t}" for t in tags])


class TableStore:
    """Where a pipeline run keeps its models.

    * path mode (``database=None``): plain parquet folders; silver batches are
      ``batch=<load time>-<run id>`` sub-folders (see the functions above).
    * catalog mode: tables registered in ``database`` (external, at the same
      paths), silver tables **bucketed by their join key** and partitioned by
      ``_batch``.  Readers then know how the data is partitioned: joins and
      windows on the hash key between hubs, links and satellites, and the
      incremental anti-joins against stored rows, need no exchange on the
      stored side.  A batch first drops its own partition (left by a failed
      earlier attempt) and then appends, so a retry replaces exactly it;
      readers take the partitions of finished batches only.  A full-refresh
      table's location is moved to its new version once that is published.
    """

    def __init__(self, spark: SparkSession, base: str, database: str | None = None,
                 buckets: int = 0):
        self.spark, self.base, self.database = spark, base.rstrip("/"), database
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.base}/_catalog'")

    @property
    def narrow(self) -> bool:
        """Stored rows lie by no key, so loads shuffle them, packed."""
        return not self.database

    def table_path(self, model: str) -> str:
        """Storage folder of a model name (``bronze_<t>``, ``hub_x``, ``dim_x`` ...)."""
        if model.startswith("bronze_"):
            return table_path(self.base, "bronze", model[len("bronze_"):])
        if model.split("_", 1)[0] in ("hub", "link", "sat") or model == "quarantine":
            return table_path(self.base, "silver", model)
        if model.split("_", 1)[0] in ("dim", "fact"):
            return table_path(self.base, "gold", model)
        return table_path(self.base, "reporting", model)

    def _fq(self, layer: str, name: str) -> str:
        return f"{self.database}.{layer}__{name}"

    def _exists(self, layer: str, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{layer}__{name}")

    def write_full(self, df: DataFrame, layer: str, name: str, key: str | None = None) -> DataFrame:
        path = table_path(self.base, layer, name)
        if not self.database:
            write_full(df, path)
            return read_full(self.spark, path)
        version = uuid.uuid4().hex[:12]
        where = version_path(path, version)
        if key:
            # bucketed files come from a table write; its entry goes again, the (external) files stay
            staged = f"{self._fq(layer, name)}__{version}"
            (df.write.format("parquet").option("path", where).bucketBy(self.buckets, key).sortBy(key)
             .saveAsTable(staged))
            self.spark.sql(f"DROP TABLE {staged}")
        else:
            df.write.parquet(where)
        switch(self.spark, path, version)
        table = self.published(layer, name, key)
        tidy(self.spark, path)
        return table

    def published(self, layer: str, name: str, key: str | None = None) -> DataFrame:
        """The current version of a full-refresh table; in catalog mode its entry is first
        brought to that version, should a run have stopped between the two."""
        path = table_path(self.base, layer, name)
        if not self.database:
            return read_full(self.spark, path)
        where, table = current_path(self.spark, path), self._fq(layer, name)
        if where is None:
            raise FileNotFoundError(f"nothing is published at {path}")
        schema = self.spark.read.parquet(where).schema
        if self._exists(layer, name) and self.spark.table(table).schema == schema:
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{where}'")
            self.spark.catalog.refreshTable(table)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(f"CREATE TABLE {table} ({_columns(schema)}) USING parquet {self._clustered(key)} "
                           f"LOCATION '{where}'")
        return self.spark.table(table)

    def location(self, model: str) -> str:
        """Folder to read a model from: the published version, or the table's folder of batches."""
        path = self.table_path(model)
        where = current_paths(self.spark, path)
        return where[0] if len(where) == 1 else path

    def tags(self, layer: str, name: str) -> list[str]:
        """Tags of the finished batches, oldest first (one entry per batch)."""
        return batch_tags(self.spark, table_path(self.base, layer, name))

    def check_newer(self, name: str, run: RunParams) -> None:
        """Refuse a batch that another run's stored batch of a silver table is
        as new as: satellites compare with the latest stored version."""
        others = [t for t in self.tags("silver", name) if t != batch_tag(run)]
        if others and _load_time(max(others)) >= _load_time(batch_tag(run)):
            raise StaleBatch(f"{name}: batch {max(others)} is stored already; load time "
                             f"{run.load_ts.isoformat()} (run {run.run_id}) is not newer")

    def existing(self, layer: str, name: str, run: RunParams,
                 key: str | None = None) -> DataFrame | None:
        """Rows of the finished batches of all other runs (None on the first run)."""
        return self._finished(layer, name, [t for t in self.tags(layer, name) if t != batch_tag(run)], key)

    def stored(self, layer: str, name: str, key: str | None = None) -> DataFrame | None:
        """Rows of all finished batches."""
        return self._finished(layer, name, self.tags(layer, name), key)

    def _finished(self, layer: str, name: str, tags: list[str], key: str | None) -> DataFrame | None:
        if not tags:
            return None
        path = table_path(self.base, layer, name)
        if not self.database:
            return self.spark.read.parquet(*[f"{path}/batch={t}" for t in tags])
        if not self._exists(layer, name):
            self._attach(layer, name, path, key)
        return self.spark.table(self._fq(layer, name)).filter(F.col("_batch").isin(tags)).drop("_batch")

    def append_batch(self, df: DataFrame, layer: str, name: str, run: RunParams,
                     key: str | None = None) -> DataFrame:
        path, tag = table_path(self.base, layer, name), batch_tag(run)
        if not self.database:
            write_batch(df, path, run)
            return read_batches(self.spark, path)
        reopen_batch(self.spark, path, tag)
        if key:
            # rows meet their bucket before the write: one file per bucket, not one per task and bucket
            df = df.repartition(self.buckets, key)
        tagged = df.withColumn("_batch", F.lit(tag))
        table = self._fq(layer, name)
        if not self._exists(layer, name):
            if self.tags(layer, name):
                self._attach(layer, name, path, key)
            else:
                self._create(layer, name, path, key, tagged.schema)
        # a retried batch first removes what its earlier attempt stored, then
        # appends (an overwrite may not read its own target; the loaders read
        # the other batches of this table)
        self.drop_batch(layer, name, tag)
        tagged.select(*self.spark.table(table).columns).write.insertInto(table, overwrite=False)
        finish_batch(self.spark, path, tag)
        return self.stored(layer, name, key)

    def drop_batch(self, layer: str, name: str, tag: str) -> None:
        path = table_path(self.base, layer, name)
        reopen_batch(self.spark, path, tag)
        if self.database:
            self.spark.sql(f"ALTER TABLE {self._fq(layer, name)} DROP IF EXISTS PARTITION (_batch='{tag}')")
            files.delete(self.spark, f"{path}/_batch={tag}")
        else:
            files.delete(self.spark, f"{path}/batch={tag}")

    def batch(self, layer: str, name: str, tag: str, key: str | None = None) -> DataFrame:
        """The rows of one stored batch (one folder / one pruned partition)."""
        path = table_path(self.base, layer, name)
        if not self.database:
            return self.spark.read.parquet(f"{path}/batch={tag}")
        if not self._exists(layer, name):
            self._attach(layer, name, path, key)
        return self.spark.table(self._fq(layer, name)).filter(F.col("_batch") == tag).drop("_batch")

    def _attach(self, layer: str, name: str, path: str, key: str | None) -> None:
        """Register batches already stored at ``path`` (a catalog that forgot
        the table) instead of overwriting them.  The schema comes from the
        stored files; the bucket spec from the caller."""
        self._create(layer, name, path, key, self.spark.read.parquet(path).schema)
        self.spark.sql(f"ALTER TABLE {self._fq(layer, name)} RECOVER PARTITIONS")

    def _create(self, layer: str, name: str, path: str, key: str | None, schema) -> None:
        self.spark.sql(f"CREATE TABLE {self._fq(layer, name)} ({_columns(schema)}) USING parquet PARTITIONED BY (_batch) "
                       f"{self._clustered(key)} LOCATION '{path}'")

    def _clustered(self, key: str | None) -> str:
        return f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS" if key else ""


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
