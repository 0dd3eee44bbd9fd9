"""Data Vault loaders: hubs, links, satellites (insert-only) and quarantine.

Every loader takes the bronze batch, the rows already stored (``existing``,
None on the first run) and the run parameters, and returns only the rows to
append.  The plans are hash-partitioned on the hub key:

* hub / link: partial + final aggregate on the key, then a shuffled
  ``left_anti`` join against the stored keys (the ``NOT EXISTS`` of the
  reference; never ``NOT IN``, whose null-aware form cannot be shuffled).
* satellite: dedupe on (hk, hash_diff), the latest stored hash per hk as an
  aggregate, left join, keep new or changed rows.  Aggregate and join share
  the hk partitioning, so the stored side is shuffled once.

Hot keys are collapsed by the map-side partial aggregate before any shuffle,
so a key carrying a third of all rows ships one row per map task.  The ``keyed``
loads, ``packed_rows`` and a ``narrow`` satellite load against stored rows give that up
for a single shuffle of narrow rows: there all copies of one hub key meet in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.keys import hash_diff, hash_key, link_hash_key, packed, packed_keys, unpacked, unpacked_keys
from ledgerlake.params import RunParams
from ledgerlake.plans.entities import ENTITIES, Entity, Link


def load_hub(bronze_df: DataFrame, entity: Entity, params: RunParams,
             existing: DataFrame | None = None, narrow: bool = False) -> DataFrame:
    """Distinct business keys by hash key.  Raw keys normalising to one hash
    (``' c1 '`` / ``'C1'``) keep the smallest raw key.  A NULL key gives a
    NULL hash key that never matches a stored row (as in the reference).

    ``narrow`` (here and in the other loaders): keys are shuffled packed, on both sides.  Stored rows that are
    bucketed by the key's text must not be loaded against in this way, as they would be shuffled."""
    hk, key = entity.hk, entity.key
    hashed = hash_key(key)
    new = (bronze_df
           .select((F.unhex(hashed) if narrow else hashed).alias(hk), F.struct(F.col(key), F.col("_source")).alias("_k"))
           .groupBy(hk)
           .agg(F.min("_k").alias("_k"))
           .select(hk, F.col("_k")[key].alias(key), params.load_ts_col.alias("load_dts"),
                   F.col("_k")["_source"].alias("rec_src")))
    if existing is not None:
        stored = existing.select(hk)
        new = new.join(packed_keys(stored, hk) if narrow else stored, on=hk, how="left_anti")
    return unpacked_keys(new) if narrow else new


def _keyed(rows: DataFrame, hk: str, digests: list[str]) -> DataFrame:
    """``rows`` partitioned by the digest ``hk`` (never NULL); all ``digests`` are shuffled as bytes."""
    def raw(c):
        # not nullable, so that joins on the key need not hash it once more to drop NULLs
        return F.coalesce(F.unhex(c), F.lit(b"")) if c == hk else F.unhex(c)
    text = [F.lower(F.hex(c)).alias(c) if c in digests else F.col(c) for c in rows.columns]
    return (rows.select(*[raw(c).alias(c) if c in digests else F.col(c) for c in rows.columns])
            .repartition(F.lower(F.hex(hk))).select(*text))


def load_link(bronze_df: DataFrame, link: Link, params: RunParams,
              existing: DataFrame | None = None, keyed: bool = False) -> DataFrame:
    """Distinct relationships by link hash key (md5 of both hub keys).

    ``keyed`` gives the link rows that an inner join on the second hub's key
    can meet (the key is not NULL), partitioned by that key: they are
    shuffled once for the dedupe and for that join.  As both keys then decide the link
    key, they are the dedupe's key.
    """
    a, b = ENTITIES[link.a], ENTITIES[link.b]
    rows = bronze_df.where(F.col(b.key).isNotNull()) if keyed else bronze_df
    hashed = rows.select(hash_key(a.key).alias(a.hk), hash_key(b.key).alias(b.hk),
                         F.col("_source").alias("rec_src"))
    if keyed:
        new = (_keyed(hashed, b.hk, [a.hk, b.hk])
               .groupBy(b.hk, a.hk).agg(F.min("rec_src").alias("rec_src"))
               .select(link_hash_key(a.hk, b.hk).alias(link.hk), a.hk, b.hk,
                       params.load_ts_col.alias("load_dts"), "rec_src"))
        return new if existing is None else new.join(existing.select(link.hk), on=link.hk, how="left_anti")
    # digests are shuffled as bytes, which are ordered as their text is
    def text(c):
        return F.lower(F.hex(c))
    new = (hashed
           .select(F.unhex(link_hash_key(a.hk, b.hk)).alias(link.hk),
                   F.struct(F.unhex(a.hk).alias(a.hk), F.unhex(b.hk).alias(b.hk), "rec_src").alias("_v"))
           .groupBy(link.hk)
           .agg(F.min("_v").alias("_v")))
    if existing is not None:
        new = new.join(packed_keys(existing.select(link.hk), link.hk), on=link.hk, how="left_anti")
    return (new
           .select(text(link.hk).alias(link.hk), text(F.col("_v")[a.hk]).alias(a.hk), text(F.col("_v")[b.hk]).alias(b.hk),
                   params.load_ts_col.alias("load_dts"), F.col("_v")["rec_src"].alias("rec_src")))


def sat_columns(entity: Entity) -> list[str]:
    return [entity.hk, *entity.attr_names, "hash_diff", "_is_valid", "load_dts", "rec_src"]


def stage_sat(bronze_df: DataFrame, entity: Entity, params: RunParams) -> DataFrame:
    """Clean, hash and flag one batch (no dedupe yet)."""
    cleaned = bronze_df.select(
        F.col(entity.key),
        *[fn(F.col(name)).alias(name) for name, fn in entity.attrs],
        F.col("_source"))
    now = params.load_ts_col
    return cleaned.select(
        hash_key(entity.key).alias(entity.hk),
        *entity.attr_names,
        hash_diff(*entity.attr_names).alias("hash_diff"),
        entity.valid(F.col, now).alias("_is_valid"),
        now.alias("load_dts"),
        F.col("_source").alias("rec_src"))


def stage_keyed_sat(bronze_df: DataFrame, entity: Entity, params: RunParams) -> DataFrame:
    """The rows of :func:`stage_sat` whose hub key is not NULL, partitioned by it.  Key and
    attributes are shuffled, the rest is computed behind the shuffle."""
    now = params.load_ts_col
    rows = bronze_df.where(F.col(entity.key).isNotNull()).select(
        hash_key(entity.key).alias(entity.hk), *[fn(F.col(name)).alias(name) for name, fn in entity.attrs],
        F.col("_source").alias("rec_src"))
    return _keyed(rows, entity.hk, [entity.hk]).select(
        entity.hk, *entity.attr_names, hash_diff(*entity.attr_names).alias("hash_diff"),
        entity.valid(F.col, now).alias("_is_valid"), now.alias("load_dts"), "rec_src")


def dedupe_versions(staged: DataFrame, entity: Entity, keyed: bool = False) -> DataFrame:
    """One row per (hk, hash_diff) of a batch.  Copies of a row combine
    map-side.  Two attribute tuples that share a hash_diff (the undelimited
    hash makes ('ab','c') and ('a','bc') collide) are one version; the
    smallest tuple is kept, so a retry keeps the same one.  Unless the rows are
    ``keyed`` already, both keys are shuffled packed."""
    rest = [c for c in sat_columns(entity) if c not in (entity.hk, "hash_diff")]
    keys = (entity.hk, "hash_diff")
    into, back = (F.col, F.col) if keyed else (packed, unpacked)
    return (staged.groupBy(*[into(c).alias(c) for c in keys]).agg(F.min(F.struct(*rest)).alias("_v"))
            .select(*[back(c).alias(c) if c in keys else F.col("_v")[c].alias(c) for c in sat_columns(entity)]))


def _raw(key: str, otherwise: Column) -> Column:
    """The digest of a business key as bytes; not nullable, so that joins on it need not hash the
    key once more to drop NULLs."""
    return F.coalesce(F.unhex(hash_key(key)), otherwise)


def packed_link(bronze_df: DataFrame, link: Link) -> DataFrame:
    """Both hub keys of :func:`load_link`'s rows as bytes, without rows whose second key is NULL."""
    a, b = ENTITIES[link.a], ENTITIES[link.b]
    return (bronze_df.where(F.col(b.key).isNotNull())
            .select(F.unhex(hash_key(a.key)).alias(a.hk), _raw(b.key, F.lit(b"")).alias(b.hk)).distinct())


def _cleaned(name: str, fn) -> Column:
    """An attribute's cleaned column.  One that is taken as it is gets no alias: Spark drops such an alias in some uses
    of the rows and keeps it in others, which then do not share their shuffle."""
    raw = F.col(name)
    clean = fn(raw)
    return raw if clean is raw else clean.alias(name)


def packed_rows(bronze_df: DataFrame, entity: Entity, joined: list[Entity], others: list[Entity],
                with_key: bool = False) -> DataFrame:
    """What the satellite of ``entity`` and the links that end in its hub are loaded from: cleaned attributes and
    hub keys as bytes, partitioned by the hub key, which is not NULL (``with_key``: with the business key, for the hub).

    :func:`first_rows` of it read all columns, so Spark shuffles the rows once for all of
    them.  A missing key of a ``joined`` hub is replaced by the row's own key and a mark, which no digest
    equals: an inner join drops it, and many of them do not meet in one task.
    """
    rows = bronze_df.where(F.col(entity.key).isNotNull()).select(
        _raw(entity.key, F.lit(b"")).alias(entity.hk), *[F.unhex(hash_key(e.key)).alias(e.hk) for e in (*joined, *others)],
        *([entity.key] if with_key else []), *[_cleaned(name, fn) for name, fn in entity.attrs], F.col("_source").alias("rec_src"))
    missing = F.concat(entity.hk, F.lit(bytes(1)))
    for e in joined:
        rows = rows.withColumn(e.hk, F.coalesce(e.hk, missing))
    return rows.repartition(entity.hk)


def first_rows(rows: DataFrame, hk: str, key: str) -> DataFrame:
    """The first row per ``hk`` and ``key`` of :func:`packed_rows`, in the order of the columns: within a hub key's
    rows, in order, the one whose ``key`` is not that of the row before.  A filter on ``key`` stays above
    the window, so that the shuffle below remains the same for all."""
    order = Window.partitionBy(hk).orderBy(key, *[c for c in rows.columns if c not in (hk, key)])
    return (rows.withColumn("_rn", F.row_number().over(order)).withColumn("_before", F.lag(key).over(order))
            .where((F.col("_rn") == 1) | ~F.col("_before").eqNullSafe(F.col(key))).drop("_rn", "_before"))


def packed_hub(rows: DataFrame, entity: Entity) -> DataFrame:
    """The rows of :func:`load_hub` in :func:`packed_rows` with the business key."""
    first = [entity.key, "rec_src"]
    return first_rows(rows.select(*first, *[c for c in rows.columns if c not in first]), entity.hk, entity.hk)


def packed_sat(rows: DataFrame, entity: Entity, params: RunParams, existing: DataFrame | None = None) -> DataFrame:
    """The versions of :func:`load_sat` in :func:`packed_rows`; which of several rows with one
    hash_diff is kept is decided by their attributes first, as in :func:`dedupe_versions`.  ``existing`` versions
    have packed keys too."""
    now = params.load_ts_col
    rest = [c for c in rows.columns if c not in entity.attr_names and c != "rec_src"]
    kept = first_rows(rows.select(*entity.attr_names, "rec_src", *rest, F.unhex(hash_diff(*entity.attr_names)).alias("hash_diff")),
                      entity.hk, "hash_diff")
    versions = kept.select(
        entity.hk, *entity.attr_names, F.lower(F.hex("hash_diff")).alias("hash_diff"),
        entity.valid(F.col, now).alias("_is_valid"), now.alias("load_dts"), "rec_src")
    return versions if existing is None else changed(versions, existing, entity)


def latest_hash(existing: DataFrame, hk: str) -> DataFrame:
    """Latest stored ``hash_diff`` per hub key; ties on ``load_dts`` (two
    versions of one batch) are broken by ``hash_diff``."""
    return (existing.groupBy(hk)
            .agg(F.max(F.struct("load_dts", "hash_diff"))["hash_diff"].alias("_existing_hash_diff")))


def load_sat(bronze_df: DataFrame, entity: Entity, params: RunParams,
             existing: DataFrame | None = None, keyed: bool = False, narrow: bool = False) -> DataFrame:
    """New and changed attribute versions of one batch.

    Compared with the latest stored version only, so A -> B -> A stores three
    versions.  Invalid rows are stored too (soft fail, ``_is_valid = false``).
    ``keyed`` gives the versions that an inner join on the hub key can meet (the key
    is not NULL), partitioned by it: they are shuffled once for dedupe and join.  So does ``narrow``
    with all rows of a batch that meets ``existing`` ones.
    """
    if narrow and existing is not None:
        return _narrow_sat(bronze_df, entity, params, existing)
    stage = stage_keyed_sat if keyed else stage_sat
    staged = dedupe_versions(stage(bronze_df, entity, params), entity, keyed)
    if existing is None:
        return staged.select(*sat_columns(entity))
    return changed(staged, existing, entity)


def _narrow_sat(bronze_df: DataFrame, entity: Entity, params: RunParams, existing: DataFrame) -> DataFrame:
    """:func:`load_sat`'s rows; batch and stored hashes are each shuffled once by the packed hub key.  Rows whose key
    is NULL lie by their hash_diff and a mark, which no digest equals, so they meet no stored key."""
    hk, now = entity.hk, params.load_ts_col
    raw = F.unhex(hash_key(entity.key))
    rows = bronze_df.select(F.col(entity.key), *[fn(F.col(name)).alias(name) for name, fn in entity.attrs],
                            F.col("_source").alias("rec_src"))
    other = F.concat(F.unhex(hash_diff(*entity.attr_names)), F.lit(bytes(1)))
    rows = (rows.select(F.coalesce(raw, other, F.lit(b"")).alias(hk), *entity.attr_names, "rec_src").repartition(hk)
            .select(hk, *entity.attr_names, F.unhex(hash_diff(*entity.attr_names)).alias("hash_diff"),
                    entity.valid(F.col, now).alias("_is_valid"), now.alias("load_dts"), "rec_src"))
    new = changed(dedupe_versions(rows, entity, keyed=True), packed_keys(existing.select(hk, "load_dts", "hash_diff"), hk), entity)
    key = {hk: F.when(F.length(hk) == 16, F.lower(F.hex(hk))), "hash_diff": F.lower(F.hex("hash_diff"))}
    return new.select(*[key.get(c, F.col(c)).alias(c) for c in sat_columns(entity)])


def changed(staged: DataFrame, existing: DataFrame, entity: Entity) -> DataFrame:
    """The ``staged`` versions that differ from the latest of their key in ``existing``."""
    joined = staged.join(latest_hash(existing, entity.hk), on=entity.hk, how="left")
    return (joined
            .filter(F.col("_existing_hash_diff").isNull()
                    | (F.col("_existing_hash_diff") != F.col("hash_diff")))
            .select(*sat_columns(entity)))


def current_hashes(previous: DataFrame | None, new_versions: DataFrame, hk: str, narrow: bool = False) -> DataFrame:
    """One row per hub key with its latest ``hash_diff`` and ``load_dts``,
    after applying a batch's new versions to the previous snapshot.  Feeding
    this snapshot (instead of the whole history) to :func:`load_sat` makes the
    change detection of a batch proportional to the number of keys, not to
    the length of the history."""
    cols = [hk, "hash_diff", "load_dts"]
    both = new_versions.select(*cols)
    if previous is not None:
        both = previous.select(*cols).unionByName(both)
    if narrow:
        return unpacked_keys(current_hashes(None, packed_keys(both), hk))
    return (both.groupBy(hk).agg(F.max(F.struct("load_dts", "hash_diff")).alias("_l"))
            .select(hk, F.col("_l")["hash_diff"].alias("hash_diff"), F.col("_l")["load_dts"].alias("load_dts")))


#: Hash slots of ``suspects``; what is broadcast has this many rows at most.
SLOTS = 1 << 20


def suspects(bronze_df: DataFrame, entity: Entity, params: RunParams) -> DataFrame:
    """The bronze rows whose key shares a hash slot with the key of an invalid row.

    All rows of a key with an invalid version are among them, so a hub or
    satellite loaded from them holds exactly the rows of the whole one for
    such keys.  The validity filter reaches the scan, and the dedupes behind it
    shuffle few rows; should most slots be taken, they shuffle what they did anyway.
    """
    slot = F.xxhash64(F.upper(F.trim(F.col(entity.key).cast("string")))).bitwiseAND(F.lit(SLOTS - 1)).alias("_slot")
    cleaned = bronze_df.select(F.col(entity.key), *[fn(F.col(name)).alias(name) for name, fn in entity.attrs])
    bad = cleaned.filter(~entity.valid(F.col, params.load_ts_col)).select(slot).distinct()
    return bronze_df.withColumn("_slot", slot).join(F.broadcast(bad), "_slot", "left_semi").drop("_slot")


def quarantine_of_batch(bronze_tables: dict[str, DataFrame], params: RunParams) -> DataFrame:
    """Quarantine of a first load straight from bronze (by source table)."""
    few = {n: suspects(bronze_tables[e.source], e, params) for n, e in ENTITIES.items()}
    return quarantine({n: load_sat(few[n], e, params) for n, e in ENTITIES.items()},
                      {n: load_hub(few[n], e, params) for n, e in ENTITIES.items()})


def quarantine(sats: dict[str, DataFrame], hubs: dict[str, DataFrame]) -> DataFrame:
    """Invalid satellite versions with their business key, all entities.

    The validity filter reaches the scan of a stored satellite, so of those
    only rejected rows are shuffled; over lazily loaded ones it stays above the
    dedupe (see ``quarantine_of_batch``).
    """
    parts = []
    for name, sat in sats.items():
        e = ENTITIES[name]
        bad = sat.filter(~F.col("_is_valid")).select(e.hk, "load_dts")
        hub = hubs[name].select(e.hk, e.key)
        parts.append(bad.join(hub, on=e.hk, how="inner").select(
            F.lit(name).alias("source_table"),
            F.col(e.key).alias("source_business_key"),
            F.col(e.hk).alias("hash_key"),
            F.lit(e.reason).alias("rejection_reason"),
            F.col("load_dts")))
    return reduce(DataFrame.unionByName, parts)
