"""Global ordering without a single-partition exchange.

``rank() over (order by ...)`` without ``partition by`` makes Spark move every
row into one task (``Exchange SinglePartition``).  Here the rows are instead
range-partitioned on the sort key, sorted within each partition and numbered
locally; per-partition counts (one row per partition, a bounded table) give
each partition its offset.  Only the counts travel to one task.

The numbered data is checkpointed to the cluster's reliable checkpoint
folder before the counts are taken: range boundaries come from sampling, so
re-evaluating the plan could place rows differently and the counts would no
longer match.  The checkpoint also cuts the lineage, so a lost executor
re-reads the checkpoint rather than re-running the upstream plan.

The sort key must be unique (append a key column); otherwise equal keys
could not be split across partitions and a hot value would land in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[Column], out: str = "row_number",
             num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Attach a 1-based global row number in ``order`` (which must be unique).

    Returns ``(rows, total)`` where ``total`` is a one-row DataFrame with the
    row count ``_total`` (taken from the per-partition counts, no extra scan).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _partitions(df, num_partitions)
    placed = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    counts = placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded table, safe to order in one task and broadcast.
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_n")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS)
    rows = (placed.withColumn("_pid", pid)
            .join(F.broadcast(offsets), "_pid", "inner")
            .withColumn(out, (F.col("_off") + local + 1).cast("long"))
            .drop("_mid", "_pid", "_off"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("_total"))
    return rows, total


def global_rank(df: DataFrame, order: list[Column], out: str = "rank",
                unique: bool = True, tiebreak: list[Column] | None = None,
                keys: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """``rank() over (order by order)`` computed in parallel.

    With ``unique=True`` the order is a total order and rank equals the row
    number.  Otherwise rows are numbered with ``tiebreak`` appended (to split
    equal keys across partitions) and the rank of a row is the smallest number
    among rows with equal ``keys`` (the columns ``order`` sorts by).
    """
    if unique:
        rows, _ = numbered(df, order, out, num_partitions)
        return rows
    if not tiebreak or not keys:
        raise ValueError("a non-unique order needs tiebreak columns and the key column names")
    rows, _ = numbered(df, order + tiebreak, "_rn", num_partitions)
    first = (rows.groupBy(*keys).agg(F.min("_rn").alias(out))
             .select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], out))
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return rows.join(first, cond, "inner").drop("_rn", *[f"_key{i}" for i in range(len(keys))])


def value_quantiles(df: DataFrame, values: dict[str, Column], fractions: dict[str, float],
                    num_partitions: int | None = None) -> DataFrame:
    """Exact ``percentile_cont`` of several columns at once: one row per label of ``values``.

    Equal values are combined map-side into (label, value, count); only these
    distinct values are range-partitioned, sorted and kept (checkpointed), never the
    rows.  Counts per partition (a row per partition and label) tell which
    partitions hold the wanted positions, and only those cumulate their counts.
    NULLs are ignored; a label without values has no row.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _partitions(df, num_partitions)
    pairs = F.array(*[F.struct(F.lit(label).alias("label"), v.cast("double").alias("value"))
                      for label, v in values.items()])
    counts = (df.select(F.explode(pairs).alias("_p")).select("_p.label", "_p.value").where("value is not null")
              .groupBy("label", "value").agg(F.count(F.lit(1)).alias("n")))
    placed = (counts.repartitionByRange(n, "label", "value").withColumn("part", F.spark_partition_id())
              .checkpoint(eager=True))
    sums = placed.groupBy("label", "part").agg(F.sum("n").alias("n"))
    by_label = Window.partitionBy("label")
    spans = sums.select(                                     # a row per partition and label
        "label", "part", F.sum("n").over(by_label).alias("total"),
        (F.sum("n").over(by_label.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
        "n")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), ((F.col("total") - 1) * F.lit(f)).alias("at"))
                       for name, f in fractions.items()])
    at = (spans.select("label", "part", "before", "n", F.explode(wanted).alias("w"))
          .select("label", "part", "before", "n", "w.name", "w.at",
                  F.explode(F.array_distinct(F.array(F.floor("w.at"), F.ceil("w.at")))).alias("place"))
          .where((F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n")))
          .select("label", "part", "before", "name", "at", "place"))
    inside = placed.join(F.broadcast(at.select("label", "part", "before").distinct()), ["label", "part"])
    upto = Window.partitionBy("label", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("before") + F.sum("n").over(upto))
    hit = (inside.join(F.broadcast(at.drop("before")), ["label", "part"])
           .where((F.col("place") >= F.col("upto") - F.col("n")) & (F.col("place") < F.col("upto"))))
    ends = hit.groupBy("label", "name").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.first("at").alias("at"))
    share = F.col("at") - F.floor("at")
    value = F.when(share == 0, F.col("low")).otherwise(F.col("low") + share * (F.col("high") - F.col("low")))
    return ends.groupBy("label").agg(*[F.max(F.when(F.col("name") == name, value)).alias(name) for name in fractions])


def approximate_quantiles(df: DataFrame, values: dict[str, Column], fractions: dict[str, float],
                          accuracy: int) -> DataFrame:
    """Like :func:`value_quantiles` from mergeable summaries of bounded size: a result is
    a value whose rank is off by at most 1 / ``accuracy`` of the rows."""
    places = list(fractions)
    one = df.agg(*[F.percentile_approx(v.cast("double"), [fractions[f] for f in places], accuracy).alias(f"_{i}")
                   for i, v in enumerate(values.values())])
    rows = F.array(*[F.struct(F.lit(label).alias("label"), *[F.col(f"_{i}")[k].alias(f) for k, f in enumerate(places)])
                     for i, label in enumerate(values)])
    return one.select(F.explode(rows).alias("_r")).select("_r.*").where(F.col(places[0]).isNotNull())


def exact_percentiles(df: DataFrame, value: Column, fractions: dict[str, float],
                      tiebreak: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Exact ``percentile_cont`` for several fractions from one global numbering.

    Spark's exact ``percentile`` aggregate buffers every value in one task; this
    numbers the values across the cluster (see :func:`numbered`), keeps only the
    rows at the interpolation positions and interpolates
    ``lo + (pos - floor(pos)) * (hi - lo)``.  NULLs are ignored; no rows -> NULL.
    Returns one row with one column per entry of ``fractions``.
    """
    vals = df.select(value.cast("double").alias("_v"), *tiebreak).filter(F.col("_v").isNotNull())
    rows, total = numbered(vals, [F.col("_v")] + list(tiebreak), "_rn", num_partitions)
    cols = []
    for i, frac in enumerate(fractions.values()):
        pos = (F.col("_total") - 1) * F.lit(frac)
        cols += [pos.alias(f"_pos{i}"), (F.floor(pos) + 1).cast("long").alias(f"_lo{i}"),
                 (F.ceil(pos) + 1).cast("long").alias(f"_hi{i}")]
    bounds = total.select(*cols)  # one row: broadcast is bounded
    hit = reduce(lambda a, b: a | b, [(F.col("_rn") == F.col(f"_lo{i}")) | (F.col("_rn") == F.col(f"_hi{i}"))
                                      for i in range(len(fractions))])
    picked = rows.join(F.broadcast(bounds), hit)
    aggs = []
    for i in range(len(fractions)):
        aggs += [F.max(F.when(F.col("_rn") == F.col(f"_lo{i}"), F.col("_v"))).alias(f"_lv{i}"),
                 F.max(F.when(F.col("_rn") == F.col(f"_hi{i}"), F.col("_v"))).alias(f"_hv{i}"),
                 F.max(f"_pos{i}").alias(f"_pos{i}")]
    agg = picked.agg(*aggs)
    out = []
    for i, name in enumerate(fractions):
        frac = F.col(f"_pos{i}") - F.floor(F.col(f"_pos{i}"))
        out.append(F.when(frac == 0, F.col(f"_lv{i}"))
                   .otherwise(F.col(f"_lv{i}") + frac * (F.col(f"_hv{i}") - F.col(f"_lv{i}"))).alias(name))
    return agg.select(*out)


def exact_percentile(df: DataFrame, value: Column, fraction: float, tiebreak: list[Column],
                     out: str = "percentile", num_partitions: int | None = None) -> DataFrame:
    """One exact ``percentile_cont`` as a one-row DataFrame (see :func:`exact_percentiles`)."""
    return exact_percentiles(df, value, {out: fraction}, tiebreak, num_partitions)
