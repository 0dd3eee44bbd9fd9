"""Explicit splitting of hot keys in an equi-join (salting).

AQE already splits oversized partitions of sort-merge joins at runtime
(``spark.sql.adaptive.skewJoin.enabled``).  ``salted_join`` does the same
explicitly for a join where one key may carry a large share of the big side
(an account holding a third of all transactions): rows of hot keys are spread
over ``salts`` sub-keys on the big side, and the small side's rows for those
keys are replicated once per sub-key.  Keys that are not hot keep one sub-key,
so the small side grows only by (hot keys x salts) rows.

A key is hot when it holds more than ``share`` of all rows, so the broadcast
list has fewer than ``1 / share`` keys at any scale.  Salts are a hash
of the row's own columns, not ``rand()``, so a retried task assigns the same
salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A key with more than this share of the rows is hot; at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.001


#: Sub-keys of a hot key.
SALTS = 32
#: Slots of key hashes that are counted before keys are.
SLOTS = 1 << 16


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, weight: str | None = None) -> DataFrame:
    """Keys with more than ``share`` of the rows (fewer than ``1 / share`` of them); a row counts ``weight`` times.

    Rows are counted by slots of the key's hash first, of which a task shuffles ``SLOTS`` rows at most; only keys in
    slots that hold more than the share can do so themselves, and are counted one by one."""
    def rows_by(frame, by):
        return frame.groupBy(by).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_rows"))

    def above(counts):
        return counts.crossJoin(F.broadcast(total)).filter(F.col("_rows") > F.col("_total") * F.lit(share))     # one row
    slotted = df.withColumn("_slot", F.xxhash64(key).bitwiseAND(F.lit(SLOTS - 1)).cast("int"))
    slots = rows_by(slotted, "_slot")
    total = slots.agg(F.sum("_rows").alias("_total"))
    few = slotted.join(F.broadcast(above(slots).select("_slot")), "_slot", "left_semi")
    return above(rows_by(few, key)).select(key)


def dealt(big: DataFrame, key: str, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """``big`` with its rows' sub-keys of ``hot`` keys as ``_salt``."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(salts))
    return (big.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
            .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)).cast("int")).drop("_hot"))


def copied(small: DataFrame, key: str, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """``small`` with one copy of a ``hot`` key's rows for each ``_salt``."""
    return (small.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
            .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                            .otherwise(F.array(F.lit(0)))))
            .drop("_hot"))


def salted_join(big: DataFrame, small: DataFrame, key: str, share: float = HOT_SHARE,
                salts: int = SALTS, how: str = "inner", hot_from: DataFrame | None = None,
                weight: str | None = None, hot: DataFrame | None = None, keep_salt: bool = False) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys of ``big`` split ``salts`` ways.

    ``how`` is ``inner`` or ``left`` (big side preserved); the result equals the
    plain join.  ``hot_from`` is a cheaper table with the same key
    distribution to find hot keys in (e.g. the link that carries the key),
    instead of a second pass over ``big``'s whole lineage; its rows may be counts (``weight``).
    ``hot`` are hot keys that are known already.  ``keep_salt`` leaves the result's sub-keys in ``_salt``: it is
    partitioned by them, and a further join of it as ``big`` (with the same ``hot``) moves its rows no more.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if hot is None:
        hot = hot_keys(big if hot_from is None else hot_from, key, share, weight)
    b = big if "_salt" in big.columns else dealt(big, key, hot, salts)
    joined = b.join(copied(small, key, hot, salts), [key, "_salt"], how)
    return joined if keep_salt else joined.drop("_salt")
