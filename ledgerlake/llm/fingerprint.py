"""Operator 7: homomorphic multiset fingerprints, in DataFrame functions only.

A paragraph (line) is hashed to a wide vector; a document's fingerprint is the
sum of its paragraphs' vectors, lane by lane modulo a power of two.  So it
does not depend on the paragraphs' order, equal multisets have equal
fingerprints, and a paragraph can be added to or taken from a fingerprint
(``combine``) without the text.

Lanes of a paragraph: ``STRONG`` uniform 32-bit values of the whole paragraph
(equality), ``2 * PAIRS`` lanes that sum one hash bit of each of its clauses,
modulo 2**16, and the clause count, modulo 2**32.  The centred bit lanes are a
random projection of the multiset of clauses: their cosine is the likeness.

Defined results: a null text is empty; an empty text has the all-zero
fingerprint; two empty texts have likeness 1, an empty and another one 0;
rows with equal doc_id follow each other by text hash; extra columns are
ignored; an empty table gives no rows; a single document's next is itself.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, text_of

STRONG = 8
PAIRS = 32
PARAGRAPH = "\\n"
CLAUSE = "\\n|(?<=[.!?,;:|])\\s+"
#: Blocks of neighbouring ids per shuffle partition, and the most blocks (boundaries kept on the driver).
BLOCKS_PER_PARTITION, MAX_BLOCKS = 4, 16384
#: Sampled ids per block; the sample only balances the blocks.
SAMPLE_PER_BLOCK = 32
M32, M16 = 0xFFFFFFFF, 0xFFFF


def _pieces(text: Column, pattern: str) -> Column:
    return F.filter(F.split(text, pattern), lambda p: p != "")


def vector(text: Column) -> Column:
    """Fingerprint lanes of a text: array of ``STRONG + PAIRS + 1`` longs.

    Sums stay below 2**63: a text has fewer than 2**31 pieces and each adds
    less than 2**32 to a field.  Two bit lanes share a long while summing.
    """
    zero = F.lit(0).cast("long")
    strong = F.aggregate(
        _pieces(text, PARAGRAPH), F.struct(*[zero.alias(f"s{i}") for i in range(STRONG)]),
        lambda acc, p: F.struct(*[(acc[f"s{i}"] + F.xxhash64(p, F.lit(i)).bitwiseAND(F.lit(M32))).alias(f"s{i}")
                                  for i in range(STRONG)]),
        lambda acc: F.array(*[acc[f"s{i}"].bitwiseAND(F.lit(M32)) for i in range(STRONG)]))
    two = (1 << 32) + 1

    def packed(v: Column) -> Column:
        high = F.shiftrightunsigned(v, 32).bitwiseAND(F.lit(M16))
        return F.shiftleft(high, 16).bitwiseOR(v.bitwiseAND(F.lit(M16)))

    bits = F.aggregate(
        F.transform(_pieces(text, CLAUSE), lambda p: F.xxhash64(p)),
        F.struct(*[zero.alias(f"b{i}") for i in range(PAIRS)], zero.alias("n")),
        lambda acc, h: F.struct(*[(acc[f"b{i}"] + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(two))).alias(f"b{i}")
                                  for i in range(PAIRS)], (acc["n"] + 1).alias("n")),
        lambda acc: F.array(*[packed(acc[f"b{i}"]) for i in range(PAIRS)], acc["n"].bitwiseAND(F.lit(M32))))
    return F.concat(strong, bits)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the union (``sign=1``) or difference (``sign=-1``) of two multisets (columns of lanes)."""
    def lane(x: Column, y: Column, k: Column) -> Column:
        whole = (x + sign * y).bitwiseAND(F.lit(M32))
        low = (x.bitwiseAND(F.lit(M16)) + sign * y.bitwiseAND(F.lit(M16))).bitwiseAND(F.lit(M16))
        high = (F.shiftright(x, 16) + sign * F.shiftright(y, 16)).bitwiseAND(F.lit(M16))
        return F.when((k < STRONG) | (k >= STRONG + PAIRS), whole).otherwise(F.shiftleft(high, 16).bitwiseOR(low))
    index = F.sequence(F.lit(0), F.lit(STRONG + PAIRS))
    return F.transform(index, lambda k: lane(F.get(a, k), F.get(b, k), k))


def written(lanes: Column) -> Column:
    return F.lower(F.array_join(F.transform(lanes, lambda v: F.lpad(F.hex(v), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; 1 for equal fingerprints, about the cosine of the clause multisets otherwise."""
    def centred(lanes: Column) -> Column:
        n = F.element_at(lanes, -1)
        half = 1 << 15
        signed = lambda c: (2 * c - n + half).bitwiseAND(F.lit(M16)) - half
        packed = F.slice(lanes, STRONG + 1, PAIRS)
        return F.concat(F.transform(packed, lambda v: signed(v.bitwiseAND(F.lit(M16)))),
                        F.transform(packed, lambda v: signed(F.shiftright(v, 16))))
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("xy", "xx", "yy")])
    sums = F.aggregate(
        F.arrays_zip(centred(a).alias("x"), centred(b).alias("y")), zero,
        lambda s, v: F.struct((s["xy"] + v["x"] * v["y"]).alias("xy"), (s["xx"] + v["x"] * v["x"]).alias("xx"),
                              (s["yy"] + v["y"] * v["y"]).alias("yy")),
        lambda s: F.when((s["xx"] == 0) | (s["yy"] == 0), 0.0).otherwise(
            s["xy"] / (F.sqrt(s["xx"].cast("double")) * F.sqrt(s["yy"].cast("double")))))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sums)))


def _block(bounds: list[int], key: Column) -> Column:
    """Number of ``bounds`` (sorted) that are at most ``key``, by binary search."""
    steps = max(1, len(bounds).bit_length())
    padded = F.array(*[F.lit(b).cast("long") for b in bounds + [2**63 - 1] * ((1 << steps) - 1 - len(bounds))])
    return F.aggregate(
        F.array(*[F.lit(1 << s) for s in range(steps - 1, -1, -1)]), F.lit(0),
        lambda at, step: F.when(F.get(padded, at + step - 1) <= key, at + step).otherwise(at))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (doc_id, tie, ...) with ``next_<c>`` for each of ``columns``.

    One shuffle: ids fall into blocks of neighbours by sampled boundaries;
    each block's first row is also sent to the block before it.
    """
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(-(2**63)))              # null ids come first
    ids = docs.select(key.alias("key"))
    n = ids.count()
    if n == 0:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    blocks = min(MAX_BLOCKS, BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    some = sorted(r.key for r in ids.sample(min(1.0, SAMPLE_PER_BLOCK * blocks / n), seed=1).collect())
    bounds = sorted({some[k * len(some) // blocks] for k in range(1, blocks)}) if some else []
    located = docs.withColumn("block", _block(bounds, key))
    firsts = {r.block: r.key for r in ids.select("key", _block(bounds, F.col("key")).alias("block"))
              .groupBy("block").agg(F.min("key").alias("key")).collect()}    # at most MAX_BLOCKS rows
    there = sorted(firsts)
    first = F.array(*[F.lit(firsts[there[max(0, bisect.bisect_right(there, b) - 1)]]).cast("long")
                      for b in range(len(bounds) + 1)])
    before = F.array(*[F.lit(there[bisect.bisect_left(there, b) - 1]) for b in range(len(bounds) + 1)])
    place = lambda b, borrowed: F.struct(b.alias("block"), F.lit(borrowed).alias("borrowed"))
    sent = (located.withColumn("place", F.explode(
        F.when(key == F.get(first, F.col("block")),
               F.array(place(F.col("block"), 0), place(F.get(before, F.col("block")), 1)))
        .otherwise(F.array(place(F.col("block"), 0)))))
        .select(*docs.columns, "place.*"))
    in_order = Window.partitionBy("block").orderBy("borrowed", F.col("doc_id").asc_nulls_first(), "tie")
    return (sent.select("*", *[F.lead(c).over(in_order).alias(f"next_{c}") for c in columns])
            .where("borrowed = 0").drop("block", "borrowed"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, lanes, edited text and lanes, next document's lanes."""
    plain = docs.select("doc_id", text_of().alias("text"))
    own = plain.select("doc_id", "text", F.xxhash64("text").alias("tie"), vector(F.col("text")).alias("lanes"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    return (with_next(own, ["text", "lanes"])
            .select("doc_id", n.cast("long").alias("n_chars"), "lanes", "next_lanes",
                    F.concat(F.col("text").substr(F.lit(1), n - half),
                             F.col("next_text").substr(F.lit(1), half)).alias("edited"))
            .withColumn("edited_lanes", vector(F.col("edited"))))


def op7_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("lanes")).alias("fingerprint"), written(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))
