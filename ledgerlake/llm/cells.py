"""Links between components whose members still share a list, looked for in cells of two blocks.

A list (a band's key, a shingle) whose members are in several components is cut
into blocks of bounded weight, sorted by component, and every pair of blocks is
one cell, dealt to tasks by its name; blocks that are wholly of one component
do not meet.  A first pass compares what members carry (sketches, parities) and hands
on members with a likely partner, a second one compares these members' full
sets by a matrix product and returns a spanning set of the links.  No pair is
ever a row, so a large list costs rows by its length times its number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, grouped, placed, scratch, shared_counts

#: Sets that a Python worker gets at a time.
SETS = 1000


def open_members(member: DataFrame, key: list[str], parts: DataFrame, heavy: int) -> DataFrame:
    """The members (key, node, n, ...) of lists that hold several components, with their ``part`` and their list's weight
    ``total`` (a member weighs one, and one more per ``heavy`` shingles).

    Of lists with the same members (told by two 64-bit hashes) the first stands for all: their pairs are the same.
    """
    member = (member.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component"))
    several = (member.groupBy(*key).agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("c"),
                                        F.sum(weight(heavy)).alias("total"), F.bit_xor(F.xxhash64("node")).alias("h1"),
                                        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("h2"))
               .where("p <> q"))
    first = several.groupBy("h1", "h2", "c").agg(F.min(F.struct(*key)).alias("at"), F.first("total").alias("total"))
    return member.join(first.select("at.*", "total"), key)


def weight(heavy: int) -> Column:
    return 1 + F.floor(F.col("n") / heavy)


def links_between(spark: SparkSession, opened: DataFrame, key: list[str], percent: int, block: int, heavy: int,
                  likely: Callable[[tuple, pa.Table], np.ndarray], sets_of: Callable[[DataFrame], DataFrame],
                  label: str) -> DataFrame:
    """u, v: links that join components.

    ``opened``: key, node, n (set size), part, total (the list's weight, as :func:`open_members` gives it; else it is
    summed here) and whatever ``likely(key values, members)`` looks at; that tells which members have a likely partner of
    another part (``sides`` gives the two blocks).  ``sets_of(nodes)`` gives node and shingles (sorted 64-bit integers as
    bytes).  A block weighs ``block``, a member one, and one more per ``heavy`` shingles.
    """
    if "total" not in opened.columns:
        opened = opened.join(opened.groupBy(*key).agg(F.sum(weight(heavy)).alias("total")), key)
    extra = [c for c in opened.columns if c not in (*key, "node", "n", "part", "total")]
    large = placed(spark, opened.where(F.col("total") > block).drop("total"), key, ["part", "n", "node"], weight(heavy),
                   f"{label}-sorted")
    columns = [*key, "node", "n", "part", *extra]
    # a list of one block is one cell; only blocks of larger lists are paired
    alone = opened.where(F.col("total") <= block).select(*columns, F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    blocked = scratch(spark, large.select(*columns, F.floor(F.col("offset") / block).alias("block")), f"{label}-blocks")
    blocks = blocked.groupBy(*key, "block").agg(F.min("part").alias("p"), F.max("part").alias("q"),
                                                F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = blocks.alias("a"), blocks.alias("b")
    same = F.lit(True)
    for c in key:
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    pairs = (a.join(b, same & (F.col("a.block") <= F.col("b.block")) & (F.least("a.p", "b.p") != F.greatest("a.q", "b.q"))
                    & (100 * F.least("a.high", "b.high") >= percent * F.greatest("a.low", "b.low")))
             .select(*[F.col(f"a.{c}") for c in key], F.col("a.block").alias("i"), F.col("b.block").alias("j")))
    sides = pairs.select("*", F.col("i").alias("block"), F.lit(0).alias("side")).unionAll(
        pairs.where("i < j").select("*", F.col("j").alias("block"), F.lit(1).alias("side")))
    cell = [*key, "i", "j"]
    rest = ["side", "node", "part", "n", *extra]
    dealt = (alone.select(*cell, F.lit(0).alias("side"), *rest[1:])
             .unionAll(sides.join(blocked, [*key, "block"]).select(*cell, *rest))
             .repartition(*cell).sortWithinPartitions(*cell, "side", "node"))
    width, keys = len(cell), len(key)
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("side", pa.int32()), ("node", pa.int64()), ("part", pa.int64())])

    def first_pass(batches):
        for name, rows in grouped(batches, keys + 2):
            keep = likely(name[:keys], rows)
            if keep.any():
                some = rows.filter(pa.array(keep)).select(range(width, width + 3))
                digest = xxhash.xxh3_128_intdigest(b"".join(np.ascontiguousarray(c.to_numpy()).tobytes() for c in some.columns[:2]))
                named = [pa.array(np.full(some.num_rows, d - (1 << 63))) for d in (digest >> 64, digest & ((1 << 64) - 1))]
                yield pa.RecordBatch.from_arrays([*named, *(c.combine_chunks() for c in some.columns)], schema=schema)

    # the same members often meet in many lists: cells go by what is left of them, so each is looked at once
    members = scratch(spark, dealt.mapInArrow(first_pass, "d1 long, d2 long, side int, node long, part long").distinct(),
                      f"{label}-members")
    discard(blocked)
    nodes = scratch(spark, members.select("node").distinct(), f"{label}-nodes")
    told = (members.join(sets_of(nodes), "node").select("d1", "d2", "side", "node", "part", "shingles")
            .repartition("d1", "d2").sortWithinPartitions("d1", "d2", "side", "node"))
    pair = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def second_pass(batches):
        for _, rows in grouped(batches, 2):
            found = spanning_links(rows, percent)
            if found:
                u, v = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=pair)

    links = scratch(spark, told.mapInArrow(second_pass, "u long, v long"), f"{label}-links", SETS)
    for table in (members, nodes):
        discard(table)
    return links


def sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the first and the second block (a block alone meets itself)."""
    side = rows.column("side").to_numpy()
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return a, b if len(b) else a


def spanning_links(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between the two blocks' components, as few as join all that are linked."""
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles").combine_chunks()]
    node, part = rows.column("node").to_pylist(), rows.column("part").to_pylist()
    a, b = sides(rows)
    if not len(a):
        return []
    n_a, n_b = np.array([len(sets[k]) for k in a]), np.array([len(sets[k]) for k in b])
    both = shared_counts([sets[k] for k in a], [sets[k] for k in b])
    top = {p: p for p in part}

    def root(p):
        while top[p] != p:
            top[p] = p = top[top[p]]
        return p

    out = []
    for x, y in zip(*np.nonzero(100 * both >= percent * (n_a[:, None] + n_b[None, :] - both)), strict=True):
        p, q = root(part[a[x]]), root(part[b[y]])
        if p != q:
            top[p] = q
            out.append((node[a[x]], node[b[y]]))
    return out
