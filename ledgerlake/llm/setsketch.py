"""Operator 12: near-duplicate documents by SetSketch registers.

A document's set is its distinct word 3-grams.  A sketch holds ``REGISTERS``
integers: register i is the truncated logarithm (base ``BASE``) of the smallest
of the set's i-th hash values, so the spacing is exponential.  The sketch of a union is the register-wise
maximum (``merge``), and the share of equal registers grows with the
similarity.

1. Rows with equal sets form one class, which has one sketch.
2. Four neighbouring registers are a band.  Linked sets (similarity 0.85) share
   none of the ``REGISTERS`` / 4 bands once in about 2e10 pairs.
3. Of a candidate pair the joint likelihood of the registers, given both set
   sizes, estimates the similarity; pairs that are ``MARGIN`` below the best
   log-likelihood at 0.85 (once in 1e7 linked pairs) go no further.
   The others are verified on their full sets.
4. First every class meets the smallest class of its bands only, so a group of
   copies costs its length.  Where members of a band are then still in several
   components, all pairs between components are looked at: a large band is cut into
   blocks of about ``BLOCK`` members, a task takes two blocks, compares
   registers, then full sets by a matrix product, and
   returns a spanning set of the links, never pairs.  No candidate pair
   between components is left out.
5. Components of the links follow.

Defined results: null and empty texts and texts without words have no
shingles and link with nothing; fewer words than three make one shingle; rows
that share a doc_id stay rows of their own, linked by their own texts; a null
doc_id counts as smaller than all ids (component_id null); equal rows
have equal results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.cells import links_between, open_members, sides
from ledgerlake.llm.common import Memo, discard, possibly_in, scratch, slices, table, text_of
from ledgerlake.llm.components import components
from ledgerlake.llm.jaccard_sql import jaccard_sql

WORDS = 3
#: Similarity as a percentage: 100 * intersection >= 85 * union.
PERCENT = 85
#: Sketch parameters: number of registers, base of the logarithm, rate of the exponential values, largest register.
REGISTERS, BASE, RATE, TOP = 128, 1.001, 20.0, (1 << 16) - 1
#: Registers of a band: four of 16 bits are one long.
BAND = 4
#: Log-likelihood by which 0.85 may fall short of the estimate.
MARGIN = 14.0
#: Weight of a block of a band's members; a member weighs one, and one more per ``HEAVY`` shingles.
BLOCK, HEAVY = 512, 2000
#: Pairs of a cell whose registers are compared at a time.
PAIRS = 8192
NO_ID = -(2**63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.random.default_rng(12).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = np.random.default_rng(13).integers(0, 1 << 32, REGISTERS, dtype=np.uint32)


#: k log(k / REGISTERS) of k registers.
_MOST = np.arange(REGISTERS + 1) * np.log(np.maximum(np.arange(REGISTERS + 1), 1) / REGISTERS)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingles(text: str, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word 3-grams."""
    words = text.encode("utf-8", "surrogatepass").lower().split()      # bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    width = min(n, WORDS)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = (out ^ h[k:n - width + 1 + k]) * _ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


def registers_of(minima: np.ndarray) -> np.ndarray:
    """32-bit minima -> registers: the exponential value's logarithm, truncated."""
    x = -np.log1p(-(minima + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP).astype("<u2")


def sketch(s: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set of 64-bit hashes."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    h = (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), 2048):                        # bounded memory for very long texts
        values = h[at:at + 2048, None] * _MULTIPLIERS + _OFFSETS
        low = np.minimum(low, values.min(axis=0))
    return registers_of(low)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def _log_likelihood(j, more, less, same, u, v):
    """Of the similarity j: ``more`` / ``less`` registers are larger in the first / second set, ``same`` are equal."""
    def larger(x):
        return -np.log1p(-np.clip(x, 0, 1) * ((BASE - 1) / BASE)) / math.log(BASE)

    p, q = larger(u - v * j), larger(v - u * j)
    with np.errstate(divide="ignore", invalid="ignore"):
        return (np.where(more > 0, more * np.log(p), 0) + np.where(less > 0, less * np.log(q), 0)
                + np.where(same > 0, same * np.log(np.maximum(1 - p - q, 1e-300)), 0))


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, how far below its log-likelihood the threshold's is) of pairs of sketches (rows) and set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    low, high = np.zeros_like(most), most.copy()
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(40):                                      # the likelihood has one peak
        x, y = high - golden * (high - low), low + golden * (high - low)
        left = _log_likelihood(x, more, less, same, u, v) >= _log_likelihood(y, more, less, same, u, v)
        low, high = np.where(left, low, x), np.where(left, y, high)
    best = (low + high) / 2
    at = np.minimum(PERCENT / 100, most)
    short = _log_likelihood(best, more, less, same, u, v) - _log_likelihood(at, more, less, same, u, v)
    return best, np.where(best >= at, 0.0, np.where(np.isnan(short), np.inf, short))


def may_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Which pairs ``similarity`` puts at most ``MARGIN`` below, mostly without its search.

    The likelihood has one peak, so a likelier value below the threshold (the share of
    equal registers is next to the peak) rules a pair out; no likelihood
    exceeds that of the observed shares, which lets a pair pass.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    at = np.minimum(PERCENT / 100, np.minimum(u / v, v / u))
    near = same / a.shape[1]
    with np.errstate(invalid="ignore"):
        here = _log_likelihood(at, more, less, same, u, v)
        out = (near < at) & (_log_likelihood(np.minimum(near, at), more, less, same, u, v) - here > MARGIN)
    keep = _MOST[more] + _MOST[less] + _MOST[same] - here <= MARGIN
    open_ = np.flatnonzero(~(out | keep))
    if len(open_):
        keep[open_] = similarity(a[open_], b[open_], n_a[open_], n_b[open_])[1] <= MARGIN
    return keep & ~out


def _scan(docs: DataFrame) -> DataFrame:
    """doc, text_hash, n, d1, d2 (digest of the set) and registers of every row."""
    memo = Memo(_word_hash)
    schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()),
                        ("d2", pa.int64()), ("registers", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                memo.trim()
                n, d1, d2, registers = [], [], [], []
                for text in part.column(2).to_pylist():
                    s = shingles(text, memo)
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    n.append(len(s))
                    d1.append((d >> 64) - (1 << 63))
                    d2.append((d & ((1 << 64) - 1)) - (1 << 63))
                    registers.append(sketch(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in (n, d1, d2)),
                     pa.array(registers, pa.binary())], schema=schema)

    return docs.mapInArrow(run, "doc long, text_hash long, n long, d1 long, d2 long, registers binary")


def _bands(classes: DataFrame) -> DataFrame:
    """band, key (its registers), node, n."""
    count = REGISTERS // BAND
    schema = pa.schema([("band", pa.int16()), ("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(count, dtype=np.int16), batch.num_rows)), pa.array(keys),
                 pa.array(np.repeat(batch.column(0).to_numpy(), count)),
                 pa.array(np.repeat(batch.column(1).to_numpy(), count))], schema=schema)

    return classes.select("node", "n", "registers").mapInArrow(run, "band short, key long, node long, n long")


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _likely(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose registers leave 0.85 likely enough."""
    def side(c: str) -> DataFrame:
        return classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))

    both = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "n_u", "n_v", "r_u", "r_v")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in (4, 5))
                keep = pa.array(may_reach(a, b, *(part.column(c).to_numpy().astype(float) for c in (2, 3))))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], schema=schema)

    return both.mapInArrow(run, "u long, v long")


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles (sorted 64-bit hashes as bytes) of the given classes, from the text of their representative."""
    wanted = nodes.join(classes, "node").select("node", "doc", "text_hash")
    slots = possibly_in(docs, wanted.select("text_hash"), "text_hash")
    memo = Memo(_word_hash)
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, rows=256):
                memo.trim()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shingles(t, memo).tobytes() for t in part.column(1).to_pylist()],
                                              pa.binary())], schema=schema)

    found = slots.join(wanted, ["doc", "text_hash"]).select("node", "text")
    return found.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _verified(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity, written to the shared folder."""
    nodes = scratch(spark, pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "sketch-nodes")
    sets = scratch(spark, _full_sets(docs, classes, nodes), "sketch-sets")
    both = (pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
            .join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], schema=schema)

    links = scratch(spark, both.select("u", "v", "su", "sv").mapInArrow(run, "u long, v long"), "sketch-links")
    discard(nodes)
    discard(sets)
    return links


def _between(spark: SparkSession, docs: DataFrame, classes: DataFrame, shared: DataFrame, parts: DataFrame) -> DataFrame:
    """Links (u, v) that join the components which still meet in a band."""
    key = ["band", "key"]
    opened = open_members(shared.select(*key, "node", "n"), key, parts, HEAVY).join(classes.select("node", "registers"), "node")
    opened = scratch(spark, opened, "sketch-open")
    links = links_between(spark, opened, key, PERCENT, BLOCK, HEAVY, lambda name, rows: _likely_members(rows, name[0]),
                          lambda nodes: _full_sets(docs, classes, nodes), "sketch")
    discard(opened)
    return links


def _likely_members(rows: pa.Table, band: int) -> np.ndarray:
    """Which members have a partner of another component, met in this band first, that may reach the similarity."""
    registers = np.frombuffer(b"".join(rows.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
    keys = registers.view("<i8")
    part, n = rows.column("part").to_numpy(), rows.column("n").to_numpy()
    a, b = sides(rows)
    keep = np.zeros(rows.num_rows, bool)
    some = max(1, PAIRS // len(b)) if len(b) else 1
    for at in range(0, len(a), some):                        # about PAIRS pairs at a time
        x = a[at:at + some, None]
        ok = (part[b] != part[x]) & (100 * np.minimum(n[b], n[x]) >= PERCENT * np.maximum(n[b], n[x]))
        if a is b:
            ok &= b > x
        x, y = np.nonzero(ok)
        x, y = a[at + x], b[y]
        new = ~(keys[x, :band] == keys[y, :band]).any(axis=1)
        x, y = x[new], y[new]
        likely = may_reach(registers[x], registers[y], n[x].astype(float), n[y].astype(float))
        keep[x[likely]] = keep[y[likely]] = True
    return keep


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest doc_id reachable)."""
    spark = documents.sparkSession
    docs = documents.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), text_of().alias("text")).select(
        "doc", F.xxhash64("text").alias("text_hash"), "text")
    rows = scratch(spark, _scan(docs), "sketch-rows")
    classes = scratch(spark, rows.where("n > 0").groupBy("d1", "d2")
                      .agg(F.min(F.struct("doc", "text_hash")).alias("at"), F.first("n").alias("n"),
                           F.first("registers").alias("registers"))
                      .select("d1", "d2", "at.*", "n", "registers", F.monotonically_increasing_id().alias("node")),
                      "sketch-classes")
    bands = scratch(spark, _bands(classes), "sketch-bands")
    groups = scratch(spark, bands.groupBy("band", "key").agg(F.count("*").alias("c"), F.min(F.struct("node", "n")).alias("low"))
                     .where("c > 1"), "sketch-groups")
    shared = scratch(spark, bands.join(groups, ["band", "key"]), "sketch-shared")
    first = (shared.where((F.col("node") != F.col("low.node")) & _sizes_fit(F.col("n"), F.col("low.n")))
             .groupBy(F.col("node").alias("v")).agg(F.min("low.node").alias("u")).select("u", "v"))
    tested = scratch(spark, first, "sketch-pairs")
    links = _verified(spark, docs, classes, scratch(spark, _likely(classes, tested), "sketch-likely"))
    parts = scratch(spark, components(spark, links), "sketch-parts")
    found = _between(spark, docs, classes, shared, parts)
    if not found.isEmpty():
        stars = parts.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
        parts = scratch(spark, components(spark, stars.unionAll(found)), "sketch-parts")
    discard(bands)
    discard(shared)
    lowest = (classes.join(parts, "node").groupBy("component").agg(F.min("doc").alias("low")))
    low = classes.join(parts, "node", "left").join(lowest, "component", "left").select(
        "d1", "d2", F.coalesce("low", "doc").alias("low"))
    return rows.join(low, ["d1", "d2"], "left").select(
        _id("doc").alias("doc_id"), F.col("n").alias("n_shingles"), _id(F.coalesce("low", "doc")).alias("component_id"))


def _id(value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value != NO_ID, value)


def op12_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = jaccard_sql(WORDS, PERCENT) + """
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM reach
"""
