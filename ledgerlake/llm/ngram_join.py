"""Operator 8: exact Jaccard join of word 5-gram sets, size-aware heavy-light.

Documents with equal sets form one class; the join runs between class
representatives (smallest doc_id).

* Light sets (at most ``x`` shingles): for every size pair (a, b) that can
  reach the similarity, both sides enumerate their subsets of the fixed size
  ``c(a, b)``, the overlap that the similarity needs.  Sharing one *is* the
  link, so no verification follows.
* Heavy sets: inverted lists over the ``n - ceil(0.75 n) + 1`` first shingles
  in a global order, rare before frequent.  Members are paired with their
  list's leader and verified by exact intersection, so a list of copies costs
  its length.  Where a list's members are then still in several components, all
  pairs between components are looked at, in cells of two blocks
  (:mod:`ledgerlake.llm.cells`): no link between components is lost, and no pair is a row.
* The links themselves (``links=True``) are counted, not listed, as their
  number grows with the square of a group of near copies: linked sets are in one
  component, so a component is cut into blocks of about ``BLOCK`` sets by size,
  and for each pair of blocks whose sizes can reach the similarity one matrix
  product gives all exact intersections.  The components, and the stage,
  do without them.
* ``x`` is the size with the lowest total cost (``boundary``).

Defined results: null and empty texts have no shingles and link with nothing;
fewer words than five make one shingle; rows that share a doc_id stay rows of
their own, linked by their own texts; a null doc_id counts as smaller than all
ids; the stage keeps one row of each group, of the smallest doc_id (ties: the
smallest text hash); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.cells import links_between, open_members, sides
from ledgerlake.llm.common import Memo, discard, grouped, placed, possibly_in, scratch, shared_counts, slices, table, text_of
from ledgerlake.llm.components import components
from ledgerlake.llm.jaccard_sql import jaccard_sql

WORDS = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
PERCENT = 75
#: Frequency counters of the global order (fixed size at any scale), and how many make one row of them.
COUNTERS, CHUNK = 1 << 20, 4096
_SHIFT = np.uint64(64 - 20)
#: A shingle whose counter holds this many times the mean is dealt on the salted path.
HOT = 4.0
#: Largest boundary considered; a heavy row counts as this many light rows (list scan, verification).
MAX_LIGHT, HEAVY_ROW_COST = 10, 5
#: Weight of a block of sets that are compared at a time; a set weighs one, and one more per ``HEAVY`` shingles.
BLOCK, HEAVY = 256, 2000
#: Lists that a member names so that a pair is not looked at in each list that it shares.
FIRST, FEW = 32, 64
#: Texts that a Python worker gets at a time, and words whose hashes it keeps.
TEXTS, MEMO = 1000, 100_000
NO_ID = -(2**63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingle_hashes(text: str, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word 5-grams."""
    words = text.encode("utf-8", "surrogatepass").lower().split()      # bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    width = min(n, WORDS)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            out = (out ^ h[k:n - width + 1 + k]) * _ODD
            out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def parity_words(s: np.ndarray) -> np.ndarray:
    """Parity of the set's members in each of n to 2n hash slots, 64 slots a word.

    Sets differ in at least as many members as their parities do in slots.
    The wider of two words folds to the other's width by xor of its halves.
    """
    slots = 1 << max(6, int(max(1, len(s)) - 1).bit_length())
    odd = np.bincount((s & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def may_link(n1, bits1, n2, bits2):
    """Column: the parities do not rule the link out (sizes of linked sets fold at most once)."""
    def half(x):
        k = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), k), F.slice(x, k + 1, k), lambda p, q: p.bitwiseXOR(q))

    def differ(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, c: t + c)

    places = (F.when(F.size(bits1) == F.size(bits2), differ(bits1, bits2))
              .when(F.size(bits1) > F.size(bits2), differ(half(bits1), bits2)).otherwise(differ(bits1, half(bits2))))
    overlap = F.ceil(PERCENT * (n1 + n2) / (100 + PERCENT))
    return places <= n1 + n2 - 2 * overlap


def needed(a: int, b: int) -> int:
    """Least overlap of linked sets of sizes a and b."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def partners(n: int) -> range:
    """Sizes that a set linked with one of n shingles can have."""
    return range(-(-PERCENT * n // 100), 100 * n // PERCENT + 1)


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def boundary(sizes: dict[int, int]) -> int:
    """The x for which light subsets and heavy list rows cost least; ``sizes``: sets by size."""
    def light(x: int) -> int:
        return sum(sizes.get(n, 0) * sum(math.comb(n, needed(n, m)) for m in partners(n) if m <= x)
                   for n in range(1, x + 1))

    def heavy(x: int) -> int:      # light sets near the boundary are listed too
        return HEAVY_ROW_COST * sum(c * prefix_length(n) for n, c in sizes.items()
                                    if partners(n)[-1] > x)
    return min(range(MAX_LIGHT + 1), key=lambda x: light(x) + heavy(x))


def _arrow(df: DataFrame, run, schema: str) -> DataFrame:
    return df.mapInArrow(run, schema)


def _scan(docs: DataFrame) -> DataFrame:
    """(node, n, d1, d2, parity bits) per row, and a task's frequency counters (node: chunk, bits: counts; ``row`` false)."""
    memo = Memo(_word_hash, MEMO)
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("bits", pa.list_(pa.int64())), ("row", pa.bool_())])

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            memo.trim()
            for part in slices(batch, 1, rows=512):
                sets = [shingle_hashes(t, memo) for t in part.column(1).to_pylist()]
                digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                counts += np.bincount((np.concatenate(sets) >> _SHIFT).astype(np.int64), minlength=COUNTERS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([(d >> 64) - (1 << 63) for d in digests], pa.int64()),
                     pa.array([(d & ((1 << 64) - 1)) - (1 << 63) for d in digests], pa.int64()),
                     pa.array([parity_words(s) for s in sets], pa.list_(pa.int64())),
                     pa.array([True] * len(sets), pa.bool_())], schema=schema)
        for k in range(0, COUNTERS if counts.any() else 0, CHUNK):
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k // CHUNK], pa.int64()), none, none, none,
                 pa.array([counts[k:k + CHUNK]], pa.list_(pa.int64())), pa.array([False])], schema=schema)

    return _arrow(docs, run, "node long, n long, d1 long, d2 long, bits array<long>, row boolean")


def _frequencies(scanned: DataFrame) -> np.ndarray:
    """The tasks' counters added up: ``COUNTERS`` integers."""
    schema = pa.schema([("node", pa.int64()), ("counts", pa.binary())])

    def run(batches):
        for (k,), rows in grouped(batches, 1):
            total = np.zeros(CHUNK, np.int64)
            for part in rows.column("bits").combine_chunks():
                total += part.values.to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([total.tobytes()], pa.binary())], schema=schema)

    told = scanned.where("not row").select("node", "bits").repartition("node").sortWithinPartitions("node")
    out = np.zeros(COUNTERS, np.int64)
    for r in _arrow(told, run, "node long, counts binary").collect():        # COUNTERS / CHUNK rows
        out[r.node * CHUNK:(r.node + 1) * CHUNK] = np.frombuffer(r.counts, np.int64)
    return out


def _signatures(docs: DataFrame, counts: np.ndarray, x: int) -> DataFrame:
    """Rows of the lists (kind 0: token, node, n, pos, hot) and of the subsets (kind 1; pos: a * 1000 + b)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts)            # COUNTERS integers
    hot_from = max(2.0, HOT * counts.sum() / COUNTERS)
    memo = Memo(_word_hash, MEMO)
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()),
                        ("kind", pa.int8())])
    heavy_from = next(n for n in range(1, MAX_LIGHT + 2) if partners(n)[-1] > x)

    def subsets(s: np.ndarray, node: int):
        n = len(s)
        for m in partners(n):
            if m <= x:
                a, b = min(n, m), max(n, m)
                for c in itertools.combinations(s.tolist(), needed(a, b)):
                    key = xxhash.xxh3_64_intdigest(np.array((a, b, *c), np.uint64).tobytes())
                    yield key - (1 << 63), node, n, 1000 * a + b

    def run(batches):
        freq = shared.value
        for batch in batches:
            memo.trim()
            for part in slices(batch, 1, rows=512):
                tokens, nodes, sizes, pos, kinds, light = [], [], [], [], [], []
                for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    s = shingle_hashes(text, memo)
                    n = len(s)
                    if 0 < n <= x:
                        light += subsets(s, node)
                    if n >= heavy_from:
                        f = freq[(s >> _SHIFT).astype(np.int64)]
                        k = prefix_length(n)
                        order = np.argsort(f, kind="stable")[:k]       # s is sorted: ties in hash order
                        tokens.append(s[order].view(np.int64))
                        kinds.append(np.where(f[order] >= hot_from, 2, 0).astype(np.int8))
                        pos.append(np.arange(k, dtype=np.int32))
                        nodes.append(np.full(k, node, np.int64))
                        sizes.append(np.full(k, n, np.int32))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in (tokens, nodes, sizes, pos, kinds)], schema=schema)
                if light:
                    t, d, n, p = zip(*light, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(t, pa.int64()), pa.array(d, pa.int64()), pa.array(n, pa.int32()),
                         pa.array(p, pa.int32()), pa.array([1] * len(t), pa.int8())], schema=schema)

    return _arrow(docs, run, "token long, node long, n int, pos int, kind byte")


def _light_links(rows: DataFrame) -> DataFrame:
    """Star links of each shared subset: between the sizes a and b, each side with the other's smallest."""
    rows = rows.withColumn("side", F.when(F.col("n") == F.floor(F.col("pos") / 1000), 0).otherwise(1))
    low = rows.groupBy("token", "pos").agg(F.min(F.when(F.col("side") == 0, F.col("node"))).alias("m0"),
                                           F.min(F.when(F.col("side") == 1, F.col("node"))).alias("m1"),
                                           F.count("*").alias("c")).where("c > 1")
    same = F.col("pos") % 1000 == F.floor(F.col("pos") / 1000)
    return (rows.join(low, ["token", "pos"])
            .select(F.col("node").alias("u"),
                    F.when(same | (F.col("side") == 1), F.col("m0")).otherwise(F.col("m1")).alias("v"))
            .where("v is not null and u <> v").distinct())


def _lists(rows: DataFrame) -> DataFrame:
    """Inverted lists of two or more members, with each list's leader (earliest position, then id)."""
    leader = F.min(F.struct("pos", "node", "n"))
    cold = rows.where("kind = 0")
    by = Window.partitionBy("token")
    cold = cold.withColumn("size", F.count("*").over(by)).where("size > 1").withColumn("leader", leader.over(by))
    hot = rows.where("kind = 2")
    found = hot.groupBy("token").agg(F.count("*").alias("size"), leader.alias("leader")).where("size > 1")
    hot = hot.join(found, "token")                           # large lists: AQE splits their join
    columns = ["token", "node", "n", "pos", "size", "leader"]
    return cold.select(columns).unionAll(hot.select(columns))


def _possible(n1, p1, n2, p2):
    """Size filter, and the overlap that two sets sharing the shingle at these positions can still reach."""
    most = F.least(p1, p2) + F.least(n1 - p1, n2 - p2)
    return ((100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2))
            & ((100 + PERCENT) * most >= PERCENT * (n1 + n2)))


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles (sorted 64-bit hashes as bytes) of the given nodes."""
    memo = Memo(_word_hash, MEMO)
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            memo.trim()
            for some in slices(batch, 1, rows=256):
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([shingle_hashes(t, memo).tobytes()
                                               for t in some.column(1).to_pylist()], pa.binary())], schema=schema)

    return _arrow(possibly_in(docs, nodes, "node").join(nodes, "node", "left_semi"), run, "node long, shingles binary")


def _screen(bits: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that their parities do not rule out (exact: no link is lost)."""
    side = lambda c: bits.select(F.col("node").alias(c), F.struct("n", "bits").alias(f"s{c}"))
    both = pairs.join(side("v"), "v").join(side("u"), "u")
    return both.where(may_link(F.col("su.n"), F.col("su.bits"), F.col("sv.n"), F.col("sv.bits"))).select("u", "v").distinct()


def _verify(spark: SparkSession, docs: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """The pairs (u, v) whose sets reach the similarity."""
    nodes = scratch(spark, pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), f"{label}-nodes")
    sets = scratch(spark, _sets_of(docs, nodes), f"{label}-sets", TEXTS)
    with_v = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
    both = with_v.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")

    def run(batches):
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())),
                                              batch.column(1).filter(pa.array(keep, pa.bool_()))], schema=schema)

    links = scratch(spark, _arrow(both.select("u", "v", "su", "sv"), run, "u long, v long"), f"{label}-links", TEXTS)
    discard(nodes)
    discard(sets)
    return links


def keyed(documents: DataFrame) -> DataFrame:
    """The documents with a number per row; written, so the numbers stay what they are."""
    return scratch(documents.sparkSession, documents.withColumn("row__", F.monotonically_increasing_id()), "ngram-docs")


def near_groups(rows_of: DataFrame, links: bool = False) -> DataFrame:
    """node, doc, n_shingles, class_id, component_id (nodes) of every row of ``rows_of`` (node, doc, text).

    A class is the rows with one set, a component what links reach; either is
    named by its smallest node.  With ``links`` also n_links: to how many other
    classes the row's class is linked.
    """
    spark = rows_of.sparkSession
    docs = rows_of.select("node", "text")
    scanned = scratch(spark, _scan(docs), "ngram-scan", TEXTS)
    counts = _frequencies(scanned)
    rows = scanned.where("row").select("node", "n", "d1", "d2")
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("node").alias("class_id"), F.min("n").alias("n"))
    classes = scratch(spark, classes, "ngram-classes")
    small = classes.where(F.col("n") <= 2 * MAX_LIGHT).groupBy("n").count().collect()
    x = boundary({r.n: r["count"] for r in small})
    member = rows.join(classes.select("d1", "d2", "class_id"), ["d1", "d2"], "left")
    member = scratch(spark, member.select("node", "n", F.when(F.col("n") > 0, F.col("class_id"))
                                          .otherwise(F.col("node")).alias("class_id")), "ngram-members")
    copies = scratch(spark, member.where("node <> class_id").select("node"), "ngram-copies")
    heads = possibly_in(docs, copies, "node", absent=True).unionAll(
        possibly_in(docs, copies, "node").join(copies, "node", "left_anti"))

    signatures = scratch(spark, _signatures(heads, counts, x), "ngram-signatures", TEXTS)
    light = _light_links(signatures.where("kind = 1")) if x else None
    lists = scratch(spark, _lists(signatures), "ngram-lists")
    bits = scanned.where("row").select("node", "n", "bits")
    pairs = (lists.where(F.col("node") != F.col("leader.node"))
             .where(_possible(F.col("n"), F.col("pos"), F.col("leader.n"), F.col("leader.pos")))
             .select(F.col("leader.node").alias("u"), F.col("node").alias("v")).distinct())
    pairs = scratch(spark, _screen(bits, pairs), "ngram-pairs")
    verified = _verify(spark, docs, pairs, "ngram-1")
    first = scratch(spark, verified if light is None else verified.unionAll(light), "ngram-links")
    for told in (signatures, pairs, verified):
        discard(told)
    parts = scratch(spark, components(spark, first), "ngram-parts")
    found = _between(spark, docs, lists, bits, parts)
    if not found.isEmpty():
        stars = parts.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
        parts = scratch(spark, components(spark, stars.unionAll(found)), "ngram-parts")
    grouped = (member.join(parts.withColumnRenamed("node", "class_id"), "class_id", "left")
               .select("node", F.col("n").alias("n_shingles"), "class_id",
                       F.coalesce("component", "class_id").alias("component_id"))
               .join(rows_of.select("node", "doc"), "node"))
    if not links:
        return grouped
    heads_in = parts.join(classes.select(F.col("class_id").alias("node"), "n"), "node")
    return (grouped.join(_degrees(spark, docs, heads_in).withColumnRenamed("node", "class_id"), "class_id", "left")
            .withColumn("n_links", F.coalesce("n_links", F.lit(0))))


def _between(spark: SparkSession, docs: DataFrame, lists: DataFrame, bits: DataFrame, parts: DataFrame) -> DataFrame:
    """Links (u, v) that join the components which still meet in a list (lists of two are settled by their leader)."""
    opened = scratch(spark, open_members(lists.where("size > 2").select("token", "node", "n", "pos", "size"), ["token"], parts,
                                         HEAVY), "ngram-open")
    discard(lists)
    # in large lists a pair is looked at once: in the first one that its members tell to share (FIRST of each are told)
    large = opened.where(F.col("size") > FEW)
    first = large.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FIRST).alias("first"))
    # what a node tells joins its rows at once: the rows are shuffled before they carry it
    told = bits.select("node", "bits").join(first, "node", "left")
    members = opened.join(told, "node").withColumn("first", F.when(F.col("size") > FEW, F.col("first"))).drop("size")
    members = scratch(spark, members, "ngram-members")
    discard(opened)
    links = links_between(spark, members, ["token"], PERCENT, BLOCK, HEAVY, _likely_members,
                          lambda nodes: _sets_of(docs, nodes), "ngram-cells")
    discard(members)
    return links


def _likely_members(name: tuple, rows: pa.Table) -> np.ndarray:
    """Which members have a partner of another component, met in this list first, that parities and positions allow."""
    token = name[0]
    part, n, pos = (rows.column(c).to_numpy() for c in ("part", "n", "pos"))
    packed = rows.column("bits").combine_chunks()
    words, ends = packed.values.to_numpy().view(np.uint64), packed.offsets.to_numpy()
    bits = [words[ends[k]:ends[k + 1]] for k in range(rows.num_rows)]
    a, b = sides(rows)
    met = None
    if rows.column("first").null_count < rows.num_rows:
        earlier = [np.array([t for t in ts or () if t < token], np.int64) for ts in rows.column("first").to_pylist()]
        met = shared_counts([earlier[k] for k in a], [earlier[k] for k in b])
    keep = np.zeros(rows.num_rows, bool)
    # parities by width: those of linked sets differ by one halving at most
    widths = np.array([len(x) for x in bits])
    folded = {}

    def at_width(w: int) -> tuple[np.ndarray, np.ndarray]:
        """Members whose parities have ``w`` words, or ``2 w`` and are folded."""
        if w not in folded:
            some = np.flatnonzero((widths == w) | (widths == 2 * w))
            folded[w] = some, np.stack([x if len(x) == w else x[:w] ^ x[w:] for x in (bits[k] for k in some)])
        return folded[w]

    in_b = np.zeros(rows.num_rows, np.int64) - 1
    in_b[b] = np.arange(len(b))
    for x, k in enumerate(a):
        for w in {int(widths[k]), int(widths[k]) // 2} - {0}:
            some, wide = at_width(w)
            mine = bits[k] if len(bits[k]) == w else bits[k][:w] ^ bits[k][w:]
            # of two members, the narrower one's width counts
            ok = (in_b[some] >= 0) & (part[some] != part[k]) & (np.minimum(widths[some], widths[k]) == w)
            if a is b:
                ok &= some > k
            ok &= 100 * np.minimum(n[some], n[k]) >= PERCENT * np.maximum(n[some], n[k])
            most = np.minimum(pos[some], pos[k]) + np.minimum(n[some] - pos[some], n[k] - pos[k])
            ok &= (100 + PERCENT) * most >= PERCENT * (n[some] + n[k])
            y = np.flatnonzero(ok)
            if met is not None:
                y = y[met[x, in_b[some[y]]] == 0]
            if len(y):
                both = n[some[y]] + n[k]
                least = -(-PERCENT * both // (100 + PERCENT))
                y = y[np.bitwise_count(wide[y] ^ mine).sum(axis=1) <= both - 2 * least]
                keep[some[y]] = True
                keep[k] |= len(y) > 0
    return keep


def _degrees(spark: SparkSession, docs: DataFrame, heads: DataFrame) -> DataFrame:
    """node, n_links of classes (node, component, n) of components with links."""
    sizes = heads.groupBy("component").agg(F.count("*").alias("c"))
    heads = scratch(spark, heads.join(sizes, "component"), "ngram-heads")
    two = heads.where("c = 2").select("node", F.lit(1).cast("long").alias("n_links"))       # linked, or no component
    many = heads.where("c > 2").select("component", "n", "node")
    at = placed(spark, many, ["component"], ["n", "node"], 1 + F.floor(F.col("n") / HEAVY), "ngram-placed")
    at = scratch(spark, at.select("component", "node", "n", F.floor(F.col("offset") / BLOCK).alias("block")), "ngram-blocks")
    blocks = at.groupBy("component", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = blocks.alias("a"), blocks.alias("b")
    couples = (a.join(b, (F.col("a.component") == F.col("b.component")) & (F.col("a.block") <= F.col("b.block"))
                      & (100 * F.col("a.high") >= PERCENT * F.col("b.low")))
               .select("a.component", F.col("a.block").alias("i"), F.col("b.block").alias("j")))
    sides = couples.select("component", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionAll(
        couples.where("i < j").select("component", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side")))
    wanted = scratch(spark, at.select("node"), "ngram-many")
    sets = _sets_of(docs, wanted).join(at, "node")
    key = ["component", "i", "j"]
    dealt = (sides.join(sets, ["component", "block"]).select(*key, "side", "node", "shingles")
             .repartition(*key).sortWithinPartitions(*key, "side"))
    schema = pa.schema([("node", pa.int64()), ("n_links", pa.int64())])

    def run(batches):
        last, held = None, ([], [])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(5)]
            for c, i, j, side, node, s in zip(*columns, batch.column(5), strict=True):
                if (c, i, j) != last:
                    if last is not None:
                        yield _counted(*held, schema)
                    last, held = (c, i, j), ([], [])
                held[side].append((node, np.frombuffer(s.as_py(), np.uint64)))
        if last is not None:
            yield _counted(*held, schema)

    counted = _arrow(dealt, run, "node long, n_links long").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    return scratch(spark, counted.unionAll(two), "ngram-degrees", TEXTS)


def _counted(a: list, b: list, schema: pa.Schema) -> pa.RecordBatch:
    """How many links each set of two blocks (or, without ``b``, of one) has between them."""
    other = b or a
    n_a, n_b = np.array([len(s) for _, s in a]), np.array([len(s) for _, s in other])
    shared = shared_counts([s for _, s in a], [s for _, s in other])
    linked = 100 * shared >= PERCENT * (n_a[:, None] + n_b[None, :] - shared)
    nodes, found = [node for node, _ in a], linked.sum(axis=1)
    if b:
        nodes, found = nodes + [node for node, _ in b], np.concatenate([found, linked.sum(axis=0)])
    else:
        found = found - 1                                    # itself
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.int64())], schema=schema)


def _nodes(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col("row__").alias("node"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
                           text_of().alias("text"))


def labelled(documents: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles, class_id, component_id (smallest doc_id of either), n_links."""
    groups = scratch(documents.sparkSession, near_groups(_nodes(keyed(documents.select("doc_id", "text"))), links=True),
                     "ngram-groups")
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))

    def smallest(key: str, out: str) -> DataFrame:
        return groups.where("n_shingles > 0").groupBy(key).agg(F.min("doc").alias(out))

    named = groups.join(smallest("class_id", "class_doc"), "class_id", "left").join(
        smallest("component_id", "component_doc"), "component_id", "left")
    return (named.withColumn("class_doc", F.coalesce("class_doc", "doc"))
            .withColumn("component_doc", F.coalesce("component_doc", "doc"))
            .select(back("doc").alias("doc_id"), "n_shingles", back("class_doc").alias("class_id"),
                    back("component_doc").alias("component_id"), "n_links"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(table(spark, sf_dir, "documents"))


def stage_ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate group, of the smallest id; empty documents stay."""
    numbered = keyed(docs)
    nodes = _nodes(numbered)
    groups = scratch(spark, near_groups(nodes).where("n_shingles > 0").select("node", "component_id"), "ngram-groups")
    place = F.struct("doc", "hash", "node")
    ranked = groups.join(nodes.select("node", "doc", F.xxhash64("text").alias("hash")), "node")
    first = ranked.groupBy("component_id").agg(F.min(place)["node"].alias("first"))
    gone = groups.join(first, "component_id").where("node <> first").select(F.col("node").alias("row__"))
    gone = scratch(spark, gone, "ngram-gone")
    return possibly_in(numbered, gone, "row__", absent=True).unionAll(
        possibly_in(numbered, gone, "row__").join(gone, "row__", "left_anti").select(numbered.columns)).select(*docs.columns)


#: Links from counted common shingles, components from reachability, classes from sorted sets.
ORACLE_SQL = jaccard_sql(WORDS, PERCENT) + """,
classes AS (
  SELECT doc_id, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(s)) END AS class_id
  FROM sets),
degrees AS (
  SELECT a.doc_id, count(DISTINCT b.class_id) AS n_links
  FROM edges JOIN classes a ON a.doc_id = edges.u JOIN classes b ON b.doc_id = edges.v
  WHERE a.class_id <> b.class_id GROUP BY a.doc_id)
SELECT reach.doc_id, n_shingles, class_id, component_id, coalesce(n_links, 0) AS n_links
FROM reach JOIN classes USING (doc_id) LEFT JOIN degrees USING (doc_id)
"""
