"""Operator 13: Merkle manifest of a dataset, with a proof for every row.

A row's leaf is a sha256 of its fields; per language the leaves, ascending by
doc_id, form a binary tree, and the languages' roots form another one above.

* Leaves get their place by a range-partitioned sort and are cut into aligned
  blocks of 2^``BLOCK_LEVELS`` leaves; a block hashes its own subtree in one task.
* Butterfly exchange: in round r, blocks whose numbers differ in the r-th digit
  to the base 2^``FANOUT_LEVELS`` only form an aligned group.  They swap the roots of
  their subtrees, and each hashes the same ancestors.  After the last round every
  block holds the tree's root and all siblings on its way up, so nothing is
  sent down again.  Where the last subtree of a group has too few blocks, its
  blocks answer in turn for those that are missing.
* A block then writes the proofs of its leaves.

Defined results: a null field is ``-``; a null language is a language of its
own, before all others; null doc_ids come first within a language, rows that
share a doc_id are ordered by their leaf (equal rows in any order: they have
different proofs of one leaf); a null doc_id or a null n_chars is never
tampered; a tree of one leaf has that leaf as root and an empty proof; extra
columns are not part of a leaf; an empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.llm.common import discard, scratch, table

#: Leaves of a block and blocks of a butterfly group, as powers of two.
BLOCK_LEVELS, FANOUT_LEVELS = 10, 4
TAMPER = 7
TREE = ["known", "tree"]
_LOCAL_BITS = 33
_PATH = "array<struct<digest:string,left:boolean>>"
_STEP = pa.struct([("digest", pa.string()), ("left", pa.bool_())])


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def ascend(nodes: list[str], width: int, levels: int) -> list[list[str]]:
    """The levels above an aligned run of ``nodes`` in a level ``width`` nodes wide, up to its root or ``levels`` more."""
    rows = [nodes]
    while width > 1 and len(rows) <= levels:
        rows.append([digest(*rows[-1][k:k + 2]) for k in range(0, len(rows[-1]), 2)])
        width = -(-width // 2)
    return rows


def path_of(rows: list[list[str]], at: int) -> list[dict]:
    """What stands beside place ``at`` on each level but the last: a digest and its side, or nothing."""
    path = []
    for row in rows[:-1]:
        beside = at ^ 1
        path.append({"digest": row[beside] if beside < len(row) else None, "left": beside < at})
        at >>= 1
    return path


def fold(leaf: str, path: list[dict]) -> str:
    """The root that the leaf and its path give."""
    for step in path:
        other = step["digest"] or ""
        leaf = digest(other, leaf) if step["left"] else digest(leaf, other)
    return leaf


def proof_digest(path: list[dict]) -> str:
    return digest(*[step["digest"] for step in path if step["digest"]])


def leaf_of(n_chars: Column) -> Column:
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars),
                           field(F.col("text"))), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """known, tree (language), doc_id, leaf, tampered (leaf of the tampered row; null if not tampered), tie."""
    n_chars = F.col("n_chars").cast("long")
    hit = (F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0) & n_chars.isNotNull()
    return docs.select(
        F.col("lang").isNotNull().alias("known"), F.coalesce("lang", F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_of(n_chars).alias("leaf"),
        F.when(hit, leaf_of(n_chars + 1)).alias("tampered"), F.monotonically_increasing_id().alias("tie"))


def _placed(spark: SparkSession, leaves: DataFrame, order: list[str], label: str) -> DataFrame:
    """The leaves with ``pos`` (from 0, by ``order`` within the tree) and the tree's ``total``; no key in one task."""
    sort = [*TREE, *order]
    rows = scratch(spark, leaves.repartitionByRange(*sort).sortWithinPartitions(*sort)
                   .withColumn("row", F.monotonically_increasing_id()), f"{label}-sorted")
    rows = rows.withColumn("part", F.shiftright("row", _LOCAL_BITS))
    counts = rows.groupBy(*TREE, "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*TREE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(                                 # a row per partition, and per tree where more
        *TREE, "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(*TREE)).alias("total"))
    return (rows.join(offsets, [*TREE, "part"])
            .withColumn("pos", F.col("before") + F.col("row") - F.col("first")))


def _blocks(placed: DataFrame, carry: list[str], levels: int) -> DataFrame:
    """One row per aligned block: tree, block, total, members (2^``levels``) and the root ``node`` of its subtree."""
    grouped = (placed.groupBy(*TREE, F.shiftright("pos", levels).alias("block"), "total")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "leaf", *carry))).alias("members")))

    def run(batches):
        for batch in batches:
            totals, members = batch.column("total").to_pylist(), batch.column("members")
            nodes = [ascend([m["leaf"] for m in members[k].as_py()], total, levels)[-1][0]
                     for k, total in enumerate(totals)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.string())],
                                             names=[*batch.schema.names, "node"])

    return grouped.mapInArrow(run, StructType([*grouped.schema.fields, StructField("node", StringType())]))


def _swap(state: DataFrame, span: int, block_levels: int, levels: int) -> DataFrame:
    """One butterfly round over subtrees of ``span`` blocks: every block meets the roots of its group."""
    blocks = F.shiftright(F.col("total") - 1, block_levels) + 1
    group = F.floor(F.col("block") / (span << levels)) * (1 << levels)
    mine = F.floor(F.col("block") / span) - group
    digits = F.filter(F.sequence(F.lit(0), F.lit((1 << levels) - 1)),
                      lambda d: (d != mine) & ((group + d) * span < blocks))
    asked = state.select(*TREE, "block", "total", F.explode(digits).alias("digit")).withColumn(
        "first", (group + F.col("digit")) * span)
    answering = F.least(F.lit(span), blocks - F.col("first"))
    asked = asked.select(*TREE, F.col("block").alias("to"), "digit",
                         (F.col("first") + F.col("block") % span % answering).cast("long").alias("block"))
    met = (asked.join(state.select(*TREE, "block", "node"), [*TREE, "block"])
           .groupBy(*TREE, F.col("to").alias("block")).agg(F.collect_list(F.struct("digit", "node")).alias("met")))
    both = state.withColumn("mine", mine.cast("int")).join(met, [*TREE, "block"], "left")

    def run(batches):
        for batch in batches:
            nodes, paths = [], []
            for row in batch.select(["total", "node", "path", "mine", "met"]).to_pylist():
                roots = sorted([(row["mine"], row["node"]), *((m["digit"], m["node"]) for m in row["met"] or [])])
                width = ((row["total"] - 1 >> block_levels) + span) // span
                rows = ascend([node for _, node in roots], width, levels)
                nodes.append(rows[-1][0])
                paths.append(row["path"] + path_of(rows, row["mine"]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*TREE, "block", "total")), pa.array(nodes, pa.string()),
                 pa.array(paths, pa.list_(_STEP))],
                names=[*TREE, "block", "total", "node", "path"])

    return both.mapInArrow(run, f"known boolean, tree string, block long, total long, node string, path {_PATH}")


def forest(spark: SparkSession, leaves: DataFrame, order: list[str], carry: list[str], label: str,
           block_levels: int, levels: int) -> DataFrame:
    """known, tree, block, total, members (pos, leaf, ``carry``), root and ``path`` from the block's root to its tree's."""
    blocks = scratch(spark, _blocks(_placed(spark, leaves, order, label), carry, block_levels), f"{label}-blocks")
    most = blocks.agg(F.max("total")).first()[0] or 0
    state = blocks.select(*TREE, "block", "total", "node", F.expr(f"cast(array() as {_PATH})").alias("path"))
    span, written = 1, None
    while span << block_levels < most:
        last, written = written, scratch(spark, _swap(state, span, block_levels, levels), f"{label}-round")
        state, span = written, span << levels
        if last is not None:
            discard(last)
    return (blocks.select(*TREE, "block", "total", "members")
            .join(state.select(*TREE, "block", F.col("node").alias("root"), "path"), [*TREE, "block"]))


def manifest(docs: DataFrame, block_levels: int = BLOCK_LEVELS, levels: int = FANOUT_LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and the proof itself."""
    spark = docs.sparkSession
    leaves = scratch(spark, leaves_of(docs), "merkle-leaves")
    trees = scratch(spark, forest(spark, leaves, ["doc_id", "leaf", "tie"], ["doc_id", "tampered"], "merkle",
                                  block_levels, levels)
                    .withColumnRenamed("root", "subroot"), "merkle-trees")
    subroots = trees.where("block = 0").select(F.lit(True).alias("known"), F.lit("").alias("tree"),
                                               F.col("known").alias("lang_known"), F.col("tree").alias("lang"),
                                               F.col("subroot").alias("leaf"))
    lang = ["lang_known", "lang"]
    above = _paths(forest(spark, subroots, lang, lang, "merkle-top", block_levels, levels), block_levels)
    both = (trees.join(above, [trees.known == above.lang_known, trees.tree == above.lang])
            .select("total", "members", "subroot", "path", "above", "root"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                members, out = row["members"], []
                rows = ascend([m["leaf"] for m in members], row["total"], block_levels)
                for k, m in enumerate(members):
                    path = path_of(rows, k) + row["path"] + row["above"]
                    folded = fold(m["tampered"] or m["leaf"], path)
                    out.append((m["doc_id"], m["leaf"], row["subroot"], row["root"], proof_digest(path), folded,
                                folded == row["root"], [s["digest"] for s in path if s["digest"]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return both.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                "folded_root string, verified boolean, proof array<string>")


def _paths(trees: DataFrame, block_levels: int) -> DataFrame:
    """lang_known, lang, root and the path ``above`` of every language in the upper tree."""
    def run(batches):
        for batch in batches:
            for row in batch.select(["total", "members", "root", "path"]).to_pylist():
                members = row["members"]
                rows = ascend([m["leaf"] for m in members], row["total"], block_levels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m["lang_known"] for m in members], pa.bool_()),
                     pa.array([m["lang"] for m in members], pa.string()),
                     pa.array([row["root"]] * len(members), pa.string()),
                     pa.array([path_of(rows, k) + row["path"] for k in range(len(members))], pa.list_(_STEP))],
                    names=["lang_known", "lang", "root", "above"])

    return trees.mapInArrow(run, f"lang_known boolean, lang string, root string, above {_PATH}")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents")).drop("proof")


#: The tree level by level as a recursive query, siblings by position, proofs folded step by step.
ORACLE_SQL = """
WITH RECURSIVE fields AS (
  SELECT *, row_number() OVER () AS rid,
         list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
             string_split(CAST(doc_id AS VARCHAR), ''),
             lambda c: [ascii(c)::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT,
                        0::UBIGINT]))),
           lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384::UBIGINT)) AS crc
  FROM documents),
parts AS (
  SELECT rid, doc_id, lang, n_chars, coalesce(xor(crc, 4294967295::UBIGINT) % 7 = 0, false) AS hit,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM fields),
hashed AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN hit AND n_chars IS NOT NULL
              THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS tampered
  FROM parts),
d AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
low AS (
  SELECT lang, 0 AS lvl, pos AS idx, leaf AS h, n AS w FROM d
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, sha256(h || coalesce(nxt, '')), (w + 1) // 2
  FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY idx) AS nxt FROM low WHERE w > 1)
  WHERE idx % 2 = 0),
subroots AS (
  SELECT lang, lvl AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
         count(*) OVER () AS n
  FROM low WHERE w = 1),
high AS (
  SELECT 0 AS lvl, place AS idx, subroot AS h, n AS w FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(h || coalesce(nxt, '')), (w + 1) // 2
  FROM (SELECT *, lead(h) OVER (ORDER BY idx) AS nxt FROM high WHERE w > 1)
  WHERE idx % 2 = 0),
steps AS (   -- one row per leaf and level: the run's other member, if any
  SELECT d.rid, 0 AS phase, a.lvl, a.idx, b.h AS other
  FROM d JOIN low a ON a.lang IS NOT DISTINCT FROM d.lang AND a.idx = d.pos >> a.lvl AND a.w > 1
  LEFT JOIN low b ON b.lang IS NOT DISTINCT FROM a.lang AND b.lvl = a.lvl AND b.idx = xor(a.idx, 1)
  UNION ALL
  SELECT d.rid, 1, a.lvl, a.idx, b.h
  FROM d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang
  JOIN high a ON a.idx = s.place >> a.lvl AND a.w > 1
  LEFT JOIN high b ON b.lvl = a.lvl AND b.idx = xor(a.idx, 1)),
paths AS (
  SELECT rid, coalesce(string_agg(other, '' ORDER BY phase, lvl), '') AS siblings,
         list(CASE WHEN other IS NULL THEN '-' WHEN idx % 2 = 1 THEN 'L' || other ELSE 'R' || other END
              ORDER BY phase, lvl) AS way
  FROM steps GROUP BY rid),
folded AS (
  SELECT d.doc_id, d.leaf, s.subroot, (SELECT h FROM high WHERE w = 1) AS root,
         sha256(coalesce(p.siblings, '')) AS proof_sha256,
         list_reduce(list_concat([coalesce(d.tampered, d.leaf)], coalesce(p.way, CAST([] AS VARCHAR[]))),
           lambda a, x: sha256(CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root
  FROM d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang LEFT JOIN paths p USING (rid))
SELECT *, folded_root = root AS verified FROM folded
"""
