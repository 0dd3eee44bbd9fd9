"""Operator 11: groups of spelling variants by a dictionary of trie-node pairs.

Every node of the trie of all words, and of the trie of all reversed words, has
a number.  A word cut before its code point i is the pair (node of what stands
before, reversed node of what follows).  Two words are near

* by a replacement, if they agree in such a pair across one skipped position
  in each of them: (prefix node before i, suffix node after i);
* by an insertion, if the longer word's pair across its skipped position is the
  shorter word's pair without a gap.

So neighbours come from equality of integer pairs, exactly and without a
comparison of strings.  A pair is shared by at most one ungapped word (prefix
and suffix spell it) and one word per letter, so no group is large.  Of the
positions in a run of equal letters only the first counts as inserted, so each
neighbour is met once.

Numbering: words are range-partitioned and sorted; a partition numbers its nodes
in one pass (a prefix shared with the word before keeps its number).  Only
prefixes of a partition's first word can be met by two partitions; the
trie of these first words (one per partition) is numbered alike everywhere.

Defined results: null texts have no runs; a null doc_id deletes nothing; a run
that is empty after the deletion is no word; counts are those of occurrences, so
repeated rows count again; extra columns are ignored; no words give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, scratch, slices, table, text_of

MIN_LENGTH, MIN_COUNT, FACTOR, MUTATE = 5, 3, 2, 97
#: Letters of the runs, as given: ASCII letters and U+00C0 to U+00FF.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Words whose counts a task holds before it hands them on, and their characters.
HELD_WORDS, HELD_CHARS = 300_000, 8_000_000
_PART_BITS = 36


def word_of(doc_id: int | None, run: str) -> str:
    """The run, without one code point where the hash says so."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % MUTATE:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _counted(docs: DataFrame) -> DataFrame:
    """word, n: occurrences, added up as far as a task has seen them."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def full(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          schema=schema)

    def run(batches):
        held, chars = Counter(), 0
        for batch in batches:
            for part in slices(batch, 1, rows=256):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for letters, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
                        word = word_of(doc_id, letters)
                        if len(word) >= MIN_LENGTH:
                            if word not in held:
                                chars += len(word)
                            held[word] += n
                    if len(held) > HELD_WORDS or chars > HELD_CHARS:
                        yield full(held)
                        held, chars = Counter(), 0
        if held:
            yield full(held)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: words of enough code points and occurrences."""
    return _counted(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class Numbering:
    """Node numbers of sorted words; prefixes of ``firsts`` (in order) have the same number in every partition."""

    def __init__(self, firsts: list[str]):
        self.shared: dict[tuple[int, str], int] = {}
        for word in firsts:
            node = 0
            for letter in word:
                node = self.shared.setdefault((node, letter), -1 - len(self.shared))
        self.part = None

    def nodes(self, part: int, word: str) -> list[int]:
        """Numbers of the word's prefixes of one code point and more; words of a partition must ascend."""
        if part != self.part:
            self.part, self.next, self.last, self.path = part, part << _PART_BITS, "", []
        same = 0
        for a, b in zip(self.last, word):
            if a != b:
                break
            same += 1
        del self.path[same:]
        node = self.path[-1] if self.path else 0
        for letter in word[same:]:
            node = self.shared.get((node, letter)) if node <= 0 else None
            if node is None:
                self.next += 1
                node = self.next
            self.path.append(node)
        self.last = word
        return list(self.path)


def _numbered(spark: SparkSession, words: DataFrame, label: str) -> DataFrame:
    """``words`` (word, id, n) with ``nodes`` (numbers of its prefixes), ``starts`` (whether a letter differs from the
    one before) and ``place`` (ascending with the word)."""
    placed = scratch(spark, words.repartitionByRange("word").withColumn("part", F.spark_partition_id()), f"{label}-parts")
    firsts = [r.word for r in placed.groupBy("part").agg(F.min("word").alias("word")).collect()]   # a word per partition
    numbers = spark.sparkContext.broadcast(sorted(firsts))
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("nodes", pa.list_(pa.int64())),
                        ("starts", pa.list_(pa.bool_()))])

    def run(batches):
        numbering, part, k = Numbering(numbers.value), None, 0
        for batch in batches:
            for piece in slices(batch, 1, rows=4096, size=1_000_000):
                places, nodes, starts = [], [], []
                for p, word in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    part, k = p, k + 1 if p == part else 0
                    places.append((p << _PART_BITS) + k)
                    nodes.append(numbering.nodes(p, word))
                    starts.append([a != b for a, b in zip(word, " " + word)])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(2), piece.column(3), pa.array(places, pa.int64()),
                     pa.array(nodes, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.bool_()))], schema=schema)

    done = (placed.select("part", "word", "id", "n").repartition("part").sortWithinPartitions("part", "word")
            .mapInArrow(run, "id long, n long, place long, nodes array<long>, starts array<boolean>"))
    return scratch(spark, done, f"{label}-nodes")


def dictionary(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """prefix, suffix, gap (0 the whole word, 1 a skipped letter, 2 one that starts a run), place, n."""
    both = forward.join(backward.select("id", F.reverse("nodes").alias("back")), "id")
    # position i: prefix nodes[i] of i letters, and what follows after no letter or after letter i
    before = F.concat(F.array(F.lit(0).cast("long")), "nodes")
    after = F.concat("back", F.array(F.lit(0).cast("long")))
    rows = F.concat(
        F.transform(F.arrays_zip(before.alias("p"), after.alias("s")),
                    lambda x: F.struct(x.p.alias("prefix"), x.s.alias("suffix"), F.lit(0).alias("gap"))),
        F.transform(F.arrays_zip(F.slice(before, 1, F.size("nodes")).alias("p"),
                                 F.slice(after, 2, F.size("nodes")).alias("s"), F.col("starts").alias("f")),
                    lambda x: F.struct(x.p.alias("prefix"), x.s.alias("suffix"), F.when(x.f, 2).otherwise(1).alias("gap"))))
    return both.select("place", "n", F.explode(rows).alias("r")).select("r.*", "place", "n")


def near(pairs: DataFrame) -> DataFrame:
    """place, n_near, best (the near word of largest n, ties the first in order: n, place)."""
    member = F.struct(F.col("n"), (-F.col("place")).alias("before"), F.col("gap"))
    groups = (pairs.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("m"))   # a word per letter at most
              .where(F.size("m") > 1))
    def others(x):
        # an ungapped word meets the skipped letters that start a run; words with a skipped letter meet each other
        return F.filter("m", lambda y: (y.before != x.before) & F.when(x.gap == 0, y.gap == 2)
                        .otherwise((y.gap > 0) | (x.gap == 2)))
    met = groups.select(F.explode(F.transform("m", lambda x: F.struct(x.before, others(x).alias("o")))).alias("x"))
    met = met.where(F.size("x.o") > 0).select(
        (-F.col("x.before")).alias("place"), F.size("x.o").alias("k"),
        F.array_max(F.transform("x.o", lambda y: F.struct(y.n, y.before))).alias("best"))
    return met.groupBy("place").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """place, root: the end of the chain of forms; each round doubles the way (n at least doubles by a step)."""
    state = scratch(spark, forms.select("place", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = state.select(F.col("place").alias("root"), F.col("root").alias("beyond"))
        state, last = scratch(spark, state.join(onward, "root", "left").select(
            "place", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")),
            "spelling-roots"), state
        discard(last)
        if state.where("moved").isEmpty():
            return state.select("place", "root")
        state = state.select("place", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    spark = docs.sparkSession
    words = scratch(spark, vocabulary(docs).withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    forward = _numbered(spark, words.select("word", "id", "n"), "spelling-forward")
    backward = _numbered(spark, words.select(F.reverse("word").alias("word"), "id", "n"), "spelling-backward")
    found = scratch(spark, near(dictionary(forward, backward)), "spelling-near")
    named = forward.select("id", "place").join(words, "id").select("place", "word", "n")
    forms = (found.join(named.select("place", "n"), "place")
             .where(F.col("best.n") >= FACTOR * F.col("n")).select("place", (-F.col("best.before")).alias("form")))
    forms = scratch(spark, forms, "spelling-forms")
    roots = _roots(spark, forms)
    spelt = named.select(F.col("place").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    rooted = named.select(F.col("place").alias("root"), F.col("word").alias("root_word"))
    return (named.join(found.select("place", "n_near"), "place", "left")
            .join(forms.join(spelt, "form").select("place", "form_word", "form_n"), "place", "left")
            .join(roots.join(rooted, "root").select("place", "root_word"), "place", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS x FROM runs GROUP BY doc_id, run),
hashed AS (   -- crc32 of the UTF-8 bytes, bit by bit
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
             range(0, len(x) // 2), lambda k: [
               (16 * strpos('123456789ABCDEF', x[2 * k + 1]) + strpos('123456789ABCDEF', x[2 * k + 2]))::UBIGINT,
               0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT]))),
           lambda a, y: xor(xor(a, y) >> 1, (xor(a, y) & 1) * 3988292384::UBIGINT))) AS h
  FROM counted),
vocabulary AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
shorter AS (SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM vocabulary, unnest(range(0, length(word))) AS t(i)),
links AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT s.word, s.rest FROM shorter s JOIN vocabulary v ON v.word = s.rest
  UNION
  SELECT s.rest, s.word FROM shorter s JOIN vocabulary v ON v.word = s.rest),
best AS (
  SELECT l.word, count(*) AS n_near, first(l.other ORDER BY v.n DESC, l.other) AS other, max(v.n) AS other_n
  FROM links l JOIN vocabulary v ON v.word = l.other GROUP BY l.word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON b.word = v.word),
walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root AND forms.form IS NOT NULL)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk ON walk.word = f.word JOIN forms e ON e.word = walk.root AND e.form IS NULL
"""
