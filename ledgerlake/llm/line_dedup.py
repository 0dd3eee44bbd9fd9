"""Operator 2: repeated passages, by content-defined chunks of lines.

A text is cut into lines, and a line after its sentence ends, so a passage
inside a paragraph is found too.  A chunk starts at such a piece and takes whole
pieces until it has ``MIN_WORDS`` words.  Which pieces start a chunk is
decided by content: a rolling hash over the hashes of the pieces gives every
possible chunk a value, and the smallest among the starts within any stretch
of ``STRETCH`` words is a boundary (a piece of ``MIN_WORDS`` words and more is a
chunk of its own).  What stands around a passage moves none of the boundaries
inside it, and a repeated passage of ``MIN_WORDS + STRETCH`` words has
at least one chunk in common with its first occurrence, however its pieces
are long.  Shorter ones of ``MIN_WORDS`` and more are found if one of their
chunks is chosen (97 % of random runs of 20 to 49 words).

Chunks that occur before (in a smaller doc_id, or earlier in the same text) are
copies.  The text around each first occurrence (a *segment*: its chunks and
as many words before and after as boundaries can be away) is brought to the documents that repeat it;
there the pieces are compared byte by byte, and the match is extended piece by piece
to both sides as far as the texts agree.  All pieces of such runs are removed.

Defined results: the first occurrence stays; null and empty texts have no
piece; pieces without words are never copies and stay, but do not end a run;
a null doc_id counts as smaller than all ids; rows that share a doc_id are
rows of their own, in the order of their text's hash, but identical rows count
as one place and all stay; extra columns are kept by the stage; an empty table
gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, possibly_in, scratch, slices, table, text_of

MIN_WORDS, STRETCH = 20, 10
#: Words around a segment's chunks: a run goes on at most so far beyond its outermost boundaries.
AROUND = 100
NO_ID = -(2**63)
_SENTENCE = re.compile(r"(?<=[.!?]) ")
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def pieces(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether it has words) of the pieces, in order.

    Lines are cut after sentence ends; the separators ("\\n" or " ") belong to
    no piece.
    """
    if not text:
        return []
    out, at = [], 0
    for line in text.split("\n"):
        for piece in _SENTENCE.split(line):
            end = at + len(piece)
            out.append((at, end, end > at and not piece.isspace()))
            at = end + 1
    return out


def worded(text: str) -> list[str]:
    """The pieces with words, in order."""
    return [p for line in text.split("\n") for p in _SENTENCE.split(line) if p and not p.isspace()]


def piece_hash(piece: str) -> int:
    return xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass"))


class _Powers:
    """Powers of the rolling hash's base and of its inverse, modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (self._first(max(n, 2 * len(self.up)), base) for base in (_BASE, _INVERSE))

    @staticmethod
    def _first(n: int, base: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        with np.errstate(over="ignore"):
            return np.cumprod(factors, dtype=np.uint64)


_POWERS = _Powers()


def rough_words(piece: str) -> int:
    return piece.count(" ") + 1


def chunk_ends(words: np.ndarray) -> np.ndarray:
    """For every piece the end (exclusive) of the chunk that starts there; len + 1 where words are too few."""
    upto = np.concatenate([[0], np.cumsum(words)])
    return np.searchsorted(upto, upto[:-1] + MIN_WORDS, "left")


def chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the chunks of a text's worded pieces."""
    n = len(texts)
    words = np.fromiter(map(rough_words, texts), np.int64, n)
    if words.sum() < MIN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = chunk_ends(words)
    whole = ends <= n
    _POWERS.to(n + 1)
    with np.errstate(over="ignore"):
        lines = np.fromiter(map(piece_hash, texts), np.uint64, n)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines * _POWERS.up[:n], dtype=np.uint64)])
        rolled = (upto[np.minimum(ends, n)] - upto[:n]) * _POWERS.down[:n]
        rolled = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        rolled ^= rolled >> np.uint64(29)
    rolled[~whole] = _NONE
    before = np.concatenate([[0], np.cumsum(words)[:-1]])
    to = np.searchsorted(before, before + STRETCH, "right")
    least = np.minimum.reduceat(np.append(rolled, _NONE), np.stack([np.arange(n), to], 1).ravel())[::2]
    chosen = whole & (np.isin(rolled, least) | (words >= MIN_WORDS))
    starts = np.flatnonzero(chosen)
    return starts, rolled[starts].view(np.int64)


def _occurrences(docs: DataFrame) -> DataFrame:
    """doc, text_hash, pos, h of every chunk (pos counts the worded pieces)."""
    schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()), ("h", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                found = [chunks(worded(t)) for t in part.column(2).to_pylist()]
                times = np.array([len(s) for s, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(0).to_numpy(), times)),
                     pa.array(np.repeat(part.column(1).to_numpy(), times)),
                     pa.array(np.concatenate([s for s, _ in found]).astype(np.int32)),
                     pa.array(np.concatenate([h for _, h in found]))], schema=schema)

    return docs.mapInArrow(run, "doc long, text_hash long, pos int, h long")


def segments(texts: list[str], starts: list[int]) -> list[tuple[int, int, list[int]]]:
    """(first piece, end, starts inside) of the parts of a text that hold the chunks at ``starts`` and what is around."""
    words = np.fromiter(map(rough_words, texts), np.int64, len(texts))
    upto = np.concatenate([[0], np.cumsum(words)])
    starts = np.array(sorted(starts))
    ends = np.minimum(chunk_ends(words)[starts], len(texts))
    low = np.maximum(np.searchsorted(upto, upto[starts] - AROUND, "right") - 1, 0)
    high = np.minimum(np.searchsorted(upto, upto[ends] + AROUND, "left"), len(texts))
    out: list[tuple[int, int, list[int]]] = []
    for s, a, b in zip(starts.tolist(), low.tolist(), high.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), [*out[-1][2], s])
        else:
            out.append((a, b, [s]))
    return out


def _segments(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """doc, text_hash, starts, low and the pieces of the segments around first occurrences (``firsts``: starts by row)."""
    wanted = possibly_in(docs, firsts.select("text_hash"), "text_hash").join(firsts, ["doc", "text_hash"])
    schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("low", pa.int32()),
                        ("starts", pa.list_(pa.int32())), ("pieces", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, rows=256):
                out = []
                for doc, h, text, starts in zip(*(part.column(c).to_pylist() for c in range(4)), strict=True):
                    texts = worded(text)
                    out += [(doc, h, a, found, texts[a:b]) for a, b, found in segments(texts, starts)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return (wanted.select("doc", "text_hash", "text", "starts")
            .mapInArrow(run, "doc long, text_hash long, low int, starts array<int>, pieces array<string>"))


def runs(texts: list[str], matches: list[dict]) -> dict[int, int]:
    """Worded piece -> first doc_id, for the pieces of repeated runs.

    ``matches``: segments (doc, low: their first piece's place, pieces) and the
    places (pos here, at there) of the chunks in them.
    """
    out: dict[int, int] = {}
    for m in matches:
        there, low, doc = m["pieces"], m["low"], m["doc"]
        reached: dict[int, int] = {}                         # distance of the two texts' places -> end of the last run
        for here, at in sorted((place["pos"], place["at"] - low) for place in m["places"]):
            line = here - at
            if here < reached.get(line, 0):
                continue
            if not (at < len(there) and here < len(texts) and texts[here] == there[at]):
                continue                                     # another text of the same hash
            a, b = here, here + 1
            least, most = max(0, line), min(len(texts), len(there) + line)
            while a > least and texts[a - 1] == there[a - 1 - line]:
                a -= 1
            while b < most and texts[b] == there[b - line]:
                b += 1
            reached[line] = b
            words = 0
            for t in texts[a:b]:
                words += len(t.split())
                if words >= MIN_WORDS:
                    break
            if words >= MIN_WORDS:
                for k in range(a, b):
                    if doc < out.get(k, doc + 1):
                        out[k] = doc
    return out


def _matches(docs: DataFrame) -> DataFrame:
    """doc, text_hash and ``matches`` (see ``runs``) of every row with copies; docs: doc, text_hash, text."""
    spark = docs.sparkSession
    key = ["doc", "text_hash"]
    occurrences = scratch(spark, _occurrences(docs), "lines-chunks")
    shared = scratch(spark, occurrences.groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct(*key, "pos")).alias("first"))
                     .where("c > 1").select("h", "first"), "lines-shared")
    # both sides come from files, so a chunk with very many places is split over tasks
    copies = scratch(spark, occurrences.join(shared, "h").where(F.struct(*key, "pos") > F.col("first"))
                     .select(*key, "pos", "first"), "lines-copies")
    firsts = (copies.select("first").distinct().select("first.*").groupBy(*key)
              .agg(F.collect_set("pos").alias("starts")))    # bounded by the text itself
    found = scratch(spark, _segments(docs, firsts).withColumn("segment", F.monotonically_increasing_id()), "lines-segments")
    places = found.select(F.col("doc").alias("f_doc"), F.col("text_hash").alias("f_hash"),
                          F.explode("starts").alias("f_pos"), "segment")
    met = (copies.select(*key, "pos", F.col("first.doc").alias("f_doc"), F.col("first.text_hash").alias("f_hash"),
                         F.col("first.pos").alias("f_pos"))
           .join(places, ["f_doc", "f_hash", "f_pos"])
           .groupBy(*key, "segment").agg(F.collect_set(F.struct("pos", F.col("f_pos").alias("at"))).alias("places")))
    met = scratch(spark, met, "lines-met")
    discard(occurrences)
    discard(shared)
    discard(copies)
    source = found.select("segment", F.col("doc").alias("s_doc"), "low", "pieces")
    return (met.join(source, "segment")
            .groupBy(*key).agg(F.collect_list(F.struct(F.col("s_doc").alias("doc"), "low", "pieces", "places"))
                             .alias("matches")))


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _removed(text: str, matches: list[dict]) -> list[tuple[int, int, int, int]]:
    """(start, end, words, first doc_id) of the pieces to remove."""
    spans = [(a, b) for a, b, has_words in pieces(text) if has_words]
    texts = [text[a:b] for a, b in spans]
    return [(*spans[k], len(texts[k].split()), doc) for k, doc in sorted(runs(texts, matches).items())]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """node (doc_id; ``NO_ID`` for null), start, end (code points), words, first_node of every piece to remove."""
    keyed = _keyed(docs)
    matches = scratch(docs.sparkSession, _matches(keyed), "lines-matches")
    rows = possibly_in(keyed, matches.select("text_hash"), "text_hash").join(matches, ["doc", "text_hash"])
    schema = pa.schema([("node", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()),
                        ("first_node", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, rows=64):
                out = [(doc, *span) for doc, text, m in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True)
                       for span in _removed(text, m)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return rows.select("doc", "text", "matches").mapInArrow(run, "node long, start int, end int, words int, first_node long")


def op2_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return repeated_spans(table(spark, sf_dir, "documents")).select(
        back("node").alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        F.col("words").cast("long").alias("n_words"), back("first_node").alias("first_doc_id"))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans and the separator that follows each."""
    out, at = [], 0
    for a, b in sorted(set(spans)):
        out.append(text[at:a])
        at = max(at, min(len(text), b + 1))
    out.append(text[at:])
    return "".join(out)


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated runs cut out of the texts and n_chars brought up to date; no row goes.

    A row's spans are found on its own text, so rows that share a doc_id never
    touch one another.
    """
    spark = docs.sparkSession
    matches = scratch(spark, _matches(_keyed(docs)), "lines-matches").select(
        F.col("doc").alias("doc__"), F.col("text_hash").alias("hash__"), "matches")
    names = docs.columns
    keyed = docs.withColumn("doc__", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("hash__", F.xxhash64(text_of()))
    same = ["doc__", "hash__"]
    touched = possibly_in(keyed, matches.select("hash__"), "hash__").join(
        matches.withColumnRenamed("matches", "matches__"), same, "left").select(*names, "matches__")
    text, found = names.index("text"), len(names)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, rows=64):
                before = part.column(text).to_pylist()
                after = [t if not m else cut(t, [(a, b) for a, b, _, _ in _removed(t, m)])
                         for t, m in zip(before, part.column(found).to_pylist(), strict=True)]
                columns = [part.column(c) for c in range(found)]
                columns[text] = pa.array(after, columns[text].type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    columns[k] = pa.array([n if a is b or a == b else len(b) for n, a, b in zip(
                        columns[k].to_pylist(), before, after, strict=True)], columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    untouched = possibly_in(keyed, matches.select("hash__"), "hash__", absent=True).select(*names)
    return untouched.unionAll(touched.mapInArrow(run, docs.schema))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove(docs)
