"""Operator 10: benchmark decontamination by BM25 with block-max WAND.

The benchmark's items become inverted indexes with BM25 weights, each item's
weights divided by its own total, so a passage that holds the item's words
scores up to 1.  Every text is cut into overlapping passages that are longer
than any item of the index; each passage is a query.  The root test of WAND
runs for all passages of a slice at once: the sum of the terms' block maxima,
with the frequent terms (never enough by themselves) taken as a constant per
block of items.  Passages with a block that can still reach ``MIN_SCORE`` run
block-max WAND for all items above it.  Every retrieved item is verified by
the word trigrams of its question and its answer (last sentence): both must be
in the passage; an item of a single sentence is checked as a whole.

Item texts are read to the driver in shards of at most ``SHARD_CHARS``
characters, one scan of the documents per shard, so what is broadcast has a
fixed bound.  Items of more words are in shards with longer passages.  The BM25
statistics (items, mean length, document frequencies) are those of the whole
benchmark, so an item's score does not depend on its shard.

Defined results: null and empty texts have no passage and no hit; items
without words are skipped; items with equal texts are each reported; repeated
rows give repeated hits; a null id is kept; extra columns are ignored; an
empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import Memo, map_rows, scratch, table, text_of

K1, B = 1.2, 0.75
MIN_SCORE = 0.5
#: Share of the question's and of the answer's trigrams that a passage must hold.
MIN_OVERLAP = 0.5
NGRAM = 3
BLOCK = 16
#: Blocks of items whose bounds are summed for all passages of a slice.
BOUND_BLOCKS = 256
#: Least distance of two passages' starts, in words, and words handled at once.
STRIDE = 32
SLICE_WORDS = 200_000
SHARD_CHARS = 16_000_000
SHORTEST = 64
_WORD = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.!?]+\s+")
RESULT = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
          "overlap double, n_passages int")


def _grams(words: list, n: int = NGRAM) -> set[tuple]:
    n = min(n, len(words))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before and in the last sentence; an item of a single sentence is both its question and its answer."""
    words = _WORD.findall(text.lower())
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    answer = _WORD.findall(text[ends[-1]:].lower()) if ends else []
    if not answer or len(answer) >= len(words):
        return words, words
    return words[:len(words) - len(answer)], answer


class ItemIndex:
    """BM25 postings of a shard of items with per-block maxima.

    ``stats``: number of items with words, their mean length and the document
    frequencies of the shard's terms, over the whole benchmark; without it the
    shard is the benchmark.
    """

    def __init__(self, items: list[tuple[int, str]], stats: tuple[int, float, dict[str, int]] | None = None):
        # items of similar length are neighbours: their weights, and so the block maxima, are alike
        items = sorted(((i, t) for i, t in items if _WORD.search(t)), key=lambda x: len(_WORD.findall(x[1])))
        self.ids = [i for i, _ in items]
        words = [_WORD.findall(t.lower()) for _, t in items]
        self.terms: dict[str, int] = {}
        for w in chain.from_iterable(words):
            self.terms.setdefault(w, len(self.terms) + 1)    # 0: not in any item
        self.longest = max(map(len, words), default=0)
        self.parts = []
        for _, t in items:
            q, a = ([self.terms[w] for w in part] for part in question_and_answer(t))
            self.parts.append((_grams(q), _grams(a), _grams(q if q == a else q + a)))
        n, mean = len(items), sum(map(len, words)) / max(1, len(words))
        df: dict[int, int] = {}
        counts = []
        for ws in words:
            c: dict[int, int] = {}
            for w in ws:
                c[self.terms[w]] = c.get(self.terms[w], 0) + 1
            counts.append(c)
            for t in c:
                df[t] = df.get(t, 0) + 1
        spread = n
        if stats:
            spread, mean = stats[:2]
            df = {t: stats[2][w] for w, t in self.terms.items()}
        postings: dict[int, list[tuple[int, float]]] = {}
        for k, (c, ws) in enumerate(zip(counts, words, strict=True)):
            weight = {t: np.log(1 + (spread - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1)
                      / (f + K1 * (1 - B + B * len(ws) / mean)) for t, f in c.items()}
            total = sum(weight.values())
            for t, w in weight.items():
                postings.setdefault(t, []).append((k, float(w / total)))
        self.items = {t: [k for k, _ in p] for t, p in postings.items()}
        self.weights = {t: [w for _, w in p] for t, p in postings.items()}
        self.block_max = {t: [max(w[k:k + BLOCK]) for k in range(0, len(w), BLOCK)] for t, w in self.weights.items()}
        self.bound = {t: max(w) for t, w in self.weights.items()}
        self._bounds(n, postings)

    def _bounds(self, n: int, postings: dict[int, list[tuple[int, float]]]) -> None:
        """Block maxima of the rare terms by term (start, count, block, weight), and what
        all frequent terms together can add to a block."""
        per = -(-max(1, n) // BOUND_BLOCKS)
        self.blocks = -(-max(1, n) // per)
        self.constant = np.zeros(self.blocks)
        self.count = np.zeros(len(self.terms) + 1, np.int64)
        block, weight = [], []
        for t in range(1, len(self.terms) + 1):
            best: dict[int, float] = {}
            for k, w in postings[t]:
                best[k // per] = max(best.get(k // per, 0.0), w)
            if len(best) > max(8, self.blocks // 16):
                for g, w in best.items():
                    self.constant[g] += w
            else:
                self.count[t] = len(best)
                block += best.keys()
                weight += best.values()
        self.start = np.concatenate([[0], np.cumsum(self.count)[:-1]])
        self.block, self.weight = np.array(block, np.int64), np.array(weight)

    def open_passages(self, words: np.ndarray, stride: int, width: int) -> np.ndarray:
        """Numbers of the passages (``width`` strides long, one per stride) that may hold an item."""
        n = -(-len(words) // stride)
        sums = self._sums(words, np.arange(len(words)) // stride, n)
        total = np.concatenate([np.zeros((1, self.blocks)), np.cumsum(sums, axis=0)])
        end = np.minimum(np.arange(n) + width, n)
        return np.flatnonzero(((total[end] - total[:n]) >= MIN_SCORE - 1e-9 - self.constant).any(axis=1))

    def may_hold(self, terms: np.ndarray) -> bool:
        """The same test with each distinct term counted once."""
        return bool((self._sums(terms, np.zeros(len(terms), np.int64), 1)[0]
                     >= MIN_SCORE - 1e-9 - self.constant).any())

    def _sums(self, words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Sums of the rare terms' block maxima by row (``at``) and block."""
        count = self.count[words]
        row = np.repeat(at, count)
        first = np.repeat(self.start[words] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        entry = first + np.arange(len(first))
        return np.bincount(row * self.blocks + self.block[entry], weights=self.weight[entry],
                           minlength=n * self.blocks).reshape(n, self.blocks)

    def retrieve(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """(item, score) of all items with a score of ``least`` or more, by block-max WAND."""
        end = len(self.ids)
        at = dict.fromkeys(terms, 0)                         # term -> place in its postings
        live = [t for t in at if t in self.items]
        out = []

        def current(t: int) -> int:
            return self.items[t][at[t]] if at[t] < len(self.items[t]) else end

        def seek(t: int, item: int) -> None:
            p, k = self.items[t], at[t]
            while k < len(p) and p[k] < item:                # whole blocks first
                k = k + BLOCK if k % BLOCK == 0 and k + BLOCK <= len(p) and p[k + BLOCK - 1] < item else k + 1
            at[t] = k

        while live:
            live = sorted((t for t in live if at[t] < len(self.items[t])), key=current)
            total, pivot = 0.0, None
            for k, t in enumerate(live):
                total += self.bound[t]
                if total >= least:
                    pivot = k
                    break
            if pivot is None:
                break
            item = current(live[pivot])
            while pivot + 1 < len(live) and current(live[pivot + 1]) == item:
                pivot += 1
            blocks, past = 0.0, end
            for t in live[:pivot + 1]:                       # the block of each list that may hold the item
                p, b = self.items[t], at[t] // BLOCK
                while (b + 1) * BLOCK <= len(p) and p[(b + 1) * BLOCK - 1] < item:
                    b += 1
                if b < len(self.block_max[t]):
                    blocks += self.block_max[t][b]
                    past = min(past, p[min(len(p), (b + 1) * BLOCK) - 1] + 1)
            if blocks < least:
                beyond = current(live[pivot + 1]) if pivot + 1 < len(live) else end
                for t in live[:pivot + 1]:
                    seek(t, max(item + 1, min(past, beyond)))
                continue
            for t in live[:pivot + 1]:
                seek(t, item)
            score = sum(self.weights[t][at[t]] for t in live[:pivot + 1] if current(t) == item)
            if score >= least:
                out.append((item, score))
            for t in live[:pivot + 1]:
                if current(t) == item:
                    at[t] += 1
        return out

    def verify(self, item: int, passage: set[tuple]) -> tuple[float, float, float]:
        """Shares of the question's, the answer's and all trigrams (shorter parts: the whole part) in the passage."""
        question, answer, both = self.parts[item]
        share = lambda g: len(g & passage) / len(g) if g else 1.0
        return share(question), share(answer), share(both)


def hits(index: ItemIndex, words: np.ndarray) -> dict[int, list]:
    """item -> [score, overlaps (question, answer, both), passages] of one text's verified items."""
    stride = max(STRIDE, index.longest // 4)
    width = -(-index.longest // stride) + 1
    out: dict[int, list] = {}
    for at in range(0, len(words), SLICE_WORDS - SLICE_WORDS % stride):
        limit = SLICE_WORDS - SLICE_WORDS % stride           # starts in this part; passages may reach beyond it
        part = words[at:at + limit + width * stride]
        for k in index.open_passages(part, stride, width):
            if k * stride >= limit:
                break
            passage = part[k * stride:(k + width) * stride]
            terms = np.unique(passage)
            if not index.may_hold(terms):
                continue
            passage = passage.tolist()
            found = index.retrieve(terms[terms > 0].tolist(), MIN_SCORE)
            grams = set().union(*(_grams(passage, n) for n in range(1, NGRAM + 1))) if found else None
            for item, score in found:
                q, a, both = index.verify(item, grams)
                if min(q, a) >= MIN_OVERLAP:
                    hit = out.setdefault(item, [score, q, a, both, 0])
                    hit[:4] = max(hit[:4], [score, q, a, both], key=lambda h: (h[3], h[0]))
                    hit[4] += 1
    return out


def search(docs: DataFrame, index: ItemIndex) -> DataFrame:
    """Verified hits of one shard's items; one row per document and item."""
    shared = docs.sparkSession.sparkContext.broadcast(index)         # built from at most SHARD_CHARS characters
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
                        ("overlap", pa.float64()), ("n_passages", pa.int32())])

    def run(batches):
        index = shared.value
        get = index.terms.get
        memo = Memo(lambda token: tuple(get(w, 0) for w in _WORD.findall(token.lower())))
        for batch in batches:
            memo.trim()
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = np.fromiter(chain.from_iterable(map(memo.__getitem__, text.as_py().split())), np.int32)
                if len(words):
                    rows += [(doc_id, index.ids[i], *h) for i, h in hits(index, words).items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, RESULT)


def _item_terms(cols: dict[str, list]) -> dict[str, list]:
    """The distinct terms of each item; its number of words stands with the null term."""
    out = {c: [] for c in ("half", "shard", "term", "n")}
    for half, shard, text in zip(cols["half"], cols["shard"], cols["text"], strict=True):
        words = _WORD.findall(text.lower())
        terms = [*set(words), None] if words else []
        out["half"] += [half] * len(terms)
        out["shard"] += [shard] * len(terms)
        out["term"] += terms
        out["n"] += [1] * (len(terms) - 1) + [len(words)] if words else []
    return out


def shards(benchmark: DataFrame):
    """(items, statistics of the benchmark for their terms) of bounded shards.

    Items of similar length share a shard, so their passages are not too long.
    """
    spark = benchmark.sparkSession
    items = benchmark.where("text is not null").select(
        "item_id", "text", F.size(F.split("text", "\\s+")).alias("words"), F.char_length("text").alias("chars"))
    items = items.withColumn("half", F.greatest(F.lit(SHORTEST), F.pow(
        F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1), F.col("words"))) + 0.001)).cast("int")))
    running = F.sum("chars").over(Window.partitionBy("half").orderBy("item_id", "text"))
    items = items.withColumn("shard", F.floor(running / SHARD_CHARS))
    terms = scratch(spark, map_rows(items.select("half", "shard", "text"), _item_terms,
                                    "half int, shard long, term string, n long"), "benchmark-terms")
    whole = terms.where("term is null").agg(F.count("*").alias("n"), F.avg("n").alias("mean")).first()
    df = scratch(spark, terms.where("term is not null").groupBy("term").agg(F.count("*").alias("df")), "benchmark-df")
    for r in items.groupBy("half", "shard").count().orderBy("half", "shard").collect():
        rows = items.where((F.col("half") == r.half) & (F.col("shard") == r.shard)).select("item_id", "text").collect()
        own = terms.where((F.col("half") == r.half) & (F.col("shard") == r.shard)).select("term").distinct()
        counted = df.join(own, "term").collect()             # terms of at most SHARD_CHARS characters
        yield [(x.item_id, x.text) for x in rows], (whole.n, whole.mean, {x.term: x.df for x in counted})


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, overlap, n_passages."""
    out = None
    for items, stats in shards(benchmark):
        found = search(docs, ItemIndex(items, stats))
        out = found if out is None else out.unionAll(found)
    return docs.sparkSession.createDataFrame([], RESULT) if out is None else out


def op10_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    ids = scratch(spark, found.select(F.col("doc_id").alias("hit__")).distinct(), "leaked-ids")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["hit__"]), "left_anti").select(*docs.columns)
