"""Operator 9: quality by random indexing and a two-layer network in numpy.

Every token falls into one of ``VOCABULARY`` hashed words with a sparse
ternary index vector.  One pass over all documents sums the index vectors of
the neighbours of every occurrence; the mean context, centred and normalised,
is the word's vector.  A second pass pools word vectors per document (mean,
spread, mean step between neighbours).  A two-layer network is trained on at
most ``TRAIN_ROWS`` labelled documents, and its logits are divided by a
temperature fitted on a validation part.

Defined results: a null text is empty, an empty text has all-zero features;
without labelled rows of both classes every score is the class share (0.5
without labels); rows keep their number, repeated rows get equal scores;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import Memo, crc_mod, map_rows, scratch, table, text_of
from ledgerlake.llm.labelled import Adam, labelled_ids, log_loss, sigmoid

VOCABULARY, DIM, NONZERO, WINDOW = 1 << 14, 32, 4, 2
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, MIN_STEPS = 32, 30, 1500
CUT = 0.7
_PIECE = re.compile(r"\w+|[^\w\s]+")


def index_vectors(seed: int = 3) -> np.ndarray:
    """Sparse ternary vectors of the hashed words; the last row is the empty pad."""
    r = np.random.default_rng(seed)
    out = np.zeros((VOCABULARY + 1, DIM), np.float32)
    for _ in range(NONZERO):
        out[np.arange(VOCABULARY), r.integers(0, DIM, VOCABULARY)] += r.choice([-1.0, 1.0], VOCABULARY)
    return out


def _token(token: str) -> tuple[int, ...]:
    return tuple(xxhash.xxh32_intdigest(p) % VOCABULARY for p in _PIECE.findall(token.lower()))


def sequence(text: str, memo: Memo) -> np.ndarray:
    return np.fromiter(chain.from_iterable(map(memo.__getitem__, text.split())), np.int32)


def context_sums(docs: DataFrame) -> DataFrame:
    """word, n, context (sums of neighbours' index vectors) over all documents; one row a word and task."""
    memo = Memo(_token)
    schema = pa.schema([("word", pa.int32()), ("n", pa.int64()), ("context", pa.list_(pa.float32()))])

    def run(batches):
        index = index_vectors()
        total, count = np.zeros((VOCABULARY + 1, DIM)), np.zeros(VOCABULARY + 1, np.int64)
        pad = np.full(WINDOW, VOCABULARY, np.int32)
        for batch in batches:
            memo.trim()
            for at in range(0, batch.num_rows, 128):
                texts = batch.slice(at, 128).column(0).to_pylist()
                flat = np.concatenate([pad, *(x for t in texts for x in (sequence(t, memo), pad))])
                vectors = index[flat]
                around = np.zeros_like(vectors)
                for k in range(1, WINDOW + 1):
                    around[k:] += vectors[:-k]
                    around[:-k] += vectors[k:]
                count += np.bincount(flat, minlength=VOCABULARY + 1)
                for d in range(DIM):
                    total[:, d] += np.bincount(flat, weights=around[:, d], minlength=VOCABULARY + 1)
        there = np.flatnonzero(count[:VOCABULARY])
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(count[there], pa.int64()),
             pa.array(list(total[there].astype(np.float32)), pa.list_(pa.float32()))], schema=schema)

    parts = docs.select(text_of().alias("text")).mapInArrow(run, "word int, n long, context array<float>")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.col("context")[d].cast("double")) for d in range(DIM)]).alias("context"))


def word_vectors(docs: DataFrame) -> np.ndarray:
    rows = context_sums(docs).collect()                      # at most VOCABULARY rows
    out = np.zeros((VOCABULARY + 1, DIM), np.float32)
    for r in rows:
        out[r.word] = np.array(r.context) / r.n
    seen = np.array(sorted(r.word for r in rows), int)
    if len(seen):
        n = np.array([r.n for r in sorted(rows, key=lambda r: r.word)])
        out[seen] -= np.average(out[seen], axis=0, weights=n)
        out[seen] /= np.maximum(1e-6, np.linalg.norm(out[seen], axis=1, keepdims=True))
    return out


def pool(sequences: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and mean absolute step of the word vectors of each document."""
    sizes = np.array([len(s) for s in sequences])
    pad = np.full(1, VOCABULARY, np.int32)
    flat = np.concatenate([x for s in sequences for x in (s, pad)])
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    v = vectors[flat]
    step = np.zeros_like(v)
    np.abs(np.diff(v, axis=0), out=step[:-1])
    for k in (start + sizes, np.maximum(start, start + sizes - 1)):
        step[k] = 0                                          # no step into or out of the pad
    n = np.maximum(1, sizes)[:, None]
    mean = np.add.reduceat(v, start, axis=0) / n
    spread = np.sqrt(np.maximum(0, np.add.reduceat(v * v, start, axis=0) / n - mean * mean))
    return np.concatenate([mean, spread, np.add.reduceat(step, start, axis=0) / np.maximum(1, n - 1)], 1)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """doc_id, features (float32 bytes)."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)       # VOCABULARY x DIM floats
    memo = Memo(_token)

    def run(cols: dict[str, list]) -> dict[str, list]:
        memo.trim()
        x = pool([sequence(t, memo) for t in cols["text"]], shared.value).astype("<f4")
        return {"doc_id": cols["doc_id"], "features": [row.tobytes() for row in x]}

    return map_rows(docs.select("doc_id", text_of().alias("text")), run, "doc_id long, features binary", rows=128)


class QualityNet:
    def __init__(self, width: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.w1 = (r.standard_normal((width, HIDDEN)) * np.sqrt(2 / width)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, np.float32)
        self.w2 = (r.standard_normal(HIDDEN) * np.sqrt(2 / HIDDEN)).astype(np.float32)
        self.b2 = np.zeros(1, np.float32)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        self.temperature, self.constant = 1.0, None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-4
        x = (x - self.mean) / self.scale
        adam = Adam([self.w1, self.b1, self.w2, self.b2], 0.003)
        r, size = np.random.default_rng(2), 128
        for _ in range(max(EPOCHS, -(-MIN_STEPS * size // len(y)))):
            order = r.permutation(len(y))
            for at in range(0, len(y), size):
                xb, yb = x[order[at:at + size]], y[order[at:at + size]]
                h = xb @ self.w1 + self.b1
                a = np.maximum(h, 0)
                slope = ((sigmoid(a @ self.w2 + self.b2) - yb) / len(yb)).astype(np.float32)
                back = np.outer(slope, self.w2) * (h > 0)
                adam.step([xb.T @ back + 1e-3 * self.w1, back.sum(0), a.T @ slope + 1e-3 * self.w2,
                           np.array([slope.sum()], np.float32)])

    def fit_temperature(self, z: np.ndarray, y: np.ndarray) -> None:
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        self.temperature = float(min(grid, key=lambda t: log_loss(sigmoid(z / t), y, np.ones_like(z))))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return sigmoid(self.logits(x).astype(np.float64) / self.temperature)


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f4").reshape(len(blobs), 3 * DIM)


def fit(features: DataFrame, labels: DataFrame, label: str, allowed: Column) -> QualityNet:
    ids, totals = labelled_ids(features, labels, label, allowed, TRAIN_ROWS, balanced=False)
    net = QualityNet(3 * DIM)
    if len(totals) < 2:
        net.constant = 0.5 if not totals else float(next(iter(totals)))
        return net
    rows = (features.join(F.broadcast(ids), "doc_id")        # at most TRAIN_ROWS ids
            .groupBy("doc_id", "y").agg(F.min("features").alias("features")).collect())
    rows.sort(key=lambda r: xxhash.xxh32_intdigest(str(r.doc_id)))
    x, y = _matrix([r.features for r in rows]), np.array([r.y for r in rows], np.float32)
    check = np.arange(len(y)) % 5 == 0
    net.train(x[~check], y[~check])
    net.fit_temperature(net.logits(x[check]), y[check])
    return net


def held_out() -> Column:
    """The fold that training never sees."""
    return F.coalesce(crc_mod(4) == 2, F.lit(False))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score."""
    features = scratch(spark, pooled(docs, word_vectors(docs)), "quality-features")
    net = spark.sparkContext.broadcast(fit(features, labels, "quality", ~held_out()))

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "score": net.value.scores(_matrix(cols["features"]))}

    return map_rows(features, run, "doc_id long, score double", rows=4096)


def op9_quality_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
