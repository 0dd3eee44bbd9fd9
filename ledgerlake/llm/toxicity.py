"""Operator 3: toxicity by a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed vectors of the word, its prefixes and
its suffixes, so inflected forms share most of it.  Filters of several widths
run over the whole word sequence; each filter's maximum over the document
feeds a logistic output, calibrated on a validation part of the sample at the
natural class shares.  Decision thresholds are calibrated by language and
applied after scoring; a score itself depends on the text alone.

Training uses at most ``TRAIN_ROWS`` labelled documents (half of each class,
in the order of an id hash) and ``TRAIN_CHARS`` characters of whole texts; a
text over the remaining allowance is left out of training.  Scoring reads
every text whole.

Defined results: a null text is empty and scored like any text; without
labelled rows of both classes every score is the class share (0 without
labels); rows keep their order and number, repeated rows get equal scores;
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

from ledgerlake.llm.common import Memo, crc_mod, scratch, slices, table, text_of
from ledgerlake.llm.labelled import Adam, labelled_ids, log_loss, sigmoid

TRAIN_ROWS = 6000
TRAIN_CHARS = 24_000_000
BUCKETS, DIM = 1 << 15, 16
WIDTHS, FILTERS = (1, 2, 3), 8
BATCH, MIN_STEPS, EPOCHS = 64, 500, 4
CUT = 0.7
#: Validation rows of each class that a language needs for a threshold of its own.
MIN_LANGUAGE = 15
_WORD = re.compile(r"[^\W_]+")


def subwords(word: str) -> list[int]:
    """Buckets of the word, its prefixes and its suffixes of three to five letters."""
    parts = ["=" + word, *("<" + word[:k] for k in (3, 4, 5)), *(">" + word[-k:] for k in (3, 4, 5))]
    return [1 + xxhash.xxh32_intdigest(p) % (BUCKETS - 1) for p in parts]


#: Texts above this many characters are split into words piece by piece.
LONG_TEXT = 1_000_000
_TOKEN = re.compile(r"\S+")


class Lexicon:
    """White-space token -> indices of its words; word 0 is the pad."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.buckets: list[list[int]] = [[0] * 7]            # of the words that ``take`` has not taken yet
        self.tokens = Memo(self._token)

    def _token(self, token: str) -> tuple[int, ...]:
        out = []
        for w in _WORD.findall(token.lower()):
            k = self.words.get(w)
            if k is None:
                k = self.words[w] = len(self.words) + 1
                self.buckets.append(subwords(w))
            out.append(k)
        return tuple(out)

    def sequence(self, text: str) -> np.ndarray:
        tokens = text.split() if len(text) <= LONG_TEXT else (m.group() for m in _TOKEN.finditer(text))
        return np.fromiter(chain.from_iterable(map(self.tokens.__getitem__, tokens)), np.int32)

    def take(self) -> np.ndarray:
        """Buckets of the words met since the last call, the pad first of all."""
        new, self.buckets = np.array(self.buckets, np.int32).reshape(-1, 7), []
        return new


#: Words of one stretch of a sequence; longer texts are pooled stretch by stretch.
STRETCH = 1 << 16


def lay_out(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents one after the other, each followed by three pads; (start, end) pairs of window starts."""
    pad = np.zeros(3, np.int32)
    flat = np.concatenate([x for s in sequences for x in (s, pad)])
    sizes = np.array([len(s) for s in sequences])
    start = np.concatenate([[0], np.cumsum(sizes + 3)[:-1]])
    return flat, np.stack([start, start + sizes + 1], axis=1)


def stretches(sequence: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(words, window starts) of pieces that have all windows of the padded sequence between them."""
    padded, starts = np.concatenate([sequence, np.zeros(3, np.int32)]), len(sequence) + 1
    return [(padded[at:min(at + STRETCH, starts) + 2], min(STRETCH, starts - at)) for at in range(0, starts, STRETCH)]


class TextCnn:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.table = (r.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        self.table[0] = 0
        self.kernels = [(r.standard_normal((w, DIM, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = (r.standard_normal(len(WIDTHS) * FILTERS) * 0.3).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.a, self.b, self.constant = 1.0, 0.0, None
        self.thresholds: dict[str, float] = {"": CUT}

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        return self.table[buckets].sum(axis=1)

    def project(self, vectors: np.ndarray) -> list[list[np.ndarray]]:
        """Every word's response at every place of every width."""
        return [[vectors @ k[j] for j in range(len(k))] for k in self.kernels]

    @staticmethod
    def convolve(parts: list[np.ndarray], flat: np.ndarray) -> np.ndarray:
        conv = parts[0][flat]
        for j in range(1, len(parts)):
            conv[:-j] += parts[j][flat[j:]]
        return conv

    def pooled(self, projected, flat: np.ndarray, spans: np.ndarray) -> np.ndarray:
        cuts = spans.ravel()
        cuts = cuts[:-1] if cuts[-1] >= len(flat) else cuts
        return np.concatenate([np.maximum.reduceat(self.convolve(p, flat), cuts, axis=0)[::2] for p in projected], 1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.shift

    def train(self, buckets: np.ndarray, sequences: list[np.ndarray], y: np.ndarray) -> None:
        params = [self.table, *self.kernels, self.bias, self.out, self.shift]
        adam, r = Adam(params, 0.01), np.random.default_rng(1)
        steps = -(-len(y) // BATCH)
        for _ in range(max(EPOCHS, -(-MIN_STEPS // steps))):
            order = r.permutation(len(y))
            for at in range(0, len(y), BATCH):
                adam.step(self._gradients(buckets, [sequences[k] for k in order[at:at + BATCH]],
                                          y[order[at:at + BATCH]]))

    def _gradients(self, buckets: np.ndarray, sequences: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
        flat, spans = lay_out(sequences)
        words, flat = np.unique(flat, return_inverse=True)   # word 0 is there, so pads stay first
        vectors = self.embed(buckets[words])
        vectors[0] = 0
        places, tops = [], []
        for parts in self.project(vectors):
            conv = self.convolve(parts, flat)
            best = np.stack([a + conv[a:b].argmax(axis=0) for a, b in spans])
            places.append(best)
            tops.append(conv[best, np.arange(FILTERS)])
        hidden = np.concatenate(tops, 1) + self.bias
        active = np.maximum(hidden, 0)
        slope = (sigmoid(active @ self.out + self.shift) - y) / len(y)
        back = np.outer(slope, self.out) * (hidden > 0)
        grad_vectors, kernels = np.zeros_like(vectors), []
        for n, (kernel, best) in enumerate(zip(self.kernels, places, strict=True)):
            part = back[:, n * FILTERS:(n + 1) * FILTERS]
            grad = np.zeros_like(kernel)
            for j in range(len(kernel)):
                at = flat[best + j]                          # documents x filters
                grad[j] = np.einsum("bfd,bf->df", vectors[at], part)
                np.add.at(grad_vectors, at, part[:, :, None] * kernel[j].T[None])
            kernels.append(grad + 1e-4 * kernel)
        grad_table = np.zeros_like(self.table)
        np.add.at(grad_table, buckets[words], grad_vectors[:, None, :])
        grad_table[0] = 0
        return [grad_table, *kernels, back.sum(0), active.T @ slope + 1e-4 * self.out,
                np.array([slope.sum()], np.float32)]

    def raw(self, buckets: np.ndarray, sequences: list[np.ndarray]) -> np.ndarray:
        vectors = self.embed(buckets)
        vectors[0] = 0
        flat, spans = lay_out(sequences)
        return self.logits(self.pooled(self.project(vectors), flat, spans))

    def calibrate(self, z: np.ndarray, y: np.ndarray, w: np.ndarray, languages: list[str]) -> None:
        """Slope and shift of the logit (Newton steps on the weighted loss), then a threshold by language."""
        x = np.stack([z, np.ones_like(z)], 1).astype(np.float64)
        theta = np.array([1.0, 0.0])
        for _ in range(30):
            p = sigmoid(x @ theta)
            grad = x.T @ (w * (p - y)) / w.sum() + np.array([1e-3 * (theta[0] - 1), 0])
            hess = (x * (w * p * (1 - p))[:, None]).T @ x / w.sum() + np.diag([1e-3, 1e-6])
            theta = theta - np.linalg.solve(hess, grad)
        if theta[0] > 0 and log_loss(sigmoid(x @ theta), y, w) <= log_loss(sigmoid(z), y, w):
            self.a, self.b = float(theta[0]), float(theta[1])
        p = sigmoid(self.a * z + self.b)
        for language in sorted(set(languages)):
            at = np.array([x == language for x in languages])
            if min(y[at].sum(), (1 - y[at]).sum()) >= MIN_LANGUAGE:
                self.thresholds[language] = _best_cut(p[at], y[at], w[at])


def _best_cut(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The cut of highest weighted F1; of equal ones the nearest to the default."""
    cuts = np.arange(0.3, 0.951, 0.05)
    f1 = [2 * (w * y * (p >= c)).sum() / max(1e-9, (w * (y + (p >= c))).sum()) for c in cuts]
    return float(min(cuts[np.array(f1) >= max(f1) - 1e-9], key=lambda c: abs(c - CUT)))


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Column) -> TextCnn:
    """Train on the driver from the bounded sample."""
    spark = docs.sparkSession
    ids, totals = labelled_ids(docs, labels, label, allowed, TRAIN_ROWS, balanced=True)
    model = TextCnn()
    if len(totals) < 2:
        model.constant = 1.0 if totals.get(1) else 0.0
        return model
    texts = docs.select("doc_id", text_of().alias("text"), "lang")
    sample = scratch(spark, texts.join(F.broadcast(ids), "doc_id")   # at most TRAIN_ROWS ids
                     .groupBy("doc_id", "y").agg(F.min(F.struct("text", "lang")).alias("d"))
                     .select("doc_id", "y", "d.*"), "toxicity-sample")
    sizes = sample.select("doc_id", F.char_length("text").alias("n"), F.xxhash64("doc_id").alias("h")).collect()
    left, taken = TRAIN_CHARS, []
    for r in sorted(sizes, key=lambda r: r.h):
        if r.n <= left:
            left -= r.n
            taken.append((r.doc_id,))
    chosen = (sample.join(F.broadcast(spark.createDataFrame(taken, "doc_id long")), "doc_id")
              .select("doc_id", "text", "lang", "y"))                # at most TRAIN_CHARS characters
    lexicon, rows = Lexicon(), []
    for r in chosen.coalesce(8).toLocalIterator():                   # a text is let go once it is a sequence
        rows.append((xxhash.xxh32_intdigest(str(r.doc_id)), r.doc_id, lexicon.sequence(r.text), r.y, r.lang or ""))
    rows.sort(key=lambda r: r[:2])
    sequences = [r[2] for r in rows]
    y = np.array([r[3] for r in rows], np.float32)
    check = np.arange(len(rows)) % 5 == 0
    buckets = lexicon.take()
    model.train(buckets, [s for s, c in zip(sequences, check, strict=True) if not c], y[~check])
    z = np.concatenate([model.raw(buckets, [sequences[k] for k in part])
                        for part in np.array_split(np.flatnonzero(check), max(1, check.sum() // 200))])
    share = {c: totals[c] / max(1, (y == c).sum()) for c in (0, 1)}
    w = np.array([share[int(v)] for v in y[check]])
    model.calibrate(z, y[check], w, [r[4] for r, c in zip(rows, check, strict=True) if c])
    return model


class Scorer:
    """One worker's lexicon with the responses of the words met so far (about 100 MB at most)."""

    LIMIT = 100_000

    def __init__(self, model: TextCnn):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.lexicon, self.count = Lexicon(), 0
        self.responses = [[np.zeros((1024, FILTERS), np.float32) for _ in range(w)] for w in WIDTHS]

    def _project(self) -> None:
        """Responses of the new words; the arrays grow by doubling."""
        vectors = self.model.embed(self.lexicon.take())
        if not self.count:
            vectors[0] = 0
        upto = self.count + len(vectors)
        for old, new in zip(self.responses, self.model.project(vectors), strict=True):
            for j, part in enumerate(new):
                if upto > len(old[j]):
                    old[j] = np.concatenate([old[j], np.zeros((max(upto - len(old[j]), len(old[j])), FILTERS), np.float32)])
                old[j][self.count:upto] = part
        self.count = upto

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        if self.count > self.LIMIT or len(self.lexicon.tokens) > 2 * self.LIMIT:
            self.reset()
        parts, owner = [], []
        for k, text in enumerate(texts):
            found = stretches(self.lexicon.sequence(text))
            parts += found
            owner += [k] * len(found)
        if self.lexicon.buckets:
            self._project()
        pooled = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        at = 0
        while at < len(parts):                               # some STRETCH words at a time
            to, size = at + 1, len(parts[at][0])
            while to < len(parts) and size + len(parts[to][0]) <= STRETCH:
                size += len(parts[to][0])
                to += 1
            np.maximum.at(pooled, owner[at:to], self._pooled(parts[at:to]))
            at = to
        z = self.model.logits(pooled)
        return sigmoid((self.model.a * z + self.model.b).astype(np.float64))

    def _pooled(self, parts: list[tuple[np.ndarray, int]]) -> np.ndarray:
        flat = np.concatenate([words for words, _ in parts])
        start = np.concatenate([[0], np.cumsum([len(words) for words, _ in parts])[:-1]])
        return self.model.pooled(self.responses, flat, np.stack([start, start + [n for _, n in parts]], axis=1))


def score(docs: DataFrame, model: TextCnn) -> DataFrame:
    """doc_id, score, and the decision at the language's threshold, one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)         # BUCKETS x DIM floats
    scorers: list[Scorer] = []
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("threshold", pa.float64()),
                        ("rejected", pa.bool_())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, rows=256, size=SLICE):
                s, cut = _scored(scorers, shared.value, part.column(1).to_pylist(), part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array(cut), pa.array(s >= cut)],
                                                 schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), "lang").mapInArrow(
        run, "doc_id long, score double, threshold double, rejected boolean")


#: Bytes of text that a task turns into Python objects at a time (a longer text comes alone).
SLICE = 1_000_000


def _scored(scorers: list[Scorer], model: TextCnn, texts: list[str], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    if not scorers:
        scorers.append(Scorer(model))
    cut = np.array([model.thresholds.get(x or "", model.thresholds[""]) for x in languages], np.float64)
    return scorers[0].scores([t or "" for t in texts]).astype(np.float64), cut


def held_out() -> Column:
    """The fold that training never sees."""
    return F.coalesce(crc_mod(3) == 1, F.lit(False))


def op3_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out())
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold", "rejected")


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects at their language's threshold."""
    model = fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out())
    shared = spark.sparkContext.broadcast(model)
    scorers: list[Scorer] = []
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def keep(batches):
        for batch in batches:
            for part in slices(batch, text, rows=256, size=SLICE):
                s, cut = _scored(scorers, shared.value, part.column(text).to_pylist(), part.column(lang).to_pylist())
                yield part.filter(pa.array(s < cut))

    return docs.mapInArrow(keep, docs.schema)
