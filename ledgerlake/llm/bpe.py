"""Operator 6: byte-level BPE encoding and decoding with numpy matrices.

Every Spark task collects the distinct pre-tokens of a slice of documents,
puts them into matrices by byte length and merges, in each round, the leftmost
pair of minimum rank of every row at once.  A row that merged is one column
shorter (compaction), a row without a known pair is finished.  Pair ranks come
from an open-addressing hash table in numpy.

Defined results: a null text is the empty text (0 tokens); repeated rows give
repeated rows; extra columns are ignored; an empty table gives no rows.  A
pre-token of more than ``MATRIX_BYTES`` bytes (one merge a round would take
quadratic time) is merged by the same rule with a heap over a linked list, so
texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from collections.abc import Iterable

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import Memo, map_rows, table, text_of

NONE = np.uint32(0xFFFFFFFF)
#: Longest pre-token, in bytes, that is merged in a matrix.
MATRIX_BYTES = 256
#: Length classes of the padded matrices.
BUCKETS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, MATRIX_BYTES)
WIDTH_OF = [next(c for c in BUCKETS if n <= c) for n in range(MATRIX_BYTES + 1)]
MAX_CELLS = 4_000_000
#: Rows of documents whose distinct pre-tokens are merged together.
SLICE = 1024

# Texts of ASCII and Latin-1 letters only: the same splits with plain classes,
# which ``re`` matches about twice as fast as ``regex`` does \p{L}.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_SPACE = r" \t\n\r\f\v"
_PLAIN = re.compile(rf"[\x00-\x7f{_LETTERS}]*\Z")
_PLAIN_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_SPACE}{_LETTERS}0-9]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """(left id, right id) -> rank of the joined bytes, as an open-addressing table."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, 3 * len(keys))))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.ranks = np.full(1 << bits, NONE, np.uint32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        ranks_in = np.array(rank, np.uint32)
        while len(todo):
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.keys[slot[free]] = keys[todo[free]]
            placed = self.keys[slot] == keys[todo]
            self.ranks[slot[placed]] = ranks_in[todo[placed]]
            todo, slot = todo[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape = left.shape
        keys = ((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)).ravel()
        slot = self._slot(keys)
        out = np.full(len(keys), NONE, np.uint32)
        found = self.keys[slot]
        out[found == keys] = self.ranks[slot[found == keys]]
        todo = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(todo):
            slot_t = slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot_t]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slot_t[hit]]
            todo = todo[~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out.reshape(shape)


class ByteBpe:
    """Encoder and decoder over a rank file; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.own_pattern = pattern
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.cache = Memo(None)
        import public_tokenizers
        self.plain = pattern == public_tokenizers.PATTERN

    def pre_tokens(self, text: str) -> list[str]:
        if self.plain and _PLAIN.match(text):
            return _PLAIN_SPLIT.findall(text)
        return [m.group() for m in self.split.finditer(text)]

    def merge_matrix(self, words: list[bytes]) -> list[bytes]:
        """Ids (as bytes) of words of 2 to ``MATRIX_BYTES`` bytes, padded to one width."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max())
        cells = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = self.byte_ids[cells].reshape(len(words), width)
        pad = np.arange(width) >= lengths[:, None]
        rank = self.pairs.look_up(ids[:, :-1], ids[:, 1:])
        rank[pad[:, 1:]] = NONE
        out: list = [None] * len(words)
        row = np.arange(len(words))
        n = lengths.copy()
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), int)
            low = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NONE)
            done = low == NONE
            if done.any():
                packed, step = ids[done].astype("<u4").tobytes(), 4 * ids.shape[1]
                for at, (k, size) in enumerate(zip(row[done].tolist(), n[done].tolist(), strict=True)):
                    out[k] = packed[at * step:at * step + 4 * size]
                go = ~done
                ids, rank, row, n, best, low = ids[go], rank[go], row[go], n[go], best[go], low[go]
                if not len(row):
                    break
            r = np.arange(len(row))
            ids[r, best] = low                              # the id of a merged pair is its rank
            keep = np.ones(ids.shape, bool)
            keep[r, best + 1] = False
            ids = ids[keep].reshape(len(row), -1)           # compaction: one column less
            keep = np.ones(rank.shape, bool)
            keep[r, best] = False
            rank = rank[keep].reshape(len(row), -1)
            n = n - 1
            has_left, has_right = best > 0, best + 1 < n
            a = r[has_left]
            p = best[has_left]
            rank[a, p - 1] = self.pairs.look_up(ids[a, p - 1], ids[a, p])
            a, p = r[has_right], best[has_right]
            rank[a, p] = self.pairs.look_up(ids[a, p], ids[a, p + 1])
            a, p = r[~has_right], best[~has_right]
            inside = p < rank.shape[1]
            rank[a[inside], p[inside]] = NONE
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same merges for one very long word: heap of (rank, position), linked list."""
        parts = [word[k:k + 1] for k in range(len(word))]
        nxt, prev = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        get, heap = self.ranks.get, []

        def push(k: int) -> None:
            if k >= 0 and nxt[k] < len(parts):
                r = get(parts[k] + parts[nxt[k]])
                if r is not None:
                    heapq.heappush(heap, (r, k, len(parts[k]), len(parts[nxt[k]])))

        for k in range(len(parts)):
            push(k)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            if len(parts[k]) != a or nxt[k] >= len(parts) or len(parts[nxt[k]]) != b:
                continue                                    # one side has merged since
            j = nxt[k]
            parts[k], parts[j] = parts[k] + parts[j], b""
            nxt[k] = nxt[j]
            if nxt[k] < len(parts):
                prev[nxt[k]] = k
            push(prev[k]), push(k)
        return np.array([get(p) for p in parts if p], np.uint32)

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that the cache lacks."""
        names: dict[int, list[str]] = {c: [] for c in BUCKETS}
        coded: dict[int, list[bytes]] = {c: [] for c in BUCKETS}
        for w in words:
            b = w.encode("utf-8", "surrogatepass")
            if b in self.ranks:
                self.cache[w] = self.ranks[b].to_bytes(4, "little")
            elif len(b) > MATRIX_BYTES:
                self.cache[w] = self.merge_long(b).astype("<u4").tobytes()
            else:
                width = WIDTH_OF[len(b)]
                names[width].append(w)
                coded[width].append(b)
        for width in BUCKETS:
            step = max(1, MAX_CELLS // width)
            for at in range(0, len(names[width]), step):
                self.cache.update(zip(names[width][at:at + step],
                                      self.merge_matrix(coded[width][at:at + step]), strict=True))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        self.cache.trim()
        split = [self.pre_tokens(t) for t in texts]
        self.learn(set().union(*split).difference(self.cache))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteBpe:
    """One encoder per Python worker; ``path`` may name a file added with ``addFile``."""
    import os
    return ByteBpe(read_ranks(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))), pattern)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None,
           with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array of long), decoded text's and ids' digests.

    ``path`` is the rank file (default: the installed public vocabulary); on
    a cluster without it ship the file with ``spark.sparkContext.addFile``.
    """
    import public_tokenizers

    path = path or str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pattern = pattern or public_tokenizers.PATTERN

    def run(cols: dict[str, list]) -> dict[str, list]:
        coder = encoder(path, pattern)
        ids = coder.encode_batch(cols["text"])
        out = {"doc_id": cols["doc_id"], "n_tokens": [len(b) // 4 for b in ids],
               "ids_sha256": [hashlib.sha256(b).hexdigest() for b in ids],
               "decoded_sha256": [hashlib.sha256(coder.decode(b)).hexdigest() for b in ids]}
        if with_ids:
            out["ids"] = [np.frombuffer(b, "<u4").astype(np.int64) for b in ids]
        return out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs.select("doc_id", text_of().alias("text")), run,
                    schema + (", ids array<long>" if with_ids else ""), rows=SLICE)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), with_ids=False)


def stage_byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the documents with their token ids."""
    return encode(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("ids"))
