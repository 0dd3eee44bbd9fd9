"""Operator 1: personal data by bootstrapped contextual extraction.

Seeds are the e-mails, IP addresses, cards and phone numbers that match their
exact rules.  An instance's two preceding words are a lexical pattern.  Spark
scores the bipartite graph of patterns and instances in a fixed number of
rounds; in each, instances found in earlier rounds count like seeds, so they
can induce further patterns.  A pattern's confidence for a kind is the mass of
known instances of that kind that follow it over *all* its occurrences in the
corpus, an instance's confidence is the noisy-or of its patterns.
Identifier-like strings that miss the exact rules (a card failing Luhn, a phone
without ``+``, an address without a dot) become spans when their confidence is
high.

Defined results: a null text is empty; a document without finds has zero
counts and the digest of the empty string; repeated rows give repeated,
equal rows; rows are matched by (doc_id, text) so clashing ids do not mix;
extra columns are ignored; an empty table gives no rows; texts are scanned
whole in time linear in their length.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import Memo, map_rows, scratch, table, text_of

KINDS = ("email", "ip", "card", "phone")
#: Distinct believed values (seeds or found ones) that a pattern needs before it is considered.
MIN_SEEDS = 3
#: Confidence from which patterns and instances count.
MIN_CONFIDENCE = 0.5
ROUNDS = 3
#: Bits of the pre-filter over candidate patterns (fixed size at any scale; totals are joined exactly).
FILTER_BITS = 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# [0-9]+ may start within a run of digits only where nothing was found from its start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# identifier-like strings at the start of a token; only patterns can confirm them
_LIKE = {
    "email": re.compile(r"(?<!\S)[\"'(<\[]?([^\s\"'(<\[@]{1,64}@[^\s\"')>\],;@]{2,255})"),
    "ip": re.compile(r"(?<!\S)[\"'(<\[]?([0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{1,4}){3,7})(?![\w.:])"),
    "card": re.compile(r"(?<!\S)[\"'(<\[]?([0-9](?:[ -]?[0-9]){11,18})(?![\w-])"),
    "phone": re.compile(r"(?<!\S)[\"'(<\[]?(\(?[0-9]{2,5}\)?(?:[ .-]?[0-9]{2,5}){1,5})(?![\w-])"),
}
_DIGITS = re.compile(r"[0-9]+")
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """The leftmost non-overlapping matches, found from each ``@`` so that time stays linear."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Exact finds, by kind as listed and then by start (code points, end exclusive)."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                    out.append(("phone", *m.span()))
    return out


def _token_hash(token: str) -> int:
    word = _DIGITS.sub("0", token.lower()).strip("\"'()<>[]")
    return xxhash.xxh3_64_intdigest(word)


def pattern_hash(first, second):
    """Pattern of two preceding tokens' hashes, as an unsigned 64-bit integer (vectorised)."""
    mixed = first * _K1 + second * _K2
    return (mixed ^ (mixed >> np.uint64(29))) * _K3


def _pattern_before(text: str, start: int) -> int:
    if start and text[start - 1] in "\"'(<[" and (start == 1 or text[start - 2].isspace()):
        start -= 1                                           # an opening quote or bracket belongs to the token
    before = text[max(0, start - 400):start].rsplit(None, 2)[-2:]
    h = [0] * (2 - len(before)) + [_token_hash(w) for w in before]
    with np.errstate(over="ignore"):
        return int(pattern_hash(np.array([h[0]], np.uint64), np.array([h[1]], np.uint64)).astype(np.int64)[0])


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Identifier-like spans that no base span overlaps; the first kind takes a stretch."""
    if "@" not in text and not _DIGITS.search(text):
        return []
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for kind, like in _LIKE.items():
        if kind == "email" and "@" not in text:
            continue
        found = []
        for m in like.finditer(text):
            a, b = m.span(1)
            if kind == "phone" and not 7 <= sum(map(len, _DIGITS.findall(m.group(1)))) <= 15:
                continue
            found.append((a, b))
        at, free = 0, []
        for a, b in found:                                   # both lists are in order
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at == len(taken) or taken[at][0] >= b:
                free.append((a, b))
        out += [(kind, a, b) for a, b in free]
        taken = sorted(taken + free)
    return out


def _scan(cols: dict[str, list]) -> dict[str, list]:
    out = {k: [] for k in ("doc_id", "text_key", "base", "found")}
    for doc_id, key, text in zip(cols["doc_id"], cols["text_key"], cols["text"], strict=True):
        base = base_spans(text)
        found = []
        for seed, spans in ((True, base), (False, candidates(text, base))):
            for kind, a, b in spans:
                value = re.sub(r"[ ().-]", "", text[a:b]).lower() if kind in ("card", "phone") else text[a:b].lower()
                found.append({"kind": kind, "start": a, "end": b, "seed": seed,
                              "instance": xxhash.xxh3_64_intdigest(value) - (1 << 63),
                              "pattern": _pattern_before(text, a)})
        out["doc_id"].append(doc_id)
        out["text_key"].append(key)
        out["base"].append(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        out["found"].append(found)
    return out


def _pattern_totals(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """pattern, total: how often each candidate pattern occurs before any token of the corpus."""
    slot = F.shiftrightunsigned("pattern", 64 - FILTER_BITS)         # a pattern is a mixed hash
    taken = candidates.select(slot.cast("int").alias("slot")).distinct().collect()  # at most 2**FILTER_BITS
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[[r.slot for r in taken]] = True
    packed = base64.b64encode(np.packbits(bits).tobytes())
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(packed)            # 2**FILTER_BITS bits
    memo = Memo(_token_hash)

    def count(cols: dict[str, list]) -> dict[str, list]:
        flags = np.unpackbits(np.frombuffer(base64.b64decode(shared.value), np.uint8)).view(bool)
        memo.trim()
        hits = []
        for text in cols["text"]:
            h = np.zeros(2, np.uint64)
            words = text.split()
            h = np.concatenate([h, np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))])
            with np.errstate(over="ignore"):
                p = pattern_hash(h[:-2], h[1:-1])
            hits.append(p[flags[(p >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]])
        values, n = np.unique(np.concatenate(hits), return_counts=True) if hits else ([], [])
        return {"pattern": np.asarray(values, np.uint64).astype(np.int64), "n": n}

    counted = map_rows(docs.select(text_of().alias("text")), count, "pattern long, n long", rows=1024)
    return counted.groupBy("pattern").agg(F.sum("n").alias("total"))


def score_graph(spark: SparkSession, edges: DataFrame, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confidences (pattern, kind) and (instance, kind) after ``ROUNDS`` rounds.

    ``edges``: pattern, kind, instance, seed, n (occurrences).
    """
    edges = edges.join(totals, "pattern").withColumn("total", F.greatest("total", "n"))
    known = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scored = edges.withColumn("belief", known)
    patterns = instances = None
    for k in range(ROUNDS):
        patterns = (scored.groupBy("pattern", "kind")
                    .agg(F.sum(F.col("belief") * F.col("n")).alias("mass"), F.max("total").alias("total"),
                         F.sum(F.when(F.col("belief") >= MIN_CONFIDENCE, 1).otherwise(0)).alias("support"))
                    .withColumn("confidence", F.when(F.col("support") >= MIN_SEEDS,
                                                     F.least(F.lit(1.0), F.col("mass") / F.col("total")))
                                .otherwise(0.0))
                    .select("pattern", "kind", "confidence"))
        patterns = scratch(spark, patterns, f"pii-patterns-{k}")
        instances = (edges.join(patterns, ["pattern", "kind"])
                     .groupBy("instance", "kind", "seed")
                     .agg((1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))).alias("belief"))
                     .withColumn("belief", F.when(F.col("seed"), 1.0).otherwise(F.col("belief"))))
        instances = scratch(spark, instances, f"pii-instances-{k}")
        scored = edges.join(instances, ["instance", "kind", "seed"])
    return patterns, instances


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base (span string), found (base and discovered spans as structs)."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_of().alias("text"))
    scanned = scratch(spark, map_rows(
        texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), _scan,
        "doc_id long, text_key long, base string, "
        "found array<struct<kind:string,start:int,end:int,seed:boolean,instance:long,pattern:long>>"), "pii-scan")
    flat = (scanned.select("doc_id", "text_key", F.explode("found").alias("f"))
            .select("doc_id", "text_key", "f.*"))
    edges = flat.groupBy("pattern", "kind", "instance", "seed").agg(F.count("*").alias("n"))
    # every pattern that a round can admit: found instances count like seeds there
    able = (edges.groupBy("pattern", "kind").agg(F.count("*").alias("values"))
            .where(F.col("values") >= MIN_SEEDS).select("pattern").distinct())
    able = scratch(spark, able, "pii-able")
    linked = edges.join(able, "pattern", "left_semi")
    totals = scratch(spark, _pattern_totals(docs, able).join(able, "pattern", "left_semi"), "pii-totals")
    _, instances = score_graph(spark, scratch(spark, linked, "pii-edges"), totals)
    good = instances.where(~F.col("seed") & (F.col("belief") >= MIN_CONFIDENCE)).select("instance", "kind")
    new = (flat.where(~F.col("seed")).join(good, ["instance", "kind"], "left_semi")
           .groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("new")))
    same = scanned["doc_id"].eqNullSafe(F.col("d")) & (scanned["text_key"] == F.col("k"))
    new = new.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "new")
    return (scanned.join(new, same, "left")
            .select("doc_id", "base",
                    F.transform(F.filter("found", lambda f: f["seed"]),
                                lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"),
                                                   f["end"].alias("end"))).alias("exact"),
                    F.coalesce("new", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("new")))


def _is(kind: str):
    return lambda span: span["kind"] == kind


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "documents"))
    rank = {k: n for n, k in enumerate(KINDS)}
    order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    spans = F.array_sort(F.transform(F.concat("exact", "new"), lambda s: F.struct(
        order[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    written = F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.filter("exact", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), written.alias("spans"),
                        F.size("new").cast("long").alias("n_discovered"))


def sha_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
