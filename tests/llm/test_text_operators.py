"""Brute-force, round-trip and edge-case tests of the untrained text operators."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import bpe, chat, decontaminate, fingerprint, license_scan, line_dedup, ngram_join, pii
from ledgerlake.llm.common import Memo

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, `end` string"


def docs_of(spark, texts, start=0):
    """Documents with extra columns whose names clash with inner ones."""
    rows = [(start + k, t, "en", "s", len(t) if t else 0, "x", "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def small_texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


# ---- 6: BPE -------------------------------------------------------------------------------------

RANK_FILE = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(RANK_FILE, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_coder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANK_FILE),
                             special_tokens={})


def ids(blob):
    return [int.from_bytes(blob[k:k + 4], "little") for k in range(0, len(blob), 4)]


def test_bpe_edge_texts(coder, reference_coder):
    r = random.Random(4)
    texts = ["", " ", "\n\n  x", "a" * 2000, "é" * 900, "日本語 x\x1c\x1fy\x85z ½²٣ 　", "<|endoftext|> it's 'll S's",
             "".join(chr(r.randrange(1, 0x3000)) for _ in range(4000)), "ab" * 5000, "\x00\x7f \t\r\n "]
    for text, blob in zip(texts, coder.encode_batch(texts), strict=True):
        assert ids(blob) == reference_coder.encode_ordinary(text)
        assert coder.decode(blob).decode() == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_bpe_random(texts):
    own = bpe.encoder(RANK_FILE, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for text, blob in zip(texts, own.encode_batch(texts), strict=True):
        assert ids(blob) == other.encode_ordinary(text)


def test_bpe_query(spark, reference_coder):
    texts = small_texts()
    for r in bpe.op6_byte_bpe(spark, SMALL).collect():
        want = reference_coder.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_rows(spark):
    got = sorted((r.doc_id, r.n_tokens) for r in bpe.encode(docs_of(spark, [None, "", "hello", "hello"])).collect())
    assert got == [(0, 0), (1, 0), (2, 1), (3, 1)]
    assert bpe.encode(docs_of(spark, [])).count() == 0


# ---- 1: personal data ---------------------------------------------------------------------------

def plain_spans(text):
    """The exact rules, by ``finditer`` of the patterns as they are stated."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        double = [sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])]
        if 13 <= len(d) <= 19 and sum(double) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1200459@.+-() _%\n", max_size=80))
def test_pii_base_rules(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_pii_hard_texts():
    for text in ["a@b.c@d.e f@g.h", "1.2.3.4.5.6.7.8", "256.1.1.1 0000255.1.1.1", "4111 1111-1111 1111", "+1 (23) 456-7890x",
                 "x@-.-", "9" * 5000, "a" * 200_000 + "@", "@" * 5000, "+1" + " " * 5000, "1." * 4000]:
        assert pii.base_spans(text) == (plain_spans(text) if len(text) < 10_000 else [])


def test_pii_query_whole_table(spark):
    texts = small_texts()
    rows = pii.op1_contextual_pii(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == pii.sha_of(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == w[0] for w in want) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(","))


def test_pii_contexts_discover(spark):
    seeds = [f"Some words. call me +1 555 010 {1000 + k} now" for k in range(6)]
    unseen = ["Other text. call me 555-0199-777 later", "the number 5550199888 is no phone", None, ""]
    docs = docs_of(spark, seeds + unseen + [unseen[0]])
    got = {r.doc_id: r for r in pii.extract(docs).collect()}
    assert [tuple(s) for s in got[6].new] == [("phone", 20, 32)] and [tuple(s) for s in got[10].new] == [("phone", 20, 32)]
    assert not got[7].new and not got[8].new and not got[9].new and got[8].base == ""
    assert pii.extract(docs_of(spark, [])).count() == 0


def test_pii_found_instances_induce_patterns(spark):
    texts = [f"Some words. call me +1 555 010 {1000 + k} now" for k in range(6)]
    texts += [f"Some words. call me 555-0200-10{k} now" for k in range(3)]
    texts += [f"Later text. ring us 555-0200-10{k} now" for k in range(3)]
    texts += ["Last text. ring us 555-0777-321 now", "Not here. see page 555-0888-321 now"]
    got = {r.doc_id: [tuple(s) for s in r.new] for r in pii.extract(docs_of(spark, texts)).collect()}
    assert got[12] == [("phone", 19, 31)] and got[13] == [] and all(got[k] for k in range(6, 12))


# ---- 7: fingerprints ----------------------------------------------------------------------------

def test_fingerprint_query(spark):
    texts = small_texts()
    order = sorted(texts)
    rows = {r.doc_id: r for r in fingerprint.op7_multiset_fingerprint(spark, SMALL).collect()}
    assert sorted(rows) == order
    by_text = {}
    for k, d in enumerate(order):
        t, nxt, r = texts[d], texts[order[(k + 1) % len(order)]], rows[d]
        half = len(t) // 2
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)
    mean = lambda c: sum(getattr(r, c) for r in rows.values()) / len(rows)
    assert mean("near_edited") > mean("near_next") + 0.3


def test_fingerprint_is_a_multiset_hash(spark):
    from pyspark.sql import functions as F

    a, b = "first line.\nsecond one", "third, with. clauses"
    df = spark.createDataFrame([(a, b, a + "\n" + b, "second one\n" + b + "\nfirst line.", a + "\n" + a)],
                               "a string, b string, ab string, mixed string, twice string")
    lanes = df.select(*[fingerprint.vector(F.col(c)).alias(c) for c in df.columns])
    r = lanes.select("*", fingerprint.combine(F.col("a"), F.col("b")).alias("inserted"),
                     fingerprint.combine(F.col("ab"), F.col("b"), -1).alias("deleted")).first()
    assert r.ab == r.mixed == r.inserted and r.a == r.deleted and r.twice != r.a


def test_fingerprint_edges(spark):
    assert fingerprint.fingerprints(docs_of(spark, [])).count() == 0
    one = fingerprint.fingerprints(docs_of(spark, ["abcd"])).first()
    assert one.edited == "abab"
    docs = docs_of(spark, [None, "", "x" * 300_000, "wxyz", "wxyz"]).unionAll(docs_of(spark, ["wxyz"], 4))
    rows = fingerprint.fingerprints(docs).collect()
    assert len(rows) == 6 and {r.doc_id: r.n_chars for r in rows} == {0: 0, 1: 0, 2: 300_000, 3: 4, 4: 4}
    null = fingerprint.fingerprints(spark.createDataFrame([(None, "pq"), (5, "abcd")], "doc_id long, text string"))
    assert {r.doc_id: r.edited for r in null.collect()} == {None: "pa", 5: "abpq"}


# ---- 8: n-gram join -----------------------------------------------------------------------------

def brute_components(texts):
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    at, names = {d: d for d in texts}, sorted(texts)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((at[a], at[b]))
                at = {d: low if c == high else c for d, c in at.items()}
    return {d: (len(sets[d]), at[d]) for d in texts}


def near_copies(seed, groups=6, size=9):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([3, 6, 8, 11, 14, 30, 80]))]
        out.append(" ".join(base))
        for _ in range(size - 1):
            words = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                words[r.randrange(len(words))] = f"v{r.randrange(30)}"
            if r.random() < 0.3:
                words.insert(0, "common start")
            out.append("  ".join(words).upper() if r.random() < 0.2 else " ".join(words))
    return out


@pytest.mark.parametrize("block", [256, 5])
def test_ngram_components(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = near_copies(5) + [None, "", " \t", "one two", "one two", "One TWO three four five six"] + \
        [" ".join(f"s{k}" for k in range(40)) + f" t{j} u{j}" for j in range(12)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.labelled(docs_of(spark, texts)).collect()}
    assert got == brute_components(dict(enumerate(texts)))


def brute_links(texts):
    """Per document: with how many other shingle sets its set reaches the similarity."""
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets[d] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()
    kinds = set(sets.values()) - {frozenset()}
    links = {s: sum(100 * len(s & o) >= 75 * len(s | o) for o in kinds) - 1 for s in kinds} | {frozenset(): 0}
    return {d: links[s] for d, s in sets.items()}


@pytest.mark.parametrize("hot", [4.0, 0.0])
def test_ngram_links_are_all_links(spark, monkeypatch, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    family = [" ".join(f"s{k}" for k in range(120)) + f" t{j}" for j in range(100)]
    texts = family + near_copies(6) + [None, "", "one two", "one two"] + [" ".join(f"q{k}" for k in range(j)) for j in range(1, 16)]
    got = {r.doc_id: r.n_links for r in ngram_join.labelled(docs_of(spark, texts)).collect()}
    assert got == brute_links(dict(enumerate(texts))) and got[0] == got[99] == 99


def test_ngram_query(spark):
    rows = ngram_join.op8_ngram_jaccard(spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(small_texts())


def test_ngram_edges(spark):
    assert ngram_join.labelled(docs_of(spark, [])).count() == 0
    words = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(None, words), (7, words + " x"), (8, words), (8, words), (9, "other " * 9), (9, "text")],
                               "doc_id long, text string")
    rows = ngram_join.labelled(df).collect()
    assert len(rows) == 6
    assert {r.component_id for r in rows if r.doc_id in (None, 7, 8)} == {None}
    assert len({r.n_shingles for r in rows if r.doc_id == 9}) == 1


def test_ngram_lists_with_several_components(spark):
    """Copies around the limit: lists hold many components, some linked by few members only."""
    r = random.Random(41)
    base = [f"w{r.randrange(5000)}" for _ in range(110)]
    texts = []
    for _ in range(130):
        words = base[:r.randrange(80, 111)]
        for _ in range(r.randrange(8)):
            words[r.randrange(len(words))] = f"v{r.randrange(10**6)}"
        texts.append(" ".join(words))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.labelled(docs_of(spark, texts)).collect()}
    want = brute_components(dict(enumerate(texts)))
    assert got == want and 3 < len({c for _, c in want.values()}) < 100


def test_ngram_rows_of_one_id_keep_their_texts(spark):
    """Different texts under one id are linked, kept and dropped by themselves."""
    r = random.Random(31)
    unique = [" ".join(f"{k}u{r.randrange(900)}" for _ in range(40)) for k in range(10)]
    a = " ".join(f"a{k}" for k in range(50))
    rows = [(1, a), *((k, t) for k in range(2, 10) for t in (a, unique[k])), (1, unique[0]), (None, unique[1]), (None, unique[1])]
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, node string")
    kept = sorted((x.doc_id or 0, x.text) for x in ngram_join.stage_ngram_jaccard(spark, docs, "").collect())
    assert kept == sorted([(1, a), (1, unique[0]), (0, unique[1]), *((k, unique[k]) for k in range(2, 10))])
    got = sorted((x.doc_id or 0, x.component_id or 0, x.n_shingles) for x in ngram_join.labelled(docs).collect())
    assert got == sorted((d or 0, 1 if t == a else d or 0, len(t.split()) - 4) for d, t in rows)


@pytest.mark.parametrize("block, heavy", [(256, 2000), (8, 2000), (16, 40)])
def test_ngram_links_in_blocks(spark, monkeypatch, block, heavy):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    r = random.Random(33)
    texts = []
    for n in (30, 60, 200):
        base = [f"w{r.randrange(5000)}" for _ in range(n)]
        for _ in range(30):
            words = base[:r.randrange(n - n // 5, n + 1)]
            for _ in range(r.randrange(3)):
                words[r.randrange(len(words))] = f"v{r.randrange(99)}"
            texts.append(" ".join(words))
    got = {x.doc_id: x.n_links for x in ngram_join.labelled(docs_of(spark, texts)).collect()}
    assert got == brute_links(dict(enumerate(texts)))


def test_shared_counts():
    r = random.Random(34)
    sets = [[sorted(r.sample(range(9000), r.randrange(1, 6000))) for _ in range(9)] for _ in range(2)]
    import numpy as np
    arrays = [[np.array(s, np.uint64) for s in side] for side in sets]
    want = [[len(set(x) & set(y)) for y in sets[1]] for x in sets[0]]
    assert ngram_join.shared_counts(*arrays).tolist() == want


def test_light_and_heavy_boundary():
    assert ngram_join.boundary({1: 10_000}) >= 1 and ngram_join.boundary({500: 1000}) == 0
    assert list(ngram_join.partners(4)) == [3, 4, 5] and ngram_join.needed(4, 5) == 4


# ---- 10: decontamination ------------------------------------------------------------------------

def test_wand_equals_full_scoring():
    r = random.Random(9)
    vocabulary = [f"t{k}" for k in range(120)]
    items = [(k, " ".join(r.choice(vocabulary[:r.choice([10, 120])]) for _ in range(r.randrange(3, 30))) + ". end it")
             for k in range(150)]
    index = decontaminate.ItemIndex(items)
    for _ in range(200):
        terms = sorted({index.terms[w] for w in r.sample(vocabulary, r.randrange(1, 60)) if w in index.terms})
        full = Counter()
        for t in terms:
            for k, w in zip(index.items[t], index.weights[t], strict=True):
                full[k] += w
        for least in (0.2, 0.5):
            got = dict(index.retrieve(terms, least))
            assert {k for k, v in full.items() if v >= least + 1e-9} <= set(got)
            assert all(math.isclose(v, full[k]) for k, v in got.items())


def test_decontamination(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7)))
    items = [" ".join(word() for _ in range(20)) + ". " + " ".join(word() for _ in range(8)) + "." for _ in range(40)]
    items += ["", None, "x", items[3]]
    noise = [" ".join(word() for _ in range(n)) for n in (5, 50, 400, 5000)]
    planted = [noise[1] + "\n" + items[3].upper() + " " + noise[2], noise[3] + " " + items[7], items[9]]
    docs = docs_of(spark, [*noise, *planted, None, "", planted[2]])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    hits = {(h.doc_id, h.item_id) for h in decontaminate.contaminated(docs, bench).collect()}
    assert hits == {(4, 3), (4, 43), (5, 7), (6, 9), (9, 9)}
    assert decontaminate.contaminated(docs_of(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0


def test_decontamination_scores_by_the_whole_benchmark(spark, monkeypatch):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    common = [f"the{k}" for k in range(12)]
    items = [" ".join(r.sample(common, 8) + [word() for _ in range(14)]) for _ in range(30)]
    items += [" ".join(r.sample(common, 12) * 2 + [word() for _ in range(70)])]      # alone in its length class
    docs = [" ".join(t.split()[:-3]) for t in items]
    n, words = len(items), [t.split() for t in items]
    mean, df = sum(map(len, words)) / n, Counter(w for ws in words for w in set(ws))

    def score(item, doc):
        weight = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(item) / mean))
                  for t, f in Counter(item).items()}
        return sum(weight[t] for t in set(doc) & set(weight)) / sum(weight.values())

    bench = spark.createDataFrame([*enumerate(items), (90, ""), (91, "?!"), (92, None)], "item_id long, text string")
    for chars in (decontaminate.SHARD_CHARS, 500):
        monkeypatch.setattr(decontaminate, "SHARD_CHARS", chars)
        got = {(h.doc_id, h.item_id): h.score for h in decontaminate.contaminated(docs_of(spark, docs), bench).collect()}
        assert set(got) == {(k, k) for k in range(n)}
        assert all(math.isclose(got[k, k], score(words[k], docs[k].split()), abs_tol=1e-9) for k in range(n))


def test_decontamination_needs_question_and_answer(spark):
    """Retrieval and verification over all passages and items, against brute force; a question alone is no hit."""
    r = random.Random(17)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    pairs = [([word() for _ in range(r.randrange(10, 30))], [word() for _ in range(r.randrange(2, 12))]) for _ in range(25)]
    single = [[word() for _ in range(18)] for _ in range(5)]
    items = [" ".join(q) + ". " + " ".join(a) + "." for q, a in pairs] + [" ".join(w) for w in single]
    noise = lambda: [word() for _ in range(r.randrange(60))]
    docs = []
    for q, a in pairs:
        docs += [noise() + q + noise(), noise() + a, noise() + q + a + noise(), q[:-(len(q) // 4)] + a]
    docs += [noise() + w + noise() for w in single] + [w[:6] for w in single]
    grams = lambda w: {tuple(w[k:k + min(3, len(w))]) for k in range(max(1, len(w) - 2))}
    share = lambda part, text: len(grams(part) & text) / len(grams(part))
    want = set()
    for d, words in enumerate(docs):
        text = {tuple(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)}
        want |= {(d, i) for i, (q, a) in enumerate(pairs) if min(share(q, text), share(a, text)) >= 0.5}
        want |= {(d, 25 + i) for i, w in enumerate(single) if share(w, text) >= 0.5}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(h.doc_id, h.item_id) for h in decontaminate.contaminated(docs_of(spark, [" ".join(w) for w in docs]), bench)
           .collect()}
    assert got == want and len(want) == 55


def test_decontamination_query_finds_exact_items(spark):
    texts = small_texts()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    flat = {d: " ".join(re.findall(r"\w+", t.lower())) for d, t in texts.items()}
    exact = {(d, i) for i, t in items for d, f in flat.items() if " ".join(re.findall(r"\w+", t.lower())) in f}
    assert exact <= {(h.doc_id, h.item_id) for h in decontaminate.op10_bm25_decontamination(spark, SMALL).collect()}


# ---- 2: line chunks -----------------------------------------------------------------------------

def passage(r, n):
    return "\n".join(" ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(10)) + "." for _ in range(n))


def test_pieces_cover_the_text():
    r = random.Random(1)
    text = passage(r, 60)
    spans = line_dedup.pieces(text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(text[a[1]] in "\n " and a[1] + 1 == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert [text[a:b] for a, b, w in spans if w] == line_dedup.worded(text)


def test_chunks_resist_shifts_and_meet_in_repeated_passages():
    """Every passage of MIN_WORDS + STRETCH words has a chunk in common in any surroundings."""
    r = random.Random(1)
    line = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    for trial in range(400):
        top = r.choice([2, 5, 9, 19, 40])
        shared, words = [], 0
        while words < line_dedup.MIN_WORDS + line_dedup.STRETCH:
            n = r.randrange(1, top + 1)
            shared.append(line(n))
            words += n
        found = []
        for _ in range(2):
            texts = [line(r.randrange(1, 20)) for _ in range(r.randrange(8))] + shared + [
                line(r.randrange(1, 20)) for _ in range(r.randrange(8))]
            starts, hashes = line_dedup.chunks(texts)
            found.append(set(hashes.tolist()))
        assert found[0] & found[1], (trial, [len(x.split()) for x in shared])
    text = [line(8) for _ in range(300)]
    moved = [line(8), *text]
    one, two = set(line_dedup.chunks(text)[1].tolist()), set(line_dedup.chunks(moved)[1].tolist())
    assert len(one & two) >= len(one) - 3 and len(one) < 0.7 * len(text)


def test_rolling_hash_is_that_of_the_chunk_alone():
    texts = [f"line {k} " + "w " * 9 + "end" for k in range(40)]
    starts, hashes = line_dedup.chunks(texts)
    for s, h in zip(starts.tolist(), hashes.tolist(), strict=True):
        alone = line_dedup.chunks(texts[s:s + 2])
        assert alone[0].tolist()[0] == 0 and alone[1].tolist()[0] == h


def test_line_dedup_removes_later_copies(spark):
    r = random.Random(2)
    shared, own = passage(r, 8), [passage(r, 6) for _ in range(5)]
    texts = [own[0] + "\n" + shared, shared + "\n" + own[1], own[2] + "\n" + shared + "\n" + own[3], own[4], None, "",
             own[4] + "\n" + own[4], "short line", "short line"]
    docs = docs_of(spark, texts)
    spans = line_dedup.repeated_spans(docs).collect()
    for s in spans:
        piece = texts[s.node][s.start:s.end]
        assert piece in texts[s.first_node] and (s.first_node < s.node or texts[s.node].index(piece) < s.start)
    cleaned = {r.doc_id: r for r in line_dedup.remove(docs).collect()}
    assert len(cleaned) == len(texts) and line_dedup.remove(docs).columns == docs.columns
    for d in (0, 3, 4, 5, 7, 8):
        assert cleaned[d].text == texts[d]
    kept = sum(cleaned[d].text.count(line) for line in shared.split("\n") for d in range(3))
    assert kept <= 8 + 2 * 3 and all(x in cleaned[1].text for x in own[1].split("\n")[1:])
    assert all(r.text is None or r.n_chars == len(r.text) for r in cleaned.values())
    assert line_dedup.repeated_spans(docs_of(spark, [])).count() == 0


def brute_dedup(texts):
    """Words of the texts (ids in order) without the runs of 20 or more words whose pieces occurred before."""
    seen, out = set(), []
    for text in texts:
        kept, run = [], []
        for piece in [*re.split(r"\n|(?<=[.!?]) ", text), None]:
            if piece in seen:
                run.append(piece)
            elif piece is None or piece.strip():
                if sum(len(p.split()) for p in run) < 20:
                    kept += run
                run = []
                kept.append(piece or "")
            seen.add(piece) if piece and piece.strip() else None
        out.append(" ".join(kept).split())
    return out


def test_line_dedup_removes_whole_passages(spark):
    r = random.Random(12)
    sentence = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)) + "."
    texts, passages = [], []
    for k in range(80):
        n = 1 + k % 4
        shared = [sentence(-(-60 // n)) for _ in range(n)]
        passages.append(shared)
        for _ in range(2):
            own = [sentence(r.randrange(3, 15)) for _ in range(8)]
            mid = r.choice([" ", "\n", "\n\n"]).join(shared)
            texts.append(" ".join(own[:4]) + r.choice([" ", "\n", "\n\n"]) + mid + r.choice([" ", "\n"]) + " ".join(own[4:]))
    short = sentence(12)
    texts += [short + " " + sentence(9), sentence(9) + " " + short]
    cleaned = {x.doc_id: x.text for x in line_dedup.remove(docs_of(spark, texts)).collect()}
    assert [cleaned[d].split() for d in range(len(texts))] == brute_dedup(texts)
    for k, shared in enumerate(passages):
        assert not any(s in cleaned[2 * k + 1] for s in shared) and cleaned[2 * k] == texts[2 * k]
    assert short in cleaned[160] and short in cleaned[161]


def test_line_dedup_compares_bytes():
    """A chunk of equal hash and other bytes removes nothing; of a run only what is equal."""
    r = random.Random(8)
    mine, other = passage(r, 10).split("\n"), passage(r, 10).split("\n")
    segment = lambda pieces: {"doc": 3, "low": 5, "pieces": pieces, "places": [{"pos": 4, "at": 9}]}
    assert line_dedup.runs(mine, [segment(other)]) == {}
    assert line_dedup.runs(mine, [segment(mine)]) == {k: 3 for k in range(10)}
    assert line_dedup.runs(mine, [segment(other[:3] + mine[3:7] + other[7:])]) == {k: 3 for k in (3, 4, 5, 6)}
    assert line_dedup.runs(mine, [segment(other[:4] + mine[4:5] + other[5:])]) == {}          # ten words only


def test_line_dedup_rows_of_one_id(spark):
    """Rows that share a doc_id lose nothing to one another's spans; identical rows stay."""
    r = random.Random(14)
    shared, own, else_ = passage(r, 8), passage(r, 6), passage(r, 9)
    rows = [(1, shared), (2, own + "\n" + shared), (2, else_), (2, else_), (None, own)]
    docs = spark.createDataFrame([(d, t, "x", len(t)) for d, t in rows], "doc_id long, text string, node string, n_chars long")
    out = sorted((x.doc_id or 0, x.text, x.n_chars) for x in line_dedup.remove(docs).collect())
    assert [(d, t) for d, t, _ in out] == sorted([(1, shared), (2, ""), (2, else_), (2, else_), (0, own)])
    assert all(n == len(t) for _, t, n in out)


def test_line_dedup_recall_of_short_passages(spark):
    """Runs of 30 words are always removed, shorter ones of 20 if one of their chunks is chosen."""
    r = random.Random(15)
    sentence = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)) + "."
    texts, planted = [], []
    for k in range(300):
        n = r.randrange(1, 5)
        shared = [sentence(r.randrange(-(-20 // n), 1 + max(-(-20 // n), 49 // n))) for _ in range(n)]
        planted.append(shared)
        for _ in range(2):
            around = [sentence(r.randrange(3, 15)) for _ in range(12)]
            texts.append("\n".join(around[:6] + shared + around[6:]))
    cleaned = {x.doc_id: x.text for x in line_dedup.remove(docs_of(spark, texts)).collect()}
    whole = [not any(s in cleaned[2 * k + 1] for s in shared) for k, shared in enumerate(planted)]
    assert sum(whole) >= 0.95 * len(planted)
    assert all(w for w, shared in zip(whole, planted, strict=True)
               if sum(len(x.split()) for x in shared) >= line_dedup.MIN_WORDS + line_dedup.STRETCH)
    assert all(cleaned[2 * k] == texts[2 * k] for k in range(300))


# ---- 4 and 5: chat and licences -----------------------------------------------------------------

def duck_rows(sql, **tables):
    con = duckdb.connect()
    for name, source in tables.items():
        if isinstance(source, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
        else:
            con.register(name, source)
    x = con.execute(sql)
    return [d[0] for d in x.description], x.fetchall()


def same_rows(df, sql, **tables):
    columns, want = duck_rows(sql, **tables)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


def test_chat_against_sql(spark):
    got = same_rows(chat.op4_perspective_rotation(spark, SMALL), chat.ORACLE_SQL,
                    conversations=f"{SMALL}/conversations.parquet")
    assert got


def test_chat_perspectives(spark):
    rows = [(1, 0, "system", "be kind", 9), (1, 1, "ann", "hi", 9), (1, 2, "bob", "é?", 9), (1, 2, "bob", "é?", 9),
            (1, 3, "ann", None, 9), (1, 400, "bob", "late", 9), (2, None, None, "x", 9), (3, 0, "system", "alone", 9)]
    got = {(r.conv_id, r.participant, r.part): r for r in chat.rotate(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at int")).collect()}
    assert sorted(got) == [(1, "ann", 0), (1, "ann", 3), (1, "bob", 0), (1, "bob", 3), (2, "unknown", -1)]
    ann = got[1, "ann", 0]
    assert ann.text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
                        "<|im_start|>user name=bob\né?<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert [ann.text[s.start:s.end] for s in ann.mask] == ["hi<|im_end|>\n", "<|im_end|>\n"]
    assert [got[1, "bob", 0].text[s.start:s.end] for s in got[1, "bob", 0].mask] == ["é?<|im_end|>\n"]
    assert not got[1, "ann", 3].mask and len(got[1, "bob", 3].mask) == 1


def test_license_against_sql(spark):
    got = same_rows(license_scan.op5_license_sentences(spark, SMALL), license_scan.oracle_sql(),
                    documents=f"{SMALL}/documents.parquet")
    assert got


def test_license_rules_need_their_order(spark):
    from ledgerlake.llm.license_rules import SENTENCES

    s = lambda *i: ". ".join(SENTENCES[x].capitalize() for x in i) + "."
    wrapped = s("mit.grant", "mit.condition", "mit.as_is").replace(" of ", " of\n")
    texts = [s("bsd.grant", "bsd.source", "bsd.binary"), s("bsd.binary", "bsd.source", "bsd.grant"), wrapped, None, "",
             "Released under the MIT License.\nAll rights reserved", "nothing permitted here", "ALL RIGHTS RESERVED"]
    got = {r.doc_id: r.licences for r in license_scan.scan(docs_of(spark, texts)).collect()}
    assert got == {0: ["BSD-2-Clause"], 1: [], 2: ["MIT"], 5: ["LicenseRef-all-rights-reserved", "MIT"],
                   7: ["LicenseRef-all-rights-reserved"]}
    assert license_scan.scan(docs_of(spark, [])).count() == 0


APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """ISC License
Copyright (c) 2020 Some One
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def gnu(what, name, version, colon, comma):
    return f"""Copyright (C) 2020 Some One

    This {what} is free software{colon} you can redistribute it and/or modify
    it under the terms of the GNU {name} as published by
    the Free Software Foundation{comma} either version {version} of the License, or
    (at your option) any later version.

    This {what} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {name} for more details.
"""


GPL = "General Public License"
PUBLISHED = [
    (APACHE, ["Apache-2.0"]), (MIT, ["MIT"]), (MIT.split("\n", 1)[1], ["MIT"]), (BSD, ["BSD-2-Clause"]),
    (BSD3, ["BSD-2-Clause", "BSD-3-Clause"]), (ISC, ["ISC"]),
    (gnu("program", GPL, "2", ";", ";"), ["GPL-2.0-or-later"]), (gnu("program", GPL, "3", ":", ","), ["GPL-3.0"]),
    (gnu("program", "Affero " + GPL, "3", ":", ","), ["AGPL-3.0"]),
    (gnu("library", "Lesser " + GPL, "2.1", ";", ";"), ["LGPL"]),
    (gnu("program", "Lesser " + GPL, "3", ":", ","), ["LGPL"]),
    ("    GNU GENERAL PUBLIC LICENSE\n       Version 3, 29 June 2007\n\n Copyright (C) 2007", ["GPL-3.0"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not"
     "\ndistributed with this file, You can obtain one at\nhttp://mozilla.org/MPL/2.0/.", ["MPL-2.0"]),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free", ["Unlicense"]),
    ("Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS CORPORATION", ["CC0-1.0"]),
    ("Creative Commons Attribution 4.0 International Public License\n\nBy exercising", ["CC-BY-4.0"]),
    ("This work is licensed under a Creative Commons\nAttribution 4.0 International License.", ["CC-BY-4.0"]),
    ("Creative Commons Attribution-NonCommercial 4.0 International Public\nLicense\n\nBy", ["CC-BY-NC-4.0"]),
    ("Creative Commons Attribution-ShareAlike 4.0 International Public\nLicense\n\nBy", ["CC-BY-SA-4.0"]),
    ("Copyright (c) 2020 Some One\nAll rights reserved.\nmore", ["LicenseRef-all-rights-reserved"]),
]


def test_published_licences(spark):
    from ledgerlake.llm.license_rules import RULES

    assert {n for _, names in PUBLISHED for n in names} == set(RULES)
    plain = [t for t, _ in PUBLISHED]
    texts = [*plain, *("intro words\n" + t for t in plain), *("\n".join("# " + x for x in t.split("\n")) for t in plain),
             *(t.replace("\n", "\r\n") for t in plain)]
    got = {r.doc_id: r.licences for r in license_scan.scan(docs_of(spark, texts)).collect()}
    for k in range(len(texts)):
        assert got.get(k) == PUBLISHED[k % len(plain)][1], texts[k]
    parts = APACHE.split("\n\n")
    none = [parts[3] + "\n" + parts[1], MIT.replace("furnished", "given").split("\n", 1)[1], "v. 2.0 of a license|x"]
    assert not any(r.licences for r in license_scan.scan(docs_of(spark, none)).collect())


def test_memo_is_emptied():
    m = Memo(len, limit=3)
    assert [m[x] for x in ("a", "bb", "ccc", "dddd")] == [1, 2, 3, 4]
    m.trim()
    assert not m
