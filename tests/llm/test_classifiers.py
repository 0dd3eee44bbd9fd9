"""Held-out accuracy and edge cases of the trained text operators, and the corpus pipeline."""

import random

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import labelled, quality, toxicity

MID = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, y int, score string"


def area_under_curve(p, y):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(len(p))
    pos, neg = y.sum(), (1 - y).sum()
    return (rank[y == 1].sum() - pos * (pos - 1) / 2) / (pos * neg)


def held_out(rows, sf_dir, label):
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{sf_dir}/labels.parquet'").fetchall())
    both = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return np.array([p for p, _ in both]), np.array([y for _, y in both])


def corpus(spark, marked, n=240):
    """Documents of which every fourth holds marked words, and their labels."""
    r = random.Random(6)
    texts = []
    for k in range(n):
        words = [f"plain{r.randrange(300)}" for _ in range(r.randrange(5, 120))]
        if k % 4 == 0:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(marked) + r.choice(["", "s", "ing"]))
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(k, t, "en" if k % 2 else None, "s", len(t), 0, "z") for k, t in enumerate(texts)]
                                 + [(n, None, "en", "s", 0, 0, "z"), (n + 1, "", None, None, None, None, None),
                                    (n + 2, "plain1 " * 60_000, "xx", "s", 0, 0, "z"), (0, texts[0], "en", "s", 1, 1, "z")],
                                 DOCS)
    labels = spark.createDataFrame([(k, int(k % 4 != 0), int(k % 4 == 0), 1.5) for k in range(n)] +
                                   [(None, 1, 1, 0.0), (3, None, None, 0.0), (10**9, 0, 1, 0.0)],
                                   "doc_id long, quality int, toxic int, score double")
    return docs, labels, n


def test_toxicity_fold_is_crc32(spark):
    import zlib

    rows = spark.range(500).withColumnRenamed("id", "doc_id").withColumn("h", toxicity.held_out()).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_toxicity_learns_and_scores_every_row(spark):
    docs, labels, n = corpus(spark, ["vilest", "horrid"])
    model = toxicity.fit(docs, labels, "toxic", ~toxicity.held_out())
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == n + 4 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 0}) == 1
    p, y = np.array([r.score for r in rows if r.doc_id < n]), np.array([r.doc_id % 4 == 0 for r in rows if r.doc_id < n])
    assert area_under_curve(p, y.astype(int)) > 0.95
    assert next(r.score for r in rows if r.doc_id == n) == next(r.score for r in rows if r.doc_id == n + 1) < 0.5


def test_toxicity_edges(spark):
    docs, labels, _ = corpus(spark, ["bad"], 8)
    none = toxicity.fit(docs, labels.where("false"), "toxic", ~toxicity.held_out())
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), none).count() == 0


def test_toxicity_held_out(spark):
    p, y = held_out(toxicity.op3_toxicity_cnn(spark, MID).collect(), MID, "toxic")
    assert area_under_curve(p, y) > 0.75


def test_cnn_gradient():
    """The hand-written gradient agrees with finite differences."""
    r = np.random.default_rng(0)
    lexicon = toxicity.Lexicon()
    sequences = [lexicon.sequence(" ".join(f"w{k}" for k in r.integers(0, 9, n))) for n in (0, 1, 5, 12)]
    y = np.array([0.0, 1.0, 1.0, 0.0])
    model = toxicity.TextCnn()
    for name in ("table", "bias", "out", "shift"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.kernels = [k.astype(np.float64) for k in model.kernels]
    model.bias += 0.05
    buckets = np.array(lexicon.buckets)
    grads = model._gradients(buckets, sequences, y)

    def loss():
        vectors = model.embed(buckets)
        vectors[0] = 0
        flat, spans = toxicity.lay_out(sequences)
        p = toxicity.sigmoid(model.logits(model.pooled(model.project(vectors), flat, spans)))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    checked = 0
    for array, grad, decay in zip([model.table, *model.kernels, model.bias, model.out],
                                  grads[:-1], [0, 1e-4, 1e-4, 1e-4, 0, 1e-4], strict=True):
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        eps, old = 1e-5, array[at]
        array[at] = old + eps
        high = loss()
        array[at] = old - eps
        low = loss()
        array[at] = old
        assert np.isclose((high - low) / (2 * eps), grad[at] - decay * old, rtol=1e-3, atol=1e-6)
        checked += 1
    assert checked == 6


def test_quality_learns_and_scores_every_row(spark):
    docs, labels, n = corpus(spark, ["|||", "%%%"])
    rows = quality.score(spark, docs, labels).collect()
    assert len(rows) == n + 4 and all(0 <= r.score <= 1 for r in rows)
    p, y = np.array([r.score for r in rows if r.doc_id < n]), np.array([r.doc_id % 4 != 0 for r in rows if r.doc_id < n])
    assert area_under_curve(p, y.astype(int)) > 0.9


def test_quality_edges(spark):
    docs, labels, n = corpus(spark, ["bad"], 8)
    assert {r.score for r in quality.score(spark, docs, labels.where("false")).collect()} == {0.5}
    assert quality.score(spark, docs.where("false"), labels).count() == 0


def test_quality_held_out(spark):
    p, y = held_out(quality.op9_quality_random_indexing(spark, MID).collect(), MID, "quality")
    assert area_under_curve(p, y) > 0.9


def test_context_sums_by_brute_force(spark):
    texts = ["a b c a", "", None, "b a"]
    index = quality.index_vectors()
    want = {}
    for t in texts:
        w = [quality._token(x)[0] for x in (t or "").split()]
        for k, word in enumerate(w):
            around = [index[w[j]] for j in range(k - 2, k + 3) if j != k and 0 <= j < len(w)]
            n, s = want.get(word, (0, 0))
            want[word] = (n + 1, s + sum(around, np.zeros(quality.DIM)))
    rows = quality.context_sums(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.word: r.n for r in rows} == {w: n for w, (n, _) in want.items()}
    assert all(np.allclose(r.context, want[r.word][1]) for r in rows)


def test_sample_is_bounded(spark):
    docs, labels, _ = corpus(spark, ["bad"])
    from pyspark.sql import functions as F

    ids, totals = labelled.labelled_ids(docs, labels, "toxic", F.lit(True), 20, balanced=True)
    assert ids.count() == 20 and totals == {0: 180, 1: 60}


# ---- pipeline -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def staged(spark):
    import corpus_pipeline
    from ledgerlake.llm.common import scratch, table

    docs, out = table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = scratch(spark, stage(spark, docs, SMALL), f"test-{name}")
    return out


def test_pipeline_stages(spark, staged):
    from ledgerlake.llm import bpe, decontaminate, line_dedup, ngram_join
    from ledgerlake.llm.common import table

    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    names = list(staged)
    assert names == ["toxicity", "line_dedup", "ngram_jaccard", "decontaminate", "byte_bpe"]
    assert all(staged[n].columns == columns for n in names[:-1])
    before = {r.doc_id: r.text for r in staged["toxicity"].collect()}
    after = {r.doc_id: r.text for r in staged["line_dedup"].collect()}
    assert before.keys() == after.keys()
    removed = {r.node for r in line_dedup.repeated_spans(staged["toxicity"]).select("node").distinct().collect()}
    assert {d for d in before if before[d] != after[d]} == removed
    groups = ngram_join.labelled(staged["line_dedup"]).collect()
    kept = {r.doc_id for r in staged["ngram_jaccard"].collect()}
    assert kept == {r.component_id for r in groups}
    hits = {h.doc_id for h in decontaminate.contaminated(staged["ngram_jaccard"], table(spark, SMALL, "benchmark"))
            .collect()}
    clean = {r.doc_id: r.text for r in staged["decontaminate"].collect()}
    assert set(clean) == kept - hits and hits
    want = {r.doc_id: r.n_tokens for r in bpe.encode(staged["decontaminate"]).collect()}
    assert {r.doc_id: len(r.ids) for r in staged["byte_bpe"].collect()} == want


def test_pipeline_run_is_registered(spark, staged):
    import __spark_entry__ as entry

    rows = entry.queries()["pipeline"](spark, SMALL)
    assert rows.count() == staged["byte_bpe"].count() and "pipeline" not in entry.oracle_sql()


def test_stages_take_odd_rows(spark):
    """Null columns, empty tables and extra columns pass through every stage."""
    import corpus_pipeline

    docs, _, _ = corpus(spark, ["bad"], 8)
    docs = docs.withColumnRenamed("score", "ids_sha256").withColumnRenamed("y", "node__x")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SMALL).count() == 0, name
        out = stage(spark, docs, SMALL)
        if name != "byte_bpe":
            assert out.columns == docs.columns
            out.collect()


def test_scorer_equals_direct_pooling_at_any_stretch(monkeypatch):
    """Pooling stretch by stretch and word by word as they come gives what one pass over each whole text gives."""
    r = np.random.default_rng(8)
    texts = [" ".join(f"w{k}x," for k in r.integers(0, 400, n)) for n in (0, 1, 2, 3, 40, 700, 0, 90)]
    model = toxicity.TextCnn(seed=3)
    lexicon = toxicity.Lexicon()
    sequences = [lexicon.sequence(t) for t in texts]
    want = toxicity.sigmoid(model.raw(lexicon.take(), sequences).astype(np.float64))
    for stretch, long in ((1 << 16, 1_000_000), (7, 10), (64, 100)):
        monkeypatch.setattr(toxicity, "STRETCH", stretch)
        monkeypatch.setattr(toxicity, "LONG_TEXT", long)
        scorer = toxicity.Scorer(model)
        got = np.concatenate([scorer.scores(texts[:3]), scorer.scores(texts[3:])])
        assert np.abs(got - want).max() < 1e-5
        scorer.LIMIT = 10                                    # the words met so far are let go
        assert np.abs(scorer.scores(texts) - want).max() < 1e-5
