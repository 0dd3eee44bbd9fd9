"""Open lists: which of them are kept, and what is shuffled for them."""

import random

from pyspark.sql import functions as F

from ledgerlake.llm import cells, ngram_join


def test_lists_of_the_same_members_are_kept_once(spark):
    lists = {k: (1, 2, 3) for k in range(20)} | {20: (1, 2), 21: (4, 5), 22: (1, 2, 3, 6), 23: (7, 8, 1), 24: (8, 1, 7)}
    rows = [(token, node, 2500 if node == 3 else 10) for token, members in lists.items() for node in members]
    parts = spark.createDataFrame([(1, 1), (2, 1), (4, 4), (5, 4)], "node long, component long")
    opened = cells.open_members(spark.createDataFrame(rows, "token long, node long, n long"), ["token"], parts, 2000)
    got = {}
    for r in opened.collect():
        got.setdefault((r.token, r.total), set()).add((r.node, r.part))
    assert got == {(0, 4): {(1, 1), (2, 1), (3, 3)}, (22, 5): {(1, 1), (2, 1), (3, 3), (6, 6)}, (23, 3): {(7, 7), (8, 8), (1, 1)}}


def test_near_copies_meet_in_few_lists(spark, monkeypatch):
    """Near copies share most of their lists: before, all of them were dealt with what their members tell."""
    r = random.Random(4)
    base = [f"w{r.randrange(10**6)}" for _ in range(400)]
    texts = []
    for k in range(5):                                       # pairs are below the limit, so no leader settles a list
        words = base[:]
        words[k * 70:k * 70 + 60] = [f"v{r.randrange(10**6)}" for _ in range(60)]
        texts.append(" ".join(words))
    counted, write = {}, ngram_join.scratch

    def counting(session, df, label, *more):
        out = write(session, df, label, *more)
        if label == "ngram-open":
            counted.update(lists=out.select("token").distinct().count(),
                           sets=out.groupBy("token").agg(F.sort_array(F.collect_set("node")).alias("s")).select("s").distinct().count())
        return out

    monkeypatch.setattr(ngram_join, "scratch", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.component_id for x in ngram_join.labelled(docs).collect()} == set(range(5))
    assert 0 < counted["lists"] == counted["sets"]
