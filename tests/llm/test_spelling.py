"""Spelling variants against a brute-force comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerlake.llm import spelling

DOCS = "doc_id long, text string, word string, n long, place long, part int"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    met = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, others in met.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(met[w]), words.get(form.get(w))) for w, n in words.items())


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def texts(seed, n):
    """Words over a small alphabet, so that many are near, in letters of one and two bytes and with runs of equal letters."""
    r = random.Random(seed)
    pool = ["".join(r.choice("abÀÿé") for _ in range(r.randrange(4, 8))) for _ in range(120)]
    pool += ["aaaaa", "aaaaaa", "aaaaaaa", "Color", "colour", "COLOURS", "x×y÷z"]
    return [" ".join(r.choices(pool, k=60)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    rows = [(k if k % 11 else None, t, "w", 1, 2, 3) for k, t in enumerate(texts(seed, 60))]
    rows += [(7, None, "", 0, 0, 0), (8, "", "", 0, 0, 0), (9, "1 2, 3", "", 0, 0, 0), *rows[:5]]
    assert got(spelling.variants(spark.createDataFrame(rows, DOCS).repartition(4))) == brute(rows)


def test_long_words_and_chains(spark):
    long = "ab" * 15_000
    rows = [(None, " ".join([long] * 3 + [long + "a"] * 6 + ["steps"] * 3 + ["stepsa"] * 6 + ["stepsab"] * 12), "", 0, 0, 0)]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, DOCS)).collect()}
    assert found[long].form == long + "a" and found[long].n_near == 1
    assert found["steps"].form == "stepsa" and found["steps"].root == "stepsab" and found["stepsab"].form is None


@pytest.mark.parametrize("rows", [[], [(1, None, "", 0, 0, 0)], [(1, "once only words here", "", 0, 0, 0)]])
def test_no_words(spark, rows):
    assert spelling.variants(spark.createDataFrame(rows, DOCS)).count() == 0


def test_ties_take_the_first_form(spark):
    rows = [(None, "words " * 3 + "wordb " * 9 + "worda " * 9, "", 0, 0, 0)]
    assert got(spelling.variants(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_numbers_agree_across_partitions():
    """A node has one number wherever its words are sorted in."""
    r = random.Random(3)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(400)})
    for size in (1, 7, 50, 400):
        parts = [words[k:k + size] for k in range(0, len(words), size)]
        numbers, prefixes = {}, {}
        for p, part in enumerate(parts):
            numbering = spelling.Numbering([x[0] for x in parts])
            for word in part:
                for k, node in enumerate(numbering.nodes(p, word)):
                    assert numbers.setdefault(word[:k + 1], node) == node
                    assert prefixes.setdefault(node, word[:k + 1]) == word[:k + 1]
