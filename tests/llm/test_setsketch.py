"""SetSketch near duplicates against brute force; sketch and likelihood against their definitions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import setsketch
from ledgerlake.llm.common import Memo

DOCS = "doc_id long, text string, node long, n long, component string, doc long"


def set_of(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "").translate(table)).split(" ") if w]
    if not words:
        return set()
    return {tuple(words[k:k + 3]) for k in range(max(1, len(words) - 2))}


def brute(rows):
    sets = [set_of(r[1]) for r in rows]
    low = [(r[0] is not None, r[0] or 0) for r in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                group[top(a)] = top(b)
    least = {}
    for k in range(len(rows)):
        least[top(k)] = min(least.get(top(k), low[k]), low[k])
    return sorted(((r[0], len(sets[k]), least[top(k)][1] if least[top(k)][0] else None)
                   for k, r in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def family(r, base, copies, edits):
    out = []
    for _ in range(copies):
        words = base[:]
        for _ in range(r.randrange(edits + 1)):
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus(seed):
    """Copies from exact to just beyond the limit, chains, short and empty texts, and clashing ids."""
    r = random.Random(seed)
    texts = []
    for n in (8, 30, 120, 400):
        base = [f"w{r.randrange(3000)}" for _ in range(n)]
        texts += family(r, base, 12, max(1, n // 25))
    drift = [f"c{k}" for k in range(150)]
    for k in range(12):                                      # a chain: ends are far apart
        drift = drift[:k * 9] + [f"d{k}x{j}" for j in range(3)] + drift[k * 9 + 3:]
        texts.append(" ".join(drift))
    texts += ["", None, " \n", "one", "One", "one two", "ONE\ttwo", "a b c", "a b c", "É b c", "é b c", "x " * 20_000]
    r.shuffle(texts)
    return [(k if k % 13 else None, t, 1, 2, "c", 3) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert got(setsketch.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3))) == brute(rows)


def test_rows_of_one_id_keep_their_own_links(spark):
    r = random.Random(5)
    a, b, c = (" ".join(f"{x}{r.randrange(500)}" for _ in range(60)) for x in "abc")
    rows = [(1, a, 0, 0, "", 0), (1, b, 0, 0, "", 0), (2, b, 0, 0, "", 0), (3, c, 0, 0, "", 0), (3, a, 0, 0, "", 0),
            (4, c, 0, 0, "", 0), (4, c, 0, 0, "", 0)]
    assert got(setsketch.near_duplicates(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_large_group_of_near_copies(spark):
    """More members in a band than one round has turns for."""
    r = random.Random(6)
    base = [f"w{r.randrange(5000)}" for _ in range(90)]
    rows = [(k, t, 0, 0, "", 0) for k, t in enumerate(family(r, base, 220, 3))]
    assert got(setsketch.near_duplicates(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_empty_table(spark):
    assert setsketch.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_sketches_merge_and_estimate():
    memo, r = Memo(setsketch._word_hash), random.Random(7)
    for share in (0.0, 0.3, 0.85, 0.95):
        errors = []
        for k in range(30):
            total = 600
            both = int(share * total)
            rest = total - both
            common = np.array([r.getrandbits(64) for _ in range(both)], np.uint64)
            a = np.unique(np.concatenate([common, np.array([r.getrandbits(64) for _ in range(rest // 2)], np.uint64)]))
            b = np.unique(np.concatenate([common, np.array([r.getrandbits(64) for _ in range(rest - rest // 2)], np.uint64)]))
            sa, sb = setsketch.sketch(a), setsketch.sketch(b)
            assert (setsketch.merge(sa, sb) == setsketch.sketch(np.union1d(a, b))).all()
            best, short = setsketch.similarity(sa[None], sb[None], np.array([len(a)]) * 1.0, np.array([len(b)]) * 1.0)
            errors.append(best[0] - share)
            if share >= 0.85:
                assert short[0] <= setsketch.MARGIN
            if share == 0.0:
                assert short[0] > setsketch.MARGIN
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08
    assert len(setsketch.shingles("", memo)) == 0


def test_bands_miss_no_planted_pair():
    """Sets at the limit share a band (the miss rate is far below one in this many)."""
    r = np.random.default_rng(9)
    for _ in range(300):
        common = r.integers(0, 1 << 63, 85, dtype=np.int64).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, r.integers(0, 1 << 63, k, dtype=np.int64).astype(np.uint64)])) for k in (7, 8))
        x, y = (setsketch.sketch(s).reshape(-1, setsketch.BAND) for s in (a, b))
        assert (x == y).all(axis=1).any()


@pytest.mark.parametrize("block, heavy", [(512, 2000), (16, 2000), (24, 20)])
def test_bands_with_several_components_in_blocks(spark, monkeypatch, block, heavy):
    """Copies around the limit: most bands hold several components, many of them linked by a few members only."""
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "HEAVY", heavy)
    r = random.Random(8)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    rows = [(k, t, 0, 0, "", 0) for k, t in enumerate(family(r, base, 150, 9))]
    want = brute(rows)
    assert len({c for _, _, c in want}) > 5
    assert got(setsketch.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5))) == want


def sketched_pairs(count, seed):
    """Registers and sizes of pairs of random sets of all similarities."""
    r = np.random.default_rng(seed)
    sides = ([], [])
    for _ in range(count):
        size = int(r.integers(1, 300))
        common = r.integers(0, 1 << 63, int(size * r.choice([0, 0.5, 0.75, 0.8, 0.85, 0.9, 1]))).astype(np.uint64)
        for side in sides:
            own = r.integers(0, 1 << 63, int(r.integers(0, size - len(common) + 1)) + 1).astype(np.uint64)
            side.append(np.unique(np.concatenate([common, own])))
    return [np.array([setsketch.sketch(s) for s in side]) for side in sides], [np.array([len(s) for s in side]) * 1.0 for side in sides]


def test_pairs_are_ruled_out_as_by_the_search(monkeypatch):
    (a, b), (n_a, n_b) = sketched_pairs(1500, 10)
    want = setsketch.similarity(a, b, n_a, n_b)[1] <= setsketch.MARGIN
    assert 0.1 < want.mean() < 0.9
    searched, search = [], setsketch.similarity
    monkeypatch.setattr(setsketch, "similarity", lambda a, *more: searched.append(len(a)) or search(a, *more))
    assert (setsketch.may_reach(a, b, n_a, n_b) == want).all()
    assert sum(searched) < 0.25 * len(a)


@pytest.mark.parametrize("two_blocks", [False, True])
def test_members_of_a_cell_are_compared_together(monkeypatch, two_blocks):
    """One search for all pairs of a cell instead of one per member, with the same members kept."""
    (a, b), (n_a, n_b) = sketched_pairs(120, 11)
    registers, n = np.concatenate([a, b]), np.concatenate([n_a, n_b])
    side = np.repeat([0, 1], 120) if two_blocks else np.zeros(240, int)
    part = np.arange(240) % 100
    rows = pa.table({"side": pa.array(side, pa.int32()), "part": part, "n": n.astype(np.int64),
                     "registers": [x.tobytes() for x in registers]})
    keys = registers.view("<i8")
    want = np.zeros(240, bool)
    for x in range(240):
        for y in range(x + 1, 240):
            if (part[x] != part[y] and (side[x] != side[y] or not two_blocks) and 100 * min(n[x], n[y]) >= 85 * max(n[x], n[y])
                    and not (keys[x, :3] == keys[y, :3]).any()
                    and setsketch.similarity(registers[x:x + 1], registers[y:y + 1], n[x:x + 1], n[y:y + 1])[1][0] <= setsketch.MARGIN):
                want[[x, y]] = True
    calls, search = [], setsketch.similarity
    monkeypatch.setattr(setsketch, "similarity", lambda *of: calls.append(1) or search(*of))
    assert (setsketch._likely_members(rows, 3) == want).all() and want.any() and not want.all()
    assert len(calls) <= 240 * 240 // setsketch.PAIRS + 1
