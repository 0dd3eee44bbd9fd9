"""Merkle manifest against a plain recursive tree, with small blocks so that several butterfly rounds run."""

import random
import zlib
from hashlib import sha256

import pytest

from ledgerlake.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, node string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, n_chars):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h(*map(field, (row[0], row[3], row[2], n_chars, row[1])))


def grow(nodes):
    """All levels of the tree over ``nodes``."""
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([h(*rows[-1][k:k + 2]) for k in range(0, len(rows[-1]), 2)])
    return rows


def way(rows, k):
    out = []
    for row in rows[:-1]:
        out.append((row[k ^ 1] if k ^ 1 < len(row) else None, k & 1))
        k >>= 1
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    trees = {}
    for r in rows:
        trees.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    grown = {}
    for key, members in trees.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        grown[key] = grow([leaf(r, r[4]) for r in members])
    keys = sorted(grown)
    top = grow([grown[k][-1][0] for k in keys])
    out = []
    for n, key in enumerate(keys):
        for k, r in enumerate(trees[key]):
            path = way(grown[key], k) + way(top, n)
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, r[4] + 1 if hit else r[4])
            for other, left in path:
                node = h(other, node) if other and left else h(node, other or "")
            out.append((r[0], leaf(r, r[4]), grown[key][-1][0], top[-1][0], h(*[o for o, _ in path if o]), node,
                        node == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r)[:7] for r in df.collect()], key=repr)


def rows_of(n, langs, seed):
    r = random.Random(seed)
    return [(r.choice([None, r.randrange(n)]) if k % 9 == 0 else k, r.choice(["", None, "täxt\n" * r.randrange(4), "x" * 3000]),
             r.choice(langs), r.choice([None, "s", ""]), r.choice([None, 0, 7, 10**12]), "clash", k, "c") for k in range(n)]


@pytest.mark.parametrize("n, langs, block, fan", [
    (1, ["en"], 2, 1), (5, ["en", None], 1, 1), (203, ["en"] * 7 + ["", "de", None, "fr"], 1, 1),
    (203, ["en"] * 7 + ["", "Ωx", None, "é"], 2, 2), (65, ["en"], 3, 2), (64, ["en"], 1, 2),
    (120, [f"l{k}" for k in range(40)], 1, 1)])
def test_manifest_equals_brute_force(spark, n, langs, block, fan):
    rows = rows_of(n, langs, n + block)
    assert got(merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(5), block, fan)) == brute(rows)


def test_equal_rows_and_production_blocks(spark):
    rows = [(5, "same", "en", "s", 4, "", 0, "")] * 40 + [(None, None, None, None, None, "", 0, "")] * 3
    assert got(merkle.manifest(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_proof_alone_gives_the_root(spark):
    """The proof column lists exactly the siblings that the digest covers."""
    rows = rows_of(30, ["en", "de"], 3)
    for r in merkle.manifest(spark.createDataFrame(rows, DOCS), 1, 1).collect():
        assert h(*r.proof) == r.proof_sha256


def test_changed_text_changes_the_root(spark):
    rows = rows_of(20, ["en", "de"], 4)
    other = [(*rows[0][:1], "changed", *rows[0][2:]), *rows[1:]]
    roots = [merkle.manifest(spark.createDataFrame(x, DOCS)).first().root for x in (rows, other)]
    assert roots[0] != roots[1]
