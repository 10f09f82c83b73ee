"""The manifest against a plain Merkle tree."""

from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from envhealth.llm import merkle

from .conftest import ODD, documents, prose


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """Levels from the leaves to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels, i):
    """For each level the side of the sibling and the sibling, which a lone node has not."""
    out = []
    for nodes in levels[:-1]:
        other = i ^ 1
        out.append((other - i, nodes[other] if other < len(nodes) else ""))
        i //= 2
    return out


def fold(node, steps):
    for side, other in steps:
        node = h(other, node) if side < 0 else h(node, other)
    return node


def plain(rows, claim):
    """Rows `(doc_id, leaf, subroot, root, proof, folded, verified)` of `(doc_id, text, lang, source, n_chars)`."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row), claim(row) or "", row))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(groups[lang], key=lambda x: x[:4])]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        for i, (_, _, own, claimed, row) in enumerate(sorted(groups[lang], key=lambda x: x[:4])):
            steps = path(trees[lang], i) + path(top, g)
            found, root = fold(claimed or own, steps), top[-1][0]
            out.append((row[0], own, trees[lang][-1][0], root, h(*[s[1] for s in steps]), found, found == root))
    return sorted(map(repr, out))


def changed(row):
    """A claim for every third id: one more character."""
    if row[0] is None or row[0] % 3 or row[4] is None:
        return None
    return leaf(*row[:4], row[4] + 1)


def audited(docs):
    more = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.audited(docs, {"n_chars": more}).drop("place")


def check(spark, rows):
    docs = documents(spark, rows)
    got = sorted(repr(tuple(r)) for r in audited(docs).collect())
    assert got == plain([(*r, len(r[1] or "")) for r in rows], changed)


@pytest.mark.parametrize("n", [1, 2, 3, 1024, 1025, 3000])
def test_manifest_equals_plain_trees(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-500, 10 * n), n - 1) + [2**62]
    langs = ["en"] * 8 + ["de", None, "", "é"]
    check(spark, [(i, prose(abs(i) % 50, 5), rng.choice(langs), "s") for i in ids])


def test_manifest_of_many_groups(spark):
    check(spark, [(i, "x", f"l{i % 1500}", None) for i in range(2000)])


def test_manifest_of_odd_rows(spark, none):
    check(spark, ODD + [(None, None, None, None), (None, "a", None, None), (6, "other", "en", "b")])
    assert audited(none).count() == 0


def test_one_id_in_a_third_of_all_rows(spark):
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i // 9}", "en", "s") for i in range(1800)]
    check(spark, rows)


def test_only_changed_rows_fail(spark):
    rows = [(i, prose(i, 5), "en", "s") for i in range(90)]
    got = audited(documents(spark, rows)).collect()
    assert {r.doc_id for r in got if not r.verified} == set(range(0, 90, 3))
    assert all(r.verified for r in merkle.audited(documents(spark, rows)).collect())
