"""Merkle manifest against a plain recursion over the same leaves."""

import hashlib

import pytest
from pyspark.sql import functions as F

from demandops.llm import merkle
from tests.llm.helpers import documents, odd_texts, rows_of

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def climb(level):
    """(root, siblings bottom to top of every leaf)."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for p, i in zip(paths, at):
            if i ^ 1 < len(level):
                p.append(level[i ^ 1])
        at = [i // 2 for i in at]
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return level[0], paths


def brute(rows):
    """(doc_id, leaf, subroot, root, proof digest) of every row."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)), r["doc_id"]))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    found = {k: climb([key[2] for key, _ in sorted(trees[k])]) for k in order}
    root, top = climb([found[k][0] for k in order])
    return sorted(((d, key[2], found[k][0], root, sha("".join(p + above)))
                   for k, above in zip(order, top)
                   for (key, d), p in zip(sorted(trees[k]), found[k][1])), key=repr)


def build(docs, levels):
    return merkle.manifest(docs, merkle.leaf_digest([F.col(c) for c in COLUMNS]), "lang", "doc_id",
                           keep=["doc_id", "n", "t1", "Root"], levels=levels)


def corpus(spark, per_lang):
    parts = None
    for k, (lang, n) in enumerate(per_lang.items()):
        rows = [(10_000 * k + 7 * i, f"text {i} of {lang}") for i in range(n)]
        part = documents(spark, (odd_texts() if k == 0 else []) + rows, lang)
        parts = part if parts is None else parts.unionByName(part)
    return parts.withColumn("Root", F.lit("clashes"))


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_equals_the_recursion(spark, levels):
    docs = corpus(spark, {"en": 41, None: 1, "éé": 2, "zz": 17, "de": 4, "d": 3})
    made = build(docs, levels)
    got = made.withColumn("proof", merkle.proof_digest())
    assert rows_of(got, "doc_id", "leaf", "subroot", "root", "proof") == brute(docs.collect())
    assert made.columns == ["doc_id", "n", "t1", *merkle.RESULTS]
    assert made.filter(merkle.fold_to_root(F.col("leaf")) != F.col("root")).count() == 0


def test_a_changed_row_no_longer_verifies(spark):
    docs = corpus(spark, {"en": 30, "fr": 9})
    changed = merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")])
    docs = docs.withColumn("seen", changed)
    rows = merkle.manifest(docs, merkle.leaf_digest([F.col(c) for c in COLUMNS]), "lang", "doc_id", keep=["seen"])
    assert rows.filter(merkle.fold_to_root(F.col("seen")) == F.col("root")).count() == 0


def test_one_row_and_no_rows(spark):
    one = build(corpus(spark, {"en": 0}).filter("doc_id = 8"), 8).first()
    assert one.siblings == [] and one.tree_siblings == [] and one.leaf == one.subroot == one.root
    assert build(corpus(spark, {"en": 0}).limit(0), 8).collect() == []


def test_witnesses_grow_while_leaves_are_appended():
    """After every append, the witnesses of all open subtrees are right."""
    acc, leaves = merkle.OpenSubtrees(), [sha(str(i)) for i in range(23)]
    for n, x in enumerate(leaves, 1):
        acc.append(x)
        for level, root, start, end in acc.open:
            want, paths = climb(leaves[start:end])
            assert (root, acc.witness[start:end], end - start) == (want, paths, 1 << level)
        assert acc.open[-1][3] == n
    assert acc.close() == climb(leaves)[0]
