"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from demandops.llm import lexical_search as LS
from tests.llm.helpers import documents, odd_texts, prose, rows_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(texts, queries, k):
    docs = [(d, Counter(terms(t))) for d, t in texts]
    sizes = [sum(c.values()) for _, c in docs]
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    merged = {}
    for q, t in queries:
        merged.setdefault(q, set()).update(terms(t))
    out = []
    for q, wanted in merged.items():
        scored = []
        for (d, c), n in zip(docs, sizes):
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // length))) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(q, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def corpus(seed):
    """Prose with copies, near copies, long texts and shared passages."""
    rng = random.Random(seed)
    texts = odd_texts() + [(100 + i, prose(rng, rng.choice([1, 3, 20, 80, 400]), 300)) for i in range(250)]
    passage = prose(rng, 12, 300)
    texts += [(1000 + i, passage) for i in range(30)] + [(2000 - i, "Été ÀB 12_34 " + passage.upper()) for i in range(30)]
    queries = [(i, prose(rng, rng.choice([1, 2, 10, 30]), 300)) for i in range(25)]
    queries += [(50, passage), (51, None), (52, "!!"), (53, "été_12"), (None, "w1 w2"), (54, "w3 w3 W3"), (54, "w4"),
                (55, "absent"), (55, "absent")]
    return texts, queries


@pytest.mark.parametrize("shard,k,size", [(8192, 10, 1 << 23), (16, 3, 1 << 23), (40, 10, 300)])
def test_search_equals_scoring_every_document(spark, shard, k, size):
    """Also with small shards and with queries in many blocks."""
    texts, queries = corpus(shard)
    bench = spark.createDataFrame([(q, t, "x") for q, t in queries], "item_id long, text string, score string")
    got = LS.search(documents(spark, texts).repartition(3), bench, k, shard=shard, query_bytes=size)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == brute(texts, queries, k)


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "red fox"), ("a", "red fox"), (None, "red fox"), ("c", "red"), ("d", "")], "id string, body string")
    bench = spark.createDataFrame([("q", "fox red")], "q string, body string")
    find = lambda d, b: LS.search(d, b, 2, "id", "body", "q", "body")
    assert [(r["rank"], r["id"]) for r in find(docs, bench).orderBy("rank").collect()] == [(1, None), (2, "a")]
    assert find(docs.limit(0), bench).collect() == [] and find(docs, bench.limit(0)).collect() == []
    assert find(docs.filter("id = 'd'"), bench).collect() == []


def test_terms_of_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(LS, "SLICE", 7)
    rng = random.Random(1)
    text = "".join(rng.choice("aB9 é-_\n") for _ in range(3000)) + "x" * 50
    assert [t.decode() for part in LS.terms_of(text.encode()) for t in part] == terms(text)


def test_range_maxima():
    rng = np.random.default_rng(2)
    term = np.sort(rng.integers(0, 20, 500))
    doc = np.concatenate([np.sort(rng.choice(100, n, replace=False)) for n in np.bincount(term)])
    p = LS.Postings(term, doc.astype(np.int32), rng.integers(1, 9, 500), 100)
    for first, end in zip(p.first, p.end):
        lo, hi = np.triu_indices(end - first + 1)
        place, value = p.maxima(lo + first, hi + first)
        for a, b, at, v in zip(lo + first, hi + first, place, value):
            assert (a == b and v == 0) or (a <= at < b and v == p.impact[a:b].max() and at == a + p.impact[a:b].argmax())


def test_bounds_prune(monkeypatch):
    """A query of one rare and one common term opens few intervals."""
    splits = []
    plain = LS.Postings.maxima
    monkeypatch.setattr(LS.Postings, "maxima", lambda self, lo, hi: splits.append(len(lo)) or plain(self, lo, hi))
    n = 5000
    term = np.r_[np.zeros(n, int), np.ones(12, int)]
    doc = np.r_[np.arange(n), np.arange(0, 1200, 100)].astype(np.int32)
    impact = np.r_[np.random.default_rng(0).integers(1, 50, n), np.full(12, 1000)]
    found = LS.Postings(term, doc, impact, n).search(np.array([0, 1]), 10, [])
    total = impact[:n].copy()
    total[np.arange(0, 1200, 100)] += 1000
    assert [-s for s, _, _ in found] == sorted(total.tolist(), reverse=True)[:10]
    assert sum(splits) < 500
