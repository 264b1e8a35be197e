"""N-gram Jaccard join and suffix-array deduplication against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from demandops.llm import jaccard_join, suffix_dedup
from demandops.llm.shingles import ShingleHasher
from tests.llm.helpers import documents, odd_texts, prose, rows_of


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts):
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if find(j) == find(i) and texts[j][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return sorted(out, key=repr)


def near_copies(rng, n=150):
    base = [prose(rng, k, 5000).split() for k in (4, 6, 12, 30, 60, 120, 300)]
    line = prose(rng, 40, 5000).split()
    out = list(odd_texts())
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, len(w) // 8])):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        if rng.random() < 0.3:
            w = line + w
        out.append((1000 + i, " ".join(w)))
    return out + [(3000 + i, " ".join(line + prose(rng, 12, 10 ** 6).split())) for i in range(25)]


@pytest.mark.parametrize("block", [8000, 4])
def test_jaccard_components(spark, block, monkeypatch):
    """With blocks of four, large blocks are split and joined in parts."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = near_copies(random.Random(block))
    got = jaccard_join.near_duplicates(documents(spark, texts))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(texts)


def test_jaccard_keep_one_and_empty_table(spark):
    texts = near_copies(random.Random(9), 60)
    docs = documents(spark, texts)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute_components(texts)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # one row of every component (by its least id), and every row without shingles
    expect = sorted([c for c in {c for _, n, c in want if n}] + [d for d, n, _ in want if not n], key=repr)
    assert ids == expect
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0


def test_trie_links_unite_what_brute_force_links():
    rng = np.random.default_rng(0)
    for _ in range(200):
        k = int(rng.integers(2, 14))
        base = [np.unique(rng.integers(0, 60, rng.integers(1, 20))) for _ in range(4)]
        sets = []
        for _ in range(k):
            s = set(base[rng.integers(4)].tolist())
            for _ in range(rng.integers(0, 4)):
                s.discard(int(rng.integers(0, 60)))
                s.add(int(rng.integers(0, 60)))
            sets.append(np.array(sorted(s), np.uint64))

        def comps(links):
            p = list(range(k))

            def find(x):
                while p[x] != x:
                    x = p[x]
                return x
            for a, b in links:
                p[find(a)] = find(b)
            return [min(j for j in range(k) if find(j) == find(i)) for i in range(k)]
        true = [(i, j) for i in range(k) for j in range(i)
                if 100 * len({*sets[i].tolist()} & {*sets[j].tolist()}) >= 75 * len({*sets[i].tolist()} | {*sets[j].tolist()})]
        found = jaccard_join.trie_links(sets, list(range(k)))
        assert comps(found) == comps(true)
        assert all((max(x), min(x)) in true for x in found)


def test_trie_of_deeply_nested_sets():
    rng = np.random.default_rng(1)
    line = np.unique(rng.integers(1, 1 << 62, 2600).astype(np.uint64))
    grown = [line[:k] for k in range(590, len(line))]    # a text that grows by a shingle per version
    assert len(grown) > 2000
    found = jaccard_join.trie_links(grown, list(range(len(grown))))
    assert len(found) == len(grown) - 1                  # a tree of links: one component
    assert all(len(grown[i]) * 100 >= 75 * len(grown[j]) for i, j in map(sorted, found))


def test_trie_of_one_word_edits_of_a_long_text():
    rng = random.Random(2)
    base = [rng.randrange(1 << 62) for _ in range(4000)]
    edits = []
    for _ in range(3000):                                # a changed word changes five shingles
        at = rng.randrange(len(base) - 5)
        edits.append(np.array(sorted(set(base[:at] + [rng.randrange(1 << 62) for _ in range(5)] + base[at + 5:])), np.uint64))
    assert len(jaccard_join.trie_links(edits, list(range(len(edits))))) == len(edits) - 1


def test_shingle_hashes_follow_words():
    h = ShingleHasher()
    texts = ["a b c d e f", "A B\tC\nd e  f ", "a b c d", "", "a b c d f", "é" * 70 + " b c d e"]
    s = h.sets(texts)
    assert [len(x) for x in s] == [2, 2, 1, 0, 1, 1]
    assert (s[0] == s[1]).all() and len({x for y in s[2:] for x in y.tolist()}) == 3
    assert all((a == b).all() for a, b in zip(s, [h.sets([t])[0] for t in texts]))


def brute_repeats(texts, length=200):
    seen = {}
    for _, t in texts:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for d, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup_against_brute_force(spark):
    rng = random.Random(5)
    line = prose(rng, 90, 9000)          # about 500 bytes, shared by many
    texts = [(i, t if t is None or len(t) < 5000 else t[:1500]) for i, t in odd_texts()]
    for i in range(40):
        a, n = rng.randrange(0, 300), rng.choice([150, 199, 200, 201, 230, 400, 500])
        texts.append((100 + i, prose(rng, rng.randrange(0, 60), 9000) + " é" + line[a:a + n] + "é " + prose(rng, 20, 9000)))
    texts += [(300, "ab" * 300), (301, "a" * 199), (302, "a" * 199), (303, "abc" * 90 + line + "abc" * 90),
              (304, line), (305, line), (306, line[:200])]
    docs = documents(spark, texts)
    got = suffix_dedup.remove_repeats(docs)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(texts)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_anchors_cover_every_window_once():
    rng = np.random.default_rng(1)
    for n, k in ((300, 256), (900, 3), (400, 1), (250, 2)):
        h = suffix_dedup.grams(suffix_dedup.doubled(rng.integers(0, k, n).astype(np.uint8)), suffix_dedup.Q)
        w = suffix_dedup.WINDOW
        pos, first, last = suffix_dedup.anchors(h)
        got = {i: int(p) for p, a, b in zip(pos, first, last) for i in range(a, b + 1)}
        assert got == {i: i + int(np.argmin(h[i:i + w])) for i in range(len(h) - w + 1)}
        assert sum(b - a + 1 for a, b in zip(first, last)) == len(got)


def test_sorted_groups_are_streamed(monkeypatch):
    """Frequencies and stars of shared tokens, whatever the batches cut."""
    monkeypatch.setattr(jaccard_join, "HOT", 4)
    rng = random.Random(1)
    for _ in range(300):
        rows = sorted((rng.randrange(8) if rng.random() < 0.7 else 3, rng.randrange(12)) for _ in range(rng.randrange(80)))
        batches, at = [], 0
        while at < len(rows):
            part, at = rows[at:(to := at + rng.randrange(9))], to
            batches.append(pa.RecordBatch.from_arrays([pa.array([t for t, _ in part], pa.int64()),
                                                       pa.array([c for _, c in part], pa.int64())], names=["token", "d1"]))
        by = {}
        for t, c in rows:
            by.setdefault(t, set()).add(c)
        got = [x for b in jaccard_join._shared(iter(batches)) for x in zip(*(y.to_pylist() for y in b.columns))]
        assert sorted(got) == sorted((t, c, min(len(v), 5)) for t, v in by.items() if len(v) > 1 for c in v)
        stars = {x for b in jaccard_join._stars(iter(batches)) for x in zip(*(y.to_pylist() for y in b.columns))}
        assert stars == {(c, min(v)) for v in by.values() for c in v if c != min(v)}
