"""The mix: targets, permutations, and the whole result against a replay."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandops.llm import mixing
from tests.llm.helpers import documents, odd_texts, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, share=1.5, cap=2):
    s = [mixing.Source(str(i), n, w) for i, (n, w) in enumerate(zip(sizes, weights))]
    mixing.share_out(s, share * sum(sizes), cap)
    return [x.target for x in s]


def test_targets_stop_at_the_cap_and_the_excess_is_shared():
    # 1500 words by 5 : 2 : 1 would give the first 937.5 of its 100
    assert targets([100, 500, 400], [5, 2, 1]) == pytest.approx([200, 866.6666667, 433.3333333])
    assert targets([10, 10, 980], [5, 2, 1]) == pytest.approx([20, 20, 1460])
    assert targets([0, 8, 0], [5, 2, 1]) == [0, 12, 0]
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 9)
        sizes = [rng.choice([0, 1, 50, 10 ** 4, rng.randrange(10 ** 6)]) for _ in range(n)]
        weights = [(5, 2, 1)[i % 3] for i in range(n)]
        got = targets(sizes, weights)
        assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(g <= 2 * s for g, s in zip(got, sizes))
        rate = [g / w for g, s, w in zip(got, sizes, weights) if g < 2 * s]
        assert not rate or max(rate) == pytest.approx(min(rate))
        assert not rate or all(2 * s <= max(rate) * w * (1 + 1e-9) for g, s, w in zip(got, sizes, weights) if g == 2 * s)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutations_are_permutations(n):
    rows = [mixing.permute(np.arange(n), np.full(n, n), np.full(n, key)).tolist() for key in range(5)]
    assert all(sorted(r) == list(range(n)) for r in rows)
    assert n < 16 or len(set(map(tuple, rows))) == 5
    # many sizes and keys in one call give the same
    x, size, key = np.arange(3).repeat(2), np.array([3, 7] * 3), np.array([1, 2] * 3)
    one = [mixing.permute(x[i:i + 1], size[i:i + 1], key[i:i + 1])[0] for i in range(6)]
    assert mixing.permute(x, size, key).tolist() == one


def corpus(spark, seed=0):
    rng = random.Random(seed)
    docs = documents(spark, odd_texts()).withColumn("source", F.lit("a"))
    for name, n in (("b", 60), (None, 12), ("éé", 8), ("none", 0), ("z", 1)):
        rows = [(100 + i, " ".join(f"{name}{i}x{j}" for j in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(n)]
        docs = docs.unionByName(documents(spark, rows or [(7, " \t ")]).withColumn("source", F.lit(name).cast("string")))
    return docs


def replay(docs, sources, slots, block):
    """(doc_id, size, taken) by laying out all words of a source in a list."""
    order, out = defaultdict(list), []
    for r in docs:
        words = WORD.findall(r["text"] or "")
        order[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, len(words), r["text"] or ""))
    for i, s in enumerate(sources):
        stream = [d for d, row in enumerate(sorted(order[s.name])) for _ in range(row[2])]
        taken = Counter()
        for index in slots[i]:
            taken.update(stream[index * block:(index + 1) * block])
        out += [(row[1] if row[0] else None, row[2], taken[d]) for d, row in enumerate(sorted(order[s.name]))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,shard", [(16, 50), (128, 1 << 15), (7, 3)])
def test_mix_equals_a_replay_of_its_slots(spark, block, shard):
    docs = corpus(spark)
    if block == 7:
        docs = docs.filter("length(text) < 5000 or text is null")
    made = mixing.mix(docs, block=block, shard=shard)
    slots = made.slots.collect()
    by_source = defaultdict(list)
    for r in slots:
        by_source[r["_src"]].append(r["index"])
    names = [s.name for s in made.sources]
    assert names == sorted(names, key=lambda n: (n is None, (n or "").encode()))
    for i, s in enumerate(made.sources):
        uses = Counter(by_source[i])
        assert sum(uses.values()) == s.quota and all(0 <= x < s.blocks for x in uses)
        # every block comes up once before any comes up again
        assert not uses or set(uses.values()) <= {s.quota // s.blocks, -(-s.quota // s.blocks)}
    # every place of every shard is filled once
    places = sorted((r["shard"], r["position"]) for r in slots)
    assert places == [(i // shard, i % shard) for i in range(len(slots))]
    got = mixing.report(made)
    # rows that are equal in all that orders them may swap their shares
    assert rows_of(got, "doc_id", "size", "taken") == replay(docs.collect(), made.sources, by_source, block)
    assert got.filter(F.col("taken") > 2 * F.col("size")).count() == 0
    assert rows_of(mixing.report(mixing.mix(docs, block=block, shard=shard)), *got.columns) == rows_of(got, *got.columns)
    for s, i in zip(made.sources, range(99)):
        words = sum(min(block, s.size - block * x) for x in by_source[i])
        assert abs(words - s.target) <= 2 * block


def test_the_mix_holds_the_words_of_its_blocks(spark):
    docs = corpus(spark).filter("length(text) < 5000")
    made = mixing.mix(docs, block=16, shard=64)
    rows = mixing.blocks_of(made, docs).collect()
    assert len(rows) == sum(s.quota for s in made.sources)
    stream = defaultdict(list)
    for r in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, len(WORD.findall(r["text"])))):
        stream[r["source"]] += WORD.findall(r["text"])
    for r in rows:
        assert Counter(r["words"]) == Counter(stream[r["source"]][r["index"] * 16:(r["index"] + 1) * 16])


def test_shards_draw_from_a_multinomial(spark):
    """Counts of the shards scatter as a multinomial's do, and add up to the quotas."""
    quotas, shard = [4000, 3000, 2000, 1000], 100
    rows = mixing.draw_counts(spark, quotas, shard, 5).collect()
    counts = np.zeros((100, 4))
    for r in rows:
        counts[r["shard"], r["_src"]] += r["n"]
    assert counts.sum(axis=0).tolist() == quotas and set(counts.sum(axis=1)) == {100}
    assert counts.std(axis=0) == pytest.approx([24 ** .5, 21 ** .5, 16 ** .5, 3], rel=0.3)
    numbers = sorted((r["_src"], r["first"] + i) for r in rows for i in range(r["n"]))
    assert numbers == [(s, i) for s, q in enumerate(quotas) for i in range(q)]


def test_no_words_and_no_rows(spark):
    blank = corpus(spark).filter("text is null or trim(text) = ''")
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.report(mixing.mix(blank)).collect()} == {(0, 0.0, 0)}
    assert mixing.report(mixing.mix(corpus(spark).limit(0))).collect() == []
