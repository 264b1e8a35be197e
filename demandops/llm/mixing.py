"""Mixing sources to target weights.

The words of a source, its documents in the order of their ids, are one stream
that is cut into blocks of a fixed number of words (the last one may be
shorter). The mix is a row of slots, a block each, dealt to output shards of a
fixed number of slots. Every shard draws its counts of the sources from a
multinomial distribution. The slots of a source are numbered across the
shards; slot ``j`` takes block ``permutation(j mod blocks)`` of the source, with
another pseudorandom permutation for every round through it, so no block is
taken again before all were. Slots and blocks are joined by that index.

A source may have a whole number of slots, its quota, which is its target in
blocks. Where more are drawn than a quota allows, an even share of them over
all shards is drawn anew, from the sources that have room, until every shard
is full. So the counts meet the targets to within a
block, and with a cap of two no document is taken more than twice.

All draws depend on the seed and the shard's number only, and streams are
ordered by (source, id, size, text digest), so reruns agree. The streams are
laid out by a range sort, which splits a source that holds most rows. Only the
list of sources (one row each, with the caller's weights) is held by the
driver.

Defined results: a null source is a source of its own, the last; null, empty
and blank texts have no words, size 0 and are never taken; repeated rows are
documents of their own; null ids come first in their stream; a source without
words has target 0; a long text is cut into as many blocks as it needs; an
empty table or one without words gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from demandops.llm.common import cut

BLOCK = 128              #: words of a block
SHARD = 1 << 15          #: slots of an output shard
TASK_SLOTS = 1 << 18     #: slots that a task makes, about
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0x9E3779B97F4A7C15  #: 2^64 over the golden ratio: spreads consecutive numbers


@dataclass
class Source:
    """A source of the mix: its words, their target, its blocks and quota."""
    name: str | None
    size: int
    weight: float
    target: float = 0.0
    blocks: int = 0
    quota: int = 0


@dataclass
class Mix:
    """layout: (_src, _row, _id, _size, _digest, _start) of every document, its
    place in its source's stream; slots: (shard, position, source, _src, index); the
    sources in order."""
    layout: DataFrame
    slots: DataFrame
    sources: list[Source]
    block: int


# -- targets --------------------------------------------------------------------

def share_out(sources: Sequence[Source], total: float, cap: float) -> None:
    """Targets: ``total`` by weight, none above ``cap`` times its source's
    size; what is above goes to the others by weight."""
    free, rest = [s for s in sources if s.size and s.weight > 0], total
    while free:
        weights = sum(s.weight for s in free)
        above = [rest * s.weight / weights > cap * s.size for s in free]
        for s, full in zip(free, above):
            s.target = float(cap * s.size) if full else rest * s.weight / weights
        if not any(above):
            return
        rest -= sum(s.target for s, full in zip(free, above) if full)
        free = [s for s, full in zip(free, above) if not full]


def set_quotas(sources: Sequence[Source], block: int, cap: float) -> None:
    """Targets in whole slots: largest remainders, never over the cap."""
    exact = []
    for s in sources:
        s.blocks = -(-s.size // block)
        e = s.target * s.blocks / s.size if s.size else 0.0
        s.quota = min(int(e), int(cap * s.blocks))
        exact.append(e)
    left = round(sum(exact)) - sum(s.quota for s in sources)
    by_rest = sorted(range(len(sources)), key=lambda i: (sources[i].quota - exact[i], i))
    for i in by_rest[:max(0, left)]:
        if sources[i].quota + 1 <= int(cap * sources[i].blocks):
            sources[i].quota += 1


# -- pseudorandom permutations ------------------------------------------------------

def _scramble(x: np.ndarray) -> np.ndarray:
    """A mixing function of 64 bits: two rounds of multiply and shift."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 6) -> np.ndarray:
    """The place of every ``x`` < ``n`` in the permutation of 0..n-1 that
    ``key`` names: a balanced Feistel network over the next power of four,
    walked until it is back below ``n``."""
    n, out = n.astype(np.uint64), x.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2 + 1e-9)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    key = _scramble(key.astype(np.uint64))
    todo = np.flatnonzero(n > 1)
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(rounds):
            mixed = _scramble(right + k + np.uint64(GOLDEN * r % (1 << 64)))
            left, right = right, left ^ (mixed & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _key(*parts: np.ndarray | int) -> np.ndarray:
    """One 64-bit key of several whole numbers."""
    out = np.zeros(1, np.uint64)
    for p in parts:
        out = _scramble(out + np.atleast_1d(p).astype(np.uint64) + np.uint64(GOLDEN))
    return out


# -- streams of words -----------------------------------------------------------------

def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _running(schema: T.StructType):
    """Words of the same source before each row, within its partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            src, size = b.column("_src").to_numpy(), b.column("_size").to_numpy()
            begin = np.cumsum(size) - size
            new = np.r_[True, src[1:] != src[:-1]]
            start = begin - begin[new][np.cumsum(new) - 1]
            if src[0] == last:
                start[:np.argmax(new[1:]) + 1 if new[1:].any() else len(new)] += before
            last, before = src[-1], int(start[-1] + size[-1])
            cols = [b.column(i) for i in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.full(len(src), part, np.int32)), pa.array(start)], names=schema.names)
    return run


def lay_out(sized: DataFrame) -> DataFrame:
    """``sized`` (_src, _id, _size, _digest) with _start, the words of the
    source before each row, and _row, a number of its own."""
    order = ["_src", "_id", "_size", "_digest"]
    n = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*sized.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_in", T.LongType())])
    runs = cut(sized.repartitionByRange(n, *order).sortWithinPartitions(*order)
               .mapInArrow(_running(schema), schema).withColumn("_row", F.monotonically_increasing_id()), "streams")
    w = W.partitionBy("_src").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # a row for each source that a range partition holds: partitions + sources at most
    before = (runs.groupBy("_src", "_part").agg(F.sum("_size").alias("_sum"))
              .select("_src", "_part", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_before")))
    return (runs.join(F.broadcast(before), ["_src", "_part"])
            .select("_src", "_row", "_id", "_size", "_digest", (F.col("_before") + F.col("_in")).alias("_start")))


# -- draws -------------------------------------------------------------------------------

def _draw(room: np.ndarray, seed: int, turn: int):
    """Multinomial counts of the open slots of each shard."""
    chance = room / room.sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, n in zip(b.column("shard").to_pylist(), b.column("n").to_pylist()):
                counts = np.random.default_rng([seed, turn, shard]).multinomial(n, chance)
                src = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(src), shard, np.int64)), pa.array(src.astype(np.int32)),
                     pa.array(counts[src].astype(np.int64))], names=["shard", "_src", "n"])
    return run


def draw_counts(spark, quotas: Sequence[int], shard: int, seed: int) -> DataFrame:
    """(shard, _src, n, first): how many slots of each shard a source has, and
    the number of the first of them among the slots of the source."""
    total, room = sum(quotas), np.array(quotas, np.int64)
    todo = (spark.range(-(-total // shard)).select(
        F.col("id").alias("shard"), F.least(F.lit(shard), total - F.col("id") * shard).cast("long").alias("n")))
    taken, turn = [], 0
    whole = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  (products beyond 64 bits)
    while room.sum():
        drawn = cut(todo.mapInArrow(_draw(room.astype(np.float64), seed, turn), "shard long, _src int, n long"), "draws")
        sums = dict(drawn.groupBy("_src").agg(F.sum("n")).collect())  # one row a source
        limits = spark.createDataFrame(
            [(i, int(quotas[i] - room[i]), int(min(room[i], n)), int(n)) for i, n in sums.items()],
            "_src int, _used long, _fit long, _sum long")
        w = W.partitionBy("_src").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)

        def fitting(c: str) -> Column:
            """Of the first so many slots of a source, those that fit: the same share everywhere."""
            return F.call_function("div", whole(c) * whole("_fit"), whole("_sum"))
        dealt = cut(drawn.withColumn("_before", F.coalesce(F.sum("n").over(w), F.lit(0)))
                    .withColumn("_after", F.col("_before") + F.col("n")).join(F.broadcast(limits), "_src")
                    .select("shard", "_src", "n", (fitting("_after") - fitting("_before")).alias("_kept"),
                            (F.col("_used") + fitting("_before")).alias("first")), "dealt")
        taken.append(dealt.filter("_kept > 0").select("shard", "_src", F.col("_kept").alias("n"), "first", F.lit(turn).alias("_turn")))
        for i, n in sums.items():
            room[i] -= min(room[i], n)
        todo = dealt.groupBy("shard").agg(F.sum(F.col("n") - F.col("_kept")).alias("n")).filter("n > 0")
        turn += 1
    if not taken:
        return spark.createDataFrame([], "shard long, _src int, n long, first long, _turn int")
    return reduce(DataFrame.unionByName, taken)


def _slots(blocks: Sequence[int], total: int, shard: int, seed: int):
    """A row for every slot: its shard, place there, source and block."""
    counts = np.array(blocks, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, src, n, first, at in zip(*(b.column(c).to_pylist() for c in ("shard", "_src", "n", "first", "_at"))):
                j, size = np.arange(first, first + n), counts[src]
                index = permute(j % size, np.full(n, size), _key(seed, 1, src, j // size))
                wide = min(shard, total - k * shard)
                place = permute(np.arange(at, at + n), np.full(n, wide), np.full(n, _key(seed, 2, k)[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, k)), pa.array(place), pa.array(np.full(n, src, np.int32)), pa.array(index)],
                    names=["shard", "position", "_src", "index"])
    return run


# -- the mix -------------------------------------------------------------------------------

def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: int = 2,
        id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
        shard: int = SHARD, seed: int = 1) -> Mix:
    """Plan a mix of ``share`` times all words. Sources in order of their names
    (by code point, null last) have ``weights`` in turn."""
    spark = docs.sparkSession
    t = F.col(f"`{text}`")
    sized = cut(docs.select(F.col(f"`{source}`").cast("string").alias("_name"), F.col(f"`{id_col}`").alias("_id"),
                            word_count(t).alias("_size"), F.xxhash64(t).alias("_digest")), "sizes")
    found = sized.groupBy("_name").agg(F.sum("_size")).collect()  # the list of sources
    found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    sources = [Source(n, int(size), float(weights[i % len(weights)])) for i, (n, size) in enumerate(found)]
    share_out(sources, share * sum(s.size for s in sources), cap)
    set_quotas(sources, block, cap)
    numbers = spark.createDataFrame([(s.name, i) for i, s in enumerate(sources)], "_name string, _src int")
    numbered = sized.alias("d").join(F.broadcast(numbers.alias("s")), F.expr("d._name <=> s._name")).select("_src", "_id", "_size", "_digest")
    layout = lay_out(numbered)
    total = sum(s.quota for s in sources)
    counts = draw_counts(spark, [s.quota for s in sources], shard, seed)
    w = W.partitionBy("shard").orderBy("_turn", "_src").rowsBetween(W.unboundedPreceding, -1)
    # a row of counts becomes many slots: tasks are cut by slots, not by bytes of counts
    spread = counts.repartition(max(1, -(-total // TASK_SLOTS)), "shard")
    slots = spread.withColumn("_at", F.coalesce(F.sum("n").over(w), F.lit(0))).mapInArrow(
        _slots([s.blocks for s in sources], total, shard, seed), "shard long, position long, _src int, index long")
    slots = cut(slots, "slots")
    return Mix(layout, slots, sources, block)


def _in_block(mix: Mix, index: Column) -> tuple[Column, Column]:
    """Of a document, the words before a block and those in it."""
    begin, n = F.col("_start"), F.lit(mix.block).cast("long")
    lo = F.greatest(begin, index * n)
    return lo - begin, F.least(begin + F.col("_size"), (index + 1) * n) - lo


def _indexes(mix: Mix) -> Column:
    """The blocks that a document with words lies in."""
    n = F.lit(mix.block).cast("long")
    return F.sequence(F.call_function("div", F.col("_start"), n),
                      F.call_function("div", F.col("_start") + F.col("_size") - 1, n))


def taken_words(mix: Mix) -> DataFrame:
    """(_src, _row, _id, _size, taken) of every document: words that the mix
    takes, repeats counted."""
    uses = mix.slots.groupBy("_src", "index").agg(F.count("*").alias("_uses"))
    parts = mix.layout.filter("_size > 0").withColumn("index", F.explode(_indexes(mix)))
    taken = (parts.select("_src", "index", "_row", _in_block(mix, F.col("index"))[1].alias("_words"))
             .join(uses, ["_src", "index"])
             .groupBy("_row").agg(F.sum(F.col("_uses") * F.col("_words")).alias("taken")))
    return (mix.layout.join(taken, "_row", "left")
            .select("_src", "_row", "_id", "_size", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def report(mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """id, size, source_size, target and taken of every document."""
    spark = mix.layout.sparkSession
    known = spark.createDataFrame([(i, s.size, s.target) for i, s in enumerate(mix.sources)],
                                  "_src int, source_size long, target double")
    return (taken_words(mix).join(F.broadcast(known), "_src")
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", "taken"))


def blocks_of(mix: Mix, docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: shard, position, source, index and the words of the block
    in every slot. ``docs`` is the table that was mixed."""
    spark = docs.sparkSession
    names = spark.createDataFrame([(i, s.name) for i, s in enumerate(mix.sources)], "_src int, source string")
    t = F.col(f"`{text}`")
    worded = (docs.select(F.col(f"`{source}`").cast("string").alias("_name"), F.col(f"`{id_col}`").alias("_key"),
                          F.xxhash64(t).alias("_hash"), F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("_all"))
              .groupBy("_name", "_key", "_hash").agg(F.first("_all").alias("_all")))  # repeated rows are one text
    placed = (mix.layout.filter("_size > 0").join(F.broadcast(names), "_src")
              .join(worded, F.expr("source <=> _name and _id <=> _key and _digest = _hash")))

    def part(index: Column) -> Column:
        before, n = _in_block(mix, index)
        return F.struct(index.alias("index"), (F.col("_start") + before).alias("at"),
                        F.slice("_all", before.cast("int") + 1, n.cast("int")).alias("words"))
    parts = placed.select("_src", "source", F.inline(F.transform(_indexes(mix), part)))
    whole = (parts.groupBy("_src", "source", "index")  # a block: a bounded number of words
             .agg(F.flatten(F.sort_array(F.collect_list(F.struct("at", "words")))["words"]).alias("words")))
    return mix.slots.join(whole, ["_src", "index"]).select("shard", "position", "source", "index", "words")
