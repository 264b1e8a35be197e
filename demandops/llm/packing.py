"""Best-fit packing of token sequences, bulk-synchronous.

Documents are tokenised, cut at the capacity only where longer, and packed in
supersteps from large to small. A superstep takes one band of lengths
(capacity/2, capacity], (capacity/4, capacity/2], ...: documents and open gaps
are range-sorted and ranked by size, a successor sweep matches every document,
longest first, to the smallest gap that holds it, conflicts between equal
documents are resolved by rank, gaps are updated, and the next band follows.

A size is at most ``capacity``, so the sweep decides on size histograms of at
most ``capacity`` rows whatever the corpus holds: "documents of length l with
ranks a..b take gaps of size g with ranks c..d". All rows are ranked, matched
and updated by Spark joins on (size, rank), which no hot size can skew; rows
and gaps never reach the driver.

Defined results: a null or empty text is one end id; repeated rows are packed
each for itself; null ids are carried; an empty table packs to nothing.
"""

from __future__ import annotations

import bisect
import itertools
import os
import sys
import types
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandops.llm.common import cut, global_rank, release

CACHE_WORDS = 500_000    #: distinct words a worker remembers before it starts anew
SLICE_BYTES = 2_000_000  #: text tokenised at a time


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones for themselves, the others from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(0x100 + rest.index(b)) for b in range(256)]


class WordEncoder:
    """Ids of texts by a lower-casing byte-level BPE tokenizer that drops white
    space: distinct words are encoded once and remembered, up to
    ``CACHE_WORDS``. Words of letters go straight to the merges, any other
    word through the whole tokenizer."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok, self.end = Tokenizer.from_file(path), end_id
        self.letters = dict(enumerate(byte_letters()))
        self.merge = self.tok.model.tokenize
        self.clear()

    @staticmethod
    def of(path: str, end_id: int) -> WordEncoder:
        """The worker's encoder: workers live on between tasks."""
        kept = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders")).__dict__
        if (path, end_id) not in kept:
            kept[path, end_id] = WordEncoder(path, end_id)
        return kept[path, end_id]

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}             # no text: the end id itself
        self.pool = np.full(1 << 18, self.end, np.uint32)
        self.offs, self.lens = np.zeros(1 << 14, np.int32), np.ones(1 << 14, np.int32)
        self.used = 1

    def _by_merges(self, word: str) -> list[int] | None:
        """Ids of a word of letters and at most one closing mark, else None."""
        tail = word[-1:]
        core = word[:-1] if tail == "," or tail == "." else word
        if not core.isalpha():
            return None
        if core.isascii():
            low = core.lower()
        else:
            low = "".join([c.lower() for c in core])
            if not (unicodedata.is_normalized("NFC", core) and low.isalpha()):
                return None
            low = low.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.merge(low)]
        if core is not word:
            ids += [t.id for t in self.merge(tail)]
        return ids

    def _learn(self, words: list[str]) -> None:
        ids = [self._by_merges(w) for w in words]
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, e in zip(rest, self.tok.encode_batch([words[i] for i in rest], add_special_tokens=False)):
            ids[i] = e.ids
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lens.sum()))
        n, end = len(self.index), self.used + len(flat)
        while len(self.pool) < end:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.offs) < n + len(words):
            self.offs = np.concatenate([self.offs, np.zeros_like(self.offs)])
            self.lens = np.concatenate([self.lens, np.zeros_like(self.lens)])
        self.pool[self.used:end] = flat
        self.offs[n:n + len(words)] = self.used + np.cumsum(lens) - lens
        self.lens[n:n + len(words)] = lens
        self.index.update(zip(words, range(n, n + len(words))))
        self.used = end

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by the end id; where each text ends)."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        # A-Z in lower case first: fewer distinct words, the same ids (a special
        # token's name is matched before the tokenizer lowers, so such texts stay)
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = parts.values.dictionary_encode()
        names = coded.dictionary.to_pylist()
        self._learn([w for w in names if w not in self.index])
        number = np.fromiter(map(self.index.__getitem__, names), np.int32, len(names))
        bounds = parts.offsets.to_numpy()
        words = number[coded.indices.to_numpy()] if names else np.zeros(0, np.int32)
        empty = words == 0                                # beside outer white space
        words = np.insert(words, bounds[1:] - bounds[0], 0)
        lens = self.lens[words]
        closing = bounds[1:] - bounds[0] + np.arange(len(texts))
        gone = np.insert(empty, bounds[1:] - bounds[0], False)
        lens[gone] = 0
        ends = np.cumsum(lens, dtype=np.int32)
        where = np.repeat(self.offs[words] - (ends - lens), lens)
        where += np.arange(len(where), dtype=np.int32)
        return self.pool[where], ends[closing].astype(np.int64)


PIECE = "piece int, start long, length long, ids_crc32 long"


def tokenize(docs: DataFrame, tokenizer: str, capacity: int, keep: Sequence[str] = ("doc_id",),
             text: str = "text", end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``keep`` columns, piece, start,
    length, ids_crc32 and, if asked for, the ids themselves."""
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    fields = src.schema.fields[:-1] + T._parse_datatype_string(PIECE).fields
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder.of(tokenizer, end_id)
        for batch in batches:
            text = batch.column(len(keep))
            group = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False)) // SLICE_BYTES
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else []
            for a, z in zip(first, [*first[1:], len(group)]):
                part = batch.slice(a, z - a)
                ids, ends = enc.encode(part.column(len(keep)))
                begins = np.r_[0, ends[:-1]]
                n = -(-(ends - begins) // capacity)                   # pieces of each text
                at = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                lo = begins[at] + start
                hi = np.minimum(lo + capacity, ends[at])
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(lo.tolist(), hi.tolist())]
                cols = [part.column(i).take(pa.array(at)) for i in range(len(keep))]
                cols += [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(hi - lo), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array([ids[x:y].astype(np.int64) for x, y in zip(lo, hi)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=names)
        pa.default_memory_pool().release_unused()  # the worker lives on

    return src.mapInArrow(run, T.StructType(fields))


def sweep(items: dict[int, int], gaps: dict[int, int], capacity: int) -> tuple[list, list, int]:
    """One successor sweep over the size histograms of a band.

    Returns matches (length, item_from, item_to, gap, gap_from, used): items of
    that length and rank go to gaps of that size from rank gap_from on, after
    ``used`` ids; updates (gap, gap_from, gap_to, rest); and the number of new
    sequences (gaps of size ``capacity``)."""
    free: dict[int, deque] = {g: deque([(g, 0, n, 0)]) for g, n in gaps.items() if n}
    sizes, matches, opened = sorted(free), [], 0
    for length in sorted(items, reverse=True):
        done, todo = 0, items[length]
        while done < todo:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                new = -(-(todo - done) // (capacity // length))
                free[capacity] = deque([(capacity, opened, opened + new, 0)])
                sizes.append(capacity)
                opened += new
            size = sizes[at]
            gap, lo, hi, used = free[size].popleft()
            n = min(hi - lo, todo - done)
            if lo + n < hi:
                free[size].appendleft((gap, lo + n, hi, used))
            elif not free[size]:
                del free[size]
                sizes.pop(at)
            matches.append((length, done, done + n, gap, lo, used))
            rest = size - length
            if rest not in free:
                free[rest] = deque()
                bisect.insort(sizes, rest)
            free[rest].append((gap, lo, lo + n, used + length))
            done += n
    updates = [(g, lo, hi, size) for size, q in free.items() for g, lo, hi, _ in q]
    return matches, updates, opened


def pack(pieces: DataFrame, capacity: int, uid: str = "uid", length: str = "length") -> DataFrame:
    """(uid, sequence_id, offset) of every piece of 1 to ``capacity`` ids."""
    spark = pieces.sparkSession
    ranked = global_rank(pieces.select(F.col(uid).alias("uid"), F.col(length).cast("int").alias("len")),
                         ["len", "uid"], "rank", "pack-items")
    hist = {int(r[0]): int(r[1]) for r in ranked.groupBy("len").count().collect()}  # at most capacity rows
    starts, at = {}, 0
    for n in sorted(hist):
        starts[n], at = at, at + hist[n]
    gaps = spark.createDataFrame([], "seq long, gap int")
    left: dict[int, int] = {}
    placed, sequences, top = [], 0, capacity
    while top > 0:
        low = top // 2
        band = {n: c for n, c in hist.items() if low < n <= top}
        if band:
            matches, updates, opened = sweep(band, left, capacity)
            # at most one row per (length, gap size) met: bounded by capacity squared, some thousands
            plan = spark.createDataFrame(
                [(n, starts[n] + a, starts[n] + b, g, c, capacity - g + u) for n, a, b, g, c, u in matches],
                "len int, a long, b long, gap int, c long, offset long")
            open_gaps = global_rank(gaps, ["gap", "seq"], "rank", "pack-gaps")
            first = open_gaps.groupBy("gap").agg(F.min("rank").alias("_first"))
            old = open_gaps.join(F.broadcast(first), "gap").select("seq", "gap", (F.col("rank") - F.col("_first")).alias("rank"))
            new = spark.range(opened).select((F.col("id") + sequences).alias("seq"),
                                             F.lit(capacity).alias("gap"), F.col("id").alias("rank"))
            every = old.unionByName(new)
            target = (ranked.filter(F.col("len").between(low + 1, top)).join(F.broadcast(plan), "len")
                      .filter((F.col("rank") >= F.col("a")) & (F.col("rank") < F.col("b")))
                      .select("uid", "offset", "gap", (F.col("c") + F.col("rank") - F.col("a")).alias("rank")))
            placed.append(cut(target.join(every, ["gap", "rank"]).select("uid", F.col("seq").alias("sequence_id"), "offset"),
                              "packed"))
            change = spark.createDataFrame(updates, "gap int, a long, b long, rest int")
            gaps_next = cut(every.join(F.broadcast(change), "gap")
                            .filter((F.col("rank") >= F.col("a")) & (F.col("rank") < F.col("b")) & (F.col("rest") > 0))
                            .select("seq", F.col("rest").alias("gap")), "gaps")
            release(open_gaps, gaps)
            gaps, sequences = gaps_next, sequences + opened
            left = {}
            for _, a, b, rest in updates:
                if rest:
                    left[rest] = left.get(rest, 0) + b - a
        top = low
    release(gaps, ranked)
    if not placed:
        return spark.createDataFrame([], f"uid {dict(pieces.dtypes)[uid]}, sequence_id long, offset long")
    return reduce(DataFrame.unionByName, placed)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, keep: Sequence[str] = ("doc_id",),
                   text: str = "text") -> DataFrame:
    """Every piece with its place: ``keep``, piece, start, length, ids_crc32,
    sequence_id, offset."""
    pieces = cut(tokenize(docs, tokenizer, capacity, keep, text)
                 .withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    places = pack(pieces, capacity, "_uid").withColumnRenamed("uid", "_uid")
    return pieces.join(places, "_uid").drop("_uid")
