"""Ranked lexical search with range-maximum tables over posting lists.

The documents are read once: of every text, its number of terms and the counts
of the terms that some query holds. From their sums follow the weights of the
terms. Documents are then taken in shards of at most ``SHARD`` rows; a shard
has, per term, a posting list (documents in order of their ids, each with the
term's impact on its score) and over it a sparse table of range maxima.

A query is answered best first. An interval of documents is bounded by the sum,
over the query's terms, of the largest impact in that interval (two look-ups
in the term's sparse table). The interval of the highest bound is split at the
document of the largest single impact: this document is scored in full, the
intervals to its left and right are bounded anew and wait. Intervals whose
bound cannot reach the k-th score found so far are dropped, so the search ends
with the exact k best. Some of the best intervals are split at a time, which
changes the work and not the result. A task carries its k best of each query
from shard to shard; the lists of all tasks are merged by a window whose first
k rows are picked before the shuffle.

Queries are taken in blocks whose terms fill a bounded number of bytes; only
those terms and the queries' numbers travel to the tasks.

Defined results: null and empty texts have no term, are in no list and not
counted; terms repeated in a query count once; rows of equal query id are one
query with the terms of all; a null query id is a query; repeated documents
are ranked row by row; equal scores ascend by id, nulls first; texts of any
length are read whole, some megabytes at a time; empty tables give no rows.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from demandops.llm.common import bounded_batches, cut

SHARD = 8192             #: documents of a shard
QUERY_BYTES = 8 << 20    #: bytes of the terms of a block of queries
SLICE = 4 << 20          #: bytes of a text that are split at a time
SPLITS = 32              #: intervals of a query that are split at a time

#: A-Z in lower case, digits, letters and all bytes from 0x80 on stay: a term
#: is a maximal run of those.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice."""
    clean, at = text.translate(TERM_BYTES), 0
    while at < len(clean):
        end = clean.find(b" ", at + SLICE) if at + SLICE < len(clean) else -1
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


# -- one shard ----------------------------------------------------------------------

class Postings:
    """The posting lists of a shard, one after the other: documents, impacts,
    and a sparse table of the places of range maxima."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        order = np.argsort(term, kind="stable")         # documents ascend already
        self.doc, self.impact, self.n_docs = doc[order], impact[order], n_docs
        term = term[order].astype(np.int64)
        self.key = term * n_docs + self.doc             # ascending
        self.terms, self.first = np.unique(term, return_index=True)
        self.end = np.append(self.first[1:], len(term))
        longest = int((self.end - self.first).max(initial=1))
        # level[n]: the widest power of two in a range of n places
        self.level = np.zeros(longest + 1, np.int64)
        for i in range(1, longest.bit_length()):
            self.level[1 << i:] = i
        self.best = np.empty((longest.bit_length(), len(term)), np.int32)
        self.best[0] = np.arange(len(term))
        for i in range(1, longest.bit_length()):
            low, width = self.best[i - 1], 1 << i - 1
            self.best[i] = low                          # beyond a list's end: never looked up
            a, b = low[:-width], low[width:]
            self.best[i, :-width] = np.where(self.impact[b] > self.impact[a], b, a)

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, impact) of the first maximum of every range; impact 0 of an empty one."""
        some = hi > lo
        last = len(self.doc) - 1
        level = self.level[np.where(some, hi - lo, 1)]
        a = self.best[level, np.minimum(lo, last)]
        b = self.best[level, np.clip(hi - (1 << level), 0, last)]
        ia, ib = self.impact[a], self.impact[b]
        return np.where(ib > ia, b, a), np.where(some, np.maximum(ia, ib), 0)

    def search(self, terms: np.ndarray, k: int, found: list[tuple]) -> list[tuple]:
        """The ``k`` best of ``found`` and this shard's documents for a query, as
        (-score, place, None or what ``found`` had there). The place is a
        document's number; of what was found before, half under the number of
        the first document that does not come before it."""
        if not len(self.terms):
            return found
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        at = at[self.terms[at] == terms]
        if not len(at):
            return found
        base = self.terms[at] * self.n_docs
        floor, before = (-found[-1][0], found[-1][1]) if len(found) == k else (0, 0)

        def bounded(lo, hi, start):
            """Those intervals that can hold a result: ranges, first document,
            bound, document to split at."""
            place, value = self.maxima(lo, hi)
            bound = value.sum(axis=1)
            keep = np.flatnonzero((bound > floor) | (bound == floor) & (start < before) & (bound > 0))
            top = place[keep, value[keep].argmax(axis=1)]
            return lo[keep], hi[keep], start[keep], bound[keep], self.doc[top]

        waiting = bounded(self.first[at][None, :], self.end[at][None, :], np.zeros(1, np.int64))
        while len(waiting[0]):
            lo, hi, start, bound, split = waiting
            if len(bound) > SPLITS:
                order = np.argpartition(-bound, SPLITS)
                now, later = order[:SPLITS], order[SPLITS:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            left, right, doc = lo[now], hi[now], split[now].astype(np.int64)
            middle = np.searchsorted(self.key, base[None, :] + doc[:, None])
            place = np.minimum(middle, len(self.key) - 1)
            has = (middle < right) & (self.doc[place] == doc[:, None])
            score = np.where(has, self.impact[place], 0).sum(axis=1)
            some = score >= floor
            found = sorted([*found, *((-s, d, None) for s, d in zip(score[some].tolist(), doc[some].tolist()))],
                           key=lambda x: x[:2])[:k]
            if len(found) == k:
                floor, before = -found[-1][0], found[-1][1]
            new = bounded(np.concatenate([left, middle + has]), np.concatenate([middle, right]),
                          np.concatenate([start[now], doc + 1]))
            still = later[(bound[later] > floor) | (bound[later] == floor) & (start[later] < before)]
            waiting = tuple(np.concatenate([x[still], y]) for x, y in zip(waiting, new))
        return found


# -- tasks -------------------------------------------------------------------------------

def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, text in enumerate(b.column(1)):
            for words in terms_of(text.as_py() or b""):
                found = sorted(set(words))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([i] * len(found), pa.int64())), pa.array(found, pa.binary())],
                    names=["item", "term"])


def _count(held):
    """Of every text: its number of terms, and the counts of queries' terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        for b in batches:
            sizes, terms, counts = [], [], []
            for text in b.column(1):
                n, seen = 0, Counter()
                for words in terms_of(text.as_py() or b""):
                    n += len(words)
                    seen.update(filter(None, map(number, words)))
                sizes.append(n)
                terms.append(list(seen.keys()))
                counts.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["id", "n", "terms", "counts"])
    return run


def _norms(n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """10 + 90 n N div L, in whole numbers."""
    if int(n.max(initial=0)) * 90 * n_docs < 1 << 63:
        return 10 + 90 * n * n_docs // length
    return np.array([10 + 90 * x * n_docs // length for x in n.tolist()], np.int64)


def _order(value) -> tuple:
    """Nulls first, then ascending."""
    return (value is not None, value if value is not None else 0)


def _search(held, k: int, n_docs: int, length: int, shard: int):
    """The ``k`` best of every query among the documents of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries = held.value
        best: list[list[tuple]] = [[] for _ in queries]  # (-score, order of the id, id)
        rows, n, kind = [], 0, None

        def work() -> None:
            docs = pa.Table.from_batches(rows)
            docs = docs.take(pc.sort_indices(docs, sort_keys=[("id", "ascending")], null_placement="at_start"))
            ids, norm = docs["id"].to_pylist(), _norms(docs["n"].to_numpy(), n_docs, length)
            terms, counts = docs["terms"].combine_chunks(), docs["counts"].combine_chunks()
            doc = np.repeat(np.arange(len(ids), dtype=np.int32), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
            term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[doc]))
            some = impact > 0
            postings = Postings(term[some], doc[some], impact[some], len(ids))
            places = [_order(i) for i in ids]
            for q, wanted in enumerate(queries):
                earlier = [(s, bisect.bisect_left(places, o) - 0.5, (s, o, i)) for s, o, i in best[q]]
                best[q] = [x or (s, places[int(d)], ids[int(d)]) for s, d, x in postings.search(wanted, k, earlier)]

        for b in batches:
            kind = b.schema.field(0).type
            b = b.filter(pc.greater(pc.list_value_length(b.column(2)), 0))
            while b.num_rows:
                part = b.slice(0, shard - n)
                rows.append(part)
                n, b = n + part.num_rows, b.slice(part.num_rows)
                if n == shard:
                    work()
                    rows.clear()
                    n = 0
        if n:
            work()
        out = [(q, i, -s) for q, hits in enumerate(best) for s, _, i in hits]
        if out:
            query, ids, scores = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(ids, kind), pa.array(scores, pa.int64())],
                                             names=["_query", "id", "score"])
    return run


# -- the search ---------------------------------------------------------------------------

def weights_of(df: dict[int, int], n_terms: int, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of every term number, from 1 on."""
    out = np.zeros(n_terms + 1, np.int64)
    for t, c in df.items():
        out[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1)))
    return out


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", shard: int = SHARD,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item, rank, id, score): the ``k`` documents of the highest positive
    scores for every query, under the names of the input's columns."""
    spark = docs.sparkSession
    bounded_batches(spark)
    item_type, id_type = queries.schema[item].dataType, docs.schema[id_col].dataType
    fields = [T.StructField("item", item_type), T.StructField("term", T.BinaryType())]
    terms = cut(queries.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").cast("binary"))
                .mapInArrow(_query_terms, T.StructType(fields)).distinct(), "query-terms")
    size = terms.agg(F.sum(F.length("term") + 16)).first()[0] or 0
    blocks, parts = max(1, -(-size // query_bytes)), []
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    counted_type = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                                 T.StructField("terms", T.ArrayType(T.IntegerType())),
                                 T.StructField("counts", T.ArrayType(T.LongType()))])
    for b in range(blocks):
        # a bounded number of bytes: the terms of a block of queries
        found = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        number = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in found}), 1)}
        wanted: dict = {}
        for r in found:
            wanted.setdefault(r["item"], []).append(number[bytes(r["term"])])
        counted = cut(narrow.mapInArrow(_count(spark.sparkContext.broadcast(number)), counted_type), "term-counts")
        n_docs, length = counted.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
        df = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # the block's terms
        held = spark.sparkContext.broadcast((weights_of(df, len(number), n_docs),
                                             [np.array(sorted(t), np.int64) for t in wanted.values()]))
        hits = counted.mapInArrow(_search(held, k, n_docs, length, shard), T.StructType(
            [T.StructField("_query", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())]))
        names = spark.createDataFrame(list(enumerate(wanted)), T.StructType(
            [T.StructField("_query", T.IntegerType()), T.StructField("item", item_type)]))
        w = W.partitionBy("_query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
        ranked = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        parts.append(ranked.join(F.broadcast(names), "_query").select(
            F.col("item").alias(item), "rank", F.col("id").alias(id_col), "score"))
    return reduce(DataFrame.unionByName, parts)
