"""Exact repeats of 200 bytes, by anchors and hashes.

Every 200-byte string that starts at two places of the corpus is found, and
the bytes it covers are removed. This takes the place of a suffix array by
bucket-pointer refinement, which moves a row per byte in every round: here no
suffix is sorted and no bucket identifier is a key of a later round.

1. Anchors. Each 200-byte window has one anchor: the leftmost least of its
   q-gram hashes (q = 100). Places are grouped by the q-gram at their anchor,
   one row per anchor (about one in 50 bytes). A group of one place is dropped
   in the shuffle that builds it.
2. Contexts. Hashes of strings are made inside each text by doubling: that of a
   2k-gram from those of the k-gram at its start and at offset k, up to 128; any
   longer string takes two or three of them. The whole context of an anchor
   (all its windows) is compared within the group; equal contexts repeat
   entirely.
3. Two fixed levels. Of groups that hold different contexts, one place per
   context goes on: windows in groups of eight offsets are compared by the core
   they share (a unique core has no repeated window), then window by window.

All comparing is grouping by (group, offset, hash): counts combine map-side
and no pairs are made. Hashes are 64-bit and only compared within one 64-bit
group. Equal texts are one text with a count, so a group of copies costs one
grouping; a text with a copy is repeated throughout.

Defined results: null and empty texts have no bytes and keep none; texts under
200 bytes are kept whole, copies included; repeated rows are copies of each
other; null ids are carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import aside, bloom_blocks, bloom_build, bloom_probe, bounded_batches, cut, release

LENGTH = 200             #: bytes of a repeated string
Q = 100                  #: bytes of an initial bucket
WINDOW = LENGTH - Q + 1  #: q-grams of a 200-byte window
STEP = 8                 #: offsets of a group in the recursion
TOP = 128                #: longest doubled gram

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_C = _RNG.integers(1, 1 << 63, 32, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def doubled(text: np.ndarray) -> dict[int, np.ndarray]:
    """Identifiers of the 1-, 2-, 4-, ... 128-grams at every byte."""
    k, at = 1, {1: _BYTE[text]}
    while k < TOP and len(at[k]) > k:
        now, j = at[k], 2 * k.bit_length() - 2
        at[2 * k] = _mix(now[:-k] * _C[j] + now[k:] * _C[j + 1])
        k *= 2
    return at


def grams(at: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Identifiers of the n-grams at every byte, from two overlapping ones."""
    k = 1 << (n.bit_length() - 1)
    now, off = at[k], n - k
    return now if not off else _mix(now[:-off] * _C[20] + now[off:] * _C[21])


def strings(top: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Identifiers of the strings [start, end) of 128 to 384 bytes."""
    mid = start + (end - start - TOP) // 2
    return _mix(_mix(top[start] * _C[24] + top[mid] * _C[25]) + top[end - TOP] * _C[26]
                + (end - start).astype(np.uint64))


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        values = op(values[:-k], values[k:])
        k *= 2
    off = width - k
    return op(values[:len(values) - off], values[off:]) if off else values


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, first window, last window) of every anchor: the windows
    whose leftmost least q-gram it is."""
    least = _sliding(h, WINDOW, np.minimum)
    n = len(least)
    pad = np.zeros(WINDOW - 1, np.uint64)
    reach = _sliding(np.concatenate([pad, least, pad]), WINDOW, np.maximum)
    pos = np.flatnonzero(h == reach)
    run = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    run_end = np.r_[run[1:], n] - 1
    values, rank = np.unique(least[run], return_inverse=True)
    of = np.searchsorted(values, h[pos])
    scale = len(h) + 1
    by_value = np.argsort(of * scale + pos, kind="stable")
    pos, of = pos[by_value], of[by_value]
    before = np.r_[-1, pos[:-1]]
    before[np.r_[True, of[1:] != of[:-1]]] = -1
    runs = np.argsort(rank * scale + run, kind="stable")
    at = runs[np.searchsorted((rank * scale + run)[runs], of * scale + pos, side="right") - 1]
    first = np.maximum(np.maximum(run[at], before + 1), np.maximum(pos - WINDOW + 1, 0))
    last = np.minimum(run_end[at], pos)
    ok = first <= last
    return pos[ok], first[ok], last[ok]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


ANCHOR = "bucket long, ctx long, t1 long, t2 long, pos long, span int"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t1, t2, text) -> anchors; span = 256 * first offset + last offset."""
    for batch in batches:
        t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        size = 0
        for i, text in enumerate(batch.column(2)):
            b = _bytes(text.as_py())
            if len(b) < LENGTH:
                continue
            at = doubled(b)
            h = grams(at, Q)
            pos, first, last = anchors(h)
            for col, v in zip(out, (h[pos], strings(at[TOP], first, last + LENGTH), np.full(len(pos), t1[i]),
                                    np.full(len(pos), t2[i]), pos, (pos - first) * 256 + (pos - last))):
                col.append(v)
            size += len(pos)
            if size >= 100_000:
                yield _anchor_batch(out)
                out, size = [[] for _ in range(6)], 0
        if size:
            yield _anchor_batch(out)


def _anchor_batch(out: list[list[np.ndarray]]) -> pa.RecordBatch:
    bucket, ctx, t1, t2, pos, span = (np.concatenate(c) for c in out)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(t1), pa.array(t2),
         pa.array(pos), pa.array(span.astype(np.int32))], names=["bucket", "ctx", "t1", "t2", "pos", "span"])


def _open_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, t1, t2, pos): distinct places of the buckets
    with two or more. One row is held between batches."""
    held: pa.RecordBatch | None = None
    given = np.zeros(0, bool)
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        bucket = batch.column(0).to_numpy()
        new = np.r_[True, bucket[1:] != bucket[:-1]]
        first = new.copy()
        for c in (2, 3, 4):
            v = batch.column(c).to_numpy()
            first[1:] |= v[1:] != v[:-1]
        out = np.r_[given, np.zeros(batch.num_rows - len(given), bool)][first]
        at = np.flatnonzero(first)
        same = ~new[at][1:]
        many = np.r_[False, same] | np.r_[same, False]
        give = at[many & ~out]
        held, given = batch.slice(int(at[-1]), 1), np.array([bool(many[-1] | out[-1])])
        if len(give):
            yield batch.take(pa.array(give))


def _group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, suffixes) -> groups of eight offsets with their core and the
    identifiers of their windows."""
    for batch in batches:
        cols: list[list] = [[] for _ in range(6)]
        for text, suffixes in zip(batch.column(0), batch.column(1)):
            top = doubled(_bytes(text.as_py()))[TOP]
            ids = strings(top, np.arange(len(top) - (LENGTH - TOP)),
                          np.arange(len(top) - (LENGTH - TOP)) + LENGTH)
            for s in suffixes.as_py():
                pos, lo, hi = s["pos"], s["span"] // 256, s["span"] % 256
                for g in range(hi // STEP, lo // STEP + 1):
                    a, b = max(hi, g * STEP), min(lo, g * STEP + STEP - 1)
                    start = pos - g * STEP
                    core = strings(top, np.array([start]), np.array([start + LENGTH - STEP + 1]))
                    for c, v in zip(cols, (s["bucket"], g, core.view(np.int64)[0], s["rid"], a,
                                           ids[pos - b:pos - a + 1][::-1].view(np.int64))):
                        c.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.list_(pa.int64()))],
            names=["bucket", "grp", "core", "rid", "first", "ids"])


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t1, t2, text, starts) -> removed spans, counts and the digest of the rest."""
    for batch in batches:
        removed, spans, sha, runs = [], [], [], []
        for text, starts in zip(batch.column(2), batch.column(3)):
            raw = _bytes(text.as_py())
            edge = np.zeros(len(raw) + 1, np.int32)
            for s in starts.as_py():
                edge[s["a"]] += 1
                edge[s["b"] + LENGTH] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            turn = np.diff(np.r_[False, gone, False].astype(np.int8))
            at = list(zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist()))
            removed.append(int(gone.sum()))
            spans.append(len(at))
            runs.append([{"start": a, "end": b} for a, b in at])
            sha.append(hashlib.sha256(raw[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(sha, pa.string()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["t1", "t2", "n_removed", "n_spans", "kept_sha256", "removed"])


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(t1, t2, text), one row per text named in ``wanted``; a fixed-size
    filter keeps the other texts out of the shuffle."""
    keys = wanted.select("t1", "t2").distinct()
    blocks = bloom_blocks(keys.count())
    bloom = bloom_build(keys, ["t1", "t2"], blocks)
    return (bloom_probe(texts, bloom, ["t1", "t2"], blocks).groupBy("t1", "t2")
            .agg(F.first("text").alias("text")))


def repeated_starts(texts: DataFrame) -> DataFrame:
    """(t1, t2, a, b): windows a..b of a text start a 200-byte string that
    starts anywhere else too. ``texts``: (t1, t2, text), copies allowed."""
    bounded_batches(texts.sparkSession)
    rows = texts.mapInArrow(_anchor_rows, ANCHOR)
    members = cut(rows.repartition("bucket").sortWithinPartitions("bucket", "t1", "t2", "pos")
                  .mapInArrow(_open_buckets, ANCHOR), "members")
    key = ["bucket", "span", "ctx"]
    keys = cut(members.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("t1", "t2", "pos")).alias("rep")),
               "contexts")
    lo, hi = F.floor(F.col("span") / 256), F.col("span") % 256
    whole = (members.join(keys.filter("n > 1").select(*key), key)
             .select("t1", "t2", (F.col("pos") - lo).alias("a"), (F.col("pos") - hi).alias("b")))
    mixed = (keys.groupBy("bucket").agg(F.count("*").alias("k"), F.min("n").alias("least"))
             .filter("k > 1 and least = 1").select("bucket"))
    reps = cut(keys.join(mixed, "bucket").select("bucket", "span", "n", "rep.*")
               .withColumn("rid", F.monotonically_increasing_id()), "suffixes")
    per_text = reps.groupBy("t1", "t2").agg(F.collect_list(F.struct("rid", "bucket", "pos", "span")).alias("suffixes"))
    groups = cut(_texts_of(texts, reps).join(per_text, ["t1", "t2"]).select("text", "suffixes")
                 .mapInArrow(_group_rows, "bucket long, grp int, core long, rid long, first int, ids array<long>"),
                 "groups")
    cores = groups.groupBy("bucket", "grp", "core").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    windows = (groups.join(cores, ["bucket", "grp", "core"])
               .select("bucket", "rid", "first", F.posexplode("ids").alias("k", "id"))
               .select("bucket", "rid", (F.col("first") + F.col("k")).alias("off"), "id"))
    windows = cut(windows, "windows")
    twice = windows.groupBy("bucket", "off", "id").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    single = reps.filter("n = 1").select("rid", "t1", "t2", "pos")
    alone = (windows.join(twice, ["bucket", "off", "id"]).select("rid", "off").join(single, "rid")
             .select("t1", "t2", (F.col("pos") - F.col("off")).alias("a")).withColumn("b", F.col("a")))
    starts = cut(whole.unionByName(alone), "starts")
    release(members, keys, reps, groups, windows)
    return starts


def remove_repeats(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 and removed
    (byte spans) of every row; a kept column named like a result column is
    replaced by it."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit("second"), t).alias("t2")]
    texts = docs.select(*digest, t.alias("text"))
    copies = cut(texts.groupBy("t1", "t2").agg(F.count("*").alias("c")).filter("c > 1").select("t1", "t2"), "copies")
    starts = repeated_starts(texts)
    partial = (starts.join(copies, ["t1", "t2"], "left_anti").groupBy("t1", "t2")
               .agg(F.collect_list(F.struct("a", "b")).alias("starts")))
    done = cut(_texts_of(texts, partial).join(partial, ["t1", "t2"]).select("t1", "t2", "text", "starts")
               .mapInArrow(_cut_rows, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string, "
                                      "removed array<struct<start:long,end:long>>"), "removed")
    release(starts)
    kept, back = aside(keep, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    base = docs.select(*kept, *digest, F.octet_length(t).cast("long").alias("n_bytes"),
                       F.sha2(t, 256).alias("_sha"))
    out = (base.join(done, ["t1", "t2"], "left")
           .join(copies.withColumn("_copy", F.lit(True)), ["t1", "t2"], "left"))
    gone = F.coalesce("_copy", F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return out.select(
        *back, "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
        F.when(gone, F.array(F.struct(zero.alias("start"), F.col("n_bytes").alias("end"))))
        .otherwise(F.coalesce("removed", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"))).alias("removed"))
