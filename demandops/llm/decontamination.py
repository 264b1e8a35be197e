"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` consecutive word k-grams the smallest hash is a
fingerprint, on both sides, so every shared span of k + WINDOW - 1 = 10 words
shares one. Texts' fingerprints pass a fixed-size Bloom filter of the
benchmark's, then an exact semi join; only texts that pass are read again, and
each hit is extended word by word to both sides. Items of fewer than ten words
are one window of their own length and are looked up by that length's grams.
Only DataFrame functions on the main path.

Work is done once per distinct text (128-bit digest), so groups of copies cost
one search. Defined results: null, empty and wordless texts hit nothing; a
benchmark row without an id, text or words is ignored; repeated item rows count
once; repeated documents are reported row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import aside, bloom_blocks, bloom_build, bloom_probe, cut, drop_texts, sized_join
from demandops.llm.url_filter import LOWER, UPPER

SPAN, K = 10, 5          #: guaranteed span and k-gram, in words
WINDOW = SPAN - K + 1    #: k-grams per winnowing window
SIDE = SPAN - K          #: words of context to each side of a fingerprint
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. An
    all-ASCII text takes the faster ``lower``, which is the same there."""
    t = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(low, SPLIT), "")


def digest(text: Column) -> list[Column]:
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("_t1"), F.xxhash64(F.lit("second"), t).alias("_t2")]


def _empty() -> Column:
    return F.array().cast("array<bigint>")


def _grams(w: Column, k: int) -> Column:
    """Hashes of the k-grams of ``w``; the length is part of the hash."""
    return F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(0), F.size(w) - k),
        lambda i: F.xxhash64(F.lit(k), *[w[i + j] for j in range(k)]))).otherwise(_empty())


def _winnow(h: Column) -> Column:
    """Distinct minima of the windows of ``WINDOW`` neighbouring hashes."""
    return F.when(F.size(h) >= WINDOW, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.least(*[h[i + j] for j in range(WINDOW)])))).otherwise(_empty())


def _fingerprints(worded: DataFrame, keys: Sequence[str], short: Sequence[int]) -> DataFrame:
    """(keys, _h): winnowed fingerprints and all grams of the short lengths."""
    hashed = worded.select(*keys, "_w", _grams(F.col("_w"), K).alias("_g"))
    parts = [_winnow(F.col("_g"))] + [F.array_distinct(_grams(F.col("_w"), n)) for n in short]
    return hashed.select(*keys, F.explode(F.concat(*parts)).alias("_h"))


def _occurrences(worded: DataFrame, keys: Sequence[str], short: Sequence[int]) -> DataFrame:
    """(keys, _h, _n, _pos, _ctx): every place of the hashes in ``_want``, with
    gram length and the words around it (null beyond the ends)."""
    w, out = F.col("_w"), None
    for n in [K, *[x for x in short if x != K]]:
        hashed = worded.select(*keys, "_w", "_want", _grams(w, n).alias("_g"))
        side = SIDE if n == K else 0
        # no row filter here: pushed below the projection it would hash the text anew per word
        place = F.when(F.size("_g") > 0, F.filter(F.sequence(F.lit(0), F.size("_g") - 1),
                                                  lambda i: F.array_contains("_want", F.col("_g")[i]))) \
            .otherwise(F.array().cast("array<int>"))
        occ = F.transform(place, lambda i: F.struct(
            F.col("_g")[i].alias("_h"), F.lit(n).alias("_n"), i.alias("_pos"),
            F.transform(F.sequence(i - side, i + n + side - 1), lambda j: F.get(w, j)).alias("_ctx")))
        part = hashed.select(*keys, F.inline(occ))
        out = part if out is None else out.unionByName(part)
    return out


def _run(ours: Column, theirs: Column, first: int, step: int) -> Column:
    """Equal words from index ``first`` on, outwards, up to ``SIDE``."""
    state = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(SIDE - 1)), state, lambda a, i: F.struct(
        (a["n"] + F.when(a["on"] & F.coalesce(F.get(ours, first + step * i) == F.get(theirs, first + step * i),
                                              F.lit(False)), 1).otherwise(0)).alias("n"),
        (a["on"] & F.coalesce(F.get(ours, first + step * i) == F.get(theirs, first + step * i),
                              F.lit(False))).alias("on")))["n"]


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
               item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(spans, items) per distinct text: (_t1, _t2, start, end) of shared word
    spans and (_t1, _t2, item) of the items with a window in the text."""
    bench = cut(benchmark.select(F.col(f"`{item}`").alias("item"),
                                 words_of(F.col(f"`{item_text}`")).alias("_w"))
                .filter(F.col("item").isNotNull() & (F.size("_w") > 0)).distinct(), "benchmark")
    short = sorted(r[0] for r in bench.filter(F.size("_w") < SPAN)
                   .select(F.size("_w").alias("n")).distinct().collect())  # at most nine values
    # an item shorter than a span has only its whole as a window
    long_fp = _fingerprints(bench.filter(F.size("_w") >= SPAN), ["item", "_w"], [])
    short_fp = None
    for n in short:
        own = bench.filter(F.size("_w") == n).select("item", "_w", _grams(F.col("_w"), n)[0].alias("_h"))
        short_fp = own if short_fp is None else short_fp.unionByName(own)
    prints = long_fp if short_fp is None else long_fp.unionByName(short_fp)
    wanted = prints.select("_h").distinct()
    theirs = cut(_occurrences(
        prints.groupBy("item", "_w").agg(F.collect_set("_h").alias("_want")),
        ["item", F.size("_w").alias("_len")], short)
        .withColumnRenamed("_ctx", "_theirs")
        # K is also a legal short length: there only the whole item is a window
        .withColumn("_whole", F.col("_len") < SPAN)
        .filter(~F.col("_whole") | (F.col("_n") == F.col("_len")))
        .withColumn("_cid", F.xxhash64("_h", "_theirs", "_whole")).drop("_pos", "_len"), "prints")

    n_keys = wanted.count()
    blocks = bloom_blocks(n_keys)
    bloom = bloom_build(wanted, ["_h"], blocks)
    t = F.col(f"`{text}`")
    worded = docs.select(*digest(t), words_of(t).alias("_w"))
    passed = bloom_probe(_fingerprints(worded, ["_t1", "_t2"], short), bloom, ["_h"], blocks).distinct()
    cand = cut(sized_join(passed, wanted, ["_h"], "left_semi", n_keys)
               .groupBy("_t1", "_t2").agg(F.collect_set("_h").alias("_want")), "candidates")

    # second read: only candidate texts pass their own fixed-size filter
    n_cand = cand.count()
    cblocks = bloom_blocks(n_cand)
    cbloom = bloom_build(cand, ["_t1", "_t2"], cblocks)
    texts = (bloom_probe(docs.select(*digest(t), t.alias("_text")), cbloom, ["_t1", "_t2"], cblocks)
             .groupBy("_t1", "_t2").agg(F.first("_text").alias("_text")))
    again = texts.join(cand, ["_t1", "_t2"]).select("_t1", "_t2", "_want", words_of(F.col("_text")).alias("_w"))
    ours = _occurrences(again, ["_t1", "_t2"], short)

    contexts = theirs.select("_h", "_n", "_theirs", "_whole", "_cid").distinct()
    both = sized_join(ours, contexts, ["_h", "_n"])
    left = _run(F.col("_ctx"), F.col("_theirs"), SIDE - 1, -1)
    right = _run(F.col("_ctx"), F.col("_theirs"), SIDE + K, 1)
    core = F.slice("_ctx", SIDE + 1, K) == F.slice("_theirs", SIDE + 1, K)
    # a whole short item of K words is compared without its (empty) sides
    bare = F.when(F.col("_n") == K, core).otherwise(F.col("_ctx") == F.col("_theirs"))
    hit = (both.select("_t1", "_t2", "_cid", "_whole", "_pos", "_n", bare.alias("_bare"),
                       F.when(F.col("_whole"), 0).otherwise(left).alias("_l"),
                       F.when(F.col("_whole"), 0).otherwise(right).alias("_r"))
           .filter(F.col("_bare") & (F.col("_whole") | (F.col("_l") + K + F.col("_r") >= SPAN)))
           .select("_t1", "_t2", "_cid", (F.col("_pos") - F.col("_l")).alias("start"),
                   (F.col("_pos") + F.col("_n") + F.col("_r")).alias("end")))
    hits = cut(hit, "hits")
    spans = hits.select("_t1", "_t2", "start", "end").distinct()
    items = (hits.select("_t1", "_t2", "_cid").distinct()
             .join(theirs.select("_cid", "item").distinct(), "_cid")
             .select("_t1", "_t2", "item").distinct())
    return spans, items


def merged(spans: Column) -> Column:
    """Sorted, disjoint spans of an array of (start, end)."""
    return F.aggregate(
        F.sort_array(spans), F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",),
                  text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, spans (disjoint hit word spans), n_hit, items
    (ids as sorted strings) and contaminated, for every row of ``docs``; a kept
    column named like a result column is replaced by it."""
    spans, items = find_spans(docs, benchmark, text, item, item_text)
    per_text = (spans.groupBy("_t1", "_t2")
                .agg(F.collect_set(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))).alias("_s"))
                .select("_t1", "_t2", merged(F.col("_s")).alias("spans"))
                .join(items.groupBy("_t1", "_t2")
                      .agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items")),
                      ["_t1", "_t2"]))
    t = F.col(f"`{text}`")
    results = ["n_words", "spans", "items", "n_hit", "contaminated"]
    kept, back = aside(keep, results)
    base = docs.select(*kept, *digest(t),
                       F.size(words_of(t)).cast("long").alias("n_words"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return (base.join(per_text, ["_t1", "_t2"], "left").drop("_t1", "_t2")
            .withColumn("n_hit", F.coalesce(n_hit, F.lit(0).cast("long")))
            .withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("contaminated", F.col("n_hit") > 0)
            .select(*back, *results))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    spans, _ = find_spans(docs, benchmark, text, item, item_text)
    keys = spans.select(F.col("_t1").alias("t1"), F.col("_t2").alias("t2")).distinct()
    return drop_texts(docs, cut(keys, "contaminated"), text)
