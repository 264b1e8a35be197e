"""Quality classifier: interpolated modified Kneser-Ney n-gram model.

Per language, a model of character 5-grams (lower-cased, otherwise as they
are, in any script) is counted over all trusted text, the documents labelled
good, but for a fifth of them that is held out. Its tables grow with that
text: an entry per distinct n-gram and context, as (language, order, n-gram)
rows, summed and discounted by joins and aggregates, an order at a time.

A document's perplexity joins its n-grams with these counts. While the tables
fill less than ``MODEL_BYTES``, their size measured, they travel to the tasks
packed by shard, and every task joins its texts' n-grams with them; beyond, the
distinct n-grams of all texts are looked up by shuffle joins, and each text's
by one more, salted, as common n-grams are in most texts. Both give the same.

A document is accepted while its perplexity is between two quantiles of the
held-out trusted documents of its language: above the upper one, it is unlike
good text, under the lower one, it repeats itself.

Defined results: null languages are one language; null, empty and blank texts
have no perplexity and are rejected; languages without trusted text have no
model, no perplexity and no threshold, and their documents are accepted, as
are those of a language none of whose trusted texts is held out; texts of any
length are read whole, a slice at a time; repeated rows are scored row by row
(equal texts are on one side of the split); labels of unknown documents are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import bounded_batches, cut, drop_kept, release, shield, sized_join, text_digest

ORDER = 5
PAD = "\x02"             #: stands before the first character
HELD_OUT = 5             #: one in so many trusted texts gives the quantiles
UPPER, LOWER = 0.99, 0.002  #: quantiles of the held-out perplexities
MODEL_BYTES = 64 << 20   #: of a packed model (12 bytes an entry) that tasks hold
SLICE = 200_000          #: characters worked on at a time
HELD_GRAMS = 150_000     #: distinct n-grams that a counting task holds
COST_BITS = 19           #: a scoring task remembers the costs of 2 ** 19 n-grams, 6 MB, of all languages together
SALTS = 16
_MUL = np.uint64(0x9E3779B97F4A7C15)


# -- n-grams of texts -----------------------------------------------------------------

def _units(texts: list[str | None], size: int = SLICE) -> Iterator[list[tuple[int, str]]]:
    """(text number, piece) lists of about ``size`` characters: the text itself
    in lower case, or part of it, after the ``ORDER - 1`` symbols before it."""
    held, n, pad = [], 0, PAD * (ORDER - 1)
    for i, t in enumerate(texts):
        t = pad + (t or "").lower()
        for a in range(0, len(t) - ORDER + 1, size):
            held.append((i, t[a:a + size + ORDER - 1]))
            n += len(held[-1][1])
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def _codes(units: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all pieces, first place of every n-gram, its text)."""
    codes = np.frombuffer("".join([u for _, u in units]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(u) for _, u in units])
    starts = np.cumsum(sizes) - sizes
    grams = sizes - ORDER + 1
    place = np.arange(grams.sum()) + np.repeat(starts - (np.cumsum(grams) - grams), grams)
    return codes, place, np.repeat(np.array([i for i, _ in units]), grams)


def _distinct(units: list[tuple[int, str]]) -> Iterator[tuple[str, int]]:
    """(n-gram, count), each at least once. Characters are numbered first, so
    that an n-gram is one whole number; pieces of too many are halved."""
    codes, place, _ = _codes(units)
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    letters = np.flatnonzero(seen)
    bits = max(1, int(len(letters) - 1).bit_length())
    if bits * ORDER > 63:
        if len(units) == 1:
            i, text = units[0]
            half = len(text) // 2
            parts = [(i, text[:half + ORDER - 1]), (i, text[half:])]
        else:
            parts = units
        yield from _distinct(parts[:len(parts) // 2])
        yield from _distinct(parts[len(parts) // 2:])
        return
    number = np.zeros(0x110000, np.int64)
    number[letters] = np.arange(len(letters))
    coded = number[codes]
    packed = np.zeros(len(codes) - ORDER + 1, np.int64)
    for k in range(ORDER):
        packed = (packed << bits) | coded[k:k + len(packed)]
    found, counts = np.unique(packed[place], return_counts=True)
    split = np.stack([letters[(found >> (bits * (ORDER - 1 - k))) & ((1 << bits) - 1)] for k in range(ORDER)], axis=1)
    text = split.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    yield from zip((text[a:a + ORDER] for a in range(0, len(text), ORDER)), counts.tolist())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, gram, c), summed within a bounded table."""
    drop_kept()
    tables: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, table in tables.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(table), pa.string()), pa.array(list(table), pa.string()),
                 pa.array(list(table.values()), pa.int64())], names=["lang", "gram", "c"])
        tables.clear()
    for b in batches:
        rows = pd.DataFrame({"lang": b.column(0).to_pylist(), "text": b.column(1).to_pylist()})
        for lang, part in rows.groupby("lang", sort=False):
            table = tables.setdefault(lang, Counter())
            for units in _units(part["text"].tolist()):
                for gram, n in _distinct(units):
                    table[gram] += n
                if sum(map(len, tables.values())) > HELD_GRAMS:
                    yield from flush()
                    table = tables.setdefault(lang, Counter())
    yield from flush()
    pa.default_memory_pool().release_unused()  # the worker lives on


# -- the model ---------------------------------------------------------------------------

def train(trusted: DataFrame) -> DataFrame:
    """Model rows (lang, order, kind, gram, value) from (lang, text).

    kind 'a': discounted probability of the n-gram; kind 'g': weight that the
    context ``gram`` gives to the next lower order; kind 'v', order 0: the
    probability of any symbol. Every order is written before the next one."""
    bounded_batches(trusted.sparkSession)
    level = cut(trusted.mapInArrow(_count, "lang string, gram string, c long")
                .groupBy("lang", "gram").agg(F.sum("c").alias("c")), "grams")
    symbols = None
    out = []
    for order in range(ORDER, 0, -1):
        n = [F.count_if(F.col("c") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
        y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

        def discount(k: int) -> Column:
            a, b = F.col(f"n{k}"), F.col(f"n{k + 1}")
            d = F.when(a > 0, k - (k + 1) * y * b / a).otherwise(F.lit(0.5 * k))
            return F.greatest(F.lit(0.05), F.least(d, F.lit(float(k)))).alias(f"d{k}")
        spec = cut(level.groupBy("lang").agg(*n).select("lang", *[discount(k) for k in (1, 2, 3)]), "discounts")
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut_ = (sized_join(level, spec, ["lang"]).withColumn("d", F.least(d, F.col("c").cast("double")))
                .withColumn("ctx", F.substring("gram", 1, order - 1)))
        ctx = cut(cut_.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("taken")), "contexts")
        joined = sized_join(cut_, ctx, ["lang", "ctx"])
        a = joined.select("lang", F.lit(order).alias("order"), F.lit("a").alias("kind"), "gram",
                          ((F.col("c") - F.col("d")) / F.col("total")).alias("value"))
        g = ctx.select("lang", F.lit(order).alias("order"), F.lit("g").alias("kind"), F.col("ctx").alias("gram"),
                       (F.col("taken") / F.col("total")).alias("value"))
        out.append(cut(a.unionByName(g), "kneser-ney"))
        if order > 1:
            # continuation counts: in how many contexts the shorter n-gram ends one
            lower = cut(level.groupBy("lang", F.substring("gram", 2, ORDER).alias("gram")).agg(F.count("*").alias("c")),
                        "continuations")
        else:
            symbols = level.groupBy("lang").agg(F.count("*").alias("n")).select(
                "lang", F.lit(0).alias("order"), F.lit("v").alias("kind"), F.lit("").alias("gram"),
                (1.0 / (F.col("n") + 1)).alias("value"))  # one more for all that was never seen
            out.append(cut(symbols, "kneser-ney"))
        release(level, spec, ctx)
        level = lower if order > 1 else level
    return reduce(DataFrame.unionByName, out)


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """64 bits of n-grams, given as code points by place."""
    h = np.zeros(len(columns[0]) if columns else 1, np.uint64)
    for c in columns:
        h = (h ^ (h >> np.uint64(29)) ^ (c.astype(np.uint64) + np.uint64(1))) * _MUL
    return h ^ (h >> np.uint64(32))


def _pack(rows: pa.Table) -> pa.Table:
    """A shard of one order's entries as two byte strings: hashes and values."""
    grams, order, kind = rows["gram"].to_pylist(), rows["order"][0].as_py(), rows["kind"][0].as_py()
    width = order - (kind == "g")
    if width > 0:
        codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, width)
        keys = _hash(list(codes.T))
    else:
        keys = _hash([])
    return pa.table({"lang": rows["lang"].slice(0, 1), "order": rows["order"].slice(0, 1), "kind": rows["kind"].slice(0, 1),
                     "keys": pa.array([keys.tobytes()]), "values": pa.array([rows["value"].to_numpy().astype(np.float32).tobytes()])})


def held_model(model: DataFrame) -> dict[str, dict]:
    """The packed model: of every language, (hashes, values) of each order and
    kind, and of the longest n-grams their -ln p. Its size is bounded by the
    caller."""
    shards = cut(model.groupBy("lang", "order", "kind", F.pmod(F.xxhash64("gram"), F.lit(SALTS)).alias("_s"))
                 .applyInArrow(_pack, "lang string, order int, kind string, keys binary, values binary"), "packed-model")
    out: dict[str, dict] = {}
    # a partition's rows at a time, so that the driver holds the model once
    for lang, order, kind, *packed in shards.toLocalIterator():
        held = out.setdefault(lang, {}).setdefault((kind, order), (bytearray(), bytearray()))
        for table, some in zip(held, packed):
            table += some
    release(shards)
    for tables in out.values():
        for k in tables:
            keys, values = (np.frombuffer(t, d) for t, d in zip(tables[k], (np.uint64, np.float32)))
            by = np.argsort(keys)
            tables[k] = keys[by], values[by]
    return out


class Costs:
    """Costs of the n-grams that a task has met, in a table of one size for
    texts of any number and language: an n-gram takes the place of the one
    that had its slot."""

    def __init__(self):
        self.keys, self.cost = np.zeros(1 << COST_BITS, np.uint64), np.zeros(1 << COST_BITS, np.float32)
        self.keys[0] = ~np.uint64(0)  # of another slot: nothing is known yet
        self.scorers = 0

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - COST_BITS)).astype(np.int64)


class Scorer:
    """-ln p of texts by a packed model of one language."""

    def __init__(self, tables: dict, held: Costs):
        self.tables, self.held = tables, held
        self.base = float(tables["v", 0][1][0])
        held.scorers += 1
        # the same n-gram costs something else in another language
        self.mark = np.uint64(held.scorers * int(_MUL) % (1 << 64))

    def _find(self, kind: str, order: int, keys: np.ndarray, default: float) -> np.ndarray:
        table, values = self.tables.get((kind, order), (np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        if not len(table):
            return np.full(len(keys), default)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, values[at].astype(np.float64), default)

    def costs(self, columns: list[np.ndarray]) -> np.ndarray:
        """-ln p of n-grams, by the interpolation formula from order 1 up."""
        p = np.full(len(columns[0]), self.base)
        for order in range(1, ORDER + 1):
            mine = columns[ORDER - order:]
            context = _hash(mine[:-1]) if order > 1 else np.repeat(_hash([]), len(p))
            p = self._find("a", order, _hash(mine), 0.0) + self._find("g", order, context, 1.0) * p
        return -np.log(np.maximum(p, 1e-12))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of -ln p, symbols) of every text."""
        total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for units in _units(texts):
            codes, place, owner = _codes(units)
            every = _hash([codes[k:len(codes) - ORDER + 1 + k] for k in range(ORDER)])[place] ^ self.mark
            slot = self.held.slots(every)
            cost = self.held.cost[slot]
            new = np.flatnonzero(self.held.keys[slot] != every)
            if len(new):   # n-grams that are not remembered
                keys, first, back = np.unique(every[new], return_index=True, return_inverse=True)
                where = place[new[first]]
                fresh = self.costs([codes[where + k] for k in range(ORDER)]).astype(np.float32)
                cost[new] = fresh[back]
                slot = self.held.slots(keys)
                last = np.flatnonzero(np.diff(slot, append=-1))  # keys ascend: one n-gram a slot
                self.held.keys[slot[last]], self.held.cost[slot[last]] = keys[last], fresh[last]
            total += np.bincount(owner, cost, len(texts))
            n += np.bincount(owner, minlength=len(texts))
        return total, n


def _scores_held(docs: DataFrame, held: Broadcast, key: Column, body: Column) -> DataFrame:
    """``docs`` with _nll and _n: each task joins its n-grams with the packed model."""
    @F.pandas_udf("struct<nll:double,n:bigint>")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        drop_kept()
        costs, scorers = Costs(), {}
        for lang, text in batches:
            out = pd.DataFrame({"nll": np.nan, "n": np.zeros(len(text), np.int64)}, index=text.index)
            size = text.fillna("").str.lower().str.len()
            out["n"] = size.to_numpy()
            for k in lang[size > 0].unique():
                if k not in scorers:
                    scorers[k] = Scorer(held.value[k], costs) if k in held.value else None
                if scorers[k] is not None:
                    mine = (lang == k) & (size > 0)
                    total, n = scorers[k].scores(text[mine].tolist())
                    out.loc[mine, "nll"], out.loc[mine, "n"] = total / n, n
            yield out
        pa.default_memory_pool().release_unused()  # the worker lives on
    # not deterministic to Spark: a filter on the scores must not make it score every text once more below
    scored = docs.withColumn("_score", score.asNondeterministic()(key, body))
    return (scored.withColumn("_nll", F.when(~F.isnan("_score.nll"), F.col("_score.nll")))
            .withColumn("_n", F.col("_score.n")).drop("_score"))


def _grams_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t1, t2, lang, text) -> (t1, t2, lang, gram, c): a text's distinct n-grams of a slice."""
    for b in batches:
        for i, text in enumerate(b.column(3).to_pylist()):
            for units in _units([text]):
                found = Counter()
                for gram, n in _distinct(units):
                    found[gram] += n
                at = pa.array([i] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), b.column(2).take(at),
                     pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                    names=["t1", "t2", "lang", "gram", "c"])


def _scores_joined(docs: DataFrame, model: DataFrame, key: Column, body: Column) -> DataFrame:
    """``docs`` with _nll and _n by shuffle joins, for a model of any size."""
    named = docs.withColumns({"_key": key, "_body": body})
    d1, d2 = text_digest(F.col("_body"))
    named = named.select("*", d1, d2)
    texts = (named.filter("_body is not null").groupBy("t1", "t2", F.col("_key").alias("lang"))
             .agg(F.first("_body").alias("text")))
    grams = cut(texts.select("t1", "t2", "lang", "text")
                .mapInArrow(_grams_of_texts, "t1 long, t2 long, lang string, gram string, c long"), "text-grams")
    p = grams.select("lang", "gram").distinct().join(
        model.filter("kind = 'v'").select("lang", F.col("value").alias("_p")), "lang")
    for order in range(1, ORDER + 1):
        part = model.filter(F.col("order") == order)
        a = part.filter("kind = 'a'").select("lang", F.col("gram").alias("_a"), F.col("value").alias("_av"))
        g = part.filter("kind = 'g'").select("lang", F.col("gram").alias("_g"), F.col("value").alias("_gv"))
        p = (p.withColumn("_a", F.substring("gram", ORDER - order + 1, order))
             .withColumn("_g", F.substring("gram", ORDER - order + 1, order - 1))
             .join(a, ["lang", "_a"], "left").join(g, ["lang", "_g"], "left")
             .select("lang", "gram", (F.coalesce("_av", F.lit(0.0)) + F.coalesce("_gv", F.lit(1.0)) * F.col("_p")).alias("_p")))
    # a common n-gram is in most texts: its cost is there once per salt
    cost = p.select("lang", "gram", (-F.log(F.greatest("_p", F.lit(1e-12)))).alias("_cost"),
                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    sums = (grams.withColumn("_salt", F.pmod(F.col("t1"), F.lit(SALTS)).cast("int"))
            .join(cost, ["lang", "gram", "_salt"])
            .groupBy("t1", "t2", "lang").agg((F.sum(F.col("c") * F.col("_cost")) / F.sum("c")).alias("_nll")))
    done = cut(sums.withColumnRenamed("lang", "_key"), "text-costs")
    return (named.join(done, ["t1", "t2", "_key"], "left")
            .withColumn("_n", F.coalesce(F.length(F.lower("_body")), F.lit(0)).cast("long")).drop("t1", "t2", "_key", "_body"))


def placed(model: DataFrame, model_bytes: int = MODEL_BYTES) -> DataFrame | Broadcast:
    """The model as scoring uses it: packed and sent to the tasks once if it
    fits, its entries counted, else the table itself."""
    fits = 12 * model.count() <= model_bytes
    return model.sparkSession.sparkContext.broadcast(held_model(model)) if fits else model


def perplexities(docs: DataFrame, model: DataFrame | Broadcast, lang: str = "lang", text: str = "text") -> DataFrame:
    """``docs`` with _nll (mean -ln p per symbol, null without a model) and _n
    (symbols)."""
    bounded_batches(docs.sparkSession)
    key = F.coalesce(F.col(f"`{lang}`"), F.lit(""))
    body = F.when(F.trim(F.col(f"`{text}`")) != "", F.col(f"`{text}`"))
    return (_scores_joined if isinstance(model, DataFrame) else _scores_held)(docs, model, key, body)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
             lang: str = "lang", label: str = "quality", upper: float = UPPER, lower: float = LOWER,
             model_bytes: int = MODEL_BYTES) -> DataFrame:
    """``docs`` with n_symbols, perplexity, threshold (the largest accepted
    perplexity of the language), least (the smallest) and accepted; columns of
    the input with these names are replaced."""
    docs, restore = shield(docs, [id_col, text, lang])
    ids = (labels.filter(F.col(f"`{label}`") == 1).select(F.col(f"`{id_col}`").alias("_id"))
           .filter(F.col("_id").isNotNull()).distinct())
    key = F.coalesce(F.col(f"`{lang}`"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), key.alias("lang"), F.col(f"`{text}`").alias("text"))
    trusted = sized_join(narrow, ids, ["_id"], "left_semi").select("lang", "text")
    held = F.pmod(F.xxhash64(F.lit("held out"), F.coalesce("text", F.lit(""))), F.lit(HELD_OUT)) == 0
    model = placed(train(trusted.filter(~held)), model_bytes)
    seen = perplexities(trusted.filter(held), model, "lang", "text")
    # in millionths: a sum's order must not decide about a text that is a quantile itself
    nll = F.round("_nll", 6)
    limits = cut(seen.filter("_nll is not null").groupBy(F.col("lang").alias("_lang"))
                 .agg(F.percentile_approx(nll, [lower, upper], 100_000).alias("_q"))
                 .select("_lang", F.exp(F.col("_q")[0]).alias("least"), F.exp(F.col("_q")[1]).alias("threshold")), "quantiles")
    scored = perplexities(docs.withColumn("_lang", key), model, "_lang", text)
    perplexity = F.exp(nll)
    inside = perplexity.between(F.col("least"), F.col("threshold"))
    judged = (sized_join(scored, limits, ["_lang"], "left")  # one row per language
              .withColumn("perplexity", perplexity).withColumn("n_symbols", F.col("_n"))
              .withColumn("accepted", (F.col("_n") > 0) & F.coalesce(inside, F.lit(True))))
    return restore(judged, "n_symbols", "perplexity", "threshold", "least", "accepted")
