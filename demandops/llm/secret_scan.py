"""Secret scans with a random forest for false-positive removal.

Whole texts are searched for candidates (long tokens with a digit or inner
capitals, assignments, private key blocks). Each gets features: length, digit
and capital shares, entropy, character transitions (class changes, and how
likely its letter pairs are in ordinary words), dictionary coverage, path
marks, assignment marks and what its neighbouring words say. A forest, fitted
on a bounded sample of labelled findings, keeps the true ones.

Labelled findings are a column of the candidates: either given by the caller
or, as in the query, by strict formats (``format_label``): known forms of secrets
are true, known other forms (paths, links, dates, numbers, dictionary words)
are false, and all else is unlabelled: the forest isn't fitted on it, but
judges it.

Defined results: null and empty texts have no findings; repeated rows have
each their own; without labelled findings of both kinds the labels decide, and
the unlabelled are none;
texts without words give an empty dictionary, and all coverage is 0; words that
no text but the value's own holds don't cover it (a secret isn't its own
dictionary; one that another text repeats can be), nor do words of over
``LONGEST`` letters; values of any length are whole candidates; a key block
without its end takes the lines of its body.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandops.llm.common import bloom_blocks, bloom_build, bloom_probe, bounded_batches, cut, shield, sized_join, text_digest

MAX_TRUE, MAX_FALSE = 4000, 12000  #: labelled findings to fit on (least hashes)
LETTERS = 26                       #: a word is known if it is likelier than random letters
LONGEST = 64                       #: letters of the longest dictionary word
PIECES = 50_000                    #: pieces of values that a task holds at a time
TREES, DEPTH = 30, 8

# fixed values: names that introduce a secret
KEY_NAMES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key",
             "auth", "credential", "private_key")

NAMED = "|".join(n if n != "auth" else "auth(?!or)" for n in KEY_NAMES)
#: forms that only secrets have
SECRETS = (r"^(AKIA|ASIA)[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^github_pat_[A-Za-z0-9_]{22,}$",
           r"^xox[abeoprs]-[A-Za-z0-9-]{10,}$", r"^AIza[A-Za-z0-9_-]{35}$", r"^[srp]k_(live|test)_[A-Za-z0-9]{16,}$",
           r"^glpat-[A-Za-z0-9_-]{20,}$", r"^eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}$")
#: forms of other things: numbers and dates, paths and links, hosts, letters of one case, UUIDs
OTHERS = (r"^[0-9.,:/_+TZ=-]+$", r"^(https?:)?/{0,2}[A-Za-z0-9_.-]{1,24}(/[A-Za-z0-9_.=-]{0,24}){2,}$",
          r"^([a-z0-9-]{1,24}\.)+[a-z]{2,6}$", r"^([A-Z]+|[a-z]+)$",
          r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")

#: a name that introduces a secret, and its value: quoted, or up to a space
_NAMED = re.compile(r"(?i)((?:" + NAMED + r")[\w.\-]{0,40})[\"']?[ \t]*(?:=>|:=|[=:])[ \t]*"
                    r"(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"']\S*))")
_CANDIDATE = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----|[A-Za-z0-9+/_.\-]+[=:]?[A-Za-z0-9+/_.=\-]{12,}")
_ASSIGNED = re.compile(r"^([A-Za-z_][A-Za-z_\-]{1,30})[=:](.{8,})$")
_BODY = re.compile(r"(?:\s+[A-Za-z0-9+/=]{16,}(?=\s|$))*(?:\s+[A-Za-z0-9+/]+={1,2}(?=\s|$))?")
_BEFORE = re.compile(r"(\w+)\W*$")
_AFTER = re.compile(r"^\W*(\w+)")
#: words, capitals or abbreviations between marks: no mixed case inside a part
_PLAIN = re.compile(r"^(?:[A-Z]?[a-z]*|[A-Z]+)(?:[+/_.=\-]+(?:[A-Z]?[a-z]*|[A-Z]+))*$")
_LETTERS = re.compile(r"[^\W\d_]{3,}")
_PASSED = re.compile(r"(\w+)\s*([=:])\s*[\"']?$")

FEATURES = ["length", "digits", "capitals", "hexes", "entropy", "changes", "pairs", "coverage",
            "slashes", "dots", "assigned", "quoted"]
SCANNED = [f for f in FEATURES if f != "coverage"]  #: known without the dictionary


def format_label(kind: Column, value: Column, key: Column, coverage: Column) -> Column:
    """1 for known forms of secrets, 0 for known forms of other things, else null."""
    named = F.lower(key).rlike(NAMED)
    mixed = (value.rlike("[0-9]").cast("int") + value.rlike("[a-z]").cast("int") + value.rlike("[A-Z]").cast("int")
             + value.rlike("[^A-Za-z0-9]").cast("int"))
    other = F.lit(False)
    for form in OTHERS:
        other = other | value.rlike(form)
    words = (coverage >= 0.8) & ~value.rlike("[0-9]")
    return F.when((kind == "block") | value.rlike("|".join(SECRETS)), 1) \
        .when(named & ~words & (F.length(value) >= 8) & ((mixed >= 3) | ((mixed == 2) & value.rlike("[0-9]"))), 1) \
        .when(words | (other & ~named), 0)


class Words:
    """What ordinary words look like: letter pair weights, 27 x 27."""

    def __init__(self, counts: list[tuple[str, int]]):
        pairs = np.ones((27, 27))
        for pair, c in counts:
            pairs[self._slot(pair[0]), self._slot(pair[1])] += c
        self.pairs = np.log(pairs / pairs.sum(1, keepdims=True)).tolist()

    @classmethod
    def of(cls, pairs: list[list[float]]) -> "Words":
        words = cls.__new__(cls)
        words.pairs = pairs
        return words

    @staticmethod
    def _slot(ch: str) -> int:
        return ord(ch) - 96 if "a" <= ch <= "z" else 0

    def pair_weight(self, low: str) -> float:
        s = [self._slot(ch) for ch in low]
        return sum(self.pairs[a][b] for a, b in zip(s, s[1:])) / max(1, len(s) - 1)


def pieces(low: str, longest: int) -> Iterator[str]:
    """Parts of three letters or more of a value's runs of letters."""
    for run in _LETTERS.findall(low):
        for i in range(len(run) - 2):
            for n in range(3, min(longest, len(run) - i) + 1):
                yield run[i:i + n]


def coverage(low: str, known: set[str]) -> float:
    """Share of characters under dictionary words, longest first."""
    at, hit, longest = 0, 0, max((len(w) for w in known), default=0)
    while at < len(low):
        for n in range(min(longest, len(low) - at), 2, -1):
            if low[at:at + n] in known:
                hit += n
                at += n
                break
        else:
            at += 1
    return hit / max(1, len(low))


def _kind_of(ch: str) -> int:
    return 0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 3


def describe(value: str, before: str, assigned: bool, words: Words) -> list[float]:
    n, low = len(value), value.lower()
    kinds = [_kind_of(c) for c in value]
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    return [float(n), kinds.count(2) / n, kinds.count(1) / n, sum(c in "0123456789abcdef" for c in low) / n,
            entropy, sum(a != b for a, b in zip(kinds, kinds[1:])) / n, words.pair_weight(low),
            float(value.count("/") + before.endswith("/")), float(value.count(".")), float(assigned),
            float(before[-1:] in ("'", '"'))]


def find(text: str, words: Words) -> Iterator[tuple]:
    """(start, end, kind, value, key, before, after, features) of candidates;
    offsets in characters of the text. Every value after a name of ``KEY_NAMES``
    is one, whatever its characters and length."""
    def token(s: int, e: int, key: str) -> tuple:
        value, before, after = text[s:e], text[max(0, s - 40):s], text[e:e + 40]
        prev, nxt = _BEFORE.search(before), _AFTER.search(after)
        return (s, e, "token", value, key, prev.group(1).lower() if prev else "", nxt.group(1).lower() if nxt else "",
                describe(value, before, bool(key), words))

    taken = []
    for m in _NAMED.finditer(text):
        group = next(g for g in (2, 3, 4) if m.group(g) is not None)
        s, e = m.span(group)
        if group == 4:
            e = s + (len(m.group(4).rstrip(".,;)]}>")) or e - s)
        if text.startswith("-----BEGIN", s):
            continue
        taken.append((s, e))
        yield token(s, e, m.group(1))
    at = 0
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        value, key = m.group(), ""
        if value.startswith("-----BEGIN"):
            stop, other = text.find("-----END", e), text.find("-----BEGIN", e)
            if stop < 0 or 0 <= other < stop:
                stop = _BODY.match(text, e).end()
            else:
                stop = text.find("-----", stop + 8) + 5
            yield s, max(e, stop), "block", value, "", "", "", describe(value, "", False, words)
            continue
        value = value.rstrip(".-")
        e = s + len(value)
        part = _ASSIGNED.match(value)
        if part:
            key, s = part.group(1), s + part.start(2)
            value = part.group(2)
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if at < len(taken) and taken[at][0] < e:   # named: given above
            continue
        # without a digit: inner capitals, or marks between mixed cases
        if not any(c.isdigit() for c in value) and (value[1:].islower() or not value.isalnum() and (
                value.islower() or value.isupper() or _PLAIN.match(value))):
            continue
        if len(value) < 8:
            continue
        passed = _PASSED.search(text[max(0, s - 40):s])
        yield token(s, e, key or (passed.group(1) if passed else ""))


def learn_words(docs: DataFrame, text: str = "text") -> tuple[Words, DataFrame]:
    """Letter pair weights and the dictionary (w, only), from all texts. Words
    are runs of letters of any script between other characters; the dictionary
    has those of three letters or more whose share of all words is above that of
    a random string of their length, which holds alike at every size. ``only``
    is the digest of the text that alone holds a word, else null."""
    t, body = F.lower(F.col(f"`{text}`")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    first, last = F.min("t1"), F.max("t1")
    counts = cut(docs.select(F.xxhash64(body).alias("t1"), F.explode(F.split(t, r"[^\p{L}\p{M}\p{N}_]+")).alias("w"))
                 .filter(F.col("w").rlike(r"^[\p{L}\p{M}]{2,}$")).groupBy("w")
                 .agg(F.count("*").alias("c"), F.when(first == last, first).alias("only")), "words")
    pairs = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))
    pair = F.regexp_replace("pair", "[^a-z]", "`")
    table = (counts.select(F.explode(pairs).alias("pair"), "c").groupBy(pair.alias("pair"))
             .agg(F.sum("c").alias("c")).collect())  # at most 27 x 27 rows
    total = counts.agg(F.sum("c")).first()[0] or 0
    n = F.length("w")
    known = (counts.filter(n.between(3, LONGEST) & (F.col("c") > total * F.pow(F.lit(float(LETTERS)), -n)))
             .select("w", "only"))
    return Words([(r[0], r[1]) for r in table]), known


def covered(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with coverage: the pieces of all distinct values meet the whole
    dictionary in a join, broadcast only behind a count of its rows. Pieces move
    without their value, some at a time, so that a very long value fits.
    Without a column t1 (its text's digest) no text is a value's own."""
    longest = known.agg(F.max(F.length("w"))).first()[0] or 0
    keyed = found.withColumns(dict(zip(("v1", "v2"), text_digest(F.lower("value")))))
    text = F.col("t1") if "t1" in found.columns else F.lit(None).cast("long")

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["v1", "v2", "own", "w"]
        for pdf in batches:
            rows: list[tuple] = []
            for v1, v2, own, low in zip(pdf["v1"], pdf["v2"], pdf["own"].astype("object"), pdf["low"]):
                seen: set[str] = set()
                for w in pieces(low, longest):
                    seen.add(w)
                    if len(rows) + len(seen) >= PIECES:
                        yield pd.DataFrame(rows + [(v1, v2, own, w) for w in seen], columns=names)
                        rows, seen = [], set()
                rows += [(v1, v2, own, w) for w in seen]
            yield pd.DataFrame(rows, columns=names)

    @F.pandas_udf("double")
    def share(values: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([coverage(v, set(w)) for v, w in zip(values, words)], dtype="float64")
    values = cut(keyed.withColumn("_text", text).groupBy("v1", "v2").agg(
        F.first(F.lower("value")).alias("low"),
        F.coalesce(F.when(F.min("_text") == F.max("_text"), F.hex(F.min("_text"))), F.lit("")).alias("own")), "values")
    parts = values.mapInPandas(cut_up, "v1 long, v2 long, own string, w string")
    hits = (sized_join(parts, known, ["w"]).filter("only is null or hex(only) != own")
            .groupBy("v1", "v2").agg(F.collect_set("w").alias("ws")))
    shares = cut(values.join(hits, ["v1", "v2"]).select("v1", "v2", share("low", "ws").alias("coverage")), "coverage")
    return sized_join(keyed, shares, ["v1", "v2"], "left").fillna({"coverage": 0.0}).drop("v1", "v2")


def candidates(docs: DataFrame, words: Words, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: id, t1, t2 (text digest), start, end, kind,
    value, key, before, after and the features but coverage."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(words.pairs)  # 27 x 27 numbers
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(t).alias("t1"),
                      F.xxhash64(F.lit("second"), t).alias("t2"), t.alias("text"))
    fields = src.schema.fields[:3] + T._parse_datatype_string(
        "start long, end long, kind string, value string, key string, before string, after string").fields + \
        [T.StructField(f, T.DoubleType()) for f in SCANNED]
    names = [f.name for f in fields]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words.of(held.value)
        for pdf in batches:
            rows, at = [], []
            for i, body in enumerate(pdf["text"]):
                for hit in find(body, known):
                    rows.append((*hit[:7], *hit[7]))
                    at.append(i)
            left = pdf[["id", "t1", "t2"]].iloc[at].reset_index(drop=True)
            yield pd.concat([left, pd.DataFrame(rows, columns=names[3:])], axis=1)[names]

    return src.mapInPandas(scan, T.StructType(fields))


def _neighbour_weights(sample: pd.DataFrame) -> dict[str, float]:
    """Log odds of a true finding next to each word of the sample."""
    true, all_ = Counter(), Counter()
    for b, a, y in zip(sample["before"], sample["after"], sample["label"]):
        for w in {b, a} - {""}:
            all_[w] += 1
            true[w] += y
    base = sample["label"].mean()
    return {w: math.log((true[w] + 2 * base) / (n - true[w] + 2 * (1 - base))) for w, n in sorted(all_.items())}


def judge(found: DataFrame, label: Column) -> DataFrame:
    """``found`` with score (forest's probability) and secret."""
    spark = found.sparkSession
    found = cut(found.withColumn("label", label), "candidates")
    order = F.xxhash64("value", "id", "start")
    least = [found.filter(F.col("label") == y).orderBy(order, "value", "start").limit(n)
             for y, n in ((1, MAX_TRUE), (0, MAX_FALSE))]
    sample = least[0].unionByName(least[1]).toPandas()  # bounded by MAX_TRUE + MAX_FALSE rows
    if sample["label"].nunique() < 2:
        score = F.coalesce(F.col("label").cast("double"), F.lit(0.0))
        return found.withColumn("score", score).withColumn("secret", score == 1)
    weights = _neighbour_weights(sample)
    near = spark.createDataFrame(list(weights.items()), "word string, weight double")  # two words of 40 characters a sampled row

    def weighted(df: DataFrame) -> DataFrame:
        for side in ("before", "after"):
            named = near.select(F.col("word").alias(side), F.col("weight").alias(f"{side}_weight"))
            df = df.join(F.broadcast(named), side, "left").fillna({f"{side}_weight": 0.0})
        return df
    inputs = [*FEATURES, "before_weight", "after_weight"]
    assemble = VectorAssembler(inputCols=inputs, outputCol="_x")
    columns = sample.sort_values(["label", "value", "start"])[[*FEATURES, "before", "after", "label"]]
    train = assemble.transform(weighted(spark.createDataFrame(columns).coalesce(1)))
    forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                    seed=5, probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r").fit(train)
    scored = forest.transform(assemble.transform(weighted(found)))
    return (scored.withColumn("score", vector_to_array("_p")[1]).withColumn("secret", F.col("score") >= 0.5)
            .drop("_x", "_p", "_y", "_r", "before_weight", "after_weight"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All candidates of all texts, judged; labels by strict formats."""
    words, known = learn_words(docs, text)
    found = covered(cut(candidates(docs, words, id_col, text), "scanned"), known)
    return judge(found, format_label(*[F.col(c) for c in ("kind", "value", "key", "coverage")]))


def redact(docs: DataFrame, findings: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the confirmed findings replaced in ``text``. Texts without
    findings don't move: a fixed-size filter sends only possible ones to the join."""
    spans = cut(findings.filter("secret").groupBy("t1", "t2")
                .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans")), "secret-spans")
    blocks = bloom_blocks(spans.count())
    plain, restore = shield(docs, [text])
    keyed = plain.select("*", *text_digest(F.col(f"`{text}`")))
    flagged = bloom_probe(keyed, bloom_build(spans, ["t1", "t2"], blocks), ["t1", "t2"], blocks, "_flag")

    @F.pandas_udf("string")
    def replace(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for body, parts in zip(texts, cuts):
            done, at = [], 0
            for p in parts:
                if p["start"] >= at:
                    done += [body[at:p["start"]], mark]
                at = max(at, p["end"])
            out.append("".join(done) + body[at:])
        return pd.Series(out)

    joined = flagged.filter("_flag").join(spans, ["t1", "t2"], "left")
    hit = joined.filter("_spans is not null").withColumn(text, replace(F.col(f"`{text}`"), "_spans"))
    rest = joined.filter("_spans is null").unionByName(
        flagged.filter("not _flag").withColumn("_spans", F.lit(None).cast(spans.schema["_spans"].dataType)))
    return restore(hit.unionByName(rest))
