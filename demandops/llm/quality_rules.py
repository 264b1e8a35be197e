"""Quality rules with risk-controlled thresholds.

Row-local statistics of whole texts; cutoffs on four ratios are chosen per
stratum (language) from labelled documents: a cutoff is certified when the
exact binomial test of its false rejections on good documents beats the level
``delta`` divided by the number of tests (Bonferroni over strata, rules and
the cutoff grid); the strictest certified cutoff of each rule is used. With
probability 1 - delta every stratum loses at most ``alpha`` of its good
documents to all rules together (``alpha`` is split evenly over the rules).
Only DataFrame functions on the main path.

Defined results: a null or empty text has zero counts and fails the base
rule; null strata form one stratum; strata without enough labelled documents
get no cutoff, so the method rejects nothing there; labels whose value is
null are ignored; repeated rows are judged row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import cut

SEP = " \t\n\x0b\x0c\r"
SEP_CLASS = r"[\x20\x09-\x0D]"
POS_BITS = 20  #: bits of a packed (hash, position); longer texts go the exact way

#: rule -> grid of cutoffs (a document above its cutoff is rejected)
GRIDS: dict[str, list[float]] = {
    "symbol_ratio": [i / 100 for i in range(1, 31)],
    "dup_line_ratio": [i / 50 for i in range(1, 31)],
    "repeat_ratio": [i / 50 for i in range(1, 31)],
    "mean_word_chars": [6.0 + i / 2 for i in range(30)],
}


def word_array(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; no words for null or blank texts."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEP))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SEP_CLASS + "+"))


def _covered(pos: Column) -> Column:
    """Words covered by 3-word windows that start at the sorted ``pos``."""
    gaps = F.transform(F.sequence(F.lit(1), F.size(pos) - 1),
                       lambda j: F.least(F.lit(3), pos[j] - pos[j - 1]))
    inner = F.when(F.size(pos) > 1, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)) \
        .otherwise(F.lit(0).cast("long"))
    return F.when(F.size(pos) == 0, F.lit(0).cast("long")).otherwise(inner + 3)


def _exact_repeats(w: Column) -> Column:
    """Start positions of repeated windows by sorting the windows themselves;
    only for texts of 2^20 words or with a hash collision. The sorted array is
    bound to a lambda variable, so it is made once and not per element."""
    grams = F.array_sort(F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("g"),
                           i.cast("long").alias("i"))))

    def positions(g: Column) -> Column:
        equal = lambda a, b: F.coalesce(F.get(g, a)["g"] == F.get(g, b)["g"], F.lit(False))
        dup = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda k: equal(k, k - 1) | equal(k, k + 1))
        return F.sort_array(F.transform(dup, lambda k: F.get(g, k)["i"]))
    return F.element_at(F.transform(F.array(grams), positions), 1)


def text_statistics(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` columns and n_words, word_chars, n_symbols, n_lines (with a
    word), n_dup_lines, n_repeat_words of the whole text, row by row."""
    cols = [F.col(f"`{c}`") for c in keep]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(*cols, word_array(t).alias("_w"), lines.alias("_lines"),
                       (F.size(F.split(t, "[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"))
    # _w is named more than once below, so Spark computes it once a row
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.xxhash64(F.col("_w")[i], F.col("_w")[i + 1], F.col("_w")[i + 2])
        .bitwiseAND(F.lit(-(1 << POS_BITS))).bitwiseOR(i.cast("long")))
    packed = base.select(
        *cols, "n_symbols", "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when((F.size("_w") >= 3) & (F.size("_w") < (1 << POS_BITS)), F.sort_array(hashes))
        .otherwise(F.array().cast("array<bigint>")).alias("_p"))
    p, w, bits = F.col("_p"), F.col("_w"), POS_BITS
    at = lambda k: p[k].bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    same = lambda a, b: F.shiftright(p[a], bits) == F.shiftright(p[b], bits)
    m = F.size(p)
    run = F.when(m > 1, F.filter(F.sequence(F.lit(1), m - 1), lambda k: same(k, k - 1))) \
        .otherwise(F.array().cast("array<int>"))
    runs = packed.withColumn("_run", run)
    r = F.col("_run")
    wrong = F.exists(r, lambda k: (w[at(k)] != w[at(k - 1)]) | (w[at(k) + 1] != w[at(k - 1) + 1])
                     | (w[at(k) + 2] != w[at(k - 1) + 2]))
    pos = F.sort_array(F.array_distinct(F.flatten(F.transform(
        r, lambda k: F.array(at(k).cast("long"), at(k - 1).cast("long"))))))
    placed = runs.select(*cols, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                         F.when((F.size("_w") >= (1 << POS_BITS)) | wrong, _exact_repeats(w))
                         .otherwise(pos).alias("_pos"))
    return placed.select(*cols, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                         _covered(F.col("_pos")).alias("n_repeat_words"))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))


def with_ratios(stats: DataFrame) -> DataFrame:
    return (stats.withColumn("symbol_ratio", _ratio("n_symbols", "word_chars"))
            .withColumn("dup_line_ratio", _ratio("n_dup_lines", "n_lines"))
            .withColumn("repeat_ratio", _ratio("n_repeat_words", "n_words"))
            .withColumn("mean_word_chars", _ratio("word_chars", "n_words")))


def _lgamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, shifted back."""
    y, shift = x + 8, F.lit(0.0)
    for k in range(8):
        shift = shift + F.ln(x + k)
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + series - shift


def binomial_tail(k: Column, n: Column, alpha: float) -> Column:
    """P(Bin(n, alpha) <= k), exact to double precision: the largest term by
    ln Gamma, the rest by the ratio of neighbouring terms from k downwards.
    For k under the mean the terms fall, and after ten standard deviations
    they are below the precision; 1 for k at or above the mean."""
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(_lgamma(n + 1) - _lgamma(k + 1) - _lgamma(n - k + 1)
                + k * F.ln(F.lit(alpha))
                + (n - k) * F.ln(F.lit(1 - alpha)))
    steps = F.least(k, F.ceil(10 * F.sqrt(n * alpha * (1 - alpha))) + 50).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct(
            (a["term"] * (k - i) * (1 - alpha) / ((n - k + i + 1) * alpha)).alias("term"),
            (a["sum"] + a["term"]).alias("sum")))["sum"]
    return F.when(k >= n * alpha, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * total))


def certified_cutoffs(good: DataFrame, stratum: str, alpha: float = 0.02,
                      delta: float = 0.05, grids: dict[str, list[float]] = GRIDS) -> DataFrame:
    """(stratum, rule, cutoff): the strictest certified cutoff of each rule.

    ``good``: labelled good documents with the ratio columns. One pass with a
    count per grid cutoff; strata x rules x grid rows afterwards."""
    risk = alpha / len(grids)
    aggs = [F.sum((F.col(rule) > c).cast("long")).alias(f"{rule}_{i}")
            for rule, grid in grids.items() for i, c in enumerate(grid)]
    counts = good.groupBy(stratum).agg(F.count("*").alias("_n"), *aggs)
    cells = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cutoff"),
                               F.col(f"{rule}_{i}").alias("k"))
                      for rule, grid in grids.items() for i, c in enumerate(grid)])
    tests = counts.select(stratum, "_n", F.explode(cells).alias("c")).select(stratum, "_n", "c.*")
    n_strata = counts.count()
    level = delta / max(1, n_strata * sum(len(g) for g in grids.values()))
    passed = tests.filter(binomial_tail(F.col("k"), F.col("_n"), risk) <= F.lit(level))
    return passed.groupBy(stratum, "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",),
          id_col: str = "doc_id", text: str = "text", stratum: str = "lang",
          label: str = "quality", alpha: float = 0.02, delta: float = 0.05,
          min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """Statistics, base verdict and the risk-controlled verdict of every row.

    Adds ``failed_rules`` (rules above their certified cutoff). The label side
    is joined by shuffle on the id with narrow rows (no texts)."""
    names = list(dict.fromkeys([*keep, id_col]))
    st = docs.select(*[F.col(f"`{c}`") for c in names],
                     F.coalesce(F.col(f"`{stratum}`"), F.lit("")).alias("_stratum"),
                     F.col(f"`{text}`").alias("_text"))
    stats = cut(with_ratios(text_statistics(st, [*names, "_stratum"], "_text")), "quality-stats")
    good_ids = (labels.filter(F.col(f"`{label}`") == 1).select(F.col(f"`{id_col}`").alias("_id"))
                .filter(F.col("_id").isNotNull()).distinct())
    base_failed = (F.col("n_words") < min_words) | \
        (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    good = stats.filter(~base_failed).join(good_ids, stats[id_col] == good_ids["_id"], "left_semi")
    cutoffs = certified_cutoffs(good, "_stratum", alpha, delta)
    wide = cutoffs.groupBy("_stratum").agg(*[
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in GRIDS])
    failed = F.filter(F.array(*[F.when(F.col(r) > F.col(f"_cut_{r}"), F.lit(r)) for r in GRIDS]),
                      lambda x: x.isNotNull())
    # one row per stratum that has labelled documents: Spark broadcasts it by its size
    return (stats.join(wide, "_stratum", "left")
            .withColumn("failed_rules", failed)
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .drop("_stratum", *[f"_cut_{r}" for r in GRIDS]))
