"""Box-plot statistics shared by several exploratory datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandops.functions.joins import lookup_join


def box_stats(df: DataFrame, group: str, value: str, whisker: float = 1.5,
              method: str = "bracket") -> DataFrame:
    """Per group: quartiles (linear interpolation), whiskers = most extreme
    values inside [Q1 - 1.5 IQR, Q3 + 1.5 IQR], and the row count.

    All three quartiles come from one call of ``group_quantiles`` (two
    passes); the whiskers from one more aggregate over the rows joined to
    their group's fences.  NULL groups and values are skipped."""
    rows = df.select(group, F.col(value).cast("double").alias("_v")).dropna()
    q = group_quantiles(rows, group, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, method)
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumns({"_lo": F.col("q1") - whisker * iqr, "_hi": F.col("q3") + whisker * iqr})
    return (lookup_join(rows, fences, [group], "inner")
                .groupBy(group, "q1", "median", "q3")
                .agg(F.min(F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))).alias("whisker_low"),
                     F.max(F.when(F.col("_v") <= F.col("_hi"), F.col("_v"))).alias("whisker_high"),
                     F.count(F.lit(1)).alias("n")))


def group_median(df: DataFrame, group, value: str, method: str = "bracket",
                 accuracy: int = 10000, out: str = "median") -> DataFrame:
    """Median of ``value`` per group; see ``group_quantile``."""
    return group_quantile(df, group, value, 0.5, method, accuracy, out)


def group_quantile(df: DataFrame, group, value: str, p: float, method: str = "bracket",
                   accuracy: int = 10000, out: str = "quantile") -> DataFrame:
    """One quantile of ``value`` per group; see ``group_quantiles``."""
    return group_quantiles(df, group, value, {out: p}, method, accuracy)


def group_quantiles(df: DataFrame, group, value: str, quantiles: Mapping[str, float],
                    method: str = "bracket", accuracy: int = 10000) -> DataFrame:
    """Quantiles of ``value`` per group, a column of each name (linear
    interpolation between the ranks floor/ceil((n - 1) p), as ``percentile``).

    * ``exact``   one ``percentile`` aggregate; its buffer holds every
                  distinct value of a group (unbounded for a hot group of
                  high-cardinality doubles).
    * ``approx``  ``percentile_approx`` with relative rank error 1/accuracy.
    * ``bracket`` exact results with bounded memory, in two passes however
                  many quantiles are asked for:
        1. per group: the count, and for every quantile approximate ones just
           below / above its rank -> a bracket [lo, hi];
        2. one aggregate over the rows joined to their brackets counts each
           distinct value inside a bracket, and as one bucket the rows
           between two brackets;
        then one window over those buckets, in the order of their least
        values, finds the values at all ranks.  Groups under ``accuracy``
        rows bracket their whole range; for larger ones the margin
        (3/accuracy) exceeds the sketch's rank error (1/accuracy) plus one
        rank, so both ranks always fall inside; the query fails loudly if
        that were violated.
    NULL values are ignored.  With ``bracket`` a group without any value is
    absent from the result (callers left-join, which yields NULL).
    """
    keys = [group] if isinstance(group, str) else list(group)
    names = sorted(quantiles, key=lambda k: quantiles[k])
    probs = [float(quantiles[k]) for k in names]
    v = F.col(value).cast("double")
    if method in ("exact", "approx"):
        q = F.percentile(v, probs) if method == "exact" else F.percentile_approx(v, probs, accuracy)
        found = df.groupBy(*keys).agg(q.alias("_q"))
        return found.select(*keys, *[F.col("_q")[names.index(k)].cast("double").alias(k) for k in quantiles])
    if method != "bracket":
        raise ValueError(f"unknown median method {method!r}")

    rows = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    margin, n = 3.0 / accuracy, range(len(probs))
    ends = [min(1.0, max(0.0, p + side)) for p in probs for side in (-margin, margin)]
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", ends, accuracy).alias("_q"))
    small = F.col("_n") < accuracy
    stats = stats.select(*keys, "_n", *[c for i in n for c in (
        F.when(small, F.col("_min")).otherwise(F.col("_q")[2 * i]).alias(f"_lo{i}"),
        F.when(small, F.col("_max")).otherwise(F.col("_q")[2 * i + 1]).alias(f"_hi{i}"))])
    # pass 2: a bucket per distinct value inside a bracket, one per gap between brackets
    inside, gap = F.lit(False), F.lit(0)
    for i in n:
        inside = inside | F.col("_v").between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        gap = gap + F.when(F.col("_v") > F.col(f"_hi{i}"), 1).otherwise(0)
    joined = lookup_join(rows, stats, keys, "inner")
    counted = (joined.select(*keys, "_n", "_v", F.when(inside, F.col("_v")).alias("_b"), F.when(~inside, gap).alias("_gap"))
               .groupBy(*keys, "_n", "_b", "_gap").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_first")))
    w = Window.partitionBy(*keys).orderBy("_first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(k: Column) -> Column:
        """The value at rank ``k``, if it lies in a bracket."""
        here = F.col("_b").isNotNull() & (F.col("_start") <= k) & (k < F.col("_end"))
        return F.max(F.when(here, F.col("_b")))
    pos = [(F.col("_n") - 1) * F.lit(p) for p in probs]
    picked = ranked.groupBy(*keys, "_n").agg(*[c for i in n for c in (
        at(F.floor(pos[i])).alias(f"_a{i}"), at(F.ceil(pos[i])).alias(f"_b{i}"))])

    def result(i: int) -> Column:
        a, b, frac = F.col(f"_a{i}"), F.col(f"_b{i}"), pos[i] - F.floor(pos[i])
        # cannot happen within the sketch's rank error bound; should it ever, no guess
        missed = F.raise_error(F.lit("group_quantiles: bracket missed the quantile rank")).cast("double")
        return F.when(a.isNull() | b.isNull(), missed).when(frac == 0, a).otherwise((F.lit(1.0) - frac) * a + frac * b)
    return picked.select(*keys, *[result(names.index(k)).alias(k) for k in quantiles])
