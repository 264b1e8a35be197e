"""Data quality checks (Q1-Q6).

All counts come from one aggregate over the input; the duplicate count is a
second aggregate (group by key, then sum of surplus rows) embedded as a
scalar subquery, so the report is a single job with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.functions.numeric import rnd

REQUIRED_COLUMNS = ("store_id", "item_id", "date", "qty_sold")
DATE_KEY = ("store_id", "item_id", "date")


def required_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    """Q1: raise if required columns are missing (checked at plan time)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Required columns missing: {missing}")
    return missing


def duplicate_count(df: DataFrame, keys: Sequence[str] = DATE_KEY) -> Column:
    """Q2: rows beyond the first per key, as a scalar column (NULL keys are
    equal to each other, as in pandas)."""
    return (df.groupBy(*keys).count()
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint"))
              .scalar())


def missing_qty(target: str = "qty_sold") -> Column:
    """Q3"""
    return F.count_if(F.col(target).isNull()).cast("bigint")


def negative_qty(target: str = "qty_sold") -> Column:
    """Q4"""
    return F.count_if(F.col(target) < 0).cast("bigint")


def pct_stockout(df: DataFrame, flag: str = "stockout_flag") -> Column:
    """Q5: mean flag x 100 (2 dp); NULL when the column is absent."""
    if flag not in df.columns:
        return F.lit(None).cast("double")
    return rnd(F.avg(flag) * 100.0, 2)


def quality_summary(df: DataFrame, keys: Sequence[str] = DATE_KEY,
                    target: str = "qty_sold") -> DataFrame:
    """Q2-Q5 as one row, in a single pass over the input: per-key partial
    counts (combined map-side), then one roll-up of those counts."""
    required_columns(df)
    has_flag = "stockout_flag" in df.columns
    t = F.col(target)
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(t.isNull()).alias("_missing"),
        F.count_if(t < 0).alias("_negative"),
        *([F.sum("stockout_flag").alias("_so_sum"), F.count("stockout_flag").alias("_so_n")]
          if has_flag else []))
    pct = (rnd(F.sum("_so_sum") / F.sum("_so_n") * 100.0, 2) if has_flag
           else F.lit(None).cast("double"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum("_missing"), F.lit(0)).cast("bigint").alias("missing_qty"),
        F.coalesce(F.sum("_negative"), F.lit(0)).cast("bigint").alias("negative_qty"),
        pct.alias("pct_stockout"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def quality_report(df: DataFrame, keys: Sequence[str] = DATE_KEY,
                   target: str = "qty_sold") -> DataFrame:
    """Q6: (check, value, status) rows; status is 'warn' for a non-zero
    count, 'pass' otherwise (total_rows and pct_stockout are informative)."""
    wanted = [*dict.fromkeys([*REQUIRED_COLUMNS, *keys, target])]
    missing = [c for c in wanted if c not in df.columns]
    # a missing column is reported, and counted as all NULL in the other checks;
    # the cleaning step is what raises (``required_columns``)
    whole = df.withColumns({c: F.lit(None).cast("bigint" if c == target else "string") for c in missing})
    s = quality_summary(whole, keys, target).withColumn("missing_columns", F.lit(len(missing)))
    checks = ["total_rows", "missing_columns", "duplicate_rows", "missing_qty",
              "negative_qty", "pct_stockout"]
    stacked = s.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("check"),
                 F.col(c).cast("double").alias("value")) for i, c in enumerate(checks)
    ])).alias("r")).select("r.*")
    informative = F.col("check").isin("total_rows", "pct_stockout")
    return stacked.withColumn(
        "status",
        F.when(informative | (F.coalesce(F.col("value"), F.lit(0.0)) == 0), "pass").otherwise("warn"))
