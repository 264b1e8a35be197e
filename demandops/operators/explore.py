"""Exploratory aggregates (E1-E11): the dataset behind each chart.

Each is a hash aggregate with partial (map-side) aggregation.  The only
un-partitioned steps run after aggregating to one row per date or per
category, i.e. over results bounded by the calendar or the dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.functions.numeric import exact_sum, rnd
from demandops.functions.stats import box_stats
from demandops.functions.windows import trailing_strict_mean

# Weekday names (Monday = 0, Spark ``weekday``) and the numeric
# columns of the correlation matrix.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
CORR_COLUMNS = ["qty_sold", "price", "discount_pct", "on_promo", "holiday_flag",
                "festival_flag", "stock_on_hand"]


def with_revenue(df: DataFrame) -> DataFrame:
    """K1: revenue = qty x price."""
    return df.withColumn("revenue", F.col("qty_sold") * F.col("price"))


def daily_sales_trend(df: DataFrame, window: int = 7) -> DataFrame:
    """Units per date and the strict trailing 7-row mean."""
    daily = df.groupBy("date").agg(F.sum("qty_sold").alias("qty_sold"))
    return daily.withColumn("ma_7", trailing_strict_mean("qty_sold", window))


def category_units(df: DataFrame) -> DataFrame:
    """Units per category, ascending."""
    return (df.groupBy("category").agg(F.sum("qty_sold").alias("qty_sold"))
              .orderBy("qty_sold", "category"))


def store_monthly_units(df: DataFrame) -> DataFrame:
    """Units per store and month start."""
    return (df.groupBy("store_id", F.trunc("date", "month").alias("month"))
              .agg(F.sum("qty_sold").alias("qty_sold")))


def dow_average(df: DataFrame) -> DataFrame:
    """Mean units per weekday, Monday..Sunday; a weekday without rows is
    kept with a NULL mean (left join from the 7-row weekday table)."""
    spark = df.sparkSession
    days = spark.createDataFrame(list(enumerate(DAY_NAMES)), "dow int, day_name string")
    means = df.groupBy(F.weekday("date").alias("dow")).agg(F.avg("qty_sold").alias("avg_qty"))
    return (days.join(means, "dow", "left")
            .select("dow", "day_name", "avg_qty").orderBy("dow"))


def promo_lift_by_category(df: DataFrame) -> DataFrame:
    """E5: mean units off / on promotion per category and lift % (on/off - 1)."""
    q = F.col("qty_sold")
    out = df.groupBy("category").agg(
        F.avg(F.when(F.col("on_promo") == 0, q)).alias("no_promo"),
        F.avg(F.when(F.col("on_promo") == 1, q)).alias("on_promo"))
    return out.withColumn("lift_pct", (F.try_divide("on_promo", "no_promo") - 1.0) * 100.0)


def top_skus_by_revenue(df: DataFrame, n: int = 10) -> DataFrame:
    """The n items with the highest revenue (ties by item id)."""
    return (with_revenue(df).groupBy("item_id", "product_name")
              .agg(exact_sum("revenue").alias("revenue"))
              .orderBy(F.desc("revenue"), "item_id").limit(n))


def zero_demand_share(df: DataFrame, threshold_pct: float = 20.0) -> DataFrame:
    """% of zero-demand rows per item, descending, flagged above 20 %."""
    out = df.groupBy("item_id", "product_name").agg(
        (F.avg((F.col("qty_sold") == 0).cast("double")) * 100.0).alias("pct_zero"))
    return (out.withColumn("intermittent", F.col("pct_zero") > threshold_pct)
               .orderBy(F.desc("pct_zero"), "item_id"))


def correlation_matrix(df: DataFrame, cols=CORR_COLUMNS) -> DataFrame:
    """Pearson correlation of every pair (lower triangle, long form);
    NULLs are skipped pair-wise, a column without variation gives NULL.

    One aggregate of sums and products (7 + 28 for seven columns, and the
    least and largest values, so that it stays within whole-stage codegen's
    field limit), per pattern of NULLs: a pair's moments are those of the
    patterns that have both columns, at most 2^columns rows in all."""
    present = [c for c in cols if c in df.columns]
    n = range(len(present))
    value = [F.col(c).cast("double") for c in present]
    mask = sum((F.when(v.isNull(), F.lit(1 << i)).otherwise(0) for i, v in enumerate(value)), F.lit(0))
    zero = df.select(mask.alias("_mask"), *[F.coalesce(v, F.lit(0.0)).alias(f"x{i}") for i, v in enumerate(value)])
    moments = zero.groupBy("_mask").agg(
        F.count("*").alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in n],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{j}_{i}") for i in n for j in n if j <= i],
        *[f(f"x{i}").alias(f"{name}{i}") for i in n for name, f in (("lo", F.min), ("hi", F.max))])

    def pair(a: int, b: int) -> Column:
        """The moments of columns a and b where both are there."""
        c = {"n": "n", "sa": f"s{a}", "sb": f"s{b}", "aa": f"p{a}_{a}", "bb": f"p{b}_{b}", "ab": f"p{b}_{a}",
             "la": f"lo{a}", "ha": f"hi{a}", "lb": f"lo{b}", "hb": f"hi{b}"}
        both = F.col("_mask").bitwiseAND(F.lit(1 << a | 1 << b)) == 0
        return F.struct(F.lit(present[a]).alias("var_a"), F.lit(present[b]).alias("var_b"),
                        *[F.when(both, F.col(v)).alias(k) for k, v in c.items()])
    long = moments.select(F.inline(F.array(*[pair(a, b) for a in n for b in range(a)])))
    s = {k: F.sum(k) for k in ("n", "sa", "sb", "aa", "bb", "ab")}
    s["n"] = s["n"].cast("double")
    spread = (s["n"] * s["aa"] - s["sa"] * s["sa"]) * (s["n"] * s["bb"] - s["sb"] * s["sb"])
    varies = (F.min("la") < F.max("ha")) & (F.min("lb") < F.max("hb"))
    return long.groupBy("var_a", "var_b").agg(
        F.when(varies, F.try_divide(s["n"] * s["ab"] - s["sa"] * s["sb"], F.sqrt(spread))).alias("corr"))


def revenue_heatmap(df: DataFrame, long: bool = False) -> DataFrame:
    """Revenue per category x month in thousands, missing cells 0.

    Wide (one column per month, via ``pivot``) or long form, which has every
    category in every month of the data (months are bounded by the calendar)."""
    rev = with_revenue(df).withColumn("month", F.date_format("date", "yyyy-MM"))
    if long:
        cells = (rev.groupBy("category", "month")
                    .agg((exact_sum("revenue") / 1000.0).alias("revenue_k")))
        months = cells.agg(F.collect_set("month")).scalar()
        every = cells.select("category").distinct().select("category", F.explode(months).alias("month"))
        same = every["category"].eqNullSafe(cells["category"]) & (every["month"] == cells["month"])
        return every.join(cells, same, "left").select(
            every["category"], every["month"], F.coalesce("revenue_k", F.lit(0.0)).alias("revenue_k"))
    wide = rev.groupBy("category").pivot("month").agg(exact_sum("revenue") / 1000.0)
    return wide.fillna(0.0)


def qty_distribution(df: DataFrame) -> DataFrame:
    """Box statistics of daily units per category, by median desc."""
    return box_stats(df, "category", "qty_sold").orderBy(F.desc("median"), "category")


def eda_summary(df: DataFrame) -> DataFrame:
    """One-row summary of the clean table."""
    return with_revenue(df).agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        F.countDistinct("store_id").alias("n_stores"),
        F.countDistinct("item_id").alias("n_items"),
        F.countDistinct("category").alias("n_categories"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("qty_sold").alias("total_units"),
        rnd(exact_sum("revenue") / 1e6, 2).alias("revenue_m"),
        rnd(F.avg("on_promo") * 100.0, 4).alias("promo_pct"),
        rnd(F.avg((F.col("qty_sold") == 0).cast("double")) * 100.0, 4).alias("zero_pct"),
    )
