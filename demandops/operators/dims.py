"""Dimension building and enrichment.

Lookup tables here are parameters (a product list, a category->lead map, a
holiday list, festival windows): their size is fixed by the caller, not by
the data, so broadcasting them is always safe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandops import SERIES_KEYS
from demandops.functions.numeric import hex_hash, rnd


def series_scaffold(df: DataFrame, keys: Sequence[str] = SERIES_KEYS,
                    start=None, end=None) -> DataFrame:
    """Every series x every day of [start, end] (default: the global
    date range of ``df``).  One output row per (series, day); each series
    row is exploded in place, no cross join."""
    bounds = df.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo = F.lit(start).cast("date") if start is not None else bounds.getField("lo")
    hi = F.lit(end).cast("date") if end is not None else bounds.getField("hi")
    series = df.select(*keys).dropna().distinct()
    return series.select(*keys, F.explode(F.sequence(lo, hi)).alias("date"))


SERIES_ATTRIBUTES = ("product_name", "category", "unit_cost", "pack_size", "shelf_life_days",
                     "supplier_lead_time_days", "ordering_cost", "holding_cost_rate")


def densify(clean: DataFrame, keys: Sequence[str] = SERIES_KEYS,
            holiday_month_days: Sequence[str] | None = None,
            festival_windows: Sequence[tuple[str, str]] | None = None,
            start=None, end=None) -> DataFrame:
    """``dense=True``: the D1 scaffold with the observed rows joined in and
    the gaps filled - zero demand, no promotion / discount / stock-out,
    price and stock carried forward within the series (backward for
    leading gaps), series attributes from the series' last row, calendar
    flags recomputed from the date when their rules are given (else taken
    from any observed row of that date).  Row lags and rolling windows on
    the result are calendar lags, and zero shares become meaningful."""
    from pyspark.sql import Window
    sc = series_scaffold(clean, keys, start, end)
    attrs = [c for c in SERIES_ATTRIBUTES if c in clean.columns]
    last = (clean.groupBy(*keys).agg(F.max_by(F.struct(*attrs), "date").alias("_a"))
                 .select(*keys, *[F.col(f"_a.{c}").alias(c) for c in attrs]))
    observed = clean.drop(*attrs, *[c for c in ("week_start",) if c in clean.columns])
    out = sc.join(observed, [*keys, "date"], "left").join(last, list(keys), "left")
    # Both fills are running frames (incremental, O(days) per series); a
    # frame ending at UNBOUNDED FOLLOWING would be re-evaluated per row.
    back = Window.partitionBy(*keys).orderBy("date") \
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*keys).orderBy(F.col("date").desc()) \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def carry(c):
        return F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(back),
                          F.last(c, ignorenulls=True).over(ahead))

    fills = {"qty_sold": F.coalesce(F.col("qty_sold"), F.lit(0).cast("bigint"))}
    for c, zero in (("on_promo", F.lit(0)), ("discount_pct", F.lit(0.0)), ("stockout_flag", F.lit(0))):
        if c in clean.columns:
            fills[c] = F.coalesce(F.col(c), zero)
    for c in ("price", "stock_on_hand"):
        if c in clean.columns:
            fills[c] = carry(c)
    out = out.withColumns(fills)
    for flag, rule in (("holiday_flag", holiday_month_days), ("festival_flag", festival_windows)):
        if flag not in clean.columns:
            continue
        if rule is not None:
            out = (holiday_flag(out.drop(flag), rule) if flag == "holiday_flag"
                   else festival_flag(out.drop(flag), rule))
        else:
            by_date = clean.groupBy("date").agg(F.max(flag).alias("_d"))
            out = (out.join(by_date, "date", "left")
                      .withColumn(flag, F.coalesce(F.col(flag), F.col("_d"), F.lit(0))).drop("_d"))
    cols = [c for c in clean.columns if c != "week_start"]
    out = out.select(*cols)
    if "week_start" in clean.columns:
        out = out.withColumn("week_start", F.date_sub(F.col("date"), F.weekday("date")))
    return out


def product_enrich(df: DataFrame, products: DataFrame, key: str = "item_id") -> DataFrame:
    """Attach product attributes (left join to a broadcast parameter table)."""
    return df.join(F.broadcast(products), key, "left")


def lead_time_lookup(df: DataFrame, lead_by_category: Mapping[str, int],
                     default: int = 7, out: str = "supplier_lead_time_days") -> DataFrame:
    """D3: category -> supplier lead days, unknown categories get ``default``."""
    spark = df.sparkSession
    table = spark.createDataFrame(list(lead_by_category.items()), "category string, _lead int")
    return (df.drop(out).join(F.broadcast(table), "category", "left")
              .withColumn(out, F.coalesce(F.col("_lead"), F.lit(default)).cast("int"))
              .drop("_lead"))


def holiday_flag(df: DataFrame, month_days: Sequence[str] = (), dates: Sequence[str] = (),
                 out: str = "holiday_flag") -> DataFrame:
    """1 when the date is a listed day (``MM-dd`` every year, or full dates)."""
    cond = F.lit(False)
    if month_days:
        cond = cond | F.date_format("date", "MM-dd").isin(list(month_days))
    if dates:
        cond = cond | F.col("date").isin([F.lit(d).cast("date") for d in dates])
    return df.withColumn(out, F.when(cond, 1).otherwise(0).cast("int"))


def festival_flag(df: DataFrame, windows: Sequence[tuple[str, str]],
                  out: str = "festival_flag") -> DataFrame:
    """1 when the date falls in any closed window [start, end].

    A window of month-days (``MM-dd``) comes back every year and is matched on
    the date itself; one that starts after it ends goes across New Year.
    Windows of full dates are expanded to their distinct days (bounded by the
    window list) and joined on date equality. So overlapping windows can never
    duplicate a row, and no range / nested-loop join is needed."""
    month_day, hit = F.date_format("date", "MM-dd"), F.lit(False)
    for start, end in windows:
        if len(start) == 5:
            inside = [month_day >= start, month_day <= end]
            hit = hit | ((inside[0] & inside[1]) if start <= end else (inside[0] | inside[1]))
    dated = [w for w in windows if len(w[0]) != 5]
    if dated:
        days = (df.sparkSession.createDataFrame(dated, "ws string, we string")
                .select(F.explode(F.sequence(F.col("ws").cast("date"), F.col("we").cast("date")))
                        .alias("_fday"))
                .distinct())
        df = df.join(F.broadcast(days), F.col("date") == F.col("_fday"), "left")
        hit = hit | F.col("_fday").isNotNull()
    return df.withColumn(out, F.when(hit, 1).otherwise(0).cast("int")).drop("_fday")


def promo_hash_sample(df: DataFrame, pct: int = 15, out: str = "on_promo") -> DataFrame:
    """Deterministic ~pct % assignment from a hash of (date, item, store)."""
    h = F.pmod(hex_hash("date", "item_id", "store_id"), F.lit(100))
    return df.withColumn(out, F.when(h < pct, 1).otherwise(0).cast("int"))


def discounted_price(base, discount, digits: int = 2):
    """round(base x (1 - discount), 2) as a column expression."""
    b = F.col(base) if isinstance(base, str) else base
    d = F.col(discount) if isinstance(discount, str) else discount
    return rnd(b * (F.lit(1.0) - d), digits)
