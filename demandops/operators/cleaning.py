"""Cleaning (C1-C11).

Order matters and follows the reference: keep-first de-duplication, drop
missing target, clip negatives, censor stock-outs, fill flags, impute price
by item median (computed after the previous steps), Monday week start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StructType, TimestampNTZType, TimestampType

from demandops.functions.numeric import exact_mean
from demandops.functions.joins import lookup_join
from demandops.functions.stats import group_median
from demandops.operators.quality import DATE_KEY
from demandops.sources.io import materialize
from demandops.sources.tables import fits_broadcast

FLAG_COLUMNS = ("on_promo", "discount_pct", "holiday_flag", "festival_flag")


def prune_later_rows(df: DataFrame, keys: Sequence[str] = DATE_KEY, order: str = "ingest_order") -> DataFrame:
    """Rows of ``df`` that can be the first of their key: all that share the
    least leading part of the order (its first field if it is a struct).

    The least part of every key is a hash aggregate over the keys and one
    column, combined map-side; the rows then meet it in a broadcast
    semi-join, so no later row is sorted or shuffled.  Where the keys are too
    many for a broadcast (measured), or the leading part is no number or
    date, ``df`` comes back as it is.  The keys' job runs while the plan is
    built."""
    kind = df.schema[order].dataType
    nested = isinstance(kind, StructType)
    lead = F.col(order)[kind.names[0]] if nested else F.col(order)
    if not isinstance(kind[0].dataType if nested else kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return df
    # a struct whose first field is NULL comes before all others
    before = (F.col(order).isNotNull() & lead.isNull()) if nested else F.lit(False)
    least = F.when(~F.max("_before"), F.min("_lead"))
    firsts = materialize(df.select(*keys, lead.alias("_lead"), before.alias("_before"))
                         .groupBy(*keys).agg(least.alias("_lead")), "first_keys")
    if not fits_broadcast(firsts):
        return df
    firsts = firsts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_lead")
    same = lead.eqNullSafe(F.col("_lead"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(F.broadcast(firsts), same, "left_semi")


def dedup_keep_first(df: DataFrame, keys: Sequence[str] = DATE_KEY,
                     order: str = "ingest_order") -> DataFrame:
    """Keep the first row per key in ingest order.

    Rows that cannot be first are pruned by ``prune_later_rows``; among the
    few left the whole order decides.  That is an aggregate (``min_by`` over
    the ingest order) rather than a ``row_number`` window: it combines
    map-side, so a key that holds a large share of the rows never lands whole
    in one task, pruned or not.  A table without the order column has no first row: that raises (``load_sales``
    adds the column on request), as ordering by the values would keep the
    smallest, worst rows.  Rows of keys alone are all equal."""
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.dropDuplicates(list(keys))
    if order not in df.columns:
        raise ValueError(f"keep-first needs the ingest order column {order!r}")
    kept = (prune_later_rows(df, keys, order).groupBy(*keys)
            .agg(F.min_by(F.struct(*payload), F.col(order)).alias("_row")))
    return kept.select(*[F.col(c) for c in df.columns if c in keys],
                       *[F.col(f"_row.{c}").alias(c) for c in payload]).select(*df.columns)


def drop_missing_target(df: DataFrame, target: str = "qty_sold") -> DataFrame:
    """C2"""
    return df.dropna(subset=[target])


def clip_negative(df: DataFrame, target: str = "qty_sold") -> DataFrame:
    """Negative -> 0 (NULL stays NULL, unlike ``greatest``)."""
    t = F.col(target)
    return df.withColumn(target, F.when(t < 0, F.lit(0).cast(df.schema[target].dataType)).otherwise(t))


def censor_stockouts(df: DataFrame, flag: str = "stockout_flag") -> DataFrame:
    """C4: keep flag == 0 only (demand is unknown when out of stock; an
    unknown flag is dropped too)."""
    return df.filter(F.col(flag) == 0) if flag in df.columns else df


def fill_flags(df: DataFrame, cols: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """C5"""
    present = [c for c in cols if c in df.columns]
    return df.fillna(0, subset=present) if present else df


def impute_price_median(df: DataFrame, by: str = "item_id", price: str = "price",
                        method: str = "bracket") -> DataFrame:
    """NULL price -> median price of the item (all stores pooled).

    The median is exact and interpolated (as pandas).  The default
    ``bracket`` method keeps memory bounded for a hot item with many
    distinct prices (see ``functions.stats.group_median``); ``exact`` is a
    single ``percentile`` aggregate, ``approx`` uses ``percentile_approx``.
    The per-item table has one row per item; Spark/AQE picks the join
    strategy behind a size check (``functions.joins.lookup_join``)."""
    if price not in df.columns:
        return df
    # Only items with a missing price need their median: restrict the median
    # input to those items (a semi-join on a small distinct).  When no price
    # is missing, AQE sees the empty side and prunes the median entirely.
    needing = df.where(F.col(price).isNull()).select(by).distinct()
    medians = group_median(df.join(needing, by, "left_semi"), by, price, method,
                           out="_median_price")
    return (lookup_join(df, medians, [by], "left")
              .withColumn(price, F.coalesce(F.col(price), F.col("_median_price")))
              .drop("_median_price").select(*df.columns))


def sort_panel(df: DataFrame, keys: Sequence[str] = DATE_KEY, global_order: bool = True) -> DataFrame:
    """Only at a sink.  Global order (range partitioned) or clustered by
    series and sorted within partitions."""
    if global_order:
        return df.orderBy(*keys)
    return df.repartition(*keys[:-1]).sortWithinPartitions(*keys)


def week_start(df: DataFrame, out: str = "week_start") -> DataFrame:
    """Monday of the week (Spark ``weekday``: Monday = 0)."""
    return df.withColumn(out, F.date_sub(F.col("date"), F.weekday("date")))


def clean_sales(df: DataFrame, keys: Sequence[str] = DATE_KEY, target: str = "qty_sold",
                with_week_start: bool = True, unique_keys: bool = False) -> DataFrame:
    """C1 -> C6 in the reference's order (lazy; C7 is left to the sink).

    The reference's clean table also carries ``week_start`` (added while
    building the weekly table), so it is appended here by default.
    ``unique_keys=True`` skips keep-first de-duplication for inputs whose
    keys are unique by construction (it would be the identity)."""
    out = df if unique_keys else dedup_keep_first(df, keys)
    if "ingest_order" in out.columns:
        out = out.drop("ingest_order")
    out = drop_missing_target(out, target)
    out = clip_negative(out, target)
    out = censor_stockouts(out)
    out = fill_flags(out)
    out = impute_price_median(out)
    return week_start(out) if with_week_start else out


def clean_audit(df: DataFrame, keys: Sequence[str] = DATE_KEY, target: str = "qty_sold",
                flag: str = "stockout_flag") -> DataFrame:
    """Rows before / after de-duplication / removed as stock-out / after /
    removed in total.  Keep-first runs on the columns that decide, all rows
    are counted by a scan without columns, and one roll-up sums everything."""
    payload = [c for c in df.columns if c not in keys]
    order = F.col("ingest_order") if "ingest_order" in df.columns else F.struct(*payload)
    named = [c for c in (target, flag) if c in df.columns]
    kept = dedup_keep_first(df.select(*keys, *named, order.alias("ingest_order")), keys)
    in_stock = (F.col(flag) == 0) if flag in df.columns else F.lit(True)
    has_target = F.col(target).isNotNull()
    return kept.agg(
        F.count(F.lit(1)).alias("rows_after_dedup"),
        F.count_if(has_target).alias("_after_missing"),
        F.count_if(has_target & in_stock).alias("rows_after"),
    ).withColumn("rows_before", df.agg(F.count(F.lit(1))).scalar()).select(
        "rows_before", "rows_after_dedup",
        (F.col("_after_missing") - F.col("rows_after")).alias("removed_stockout"),
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("removed_total"),
    )


def weekly_rollup(df: DataFrame) -> DataFrame:
    """C11: weekly aggregate per (store, item, category, product, week).

    Sums/means/maxes as in the reference; 'first' attributes are the first
    non-NULL value in date order (``min_by`` with NULLs excluded from the
    ordering).  Only aggregates whose input column exists; NULL group keys
    are dropped (pandas default)."""
    if "week_start" not in df.columns:
        df = week_start(df)
    group = ["store_id", "item_id", "category", "product_name", "week_start"]
    plan = [("qty_sold", "sum"), ("price", "mean"), ("on_promo", "max"),
            ("discount_pct", "mean"), ("holiday_flag", "max"), ("festival_flag", "max"),
            ("unit_cost", "first"), ("supplier_lead_time_days", "first"),
            ("ordering_cost", "first"), ("holding_cost_rate", "first")]
    aggs = []
    for col, how in plan:
        if col not in df.columns:
            continue
        c = F.col(col)
        if how == "sum":
            a = F.sum(c)
        elif how == "mean":
            a = exact_mean(c)
        elif how == "max":
            a = F.max(c)
        else:
            a = F.min_by(c, F.when(c.isNotNull(), F.col("date")))
        aggs.append(a.alias(col))
    return (df.dropna(subset=group).groupBy(*group).agg(*aggs)
              .withColumnRenamed("week_start", "date"))
