"""Business insights, reports and dashboard queries.

KPIs are computed as one-row aggregates and stacked into a long
(metric, value, label) table: numeric value plus a separate text label
instead of the reference's mixed-type column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.functions.numeric import exact_sum, rnd
from demandops.functions.stats import box_stats
from demandops.functions.windows import trailing_strict_mean
from demandops.operators.explore import with_revenue  # noqa: F401  (K1)
from demandops.operators.inventory import reorder_alerts


def total_revenue_units(df: DataFrame) -> DataFrame:
    """K2: revenue in millions (2 dp) and total units."""
    return with_revenue(df).agg(rnd(exact_sum("revenue") / 1e6, 2).alias("revenue_m"),
                                F.sum("qty_sold").alias("total_units"))


def avg_daily_units(df: DataFrame) -> DataFrame:
    """K3: mean of the per-date unit totals (0 dp)."""
    daily = df.groupBy("date").agg(F.sum("qty_sold").alias("units"))
    return daily.agg(rnd(F.avg("units"), 0).alias("avg_daily_units"))


def top_category(df: DataFrame) -> DataFrame:
    """K4: category with the highest revenue; ties go to the first name."""
    return (with_revenue(df).groupBy("category").agg(exact_sum("revenue").alias("revenue"))
              .orderBy(F.desc("revenue"), "category").limit(1))


def promo_lift_value(qty: str = "qty_sold", promo: str = "on_promo") -> Column:
    """K5 as an aggregate expression:
    (mean on promo, default 0) / max(mean off promo, default 1, at least 1) - 1, in %."""
    on = F.coalesce(F.avg(F.when(F.col(promo) == 1, F.col(qty))), F.lit(0.0))
    off = F.coalesce(F.avg(F.when(F.col(promo) == 0, F.col(qty))), F.lit(1.0))
    return (on / F.greatest(off, F.lit(1.0)) - 1.0) * 100.0


def promo_lift_overall(df: DataFrame) -> DataFrame:
    """K5"""
    return df.agg(rnd(promo_lift_value(), 4).alias("promo_lift_pct"))


def alert_rate(policy: DataFrame) -> DataFrame:
    """K6: alerts, combos, alerts / combos in %."""
    n_alert = F.count_if(F.col("reorder_alert"))
    return policy.agg(n_alert.alias("n_alerts"), F.count(F.lit(1)).alias("n_combos"),
                      rnd(n_alert * 100.0 / F.count(F.lit(1)), 1).alias("alert_rate_pct"))


def forecast_total(forecast: DataFrame) -> DataFrame:
    """K7: total forecast units over the horizon, truncated to an integer."""
    return forecast.agg(exact_sum("predicted_qty").cast("bigint").alias("forecast_total"))


def kpi_table(clean: DataFrame, policy: DataFrame, forecast: DataFrame) -> DataFrame:
    """K8: the 12 KPIs as (ordinal, metric, value, label) rows.

    Each input is reduced to one row by its own aggregate; the three rows
    are combined through scalar subqueries (no join)."""
    rev = with_revenue(clean)
    # One scalar subquery per input: each aggregate runs once, its fields
    # are read from the returned struct.
    c = rev.agg(F.struct(
        rnd(exact_sum("revenue") / 1e6, 2).alias("revenue_m"),
        F.sum("qty_sold").cast("double").alias("units"),
        rnd(promo_lift_value(), 1).alias("promo_lift"),
    )).scalar()
    daily = clean.groupBy("date").agg(F.sum("qty_sold").alias("u")).agg(rnd(F.avg("u"), 0)).scalar()
    top = (rev.groupBy("category").agg(exact_sum("revenue").alias("r"))
              .orderBy(F.desc("r"), "category").limit(1).select("category").scalar())
    p = policy.agg(F.struct(
        F.count(F.lit(1)).cast("double").alias("combos"),
        F.count_if(F.col("reorder_alert")).cast("double").alias("alerts"),
        rnd(F.avg("safety_stock"), 1).alias("avg_ss"),
        rnd(F.avg("reorder_point"), 1).alias("avg_rop"),
        rnd(F.avg("EOQ"), 1).alias("avg_eoq"),
    )).scalar()
    combos, alerts = p.getField("combos"), p.getField("alerts")
    fc = forecast.agg(F.floor(exact_sum("predicted_qty")).cast("double")).scalar()
    rows = [
        ("Total Revenue (M)", c.getField("revenue_m"), None),
        ("Total Units Sold", c.getField("units"), None),
        ("Avg Daily Units Sold", daily, None),
        ("Top Revenue Category", F.lit(None).cast("double"), top),
        ("Promo Lift (%)", c.getField("promo_lift"), None),
        ("SKU-Store Combos", combos, None),
        ("Reorder Alerts", alerts, None),
        ("Alert Rate (%)", rnd(alerts * 100.0 / combos, 1), None),
        ("Avg Safety Stock (units)", p.getField("avg_ss"), None),
        ("Avg Reorder Point", p.getField("avg_rop"), None),
        ("Avg EOQ (units)", p.getField("avg_eoq"), None),
        ("30-Day Forecast Total", fc, None),
    ]
    spark = clean.sparkSession
    structs = [F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("metric"),
                        v.cast("double").alias("value"),
                        (lbl if lbl is not None else F.lit(None).cast("string")).alias("label"))
               for i, (m, v, lbl) in enumerate(rows)]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("k")).select("k.*")


def daily_revenue_trend(df: DataFrame, window: int = 7) -> DataFrame:
    """K9: revenue per date and its strict trailing 7-row mean."""
    daily = with_revenue(df).groupBy("date").agg(exact_sum("revenue").alias("revenue"))
    return daily.withColumn("ma_7", trailing_strict_mean("revenue", window, exact_scale=6))


def category_revenue_share(df: DataFrame) -> DataFrame:
    """Revenue per category (desc) and its share of the total in %.
    The total is a window over the per-category result (one row each)."""
    from pyspark.sql import Window
    cat = with_revenue(df).groupBy("category").agg(exact_sum("revenue").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    return (cat.withColumn("share_pct", F.col("revenue") * 100.0 / total)
               .orderBy(F.desc("revenue"), "category"))


def promo_distribution(df: DataFrame) -> DataFrame:
    """Box statistics of daily units, on promotion vs not."""
    labelled = df.withColumn("promotion", F.when(F.col("on_promo") == 1, "On Promo")
                                           .when(F.col("on_promo") == 0, "No Promo"))
    return box_stats(labelled, "promotion", "qty_sold")


def recent_actuals(df: DataFrame, n: int = 30) -> DataFrame:
    """Total units of the last n dates."""
    return (df.groupBy("date").agg(F.sum("qty_sold").alias("qty_sold"))
              .orderBy(F.desc("date")).limit(n))


def report_policy_table(policy: DataFrame, n: int = 30) -> DataFrame:
    """K13 (a): first n policy rows by series key, numbers to 1 dp."""
    cols = ["safety_stock", "reorder_point", "EOQ", "order_qty"]
    return (policy.orderBy("store_id", "item_id").limit(n)
                  .select("store_id", "item_id", "product_name", "category",
                          *[rnd(c, 1).alias(c) for c in cols], "reorder_alert"))


def report_alert_table(policy: DataFrame, n: int = 20) -> DataFrame:
    """K13 (b): first n alert rows in policy order, numbers to 1 dp."""
    cols = ["on_hand", "reorder_point", "safety_stock", "order_qty"]
    return (policy.filter(F.col("reorder_alert")).orderBy("store_id", "item_id").limit(n)
                  .select("store_id", "item_id", "product_name", "category",
                          *[rnd(c, 1).alias(c) for c in cols]))


# ------------------------------------------------------------ dashboard --
def filter_slice(df: DataFrame, store: str | None = None, category: str | None = None,
                 item: str | None = None) -> DataFrame:
    """A1: optional equality filters (pushed into the scan by Catalyst)."""
    for col, val in (("store_id", store), ("category", category), ("item_id", item)):
        if val is not None:
            df = df.filter(F.col(col) == val)
    return df


def filter_options(df: DataFrame) -> DataFrame:
    """A2: sorted distinct stores, items and categories as (kind, value)."""
    kinds = (("store", "store_id"), ("item", "item_id"), ("category", "category"))
    # distinct combinations first (combined map-side), then three rows of each: one scan
    options = df.select([c for _, c in kinds]).distinct().select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds])))
    return options.dropna().distinct().orderBy("kind", "value")


def slice_kpis(df: DataFrame, policy: DataFrame, store: str | None = None,
               category: str | None = None) -> DataFrame:
    """A3: revenue, units, distinct SKUs and promo lift over a slice; the
    alert count stays global (as on the dashboard)."""
    s = with_revenue(filter_slice(df, store, category))
    alerts = policy.agg(F.count_if(F.col("reorder_alert"))).scalar()
    return s.agg(
        rnd(exact_sum("revenue") / 1e6, 2).alias("revenue_m"),
        F.sum("qty_sold").alias("total_units"),
        F.countDistinct("item_id").alias("n_skus"),
        rnd(promo_lift_value(), 4).alias("promo_lift_pct"),
    ).withColumn("n_alerts", alerts)


def series_history_forecast(clean: DataFrame, forecast: DataFrame, item: str,
                            store: str | None = None, n_history: int = 90) -> DataFrame:
    """A4: last n_history rows of one series plus its forecast, labelled.
    Without ``store`` the first store (alphabetically) is used, as the
    dashboard does."""
    from pyspark.sql import Window
    if store is None:
        store_col = clean.agg(F.min("store_id")).scalar()
    else:
        store_col = F.lit(store)
    hist = clean.filter((F.col("item_id") == item) & (F.col("store_id") == store_col))
    w = Window.partitionBy("store_id", "item_id").orderBy(F.desc("date"))
    hist = (hist.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n_history)
                .select("store_id", "item_id", "date", F.col("qty_sold").cast("double").alias("qty"),
                        F.lit("history").alias("kind")))
    fc = (forecast.filter((F.col("item_id") == item) & (F.col("store_id") == store_col))
                  .select("store_id", "item_id", F.col("forecast_date").alias("date"),
                          F.col("predicted_qty").alias("qty"), F.lit("forecast").alias("kind")))
    return hist.unionByName(fc)


def alert_counts(policy: DataFrame) -> DataFrame:
    """A5: total / critical / warning alerts."""
    a = reorder_alerts(policy)
    return a.agg(F.count(F.lit(1)).alias("n_alerts"),
                 F.count_if(F.col("urgency") == "CRITICAL").alias("n_critical"),
                 F.count_if(F.col("urgency") == "WARNING").alias("n_warning"))


def policy_by_product(policy: DataFrame, store: str | None = None,
                      category: str | None = None) -> DataFrame:
    """Mean safety stock and mean EOQ per product (ascending)."""
    p = filter_slice(policy, store, category)
    return (p.groupBy("product_name")
             .agg(rnd(F.avg("safety_stock"), 4).alias("safety_stock"),
                  rnd(F.avg("EOQ"), 4).alias("EOQ"))
             .orderBy("safety_stock", "product_name"))


def preview(df: DataFrame, n: int = 100, keys: Sequence[str] = ("store_id", "item_id", "date")) -> DataFrame:
    """First n rows of a slice in series order."""
    return df.orderBy(*keys).limit(n)
