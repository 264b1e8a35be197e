"""Inventory optimisation.

The reference loops over series and scans the whole forecast for each one.
Here the policy is one aggregate over the clean history (grouped by series),
one aggregate over the forecast (grouped by series), a join on the series
key (both sides already hash-partitioned by it) and column arithmetic.

Formulas (unrounded inside, rounded on output):
  mu_L    = sum of the first L forecast values (fallback: min(L, 30) x mean qty)
  sigma_L = max(std(qty), 0.1) x sqrt(L)           (sample std; one row -> NULL)
  SS = z sigma_L,  ROP = mu_L + SS,  H = unit_cost x holding rate
  EOQ = sqrt(2 D K / H) if H > 0 else mu_L
  order = max(0, EOQ, ROP - on_hand) if on_hand < ROP else 0
  alert = on_hand <= ROP                           (NULL comparisons -> false)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandops import SERIES_KEYS
from demandops.functions.numeric import rnd, service_z
from demandops.functions.stats import box_stats

# 95 % service level, 30-day horizon, demand std floor 0.1,
# output column lists.
DEFAULT_SERVICE = 0.95
DEFAULT_HORIZON = 30
MIN_STD = 0.1
LAST_ATTRIBUTES = ("supplier_lead_time_days", "unit_cost", "ordering_cost",
                   "holding_cost_rate", "product_name", "category", "stock_on_hand")
POLICY_COLUMNS = ["store_id", "item_id", "product_name", "category", "unit_cost",
                  "lead_time_days", "annual_demand_est", "z_score", "mu_L", "sigma_L",
                  "safety_stock", "reorder_point", "EOQ", "order_qty", "on_hand",
                  "reorder_alert"]
ALERT_COLUMNS = ["store_id", "item_id", "product_name", "category", "on_hand",
                 "reorder_point", "safety_stock", "order_qty", "urgency"]


def latest_attributes(clean: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """I1 (+ the history statistics of I3-I5) in a single aggregate.

    ``max_by(struct, date)`` takes every 'last value' at once; the aggregate
    combines map-side, so series size never matters."""
    attrs = [c for c in LAST_ATTRIBUTES if c in clean.columns]
    hist = clean.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.max_by(F.struct(*attrs), "date").alias("_last"),
        F.stddev_samp("qty_sold").alias("_std"),
        F.sum("qty_sold").alias("_total_qty"),
        F.avg("qty_sold").alias("_mean_qty"),
        F.min("date").alias("_first_date"),
        F.max("date").alias("_last_date"),
    )
    return hist.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in attrs],
                       "_std", "_total_qty", "_mean_qty", "_first_date", "_last_date")


def lead_time_demand(forecast: DataFrame, leads: DataFrame,
                     keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Per series, sum of the first L forecast values (by forecast date);
    a lead beyond the horizon sums what exists.  ``leads`` has one row per
    series with ``supplier_lead_time_days``.  Each window partition holds
    one series' horizon (bounded by the horizon length)."""
    w = Window.partitionBy(*keys).orderBy("forecast_date")
    fc = forecast.select(*keys, "forecast_date", "predicted_qty") \
                 .withColumn("_h", F.row_number().over(w))
    lead = F.col("supplier_lead_time_days")
    return (fc.join(leads.select(*keys, "supplier_lead_time_days"), list(keys))
              .groupBy(*keys)
              .agg(F.sum(F.when(F.col("_h") <= lead, F.col("predicted_qty")).otherwise(0.0))
                    .alias("_mu_fc"),
                   F.count(F.lit(1)).alias("_n_fc")))


def policy_columns(df: DataFrame, z) -> DataFrame:
    """I6-I10 as column arithmetic over: mu_L, _std, on_hand, lead_time_days,
    annual_demand_est, ordering_cost, unit_cost, holding_cost_rate.
    ``z`` is a float (one service level) or a column (one per row)."""
    std = F.when(F.col("_std") < MIN_STD, F.lit(MIN_STD)).otherwise(F.col("_std"))
    lead = F.col("lead_time_days")
    out = df.withColumns({
        "z_score": z if isinstance(z, Column) else F.lit(float(z)),
        "sigma_L": std * F.sqrt(lead.cast("double")),
    })
    out = out.withColumn("safety_stock", F.col("z_score") * F.col("sigma_L"))
    out = out.withColumn("reorder_point", F.col("mu_L") + F.col("safety_stock"))
    holding = F.col("unit_cost") * F.col("holding_cost_rate")
    out = out.withColumn(
        "EOQ",
        F.when(holding > 0, F.sqrt(F.lit(2.0) * F.col("annual_demand_est") * F.col("ordering_cost")
                                   / holding)).otherwise(F.col("mu_L")))
    rop, on_hand = F.col("reorder_point"), F.col("on_hand")
    return out.withColumns({
        "order_qty": F.when(on_hand < rop,
                            F.greatest(F.lit(0.0), F.col("EOQ"), rop - on_hand)).otherwise(F.lit(0.0)),
        "reorder_alert": F.coalesce(on_hand <= rop, F.lit(False)),
    })


def round_policy(df: DataFrame) -> DataFrame:
    """Output rounding of the reference: z 3 dp, annual demand 1 dp, rest 2 dp."""
    two = ["mu_L", "sigma_L", "safety_stock", "reorder_point", "EOQ", "order_qty", "on_hand"]
    return df.withColumns({
        "z_score": rnd("z_score", 3),
        "annual_demand_est": rnd("annual_demand_est", 1),
        **{c: rnd(c, 2) for c in two},
    })


def policy_base(clean: DataFrame, forecast: DataFrame | None = None,
                horizon: int = DEFAULT_HORIZON, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """One row per series with mu_L, std, on-hand, lead, annual demand."""
    hist = latest_attributes(clean, keys)
    lead = F.col("supplier_lead_time_days")
    fallback = F.least(F.greatest(lead, F.lit(0)), F.lit(horizon)) * F.col("_mean_qty")
    if forecast is not None:
        hist = hist.join(lead_time_demand(forecast, hist, keys), list(keys), "left")
        mu = F.when(F.col("_n_fc") > 0, F.col("_mu_fc")).otherwise(fallback)
    else:
        mu = fallback
    days = F.datediff("_last_date", "_first_date") + 1
    return hist.select(
        *keys, "product_name", "category", "unit_cost",
        lead.cast("int").alias("lead_time_days"),
        (F.col("_total_qty") / days * F.lit(365.0)).alias("annual_demand_est"),
        mu.cast("double").alias("mu_L"),
        "_std",
        F.col("stock_on_hand").cast("double").alias("on_hand"),
        "ordering_cost", "holding_cost_rate",
    )


def inventory_policy(clean: DataFrame, forecast: DataFrame | None = None,
                     service: float = DEFAULT_SERVICE, horizon: int = DEFAULT_HORIZON,
                     keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The full policy table (16 columns), rounded as the reference."""
    base = policy_base(clean, forecast, horizon, keys)
    return round_policy(policy_columns(base, service_z(service))).select(*POLICY_COLUMNS)


def reorder_alerts(policy: DataFrame) -> DataFrame:
    """Alert rows with urgency (CRITICAL when on-hand <= safety stock),
    ascending on-hand (ties by series key)."""
    return (policy.filter(F.col("reorder_alert"))
                  .withColumn("urgency", F.when(F.col("on_hand") <= F.col("safety_stock"), "CRITICAL")
                                          .otherwise("WARNING"))
                  .select(*ALERT_COLUMNS)
                  .orderBy("on_hand", "store_id", "item_id"))


def policy_summary(policy: DataFrame) -> DataFrame:
    """Alerts, combos, alert rate, average SS / ROP / EOQ."""
    n_alert = F.count_if(F.col("reorder_alert"))
    n = F.count(F.lit(1))
    return policy.agg(
        n_alert.alias("n_alerts"),
        n.alias("n_combos"),
        rnd(n_alert * 100.0 / n, 4).alias("alert_rate_pct"),
        rnd(F.avg("safety_stock"), 4).alias("avg_safety_stock"),
        rnd(F.avg("reorder_point"), 4).alias("avg_reorder_point"),
        rnd(F.avg("EOQ"), 4).alias("avg_eoq"),
    )


def top_alerts(policy: DataFrame, n: int = 10) -> DataFrame:
    """The n most urgent alerts (lowest on-hand first)."""
    return reorder_alerts(policy).limit(n)


def ss_rop_by_product(policy: DataFrame) -> DataFrame:
    """Mean SS and ROP per product, by ROP."""
    return (policy.groupBy("product_name")
                  .agg(rnd(F.avg("safety_stock"), 4).alias("safety_stock"),
                       rnd(F.avg("reorder_point"), 4).alias("reorder_point"))
                  .orderBy("reorder_point", "product_name"))


def eoq_by_category(policy: DataFrame) -> DataFrame:
    """I16: EOQ box statistics per category, by median descending."""
    return box_stats(policy, "category", "EOQ").orderBy(F.desc("median"), "category")


def alert_matrix(policy: DataFrame, long: bool = True) -> DataFrame:
    """Product x store alert matrix (first alert by item id as 0/1).

    ``long=True`` returns (product_name, store_id, alert); otherwise the
    stores become columns via ``pivot``."""
    cell = F.min_by(F.col("reorder_alert").cast("double"), F.col("item_id"))
    if long:
        return policy.groupBy("product_name", "store_id").agg(cell.alias("alert"))
    return policy.groupBy("product_name").pivot("store_id").agg(cell)


def onhand_vs_rop(policy: DataFrame) -> DataFrame:
    """I18"""
    return policy.select("store_id", "item_id", "reorder_point", "on_hand", "reorder_alert")


def service_level_sweep(clean: DataFrame, levels: Sequence[float] = (0.80, 0.85, 0.90, 0.95, 0.99),
                        forecast: DataFrame | None = None, horizon: int = DEFAULT_HORIZON,
                        keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The policy at several service levels.  The per-series base is
    computed once; each row is expanded by a literal (level, z) array (no
    join), then the policy arithmetic runs per level."""
    base = policy_base(clean, forecast, horizon, keys)
    table = F.array(*[F.struct(F.lit(float(s)).alias("service_level"),
                               F.lit(service_z(s)).alias("_z")) for s in levels])
    expanded = base.withColumn("_lv", F.explode(table)).select("*", "_lv.*").drop("_lv")
    out = policy_columns(expanded, F.col("_z"))
    return round_policy(out).select("service_level", *POLICY_COLUMNS)
