"""Queries: inventory policy and its reports (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandops.functions.numeric import rnd, service_z
from demandops.operators import inventory as I
from demandops.plans.catalog import clean, query
from demandops.plans.oracle import box_sql, cte, oracle, policy_sql, r


@query("I11_inventory_policy")
def i11(spark, sf):
    return I.inventory_policy(clean(spark, sf))


oracle("I11_inventory_policy", "SELECT * FROM policy", "policy")


@query("I1_latest_attributes")
def i1(spark, sf):
    h = I.latest_attributes(clean(spark, sf))
    return h.select("store_id", "item_id", *I.LAST_ATTRIBUTES)


oracle("I1_latest_attributes", """
SELECT store_id, item_id, lead_ AS supplier_lead_time_days, unit_cost, ordering_cost,
       holding_cost_rate, product_name, category, soh_ AS stock_on_hand
FROM hist""", "hist")


@query("I3_forecast_fallback")
def i3(spark, sf):
    b = I.policy_base(clean(spark, sf))
    return b.select("store_id", "item_id", rnd("mu_L", 6).alias("mu_L"))


oracle("I3_forecast_fallback", f"SELECT store_id, item_id, {r('mu_L', 6)} AS mu_L FROM base_fallback",
       "base_fallback")


@query("I4_demand_std")
def i4(spark, sf):
    b = I.policy_base(clean(spark, sf))
    s = F.when(F.col("_std") < I.MIN_STD, I.MIN_STD).otherwise(F.col("_std"))
    return b.select("store_id", "item_id", rnd(s, 6).alias("demand_std"))


oracle("I4_demand_std", f"""
SELECT store_id, item_id, {r('CASE WHEN sd_ < 0.1 THEN 0.1 ELSE sd_ END', 6)} AS demand_std
FROM base_fallback""", "base_fallback")


@query("I5_annual_demand")
def i5(spark, sf):
    b = I.policy_base(clean(spark, sf))
    return b.select("store_id", "item_id", rnd("annual_demand_est", 6).alias("annual_demand_est"))


oracle("I5_annual_demand", f"""
SELECT store_id, item_id, {r('annual_demand_est', 6)} AS annual_demand_est FROM base_fallback""",
       "base_fallback")


@query("I12_reorder_alerts")
def i12(spark, sf):
    return I.reorder_alerts(I.inventory_policy(clean(spark, sf)))


oracle("I12_reorder_alerts", "SELECT * FROM alerts ORDER BY on_hand, store_id, item_id", "alerts")


@query("I13_policy_summary")
def i13(spark, sf):
    return I.policy_summary(I.inventory_policy(clean(spark, sf)))


oracle("I13_policy_summary", f"""
SELECT COUNT(*) FILTER (WHERE reorder_alert) AS n_alerts, COUNT(*) AS n_combos,
       {r('COUNT(*) FILTER (WHERE reorder_alert) * 100.0 / COUNT(*)', 4)} AS alert_rate_pct,
       {r('AVG(safety_stock)', 4)} AS avg_safety_stock,
       {r('AVG(reorder_point)', 4)} AS avg_reorder_point, {r('AVG(EOQ)', 4)} AS avg_eoq
FROM policy""", "policy")


@query("I14_top_alerts")
def i14(spark, sf):
    return I.top_alerts(I.inventory_policy(clean(spark, sf)), 10)


oracle("I14_top_alerts", "SELECT * FROM alerts ORDER BY on_hand, store_id, item_id LIMIT 10",
       "alerts")


@query("I15_ss_rop_by_product")
def i15(spark, sf):
    return I.ss_rop_by_product(I.inventory_policy(clean(spark, sf)))


oracle("I15_ss_rop_by_product", f"""
SELECT product_name, {r('AVG(safety_stock)', 4)} AS safety_stock,
       {r('AVG(reorder_point)', 4)} AS reorder_point
FROM policy GROUP BY product_name""", "policy")


@query("I16_eoq_by_category")
def i16(spark, sf):
    return I.eoq_by_category(I.inventory_policy(clean(spark, sf)))


oracle("I16_eoq_by_category", box_sql("policy", "category", "EOQ"), "policy")


@query("I17_alert_matrix")
def i17(spark, sf):
    return I.alert_matrix(I.inventory_policy(clean(spark, sf)))


oracle("I17_alert_matrix", """
SELECT product_name, store_id, arg_min(CAST(reorder_alert AS DOUBLE), item_id) AS alert
FROM policy GROUP BY product_name, store_id""", "policy")


@query("I18_onhand_vs_rop")
def i18(spark, sf):
    return I.onhand_vs_rop(I.inventory_policy(clean(spark, sf)))


oracle("I18_onhand_vs_rop",
       "SELECT store_id, item_id, reorder_point, on_hand, reorder_alert FROM policy", "policy")

SWEEP = (0.80, 0.85, 0.90, 0.95, 0.99)


@query("I19_service_level_sweep")
def i19(spark, sf):
    return I.service_level_sweep(clean(spark, sf), SWEEP)


cte("levels", "SELECT CAST(s AS DOUBLE) AS service_level, CAST(z AS DOUBLE) AS zz_ FROM (VALUES "
    + ", ".join(f"('{s!r}', '{service_z(s)!r}')" for s in SWEEP) + ") t(s, z)")
cte("base_levels", "SELECT b.*, l.service_level, l.zz_ FROM base_fallback b CROSS JOIN levels l",
    "base_fallback", "levels")
oracle("I19_service_level_sweep", policy_sql("base_levels", "zz_", "service_level, "),
       "base_levels")


# I7-I10 are columns of the policy; each is also exposed on its own.
_POLICY_PARTS = {
    "I7_safety_stock_rop": ["sigma_L", "safety_stock", "reorder_point"],
    "I8_eoq": ["annual_demand_est", "unit_cost", "EOQ"],
    "I9_order_qty": ["on_hand", "reorder_point", "order_qty"],
    "I10_reorder_alert": ["on_hand", "reorder_point", "reorder_alert"],
}
for _name, _cols in _POLICY_PARTS.items():
    query(_name)(lambda spark, sf, _c=_cols: I.inventory_policy(clean(spark, sf))
                 .select("store_id", "item_id", *_c))
    oracle(_name, f"SELECT store_id, item_id, {', '.join(_cols)} FROM policy", "policy")


@query("I6_service_z")
def i6(spark, sf):
    """z per service level on every policy row (3 dp, as in the table)."""
    return I.service_level_sweep(clean(spark, sf), SWEEP).select("store_id", "item_id", "service_level", "z_score")


# fixed values: standard normal quantiles from published tables, 3 dp
PUBLISHED_Z = {0.80: 0.842, 0.85: 1.036, 0.90: 1.282, 0.95: 1.645, 0.975: 1.960, 0.98: 2.054, 0.99: 2.326,
               0.995: 2.576, 0.999: 3.090}
oracle("I6_service_z", "SELECT store_id, item_id, s AS service_level, z AS z_score FROM hist CROSS JOIN (VALUES "
       + ", ".join(f"(CAST({s!r} AS DOUBLE), CAST({PUBLISHED_Z[s]!r} AS DOUBLE))" for s in SWEEP) + ") t(s, z)", "hist")


@query("I14_top_alerts_dashboard")
def i14_dashboard(spark, sf):
    # the executive dashboard's variant of I14: eight alerts, four columns
    return I.top_alerts(I.inventory_policy(clean(spark, sf)), 8).select(
        "item_id", "product_name", "on_hand", "order_qty")


oracle("I14_top_alerts_dashboard", """
SELECT item_id, product_name, on_hand, order_qty FROM (
  SELECT * FROM alerts ORDER BY on_hand, store_id, item_id LIMIT 8)""", "alerts")
