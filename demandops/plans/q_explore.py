"""Queries: exploratory aggregates (E) and business / dashboard reports (K, A)."""

from __future__ import annotations

from demandops.functions.numeric import present
from demandops.operators import explore as E
from demandops.operators import insights as K
from demandops.operators import inventory as I
from demandops.plans.catalog import clean, query
from demandops.plans.oracle import box_sql, oracle, r

REV = "CAST(SUM(CAST(qty_sold * price AS DECIMAL(38,6))) AS DOUBLE)"


@query("E1_daily_sales_trend")
def e1(spark, sf):
    return present(E.daily_sales_trend(clean(spark, sf)))


oracle("E1_daily_sales_trend", f"""
SELECT date, qty_sold, {r('CASE WHEN COUNT(qty_sold) OVER w = 7 THEN AVG(qty_sold) OVER w END', 6)} AS ma_7
FROM (SELECT date, CAST(SUM(qty_sold) AS BIGINT) AS qty_sold FROM clean GROUP BY date)
WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", "clean")


@query("E2_category_units")
def e2(spark, sf):
    return E.category_units(clean(spark, sf))


oracle("E2_category_units",
       "SELECT category, CAST(SUM(qty_sold) AS BIGINT) AS qty_sold FROM clean GROUP BY category",
       "clean")


@query("E3_store_monthly_units")
def e3(spark, sf):
    return E.store_monthly_units(clean(spark, sf))


oracle("E3_store_monthly_units", """
SELECT store_id, CAST(date_trunc('month', date) AS DATE) AS month, CAST(SUM(qty_sold) AS BIGINT) AS qty_sold
FROM clean GROUP BY store_id, CAST(date_trunc('month', date) AS DATE)""", "clean")


@query("E4_dow_average")
def e4(spark, sf):
    return present(E.dow_average(clean(spark, sf)))


oracle("E4_dow_average", f"""
SELECT d.dow, d.day_name, {r('m.avg_qty', 6)} AS avg_qty
FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(E.DAY_NAMES))}) d(dow, day_name)
LEFT JOIN (SELECT CAST(isodow(date) - 1 AS INTEGER) AS dow, AVG(qty_sold) AS avg_qty
           FROM clean GROUP BY 1) m ON d.dow = m.dow""", "clean")


@query("E5_promo_lift_by_category")
def e5(spark, sf):
    return present(E.promo_lift_by_category(clean(spark, sf)))


oracle("E5_promo_lift_by_category", f"""
SELECT category, {r('no_promo', 6)} AS no_promo, {r('on_promo', 6)} AS on_promo,
       {r('(on_promo / NULLIF(no_promo, 0) - 1) * 100.0', 6)} AS lift_pct
FROM (SELECT category, AVG(qty_sold) FILTER (WHERE on_promo = 0) AS no_promo,
             AVG(qty_sold) FILTER (WHERE on_promo = 1) AS on_promo
      FROM clean GROUP BY category)""", "clean")


@query("E6_top_skus_by_revenue")
def e6(spark, sf):
    return present(E.top_skus_by_revenue(clean(spark, sf)))


oracle("E6_top_skus_by_revenue", f"""
SELECT item_id, product_name, {r('revenue', 6)} AS revenue
FROM (SELECT item_id, product_name, {REV} AS revenue FROM clean GROUP BY item_id, product_name)
ORDER BY revenue DESC, item_id LIMIT 10""", "clean")


@query("E7_zero_demand_share")
def e7(spark, sf):
    return present(E.zero_demand_share(clean(spark, sf)))


oracle("E7_zero_demand_share", f"""
SELECT item_id, product_name, {r('pct_zero', 6)} AS pct_zero, pct_zero > 20.0 AS intermittent
FROM (SELECT item_id, product_name, AVG(CAST(qty_sold = 0 AS DOUBLE)) * 100.0 AS pct_zero
      FROM clean GROUP BY item_id, product_name)""", "clean")


@query("E8_correlation_matrix")
def e8(spark, sf):
    return present(E.correlation_matrix(clean(spark, sf)))


_pairs = [(a, b) for i, a in enumerate(E.CORR_COLUMNS) for b in E.CORR_COLUMNS[:i]]
oracle("E8_correlation_matrix", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, "
    f"{r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 6)} AS corr FROM clean"
    for a, b in _pairs), "clean")


@query("E9_revenue_heatmap")
def e9(spark, sf):
    return present(E.revenue_heatmap(clean(spark, sf), long=True))


oracle("E9_revenue_heatmap", f"""
SELECT c.category, m.month, {r('COALESCE(v.revenue_k, 0)', 6)} AS revenue_k
FROM (SELECT DISTINCT category FROM clean) c
CROSS JOIN (SELECT DISTINCT strftime(date, '%Y-%m') AS month FROM clean) m
LEFT JOIN (SELECT category, strftime(date, '%Y-%m') AS month, {REV} / 1000.0 AS revenue_k
           FROM clean GROUP BY ALL) v
  ON v.category IS NOT DISTINCT FROM c.category AND v.month = m.month""", "clean")


@query("E10_qty_distribution")
def e10(spark, sf):
    return E.qty_distribution(clean(spark, sf))


oracle("E10_qty_distribution", box_sql("clean", "category", "qty_sold"), "clean")


@query("E11_eda_summary")
def e11(spark, sf):
    return E.eda_summary(clean(spark, sf))


oracle("E11_eda_summary", f"""
SELECT MIN(date) AS min_date, MAX(date) AS max_date, COUNT(DISTINCT store_id) AS n_stores,
       COUNT(DISTINCT item_id) AS n_items, COUNT(DISTINCT category) AS n_categories,
       COUNT(*) AS n_rows, CAST(SUM(qty_sold) AS BIGINT) AS total_units,
       {r(REV + ' / 1e6', 2)} AS revenue_m, {r('AVG(on_promo) * 100.0', 4)} AS promo_pct,
       {r('AVG(CAST(qty_sold = 0 AS DOUBLE)) * 100.0', 4)} AS zero_pct
FROM clean""", "clean")


# ------------------------------------------------------------------ K --
@query("K1_revenue_column")
def k1(spark, sf):
    return E.with_revenue(clean(spark, sf)).select("date", "store_id", "item_id", "revenue")


oracle("K1_revenue_column",
       "SELECT date, store_id, item_id, qty_sold * price AS revenue FROM clean", "clean")


@query("K2_total_revenue_units")
def k2(spark, sf):
    return K.total_revenue_units(clean(spark, sf))


oracle("K2_total_revenue_units", f"""
SELECT {r(REV + ' / 1e6', 2)} AS revenue_m, CAST(SUM(qty_sold) AS BIGINT) AS total_units
FROM clean""", "clean")


@query("K3_avg_daily_units")
def k3(spark, sf):
    return K.avg_daily_units(clean(spark, sf))


oracle("K3_avg_daily_units", f"""
SELECT {r('AVG(u)', 0)} AS avg_daily_units
FROM (SELECT date, SUM(qty_sold) AS u FROM clean GROUP BY date)""", "clean")


@query("K4_top_category")
def k4(spark, sf):
    return K.top_category(clean(spark, sf))


oracle("K4_top_category", f"""
SELECT category, {REV} AS revenue FROM clean GROUP BY category
ORDER BY revenue DESC, category LIMIT 1""", "clean")

_LIFT = ("(COALESCE(AVG(qty_sold) FILTER (WHERE on_promo = 1), 0) / "
         "GREATEST(COALESCE(AVG(qty_sold) FILTER (WHERE on_promo = 0), 1), 1) - 1) * 100.0")


@query("K5_promo_lift_overall")
def k5(spark, sf):
    return K.promo_lift_overall(clean(spark, sf))


oracle("K5_promo_lift_overall", f"SELECT {r(_LIFT, 4)} AS promo_lift_pct FROM clean", "clean")


@query("K6_alert_rate")
def k6(spark, sf):
    return K.alert_rate(I.inventory_policy(clean(spark, sf)))


oracle("K6_alert_rate", f"""
SELECT COUNT(*) FILTER (WHERE reorder_alert) AS n_alerts, COUNT(*) AS n_combos,
       {r('COUNT(*) FILTER (WHERE reorder_alert) * 100.0 / COUNT(*)', 1)} AS alert_rate_pct
FROM policy""", "policy")


@query("K9_daily_revenue_trend")
def k9(spark, sf):
    return present(K.daily_revenue_trend(clean(spark, sf)))


oracle("K9_daily_revenue_trend", f"""
SELECT date, {r('revenue', 6)} AS revenue,
       {r('CASE WHEN COUNT(revenue) OVER w = 7 THEN CAST(SUM(CAST(revenue AS DECIMAL(38,6))) OVER w AS DOUBLE) / 7.0 END', 6)} AS ma_7
FROM (SELECT date, {REV} AS revenue FROM clean GROUP BY date)
WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", "clean")


@query("K10_category_revenue_share")
def k10(spark, sf):
    return present(K.category_revenue_share(clean(spark, sf)))


oracle("K10_category_revenue_share", f"""
SELECT category, {r('revenue', 6)} AS revenue, {r('revenue * 100.0 / SUM(revenue) OVER ()', 6)} AS share_pct
FROM (SELECT category, {REV} AS revenue FROM clean GROUP BY category)""", "clean")


@query("K11_promo_distribution")
def k11(spark, sf):
    return K.promo_distribution(clean(spark, sf))


oracle("K11_promo_distribution", box_sql(
    "(SELECT CASE WHEN on_promo = 1 THEN 'On Promo' WHEN on_promo = 0 THEN 'No Promo' END "
    "AS promotion, qty_sold FROM clean)", "promotion", "qty_sold"), "clean")


@query("K12_recent_actuals")
def k12(spark, sf):
    return K.recent_actuals(clean(spark, sf))


oracle("K12_recent_actuals", """
SELECT date, CAST(SUM(qty_sold) AS BIGINT) AS qty_sold FROM clean GROUP BY date
ORDER BY date DESC LIMIT 30""", "clean")


@query("K13_report_policy")
def k13a(spark, sf):
    return K.report_policy_table(I.inventory_policy(clean(spark, sf)))


oracle("K13_report_policy", f"""
SELECT store_id, item_id, product_name, category, {r('safety_stock', 1)} AS safety_stock,
       {r('reorder_point', 1)} AS reorder_point, {r('EOQ', 1)} AS EOQ,
       {r('order_qty', 1)} AS order_qty, reorder_alert
FROM policy ORDER BY store_id, item_id LIMIT 30""", "policy")


@query("K13_report_alerts")
def k13b(spark, sf):
    return K.report_alert_table(I.inventory_policy(clean(spark, sf)))


oracle("K13_report_alerts", f"""
SELECT store_id, item_id, product_name, category, {r('on_hand', 1)} AS on_hand,
       {r('reorder_point', 1)} AS reorder_point, {r('safety_stock', 1)} AS safety_stock,
       {r('order_qty', 1)} AS order_qty
FROM policy WHERE reorder_alert ORDER BY store_id, item_id LIMIT 20""", "policy")


# ------------------------------------------------------------------ A --
SLICE_STORE, SLICE_CATEGORY = "EUROPE", "Core"


@query("A1_filter_slice")
def a1(spark, sf):
    return K.filter_slice(clean(spark, sf), SLICE_STORE, SLICE_CATEGORY)


oracle("A1_filter_slice",
       f"SELECT * FROM clean WHERE store_id = '{SLICE_STORE}' AND category = '{SLICE_CATEGORY}'",
       "clean")


@query("A2_filter_options")
def a2(spark, sf):
    return K.filter_options(clean(spark, sf))


oracle("A2_filter_options", """
SELECT DISTINCT kind, value FROM (
  SELECT 'store' AS kind, store_id AS value FROM clean UNION ALL
  SELECT 'item', item_id FROM clean UNION ALL
  SELECT 'category', category FROM clean) WHERE value IS NOT NULL
ORDER BY kind, value""", "clean")


@query("A3_slice_kpis")
def a3(spark, sf):
    c = clean(spark, sf)
    return K.slice_kpis(c, I.inventory_policy(c), store=SLICE_STORE)


oracle("A3_slice_kpis", f"""
SELECT {r(REV + ' / 1e6', 2)} AS revenue_m, CAST(SUM(qty_sold) AS BIGINT) AS total_units,
       COUNT(DISTINCT item_id) AS n_skus, {r(_LIFT, 4)} AS promo_lift_pct,
       (SELECT COUNT(*) FILTER (WHERE reorder_alert) FROM policy) AS n_alerts
FROM clean WHERE store_id = '{SLICE_STORE}'""", "clean", "policy")


@query("A5_alert_counts")
def a5(spark, sf):
    return K.alert_counts(I.inventory_policy(clean(spark, sf)))


oracle("A5_alert_counts", """
SELECT COUNT(*) AS n_alerts, COUNT(*) FILTER (WHERE urgency = 'CRITICAL') AS n_critical,
       COUNT(*) FILTER (WHERE urgency = 'WARNING') AS n_warning
FROM alerts""", "alerts")


@query("A6_policy_by_product")
def a6(spark, sf):
    return K.policy_by_product(I.inventory_policy(clean(spark, sf)))


oracle("A6_policy_by_product", f"""
SELECT product_name, {r('AVG(safety_stock)', 4)} AS safety_stock, {r('AVG(EOQ)', 4)} AS EOQ
FROM policy GROUP BY product_name""", "policy")


@query("A7_preview")
def a7(spark, sf):
    return K.preview(K.filter_slice(clean(spark, sf), store="ASIA"))


oracle("A7_preview", "SELECT * FROM clean WHERE store_id = 'ASIA' ORDER BY store_id, item_id, date LIMIT 100",
       "clean")
