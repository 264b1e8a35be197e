"""Queries: evaluation (M1-M12), deterministic forecasting (M20-M27) and the
reports that consume a forecast (I2, I11 with forecast, K7, K8, A4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandops.functions.numeric import present
from demandops.operators import evaluation as EV
from demandops.operators import forecasting as FC
from demandops.operators import insights as K
from demandops.operators import inventory as I
from demandops.plans.catalog import clean, croston_fc, features, query
from demandops.plans.oracle import Z95, base_ctes, cte, mean, oracle, policy_sql, r
from demandops.plans.q_features import CAL_SQL, FEATURE_ORDER, rounded

KEYS = ["store_id", "item_id"]
W = "PARTITION BY store_id, item_id ORDER BY date"
CUTOFF = f"((SELECT MAX(date) FROM features) - {EV.TEST_DAYS})"

# ------------------------------------------------------------ oracle CTEs --
cte("test_rows", f"""
SELECT *, COALESCE(CAST(LAG(qty_sold, {EV.SEASON_ROWS}) OVER ({W}) AS DOUBLE), CAST(0 AS DOUBLE)) AS naive
FROM features WHERE date > {CUTOFF}""", "features")

cte("baseline_long", """
SELECT store_id, item_id, date, category, qty_sold, naive, 'naive_lag1' AS model,
       CAST(lag_1 AS DOUBLE) AS predicted FROM test_rows
UNION ALL
SELECT store_id, item_id, date, category, qty_sold, naive, 'moving_average_7' AS model,
       CAST(rollmean_7 AS DOUBLE) AS predicted FROM test_rows""", "test_rows")

ERR = "(CAST(qty_sold AS DOUBLE) - predicted)"


def metrics_sql(src: str, by: str = "", naive: bool = True) -> str:
    mae = mean(f"ABS{ERR}")
    cols = [f"{r(mae, 2)} AS MAE", f"{r('sqrt(' + mean(ERR + ' * ' + ERR) + ')', 2)} AS RMSE",
            f"{r(mean(f'CASE WHEN qty_sold > 0 THEN ABS({ERR} / CAST(qty_sold AS DOUBLE)) END') + ' * 100.0', 2)} AS MAPE"]
    if naive:
        nmae = mean("ABS(CAST(qty_sold AS DOUBLE) - naive)")
        cols.append(f"{r(f'CASE WHEN {nmae} > 0 THEN {mae} / {nmae} END', 4)} AS MASE")
    sel = (by + ", " if by else "") + ", ".join(cols)
    return f"SELECT {sel} FROM {src}" + (f" GROUP BY {by}" if by else "")


def croston_ctes(features: str = "features", suffix: str = "") -> str:
    """Register the Croston CTEs over a feature CTE; return the rates CTE."""
    cte(f"cro_nz{suffix}", f"""
SELECT store_id, item_id, qty_sold,
       pos - COALESCE(LAG(pos) OVER ({W}), 0) AS gap,
       ROW_NUMBER() OVER ({W}) AS i,
       COUNT(*) OVER (PARTITION BY store_id, item_id) AS n
FROM (SELECT store_id, item_id, date, qty_sold, ROW_NUMBER() OVER ({W}) AS pos FROM {features})
WHERE qty_sold > 0""", features)
    cte(f"cro_rates{suffix}", f"""
SELECT s.store_id, s.item_id,
       GREATEST(COALESCE(c.z / GREATEST(c.p, CAST(1 AS DOUBLE)) * {_SBA}, 0), 0) AS rate
FROM (SELECT DISTINCT store_id, item_id FROM {features}
      WHERE store_id IS NOT NULL AND item_id IS NOT NULL) s
LEFT JOIN (SELECT store_id, item_id, SUM(w * qty_sold) AS z, SUM(w * gap) AS p
           FROM (SELECT *, CASE WHEN i = 1 THEN pow({_KEEP}, n - 1)
                                ELSE {_A} * pow({_KEEP}, n - i) END AS w FROM cro_nz{suffix})
           GROUP BY store_id, item_id) c
  ON s.store_id = c.store_id AND s.item_id = c.item_id""", f"cro_nz{suffix}", features)
    return f"cro_rates{suffix}"


_A, _KEEP, _SBA = (f"CAST('{x!r}' AS DOUBLE)" for x in (FC.ALPHA, 1.0 - FC.ALPHA, 1.0 - FC.ALPHA / 2.0))

REV = "CAST(SUM(CAST(qty_sold * price AS DECIMAL(38,6))) AS DOUBLE)"
LIFT = ("(COALESCE(AVG(qty_sold) FILTER (WHERE on_promo = 1), 0) / "
        "GREATEST(COALESCE(AVG(qty_sold) FILTER (WHERE on_promo = 0), 1), 1) - 1) * 100.0")


def forecast_ctes(features: str = "features", clean: str = "clean", suffix: str = "") -> str:
    """Register the Croston forecast over a feature table and the policy that
    it feeds over a clean table; return the SQL of the KPI table."""
    croston_ctes(features, suffix)
    if suffix:
        base_ctes(clean, suffix)
    cte(f"horizon{suffix}", f"""
SELECT CAST((SELECT MAX(date) FROM {features}) + CAST(h AS INTEGER) AS DATE) AS forecast_date
FROM (SELECT unnest(generate_series(1, {FC.HORIZON})) AS h)""", features)
    cte(f"cro_fc{suffix}", f"""
SELECT c.store_id, c.item_id, h.forecast_date, {r('c.rate', 2)} AS predicted_qty,
       '{FC.CROSTON_METHOD}' AS method
FROM cro_rates{suffix} c CROSS JOIN horizon{suffix} h""", f"cro_rates{suffix}", f"horizon{suffix}")
    cte(f"fc_mu{suffix}", f"""
SELECT f.store_id, f.item_id,
       SUM(CASE WHEN f.h_ <= hh.lead_ THEN f.predicted_qty ELSE CAST(0 AS DOUBLE) END) AS mu_fc_,
       COUNT(*) AS n_fc_
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY forecast_date) AS h_
      FROM cro_fc{suffix}) f
JOIN hist{suffix} hh ON f.store_id = hh.store_id AND f.item_id = hh.item_id
GROUP BY f.store_id, f.item_id""", f"cro_fc{suffix}", f"hist{suffix}")
    cte(f"base_fc{suffix}", f"""
SELECT b.store_id, b.item_id, b.product_name, b.category, b.unit_cost, b.lead_time_days,
       b.annual_demand_est,
       CASE WHEN m.n_fc_ > 0 THEN m.mu_fc_ ELSE b.mu_L END AS mu_L, b.sd_, b.on_hand,
       b.ordering_cost, b.holding_cost_rate
FROM base_fallback{suffix} b LEFT JOIN fc_mu{suffix} m ON b.store_id = m.store_id AND b.item_id = m.item_id""",
        f"base_fallback{suffix}", f"fc_mu{suffix}")
    cte(f"policy_fc{suffix}", policy_sql(f"base_fc{suffix}", f"CAST('{Z95}' AS DOUBLE)"), f"base_fc{suffix}")
    policy, fc = f"policy_fc{suffix}", f"cro_fc{suffix}"
    kpis = [
        ("Total Revenue (M)", f"(SELECT {r(REV + ' / 1e6', 2)} FROM {clean})", "NULL"),
        ("Total Units Sold", f"(SELECT CAST(SUM(qty_sold) AS DOUBLE) FROM {clean})", "NULL"),
        ("Avg Daily Units Sold", f"(SELECT {r('AVG(u)', 0)} FROM (SELECT SUM(qty_sold) AS u FROM {clean} GROUP BY date))", "NULL"),
        ("Top Revenue Category", "NULL",
         f"(SELECT category FROM {clean} GROUP BY category ORDER BY {REV} DESC, category LIMIT 1)"),
        ("Promo Lift (%)", f"(SELECT {r(LIFT, 1)} FROM {clean})", "NULL"),
        ("SKU-Store Combos", f"(SELECT COUNT(*) FROM {policy})", "NULL"),
        ("Reorder Alerts", f"(SELECT COUNT(*) FILTER (WHERE reorder_alert) FROM {policy})", "NULL"),
        ("Alert Rate (%)", f"(SELECT {r('COUNT(*) FILTER (WHERE reorder_alert) * 100.0 / COUNT(*)', 1)} FROM {policy})", "NULL"),
        ("Avg Safety Stock (units)", f"(SELECT {r('AVG(safety_stock)', 1)} FROM {policy})", "NULL"),
        ("Avg Reorder Point", f"(SELECT {r('AVG(reorder_point)', 1)} FROM {policy})", "NULL"),
        ("Avg EOQ (units)", f"(SELECT {r('AVG(EOQ)', 1)} FROM {policy})", "NULL"),
        ("30-Day Forecast Total", f"(SELECT floor(CAST(SUM(CAST(predicted_qty AS DECIMAL(38,6))) AS DOUBLE)) FROM {fc})", "NULL"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS ordinal, '{m}' AS metric, CAST({v} AS DOUBLE) AS value, CAST({lbl} AS VARCHAR) AS label"
        for i, (m, v, lbl) in enumerate(kpis))


KPIS = forecast_ctes()

# ------------------------------------------------------------- M1-M12 --
@query("M1_time_split")
def m1(spark, sf):
    return EV.time_split(features(spark, sf)).select(*KEYS, "date", "split")


oracle("M1_time_split", f"""
SELECT store_id, item_id, date, CASE WHEN date <= {CUTOFF} THEN 'train' ELSE 'test' END AS split
FROM features""", "features")


@query("M4_seasonal_naive_28")
def m4(spark, sf):
    return EV.seasonal_naive(features(spark, sf)).select(*KEYS, "date", "qty_sold", "naive")


oracle("M4_seasonal_naive_28", "SELECT store_id, item_id, date, qty_sold, naive FROM test_rows",
       "test_rows")


def _ma7(spark, sf):
    return EV.baseline_predictions(features(spark, sf)).filter(F.col("model") == "moving_average_7")


MA7 = "(SELECT * FROM baseline_long WHERE model = 'moving_average_7')"


@query("M5_forecast_metrics")
def m5(spark, sf):
    return EV.forecast_metrics(_ma7(spark, sf))


oracle("M5_forecast_metrics", metrics_sql(MA7), "baseline_long")


@query("M6_mae_by_category")
def m6(spark, sf):
    return EV.mae_by_category(_ma7(spark, sf))


oracle("M6_mae_by_category", f"SELECT category, {r(mean(f'ABS{ERR}'), 2)} AS MAE FROM {MA7} GROUP BY category",
       "baseline_long")


@query("M8_actual_vs_predicted_daily")
def m8(spark, sf):
    return EV.actual_vs_predicted_daily(_ma7(spark, sf))


oracle("M8_actual_vs_predicted_daily", f"""
SELECT date, CAST(SUM(qty_sold) AS BIGINT) AS actual,
       CAST(SUM(CAST(predicted AS DECIMAL(38,6))) AS DOUBLE) AS predicted
FROM {MA7} GROUP BY date""", "baseline_long")


@query("M9a_naive_lag1")
def m9a(spark, sf):
    return clean(spark, sf).select(*KEYS, "date", "qty_sold", EV.naive_lag1().alias("naive_lag1"))


oracle("M9a_naive_lag1", f"""
SELECT store_id, item_id, date, qty_sold, CAST(LAG(qty_sold, 1) OVER ({W}) AS DOUBLE) AS naive_lag1
FROM clean""", "clean")


@query("M9b_moving_average_7")
def m9b(spark, sf):
    return present(clean(spark, sf).select(*KEYS, "date", "qty_sold",
                                           EV.moving_average_7().alias("moving_average_7")))


oracle("M9b_moving_average_7", f"""
SELECT store_id, item_id, date, qty_sold,
       {r(f'CASE WHEN COUNT(qty_sold) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7 THEN AVG(qty_sold) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END', 6)} AS moving_average_7
FROM clean""", "clean")


@query("M10_model_benchmark")
def m10(spark, sf):
    return EV.model_benchmark(EV.baseline_predictions(features(spark, sf)))


cte("bench_metrics", metrics_sql("baseline_long", "model"), "baseline_long")
oracle("M10_model_benchmark", f"""
SELECT *, {r("TRY_CAST((SELECT MAPE FROM bench_metrics WHERE model = 'naive_lag1') - MAPE AS DOUBLE) / NULLIF((SELECT MAPE FROM bench_metrics WHERE model = 'naive_lag1'), 0) * 100.0", 2)} AS mape_improvement_pct
FROM bench_metrics""", "bench_metrics")


@query("M11_error_analysis")
def m11(spark, sf):
    return EV.error_analysis(EV.baseline_predictions(features(spark, sf)))


oracle("M11_error_analysis", metrics_sql("baseline_long", "model, item_id", naive=False),
       "baseline_long")


@query("M12_category_error_table")
def m12(spark, sf):
    return EV.category_error_table(EV.baseline_predictions(features(spark, sf)))


oracle("M12_category_error_table", f"""
SELECT model, category, MAE, MAPE FROM ({metrics_sql("baseline_long", "model, category", naive=False)})""",
       "baseline_long")


# ------------------------------------------------------------ M20-M27 --
@query("M20_intermittency_class")
def m20(spark, sf):
    return present(FC.intermittency_class(features(spark, sf)))


oracle("M20_intermittency_class", f"""
SELECT store_id, item_id, {r('p_zero', 6)} AS p_zero, p_zero > {FC.INTERMITTENT_SHARE!r} AS intermittent
FROM (SELECT store_id, item_id, AVG(CAST(qty_sold = 0 AS DOUBLE)) AS p_zero FROM features
      GROUP BY store_id, item_id)""", "features")


@query("M21_croston_sba")
def m21(spark, sf):
    return present(FC.croston_rates(features(spark, sf)))


oracle("M21_croston_sba", f"SELECT store_id, item_id, {r('rate', 6)} AS rate FROM cro_rates", "cro_rates")


@query("M22_future_scaffold")
def m22(spark, sf):
    return FC.future_scaffold(features(spark, sf))


oracle("M22_future_scaffold", """
SELECT s.store_id, s.item_id, h.forecast_date
FROM (SELECT DISTINCT store_id, item_id FROM features) s CROSS JOIN horizon h""",
       "features", "horizon")


@query("M23_future_features")
def m23(spark, sf):
    return present(FC.future_features(features(spark, sf)))


def _m23_sql() -> str:
    cal = set(CAL_SQL)
    inner = ", ".join(
        ("h.forecast_date AS date" if c == "date"
         else f"CAST(l.time_idx + date_diff('day', (SELECT MAX(date) FROM features), h.forecast_date) AS INTEGER) AS time_idx"
         if c == "time_idx" else f"l.{c}")
        for c in FEATURE_ORDER if c not in cal)
    outer = ", ".join(
        (CAL_SQL[c] + f" AS {c}") if c in cal else c for c in FEATURE_ORDER)
    return f"""
SELECT {rounded(FEATURE_ORDER)} FROM (
SELECT {outer} FROM (
  SELECT {inner}
  FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rn_
                       FROM features) WHERE rn_ = 1) l
  CROSS JOIN horizon h))"""


oracle("M23_future_features", _m23_sql(), "features", "horizon")


@query("M26_forecast_band")
def m26(spark, sf):
    return present(FC.forecast_band(croston_fc(spark, sf)))


oracle("M26_forecast_band", f"""
SELECT *, {r('GREATEST(predicted_qty * 0.8, 0)', 6)} AS lower, {r('predicted_qty * 1.2', 6)} AS upper
FROM cro_fc""", "cro_fc")


@query("M27_forecast_daily_total")
def m27(spark, sf):
    return FC.forecast_daily_total(croston_fc(spark, sf))


oracle("M27_forecast_daily_total", """
SELECT forecast_date, CAST(SUM(CAST(predicted_qty AS DECIMAL(38,6))) AS DOUBLE) AS predicted_qty
FROM cro_fc GROUP BY forecast_date""", "cro_fc")


@query("M25_hybrid_forecast_croston")
def m25c(spark, sf):
    # The Croston branch of the hybrid forecast (exact); the model branch is
    # the rows-only M25_hybrid_forecast query.
    return FC.croston_forecast(features(spark, sf))


oracle("M25_hybrid_forecast_croston", "SELECT * FROM cro_fc", "cro_fc")


# ---------------------------------------- consumers of the forecast ----
@query("I2_lead_time_demand")
def i2(spark, sf):
    c = clean(spark, sf)
    hist = I.latest_attributes(c)
    return present(I.lead_time_demand(croston_fc(spark, sf), hist)
                   .select(*KEYS, F.col("_mu_fc").alias("mu_L"), F.col("_n_fc").alias("n_forecast")))


oracle("I2_lead_time_demand",
       f"SELECT store_id, item_id, {r('mu_fc_', 6)} AS mu_L, n_fc_ AS n_forecast FROM fc_mu", "fc_mu")


def policy_fc(spark, sf):
    return I.inventory_policy(clean(spark, sf), croston_fc(spark, sf))


@query("I11_inventory_policy_forecast")
def i11f(spark, sf):
    return policy_fc(spark, sf)


oracle("I11_inventory_policy_forecast", "SELECT * FROM policy_fc", "policy_fc")


@query("K7_forecast_total")
def k7(spark, sf):
    return K.forecast_total(croston_fc(spark, sf))


oracle("K7_forecast_total",
       "SELECT CAST(CAST(SUM(CAST(predicted_qty AS DECIMAL(38,6))) AS DOUBLE) AS BIGINT) AS forecast_total FROM cro_fc",
       "cro_fc")


@query("K8_kpi_table")
def k8(spark, sf):
    c = clean(spark, sf)
    return K.kpi_table(c, policy_fc(spark, sf), croston_fc(spark, sf))


oracle("K8_kpi_table", KPIS, "clean", "policy_fc", "cro_fc")

A4_ITEM = "STANDARD"


@query("A4_series_history_forecast")
def a4(spark, sf):
    return K.series_history_forecast(clean(spark, sf), croston_fc(spark, sf), A4_ITEM)


oracle("A4_series_history_forecast", f"""
SELECT store_id, item_id, date, CAST(qty_sold AS DOUBLE) AS qty, 'history' AS kind FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rn_
  FROM clean WHERE item_id = '{A4_ITEM}' AND store_id = (SELECT MIN(store_id) FROM clean)) WHERE rn_ <= 90
UNION ALL
SELECT store_id, item_id, forecast_date AS date, predicted_qty AS qty, 'forecast' AS kind
FROM cro_fc WHERE item_id = '{A4_ITEM}' AND store_id = (SELECT MIN(store_id) FROM clean)""",
       "clean", "cro_fc")


@query("M4_seasonal_naive_28_full")
def m4_full(spark, sf):
    # honest variant: lag over the whole history, then keep the test slice
    return EV.seasonal_naive(features(spark, sf), history="full").select(
        *KEYS, "date", "qty_sold", "naive")


oracle("M4_seasonal_naive_28_full", f"""
SELECT store_id, item_id, date, qty_sold, naive FROM (
  SELECT *, COALESCE(CAST(LAG(qty_sold, {EV.SEASON_ROWS}) OVER ({W}) AS DOUBLE), CAST(0 AS DOUBLE)) AS naive
  FROM features) WHERE date > {CUTOFF}""", "features")
