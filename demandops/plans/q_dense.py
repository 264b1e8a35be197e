"""Queries on the dense panel (``dense=True``): gaps zero-filled on the D1
scaffold before features, so row lags are calendar lags and zero shares
(intermittency, Croston) are meaningful on sparse data."""

from __future__ import annotations

from demandops.functions.numeric import present
from demandops.operators import dims as D
from demandops.operators import features as FE
from demandops.operators import forecasting as FC
from demandops.plans.catalog import SERIES, clean, input_paths, query
from demandops.plans.materialize import memo_table
from demandops.plans.oracle import A, cte, festival_sql, oracle, r
from demandops.plans.q_features import FEATURE_ORDER, feature_ctes, rounded
from demandops.plans.q_forecast import croston_ctes

WK = "PARTITION BY s.store_id, s.item_id ORDER BY s.date"


def dense(spark, sf):
    return D.densify(clean(spark, sf), holiday_month_days=A.HOLIDAY_MONTH_DAYS,
                     festival_windows=A.FESTIVAL_WINDOWS)


def _carry(col: str) -> str:
    return (f"COALESCE(c.{col}, LAST_VALUE(c.{col} IGNORE NULLS) OVER ({WK} ROWS BETWEEN UNBOUNDED "
            f"PRECEDING AND CURRENT ROW), FIRST_VALUE(c.{col} IGNORE NULLS) OVER ({WK} ROWS BETWEEN "
            f"CURRENT ROW AND UNBOUNDED FOLLOWING))")


_HOL = ", ".join(f"'{m}'" for m in A.HOLIDAY_MONTH_DAYS)
cte("dense", f"""
SELECT s.date, s.store_id, s.item_id, a.product_name, a.category,
       COALESCE(c.qty_sold, CAST(0 AS BIGINT)) AS qty_sold, {_carry('price')} AS price,
       COALESCE(c.on_promo, 0) AS on_promo, COALESCE(c.discount_pct, CAST(0 AS DOUBLE)) AS discount_pct,
       {_carry('stock_on_hand')} AS stock_on_hand, COALESCE(c.stockout_flag, 0) AS stockout_flag,
       a.unit_cost, a.pack_size, a.shelf_life_days, a.supplier_lead_time_days, a.ordering_cost,
       a.holding_cost_rate,
       CAST(CASE WHEN strftime(s.date, '%m-%d') IN ({_HOL}) THEN 1 ELSE 0 END AS INTEGER) AS holiday_flag,
       CAST(CASE WHEN {festival_sql('s.date')} THEN 1 ELSE 0 END AS INTEGER) AS festival_flag,
       s.date - CAST(isodow(s.date) - 1 AS INTEGER) AS week_start
FROM (SELECT k.store_id, k.item_id, CAST(g.d AS DATE) AS date
      FROM (SELECT DISTINCT store_id, item_id FROM clean
            WHERE store_id IS NOT NULL AND item_id IS NOT NULL) k
      CROSS JOIN (SELECT unnest(generate_series(CAST((SELECT MIN(date) FROM clean) AS TIMESTAMP),
                                                CAST((SELECT MAX(date) FROM clean) AS TIMESTAMP),
                                                INTERVAL 1 DAY)) AS d) g) s
LEFT JOIN clean c ON s.store_id = c.store_id AND s.item_id = c.item_id AND s.date = c.date
LEFT JOIN (SELECT store_id, item_id, arg_max(product_name, date) AS product_name,
                  arg_max(category, date) AS category, arg_max(unit_cost, date) AS unit_cost,
                  arg_max(pack_size, date) AS pack_size, arg_max(shelf_life_days, date) AS shelf_life_days,
                  arg_max(supplier_lead_time_days, date) AS supplier_lead_time_days,
                  arg_max(ordering_cost, date) AS ordering_cost,
                  arg_max(holding_cost_rate, date) AS holding_cost_rate
           FROM clean GROUP BY store_id, item_id) a
  ON s.store_id = a.store_id AND s.item_id = a.item_id""", "clean")

def dense_features(spark, sf):
    """Feature table over the dense panel, as a stage (materialised once)."""
    return memo_table(spark, "features_dense", input_paths(sf),
                      lambda: FE.engineer_features(dense(spark, sf)),
                      bucket_by=SERIES, sort_by=["date"])


DENSE_FEATURES = feature_ctes("dense", "_dense")
DENSE_RATES = croston_ctes(DENSE_FEATURES, "_dense")


@query("D1_dense_panel")
def d1_dense(spark, sf):
    return dense(spark, sf)


oracle("D1_dense_panel", "SELECT * FROM dense", "dense")


@query("F13_engineer_features_dense")
def f13_dense(spark, sf):
    return present(FE.engineer_features(dense(spark, sf)))


oracle("F13_engineer_features_dense", f"SELECT {rounded(FEATURE_ORDER)} FROM {DENSE_FEATURES}",
       DENSE_FEATURES)


@query("M20_intermittency_class_dense")
def m20_dense(spark, sf):
    return present(FC.intermittency_class(dense_features(spark, sf)))


oracle("M20_intermittency_class_dense", f"""
SELECT store_id, item_id, {r('p_zero', 6)} AS p_zero, p_zero > {FC.INTERMITTENT_SHARE!r} AS intermittent
FROM (SELECT store_id, item_id, AVG(CAST(qty_sold = 0 AS DOUBLE)) AS p_zero FROM {DENSE_FEATURES}
      GROUP BY store_id, item_id)""", DENSE_FEATURES)


@query("M21_croston_sba_dense")
def m21_dense(spark, sf):
    return present(FC.croston_rates(dense_features(spark, sf)))


oracle("M21_croston_sba_dense", f"SELECT store_id, item_id, {r('rate', 6)} AS rate FROM {DENSE_RATES}",
       DENSE_RATES)
