"""Queries: feature engineering (F)."""

from __future__ import annotations


from demandops.functions.numeric import present
from demandops.operators import features as FE
from demandops.plans.catalog import clean, query
from demandops.plans.oracle import cte, oracle, r

KEY = ["store_id", "item_id", "date"]
W = "PARTITION BY store_id, item_id ORDER BY date"
TWO_PI = f"CAST('{FE.TWO_PI!r}' AS DOUBLE)"


def _frame(w: int) -> str:
    return f"({W} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"


def _strict(col: str, w: int, agg: str) -> str:
    return f"CASE WHEN COUNT({col}) OVER {_frame(w)} = {w} THEN {agg}({col}) OVER {_frame(w)} END"


CAL_SQL = {
    "dow": "CAST(isodow(date) - 1 AS INTEGER)",
    "is_weekend": "CAST(isodow(date) - 1 >= 5 AS INTEGER)",
    "day_of_month": "CAST(day(date) AS INTEGER)",
    "week_of_year": "CAST(weekofyear(date) AS INTEGER)",
    "month": "CAST(month(date) AS INTEGER)",
    "quarter": "CAST(quarter(date) AS INTEGER)",
    "year": "CAST(year(date) AS INTEGER)",
    "sin_doy": f"sin({TWO_PI} * dayofyear(date) / CAST(365 AS DOUBLE))",
    "cos_doy": f"cos({TWO_PI} * dayofyear(date) / CAST(365 AS DOUBLE))",
    "sin_dow": f"sin({TWO_PI} * (isodow(date) - 1) / CAST(7 AS DOUBLE))",
    "cos_dow": f"cos({TWO_PI} * (isodow(date) - 1) / CAST(7 AS DOUBLE))",
}
LAG_SQL = {f"lag_{n}": f"LAG(qty_sold, {n}) OVER ({W})" for n in FE.LAGS}
ROLL_SQL = {}
for _w in FE.WINDOWS:
    ROLL_SQL[f"rollmean_{_w}"] = _strict("qty_sold", _w, "AVG")
    ROLL_SQL[f"rollstd_{_w}"] = _strict("qty_sold", _w, "stddev_samp")
    ROLL_SQL[f"rollmin_{_w}"] = _strict("qty_sold", _w, "MIN")
    ROLL_SQL[f"rollmax_{_w}"] = _strict("qty_sold", _w, "MAX")
PROMO_SQL = {f"promo_freq_{w}d": _strict("on_promo", w, "AVG") for w in FE.PROMO_WINDOWS}
PRICE_SQL = {
    "gross_margin_pct": "(x.price - x.unit_cost) / NULLIF(x.price, 0)",
    "is_discounted": "CAST(x.discount_pct > 0 AS INTEGER)",
    "price_vs_cat_median": "x.price / (cm_.med_ + 1e-9)",
}
ENC_SQL = {f"{c}_enc": f"CAST(COALESCE(e_{c}.code_, -1) AS INTEGER)" for c in FE.ENCODED}
TIME_SQL = {"time_idx": f"CAST(ROW_NUMBER() OVER ({W}) - 1 AS INTEGER)"}
CLEAN_COLS = ["date", "store_id", "item_id", "product_name", "category", "qty_sold", "price",
              "on_promo", "discount_pct", "stock_on_hand", "stockout_flag", "unit_cost",
              "pack_size", "shelf_life_days", "supplier_lead_time_days", "ordering_cost",
              "holding_cost_rate", "holiday_flag", "festival_flag", "week_start"]


def _sel(d: dict) -> str:
    return ",\n       ".join(f"{v} AS {k}" for k, v in d.items())


def _enc_joins(src: str) -> str:
    return "\n".join(
        f"LEFT JOIN (SELECT {c}, DENSE_RANK() OVER (ORDER BY {c}) - 1 AS code_ "
        f"FROM (SELECT DISTINCT {c} FROM {src} WHERE {c} IS NOT NULL)) e_{c} ON x.{c} = e_{c}.{c}"
        for c in FE.ENCODED)


FEATURE_ORDER = (CLEAN_COLS + list(CAL_SQL) + list(LAG_SQL) + list(ROLL_SQL) + list(PRICE_SQL)
                 + list(PROMO_SQL) + list(ENC_SQL) + list(TIME_SQL))


def feature_ctes(src: str = "clean", suffix: str = "") -> str:
    """Register feat_win / feat_all / features CTEs over ``src``; return the
    name of the final feature CTE."""
    cte(f"feat_win{suffix}", f"""
SELECT *, {_sel({**CAL_SQL, **LAG_SQL, **ROLL_SQL, **PROMO_SQL, **TIME_SQL})}
FROM {src}""", src)
    cte(f"feat_all{suffix}", f"""
SELECT {', '.join('x.' + c for c in CLEAN_COLS + list(CAL_SQL) + list(LAG_SQL) + list(ROLL_SQL))},
       {_sel(PRICE_SQL)},
       {', '.join('x.' + c for c in PROMO_SQL)},
       {_sel(ENC_SQL)}, x.time_idx
FROM feat_win{suffix} x
LEFT JOIN (SELECT category, median(price) AS med_ FROM {src} GROUP BY category) cm_
  ON x.category = cm_.category
{_enc_joins(src)}""", f"feat_win{suffix}", src)
    cte(f"features{suffix}", f"""
SELECT * FROM feat_all{suffix} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURE_ORDER)}""",
        f"feat_all{suffix}")
    return f"features{suffix}"


feature_ctes("clean")

DOUBLE_FEATURES = {"price", "discount_pct", "unit_cost", "ordering_cost", "holding_cost_rate",
                   "sin_doy", "cos_doy", "sin_dow", "cos_dow", "gross_margin_pct",
                   "price_vs_cat_median", *[k for k in ROLL_SQL if not k.startswith(("rollmin", "rollmax"))],
                   *PROMO_SQL}


def rounded(cols, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(f"{r(p + c, 6)} AS {c}" if c in DOUBLE_FEATURES else p + c for c in cols)


def _q(name, fn, cols, src="feat_all"):
    query(name)(lambda spark, sf: present(fn(clean(spark, sf)).select(*KEY, *cols)))
    oracle(name, f"SELECT {rounded(KEY + cols)} FROM {src}", src)


_q("F1_calendar_features", FE.calendar_features, CAL_SQL and list(CAL_SQL)[:7])
_q("F2_fourier_features", FE.fourier_features, list(CAL_SQL)[7:])
_q("F3_lag_features", FE.lag_features, list(LAG_SQL))
_q("F4_rolling_features", FE.rolling_features, list(ROLL_SQL))
_q("F5_gross_margin_pct", FE.gross_margin, ["gross_margin_pct"])
_q("F6_is_discounted", FE.is_discounted, ["is_discounted"])
_q("F7_price_vs_cat_median", FE.price_features, ["price_vs_cat_median"])
_q("F8_promo_frequency", FE.promo_frequency, list(PROMO_SQL))
_q("F9_label_encode", FE.label_encode, list(ENC_SQL))
_q("F10_time_index", FE.time_index, list(TIME_SQL))


@query("F11_drop_cold_start")
def f11(spark, sf):
    cols = list(LAG_SQL) + list(ROLL_SQL)
    df = FE.rolling_features(FE.lag_features(clean(spark, sf))).select(*KEY, *cols)
    return present(FE.drop_cold_start(df))


oracle("F11_drop_cold_start", f"""
SELECT {rounded(KEY + list(LAG_SQL) + list(ROLL_SQL))} FROM feat_win
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in list(LAG_SQL) + list(ROLL_SQL))}""", "feat_win")


@query("F12_feature_columns")
def f12(spark, sf):
    feats = FE.engineer_features(clean(spark, sf))
    return present(feats.select(*KEY, *FE.feature_columns(feats)))


oracle("F12_feature_columns", f"""
SELECT {rounded(KEY + [c for c in FEATURE_ORDER if c not in FE.EXCLUDED])} FROM features""",
       "features")


@query("F13_engineer_features")
def f13(spark, sf):
    return present(FE.engineer_features(clean(spark, sf)))


oracle("F13_engineer_features", f"SELECT {rounded(FEATURE_ORDER)} FROM features", "features")
