"""Feature engineering.

All per-series window features (lags, strict rolling statistics, promo
frequency, time index) use the same (partition, order) spec and are added in
one ``withColumns``: Spark plans a single exchange on the series key and a
single sort for all of them.  Each window partition is one series, whose
size is bounded by the number of days (one row per series and day).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandops import SERIES_KEYS
from demandops.functions.joins import lookup_join
from demandops.functions.numeric import safe_div
from demandops.functions.ranking import dense_codes
from demandops.functions.stats import group_median
from demandops.functions.windows import series_window, strict_rolling
from demandops.sources.io import materialize
from demandops.sources.tables import fits_broadcast

# Fixed values (the reference's default feature set): lags, rolling windows,
# promo windows, encoded columns, excluded columns.
LAGS = (1, 2, 3, 7, 14)
WINDOWS = (7, 14, 28)
PROMO_WINDOWS = (7, 14)
ENCODED = ("store_id", "item_id", "category")
# identifiers and leakage columns, never model inputs
EXCLUDED = ("date", "qty_sold", "store_id", "item_id", "product_name", "category",
            "stockout_flag", "stock_on_hand", "week_start")
CALENDAR_COLUMNS = ["dow", "is_weekend", "day_of_month", "week_of_year", "month", "quarter",
                    "year", "sin_doy", "cos_doy", "sin_dow", "cos_dow"]
TWO_PI = 2.0 * math.pi


def calendar_columns(date: str = "date") -> dict:
    """F1 + F2 as column expressions (reused for future dates, M23)."""
    d = F.col(date)
    dow = F.weekday(d)
    return {
        "dow": dow,
        "is_weekend": (dow >= 5).cast("int"),
        "day_of_month": F.dayofmonth(d),
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        # divisor 365 even in leap years, as the reference
        "sin_doy": F.sin(F.lit(TWO_PI) * F.dayofyear(d) / F.lit(365.0)),
        "cos_doy": F.cos(F.lit(TWO_PI) * F.dayofyear(d) / F.lit(365.0)),
        "sin_dow": F.sin(F.lit(TWO_PI) * dow / F.lit(7.0)),
        "cos_dow": F.cos(F.lit(TWO_PI) * dow / F.lit(7.0)),
    }


def calendar_features(df: DataFrame) -> DataFrame:
    """F1 (dow Mon=0, weekend, day, ISO week, month, quarter, year) and
    F2 (annual and weekly Fourier terms)."""
    return df.withColumns(calendar_columns())


def fourier_features(df: DataFrame) -> DataFrame:
    """F2 alone."""
    cols = calendar_columns()
    return df.withColumns({k: cols[k] for k in ("sin_doy", "cos_doy", "sin_dow", "cos_dow")})


def lag_columns(target: str = "qty_sold", lags: Sequence[int] = LAGS,
                keys: Sequence[str] = SERIES_KEYS) -> dict:
    """row lags within each series (gaps shift them, as the reference)."""
    w = series_window(keys)
    return {f"lag_{n}": F.lag(target, n).over(w) for n in lags}


def rolling_columns(target: str = "qty_sold", windows: Sequence[int] = WINDOWS,
                    keys: Sequence[str] = SERIES_KEYS) -> dict:
    """mean / std (n-1) / min / max over the previous w rows, NULL until
    w values exist; the current row is excluded."""
    out = {}
    for w in windows:
        out[f"rollmean_{w}"] = strict_rolling(target, w, F.avg, keys)
        out[f"rollstd_{w}"] = strict_rolling(target, w, F.stddev_samp, keys)
        out[f"rollmin_{w}"] = strict_rolling(target, w, F.min, keys)
        out[f"rollmax_{w}"] = strict_rolling(target, w, F.max, keys)
    return out


def promo_columns(windows: Sequence[int] = PROMO_WINDOWS, keys: Sequence[str] = SERIES_KEYS) -> dict:
    """F8: share of promotion days over the previous 7 / 14 rows (strict)."""
    return {f"promo_freq_{w}d": strict_rolling("on_promo", w, F.avg, keys) for w in windows}


def time_index_column(keys: Sequence[str] = SERIES_KEYS) -> dict:
    """0-based row number within the series."""
    return {"time_idx": F.row_number().over(series_window(keys)) - 1}


def lag_features(df: DataFrame, target: str = "qty_sold", lags: Sequence[int] = LAGS) -> DataFrame:
    return df.withColumns(lag_columns(target, lags))


def rolling_features(df: DataFrame, target: str = "qty_sold",
                     windows: Sequence[int] = WINDOWS) -> DataFrame:
    return df.withColumns(rolling_columns(target, windows))


def promo_frequency(df: DataFrame) -> DataFrame:
    return df.withColumns(promo_columns()) if "on_promo" in df.columns else df


def time_index(df: DataFrame) -> DataFrame:
    return df.withColumns(time_index_column())


def gross_margin(df: DataFrame) -> DataFrame:
    """(price - unit cost) / price, row by row."""
    if "price" in df.columns and "unit_cost" in df.columns:
        return df.withColumn("gross_margin_pct", safe_div(F.col("price") - F.col("unit_cost"), "price"))
    return df


def is_discounted(df: DataFrame) -> DataFrame:
    """1 where a discount is given, row by row."""
    if "discount_pct" in df.columns:
        return df.withColumn("is_discounted", (F.col("discount_pct") > 0).cast("int"))
    return df


def price_features(df: DataFrame, fit: DataFrame | None = None,
                   median_method: str = "bracket") -> DataFrame:
    """F5, F6 and F7 price / (category median + 1e-9).

    The reference's median spans the whole table (look-ahead); pass
    ``fit`` (e.g. the training rows) to take the medians from it instead.
    Medians are exact (``functions.stats.group_median``)."""
    out = is_discounted(gross_margin(df))
    if "discount_pct" in df.columns:
        src = fit if fit is not None else df
        med = group_median(src, "category", "price", median_method, out="_cat_median")
        out = (lookup_join(out, med, ["category"], "left")
                  .withColumn("price_vs_cat_median",
                              F.col("price") / (F.col("_cat_median") + F.lit(1e-9)))
                  .drop("_cat_median"))
    return out


def label_encode(df: DataFrame, cols: Sequence[str] = ENCODED) -> DataFrame:
    """codes 0..n-1 in sorted order of the distinct values; NULL -> -1.

    One aggregate collects the distinct value combinations (bounded by the
    dimensions, not by the rows), written once and measured.  Under the
    broadcast bounds they are ranked with windows in one pass; otherwise each
    column is coded by ``functions.ranking.dense_codes`` (no single-task
    step).  The codes come back to the rows in one null-safe ``lookup_join``."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    combos = materialize(df.select(*present).distinct(), "combinations")
    small = fits_broadcast(combos)
    if small:
        # measured: rank every column in one pass of windows over the combinations
        codes = combos.withColumns({
            f"{c}_enc": F.when(F.col(c).isNull(), F.lit(-1)).otherwise(
                F.dense_rank().over(Window.partitionBy(F.col(c).isNull()).orderBy(c)) - 1
            ).cast("int") for c in present})
    else:
        codes = combos
        for c in present:
            codes = lookup_join(codes, dense_codes(combos, c, f"{c}_enc"), [c], "left")
    codes = codes.select(*[F.col(c).alias(f"_k_{c}") for c in present],
                         *[F.coalesce(F.col(f"{c}_enc"), F.lit(-1)).cast("int").alias(f"{c}_enc")
                           for c in present])

    def cond(big, small):
        out = None
        for c in present:
            term = big[c].eqNullSafe(small[f"_k_{c}"])
            out = term if out is None else out & term
        return out
    return (lookup_join(df, codes, how="left", condition=cond, checked=small)
            .drop(*[f"_k_{c}" for c in present]))


def drop_cold_start(df: DataFrame) -> DataFrame:
    """drop rows with NULL in any column (the first 28 rows per series
    with the default windows)."""
    return df.dropna(how="any")


def feature_columns(df: DataFrame) -> list[str]:
    """every column except identifiers and leakage columns."""
    return [c for c in df.columns if c not in EXCLUDED]


def engineer_features(clean: DataFrame, target: str = "qty_sold",
                      keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """the reference's feature table (57 columns with the defaults)."""
    base_cols = list(clean.columns)
    windowed = {**lag_columns(target, LAGS, keys), **rolling_columns(target, WINDOWS, keys)}
    promo = promo_columns(PROMO_WINDOWS, keys) if "on_promo" in clean.columns else {}
    out = clean.withColumns({**calendar_columns(), **windowed, **promo, **time_index_column(keys)})
    out = price_features(out)
    out = label_encode(out)
    order = (base_cols + CALENDAR_COLUMNS + list(windowed)
             + [c for c in ("gross_margin_pct", "is_discounted", "price_vs_cat_median")
                if c in out.columns]
             + list(promo) + [f"{c}_enc" for c in ENCODED if c in clean.columns] + ["time_idx"])
    return drop_cold_start(out.select(*order))
