"""Forecasting.

Croston / SBA without a sequential loop: over the non-zero rows of a series
in date order, exponential smoothing seeded by the first value unrolls to a
weighted sum.  For the i-th of n non-zero rows the weight is

    (1 - a)^(n - 1)          if i = 1
    a (1 - a)^(n - i)        otherwise

so  z = sum(w * size),  p = sum(w * gap),  gap_i = pos_i - pos_{i-1}
(pos = 1-based row position in the series, pos_0 = 0), and
rate = max(0, z / max(p, 1) * (1 - a / 2)); a series without demand -> 0.
One window pass (ranks) plus one aggregate per series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandops import SERIES_KEYS
from demandops.functions.numeric import exact_sum, rnd
from demandops.functions.windows import series_window
from demandops.operators.features import calendar_columns

# 30-day horizon, smoothing 0.1, intermittent above 30 % zeros,
# method labels.
HORIZON = 30
ALPHA = 0.1
INTERMITTENT_SHARE = 0.30
CROSTON_METHOD = "Croston/SBA"
FOREST_METHOD = "RandomForest"


def intermittency_class(features: DataFrame, threshold: float = INTERMITTENT_SHARE,
                        target: str = "qty_sold", keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Share of zero-demand rows per series; > threshold -> intermittent."""
    share = F.avg((F.col(target) == 0).cast("double"))
    return (features.groupBy(*keys).agg(share.alias("p_zero"))
                    .withColumn("intermittent", F.col("p_zero") > threshold))


def croston_rates(features: DataFrame, alpha: float = ALPHA, target: str = "qty_sold",
                  keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """One Croston/SBA demand rate per series (closed form)."""
    w = series_window(keys)
    pos = features.select(*keys, "date", target).withColumn("_pos", F.row_number().over(w))
    nz = pos.filter(F.col(target) > 0)
    nz = nz.withColumns({
        "_gap": F.col("_pos") - F.lag("_pos", 1, 0).over(w),
        "_i": F.row_number().over(w),
        "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
    })
    keep = 1.0 - alpha
    weight = F.when(F.col("_i") == 1, F.pow(F.lit(keep), F.col("_n") - 1)) \
              .otherwise(F.lit(alpha) * F.pow(F.lit(keep), F.col("_n") - F.col("_i")))
    smoothed = nz.groupBy(*keys).agg(
        F.sum(weight * F.col(target).cast("double")).alias("_z"),
        F.sum(weight * F.col("_gap").cast("double")).alias("_p"))
    series = features.select(*keys).dropna().distinct()
    rate = F.col("_z") / F.greatest(F.col("_p"), F.lit(1.0)) * F.lit(1.0 - alpha / 2.0)
    return (series.join(smoothed, list(keys), "left")
                  .select(*keys, F.greatest(F.coalesce(rate, F.lit(0.0)), F.lit(0.0)).alias("rate")))


def _horizon_dates(features: DataFrame, horizon: int):
    last = features.agg(F.max("date")).scalar()
    return last, F.sequence(F.date_add(last, 1), F.date_add(last, horizon))


def future_scaffold(features: DataFrame, horizon: int = HORIZON,
                    keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The ``horizon`` dates after the global last date, for every series
    (each series row exploded in place)."""
    _, dates = _horizon_dates(features, horizon)
    return (features.select(*keys).dropna().distinct()
                    .select(*keys, F.explode(dates).alias("forecast_date")))


def croston_forecast(features: DataFrame, alpha: float = ALPHA, horizon: int = HORIZON,
                     keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Flat Croston/SBA forecast for every series (2 dp, as the reference's table)."""
    _, dates = _horizon_dates(features, horizon)
    return croston_rates(features, alpha, keys=keys).select(
        *keys, F.explode(dates).alias("forecast_date"),
        rnd("rate", 2).alias("predicted_qty"), F.lit(CROSTON_METHOD).alias("method"))


def future_features(features: DataFrame, horizon: int = HORIZON,
                    keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The last row of each series repeated over the horizon with the
    calendar columns and date refreshed and time_idx advanced by the days
    since the global last date; lags, rolling, price and promo stay frozen
    (no recursion), as the reference."""
    last_date, dates = _horizon_dates(features, horizon)
    payload = [c for c in features.columns if c not in keys]
    last = (features.groupBy(*keys).agg(F.max_by(F.struct(*payload), "date").alias("_r"))
                    .select(*keys, "_r.*"))
    fut = last.withColumn("_fd", F.explode(dates))
    fut = fut.withColumn("time_idx", F.col("time_idx") + F.datediff("_fd", last_date))
    fut = fut.withColumn("date", F.col("_fd")).drop("_fd")
    return fut.withColumns(calendar_columns()).select(*features.columns)


def forecast_band(forecast: DataFrame, width: float = 0.20, floor_zero: bool = True) -> DataFrame:
    """+-20 % band around each forecast value (lower bound floored at 0)."""
    lo = F.col("predicted_qty") * (1.0 - width)
    return forecast.withColumns({
        "lower": F.greatest(lo, F.lit(0.0)) if floor_zero else lo,
        "upper": F.col("predicted_qty") * (1.0 + width),
    })


def forecast_daily_total(forecast: DataFrame) -> DataFrame:
    """Total forecast per forecast date."""
    return forecast.groupBy("forecast_date").agg(exact_sum("predicted_qty").alias("predicted_qty"))


def hybrid_forecast(features: DataFrame, forest_forecast: DataFrame | None,
                    alpha: float = ALPHA, horizon: int = HORIZON,
                    threshold: float = INTERMITTENT_SHARE,
                    keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Intermittent series -> Croston, the rest -> the model forecast
    (``forest_forecast``, one row per series and date); one row per
    series-day with a ``method`` label."""
    cls = intermittency_class(features, threshold, keys=keys)
    cro = (croston_forecast(features, alpha, horizon, keys)
           .join(cls.filter(F.col("intermittent")).select(*keys), list(keys), "left_semi"))
    if forest_forecast is None:
        return cro
    rest = forest_forecast.join(cls.filter(~F.col("intermittent")).select(*keys), list(keys), "left_semi")
    return cro.unionByName(rest.select(*keys, "forecast_date", "predicted_qty", "method"))
