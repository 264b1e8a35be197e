"""Splitting and evaluation.

Metrics are one aggregate over (actual, predicted[, naive]) rows.  Means go
through exact decimal sums, so a metric does not depend on how the rows are
partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops import SERIES_KEYS
from demandops.functions.numeric import exact_mean, exact_sum, rnd
from demandops.functions.windows import series_window, strict_rolling

# 60-day holdout, seasonal naive 28 rows back.
TEST_DAYS = 60
SEASON_ROWS = 28


def time_split(df: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """M1: cutoff = global max(date) - test_days; 'train' <= cutoff < 'test'.
    The global max is a scalar subquery (computed once, no join)."""
    cutoff = F.date_sub(df.agg(F.max("date")).scalar(), test_days)
    return df.withColumn("split", F.when(F.col("date") <= cutoff, "train").otherwise("test"))


def train_test(df: DataFrame, test_days: int = TEST_DAYS) -> tuple[DataFrame, DataFrame]:
    s = time_split(df, test_days)
    return (s.filter(F.col("split") == "train").drop("split"),
            s.filter(F.col("split") == "test").drop("split"))


def seasonal_naive(df: DataFrame, rows: int = SEASON_ROWS, target: str = "qty_sold",
                   history: str = "test", test_days: int = TEST_DAYS,
                   keys: Sequence[str] = SERIES_KEYS, out: str = "naive") -> DataFrame:
    """M4: target ``rows`` rows earlier within the series, missing -> 0.

    ``history='test'`` reproduces the reference (lag taken inside the test
    slice only); ``history='full'`` lags over the whole history first."""
    w = series_window(keys)
    if history == "full":
        s = time_split(df, test_days).withColumn(
            out, F.coalesce(F.lag(target, rows).over(w).cast("double"), F.lit(0.0)))
        return s.filter(F.col("split") == "test").drop("split")
    _, test = train_test(df, test_days)
    return test.withColumn(out, F.coalesce(F.lag(target, rows).over(w).cast("double"), F.lit(0.0)))


def naive_lag1(target: str = "qty_sold", keys: Sequence[str] = SERIES_KEYS) -> Column:
    """Previous observed value of the series."""
    return F.lag(target, 1).over(series_window(keys)).cast("double")


def moving_average_7(target: str = "qty_sold", keys: Sequence[str] = SERIES_KEYS) -> Column:
    """Mean of the previous 7 rows (strict) - the rollmean_7 feature."""
    return strict_rolling(target, 7, F.avg, keys)


def metric_columns(y: str = "qty_sold", yhat: str = "predicted", naive: str | None = "naive") -> list[Column]:
    """M5 as aggregate expressions: MAE, RMSE, MAPE over y > 0, MASE."""
    err = F.col(y).cast("double") - F.col(yhat).cast("double")
    mae = exact_mean(F.abs(err))
    out = [
        rnd(mae, 2).alias("MAE"),
        rnd(F.sqrt(exact_mean(err * err)), 2).alias("RMSE"),
        rnd(exact_mean(F.when(F.col(y) > 0, F.abs(err / F.col(y).cast("double")))) * 100.0, 2)
        .alias("MAPE"),
    ]
    if naive is not None:
        naive_mae = exact_mean(F.abs(F.col(y).cast("double") - F.col(naive).cast("double")))
        out.append(rnd(F.when(naive_mae > 0, mae / naive_mae), 4).alias("MASE"))
    else:
        out.append(F.lit(None).cast("double").alias("MASE"))
    return out


def forecast_metrics(df: DataFrame, y: str = "qty_sold", yhat: str = "predicted",
                     naive: str | None = "naive", by: Sequence[str] = ()) -> DataFrame:
    """M5 (and M10-M12 with ``by``): MAE, RMSE, MAPE (y > 0), MASE."""
    cols = metric_columns(y, yhat, naive)
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def mae_by_category(df: DataFrame, y: str = "qty_sold", yhat: str = "predicted") -> DataFrame:
    """M6"""
    err = F.abs(F.col(y).cast("double") - F.col(yhat).cast("double"))
    return df.groupBy("category").agg(rnd(exact_mean(err), 2).alias("MAE"))


def actual_vs_predicted_daily(df: DataFrame, y: str = "qty_sold", yhat: str = "predicted") -> DataFrame:
    """M8: per date total actual and total predicted."""
    return df.groupBy("date").agg(F.sum(y).alias("actual"), exact_sum(yhat).alias("predicted"))


def clip_prediction(df: DataFrame, col: str = "predicted") -> DataFrame:
    """M3 (floor part): max(0, prediction)."""
    return df.withColumn(col, F.greatest(F.col(col), F.lit(0.0)))


def baseline_predictions(features: DataFrame, test_days: int = TEST_DAYS,
                         keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Long (model, keys, date, category, item, y, y_hat, naive) rows of the
    deterministic baselines on the test slice: naive lag-1 (M9a), moving
    average 7 (M9b).  The seasonal naive (M4) is the MASE scale."""
    test = seasonal_naive(features, history="test", test_days=test_days, keys=keys)
    base = test.select(
        *keys, "date", "category", "qty_sold", "naive",
        F.col("lag_1").cast("double").alias("naive_lag1"),
        F.col("rollmean_7").cast("double").alias("moving_average_7"))
    models = ["naive_lag1", "moving_average_7"]
    long = base.select(*keys, "date", "category", "qty_sold", "naive", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in models
    ])).alias("m")).select(*keys, "date", "category", "qty_sold", "naive", "m.*")
    return long


def model_benchmark(predictions: DataFrame, reference_model: str = "naive_lag1") -> DataFrame:
    """One metrics row per model plus MAPE improvement vs a reference."""
    m = forecast_metrics(predictions, by=["model"])
    ref = m.filter(F.col("model") == reference_model).select("MAPE").scalar()
    return m.withColumn("mape_improvement_pct",
                        rnd(F.try_divide(ref - F.col("MAPE"), ref) * 100.0, 2))


def error_analysis(predictions: DataFrame) -> DataFrame:
    """Error metrics per model and SKU."""
    return forecast_metrics(predictions, naive=None, by=["model", "item_id"]).drop("MASE")


def category_error_table(predictions: DataFrame) -> DataFrame:
    """MAE and MAPE per model and category."""
    return forecast_metrics(predictions, naive=None, by=["model", "category"]).select(
        "model", "category", "MAE", "MAPE")
