"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (through the adapter) and runs over the
whole of them.  Query modules register themselves on import; the DuckDB
twin of each exactly checkable query lives in ``plans.oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandops.operators import evaluation as EV
from demandops.operators import features as FE
from demandops.operators import models as MD
from demandops.operators.cleaning import clean_sales, dedup_keep_first
from demandops.operators.forecasting import croston_forecast
from demandops.plans.materialize import memo_artifact, memo_table
from demandops.sources.adapter import sales_fact, sales_raw, with_dimensions
from demandops.sources.tables import table_path

SERIES = ["store_id", "item_id"]

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def input_paths(sf_dir: str) -> list[str]:
    return [table_path(sf_dir, t) for t in ("lineitem", "part", "supplier", "nation", "region")]


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily fact, materialised once per input (stage boundary)."""
    return memo_table(spark, "sales_fact", input_paths(sf_dir), lambda: sales_fact(spark, sf_dir),
                      bucket_by=SERIES, sort_by=["date"])


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_raw(spark, sf_dir)


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-first de-duplication of the line-grain input; the rows that stay
    get their dimensions after it."""
    kept = dedup_keep_first(sales_raw(spark, sf_dir, dimensions=False)).drop("ingest_order")
    return with_dimensions(kept, spark)


def raw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows as a stage: bounded by the (store, item, day) key space
    and read by two consumers (the rows and the per-item medians)."""
    return memo_table(spark, "raw_dedup", input_paths(sf_dir), lambda: first_rows(spark, sf_dir),
                      bucket_by=SERIES, sort_by=["date"])


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's clean table as a stage, derived from the daily fact
    (whose (store, item, date) keys are unique by construction): the price
    imputation runs once per input, and readers scan only their columns."""
    return memo_table(spark, "clean", input_paths(sf_dir),
                      lambda: clean_sales(fact(spark, sf_dir), unique_keys=True),
                      bucket_by=SERIES, sort_by=["date"])


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as a stage (materialised once per input), as the
    reference's features file; consumers (split, baselines, forecasting)
    read it instead of re-deriving the windows in every subquery."""
    return memo_table(spark, "features", input_paths(sf_dir),
                      lambda: FE.engineer_features(clean(spark, sf_dir)),
                      bucket_by=SERIES, sort_by=["date"])


def croston_fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic forecast stage for every series (Croston/SBA, 30 days)."""
    return memo_table(spark, "forecast_croston", input_paths(sf_dir),
                      lambda: croston_forecast(features(spark, sf_dir)),
                      bucket_by=SERIES, sort_by=["forecast_date"])


def forest_model(spark: SparkSession, sf_dir: str):
    """The trained forest as a stage: fitted once per input on the training
    split of the feature stage, saved with its test metrics (S4) and loaded
    back.  Returns (model, path)."""
    def fit_and_save(path: str) -> None:
        f = features(spark, sf_dir)
        train, _ = EV.train_test(f)
        model = MD.train_forest(train, FE.feature_columns(f))
        metrics = EV.forecast_metrics(MD.predict_clipped(model, EV.seasonal_naive(f)))
        MD.save_model(model, path, metrics, FE.feature_columns(f))

    path = memo_artifact(spark, "forest", input_paths(sf_dir), fit_and_save)
    return MD.load_model(path), path


def boosted_model(spark: SparkSession, sf_dir: str):
    """The boosted trees as a stage, fitted as the forest is.  Returns (model, path)."""
    def fit_and_save(path: str) -> None:
        f = features(spark, sf_dir)
        train, _ = EV.train_test(f)
        MD.save_model(MD.train_boosted(train, FE.feature_columns(f)), path, feature_cols=FE.feature_columns(f))

    path = memo_artifact(spark, "boosted", input_paths(sf_dir), fit_and_save)
    return MD.load_model(path), path


def all_queries() -> dict[str, QueryFn]:
    from demandops.plans import (  # noqa: F401  (registration side effects)
        q_sources, q_inventory, q_explore, q_features, q_forecast, q_models, q_dense)
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    from demandops.plans.oracle import ORACLE
    return dict(ORACLE)
