"""Stage runner (S6): the reference's seven-step batch flow as Spark stages.

Each stage is a DataFrame -> DataFrame step whose output is written as
Parquet under one run folder (inside the shared checkpoint dir by default)
and read back by the next stage, like the reference's CSV hand-offs.
Steps can be run alone: an existing stage table is reused unless
``recompute`` names it.  Nothing passes through the driver except scalars
and model metadata.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandops.operators import cleaning as C
from demandops.operators import dims as D
from demandops.operators import evaluation as EV
from demandops.operators import explore as E
from demandops.operators import features as FE
from demandops.operators import forecasting as FC
from demandops.operators import insights as K
from demandops.operators import inventory as I
from demandops.operators import models as MD
from demandops.operators import quality as Q
from demandops.sources.fs import path_exists
from demandops.session import stage_root
from demandops.sources.io import load_stage, write_stage

STEPS = ("clean", "explore", "features", "model", "forecast", "inventory", "insights")

#: Stages that a rebuilt stage makes stale, beside all that follow from those.
FEEDS = {"deduplicated": ("clean",), "clean": ("weekly", "eda", "dense", "features", "policy", "report"),
         "dense": ("features",), "features": ("model", "forecast"), "model": ("forecast",),
         "forecast": ("policy", "kpis"), "policy": ("alerts", "kpis", "report")}


def stale_after(names: Iterable[str]) -> set[str]:
    """``names`` and every stage family that is derived from them."""
    found, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += FEEDS.get(name, ())
    return found


class StageRun:
    """One run folder; ``table(name)`` reads a stage, ``put`` writes one."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or os.path.join(stage_root(spark, "runs"), uuid.uuid4().hex[:12])

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def has(self, name: str) -> bool:
        """A stage is there when its write was committed, not when its folder is."""
        return path_exists(self.spark, os.path.join(self.path(name), "_SUCCESS"))

    def has_model(self) -> bool:
        """The fitted pipeline and its metrics, both committed."""
        return self.has("model_metrics") and self.has(os.path.join("model", "metadata"))

    def put(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        write_stage(df, self.root, name, partition_by=partition_by)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return load_stage(self.spark, self.root, name)


def run_stages(spark: SparkSession, sales: Callable[[], DataFrame],
               steps: Sequence[str] = STEPS, root: str | None = None,
               recompute: Sequence[str] = (), service: float = 0.95,
               forest_params: dict | None = None, dense: bool = False,
               holiday_month_days: Sequence[str] | None = None,
               festival_windows: Sequence[tuple[str, str]] | None = None,
               forecaster: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Run the chosen steps in order; return every stage table produced or
    reused, keyed by name (each read back from the run folder).

    ``dense=True`` zero-fills each series' gaps (``dims.densify``, calendar
    flags recomputed from the given rules) before features, so zero shares
    and the Croston branch of the forecast are meaningful on sparse data;
    the inventory step keeps using the observed clean history.

    ``forecaster`` replaces the forecast step: it gets the feature table and
    returns one row per series and date (keys, forecast_date, predicted_qty,
    method), e.g. ``forecasting.croston_forecast``; no model is needed then."""
    run = StageRun(spark, root)
    out: dict[str, DataFrame] = {}
    rebuilt = set(recompute)

    def stale(name: str) -> bool:
        """Named for a rebuild, or derived from a stage that this run rebuilt."""
        return bool({name, name.split("_")[0]} & stale_after(rebuilt))

    def stage(name: str, build: Callable[[], DataFrame], partition_by: str | None = None) -> DataFrame:
        if run.has(name) and not stale(name):
            out[name] = run.table(name)
        else:
            out[name] = run.put(name, build(), partition_by)
            rebuilt.add(name)
        return out[name]

    def need(name: str) -> DataFrame:
        if name in out:
            return out[name]
        if run.has(name):
            out[name] = run.table(name)
            return out[name]
        raise ValueError(f"stage {name!r} is neither run nor present in {run.root}")

    for step in steps:
        if step == "clean":
            raw = sales()
            stage("quality", lambda: Q.quality_report(raw))
            Q.required_columns(raw)
            # keep-first de-duplication is its own stage (bounded by the key
            # space; read by both the clean rows and the per-item medians)
            kept = stage("deduplicated", lambda: C.dedup_keep_first(raw).drop(
                *[c for c in ("ingest_order",) if c in raw.columns]))
            stage("clean", lambda: C.clean_sales(kept, unique_keys=True), partition_by="store_id")
            stage("weekly", lambda: C.weekly_rollup(need("clean")))
        elif step == "explore":
            c = need("clean")
            for name, fn in (("daily_trend", E.daily_sales_trend), ("category_units", E.category_units),
                             ("store_monthly", E.store_monthly_units), ("dow_average", E.dow_average),
                             ("promo_lift", E.promo_lift_by_category), ("top_skus", E.top_skus_by_revenue),
                             ("zero_share", E.zero_demand_share), ("correlation", E.correlation_matrix),
                             ("revenue_heatmap", lambda d: E.revenue_heatmap(d, long=True)),
                             ("qty_distribution", E.qty_distribution), ("eda_summary", E.eda_summary)):
                stage(f"eda_{name}", lambda fn=fn: fn(c))
        elif step == "features":
            base = need("clean")
            if dense:
                base = stage("dense", lambda: D.densify(base, holiday_month_days=holiday_month_days,
                                                          festival_windows=festival_windows))
            stage("features", lambda: FE.engineer_features(base))
        elif step == "model":
            f = need("features")
            cols = FE.feature_columns(f)
            model_path = run.path("model")
            if run.has_model() and not stale("model"):
                model = MD.load_model(model_path)
            else:
                train, _ = EV.train_test(f)
                model = MD.train_forest(train, cols, **(forest_params or {}))
                metrics = EV.forecast_metrics(MD.predict_clipped(model, EV.seasonal_naive(f)))
                MD.save_model(model, model_path, metrics, cols)
                rebuilt.add("model")
            out["model_metrics"] = spark.read.parquet(model_path + "_metrics")
            out["_model"] = model  # type: ignore[assignment]
            tested = MD.predict_clipped(model, EV.seasonal_naive(f))
            stage("model_category_mae", lambda: EV.mae_by_category(tested))
            stage("model_importances", lambda: MD.feature_importance_topn(model, cols))
            stage("model_daily", lambda: EV.actual_vs_predicted_daily(tested))
            stage("model_benchmark", lambda: EV.model_benchmark(EV.baseline_predictions(f)))
        elif step == "forecast":
            f = need("features")

            def hybrid() -> DataFrame:
                model = out.get("_model")
                if model is None and run.has_model():
                    model = MD.load_model(run.path("model"))
                forest = MD.forest_forecast(model, FC.future_features(f)) if model is not None else None
                return FC.hybrid_forecast(f, forest)
            stage("forecast", lambda: forecaster(f) if forecaster else hybrid())
        elif step == "inventory":
            c, fc = need("clean"), need("forecast")
            p = stage("policy", lambda: I.inventory_policy(c, fc, service=service))
            stage("alerts", lambda: I.reorder_alerts(p))
        elif step == "insights":
            stage("kpis", lambda: K.kpi_table(need("clean"), need("policy"), need("forecast")))
            stage("report_policy", lambda: K.report_policy_table(need("policy")))
            stage("report_alerts", lambda: K.report_alert_table(need("policy")))
            stage("report_revenue_trend", lambda: K.daily_revenue_trend(need("clean")))
            stage("report_revenue_share", lambda: K.category_revenue_share(need("clean")))
            stage("report_recent", lambda: K.recent_actuals(need("clean")))
        else:
            raise ValueError(f"unknown step {step!r}")
    out.pop("_model", None)
    return out


def stage_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) for every produced table — one small job per stage."""
    spark = next(iter(tables.values())).sparkSession
    parts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("stage"), "rows")
             for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
