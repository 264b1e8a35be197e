"""Plan shape (pruning, push-down, single scans) and the stage runner."""

from pyspark.sql import functions as F

from demandops.operators.insights import filter_slice
from demandops.plans.catalog import clean, features, fact
from demandops.plans.stages import run_stages
from demandops.sources.adapter import sales_fact
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_adapter_reads_only_needed_lineitem_columns(spark):
    plan = sales_fact(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    li = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    for unused in ("l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in li
    assert plan.count("lineitem.parquet") == 1


def _formatted(df):
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def test_slice_filter_reaches_the_scan(spark):
    df = filter_slice(clean(spark, SF_SMALL), store="EUROPE", category="Core")
    plan = _formatted(df)
    assert "EqualTo(store_id,EUROPE)" in plan and "EqualTo(category,Core)" in plan


def test_features_plan_does_not_rescan_lineitem(spark):
    df = features(spark, SF_SMALL)
    df.count()
    assert "lineitem.parquet" not in _plan(df)


def test_stage_runner_reuses_stages(spark, tmp_path):
    from demandops.plans.catalog import raw
    root = str(tmp_path / "run")
    sales = lambda: raw(spark, SF_SMALL)
    out = run_stages(spark, sales, root=root, forest_params={"numTrees": 5, "maxDepth": 4})
    for name in ("quality", "deduplicated", "clean", "weekly", "features", "forecast", "policy",
                 "alerts", "kpis", "model_metrics", "eda_daily_trend"):
        assert name in out, name
    n_series = out["features"].select("store_id", "item_id").distinct().count()
    assert out["forecast"].count() == n_series * 30
    assert out["kpis"].count() == 12
    # second run reuses every stage table (no sales input needed)
    again = run_stages(spark, lambda: 1 / 0, root=root,
                       steps=("features", "forecast", "inventory", "insights"))
    assert again["policy"].count() == out["policy"].count()


def test_fact_is_materialised_once(spark):
    a = fact(spark, SF_SMALL).inputFiles()
    b = fact(spark, SF_SMALL).inputFiles()
    assert a == b and F is not None


def test_nation_brand_grain(spark):
    from demandops.operators.cleaning import clean_sales
    from demandops.operators.inventory import inventory_policy
    f = sales_fact(spark, SF_SMALL, grain="nation_brand")
    n_series = f.select("store_id", "item_id").distinct().count()
    assert 25 < n_series <= 625
    assert f.groupBy("store_id", "item_id", "date").count().filter("count > 1").count() == 0
    pol = inventory_policy(clean_sales(f, unique_keys=True))
    assert pol.count() <= n_series and pol.filter("EOQ IS NULL").count() == 0


def test_memo_rebuilds_when_input_changes(spark, tmp_path):
    import time as _t
    from demandops.plans.materialize import memo_table
    src = str(tmp_path / "in.parquet")
    spark.range(5).write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src).withColumn("store_id", F.lit("S")).withColumn(
            "item_id", F.lit("I"))

    a = memo_table(spark, "t", [src], build, bucket_by=["store_id", "item_id"], sort_by=["id"])
    b = memo_table(spark, "t", [src], build, bucket_by=["store_id", "item_id"], sort_by=["id"])
    assert len(calls) == 1 and a.count() == b.count() == 5
    _t.sleep(1.1)
    spark.range(7).write.mode("overwrite").parquet(src)
    c = memo_table(spark, "t", [src], build, bucket_by=["store_id", "item_id"], sort_by=["id"])
    assert len(calls) == 2 and c.count() == 7


def test_hot_key_aggregates_combine_before_the_shuffle(spark):
    from demandops.operators import cleaning as C
    from demandops.operators import quality as Q
    from demandops.sources.adapter import sales_raw
    raw = sales_raw(spark, SF_SMALL)
    hot = F.col("ingest_order.l_orderkey") % 3 == 0
    skewed = raw.withColumns({c: F.when(hot, F.lit("HOT")).otherwise(F.col(c))
                              for c in ("store_id", "item_id")})
    for df in (C.dedup_keep_first(skewed), Q.quality_report(skewed), C.clean_audit(skewed)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        partial = plan.find("partial_")
        assert partial != -1                      # map-side partial aggregate exists
        assert "Window" not in plan               # no per-key window over the raw rows
    assert C.dedup_keep_first(skewed).filter("store_id = 'HOT'").count() < 3000


def test_stage_runner_dense_uses_croston(spark, tmp_path):
    from demandops.plans.catalog import raw
    from demandops.sources import adapter as A
    out = run_stages(spark, lambda: raw(spark, SF_SMALL),
                     root=str(tmp_path / "dense"), forest_params={"numTrees": 5, "maxDepth": 4},
                     steps=("clean", "features", "model", "forecast", "inventory"), dense=True,
                     holiday_month_days=A.HOLIDAY_MONTH_DAYS, festival_windows=A.FESTIVAL_WINDOWS)
    methods = {r.method for r in out["forecast"].select("method").distinct().collect()}
    assert "Croston/SBA" in methods
    assert out["dense"].count() > out["clean"].count()
    assert out["policy"].count() == 30


def test_stamp_follows_files_below_a_folder(spark, tmp_path):
    from demandops.sources.fs import fingerprint
    src = str(tmp_path / "parts.parquet")
    spark.range(3).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(src)
    before = fingerprint(spark, [src])
    spark.range(2).write.mode("append").parquet(f"{src}/p=1")
    assert fingerprint(spark, [src]) != before
    assert fingerprint(spark, [src, str(tmp_path / "absent")]) is None


def test_half_written_stages_are_not_reused(spark, tmp_path):
    from demandops.plans.stages import StageRun, stale_after
    run = StageRun(spark, str(tmp_path))
    run.put("clean", spark.range(3))
    assert run.has("clean") and not run.has("weekly")
    (tmp_path / "clean" / "_SUCCESS").unlink()
    assert not run.has("clean")
    assert {"features", "model", "forecast", "policy", "alerts", "kpis"} <= stale_after(["clean"])
    assert "clean" not in stale_after(["features"])


def test_a_given_forecaster_replaces_the_model(spark, tmp_path):
    from demandops.operators.forecasting import croston_forecast
    from demandops.plans.catalog import raw
    out = run_stages(spark, lambda: raw(spark, SF_SMALL), root=str(tmp_path / "fixed"),
                     steps=("clean", "features", "forecast", "inventory"), forecaster=croston_forecast)
    assert "model_metrics" not in out and out["policy"].count() == 30
    want = croston_forecast(out["features"])
    assert out["forecast"].exceptAll(want.select(*out["forecast"].columns)).count() == 0
    assert out["forecast"].count() == want.count()
