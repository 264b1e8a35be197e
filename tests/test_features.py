"""Feature engineering: strict windows, cold start, no leakage across series."""

import numpy as np
import pandas as pd

from demandops.operators import features as FE
from demandops.operators.cleaning import week_start
from tests.conftest import fact_rows


def _clean(make_fact, rows):
    return week_start(make_fact(rows))


def test_57_columns_and_no_nulls(spark, make_fact):
    rng = np.random.default_rng(0)
    rows = fact_rows("S", "A", [int(x) for x in rng.integers(0, 20, 60)])
    f = FE.engineer_features(_clean(make_fact, rows))
    assert len(f.columns) == 57
    assert len(FE.feature_columns(f)) == 48
    assert f.count() == 60 - 28
    assert f.dropna().count() == f.count()


def test_short_series(spark, make_fact):
    rows = fact_rows("S", "S27", list(range(1, 28))) + fact_rows("S", "S29", list(range(1, 30)))
    f = FE.engineer_features(_clean(make_fact, rows))
    counts = {r.item_id: r["count"] for r in f.groupBy("item_id").count().collect()}
    assert counts == {"S29": 1}


def test_windows_do_not_leak_across_series(spark, make_fact):
    long = fact_rows("S", "A", [100] * 40)
    short = fact_rows("S", "B", list(range(1, 31)))
    f = FE.engineer_features(_clean(make_fact, long + short)).filter("item_id = 'B'").collect()
    assert len(f) == 2
    first = sorted(f, key=lambda r: r.date)[0]
    assert first.lag_1 == 28 and first.rollmax_28 == 28 and first.rollmin_28 == 1


def test_rolling_matches_pandas(spark, make_fact):
    rng = np.random.default_rng(1)
    qty = [int(x) for x in rng.integers(0, 50, 45)]
    df = _clean(make_fact, fact_rows("S", "A", qty))
    out = FE.rolling_features(FE.lag_features(df)).orderBy("date").toPandas()
    s = pd.Series(qty, dtype=float).shift(1)
    for w in FE.WINDOWS:
        exp = s.rolling(w).std().to_numpy()
        got = out[f"rollstd_{w}"].to_numpy(dtype=float)
        assert np.allclose(np.nan_to_num(exp, nan=-1), np.nan_to_num(got, nan=-1))
        assert np.allclose(np.nan_to_num(s.rolling(w).mean().to_numpy(), nan=-1),
                           np.nan_to_num(out[f"rollmean_{w}"].to_numpy(dtype=float), nan=-1))


def test_calendar(spark, make_fact):
    df = _clean(make_fact, fact_rows("S", "A", [1] * 7))      # Mon 2024-01-01 .. Sun
    r = {x.date.isoweekday(): x for x in FE.calendar_features(df).collect()}
    assert r[1].dow == 0 and r[7].dow == 6 and r[6].is_weekend == 1 and r[5].is_weekend == 0
    assert r[1].week_of_year == 1 and r[1].quarter == 1
    assert abs(r[1].sin_doy - np.sin(2 * np.pi * 1 / 365)) < 1e-12


def test_label_encode_null_and_order(spark):
    df = spark.createDataFrame([("b", "x", "k"), ("a", None, "k"), ("c", "y", None)],
                               "store_id string, item_id string, category string")
    out = {r.store_id: r for r in FE.label_encode(df).collect()}
    assert [out[s].store_id_enc for s in "abc"] == [0, 1, 2]
    assert out["a"].item_id_enc == -1 and out["b"].item_id_enc == 0 and out["c"].item_id_enc == 1
    assert out["c"].category_enc == -1


def test_one_exchange_for_all_series_windows(spark, make_fact):
    df = _clean(make_fact, fact_rows("S", "A", list(range(40))))
    out = df.withColumns({**FE.lag_columns(), **FE.rolling_columns(), **FE.promo_columns(),
                          **FE.time_index_column()})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_zero_price_gives_null_margin_not_error(spark, make_fact):
    rows = fact_rows("S", "Z", [5] * 40, price=0.0, cost=0.0)
    df = _clean(make_fact, rows)
    out = FE.price_features(df).select("gross_margin_pct", "price_vs_cat_median").collect()
    assert all(r.gross_margin_pct is None for r in out)
    assert all(r.price_vs_cat_median == 0.0 for r in out)
    assert FE.engineer_features(df).count() == 0      # NULL margin -> dropped with cold start


def test_dense_codes_distributed_path(spark):
    from pyspark.sql import functions as F
    from demandops.functions.ranking import dense_codes
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 1009).cast("string").alias("v"))
    exp = {v: i for i, v in enumerate(sorted({str(i * 7919 % 1009) for i in range(3000)}))}
    try:
        spark.conf.set("demandops.broadcast.maxRows", "0")   # force the range path
        got = {r.v: r.c for r in dense_codes(df, "v", "c", ranges=5).collect()}
    finally:
        spark.conf.unset("demandops.broadcast.maxRows")
    assert got == exp
