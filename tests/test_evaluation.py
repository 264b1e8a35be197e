"""Metrics and correlations against brute-force numpy / pandas."""

import numpy as np
import pandas as pd

from demandops.operators import evaluation as EV
from demandops.operators import explore as E
from tests.conftest import fact_rows


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 20, 300)
    yhat = rng.random(300) * 20
    naive = rng.integers(0, 20, 300).astype(float)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, yhat, naive)],
                               "qty_sold bigint, predicted double, naive double")
    m = EV.forecast_metrics(df).first()
    mae = np.abs(y - yhat).mean()
    mask = y > 0
    assert m.MAE == round(mae, 2)
    assert m.RMSE == round(float(np.sqrt(((y - yhat) ** 2).mean())), 2)
    assert m.MAPE == round(float(np.mean(np.abs((y[mask] - yhat[mask]) / y[mask])) * 100), 2)
    assert m.MASE == round(mae / np.abs(y - naive).mean(), 4)


def test_mase_null_when_naive_perfect(spark):
    df = spark.createDataFrame([(3, 2.0, 3.0), (4, 5.0, 4.0)],
                               "qty_sold bigint, predicted double, naive double")
    assert EV.forecast_metrics(df).first().MASE is None


def test_time_split_and_seasonal_naive(spark, make_fact):
    rows = fact_rows("S", "A", list(range(1, 101)))
    df = make_fact(rows)
    s = {r.split for r in EV.time_split(df, 60).collect()}
    assert s == {"train", "test"}
    test = EV.seasonal_naive(df, rows=28, test_days=60).orderBy("date").collect()
    assert len(test) == 60
    assert [r.naive for r in test[:28]] == [0.0] * 28          # inside the test slice only
    assert test[28].naive == float(test[0].qty_sold)
    full = EV.seasonal_naive(df, rows=28, history="full", test_days=60).orderBy("date").collect()
    assert full[0].naive == float(full[0].qty_sold - 28)


def test_correlations_match_pandas(spark, make_fact):
    rng = np.random.default_rng(4)
    q = [int(x) for x in rng.integers(0, 30, 80)]
    rows = fact_rows("S", "A", q, promo=[int(x) for x in rng.integers(0, 2, 80)])
    rows = [r[:6] + (float(rng.random() * 10),) + r[7:9] + (int(rng.integers(0, 100)),) + r[10:]
            for r in rows]
    df = make_fact(rows)
    got = {(r.var_a, r.var_b): r.corr for r in E.correlation_matrix(
        df, ["qty_sold", "price", "on_promo", "stock_on_hand"]).collect()}
    pdf = df.select("qty_sold", "price", "on_promo", "stock_on_hand").toPandas().astype(float)
    exp = pdf.corr()
    for (a, b), v in got.items():
        assert abs(v - exp.loc[a, b]) < 1e-9
    assert len(got) == 6
    assert isinstance(exp, pd.DataFrame)
