"""Croston closed form vs the sequential recursion; forecast scaffolds."""

import numpy as np

from demandops.operators import forecasting as FC
from tests.conftest import day


def croston_recursive(y, alpha=0.1):
    """Brute-force statement of the semantics: smooth sizes and gaps."""
    idx = [i for i, v in enumerate(y) if v > 0]
    if not idx:
        return 0.0
    sizes = [y[i] for i in idx]
    gaps = [idx[0] + 1] + [idx[k] - idx[k - 1] for k in range(1, len(idx))]
    z, p = sizes[0], gaps[0]
    for v in sizes[1:]:
        z = alpha * v + (1 - alpha) * z
    for g in gaps[1:]:
        p = alpha * g + (1 - alpha) * p
    return max(0.0, z / max(p, 1) * (1 - alpha / 2))


def _series(spark, data):
    rows = [(s, "P", day(i), int(v)) for s, ys in data.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "store_id string, item_id string, date date, qty_sold bigint")


def test_closed_form_matches_recursion(spark):
    rng = np.random.default_rng(7)
    data = {"known": [0, 0, 5, 0, 0, 3, 0, 8, 0, 0], "zeros": [0] * 50, "dense": [4, 5, 6, 7]}
    for k in range(40):
        n = int(rng.integers(1, 300))
        data[f"r{k}"] = list((rng.random(n) < rng.random()) * rng.integers(1, 30, n))
    got = {r.store_id: r.rate for r in FC.croston_rates(_series(spark, data)).collect()}
    for k, ys in data.items():
        assert abs(got[k] - croston_recursive(ys)) < 1e-9 * max(1.0, got[k]), k
    assert got["zeros"] == 0.0


def test_forecast_shape(spark):
    df = _series(spark, {"a": [0, 0, 5, 0, 0, 3, 0, 8, 0, 0] * 10, "b": [1, 2, 3]})
    fc = FC.croston_forecast(df, horizon=14)
    assert fc.count() == 28
    assert fc.filter("predicted_qty < 0").count() == 0
    dates = sorted({r.forecast_date for r in fc.collect()})
    assert dates[0] == day(100) and len(dates) == 14


def test_intermittency(spark):
    df = _series(spark, {"a": [0, 0, 0, 1], "b": [1, 1, 1, 0]})
    got = {r.store_id: r.intermittent for r in FC.intermittency_class(df).collect()}
    assert got == {"a": True, "b": False}
