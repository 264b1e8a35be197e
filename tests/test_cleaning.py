import pytest

"""Quality checks and cleaning on hand-built dirty frames."""

import datetime as dt

from pyspark.sql import functions as F

from demandops.operators import cleaning as C
from demandops.operators import quality as Q
from tests.conftest import FACT_DDL, day, fact_rows

RAW_DDL = FACT_DDL + ", ingest_order int"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_DDL)


def _row(i, d, store, item, qty, price=10.0, stockout=0, promo=0):
    return (d, store, item, "n", "c", qty, price, promo, 0.0, 5, stockout, 1.0, 1, 1, 1, 1.0, 0.2,
            0, 0, i)


def test_dedup_keeps_first_in_ingest_order(spark):
    rows = [_row(2, day(0), "S", "A", 7), _row(1, day(0), "S", "A", 3), _row(3, day(0), "S", "A", 9)]
    out = C.dedup_keep_first(_raw(spark, rows)).collect()
    assert len(out) == 1 and out[0].qty_sold == 3


def test_null_keys_group_together(spark):
    rows = [_row(1, day(0), None, "A", 1), _row(2, day(0), None, "A", 2)]
    df = _raw(spark, rows)
    assert C.dedup_keep_first(df).count() == 1
    assert Q.quality_summary(df).first().duplicate_rows == 1


def test_clip_keeps_null(spark):
    rows = [_row(1, day(0), "S", "A", -4), _row(2, day(1), "S", "A", None)]
    out = {r.date: r.qty_sold for r in C.clip_negative(_raw(spark, rows)).collect()}
    assert out[day(0)] == 0 and out[day(1)] is None


def test_censor_drops_unknown_flag(spark):
    rows = [_row(1, day(0), "S", "A", 1, stockout=0), _row(2, day(1), "S", "A", 1, stockout=1),
            _row(3, day(2), "S", "A", 1, stockout=None)]
    assert C.censor_stockouts(_raw(spark, rows)).count() == 1


def test_median_after_filters(spark):
    # the stock-out row's price must not enter the median
    rows = [_row(1, day(0), "S", "A", 1, price=10.0), _row(2, day(1), "S", "A", 1, price=20.0),
            _row(3, day(2), "S", "A", 1, price=1000.0, stockout=1),
            _row(4, day(3), "T", "A", 1, price=None)]
    out = C.clean_sales(_raw(spark, rows))
    filled = out.filter(F.col("store_id") == "T").first().price
    assert filled == 15.0


def test_quality_report(spark):
    rows = [_row(1, day(0), "S", "A", 1), _row(2, day(0), "S", "A", -1),
            _row(3, day(1), "S", "A", None, stockout=1)]
    rep = {r.check: (r.value, r.status) for r in Q.quality_report(_raw(spark, rows)).collect()}
    assert rep["total_rows"] == (3.0, "pass")
    assert rep["duplicate_rows"] == (1.0, "warn")
    assert rep["missing_qty"] == (1.0, "warn")
    assert rep["negative_qty"] == (1.0, "warn")
    assert rep["pct_stockout"][0] == round(100 / 3, 2)


def test_required_columns_raise(spark):
    df = spark.createDataFrame([(1,)], "store_id int")
    with pytest.raises(ValueError):
        Q.required_columns(df)
    report = {r.check: (r.value, r.status) for r in Q.quality_report(df).collect()}
    assert report["missing_columns"] == (3.0, "warn") and report["total_rows"] == (1.0, "pass")


def test_clean_audit(spark):
    rows = [_row(1, day(0), "S", "A", 1), _row(2, day(0), "S", "A", 2),
            _row(3, day(1), "S", "A", None), _row(4, day(2), "S", "A", 3, stockout=1)]
    a = C.clean_audit(_raw(spark, rows)).first()
    assert (a.rows_before, a.rows_after_dedup, a.removed_stockout, a.rows_after, a.removed_total) == \
        (4, 3, 1, 1, 3)


def test_week_start_monday(spark, make_fact):
    df = make_fact(fact_rows("S", "A", [1] * 7, start=0))   # 2024-01-01 is a Monday
    ws = {r.date: r.week_start for r in C.week_start(df).collect()}
    assert all(v == dt.date(2024, 1, 1) for v in ws.values())


def test_weekly_first_non_null(spark, make_fact):
    rows = fact_rows("S", "A", [1, 2, 3], start=0)
    rows[0] = rows[0][:11] + (None,) + rows[0][12:]          # unit_cost NULL on the first day
    rows[1] = rows[1][:11] + (7.0,) + rows[1][12:]
    w = C.weekly_rollup(make_fact(rows)).first()
    assert w.unit_cost == 7.0 and w.qty_sold == 6


def test_dedup_needs_an_order_and_keeps_a_good_first_row(spark):
    rows = [_row(1, day(0), "S", "A", 7), _row(2, day(0), "S", "A", None), _row(3, day(0), "S", "A", -4)]
    df = _raw(spark, rows)
    assert [r.qty_sold for r in C.dedup_keep_first(df).collect()] == [7]
    with pytest.raises(ValueError, match="ingest order"):
        C.dedup_keep_first(df.drop("ingest_order"))


def test_load_sales_gives_the_ingest_order(spark, tmp_path):
    from demandops.sources.io import load_sales, write_stage
    df = _raw(spark, [_row(i, day(0), "S", "A", 10 - i) for i in range(5)]).drop("ingest_order").coalesce(1)
    for fmt in ("parquet", "csv"):
        path = write_stage(df, str(tmp_path), fmt, fmt=fmt)
        kept = C.dedup_keep_first(load_sales(spark, path, fmt=fmt, ingest_order=True)).collect()
        assert [r.qty_sold for r in kept] == [10]


def test_pruning_keeps_what_the_whole_order_needs(spark):
    """Struct orders: ties on the leading field, a NULL leading field (first),
    a NULL order (never first), against ``min_by`` over all rows."""
    rows = [("a", 2, 1, 10), ("a", 1, 9, 11), ("a", 1, 3, 12), ("a", 5, 0, 13),
            ("b", 4, 1, 20), ("b", None, 7, 21), ("b", None, 6, 22),
            (None, 3, 1, 30), (None, 3, 0, 31), ("c", 8, 8, 40)]
    df = spark.createDataFrame(rows, "k string, o1 int, o2 int, v int").select(
        "k", "v", F.when(F.col("v") != 13, F.struct("o1", "o2")).alias("ingest_order"))
    want = {r.k: r.v for r in df.groupBy("k").agg(F.min_by("v", "ingest_order").alias("v")).collect()}
    assert want == {"a": 12, "b": 22, None: 31, "c": 40}
    assert {r.k: r.v for r in C.dedup_keep_first(df, ["k"]).collect()} == want
    assert sorted(r.v for r in C.prune_later_rows(df, ["k"]).collect()) == [11, 12, 21, 22, 30, 31, 40]
    try:
        spark.conf.set("demandops.broadcast.maxRows", "2")      # more keys than a broadcast may hold
        assert C.prune_later_rows(df, ["k"]).count() == len(rows)
        assert {r.k: r.v for r in C.dedup_keep_first(df, ["k"]).collect()} == want
    finally:
        spark.conf.unset("demandops.broadcast.maxRows")
    empty = df.limit(0)
    assert C.dedup_keep_first(empty, ["k"]).count() == 0


def test_pruning_aggregates_by_hash(spark):
    from demandops.sources.adapter import sales_raw
    from tests.conftest import SF_SMALL
    raw = sales_raw(spark, SF_SMALL, dimensions=False)
    kept, rows = C.prune_later_rows(raw).count(), raw.count()
    keys = raw.select("date", "store_id", "item_id").distinct().count()
    assert keys <= kept < rows
    plan = C.prune_later_rows(raw)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortAggregate" not in plan and "SortMergeJoin" not in plan
