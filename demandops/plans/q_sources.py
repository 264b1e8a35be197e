"""Queries: sources, dimensions, quality and cleaning (S, D, Q, C)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from demandops.functions.numeric import present
from demandops.operators import cleaning as C
from demandops.operators import dims as D
from demandops.operators import quality as Q
from demandops.plans.catalog import clean, fact, first_rows, query, raw, raw_dedup
from demandops.plans.oracle import A, festival_sql, hex_hash_sql, mean, oracle, r
from demandops.session import stage_root
from demandops.sources.io import load_sales, profile_sales, write_stage
from demandops.sources.tables import read_table


@query("S1_load_sales")
def s1(spark, sf):
    """The fact written as CSV and loaded with the explicit schema."""
    root = os.path.join(stage_root(spark, "roundtrip"), uuid.uuid4().hex[:12])
    write_stage(fact(spark, sf), root, "sales", fmt="csv")
    return load_sales(spark, os.path.join(root, "sales"), fmt="csv")


oracle("S1_load_sales", "SELECT * FROM fact", "fact")


#: Column types of the fact, as Spark names them.
_TYPES = {"date": "date", "qty_sold": "bigint", "stock_on_hand": "bigint"} | {
    c: "string" for c in ("store_id", "item_id", "product_name", "category")} | {
    c: "double" for c in ("price", "discount_pct", "unit_cost", "ordering_cost", "holding_cost_rate")}


@query("S5_profile_sales")
def s5(spark, sf):
    """The profile, once per column with the column's type."""
    f = fact(spark, sf)
    types = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("type")) for n, t in f.dtypes])
    return profile_sales(f).select("*", F.explode(types).alias("c")).select(
        "n_rows", "min_date", "max_date", "n_stores", "n_items", "n_columns", "c.*")


oracle("S5_profile_sales", f"""
SELECT COUNT(*) AS n_rows, MIN(date) AS min_date, MAX(date) AS max_date,
       COUNT(DISTINCT store_id) AS n_stores, COUNT(DISTINCT item_id) AS n_items,
       {len(A.FACT_COLUMNS)} AS n_columns, t.column, t.type
FROM fact CROSS JOIN (VALUES {', '.join(f"('{c}', '{_TYPES.get(c, 'int')}')" for c in A.FACT_COLUMNS)}) t("column", type)
GROUP BY t.column, t.type""", "fact")


# ---------------------------------------------------------------- D1-D7 --
@query("D1_series_scaffold")
def d1(spark, sf):
    return D.series_scaffold(fact(spark, sf))


oracle("D1_series_scaffold", """
SELECT s.store_id, s.item_id, CAST(g.d AS DATE) AS date
FROM (SELECT DISTINCT store_id, item_id FROM fact
      WHERE store_id IS NOT NULL AND item_id IS NOT NULL) s
CROSS JOIN (SELECT unnest(generate_series(CAST((SELECT MIN(date) FROM fact) AS TIMESTAMP),
                                          CAST((SELECT MAX(date) FROM fact) AS TIMESTAMP),
                                          INTERVAL 1 DAY)) AS d) g""", "fact")

_DIM_COLS = ["date", "store_id", "item_id", "product_name", "category", "unit_cost",
             "pack_size", "shelf_life_days", "supplier_lead_time_days"]


@query("D2_product_enrich")
def d2(spark, sf):
    return fact(spark, sf).select(*_DIM_COLS)


oracle("D2_product_enrich", f"SELECT {', '.join(_DIM_COLS)} FROM fact", "fact")

LEAD_BY_CATEGORY = {"Value": 3, "Core": 6, "Bulk": 10}


@query("D3_lead_time_lookup")
def d3(spark, sf):
    return D.lead_time_lookup(fact(spark, sf), LEAD_BY_CATEGORY).select(
        "date", "store_id", "item_id", "category", "supplier_lead_time_days")


oracle("D3_lead_time_lookup", """
SELECT date, store_id, item_id, category,
       CAST(CASE category WHEN 'Value' THEN 3 WHEN 'Core' THEN 6 WHEN 'Bulk' THEN 10 ELSE 7 END
            AS INTEGER) AS supplier_lead_time_days
FROM fact""", "fact")

EXTRA_HOLIDAYS = ["1996-02-29", "2000-07-04"]


@query("D4_holiday_flag")
def d4(spark, sf):
    return D.holiday_flag(fact(spark, sf), A.HOLIDAY_MONTH_DAYS, EXTRA_HOLIDAYS).select(
        "date", "store_id", "item_id", "holiday_flag")


oracle("D4_holiday_flag", f"""
SELECT date, store_id, item_id,
       CAST(CASE WHEN strftime(date, '%m-%d') IN ({', '.join(repr(m) for m in A.HOLIDAY_MONTH_DAYS)})
                   OR date IN ({', '.join(f"DATE '{d}'" for d in EXTRA_HOLIDAYS)})
                 THEN 1 ELSE 0 END AS INTEGER) AS holiday_flag
FROM fact""", "fact")

# An extra window overlapping two of the adapter's windows exercises the
# no-duplication rule.
OVERLAP_WINDOW = ("1998-03-10", "1998-07-20")
NEW_YEAR_WINDOW = ("12-30", "01-02")  # of every year, across New Year


@query("D5_festival_flag")
def d5(spark, sf):
    windows = [*A.FESTIVAL_WINDOWS, OVERLAP_WINDOW, NEW_YEAR_WINDOW]
    return D.festival_flag(fact(spark, sf).drop("festival_flag"), windows).select(
        "date", "store_id", "item_id", "festival_flag")


oracle("D5_festival_flag", f"""
SELECT date, store_id, item_id,
       CAST(CASE WHEN {festival_sql('x.date')} OR strftime(x.date, '%m-%d') IN ('12-30', '12-31', '01-01', '01-02')
                   OR x.date BETWEEN DATE '{OVERLAP_WINDOW[0]}' AND DATE '{OVERLAP_WINDOW[1]}'
                 THEN 1 ELSE 0 END AS INTEGER) AS festival_flag
FROM fact x""", "fact")


@query("D6_promo_hash_sample")
def d6(spark, sf):
    return D.promo_hash_sample(fact(spark, sf)).select("date", "store_id", "item_id", "on_promo")


oracle("D6_promo_hash_sample", f"""
SELECT date, store_id, item_id,
       CAST(CASE WHEN {hex_hash_sql("strftime(date, '%Y-%m-%d')", 'item_id', 'store_id')} % 100 < 15
                 THEN 1 ELSE 0 END AS INTEGER) AS on_promo FROM fact""", "fact")


@query("D7_discounted_price")
def d7(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     D.discounted_price(F.col("l_extendedprice") / F.col("l_quantity"),
                                        "l_discount").alias("net_unit_price"))


oracle("D7_discounted_price", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {r('(l_extendedprice / l_quantity) * (1 - l_discount)', 2)} AS net_unit_price
FROM lineitem""")


# ---------------------------------------------------------------- Q2-Q6 --
@query("Q2_duplicate_count")
def q2(spark, sf):
    df = raw(spark, sf)
    return Q.quality_summary(df).select("duplicate_rows")


oracle("Q2_duplicate_count", """
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM raw GROUP BY store_id, item_id, date)""", "raw")


@query("Q3_missing_qty")
def q3(spark, sf):
    return raw(spark, sf).agg(Q.missing_qty().alias("missing_qty"))


oracle("Q3_missing_qty", "SELECT COUNT(*) FILTER (WHERE qty_sold IS NULL) AS missing_qty FROM raw", "raw")


@query("Q4_negative_qty")
def q4(spark, sf):
    return raw(spark, sf).agg(Q.negative_qty().alias("negative_qty"))


oracle("Q4_negative_qty", "SELECT COUNT(*) FILTER (WHERE qty_sold < 0) AS negative_qty FROM raw", "raw")


@query("Q5_pct_stockout")
def q5(spark, sf):
    df = raw(spark, sf)
    return df.agg(Q.pct_stockout(df).alias("pct_stockout"))


oracle("Q5_pct_stockout", f"SELECT {r('AVG(stockout_flag) * 100.0', 2)} AS pct_stockout FROM raw", "raw")


@query("Q6_quality_report")
def q6(spark, sf):
    return Q.quality_report(raw(spark, sf))


oracle("Q6_quality_report", f"""
WITH s AS (
  SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE qty_sold IS NULL) AS missing_qty,
         COUNT(*) FILTER (WHERE qty_sold < 0) AS negative_qty,
         {r('AVG(stockout_flag) * 100.0', 2)} AS pct_stockout,
         (SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM raw
                                              GROUP BY store_id, item_id, date)) AS duplicate_rows
  FROM raw),
u AS (
  SELECT 0 AS ordinal, 'total_rows' AS "check", CAST(total_rows AS DOUBLE) AS value FROM s UNION ALL
  SELECT 1, 'missing_columns', CAST(0 AS DOUBLE) FROM s UNION ALL
  SELECT 2, 'duplicate_rows', CAST(duplicate_rows AS DOUBLE) FROM s UNION ALL
  SELECT 3, 'missing_qty', CAST(missing_qty AS DOUBLE) FROM s UNION ALL
  SELECT 4, 'negative_qty', CAST(negative_qty AS DOUBLE) FROM s UNION ALL
  SELECT 5, 'pct_stockout', CAST(pct_stockout AS DOUBLE) FROM s)
SELECT ordinal, "check", value,
       CASE WHEN "check" IN ('total_rows', 'pct_stockout') OR COALESCE(value, 0) = 0
            THEN 'pass' ELSE 'warn' END AS status
FROM u""", "raw")


# ---------------------------------------------------------------- C1-C11 --
_RAW_COLS = ", ".join(A.FACT_COLUMNS)


def _raw_plain(spark, sf):
    return raw(spark, sf).drop("ingest_order")


@query("C1_dedup_keep_first")
def c1(spark, sf):
    return first_rows(spark, sf)


oracle("C1_dedup_keep_first", "SELECT * FROM raw_dedup", "raw_dedup")


@query("C2_drop_missing_target")
def c2(spark, sf):
    return C.drop_missing_target(_raw_plain(spark, sf))


oracle("C2_drop_missing_target", f"SELECT {_RAW_COLS} FROM raw WHERE qty_sold IS NOT NULL", "raw")


@query("C3_clip_negative")
def c3(spark, sf):
    return C.clip_negative(_raw_plain(spark, sf))


oracle("C3_clip_negative", f"""
SELECT * REPLACE (CASE WHEN qty_sold < 0 THEN 0 ELSE qty_sold END AS qty_sold)
FROM (SELECT {_RAW_COLS} FROM raw)""", "raw")


@query("C4_censor_stockouts")
def c4(spark, sf):
    return C.censor_stockouts(_raw_plain(spark, sf))


oracle("C4_censor_stockouts", f"SELECT {_RAW_COLS} FROM raw WHERE stockout_flag = 0", "raw")


@query("C5_fill_flags")
def c5(spark, sf):
    return C.fill_flags(_raw_plain(spark, sf))


oracle("C5_fill_flags", f"""
SELECT * REPLACE (COALESCE(on_promo, 0) AS on_promo, COALESCE(discount_pct, 0) AS discount_pct,
                  COALESCE(holiday_flag, 0) AS holiday_flag, COALESCE(festival_flag, 0) AS festival_flag)
FROM (SELECT {_RAW_COLS} FROM raw)""", "raw")


@query("C6_impute_price_median")
def c6(spark, sf):
    return C.impute_price_median(_raw_plain(spark, sf))


oracle("C6_impute_price_median", f"""
SELECT x.* REPLACE (COALESCE(x.price, m.med_) AS price)
FROM (SELECT {_RAW_COLS} FROM raw) x
LEFT JOIN (SELECT item_id, median(price) AS med_ FROM raw GROUP BY item_id) m
  ON x.item_id = m.item_id""", "raw")


@query("C7_sort_panel")
def c7(spark, sf):
    return C.sort_panel(clean(spark, sf))


oracle("C7_sort_panel", "SELECT * FROM clean ORDER BY store_id, item_id, date", "clean")


@query("C8_clean_audit")
def c8(spark, sf):
    return C.clean_audit(raw(spark, sf))


oracle("C8_clean_audit", """
WITH d AS (SELECT * FROM raw_dedup),
a AS (SELECT COUNT(*) AS rows_after_dedup,
             COUNT(*) FILTER (WHERE qty_sold IS NOT NULL) AS am_,
             COUNT(*) FILTER (WHERE qty_sold IS NOT NULL AND stockout_flag = 0) AS rows_after
      FROM d)
SELECT (SELECT COUNT(*) FROM raw) AS rows_before, rows_after_dedup,
       am_ - rows_after AS removed_stockout, rows_after,
       (SELECT COUNT(*) FROM raw) - rows_after AS removed_total
FROM a""", "raw_dedup")


def clean_raw(spark, sf):
    """C9 over the line-grain input, reading the keep-first stage
    (``catalog.raw_dedup``) written once per input."""
    return C.clean_sales(raw_dedup(spark, sf), unique_keys=True)


@query("C9_clean_sales")
def c9(spark, sf):
    return clean_raw(spark, sf)


oracle("C9_clean_sales", "SELECT * FROM clean_raw", "clean_raw")


@query("C10_week_start")
def c10(spark, sf):
    return C.week_start(fact(spark, sf)).select("date", "store_id", "item_id", "week_start")


oracle("C10_week_start", """
SELECT date, store_id, item_id, date - CAST(isodow(date) - 1 AS INTEGER) AS week_start
FROM fact""", "fact")


@query("C11_weekly_rollup")
def c11(spark, sf):
    return present(C.weekly_rollup(clean(spark, sf)), 6)


oracle("C11_weekly_rollup", f"""
SELECT store_id, item_id, category, product_name, week_start AS date,
       CAST(SUM(qty_sold) AS BIGINT) AS qty_sold, {r(mean('price'), 6)} AS price,
       MAX(on_promo) AS on_promo, {r(mean('discount_pct'), 6)} AS discount_pct,
       MAX(holiday_flag) AS holiday_flag, MAX(festival_flag) AS festival_flag,
       {r('arg_min(unit_cost, date)', 6)} AS unit_cost,
       arg_min(supplier_lead_time_days, date) AS supplier_lead_time_days,
       {r('arg_min(ordering_cost, date)', 6)} AS ordering_cost,
       {r('arg_min(holding_cost_rate, date)', 6)} AS holding_cost_rate
FROM clean
WHERE store_id IS NOT NULL AND item_id IS NOT NULL AND category IS NOT NULL
  AND product_name IS NOT NULL AND week_start IS NOT NULL
GROUP BY store_id, item_id, category, product_name, week_start""", "clean")


@query("Q1_required_columns")
def q1(spark, sf):
    """The report's row for the whole input, and for one without the target."""
    df = raw(spark, sf)
    parts = [Q.quality_report(x).groupBy().agg(
        F.max(F.when(F.col("check") == "total_rows", F.col("value"))).alias("total_rows"),
        F.max(F.when(F.col("check") == "missing_columns", F.col("value"))).alias("missing_columns"),
        F.max(F.when(F.col("check") == "missing_columns", F.col("status"))).alias("status"))
        .select(F.lit(name).alias("input"), "total_rows", "missing_columns", "status")
        for name, x in (("whole", df), ("no target", df.drop("qty_sold")))]
    return parts[0].unionByName(parts[1])


oracle("Q1_required_columns", """
SELECT 'whole' AS input, CAST(COUNT(*) AS DOUBLE) AS total_rows, CAST(0 AS DOUBLE) AS missing_columns, 'pass' AS status FROM raw
UNION ALL SELECT 'no target', CAST(COUNT(*) AS DOUBLE), CAST(1 AS DOUBLE), 'warn' FROM raw""", "raw")
