"""Equivalent DuckDB SQL for every exactly checkable registered query.

The oracle is an independent statement of each operator's semantics over
the same Parquet tables (pre-registered as views).  Shared building blocks
(the adapter, the clean table, ...) are CTEs; ``compose`` prepends the ones
a query needs, in dependency order.  Rounding uses the same half-up rule as
the Spark side: ``floor(x * 10^n + 0.5) / 10^n``.
"""

from __future__ import annotations

from demandops.functions.numeric import service_z
from demandops.sources import adapter as A


def r(expr: str, n: int) -> str:
    s = f"{float(10 ** n)!r}"
    return f"(floor(({expr}) * {s} + 0.5) / {s})"


def mean(expr: str, scale: int = 10) -> str:
    """Order-independent mean, as ``functions.numeric.exact_mean``."""
    return (f"(CAST(SUM(CAST({expr} AS DECIMAL(38,{scale}))) AS DOUBLE) "
            f"/ CAST(COUNT({expr}) AS DOUBLE))")


def hex_hash_sql(*exprs: str) -> str:
    """``functions.numeric.hex_hash``: four hexadecimal digits of an md5."""
    digest = f"md5(concat_ws('|', {', '.join(exprs)}))"
    return "(" + " + ".join(f"{16 ** (3 - i)} * (strpos('0123456789abcdef', substr({digest}, {i + 1}, 1)) - 1)"
                            for i in range(4)) + ")"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _products_values() -> str:
    return ", ".join(
        f"({_q(i)}, {_q(n)}, {_q(c)}, {u!r}, {lead}, {pack}, {shelf})"
        for i, n, c, u, lead, pack, shelf in A.PRODUCTS)


def festival_sql(date: str) -> str:
    """Whether a date lies in a recurring festival window."""
    return "(" + " OR ".join(f"strftime({date}, '%m-%d') BETWEEN {_q(a)} AND {_q(b)}" for a, b in A.FESTIVAL_WINDOWS) + ")"


def _month_days() -> str:
    return ", ".join(_q(m) for m in A.HOLIDAY_MONTH_DAYS)


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (deps, sql)


def compose(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    head = "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        # merge the body's own CTE list into ours
        return head + ",\n" + stripped[4:].lstrip()
    return head + "\n" + body


# --------------------------------------------------------------------------
# Adapter
# --------------------------------------------------------------------------
cte("products", f"""
SELECT item_id, product_name, category, CAST(unit_cost AS DOUBLE) AS unit_cost,
       CAST(lead AS INTEGER) AS supplier_lead_time_days, CAST(pack AS INTEGER) AS pack_size,
       CAST(shelf AS INTEGER) AS shelf_life_days
FROM (VALUES {_products_values()}) t(item_id, product_name, category, unit_cost, lead, pack, shelf)""")

cte("lines", """
SELECT CAST(l.l_shipdate AS DATE) AS date, r.r_name AS store_id, p.p_type AS item_id,
       l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate,
       l.l_quantity, l.l_extendedprice, l.l_discount
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("daily", f"""
SELECT date, store_id, item_id,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty_sold,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue_,
       MAX(CASE WHEN l_discount >= {A.PROMO_DISCOUNT!r} THEN 1 ELSE 0 END) AS on_promo,
       AVG(l_discount) AS disc_,
       SUM(l_orderkey) AS oksum_
FROM lines GROUP BY date, store_id, item_id""", "lines")

_FLAGS = f"""
       CAST(CASE WHEN strftime(x.date, '%m-%d') IN ({_month_days()}) THEN 1 ELSE 0 END AS INTEGER) AS holiday_flag,
       CAST(CASE WHEN {festival_sql('x.date')} THEN 1 ELSE 0 END AS INTEGER) AS festival_flag"""

cte("fact", f"""
SELECT x.date, x.store_id, x.item_id, p.product_name, p.category, x.qty_sold,
       x.revenue_ / NULLIF(CAST(x.qty_sold AS DOUBLE), 0) AS price,
       CAST(x.on_promo AS INTEGER) AS on_promo,
       {r('x.disc_', 4)} AS discount_pct,
       CAST(x.oksum_ % {A.STOCK_MODULUS} AS BIGINT) AS stock_on_hand,
       CAST(CASE WHEN x.oksum_ % {A.STOCKOUT_MODULUS} = 0 THEN 1 ELSE 0 END AS INTEGER) AS stockout_flag,
       p.unit_cost, p.pack_size, p.shelf_life_days, p.supplier_lead_time_days,
       CAST({A.ORDERING_COST!r} AS DOUBLE) AS ordering_cost,
       CAST({A.HOLDING_COST_RATE!r} AS DOUBLE) AS holding_cost_rate,{_FLAGS}
FROM daily x LEFT JOIN products p ON x.item_id = p.item_id""", "daily", "products")

cte("raw", f"""
SELECT x.date, x.store_id, x.item_id, p.product_name, p.category,
       CASE WHEN x.l_orderkey % {A.RAW_NULL_QTY_MOD} = 0 THEN NULL
            WHEN x.l_orderkey % {A.RAW_NEG_QTY_MOD} = 0 THEN -CAST(x.l_quantity AS BIGINT)
            ELSE CAST(x.l_quantity AS BIGINT) END AS qty_sold,
       CASE WHEN x.l_partkey % {A.RAW_NULL_PRICE_MOD} = 0 THEN NULL
            ELSE x.l_extendedprice / NULLIF(x.l_quantity, 0) END AS price,
       CASE WHEN x.l_orderkey % {A.RAW_NULL_PROMO_MOD} = 0 THEN NULL
            WHEN x.l_discount >= {A.PROMO_DISCOUNT!r} THEN 1 ELSE 0 END AS on_promo,
       x.l_discount AS discount_pct,
       CAST(x.l_orderkey % {A.STOCK_MODULUS} AS BIGINT) AS stock_on_hand,
       CAST(CASE WHEN x.l_orderkey % {A.STOCKOUT_MODULUS} = 0 THEN 1 ELSE 0 END AS INTEGER) AS stockout_flag,
       p.unit_cost, p.pack_size, p.shelf_life_days, p.supplier_lead_time_days,
       CAST({A.ORDERING_COST!r} AS DOUBLE) AS ordering_cost,
       CAST({A.HOLDING_COST_RATE!r} AS DOUBLE) AS holding_cost_rate,{_FLAGS},
       x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey, x.l_shipdate, x.l_quantity,
       x.l_extendedprice
FROM lines x LEFT JOIN products p ON x.item_id = p.item_id""", "lines", "products")

FACT_COLS = ", ".join(A.FACT_COLUMNS)
INGEST = ", ".join(A.INGEST_ORDER)

cte("raw_dedup", f"""
SELECT {FACT_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, item_id, date ORDER BY {INGEST}) AS rn_
  FROM raw) WHERE rn_ = 1""", "raw")


def _clean_from(src: str) -> str:
    return f"""
SELECT c.date, c.store_id, c.item_id, c.product_name, c.category, c.qty_sold,
       COALESCE(c.price, m.med_) AS price, c.on_promo, c.discount_pct, c.stock_on_hand,
       c.stockout_flag, c.unit_cost, c.pack_size, c.shelf_life_days, c.supplier_lead_time_days,
       c.ordering_cost, c.holding_cost_rate, c.holiday_flag, c.festival_flag,
       c.date - CAST(isodow(c.date) - 1 AS INTEGER) AS week_start
FROM (
  SELECT date, store_id, item_id, product_name, category,
         CASE WHEN qty_sold < 0 THEN 0 ELSE qty_sold END AS qty_sold, price,
         COALESCE(on_promo, 0) AS on_promo, COALESCE(discount_pct, 0) AS discount_pct,
         stock_on_hand, stockout_flag, unit_cost, pack_size, shelf_life_days,
         supplier_lead_time_days, ordering_cost, holding_cost_rate,
         COALESCE(holiday_flag, 0) AS holiday_flag, COALESCE(festival_flag, 0) AS festival_flag
  FROM {src} WHERE qty_sold IS NOT NULL AND stockout_flag = 0) c
LEFT JOIN (
  SELECT item_id, median(price) AS med_ FROM {src}
  WHERE qty_sold IS NOT NULL AND stockout_flag = 0 GROUP BY item_id) m
ON c.item_id = m.item_id"""


# ``fact`` is unique per (store, item, date) by construction, so keep-first
# de-duplication is the identity on it.
cte("clean", _clean_from("fact"), "fact")
cte("clean_raw", _clean_from("raw_dedup"), "raw_dedup")

# --------------------------------------------------------------------------
# Inventory policy with the mean-forecast fallback
# --------------------------------------------------------------------------
Z95 = repr(service_z(0.95))


def _hist(src: str) -> str:
    return f"""
SELECT store_id, item_id,
       arg_max(supplier_lead_time_days, date) AS lead_, arg_max(unit_cost, date) AS unit_cost,
       arg_max(ordering_cost, date) AS ordering_cost, arg_max(holding_cost_rate, date) AS holding_cost_rate,
       arg_max(product_name, date) AS product_name, arg_max(category, date) AS category,
       arg_max(stock_on_hand, date) AS soh_, stddev_samp(qty_sold) AS sd_,
       CAST(SUM(qty_sold) AS BIGINT) AS total_, AVG(qty_sold) AS mean_,
       MIN(date) AS d0_, MAX(date) AS d1_
FROM {src} WHERE store_id IS NOT NULL AND item_id IS NOT NULL GROUP BY store_id, item_id"""


def policy_sql(base: str, z: str = Z95, extra: str = "") -> str:
    """Policy arithmetic over a base CTE with mu_L, sd_, on_hand, ..."""
    return f"""
SELECT {extra}store_id, item_id, product_name, category, unit_cost, lead_time_days,
       {r('annual_demand_est', 1)} AS annual_demand_est, {r('z_score', 3)} AS z_score,
       {r('mu_L', 2)} AS mu_L, {r('sigma_L', 2)} AS sigma_L, {r('ss', 2)} AS safety_stock,
       {r('rop', 2)} AS reorder_point, {r('eoq', 2)} AS EOQ,
       {r('CASE WHEN on_hand < rop THEN GREATEST(CAST(0 AS DOUBLE), eoq, rop - on_hand) ELSE CAST(0 AS DOUBLE) END', 2)} AS order_qty,
       {r('on_hand', 2)} AS on_hand, COALESCE(on_hand <= rop, false) AS reorder_alert
FROM (
  SELECT *, mu_L + ss AS rop,
         CASE WHEN unit_cost * holding_cost_rate > 0
              THEN sqrt(CAST(2 AS DOUBLE) * annual_demand_est * ordering_cost / (unit_cost * holding_cost_rate))
              ELSE mu_L END AS eoq
  FROM (
    SELECT *, z_score * sigma_L AS ss
    FROM (
      SELECT *, {z} AS z_score,
             (CASE WHEN sd_ < 0.1 THEN CAST(0.1 AS DOUBLE) ELSE sd_ END) * sqrt(CAST(lead_time_days AS DOUBLE)) AS sigma_L
      FROM {base})))"""


def base_ctes(src: str, suffix: str = "") -> None:
    """Register hist and base_fallback over a clean table."""
    cte(f"hist{suffix}", _hist(src), src)
    cte(f"base_fallback{suffix}", f"""
SELECT store_id, item_id, product_name, category, unit_cost,
       CAST(lead_ AS INTEGER) AS lead_time_days,
       CAST(total_ AS DOUBLE) / (date_diff('day', d0_, d1_) + 1) * CAST(365 AS DOUBLE) AS annual_demand_est,
       CAST(LEAST(GREATEST(lead_, 0), 30) * mean_ AS DOUBLE) AS mu_L, sd_,
       CAST(soh_ AS DOUBLE) AS on_hand, ordering_cost, holding_cost_rate
FROM hist{suffix}""", f"hist{suffix}")


base_ctes("clean")

cte("policy", policy_sql("base_fallback", f"CAST('{Z95}' AS DOUBLE)"), "base_fallback")

cte("alerts", """
SELECT store_id, item_id, product_name, category, on_hand, reorder_point, safety_stock, order_qty,
       CASE WHEN on_hand <= safety_stock THEN 'CRITICAL' ELSE 'WARNING' END AS urgency
FROM policy WHERE reorder_alert""", "policy")


def box_sql(src: str, group: str, value: str) -> str:
    """Box statistics (quartiles interpolated, whiskers inside 1.5 IQR)."""
    vals = (f"SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {src} "
            f"WHERE {group} IS NOT NULL AND {value} IS NOT NULL")
    return f"""
SELECT q_.{group}, q1, median, q3,
       MIN(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS whisker_low,
       MAX(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
       COUNT(*) AS n
FROM ({vals}) v_
JOIN (SELECT {group}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM ({vals}) GROUP BY {group}) q_
  ON v_.{group} = q_.{group}
GROUP BY q_.{group}, q1, median, q3"""


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLE[name] = compose(body, *needs)
