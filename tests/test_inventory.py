"""Inventory policy: the reference's unit cases plus edge frames."""

import math

from pyspark.sql import functions as F

from demandops.functions.numeric import service_z
from demandops.operators import inventory as I
from tests.conftest import day, fact_rows


def _base(spark, mu=140.0, std=5.0, on_hand=50.0, lead=7, annual=7300.0, k=500.0, cost=100.0,
          rate=0.2):
    return spark.createDataFrame(
        [("S", "P", mu, std, on_hand, lead, annual, k, cost, rate)],
        "store_id string, item_id string, mu_L double, _std double, on_hand double, "
        "lead_time_days int, annual_demand_est double, ordering_cost double, unit_cost double, "
        "holding_cost_rate double")


def test_policy_example(spark):
    # forecast 20 x 30, std 5, on hand 50, lead 7, demand 7300, K 500, cost 100, rate 0.2
    r = I.round_policy(I.policy_columns(_base(spark), service_z(0.95))).first()
    assert r.safety_stock > 0
    assert r.reorder_point > r.safety_stock
    assert abs(r.EOQ - round(math.sqrt(2 * 7300 * 500 / 20.0), 2)) < 1e-9  # 604.15
    assert r.z_score == 1.645
    assert r.sigma_L == round(5 * math.sqrt(7), 2)


def test_safety_stock_grows_with_service_level(spark):
    ss = {s: I.policy_columns(_base(spark), service_z(s)).first().safety_stock for s in (0.90, 0.99)}
    assert ss[0.99] > ss[0.90]


def test_alert_when_stock_low(spark):
    r = I.policy_columns(_base(spark, on_hand=1.0), service_z(0.95)).first()
    assert r.reorder_alert is True
    assert r.order_qty == max(r.EOQ, r.reorder_point - 1.0)


def test_boundary_on_hand_equals_rop(spark):
    # ROP = mu_L + z*std*sqrt(L); choose on_hand == ROP exactly with std 0.1 floor
    b = _base(spark, mu=10.0, std=0.0, lead=1)
    rop = 10.0 + service_z(0.95) * 0.1
    r = I.policy_columns(b.withColumn("on_hand", F.lit(rop)), service_z(0.95)).first()
    assert r.reorder_alert is True     # non-strict
    assert r.order_qty == 0.0          # strict


def test_free_item_eoq_falls_back_to_mu(spark):
    r = I.policy_columns(_base(spark, cost=0.0), service_z(0.95)).first()
    assert r.EOQ == r.mu_L


def test_one_row_series_has_no_alert(spark, make_fact):
    rows = fact_rows("S", "ONE", [5], stock=0)
    p = I.inventory_policy(make_fact(rows)).first()
    assert p.sigma_L is None and p.reorder_alert is False and p.order_qty == 0.0


def test_fallback_uses_mean_history(spark, make_fact):
    rows = fact_rows("S", "A", [10, 20, 30], lead=2)
    p = I.inventory_policy(make_fact(rows)).first()
    assert p.mu_L == 40.0                      # 2 x mean 20
    assert p.annual_demand_est == round(60 / 3 * 365, 1)


def test_lead_beyond_horizon_sums_what_exists(spark, make_fact):
    rows = fact_rows("S", "L", [10] * 5, lead=45)
    fc = spark.createDataFrame([("S", "L", day(100 + i), 2.0, "x") for i in range(30)],
                               "store_id string, item_id string, forecast_date date, "
                               "predicted_qty double, method string")
    p = I.inventory_policy(make_fact(rows), fc).first()
    assert p.mu_L == 60.0


def test_lead_uses_first_forecast_days_in_date_order(spark, make_fact):
    rows = fact_rows("S", "O", [10] * 5, lead=2)
    # deliberately shuffled dates: first two days are 1.0 and 2.0
    fc = spark.createDataFrame(
        [("S", "O", day(103), 9.0, "x"), ("S", "O", day(100), 1.0, "x"),
         ("S", "O", day(102), 7.0, "x"), ("S", "O", day(101), 2.0, "x")],
        "store_id string, item_id string, forecast_date date, predicted_qty double, method string")
    assert I.inventory_policy(make_fact(rows), fc).first().mu_L == 3.0


def test_alerts_and_urgency(spark, make_fact):
    rows = (fact_rows("S", "LOW", [10, 12, 9, 11], stock=0)
            + fact_rows("S", "MID", [10, 12, 9, 11], stock=20)
            + fact_rows("S", "HIGH", [10, 12, 9, 11], stock=400))
    pol = I.inventory_policy(make_fact(rows))
    alerts = {r.item_id: r.urgency for r in I.reorder_alerts(pol).collect()}
    assert alerts == {"LOW": "CRITICAL", "MID": "WARNING"}
    summary = I.policy_summary(pol).first()
    assert summary.n_alerts == 2 and summary.n_combos == 3


def test_service_sweep_monotone(spark, make_fact):
    rows = fact_rows("S", "A", [10, 14, 9, 11, 13])
    sw = I.service_level_sweep(make_fact(rows), (0.8, 0.9, 0.99)).orderBy("service_level").collect()
    ss = [r.safety_stock for r in sw]
    assert ss == sorted(ss) and ss[0] < ss[-1]


# Published policy rows at 95 % service (ordering cost 500, holding rate 0.20).
# Per product: unit cost, lead days.
PUBLISHED_PRODUCTS = [(180, 7), (45, 2), (110, 10), (55, 5), (100, 7), (60, 5), (80, 8), (30, 1), (18, 5), (70, 10)]
# Per store and product: annual demand, lead time demand, its deviation, reorder point, order quantity.
PUBLISHED_POLICY = [
    [(11211.0, 175.28, 24.76, 216.01, 558.05), (22514.0, 97.58, 25.28, 139.17, 1581.63), (6663.0, 157.47, 20.27, 190.81, 550.33),
     (18053.0, 188.3, 32.87, 242.37, 1281.09), (11340.5, 176.87, 25.4, 218.65, 753.01), (15894.5, 175.01, 28.9, 222.54, 1150.89),
     (5395.0, 112.44, 15.11, 137.29, 580.68), (26990.0, 53.81, 21.73, 89.56, 2120.93), (18109.0, 177.93, 33.05, 232.3, 2242.83),
     (6831.0, 149.01, 20.84, 183.3, 698.52)],
    [(8510.0, 137.86, 20.62, 171.77, 486.2), (16975.0, 66.61, 18.89, 97.68, 1373.36), (5082.0, 106.88, 15.6, 132.54, 480.62),
     (13499.5, 142.6, 26.0, 185.37, 1107.8), (8354.0, 148.04, 19.97, 180.89, 646.3), (11897.5, 123.01, 22.41, 159.86, 995.72),
     (3973.0, 70.76, 12.37, 91.1, 498.31), (20219.0, 40.88, 16.29, 67.67, 1835.71), (13482.5, 140.23, 24.89, 181.18, 1935.24),
     (5025.0, 102.99, 15.91, 129.16, 599.11)],
    [(14012.5, 197.77, 31.35, 249.33, 623.89), (28121.0, 118.85, 30.62, 169.21, 1767.64), (8546.0, 176.27, 25.74, 218.61, 623.26),
     (22544.0, 240.05, 40.44, 306.56, 1431.59), (14330.0, 246.45, 31.22, 297.81, 846.46), (19791.5, 205.16, 34.99, 262.72, 1284.25),
     (6779.0, 124.06, 19.01, 155.33, 650.91), (33712.5, 68.98, 25.68, 111.22, 2370.39), (22629.0, 240.31, 40.15, 306.36, 2507.16),
     (8418.0, 204.01, 24.37, 244.1, 775.43)]]


def test_published_policy_rows(spark):
    """Safety stock, reorder point and order quantity of all thirty rows, from
    their published (rounded) demand, deviation and costs."""
    rows = [(s, p, float(cost), lead, demand, mu, sigma, 1e6, rop, eoq)
            for s, store in enumerate(PUBLISHED_POLICY)
            for p, ((cost, lead), (demand, mu, sigma, rop, eoq)) in enumerate(zip(PUBLISHED_PRODUCTS, store))]
    df = spark.createDataFrame(rows, "store int, item int, unit_cost double, lead_time_days int, annual_demand_est double, "
                               "mu_L double, sigma double, on_hand double, rop double, eoq_ double").withColumns({
        "_std": F.col("sigma") / F.sqrt("lead_time_days"), "ordering_cost": F.lit(500.0), "holding_cost_rate": F.lit(0.20)})
    out = I.policy_columns(df, service_z(0.95)).collect()
    assert len(out) == 30
    for r in out:
        assert abs(r["reorder_point"] - r["rop"]) <= 0.02 and abs(r["safety_stock"] - (r["rop"] - r["mu_L"])) <= 0.02
        assert abs(r["EOQ"] - r["eoq_"]) <= 0.005 and not r["reorder_alert"] and r["order_qty"] == 0
