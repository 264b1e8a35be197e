import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from demandops.session import local_session
    s = local_session("*", shuffle_partitions=8, app="demandops-tests")
    yield s
    s.stop()


def day(i: int, start=dt.date(2024, 1, 1)) -> dt.date:
    return start + dt.timedelta(days=i)


FACT_DDL = ("date date, store_id string, item_id string, product_name string, category string, "
            "qty_sold bigint, price double, on_promo int, discount_pct double, stock_on_hand bigint, "
            "stockout_flag int, unit_cost double, pack_size int, shelf_life_days int, "
            "supplier_lead_time_days int, ordering_cost double, holding_cost_rate double, "
            "holiday_flag int, festival_flag int")


def fact_rows(store, item, qtys, start=0, price=10.0, cost=5.0, lead=7, stock=100, promo=None,
              category="Cat", product=None, stockout=None):
    rows = []
    for i, q in enumerate(qtys):
        rows.append((day(start + i), store, item, product or f"{item} name", category, q, price,
                     (promo[i] if promo else 0), 0.0, stock, (stockout[i] if stockout else 0),
                     cost, 1, 30, lead, 500.0, 0.2, 0, 0))
    return rows


@pytest.fixture
def make_fact(spark):
    def _make(rows):
        return spark.createDataFrame(rows, FACT_DDL)
    return _make
