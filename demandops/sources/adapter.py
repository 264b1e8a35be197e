"""Canonical daily sales fact built from the driver's TPC-H-style tables.

``sales_fact``  one row per (store_id, item_id, date) with the 19 columns of
                the reference's daily fact.
``sales_raw``   the same columns at line grain, deliberately dirty
                (NULL / negative quantities, NULL prices and flags,
                repeated keys) for the quality and cleaning operators.

Scale notes
-----------
* ``nation`` and ``region`` are fixed-size TPC-H dimensions (25 and 5 rows):
  always broadcast.  ``part`` and ``supplier`` grow with the scale factor:
  they are broadcast only behind a row-count check (``fits_broadcast``),
  otherwise joined by shuffle (AQE splits skewed keys), the lines unsorted
  where they are many times the lookup's rows (``hash_side``).
* The grouping to the daily grain is a hash aggregate with map-side partial
  aggregation, so a hot (date, store, item) key is pre-reduced in every
  task before the shuffle.
* ``stock_on_hand``/``stockout_flag`` are modular stand-ins; they are
  computed from per-row residues so the sums cannot overflow ``bigint``
  on large groups (sum(x) mod m == sum(x mod m) mod m).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandops.functions.numeric import exact_cents, rnd
from demandops.operators.dims import festival_flag, holiday_flag, product_enrich
from demandops.sources.tables import fits_broadcast, hash_side, read_table

# ---------------------------------------------------------------------------
# Fixed values of the test-data adapter (product attributes per part type,
# cost constants, holiday month-days, festival windows).  They define the
# test fixture, see FIXTURES.md §2.1.
# ---------------------------------------------------------------------------
# item_id, product_name, category; the numbers follow from the place i = 1..6:
# unit_cost 20 + 35 i, lead days 3 + (4 i mod 9), pack_size 1 + (i mod 3), shelf_life_days 45 i
PRODUCT_LINES = [
    ("ECONOMY", "Economy line", "Value"), ("SMALL", "Small line", "Value"), ("MEDIUM", "Medium line", "Core"),
    ("STANDARD", "Standard line", "Core"), ("LARGE", "Large line", "Bulk"), ("PROMO", "Promo line", "Deal"),
]
PRODUCTS = [(*line, 20.0 + 35.0 * i, 3 + 4 * i % 9, 1 + i % 3, 45 * i) for i, line in enumerate(PRODUCT_LINES, 1)]
ORDERING_COST = 500.0
HOLDING_COST_RATE = 0.20
PROMO_DISCOUNT = 0.09          # a line with discount >= this counts as on promotion
STOCK_MODULUS = 400            # stock_on_hand stand-in: sum(orderkey) mod 400
STOCKOUT_MODULUS = 41          # stockout when sum(orderkey) mod 41 == 0
HOLIDAY_MONTH_DAYS = ["01-01", "05-01", "09-07", "12-24"]
FESTIVAL_WINDOWS = [("03-03", "03-12"), ("07-19", "07-26")]  # of every year
# Defects injected into sales_raw (line grain): residue rules on the keys.
RAW_NULL_QTY_MOD = 97          # l_orderkey % 97 == 0  -> qty NULL
RAW_NEG_QTY_MOD = 89           # l_orderkey % 89 == 0  -> qty negated
RAW_NULL_PRICE_MOD = 53        # l_partkey % 53 == 0   -> price NULL
RAW_NULL_PROMO_MOD = 61        # l_orderkey % 61 == 0  -> on_promo NULL

FACT_COLUMNS = [
    "date", "store_id", "item_id", "product_name", "category", "qty_sold", "price",
    "on_promo", "discount_pct", "stock_on_hand", "stockout_flag", "unit_cost",
    "pack_size", "shelf_life_days", "supplier_lead_time_days", "ordering_cost",
    "holding_cost_rate", "holiday_flag", "festival_flag",
]
INGEST_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                "l_shipdate", "l_quantity", "l_extendedprice"]


def product_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PRODUCTS,
        "item_id string, product_name string, category string, unit_cost double, "
        "supplier_lead_time_days int, pack_size int, shelf_life_days int",
    )


def _lines(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """lineitem joined to its store (supplier geography) and item (part)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), *INGEST_ORDER[:4],
        "l_shipdate", "l_quantity", "l_extendedprice", "l_discount")
    nation = F.broadcast(read_table(spark, sf_dir, "nation")
                         .select("n_nationkey", "n_name", "n_regionkey"))
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part")
    if grain == "region_type":
        region = F.broadcast(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
        store = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                 .join(region, nation.n_regionkey == region.r_regionkey)
                 .select("s_suppkey", F.col("r_name").alias("store_id")))
        item = part.select("p_partkey", F.col("p_type").alias("item_id"))
    elif grain == "nation_brand":
        store = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                 .select("s_suppkey", F.col("n_name").alias("store_id")))
        item = part.select("p_partkey", F.col("p_brand").alias("item_id"))
    else:
        raise ValueError(f"unknown grain {grain!r}")
    # Joins whose lookup side passed the size check (broadcast) go first:
    # they need no shuffle, so a remaining shuffle join moves rows that are
    # already narrowed to their final columns.
    sides = [(item, li.l_partkey, "p_partkey"), (store, li.l_suppkey, "s_suppkey")]
    small = {name: fits_broadcast(side) for side, _, name in sides}
    sides.sort(key=lambda s: not small[s[2]])
    out = li
    for side, key, name in sides:
        out = out.join(F.broadcast(side) if small[name] else hash_side(side, li), key == side[name])
    return out.drop("p_partkey", "s_suppkey")


def _attach_dimensions(daily: DataFrame, spark: SparkSession, grain: str) -> DataFrame:
    if grain == "region_type":
        daily = product_enrich(daily, product_dim(spark))
    else:
        # Brand grain: attributes follow from the brand number (rule, not table).
        n = F.regexp_extract("item_id", r"#(\d+)", 1).cast("int")
        daily = daily.withColumns({
            "product_name": F.col("item_id"),
            "category": F.concat(F.lit("Cat"), (n % 7).cast("string")),
            "unit_cost": (F.lit(20) + F.lit(8) * n).cast("double"),
            "supplier_lead_time_days": (F.lit(1) + n % 10).cast("int"),
            "pack_size": F.lit(1),
            "shelf_life_days": F.lit(365),
        })
    daily = daily.withColumns({
        "ordering_cost": F.lit(ORDERING_COST),
        "holding_cost_rate": F.lit(HOLDING_COST_RATE),
    })
    daily = holiday_flag(daily, HOLIDAY_MONTH_DAYS)
    daily = festival_flag(daily, FESTIVAL_WINDOWS)
    return daily


def sales_fact(spark: SparkSession, sf_dir: str, grain: str = "region_type") -> DataFrame:
    """Daily fact: one row per (date, store_id, item_id)."""
    lines = _lines(spark, sf_dir, grain)
    daily = lines.groupBy("date", "store_id", "item_id").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty_sold"),
        exact_cents("l_extendedprice").alias("_revenue"),
        F.max(F.when(F.col("l_discount") >= PROMO_DISCOUNT, 1).otherwise(0)).alias("on_promo"),
        F.avg("l_discount").alias("_discount"),
        F.sum(F.col("l_orderkey") % STOCK_MODULUS).alias("_stock"),
        F.sum(F.col("l_orderkey") % STOCKOUT_MODULUS).alias("_stockout"),
    )
    daily = daily.select(
        "date", "store_id", "item_id", "qty_sold",
        F.try_divide(F.col("_revenue").cast("double"), F.col("qty_sold").cast("double")).alias("price"),
        F.col("on_promo").cast("int").alias("on_promo"),
        rnd("_discount", 4).alias("discount_pct"),
        (F.col("_stock") % STOCK_MODULUS).cast("bigint").alias("stock_on_hand"),
        F.when(F.col("_stockout") % STOCKOUT_MODULUS == 0, 1).otherwise(0).cast("int")
         .alias("stockout_flag"),
    )
    return _attach_dimensions(daily, spark, grain).select(*FACT_COLUMNS)


def sales_raw(spark: SparkSession, sf_dir: str, grain: str = "region_type", dimensions: bool = True) -> DataFrame:
    """Line-grain fact with injected defects and an explicit ingest order.

    ``ingest_order`` is a struct of the line's natural key; it totally orders
    the rows and stands in for file order in keep-first de-duplication.
    ``dimensions=False`` leaves out the columns that ``with_dimensions`` adds
    from an item and a date, for callers that drop rows first."""
    lines = _lines(spark, sf_dir, grain)
    okey, pkey = F.col("l_orderkey"), F.col("l_partkey")
    qty = F.col("l_quantity").cast("bigint")
    raw = lines.select(
        "date", "store_id", "item_id",
        F.when(okey % RAW_NULL_QTY_MOD == 0, F.lit(None).cast("bigint"))
         .when(okey % RAW_NEG_QTY_MOD == 0, -qty).otherwise(qty).alias("qty_sold"),
        F.when(pkey % RAW_NULL_PRICE_MOD == 0, F.lit(None).cast("double"))
         .otherwise(F.try_divide("l_extendedprice", "l_quantity")).alias("price"),
        F.when(okey % RAW_NULL_PROMO_MOD == 0, F.lit(None).cast("int"))
         .otherwise(F.when(F.col("l_discount") >= PROMO_DISCOUNT, 1).otherwise(0)).alias("on_promo"),
        F.col("l_discount").alias("discount_pct"),
        (okey % STOCK_MODULUS).cast("bigint").alias("stock_on_hand"),
        F.when(okey % STOCKOUT_MODULUS == 0, 1).otherwise(0).cast("int").alias("stockout_flag"),
        F.struct(*INGEST_ORDER).alias("ingest_order"),
    )
    return with_dimensions(raw, spark, grain) if dimensions else raw


def with_dimensions(df: DataFrame, spark: SparkSession, grain: str = "region_type") -> DataFrame:
    """Sales rows with their product, cost and calendar columns; what else
    ``df`` has stays behind the fact's columns."""
    more = [c for c in df.columns if c not in FACT_COLUMNS]
    return _attach_dimensions(df, spark, grain).select(*FACT_COLUMNS, *more)
