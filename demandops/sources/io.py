"""Scans, sinks and profiling.

Stages exchange Parquet (typed, column-pruned, splittable); CSV is kept
only as an interchange format with an explicit schema, so types are never
re-inferred between stages.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

SALES_SCHEMA = StructType([
    StructField("date", DateType()),
    StructField("store_id", StringType()),
    StructField("item_id", StringType()),
    StructField("product_name", StringType()),
    StructField("category", StringType()),
    StructField("qty_sold", LongType()),
    StructField("price", DoubleType()),
    StructField("on_promo", IntegerType()),
    StructField("discount_pct", DoubleType()),
    StructField("stock_on_hand", LongType()),
    StructField("stockout_flag", IntegerType()),
    StructField("unit_cost", DoubleType()),
    StructField("pack_size", IntegerType()),
    StructField("shelf_life_days", IntegerType()),
    StructField("supplier_lead_time_days", IntegerType()),
    StructField("ordering_cost", DoubleType()),
    StructField("holding_cost_rate", DoubleType()),
    StructField("holiday_flag", IntegerType()),
    StructField("festival_flag", IntegerType()),
])


def load_sales(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType = SALES_SCHEMA, ingest_order: bool = False) -> DataFrame:
    """Scan a sales table.  CSV gets the explicit schema (date parsed).

    ``ingest_order=True`` adds the column keep-first needs: (file, row).  A
    Parquet file knows its row numbers; for text, the ids Spark gives out grow
    with the place in a file."""
    if fmt == "csv":
        df = (spark.read.schema(schema).option("header", True)
              .option("dateFormat", "yyyy-MM-dd").csv(path))
        row = F.monotonically_increasing_id()
    elif fmt == "parquet":
        df, row = spark.read.parquet(path), F.col("_metadata.row_index")
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    if not ingest_order:
        return df
    order = F.struct(F.col("_metadata.file_path").alias("file"), row.alias("row"))
    return df.select("*", order.alias("ingest_order"))


def write_stage(df: DataFrame, root: str, name: str, fmt: str = "parquet",
                partition_by: str | list[str] | None = None,
                cluster_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """S3: persist a stage table under ``root/name`` (shared storage).

    With ``partition_by`` the rows are first range-partitioned on the
    partition columns followed by ``cluster_by`` (default: the series keys
    and date when present): every task then holds a contiguous key range and
    writes few files (about tasks + partition values, instead of tasks x
    values), and a hot partition value still spreads over several tasks
    because the range boundaries also cut on the following columns."""
    path = os.path.join(root, name)
    if partition_by:
        parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        if cluster_by is None:
            cluster_by = [c for c in ("store_id", "item_id", "date") if c in df.columns]
        order = parts + [c for c in cluster_by if c not in parts]
        df = df.repartitionByRange(*order)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        w.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` under a fresh folder of the shared stage root; return it."""
    from demandops.session import stage_root
    import uuid
    path = os.path.join(stage_root(df.sparkSession, "tables"), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared stage folder and read it back."""
    return df.sparkSession.read.parquet(write_table(df, name))


def load_stage(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Re-read a materialised stage table."""
    return spark.read.parquet(os.path.join(root, name))


def profile_sales(df: DataFrame) -> DataFrame:
    """One-row profile (rows, date range, distinct stores and SKUs)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.countDistinct("store_id").alias("n_stores"),
        F.countDistinct("item_id").alias("n_items"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """S5 (types): column name -> Spark type, as a DataFrame."""
    spark = df.sparkSession
    return spark.createDataFrame([(n, t) for n, t in df.dtypes], "column string, type string")
