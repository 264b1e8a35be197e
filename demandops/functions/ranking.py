"""Dense codes 0..n-1 for the distinct values of a column, in sorted order.

The distinct values are written once and measured (rows and bytes).  Small
sets are ranked with one window.  Larger ones are ranked without any
single-task step: the values are range-partitioned (range i holds only values
below range i+1), ranked inside each range, written (so the ranges cannot
change between uses), and shifted by the number of values in all earlier
ranges - a table with one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandops.sources.io import materialize
from demandops.sources.tables import fits_broadcast


def dense_codes(df: DataFrame, col: str, out: str, ranges: int | None = None) -> DataFrame:
    """(col, out) for every distinct non-NULL value of ``col``."""
    values = materialize(df.select(col).where(F.col(col).isNotNull()).distinct(), f"values_{col}")
    if fits_broadcast(values):
        return values.withColumn(out, (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))
    n = ranges or max(1, df.sparkSession.sparkContext.defaultParallelism)
    ranged = values.repartitionByRange(n, col).withColumn("_range", F.spark_partition_id())
    local = materialize(
        ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_range").orderBy(col)) - 1),
        f"codes_{col}")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (local.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
                    .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    # ``offsets`` has one row per range (bounded by ``n``): broadcast is safe
    return (local.join(F.broadcast(offsets.select("_range", "_offset")), "_range")
                 .select(col, (F.col("_offset") + F.col("_local")).cast("int").alias(out)))
