"""Stage boundaries: write a derived table once, read it back.

The daily fact is the expensive boundary (a scan of the line items, two
joins and an aggregate) and is small afterwards (one row per series and
day).  Downstream plans branch (medians, encodings, windows); without a
boundary every branch would re-scan the line items, because column pruning
makes each branch's aggregate different and no shuffle can be reused.

Tables go to Parquet under the shared ``spark.checkpoint.dir`` (survives
executor loss, keeps column pruning and filter push-down on re-read).
"""

from __future__ import annotations

import os
import uuid
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from demandops.session import stage_root
from demandops.sources.fs import fingerprint, path_exists
from demandops.sources.io import materialize, write_table  # noqa: F401  (re-exported)

_MEMO: dict[tuple, tuple[str, int]] = {}


# ---------------------------------------------------------------- buckets --
# A stage written bucketed on the series key is read back with that hash
# partitioning known to the planner, so per-series windows and aggregates
# downstream need no exchange.  Bucketed tables live at an explicit location
# in the shared folder; the session catalog only keeps their definition and
# is re-pointed at the files when a new session reads a memoised stage.

def _table_name(path: str) -> str:
    return "demandops_" + os.path.basename(path.rstrip("/")).replace("-", "_")


BUCKETS_CONF = "demandops.stage.buckets"


def stage_buckets(spark: SparkSession) -> int:
    """Bucket count for stage tables: the session setting if given, else the
    cluster's default parallelism (one bucket per core), so every reading
    task gets one bucket.  All bucketed stages share it, which keeps them
    co-partitioned with each other."""
    conf = spark.conf.get(BUCKETS_CONF, None)
    return int(conf) if conf else max(1, spark.sparkContext.defaultParallelism)


def write_bucketed(df: DataFrame, name: str, keys: list[str], sort_by: list[str],
                   buckets: int | None = None) -> str:
    spark = df.sparkSession
    n = buckets or stage_buckets(spark)
    path = os.path.join(stage_root(spark, "tables"), f"{name}-{uuid.uuid4().hex[:12]}")
    # one hash shuffle on the keys first, so every bucket is one file
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet")
       .bucketBy(n, *keys).sortBy(*sort_by).option("path", path).saveAsTable(_table_name(path)))
    return path


def read_bucketed(spark: SparkSession, path: str, keys: list[str], sort_by: list[str],
                  buckets: int) -> DataFrame:
    table = _table_name(path)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} USING parquet CLUSTERED BY ({', '.join(keys)}) "
                  f"SORTED BY ({', '.join(sort_by)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def memo_table(spark: SparkSession, name: str, inputs: list[str], build,
               bucket_by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
    """Materialize ``build()`` once per unchanged set of input files;
    optionally bucketed on ``bucket_by`` (sorted by ``sort_by``)."""
    fp = fingerprint(spark, inputs)
    key = (name, fp, tuple(bucket_by or ()))
    hit = _MEMO.get(key) if fp is not None else None
    if hit is not None and path_exists(spark, hit[0]):
        path, n = hit
    elif bucket_by:
        n = stage_buckets(spark)
        try:
            path = write_bucketed(build(), name, list(bucket_by), list(sort_by or ()), n)
        except AnalysisException as e:  # no usable catalog: a plain stage, same rows
            warnings.warn(f"stage {name} is written without buckets: {e}", stacklevel=2)
            path, n = write_table(build(), name), 0
    else:
        path, n = write_table(build(), name), 0
    if fp is not None:
        _MEMO[key] = (path, n)
    if bucket_by and n:
        try:
            return read_bucketed(spark, path, list(bucket_by), list(sort_by or ()), n)
        except AnalysisException as e:  # the same files, without the bucket spec
            warnings.warn(f"stage {name} is read without buckets: {e}", stacklevel=2)
    return spark.read.parquet(path)


def memo_artifact(spark: SparkSession, name: str, inputs: list[str], save) -> str:
    """Like ``memo_table`` for artefacts written by ``save(path)`` (e.g. a
    fitted model): returns the path, saving once per unchanged input."""
    fp = fingerprint(spark, inputs)
    key = (name, fp, "artifact")
    hit = _MEMO.get(key) if fp is not None else None
    if hit is not None and path_exists(spark, hit[0]):
        return hit[0]
    path = os.path.join(stage_root(spark, "models"), f"{name}-{uuid.uuid4().hex[:12]}")
    save(path)
    if fp is not None:
        _MEMO[key] = (path, 0)
    return path
