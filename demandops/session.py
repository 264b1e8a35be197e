"""Session helpers: sensible defaults for local runs, and the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "demandops", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (a cluster brings its own).
    ``event_log_dir`` turns on Spark's event log (stage and task timings)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                          .config("spark.eventLog.dir", event_log_dir))
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    The cluster's ``spark.checkpoint.dir`` always wins; a private folder is
    only created for a local master (tests).  On a cluster without the setting
    this raises: a machine's own folder is not seen by the other executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="demandops-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    try:  # core configs may be read-only at runtime; the context dir is what counts
        spark.conf.set("spark.checkpoint.dir", path)
    except AnalysisException:
        pass
    return path


def stage_root(spark: SparkSession, name: str = "stages") -> str:
    """A folder for materialised stage tables next to the checkpoint dir."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "demandops", name)
