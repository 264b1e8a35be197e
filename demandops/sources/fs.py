"""File-system helpers through the Hadoop FileSystem API (local disk, HDFS
and object stores alike): existence checks and input fingerprints."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_status(spark: SparkSession, path: str):
    """Hadoop FileStatus of ``path`` (any file system the cluster can reach),
    or None when it does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p) if fs.exists(p) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    return fs_status(spark, path) is not None


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple | None:
    """(path, bytes, files, folders, modification time) of the inputs, through
    the Hadoop FileSystem API so it works for local and distributed storage
    alike.  The totals cover everything below a folder, so rows added to a
    partition change the stamp; two calls a path, however many files."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return None
        total = fs.getContentSummary(p)
        out.append((path, total.getLength(), total.getFileCount(), total.getDirectoryCount(),
                    fs.getFileStatus(p).getModificationTime()))
    return tuple(out)
