"""Helpers shared by the corpus operators: shared scratch tables, size-checked
joins, fixed-size Bloom filters and distributed ranks."""

from __future__ import annotations

import gc
import sys
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandops.session import ensure_checkpoint_dir

#: Largest side (rows) that ``sized_join`` broadcasts: keys of 8-16 bytes, so
#: some tens of MB at most. Beyond it the join shuffles.
BROADCAST_ROWS = 400_000
#: Bloom filter size bound: 2^15 blocks of 8 longs = 2 MB of bits, whatever
#: the number of keys. A fuller filter passes more rows, never fewer.
MAX_BLOOM_BLOCKS = 1 << 15


#: Rows of an Arrow batch: whole texts, so fewer than Spark's 10,000.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for tasks that read whole texts, unless the
    session has already set a smaller number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def drop_kept() -> None:
    """In a task: give back what earlier operators left in this Python worker
    (workers live on, and each keeps its word cache for the next task)."""
    if sys.modules.pop("_word_encoders", None) is not None:
        gc.collect()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/demandops-llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    fixes generated ids and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*dfs: DataFrame) -> None:
    """Delete scratch tables that no later plan reads."""
    for df in dfs:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(conf).delete(hpath, True)


def sized_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
               rows: int | None = None) -> DataFrame:
    """Broadcast ``small`` only behind a count of its rows; beyond
    ``BROADCAST_ROWS`` both sides shuffle (AQE splits skewed partitions)."""
    n = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, list(on), how)


def text_digest(text: Column) -> list[Column]:
    """128 bits of a text in two columns, t1 and t2; null is the empty text."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit("second"), t).alias("t2")]


def shield(df: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with all but the ``needed`` columns renamed out of the way of an
    operator's own names, and the function that gives them back: of a result,
    it selects the columns of ``df`` (but those that ``added`` replaces) and
    ``added``."""
    now = [c if c in needed else f"_extra{i}" for i, c in enumerate(df.columns)]

    def restore(out: DataFrame, *added: str) -> DataFrame:
        lower = {a.lower() for a in added}
        return out.select(*[F.col(n).alias(c) if n != c else F.col(f"`{c}`")
                            for n, c in zip(now, df.columns) if c.lower() not in lower], *added)
    return df.toDF(*now), restore


def aside(keep: Sequence[str], results: Sequence[str]) -> tuple[list[Column], list[Column]]:
    """The columns ``keep`` of a table under names that no operator uses, and
    the same columns back under their own. One named like a column of the
    ``results`` is left out, as the result replaces it."""
    taken = {c.lower() for c in results}
    named = [c for c in keep if c.lower() not in taken]
    return ([F.col(f"`{c}`").alias(f"_kept{i}") for i, c in enumerate(named)],
            [F.col(f"_kept{i}").alias(c) for i, c in enumerate(named)])


def drop_texts(docs: DataFrame, keys: DataFrame, text: str) -> DataFrame:
    """Rows of ``docs`` whose text digest is not in ``keys`` (t1, t2). A
    fixed-size filter keeps all other texts out of the exact anti join."""
    plain, restore = shield(docs, [text])
    blocks = bloom_blocks(keys.count())
    bloom = bloom_build(keys, ["t1", "t2"], blocks)
    d1, d2 = text_digest(F.col(f"`{text}`"))
    flagged = bloom_probe(plain.select("*", d1, d2), bloom, ["t1", "t2"], blocks, "_maybe")
    left = flagged.filter("_maybe").join(keys, ["t1", "t2"], "left_anti")
    return restore(flagged.filter("not _maybe").unionByName(left))


# -- fixed-size blocked Bloom filter ------------------------------------------

def _block(keys: Sequence[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")


def _masks(keys: Sequence[Column]) -> list[Column]:
    """One bit in each of the eight 64-bit words of a block, by a second hash."""
    h = F.xxhash64(F.lit("bloom"), *keys)
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * j).bitwiseAND(F.lit(63)).cast("int"))
            for j in range(8)]


def bloom_blocks(n_keys: int, bits_per_key: int = 16) -> int:
    """Blocks for ``n_keys`` keys, a power of two under ``MAX_BLOOM_BLOCKS``."""
    need, blocks = n_keys * bits_per_key / 512, 16
    while blocks < need and blocks < MAX_BLOOM_BLOCKS:
        blocks *= 2
    return blocks


def bloom_build(df: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """Blocked Bloom filter as a table of at most ``blocks`` rows: the eight
    words of every block, OR-ed map-side before the shuffle."""
    cols = [F.col(k) for k in keys]
    rows = df.select(_block(cols, blocks).alias("_block"),
                     *[m.alias(f"_m{j}") for j, m in enumerate(_masks(cols))])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_m{j}").alias(f"_w{j}") for j in range(8)])


def bloom_probe(df: DataFrame, bloom: DataFrame, keys: Sequence[str], blocks: int,
                flag: str | None = None) -> DataFrame:
    """Rows of ``df`` that the filter may hold (``flag=None``), or all rows
    with a boolean ``flag`` column. Null keys never pass. The filter's size is
    bounded by ``MAX_BLOOM_BLOCKS``, so it is broadcast."""
    cols = [F.col(k) for k in keys]
    full = F.lit(True)
    for j, m in enumerate(_masks(cols)):
        full = full & (F.col(f"_w{j}").bitwiseAND(m) == m)
    for c in cols:
        full = full & c.isNotNull()
    words = [f"_w{j}" for j in range(8)]
    joined = df.withColumn("_block", _block(cols, blocks)).join(
        F.broadcast(bloom), "_block", "inner" if flag is None else "left")
    if flag is None:
        return joined.filter(full).drop("_block", *words)
    return joined.withColumn(flag, F.coalesce(full, F.lit(False))).drop("_block", *words)


# -- distributed ranks ---------------------------------------------------------

def global_rank(df: DataFrame, order: Sequence[str], rank: str, name: str,
                partitions: int | None = None) -> DataFrame:
    """Dense 0-based rank by ``order`` without a global window: range-sort,
    number the rows of each partition, add the partitions' offsets (one row a
    partition). The numbered rows are written first, so ids are fixed."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    numbered = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .withColumn("_mid", mid), name)
    pid, idx = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(pid.alias("_pid")).agg(F.count("*").alias("_n"))
    w = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = (numbered.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
           .withColumn(rank, F.col("_off") + idx).drop("_pid", "_mid", "_off"))
    out._scratch_path = numbered._scratch_path
    return out
