"""Readers for the given Parquet tables.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan,
so callers just ``select``/``filter`` what they need.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from demandops.sources.fs import fingerprint

# A lookup side is broadcast only when its measured rows and bytes are below
# these bounds; beyond them the join stays a shuffle join (and AQE may still
# convert it at runtime from measured sizes).  Overridable per session.
BROADCAST_ROWS_CONF = "demandops.broadcast.maxRows"
DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES_CONF = "demandops.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 128 << 20


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_MEASURED: dict[tuple, int] = {}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as Spark holds it, not as a file encodes it: eight a
    column and for the row, what strings hold, and for nested values eight
    times their JSON text (an upper bound)."""
    size = F.lit(8 * (len(df.columns) + 1))
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            text = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
            size = size + F.lit(8) * F.octet_length(text)
    return size.cast("bigint")


def _measure(df: DataFrame, what: str, measure: Callable[[], int]) -> int:
    """A measure of a plain scan (+ projection), memoised per unchanged input
    files and columns so repeated plan building does not re-run the job. The
    files are named, as tables of one file each share a folder and its stamp."""
    files = sorted(df.inputFiles())
    stamp = fingerprint(df.sparkSession, sorted({os.path.dirname(f) for f in files}))
    if stamp is None:
        return measure()
    key = (what, stamp, tuple(files), tuple(df.columns) if what == "bytes" else ())
    if key not in _MEASURED:
        _MEASURED[key] = measure()
    return _MEASURED[key]


def fits_broadcast(df: DataFrame, max_rows: int | None = None, remember: bool = True) -> bool:
    """Size check for a lookup side that is a plain scan + projection of a
    table: its rows, counted first (from the files' footers), then the bytes
    of these bounded rows, against the session's bounds.  The planner's
    estimate is no such check: it comes from file sizes, and a repetitive
    table takes a small part of its real size there. Of a table that leaves
    rows out, ``remember=False``: a measure is memoised by files and columns."""
    conf = df.sparkSession.conf
    if max_rows is None:
        max_rows = int(conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))
    measure = _measure if remember else (lambda _df, _what, job: job())
    if measure(df, "rows", df.count) > max_rows:
        return False
    size = lambda: df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]
    return measure(df, "bytes", size) <= int(conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))


def hash_side(side: DataFrame, big: DataFrame) -> DataFrame:
    """``side`` of a shuffle join with ``big`` (plain scans and projections
    both): where ``big`` has at least four times its rows, marked to be hashed
    in every shuffle partition, so that neither side is sorted; a partition then
    holds few rows of it. Else the planner keeps its sort, which can spill."""
    few = 4 * _measure(side, "rows", side.count) <= _measure(big, "rows", big.count)
    return side.hint("shuffle_hash") if few else side


def maybe_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only behind the size check; otherwise the plain
    DataFrame is returned and the planner keeps a shuffle join (AQE may
    still switch to a broadcast from measured sizes)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
