"""Joining a data-derived lookup (one row per key: medians, fences, codes)
to a big table without shuffling the big table or piling a hot key into
one task.

1. The lookup is written once to the shared stage folder and measured: its
   rows, and the bytes they take as rows.  An estimate of the optimizer is
   not asked: it comes from the sizes of compressed files and can lie far
   below the real size.
2. Under ``demandops.broadcast.maxRows`` and ``demandops.broadcast.maxBytes``
   it is broadcast.
3. Beyond either bound the join is salted: the lookup is replicated over
   ``buckets`` salt values and every big-side row gets a salt from a hash of
   its own columns, so a key holding a large share of the rows is spread
   over ``buckets`` shuffle partitions.  A hint keeps the planner, which
   still sees the compressed files, from broadcasting it after all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.sources.io import materialize
from demandops.sources.tables import fits_broadcast

SALT = "_salt"


def lookup_join(big: DataFrame, lookup: DataFrame, on: Sequence[str] | None = None,
                how: str = "left", condition: Callable[[DataFrame, DataFrame], Column] | None = None,
                salt_cols: Sequence[str] | None = None, buckets: int = 32, checked: bool = False) -> DataFrame:
    """Join ``lookup`` to ``big`` on the column names ``on`` (or on
    ``condition(big, lookup)``), choosing broadcast behind a size check and a
    salted shuffle join beyond it.  ``checked``: the caller has measured that
    the lookup's values fit a broadcast."""
    def join(b: DataFrame, s: DataFrame, extra: Column | None = None) -> DataFrame:
        if condition is None:
            keys = list(on) + ([SALT] if extra is not None else [])
            return b.join(s, keys, how)
        cond = condition(b, s)
        if extra is not None:
            cond = cond & extra
        return b.join(s, cond, how)

    if checked:
        return join(big, F.broadcast(lookup))
    small = materialize(lookup, "lookup")
    if fits_broadcast(small):
        return join(big, F.broadcast(small))
    cols = list(salt_cols) if salt_cols else [c for c in big.columns if not on or c not in on]
    # rows of keys alone have nothing to tell them apart but where they lie
    salt = F.xxhash64(*cols) if cols else F.spark_partition_id()
    salted_big = big.withColumn(SALT, F.pmod(salt, F.lit(buckets)).cast("int"))
    salted_small = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).hint("merge")
    if condition is None:
        return join(salted_big, salted_small, F.lit(True)).drop(SALT)
    out = join(salted_big, salted_small, salted_big[SALT] == salted_small[SALT])
    return out.drop(salted_big[SALT]).drop(salted_small[SALT])
