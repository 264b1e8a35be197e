"""Numeric helpers.

Rounding: Spark and DuckDB break exact ``round`` ties differently, so every
rounded output goes through one rule on both sides,
``rnd(x, n) = floor(x * 10^n + 0.5) / 10^n`` (round half up), applied only
to final outputs, never inside a computation.
"""

from __future__ import annotations

from decimal import Decimal
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, n: int) -> Column:
    scale = float(10 ** n)
    return F.floor(_col(c).cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def safe_div(num, den) -> Column:
    """Division that yields NULL instead of raising (ANSI) or inf."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def service_z(service_level: float) -> float:
    """Normal quantile of the service level, computed once on the driver."""
    if not 0.0 < service_level < 1.0:
        raise ValueError("service level must lie strictly between 0 and 1")
    return NormalDist().inv_cdf(service_level)


def exact_mean(c, scale: int = 10) -> Column:
    """Mean of a double column that does not depend on summation order.

    Values are summed as DECIMAL(38, scale) (exact, associative), so the
    result is identical however Spark partitions the rows; the quotient is
    one IEEE division.  Used where a mean of non-integer doubles is an
    output (integer inputs are already summed exactly)."""
    x = _col(c)
    total = F.sum(x.cast(f"decimal(38,{scale})")).cast("double")
    return total / F.count(x).cast("double")


def exact_sum(c, scale: int = 6) -> Column:
    """Sum of a double column through DECIMAL(38, scale): exact and
    associative, so independent of partitioning and summation order."""
    return F.sum(_col(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_cents(c) -> Column:
    """Sum of a double column's values as DECIMAL(18, 2), exact and the same to
    the last digit. A value that is a whole number of cents (below 20 million,
    so a sum of four billion of them fits) is added as a bigint; only another
    one goes through its decimal text."""
    x = _col(c)
    cents = F.rint(x * 100.0)
    whole = (F.abs(x) < 2e7) & (cents / 100.0 == x)
    fast = F.sum(F.when(whole, cents.cast("bigint"))).cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    rest = F.sum(F.when(~F.coalesce(whole, F.lit(False)), x.cast("decimal(18,2)")))
    return F.coalesce(fast + rest, fast, rest).cast("decimal(28,2)")


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column for display/comparison (final output only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(rnd(f.name, digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def hex_hash(*cols) -> Column:
    """0..65535 from the first four hexadecimal digits of the md5 of the
    columns' texts, joined by ``|`` (an engine-independent hash)."""
    digest = F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("bigint")
