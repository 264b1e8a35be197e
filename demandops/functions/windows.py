"""Window helpers.

pandas rolling windows return NULL until the window is full; Spark frames
shrink at the edge.  ``strict_rolling`` guards every frame with a count so
the two agree.  All per-series windows share one (partition, order) spec so
Spark plans a single exchange and sort for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from demandops import SERIES_KEYS


def series_window(keys: Sequence[str] = SERIES_KEYS, order: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def strict_rolling(target: str, size: int, agg: Callable[[Column], Column],
                   keys: Sequence[str] = SERIES_KEYS, order: str = "date") -> Column:
    """``agg`` over the ``size`` rows before the current one; NULL unless all
    ``size`` values exist (current row excluded, no leakage)."""
    frame = series_window(keys, order).rowsBetween(-size, -1)
    return F.when(F.count(target).over(frame) == size, agg(F.col(target)).over(frame))


def trailing_strict_mean(target: str, size: int, order: str = "date",
                         exact_scale: int | None = None) -> Column:
    """Mean of the current and ``size - 1`` previous rows of an already
    aggregated (small, one row per ``order`` value) frame; NULL until full.

    Deliberately un-partitioned: only ever applied after aggregating to one
    row per date, whose size is bounded by the calendar, not by the data.
    ``exact_scale`` sums through DECIMAL for an order-independent result."""
    frame = Window.orderBy(order).rowsBetween(-(size - 1), 0)
    if exact_scale is None:
        mean = F.avg(target).over(frame)
    else:
        total = F.sum(F.col(target).cast(f"decimal(38,{exact_scale})")).over(frame)
        mean = total.cast("double") / F.lit(float(size))
    return F.when(F.count(target).over(frame) == size, mean)
