"""Sums and means of doubles that don't depend on the order of additions.

Adding doubles rounds after each step, so another partitioning, or a task that runs again, changes the last digits, and
a threshold that a sum meets to the digit may then be missed. Here each value is cut into its whole part and two
integers of BITS bits for the rest; integers add up exactly in any order, and the parts become one double at the end.
A value below 1 keeps 2 * BITS binary places, which is all of its digits from 2^-8 up and 10^-18 below that.

Values and sums have to be below 2^63, and a group may have up to 2^33 values; beyond that the integers overflow,
which is an error in Spark's ANSI mode (the default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BITS = 30
_GRID = float(1 << BITS)


def exact_sum(value: Column, over: WindowSpec | None = None) -> Column:
    """Sum of the present values, the same for any order; null without any. `over` makes it a window sum."""
    v = value.cast("double")
    # Cut towards zero, so that each rest is exact.
    whole = v.cast("long")
    scaled = (v - whole) * _GRID
    high = scaled.cast("long")
    low = ((scaled - high) * _GRID).cast("long")
    parts = [F.sum(p) if over is None else F.sum(p).over(over) for p in (whole, high, low)]
    return parts[0] + (parts[1] + parts[2] / _GRID) / _GRID


def exact_mean(value: Column, over: WindowSpec | None = None) -> Column:
    """Mean of the present values, the same for any order; null without any."""
    n = F.count(value) if over is None else F.count(value).over(over)
    return F.try_divide(exact_sum(value, over), n.cast("double"))
