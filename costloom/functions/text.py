"""Numbers as text, with the rounding that binary floating point implies."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1 cuts a double into two halves whose products with small integers are exact.
_HALVES = 134217729.0


def fixed2(x: Column) -> Column:
    """Two decimals, rounding the exact binary value half to even (2.675 gives 2.67).

    100*x is rounded once to a double; `rest` is the exact error of that product. The nearest
    whole number is wrong only if the double lies on a half and the error points beyond it.
    """
    x = x.cast("double")
    scaled = x * F.lit(100.0)
    cut = x * F.lit(_HALVES)
    high = cut - (cut - x)
    rest = (high * F.lit(100.0) - scaled) + (x - high) * F.lit(100.0)
    near = F.rint(scaled)
    beyond = (
        F.when((scaled - near == 0.5) & (rest > 0), F.lit(1.0))
        .when((scaled - near == -0.5) & (rest < 0), F.lit(-1.0))
        .otherwise(F.lit(0.0))
    )
    shown = ((near + beyond).cast("decimal(32,0)") * F.lit(Decimal("0.01"))).cast("string")
    return (
        F.when(x.isNull() | F.isnan(x), F.lit("nan"))
        .when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when((x < 0) & (scaled >= -0.5) & shown.startswith("0"), F.concat(F.lit("-"), shown))
        .otherwise(shown)
    )


def whole(x: Column) -> Column:
    """Nearest whole number, half to even; 'n/a' where there is none."""
    x = x.cast("double")
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(ok, F.rint(x).cast("long").cast("string")).otherwise(F.lit("n/a"))


def thousands(x: Column) -> Column:
    """Whole thousands, half to even."""
    return whole(x / F.lit(1000.0))
