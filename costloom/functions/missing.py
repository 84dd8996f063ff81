"""Missing-value and division rules.

NaN becomes null when data enters; inside the engine a missing value is always null. Infinities
appear only in ratios that a rule compares, and are nulled before anything is stored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costloom.functions.sums import exact_sum

INF = float("inf")


def col(name: str) -> Column:
    """Column by its literal name, also when the name holds dots or spaces."""
    return F.col(f"`{name}`")


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Remove rows whose grouping key is missing (they belong to no group)."""
    for key in keys:
        df = df.filter(col(key).isNotNull())
    return df


def sum0(c: Column) -> Column:
    """Sum that is 0 for a group without any value."""
    return F.coalesce(exact_sum(c), F.lit(0.0))


def sum_where(cond: Column, value: Column) -> Column:
    """Sum over matching rows: 0 if rows match without a value, null if no row matches."""
    hit = F.count(F.when(cond, F.lit(1)))
    return F.when(hit > 0, F.coalesce(exact_sum(F.when(cond, value)), F.lit(0.0)))


def total0(*cols: Column) -> Column:
    """Row total that counts missing parts as 0."""
    total = F.coalesce(cols[0], F.lit(0.0))
    for c in cols[1:]:
        total = total + F.coalesce(c, F.lit(0.0))
    return total


def div_guarded(a: Column, b: Column) -> Column:
    """a / b where b is positive, else null."""
    return F.when(b > 0, a / b)


def div_ieee(a: Column, b: Column) -> Column:
    """Floating-point division: x/0 is an infinity, 0/0 is null."""
    a, b = a.cast("double"), b.cast("double")
    at_zero = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, at_zero).otherwise(F.try_divide(a, b))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """True for a present, finite number."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < INF)


def inf_to_null(c: Column) -> Column:
    return F.when(F.abs(c) != INF, c)


def _floating(df: DataFrame) -> list[str]:
    kinds = (T.DoubleType, T.FloatType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def inf_to_null_all(df: DataFrame) -> DataFrame:
    """Null every infinity in the floating-point columns."""
    return df.withColumns({n: inf_to_null(col(n)) for n in _floating(df)})


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Null every NaN in the floating-point columns; applied when data enters."""
    return df.withColumns({n: nan_to_null(col(n)) for n in _floating(df)})


def fill_zero(df: DataFrame, text: str = "") -> DataFrame:
    """Fill missing numbers with 0 and missing text with a placeholder."""
    filled = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            filled[f.name] = F.coalesce(col(f.name), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            filled[f.name] = F.coalesce(col(f.name), F.lit(text))
    return df.withColumns(filled)


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def holds(pred: Column) -> Column:
    """A comparison with a missing side is false."""
    return F.coalesce(pred, F.lit(False))


def clamp01(c: Column) -> Column:
    """Limit a present value to [0, 1]; a missing value stays missing."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def at_most_one(c: Column) -> Column:
    return F.when(c.isNotNull(), F.least(c, F.lit(1.0)))


def greatest_first(a: Column, b: Column) -> Column:
    """Larger of two values; missing when the first is missing, the first when the second is."""
    return F.when(a.isNotNull(), F.greatest(a, b))


def any_of(c: Column, values: Sequence[str]) -> Column:
    """Set membership, false for a missing value."""
    return holds(c.isin(list(values)))
