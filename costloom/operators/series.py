"""Operators over monthly series.

A series has one row per month, so a window over it is bounded by the calendar (a century is
1,200 rows) however large the table is. Inputs that repeat a month are aggregated first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costloom.functions.dates import next_month


def rolling_mean(value: Column, series: list[str], order: str, n: int) -> Column:
    """Mean of this row and the n-1 before it; missing unless all n are present."""
    w = W.partitionBy(*series).orderBy(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def lagged_mean(value: Column, series: list[str], order: str, n: int = 3) -> Column:
    """Mean of the n rows before this one; missing unless all n are present."""
    w = W.partitionBy(*series).orderBy(order).rowsBetween(-n, -1)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def series_length(series: list[str]) -> Column:
    return F.count(F.lit(1)).over(W.partitionBy(*series))


def long_enough(df: DataFrame, series: list[str], n: int = 6) -> DataFrame:
    """Rows of series with at least n rows.

    Counted over the series partition, which later series operators reuse without a shuffle.
    """
    counted = df.withColumn("_rows", series_length(series))
    return counted.filter(F.col("_rows") >= n).drop("_rows")


def append_next_month(df: DataFrame, series: list[str], month: str, current: Column) -> DataFrame:
    """One more row per series, for the month after the current one, with all else missing."""
    extra = df.select(*series).distinct().withColumn(month, next_month(current))
    return df.unionByName(extra, allowMissingColumns=True)


def actual_until(month: Column, current: Column, actual: Column, planned: Column) -> Column:
    """Actual quantity up to the current month, planned quantity after it."""
    return F.when(month <= current, actual).otherwise(planned)


def spread_series(df: DataFrame, series: list[str]) -> DataFrame:
    """Distribute whole series over all shuffle partitions.

    Fitting costs much computation per row, so partitions must not be merged by their few bytes;
    a partition count that is given explicitly is kept by adaptive execution.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *series)
