"""Exchange rates: three policies, one join.

Actual amounts use the rate of their month, Budget amounts that of their year, rolling-forecast
amounts that of the month after the forecast version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import version_rate_month
from costloom.operators.lookups import with_forecast_version


def _pair(rates: DataFrame) -> DataFrame:
    return rates.filter((F.col("From") == K.FOREIGN) & (F.col("To") == K.LOCAL))


def rate_dimension(actual: DataFrame, budget: DataFrame, r3m: DataFrame) -> DataFrame:
    """All rates as (fx_type, fx_date, FX); a year is the date of its first day."""
    year = F.make_date(F.col("Year"), F.lit(1), F.lit(1))
    parts = [("Actual", actual, F.col("Month")), ("Budget", budget, year), ("R3M", r3m, F.col("Month"))]
    frames = [
        _pair(df).select(F.lit(t).alias("fx_type"), c.cast("date").alias("fx_date"), "FX")
        for t, df, c in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _rate_date(policy: Column, month: Column, version: Column | None) -> Column:
    booked = version_rate_month(version) if version is not None else F.lit(None).cast("date")
    return (
        F.when(policy == "Actual", month)
        .when(policy == "Budget", F.trunc(month, "year").cast("date"))
        .otherwise(booked)
    )


def _join_rate(df: DataFrame, rates: DataFrame, policy: Column, when: Column) -> DataFrame:
    # Both rate columns are computed before the join, so Spark sees a plain equi-join.
    keyed = df.withColumns({"_fx_type": policy, "_fx_date": when})
    slim = rates.select(
        F.col("fx_type").alias("_r_type"), F.col("fx_date").alias("_r_date"), "FX"
    )
    cond = (F.col("_fx_type") == F.col("_r_type")) & (F.col("_fx_date") == F.col("_r_date"))
    return keyed.join(slim, cond, "left").drop("_fx_type", "_fx_date", "_r_type", "_r_date")


def add_rate(
    df: DataFrame,
    rates: DataFrame,
    month: str = "reporting_month",
    policy: str = "Actual",
    version: str = "Version",
) -> DataFrame:
    """FX column for a table of one type."""
    v = F.col(version) if policy not in ("Actual", "Budget") else None
    kind = F.lit("R3M" if v is not None else policy)
    return _join_rate(df, rates, kind, _rate_date(kind, F.col(month).cast("date"), v))


def add_rate_by_type(
    df: DataFrame, rates: DataFrame, versions: DataFrame, month: str = "reporting_month"
) -> DataFrame:
    """FX column for a table that mixes types, in one join over a computed key."""
    base = [c for c in df.columns]
    dated = with_forecast_version(df.withColumnRenamed("version", "_kept"), versions, month)
    when = _rate_date(F.col("type"), F.col(month).cast("date"), F.col("version"))
    joined = _join_rate(dated, rates, F.col("type"), when).drop("version")
    return joined.withColumnRenamed("_kept", "version").select(*base, "FX")


def foreign_to_local(amount: Column, rate: Column) -> Column:
    return amount * rate


def local_to_foreign(df: DataFrame, cols: list[str], rate: str = "FX") -> DataFrame:
    """Divide local amounts by the rate."""
    return df.withColumns({c: F.try_divide(F.col(c), F.col(rate)) for c in cols})


def tag_foreign(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Currency label USD and the Actual rate of the month."""
    out = add_rate(df.withColumn("currency", F.lit(K.FOREIGN)), rates)
    return out.withColumnRenamed("FX", "fx_rate")


def tag_local(df: DataFrame, rates: DataFrame, versions: DataFrame) -> DataFrame:
    """Currency label NTD and the rate by type."""
    out = add_rate_by_type(df.withColumn("currency", F.lit(K.LOCAL)), rates, versions)
    return out.withColumnRenamed("FX", "fx_rate")
