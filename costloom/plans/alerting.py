"""Inputs of the alert rules, and the alert tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import months_in_production, within_next_months
from costloom.functions.missing import any_of, drop_null_keys, sum0
from costloom.functions.sums import exact_mean
from costloom.operators import alerts
from costloom.operators.lookups import line_item_short, params_row
from costloom.operators.reshape import stack


def max_future_mps(perf_kpi: DataFrame, current: Column, months: int = 6) -> DataFrame:
    """Largest planned volume of each product in the months after the current one."""
    future = perf_kpi.filter(within_next_months(F.col("reporting_month"), current, months))
    return drop_null_keys(future, ["product"]).groupBy("product").agg(F.max("mps").alias("max_mps"))


def fixed_moh_cost(unit_moh: DataFrame) -> DataFrame:
    """Sum of the fixed overhead items per product."""
    rows = unit_moh.filter(any_of(F.col("moh_item"), K.FIXED_MOH_ALERT))
    return drop_null_keys(rows, ["product"]).groupBy("product").agg(
        sum0(F.col("unit_moh_actual")).alias("fixed_moh_cost")
    )


def price_and_usage_variance(ledger: DataFrame) -> DataFrame:
    """Actual purchase price and usage variance per product, from one aggregate."""
    item, value = F.col("line_item"), F.col("value")
    rows = ledger.filter((F.col("type") == "Actual") & item.isin(K.PPV, K.MUV))

    def part(name: str) -> Column:
        hit = F.count(F.when(item == name, F.lit(1)))
        return F.when(hit > 0, sum0(F.when(item == name, value)))

    return drop_null_keys(rows, ["product"]).groupBy("product").agg(
        part(K.PPV).alias("ppv"), part(K.MUV).alias("muv")
    )


def production_age(dim_project: DataFrame, current: Column) -> DataFrame:
    """Months since the start of mass production per product."""
    started = dim_project.filter(F.col("mp_start_month").isNotNull())
    return started.select(
        "product", months_in_production(current, F.col("mp_start_month")).alias("mp_no_of_month")
    )


def alert_base(
    perf_kpi: DataFrame, unit_moh: DataFrame, ledger: DataFrame, dim_project: DataFrame, current: Column
) -> DataFrame:
    """KPI rows of the current month with everything the rules need."""

    def of_month(df: DataFrame) -> DataFrame:
        return df.filter(F.col("reporting_month") == current)

    return (
        of_month(perf_kpi)
        .join(max_future_mps(perf_kpi, current), "product", "left")
        .join(fixed_moh_cost(of_month(unit_moh)), "product", "left")
        .join(production_age(dim_project, current), "product", "left")
        .join(price_and_usage_variance(of_month(ledger)), "product", "left")
    )


def kpi_with_unit_moh(base: DataFrame, unit_moh: DataFrame, current: Column) -> DataFrame:
    """KPI rows with every overhead item of the current month."""
    items = unit_moh.filter(F.col("reporting_month") == current).select(
        "product", "moh_item", "unit_moh_actual", "unit_moh_r3m", "unit_moh_quote"
    )
    return base.select("reporting_month", "product", "production").join(items, "product", "left")


SITE_MEASURES = [f"{t.lower()}_{m}" for t in K.TYPES for m in ("total_cost", "shipment")]


def site_alert_base(
    base: DataFrame, detail: DataFrame, control: DataFrame, current: Column
) -> DataFrame:
    """Other cost and operating expense of the current month per site and item."""
    rows = detail.filter(
        (F.col("reporting_month") == current)
        & any_of(F.col("cost_box_group"), K.ALERT_COST_GROUPS)
    )
    keys = ["reporting_month", "product", "cost_item_level1"]
    monthly = drop_null_keys(rows, keys).groupBy(*keys).agg(
        *[sum0(F.col(m)).alias(m) for m in SITE_MEASURES if m.endswith("total_cost")],
        *[exact_mean(F.col(m)).alias(m) for m in SITE_MEASURES if m.endswith("shipment")],
    )
    named = line_item_short(monthly, control).select("product", "line_item_short", *SITE_MEASURES)
    joined = base.select("reporting_month", "site", "product", "revenue").join(
        named, "product", "left"
    )
    groups = ["reporting_month", "site", "line_item_short"]
    return drop_null_keys(joined, groups).groupBy(*groups).agg(
        *[sum0(F.col(m)).alias(m) for m in ["revenue", *SITE_MEASURES]]
    )


def all_alerts(
    base: DataFrame, site_base: DataFrame, params: DataFrame, impact: float = K.IMPACT
) -> DataFrame:
    """Alerts of both generators, without ids."""
    values = params_row(params, ["corp_funding_rate", "scrap_target"])
    kpi = alerts.kpi_alerts(alerts.kpi_flags(base, values, impact))
    return stack(kpi, alerts.site_alerts(alerts.site_flags(site_base, impact)))
