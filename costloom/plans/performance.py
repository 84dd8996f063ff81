"""Staging tables to the performance tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import from_year
from costloom.functions.missing import (
    col,
    div_guarded,
    div_ieee,
    drop_null_keys,
    inf_to_null,
    sum0,
    sum_where,
)
from costloom.functions.sums import exact_sum
from costloom.operators import fx
from costloom.operators.health import health_score
from costloom.operators.joins import left_on
from costloom.operators.lookups import app_item_of, product_type, project_status
from costloom.operators.rollup import four_level, ratio
from costloom.operators.series import rolling_mean


def _app_sums() -> list[Column]:
    return [sum_where(F.col("app_item") == i, F.col("value")).alias(i) for i in K.APP_ITEMS]


def _variance_sums() -> dict[str, Column]:
    return {
        v: sum_where(F.col("line_item") == item, F.col("value"))
        for item, v in K.VARIANCE_OF_ITEM.items()
    }


def _income(df: DataFrame) -> DataFrame:
    """Value added, and what is left of it after the other costs."""
    df = df.withColumn("mva", F.col("revenue") - F.col("material_cost"))
    left = F.col("mva") - F.col("other_cost") - F.col("opex") - F.col("moh")
    return df.withColumn("operating_income", left)


def ledger_stats(ledger: DataFrame, merge_map: DataFrame) -> DataFrame:
    """Reporting items and variances per (month, product, type), from one aggregate."""
    keys = ["reporting_month", "product", "type"]
    mapped = drop_null_keys(app_item_of(ledger, merge_map), keys)
    grouped = mapped.groupBy(*keys).agg(
        *_app_sums(),
        *[c.alias(f"_v_{v}") for v, c in _variance_sums().items()],
        F.count("app_item").alias("_mapped"),
    )
    out = _income(grouped.filter(F.col("_mapped") > 0)).withColumns(
        {
            "material_total_variance": F.col("_v_price_variance") + F.col("_v_usage_variance"),
            "revenue_amt_for_scrap": F.col("_v_shipment") + F.col("_v_allowance"),
        }
    )
    unit = div_guarded(F.col("material_total_variance"), F.col("production_volume"))
    drop = [f"_v_{v}" for v in K.VARIANCE_OF_ITEM.values()]
    return out.withColumn("material_unit_variance", unit).drop("_mapped", *drop)


def perf_kpi_model(
    kpi: DataFrame,
    ledger: DataFrame,
    unit_moh: DataFrame,
    merge_map: DataFrame,
    dim_project: DataFrame,
    weights: DataFrame,
    first_year: int = K.FIRST_YEAR,
) -> DataFrame:
    """KPI rows with Actual results, unit overhead and health score (app.perf_kpi_model)."""
    keys = ["reporting_month", "product"]
    averaged = drop_null_keys(kpi, ["product"]).withColumn(
        "inventory", rolling_mean(F.col("inventory"), ["product"], "reporting_month", 2)
    )
    actual = ledger_stats(ledger.filter(F.col("type") == "Actual"), merge_map)
    moh = drop_null_keys(unit_moh, keys).groupBy(*keys).agg(
        sum0(F.col("unit_moh_actual")).alias("unit_moh_actual"),
        sum0(F.col("unit_moh_quote")).alias("unit_moh_quote"),
    )
    joined = averaged.join(actual, keys, "left").join(moh, keys, "left")
    scored = health_score(project_status(joined, dim_project), weights)
    return (
        scored.drop("project_status")
        # Column names of the KPI table, and of the output table.
        .withColumnsRenamed(
            {
                "ads_target": "fg_ads_target",
                "inventory": "avg_inventory_for_ads",
                "cogs": "cogs_for_ads",
                "scrap_rate": "fg_scrap_rate_target",
                "yield_rate_current_target": "yield_rate_curr_target",
                "max_capacity_volume": "max_capacity",
                "production_volume": "production",
                "shipment_volume": "shipment",
            }
        )
        .filter(from_year(F.col("reporting_month"), first_year))
    )


def overview_stats(ledger: DataFrame, merge_map: DataFrame) -> DataFrame:
    """Reporting items per (month, bg, site, product, type); the amount that scrap is compared
    with is that of the whole (month, product, type).

    The ledger is aggregated once; the coarser sum is a window over the few site rows of a
    product and month.
    """
    coarse = ["reporting_month", "product", "type"]
    mapped = drop_null_keys(app_item_of(ledger, merge_map), coarse)
    sums = _variance_sums()
    fine = mapped.groupBy("reporting_month", "bg", "site", "product", "type").agg(
        *_app_sums(),
        sums["shipment"].alias("_ship"),
        sums["allowance"].alias("_allow"),
        F.count("app_item").alias("_mapped"),
    )
    w = W.partitionBy(*coarse)
    fine = fine.withColumn(
        "revenue_amt_for_scrap", exact_sum(F.col("_ship"), w) + exact_sum(F.col("_allow"), w)
    )
    kept = drop_null_keys(fine, ["bg", "site"]).filter(F.col("_mapped") > 0)
    return _income(kept).drop("_ship", "_allow", "_mapped")


def quoted_moh(unit_moh: DataFrame, with_quantity: bool = False) -> DataFrame:
    """Quoted unit overhead per (month, product), without the quantity row unless asked for."""
    keys = ["reporting_month", "product"]
    rows = drop_null_keys(unit_moh, keys)
    if not with_quantity:
        item = F.col("moh_item")
        rows = rows.filter(item.isNull() | (item != K.PRODUCTION_QUANTITY))
    return rows.groupBy(*keys).agg(sum0(F.col("unit_moh_quote")).alias("unit_moh_quote"))


def perf_overview_model(
    ledger: DataFrame,
    kpi: DataFrame,
    unit_moh: DataFrame,
    merge_map: DataFrame,
    rates: DataFrame,
    versions: DataFrame,
    first_year: int = K.FIRST_YEAR,
) -> DataFrame:
    """Results by type with scrap rate and quote (app.perf_overview_model)."""
    keys = ["reporting_month", "bg", "site", "product", "type"]
    feed = kpi.withColumn("type", F.lit("Actual"))
    joined = left_on(overview_stats(ledger, merge_map), feed, keys, ["ads", "fg_scrap_amount"])
    joined = joined.withColumn("scrap_rate", ratio("fg_scrap_amount", "revenue_amt_for_scrap"))
    quoted = joined.join(quoted_moh(unit_moh), ["reporting_month", "product"], "left")
    tagged = fx.tag_local(quoted.withColumn("bu", F.lit(K.BU)), rates, versions)
    return tagged.withColumnsRenamed(
        {"production_volume": "production", "shipment_volume": "shipment"}
    ).filter(from_year(F.col("reporting_month"), first_year))


OVERVIEW_SUMS = [
    "revenue", "mva", "material_cost", "other_cost", "opex", "operating_income", "moh",
    "production", "shipment",
]
KPI_SUMS = ["cogs_for_ads", "avg_inventory_for_ads", "fg_scrap_amount", "revenue_amt_for_scrap"]


def overview_ratios(sums: DataFrame) -> DataFrame:
    """Scrap rate and days of stock from summed parts."""
    return sums.withColumns(
        {
            "scrap_rate": ratio("fg_scrap_amount", "revenue_amt_for_scrap"),
            "ads": ratio("avg_inventory_for_ads", "cogs_for_ads") * F.lit(30.0),
        }
    )


def first_targets(perf_kpi: DataFrame) -> Column:
    """Stock and scrap targets of the earliest KPI row, as one struct."""
    first = F.struct("reporting_month", "product")
    return perf_kpi.agg(
        F.min_by(
            F.struct(F.col("fg_ads_target").alias("ads"), F.col("fg_scrap_rate_target").alias("scrap_rate")),
            first,
        ).alias("targets")
    ).scalar()


def perf_overview_all(
    perf_kpi: DataFrame,
    overview: DataFrame,
    dim_project: DataFrame,
    rates: DataFrame,
    versions: DataFrame,
) -> DataFrame:
    """Four-level results with stock days and scrap rate (app.perf_overview_all).

    Rows of other types than Actual show the targets instead.
    """
    keys = ["reporting_month", "product", "type"]
    feed = perf_kpi.withColumn("type", F.lit("Actual"))
    results = overview.select("reporting_month", "bg", "site", "product", "type", *OVERVIEW_SUMS)
    base = product_type(left_on(results, feed, keys, KPI_SUMS), dim_project)
    rolled = four_level(
        base, ["bg", "reporting_month", "type"], [*OVERVIEW_SUMS, *KPI_SUMS], post=overview_ratios
    ).drop(*KPI_SUMS)
    planned = F.col("type") != "Actual"
    shown = rolled.withColumn("_t", first_targets(perf_kpi)).withColumns(
        {
            n: F.when(planned, F.col(f"_t.{n}")).otherwise(F.col(n))
            for n in ("ads", "scrap_rate")
        }
    )
    return fx.tag_local(shown.drop("_t"), rates, versions)


HEALTH_SUMS = [
    "shipment", "production", "apr", "material_total_variance", "revenue", "moh",
    "yield_volume", "yield_target_volume", "avg_inventory_for_ads", "cogs_for_ads",
]


def health_kpi_model(perf_kpi: DataFrame, overview: DataFrame) -> DataFrame:
    """KPI ratios per product and month (app.health_kpi_model)."""
    keys = ["reporting_month", "product"]
    ratios = perf_kpi.withColumns(
        {
            "shipment_rate": ratio("shipment", "apr"),
            "production_rate": ratio("production", "apr"),
            "material_cost_variance": ratio("material_total_variance", "revenue"),
        }
    ).drop("moh")
    per_unit = div_ieee(F.col("moh"), F.col("production"))
    actual = overview.filter(F.col("type") == "Actual").select(
        *keys, "moh", div_ieee(per_unit, F.col("unit_moh_quote")).alias("unit_moh_rate")
    )
    joined = ratios.join(actual, keys, "left")
    names = ["shipment_rate", "production_rate", "material_cost_variance", "unit_moh_rate"]
    return joined.withColumns({n: inf_to_null(col(n)) for n in names})


def health_ratios(sums: DataFrame) -> DataFrame:
    """Group rates from summed parts; the quote is the mean over products."""
    per_unit = ratio("moh", "production")
    rates = {
        "shipment_rate": ratio("shipment", "apr"),
        "production_rate": ratio("production", "apr"),
        "material_cost_variance": ratio("material_total_variance", "revenue"),
        "unit_moh_rate": div_ieee(per_unit, F.col("unit_moh_quote")),
        "yield_rate": ratio("yield_volume", "production"),
        "yield_rate_curr_target": ratio("yield_target_volume", "production"),
        "ads": ratio("avg_inventory_for_ads", "cogs_for_ads") * F.lit(30.0),
    }
    return sums.select(
        "bg", "reporting_month", "cat_ind", *[inf_to_null(c).alias(n) for n, c in rates.items()]
    )


def health_kpi_group(health: DataFrame, dim_project: DataFrame) -> DataFrame:
    """Four-level health rates (app.health_kpi_group)."""
    typed = product_type(health, dim_project).withColumns(
        {
            "yield_volume": F.col("yield_rate") * F.col("production"),
            "yield_target_volume": F.col("yield_rate_curr_target") * F.col("production"),
        }
    )
    return four_level(
        typed, ["bg", "reporting_month"], HEALTH_SUMS, means=["unit_moh_quote"], post=health_ratios
    )
