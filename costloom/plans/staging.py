"""Raw templates to staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import december_before, month_start, parse_month, parse_version
from costloom.functions.missing import any_of, col, div_ieee, positive_or_null
from costloom.operators import fx
from costloom.operators.joins import align_apart, left_lookup, missing_keys
from costloom.operators.lookups import (
    item_code,
    item_description,
    latest_by,
    model_code_of_product,
    site_of_product,
)
from costloom.operators.reshape import melt, pivot_mean, split_rows
from costloom.operators.watch import counted


def dim_project(project_info: DataFrame) -> DataFrame:
    """Project template to staging.dim_project."""
    return project_info.withColumnsRenamed(
        {
            "Project name": "product",
            "Site": "site",
            "AllieCode Name": "product_code",
            "Product Type": "product_type",
            "Current stage": "project_status",
            "MP Start": "mp_start_month",
            "NPI Start": "npi_start_month",
            "Shipment Start": "shipment_start_month",
        }
    ).withColumns({"bg": F.lit(K.BG), "bu": F.lit(K.BU)})


def product_status(dim: DataFrame) -> DataFrame:
    """staging.dim_project to app.health_product_status."""
    return dim.withColumnRenamed("project_status", "product_status")


def with_shipped_units(pl: DataFrame) -> DataFrame:
    """Shipped units, taken from the invoiced units where they are missing."""
    return pl.withColumn(
        K.SHIPPED_UNITS, F.coalesce(col(K.SHIPPED_UNITS), col(K.INVOICED_UNITS))
    )


def _currency(desc: Column) -> Column:
    """Quantities have no currency."""
    return F.when(~desc.contains("quantity"), F.lit(K.LOCAL))


def _described(pl: DataFrame, ids: list[str], items_map: DataFrame, codes: DataFrame) -> DataFrame:
    long = item_description(melt(with_shipped_units(pl), ids), items_map)
    known = long.filter(F.col("accounting_item_desc").isNotNull())
    return item_code(known, codes).withColumns(
        {
            "currency": _currency(F.col("accounting_item_desc")),
            "Period": parse_month(F.col("Period")),
        }
    )


def normalise_pl(
    pl: DataFrame, items_map: DataFrame, codes: DataFrame, rates: DataFrame, kind: str
) -> DataFrame:
    """A raw profit-and-loss table as long rows: latest version, named items, rate, constants.

    `kind` is the type of the table: Actual, Budget or R3M.
    """
    dated = pl.withColumn("Version", parse_version(F.col("Version")))
    measures = [c for c in pl.columns if c not in K.PL_IDS and c != "Version"]
    latest = latest_by(dated, ["Period", "Project"], "Version", ["Site", *measures])
    long = _described(latest, [*K.PL_IDS, "Version"], items_map, codes)
    return fx.add_rate(long, rates, "Period", kind).withColumns(
        {"type": F.lit(kind), "bg": F.lit(K.BG), "bu": F.lit(K.BU)}
    )


def _ledger_rows(df: DataFrame) -> DataFrame:
    """Rows with an item group, and quantities."""
    return df.filter(F.col("accounting_item_group").isNotNull() | F.col("currency").isNull())


def pl_to_ledger(normal: DataFrame) -> DataFrame:
    """Normalised budget or forecast rows to staging.tbl_is_modeltype."""
    return _ledger_rows(normal).withColumnsRenamed(
        {
            "Period": "reporting_month",
            "Site": "site",
            "Project": "product",
            "accounting_item_group": "line_itm_group",
            "accounting_item_desc": "line_item",
            "FX": "fx_rate",
            "Version": "version",
        }
    )


def pl_to_moh_raw(normal: DataFrame, project_info: DataFrame, kind: str) -> DataFrame:
    """Normalised rows without an item group to raw.moh_raw (quantities are among them)."""
    rows = normal.filter(F.col("accounting_item_group").isNull())
    fixed = any_of(F.col("accounting_item_desc"), K.FIXED_MOH_INPUT)
    rows = model_code_of_product(
        rows.withColumn("MOH_item_type", F.when(fixed, "Fixed").otherwise("Variable")),
        project_info,
        "Project",
    )
    return rows.select(
        "Site",
        F.col("AllieCode Name").alias("model_code"),
        F.col("Project").alias("model_name"),
        F.lit(kind).alias("type"),
        "MOH_item_type",
        "accounting_item_desc",
        F.col("value").alias("amount"),
        "currency",
        F.col("Period").alias("period_start"),
        F.lit(K.UPDATE_FREQUENCY).alias("update_frequency"),
        F.col("Period").alias("last_update_time"),
        F.col("Period").alias("stat_dt"),
    )


def actual_to_is_model(history: DataFrame, items_map: DataFrame, codes: DataFrame) -> DataFrame:
    """Actual history (no versions) to raw.is_model."""
    rows = _ledger_rows(_described(history, K.PL_IDS, items_map, codes))
    return rows.select(
        F.lit(K.PROFIT_CENTER).alias("profit_center"),
        F.lit(K.PROFIT_CENTER_NAME).alias("profit_center_name"),
        F.lit("").alias("model_code"),
        F.col("Project").alias("model_name"),
        "accounting_item_code",
        "accounting_item_group",
        "accounting_item_desc",
        F.col("value").alias("amount"),
        "currency",
        F.col("Period").alias("period_start"),
        F.col("Period").alias("last_update_time"),
        F.col("Period").alias("stat_dt"),
        F.lit(K.UPDATE_FREQUENCY).alias("update_frequency"),
    )


def is_model_to_ledger(
    is_model: DataFrame, project_info: DataFrame, rates: DataFrame
) -> DataFrame:
    """raw.is_model to staging.tbl_is_modeltype."""
    df = site_of_product(is_model.withColumn("type", F.lit("Actual")), project_info, "model_name")
    df = fx.add_rate(df, rates, "period_start")
    return df.withColumns(
        {"bu": F.lit(K.BU), "version": december_before(F.col("period_start"))}
    ).withColumnsRenamed(
        {
            "period_start": "reporting_month",
            "profit_center_name": "bg",
            "Site": "site",
            "model_name": "product",
            "accounting_item_group": "line_itm_group",
            "accounting_item_desc": "line_item",
            "amount": "value",
            "FX": "fx_rate",
        }
    )


def split_quantity(df: DataFrame, amount: str = "amount") -> tuple[DataFrame, DataFrame]:
    """Production quantity rows and cost rows; invoice quantity is left out and amounts that are
    not positive become missing."""
    desc = F.col("accounting_item_desc")
    kept = df.filter(desc.isNull() | (desc != K.INVOICE_QUANTITY)).withColumn(
        amount, positive_or_null(F.col(amount))
    )
    return split_rows(kept, desc == K.PRODUCTION_QUANTITY)


def quote_by_item(
    quote: DataFrame, items_map: DataFrame, rates: DataFrame
) -> DataFrame:
    """Quoted unit overhead in local currency: (Period, Project, item, unit_moh_quote)."""
    long = item_description(melt(quote, K.PL_IDS), items_map)
    known = long.filter(F.col("accounting_item_desc").isNotNull()).withColumn(
        "Period", parse_month(F.col("Period"))
    )
    _, costs = split_quantity(fx.add_rate(known, rates, "Period"), "value")
    return costs.select(
        F.col("Period").alias("period_start"),
        F.col("Project").alias("model_name"),
        "accounting_item_desc",
        fx.foreign_to_local(F.col("value"), F.col("FX")).alias("unit_moh_quote"),
    )


def unit_moh(moh_raw: DataFrame, quotes: DataFrame) -> DataFrame:
    """raw.moh_raw to staging.tbl_unitmoh_monthly: mean cost per produced unit, with quotes.

    Quantities are matched on month and product, not on site.
    """
    quantity, costs = split_quantity(moh_raw)
    keys = ["period_start", "Site", "model_name", "accounting_item_desc"]
    cost_by_type = pivot_mean(costs, keys, "type", "amount", K.TYPES)
    units = pivot_mean(
        quantity, keys, "type", "amount", {t: f"{t}_quantity" for t in K.TYPES}
    ).drop("Site", "accounting_item_desc")
    place = ["period_start", "model_name"]
    joined = counted("produced_units: " + ", ".join(place), cost_by_type, units, place, lambda df: df.join(units, place, "left"))
    per_unit = joined.withColumns(
        {t: div_ieee(F.col(t), F.col(f"{t}_quantity")) for t in K.TYPES}
    )
    item = [*place, "accounting_item_desc"]
    quoted = counted("quotes: " + ", ".join(item), per_unit, quotes, item, lambda df: df.join(quotes, item, "left"))
    return quoted.select(
        F.col("period_start").alias("reporting_month"),
        F.lit(K.BG).alias("bg"),
        F.lit(K.BU).alias("bu"),
        F.col("Site").alias("site"),
        F.col("model_name").alias("product"),
        F.col("accounting_item_desc").alias("moh_item"),
        F.col("Actual").alias("unit_moh_actual"),
        F.col("Budget").alias("unit_moh_budget"),
        F.col("R3M").alias("unit_moh_r3m"),
        "unit_moh_quote",
        F.lit(K.LOCAL).alias("currency"),
    )


KPI_KEYS = ["Model", "Month"]


def kpi_feeds(
    ads: DataFrame, apr: DataFrame, mps: DataFrame, scrap: DataFrame, yields: DataFrame, capacity: DataFrame
) -> dict[str, DataFrame]:
    """The columns of six monthly feeds that the KPI table takes, by model and month."""
    scrap = scrap.withColumnRenamed("W_Model", "Model").withColumn("Month", month_start(F.col("Month")))
    keys = KPI_KEYS
    return {
        "ADS": ads.select(*keys, "ADS", "COGS NTD", "Inventory NTD", "ads_target"),
        "APR": apr.withColumnRenamed("project", "Model").select(*keys, "APR _volume"),
        "MPS": mps.withColumnRenamed("project", "Model").select(*keys, "MPS _volume"),
        "Scrap amount": scrap.select(*keys, "Actual Scrap AMT_USD", "scrap_rate"),
        "yield rate": yields.select(*keys, "Yield rate", "yield_rate_current_target", "yield_rate_final_target"),
        "Max capacity": capacity.select(*keys, "Units"),
    }


def missing_feed_keys(feeds: dict[str, DataFrame]) -> DataFrame:
    """(feed, n): rows of each feed without model or month."""
    return missing_keys(feeds, KPI_KEYS)


def kpi_model(
    ads: DataFrame,
    apr: DataFrame,
    mps: DataFrame,
    scrap: DataFrame,
    yields: DataFrame,
    capacity: DataFrame,
    project_info: DataFrame,
    rates: DataFrame,
    unique: bool = False,
) -> DataFrame:
    """Six monthly feeds to staging.tbl_kpi_model, one row per model and month.

    Rows that miss their model or month match nothing and stay, each in a row of its own. `unique=True` says that
    no feed repeats a model and month; one shuffle then does it all.
    """
    feeds = kpi_feeds(ads, apr, mps, scrap, yields, capacity)
    joined = align_apart(list(feeds.values()), KPI_KEYS, unique)
    rated = fx.add_rate(joined, rates, "Month").withColumns(
        {
            "Actual Scrap AMT_USD": fx.foreign_to_local(
                col("Actual Scrap AMT_USD"), F.col("FX")
            ),
            "currency": F.lit(K.LOCAL),
            "bg": F.lit(K.BG),
            "bu": F.lit(K.BU),
        }
    )
    placed = left_lookup(rated, project_info, "Model", "Project name", {"Site": "site"}, "site_of_product")
    return placed.withColumnsRenamed(
        {
            "Model": "product",
            "Month": "reporting_month",
            "ADS": "ads",
            "COGS NTD": "cogs",
            "Inventory NTD": "inventory",
            "Actual Scrap AMT_USD": "fg_scrap_amount",
            "Yield rate": "yield_rate",
            "APR _volume": "apr",
            "MPS _volume": "mps",
            "Units": "max_capacity_volume",
            "FX": "fx_rate",
        }
    )
