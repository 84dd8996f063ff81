"""Declared columns of every stored table, and projection onto them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costloom import constants as K
from costloom.functions.missing import col

_ENTITY = "reporting_month date, bg string, bu string, site string, product string"
_TYPED = ", ".join(f"{t.lower()}_{{}} double" for t in K.TYPES)
_MONEY = "currency string, fx_rate double"
_DETAIL = (
    f"{_ENTITY}, cost_box_group string, cost_item_level1 string, cost_item_level2 string, "
    + ", ".join(_TYPED.format(m, m, m) for m in ("total_cost", "shipment", "production"))
    + f", {_MONEY}"
)
_OVERVIEW = (
    "revenue double, mva double, material_cost double, other_cost double, opex double, "
    "operating_income double, moh double, production double, shipment double, ads double, "
    "scrap_rate double"
)


@dataclass(frozen=True)
class Contract:
    """Columns of a table, the columns its folders are split by, and the one that a store may bucket it by."""

    ddl: str
    partition_by: list[str] = field(default_factory=list)
    bucket_by: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def names(self) -> list[str]:
        """Column names, without needing a session."""
        return [c.strip().rsplit(" ", 1)[0].strip("`") for c in self.ddl.split(",")]


TABLES: dict[str, Contract] = {
    "raw.is_model": Contract(
        "profit_center string, profit_center_name string, model_code string, model_name string, "
        "accounting_item_code string, accounting_item_group string, accounting_item_desc string, "
        "amount double, currency string, period_start date, last_update_time date, stat_dt date, "
        "update_frequency string",
        ["period_start"],
    ),
    "raw.moh_raw": Contract(
        "Site string, model_code string, model_name string, type string, MOH_item_type string, "
        "accounting_item_desc string, amount double, currency string, period_start date, "
        "update_frequency string, last_update_time date, stat_dt date",
        ["type", "period_start"],
        "model_name",
    ),
    "staging.dim_project": Contract(
        "product string, site string, product_code string, product_type string, "
        "project_status string, mp_start_month date, npi_start_month date, "
        "shipment_start_month date, bg string, bu string"
    ),
    "staging.fx_rate": Contract("Month date, `From` string, `To` string, FX double"),
    "staging.tbl_kpi_model": Contract(
        f"{_ENTITY}, ads double, ads_target double, cogs double, inventory double, apr double, "
        "mps double, fg_scrap_amount double, scrap_rate double, yield_rate double, "
        "yield_rate_current_target double, yield_rate_final_target double, "
        f"max_capacity_volume double, {_MONEY}",
        ["reporting_month"],
        "product",
    ),
    "staging.tbl_is_modeltype": Contract(
        f"{_ENTITY}, type string, line_itm_group string, line_item string, value double, "
        f"{_MONEY}, version date",
        ["type", "reporting_month"],
        "product",
    ),
    "staging.tbl_unitmoh_monthly": Contract(
        f"{_ENTITY}, moh_item string, unit_moh_actual double, unit_moh_budget double, "
        "unit_moh_r3m double, unit_moh_quote double, currency string",
        ["reporting_month"],
        "product",
    ),
    "app.perf_kpi_model": Contract(
        f"{_ENTITY}, ads double, fg_ads_target double, cogs_for_ads double, "
        "avg_inventory_for_ads double, apr double, mps double, fg_scrap_amount double, "
        "fg_scrap_rate_target double, yield_rate double, yield_rate_curr_target double, "
        "yield_rate_final_target double, max_capacity double, revenue double, "
        "material_total_variance double, material_unit_variance double, "
        "revenue_amt_for_scrap double, production double, shipment double, "
        "unit_moh_actual double, unit_moh_quote double, health_score double, "
        f"{_MONEY}",
        ["reporting_month"],
    ),
    "app.perf_overview_model": Contract(
        f"{_ENTITY}, type string, {_OVERVIEW}, unit_moh_quote double, {_MONEY}",
        ["reporting_month"],
    ),
    "app.perf_overview_all": Contract(
        f"reporting_month date, bg string, cat_ind string, type string, {_OVERVIEW}, {_MONEY}",
        ["reporting_month"],
    ),
    "app.health_product_status": Contract(
        "product string, site string, product_code string, product_type string, "
        "product_status string, mp_start_month date, npi_start_month date, "
        "shipment_start_month date, bg string, bu string"
    ),
    "app.health_kpi_model": Contract(
        f"{_ENTITY}, shipment_rate double, production_rate double, unit_moh_rate double, "
        "material_cost_variance double, yield_rate double, yield_rate_curr_target double, "
        "ads double, fg_ads_target double, health_score double",
        ["reporting_month"],
    ),
    "app.health_kpi_group": Contract(
        "reporting_month date, bg string, cat_ind string, shipment_rate double, "
        "production_rate double, unit_moh_rate double, material_cost_variance double, "
        "yield_rate double, yield_rate_curr_target double, ads double",
        ["reporting_month"],
    ),
    "app.cost_overview_dtl": Contract(_DETAIL, ["reporting_month"]),
    "app.cost_overview_dtl_ntd": Contract(_DETAIL, ["reporting_month"]),
    "app.cost_overview_level2": Contract(
        "reporting_month date, bg string, type string, project string, cost_cat_code string, "
        "cost_level2 string, cat_ind string, total_cost double, shipment double, "
        f"production double, unit_cost_ship double, unit_cost_prod double, {_MONEY}",
        ["reporting_month"],
    ),
    "app.perf_alerts": Contract(
        "alert_id long, alert_month date, title string, importance string, object string, "
        "description string"
    ),
    "app.perf_alert_leads": Contract("alert_id long, lead_id long, lead_desc string"),
}


def level1_contract(codes: list[str]) -> Contract:
    """Unit costs per category; predictions add rows with planned quantities."""
    cats = "".join(f"`{c}` double, " for c in codes)
    return Contract(
        f"reporting_month date, bg string, cat_ind string, type string, {cats}shipment double, "
        f"production double, r3m_shipment double, r3m_production double, standard string, {_MONEY}",
        ["type", "reporting_month"],
    )


def gap_contract(groups: list[str]) -> Contract:
    cats = ", ".join(f"`{g}` double" for g in groups)
    return Contract(
        f"reporting_month date, bg string, cat_ind string, type string, {cats}, ucg_total double, "
        f"ucg_non_adj double, {_MONEY}",
        ["reporting_month"],
    )


def prediction_contract() -> Contract:
    models = ", ".join(
        f"{m}_unit_cost_{s} double" for s in ("shipment", "production") for m in ("ma", "es", "arima")
    )
    return Contract(
        f"{_ENTITY}, cost_item_level1 string, actual_total_cost double, actual_shipment double, "
        "actual_production double, r3m_shipment double, r3m_production double, "
        f"actual_unit_cost_per_ship double, actual_unit_cost_per_prod double, {models}, {_MONEY}",
        ["reporting_month"],
    )


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the schema's columns in its order and types.

    Further columns (among them a surrogate id) are dropped; a missing one is an error, unless
    it is named as optional and then becomes null.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)
