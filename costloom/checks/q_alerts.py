"""Alert inputs, rules, texts and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from costloom.checks.ctes import define
from costloom.checks.domain import Domain
from costloom.checks.q_cost import detail
from costloom.checks.q_performance import perf_kpi
from costloom.checks.registry import query
from costloom.operators import alerts
from costloom.operators.ids import dense_ids
from costloom.operators.lookups import latest_actual_month, params_row
from costloom.plans import alerting
from costloom.session import settle

PARAM_NAMES = ["corp_funding_rate", "scrap_target"]


def current(d: Domain) -> Column:
    return latest_actual_month(d.ledger).scalar()


define("alert_month", "SELECT max(reporting_month) AS month FROM ledger WHERE type = 'Actual'")
_CUR = "(SELECT month FROM alert_month)"

# --- inputs ---------------------------------------------------------------------------------------

define(
    "max_mps",
    f"""
SELECT product, max(mps) AS max_mps FROM perf_kpi
WHERE reporting_month > {_CUR} AND reporting_month <= {_CUR} + 186 GROUP BY product
""",
)


@query("max_future", "A6 P13", "SELECT product, max_mps FROM max_mps")
def max_future(d: Domain) -> DataFrame:
    return alerting.max_future_mps(perf_kpi(d), current(d))


_FIXED = "(' Electricity&Water', 'other utilities', 'IDL', 'Depreciation-W-buy')"


@query(
    "fixed_cost",
    "A8 P9",
    f"""SELECT product, coalesce(sum(unit_moh_actual), 0) AS fixed_moh_cost FROM unit_moh
WHERE moh_item IN {_FIXED} GROUP BY product""",
    shared=False,
)
def fixed_cost(d: Domain) -> DataFrame:
    return alerting.fixed_moh_cost(d.unit_moh)


@query(
    "ppv_muv",
    "A9 C2",
    """
SELECT product, coalesce(sum(value) FILTER (line_item = 'Material cost_Purchase price variance'), 0) AS ppv,
  coalesce(sum(value) FILTER (line_item = 'Material cost_Material usage variance'), 0) AS muv
FROM ledger WHERE type = 'Actual' AND line_item IN ('Material cost_Purchase price variance', 'Material cost_Material usage variance')
GROUP BY product
""",
    shared=False,
)
def ppv_muv(d: Domain) -> DataFrame:
    return alerting.price_and_usage_variance(d.ledger)


define(
    "alert_kpi",
    f"""
SELECT k.*, max_mps, fixed_moh_cost, mp_no_of_month, ppv, muv
FROM (SELECT * FROM perf_kpi WHERE reporting_month = {_CUR}) k
LEFT JOIN max_mps USING (product)
LEFT JOIN (SELECT product, coalesce(sum(unit_moh_actual), 0) AS fixed_moh_cost FROM unit_moh
  WHERE moh_item IN {_FIXED} AND reporting_month = {_CUR} GROUP BY product) USING (product)
LEFT JOIN (SELECT product, greatest(date_diff('day', mp_start_month, {_CUR}), 0) / CAST(30 AS DOUBLE) AS mp_no_of_month
  FROM dim_project WHERE mp_start_month IS NOT NULL) USING (product)
LEFT JOIN (SELECT product, coalesce(sum(value), 0) AS ppv FROM ledger WHERE type = 'Actual'
  AND line_item = 'Material cost_Purchase price variance' AND reporting_month = {_CUR} GROUP BY product) USING (product)
LEFT JOIN (SELECT product, coalesce(sum(value), 0) AS muv FROM ledger WHERE type = 'Actual'
  AND line_item = 'Material cost_Material usage variance' AND reporting_month = {_CUR} GROUP BY product) USING (product)
""",
)


def base(d: Domain) -> DataFrame:
    """KPI rows of the month; several rules read them, so they are stored once."""
    rows = alerting.alert_base(settle(perf_kpi(d)), d.unit_moh, d.ledger, d.dim_project, current(d))
    return settle(rows)


@query("alert_base", "J31 A6 A8 A9 F7 P11 P13", "SELECT * FROM alert_kpi")
def alert_base(d: Domain) -> DataFrame:
    return base(d)


@query(
    "kpi_with_unit_moh",
    "J33 P11",
    f"""
SELECT k.reporting_month, product, production, moh_item, u.unit_moh_actual, u.unit_moh_r3m, u.unit_moh_quote
FROM alert_kpi k LEFT JOIN (SELECT * FROM unit_moh WHERE reporting_month = {_CUR}) u USING (product)
""",
)
def kpi_with_unit_moh(d: Domain) -> DataFrame:
    return alerting.kpi_with_unit_moh(base(d), d.unit_moh, current(d))


# --- rules 1 to 6 -----------------------------------------------------------------------------------


def _ieee(a: str, b: str) -> str:
    return (
        f"(CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) END ELSE ({a}) / ({b}) END)"
    )


def _param(name: str) -> str:
    return f"(SELECT arg_max(value, date) FROM params WHERE param = '{name}')"


_REV = "(SELECT coalesce(sum(revenue), 0) FROM alert_kpi)"
_SHIP = "(SELECT coalesce(sum(shipment), 0) FROM alert_kpi)"
_HALF, _MORE = "CAST(0.5 AS DOUBLE)", "CAST(1.1 AS DOUBLE)"

define(
    "alert_numbers",
    f"""
SELECT *,
  coalesce(production < {_HALF} * max_capacity AND max_mps < {_HALF} * max_capacity, false) AS rule1,
  {_ieee("(max_capacity - max_mps) * fixed_moh_cost", _REV)} AS rule1_num,
  coalesce(shipment < apr, false) AS rule2, {_ieee("apr - shipment", _SHIP)} AS rule2_num,
  coalesce(ads > fg_ads_target * {_MORE}, false) AS rule3,
  {_ieee(f"(ads - fg_ads_target) * {_param('corp_funding_rate')}", _REV)} AS rule3_num,
  {_ieee("fg_scrap_amount", "revenue_amt_for_scrap")} AS scrap_rate, {_param("scrap_target")} AS scrap_target,
  coalesce(yield_rate < yield_rate_curr_target, false) AS rule5,
  {_ieee("(yield_rate_curr_target - yield_rate) * cogs_for_ads", "revenue")} AS rule5_num,
  {_ieee("material_total_variance", "revenue")} AS material_share,
  {_ieee("material_total_variance", _REV)} AS rule6_num
FROM alert_kpi
""",
)
define(
    "alert_rules",
    "SELECT *, coalesce(scrap_rate > scrap_target, false) AS rule4, scrap_rate - scrap_target AS rule4_num, "
    "coalesce(material_share > 0, false) AS rule6, "
    + ", ".join(
        f"coalesce({'scrap_rate - scrap_target' if r == 4 else f'rule{r}_num'} > CAST(1e-5 AS DOUBLE), false) AS rule{r}_impact"
        for r in range(1, 7)
    )
    + " FROM alert_numbers",
)

_FLAGS = ["reporting_month", "product"] + [
    f"rule{r}{part}" for r in range(1, 7) for part in ("", "_num", "_impact")
]


def flags(d: Domain) -> DataFrame:
    return alerts.kpi_flags(base(d), params_row(d.params, PARAM_NAMES))


@query("alert_flags", "K1 K2 K3 K4 K5 K6 A10 C8 T3 F17", f"SELECT {', '.join(_FLAGS)} FROM alert_rules")
def alert_flags(d: Domain) -> DataFrame:
    return flags(d).select(*_FLAGS)


# --- rule 8 -------------------------------------------------------------------------------------------

define(
    "site_base",
    f"""
SELECT k.reporting_month, k.site, short AS line_item_short, coalesce(sum(revenue), 0) AS revenue,
  {", ".join(f"coalesce(sum({t}_{m}), 0) AS {t}_{m}" for t in ("actual", "budget", "r3m") for m in ("total_cost", "shipment"))}
FROM alert_kpi k LEFT JOIN (
  SELECT product, cost_item_level1,
    {", ".join(f"coalesce(sum({t}_total_cost), 0) AS {t}_total_cost, avg({t}_shipment) AS {t}_shipment" for t in ("actual", "budget", "r3m"))}
  FROM detail WHERE reporting_month = {_CUR} AND cost_box_group IN ('Other cost', 'OPEX') GROUP BY ALL) c USING (product)
LEFT JOIN control ON line_item = cost_item_level1
WHERE short IS NOT NULL AND k.site IS NOT NULL GROUP BY k.reporting_month, k.site, short
""",
)


def site_base(d: Domain, kpi: DataFrame | None = None) -> DataFrame:
    return settle(alerting.site_alert_base(kpi or base(d), detail(d), d.control, current(d)))


@query("site_alert_base", "J32 A5 A21 J10 P9 C15", "SELECT * FROM site_base")
def site_alert_base(d: Domain) -> DataFrame:
    return site_base(d)


_OVER = "CAST(1.2 AS DOUBLE)"
_SITE_REV = "(SELECT sum(DISTINCT revenue) FROM site_base)"

define(
    "site_numbers",
    f"""
SELECT *, coalesce(actual_total_cost > {_OVER} * budget_total_cost, false) AS tot_cost_is_high,
  coalesce(actual_unit_cost > {_OVER} * budget_unit_cost, false) AS unit_cost_is_high,
  {_ieee("actual_total_cost - budget_total_cost", _SITE_REV)} AS tot_cost_impact,
  {_ieee("unit_gap", _SITE_REV)} AS unit_cost_impact
FROM (SELECT *, CASE WHEN NOT isnan((actual_unit_cost - budget_unit_cost) * actual_shipment)
  THEN (actual_unit_cost - budget_unit_cost) * actual_shipment END AS unit_gap
FROM (SELECT *, {", ".join(_ieee(f"{t}_total_cost", f"{t}_shipment") + f" AS {t}_unit_cost" for t in ("actual", "budget", "r3m"))}
  FROM site_base))
""",
)
define(
    "site_rules",
    """
SELECT *, rule8_num IS NOT NULL AND rule8_num > CAST(1e-5 AS DOUBLE) AS rule8_impact FROM (
  SELECT *, tot_cost_is_high OR unit_cost_is_high AS rule8,
    CASE WHEN tot_cost_impact IS NOT NULL THEN CASE WHEN unit_cost_impact > tot_cost_impact THEN unit_cost_impact ELSE tot_cost_impact END END AS rule8_num
  FROM site_numbers WHERE budget_total_cost > 0)
""",
)
_SITE = [
    "reporting_month", "site", "line_item_short", "tot_cost_is_high", "unit_cost_is_high", "rule8",
    "tot_cost_impact", "unit_cost_impact", "rule8_num", "rule8_impact",
]


@query("site_alerts", "K8 A11 C10", f"SELECT {', '.join(_SITE)} FROM site_rules")
def site_alerts(d: Domain) -> DataFrame:
    return alerts.site_flags(site_base(d)).select(*_SITE)


# --- texts, leads and ids ---------------------------------------------------------------------------


def _two(x: str) -> str:
    return f"coalesce(printf('%.2f', {x}), 'nan')"


def _pct(x: str) -> str:
    return _two(f"({x}) * 100")


def _whole(x: str) -> str:
    return f"CASE WHEN isfinite({x}) THEN CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR) ELSE 'n/a' END"


def _k(x: str) -> str:
    return _whole(f"({x}) / 1000")


_USED = _pct(_ieee("production", "max_capacity"))
_PLANNED = _pct(_ieee("max_mps", "max_capacity"))
_FINAL = _pct("coalesce(yield_rate_final_target, yield_rate_curr_target)")

# Titles and texts of the alerts and leads, as in `constants`, written out once more in SQL.
# rule: title, description, leads
_TEXTS = {
    1: (
        "Capacity under-usage",
        f"product || ' reporting period production volume was only ' || {_USED} || ' % of max capacity'",
        [
            f"product || ' reporting period production volume was ' || {_k('production')} || 'K, only ' || {_USED} || ' % of max capacity'",
            f"product || ' Maximum MPS 6 month requirement was ' || {_k('max_mps')} || 'K, stays below ' || {_PLANNED} || ' % of max capacity'",
        ],
    ),
    2: (
        "Shipment below APR",
        f"product || ' shipment volume ' || {_pct('rule2_num')} || ' % below APR'",
        [
            f"product || ' shipment volume was ' || {_k('shipment')} || 'K'",
            f"product || ' APR was ' || {_k('apr')} || 'K'",
        ],
    ),
    3: (
        "Average days stock too high",
        f"product || ' finished goods ADS was ' || {_pct(_ieee('ads', 'fg_ads_target') + ' - 1')} || ' % over business rule'",
        [
            f"product || ' reporting month finished goods ADS ' || {_two('ads')} || ' days, vs. ADS business rule of ' || {_whole('fg_ads_target')} || ' days'"
        ],
    ),
    4: (
        "Scrap rate too high",
        f"product || ' scrap rate ' || {_pct('scrap_rate')} || ' %, ' || {_pct('rule4_num')} || ' % higher than ' || {_pct('scrap_target')} || ' %'",
        [
            f"product || ' scrap rate ' || {_pct('scrap_rate')} || ' %, vs.inventory reserve of ' || {_pct('scrap_target')} || ' %'"
        ],
    ),
    5: (
        "Yield rate target unmet",
        f"product || ' yield rate was ' || {_pct('yield_rate')} || ' %, ' || {_pct('yield_rate_curr_target - yield_rate')} || ' % behind yield rate current target'",
        [
            f"product || ' yield rate ' || {_pct('yield_rate')} || ' %, vs. yield rate current target of ' || {_pct('yield_rate_curr_target')} || ' %'",
            f"product || ' has been in MP stage for ' || {_whole('mp_no_of_month')} || ' months. ' || product || ' yield rate was ' || {_pct('yield_rate')} || ', vs. yield rate final target of ' || {_FINAL} || ' %'",
        ],
    ),
    6: (
        "Positive material cost variance",
        f"product || ' material cost variance(PPV + MUV) was ' || {_pct('material_share')} || ' %'",
        [
            f"product || ' PPV was ' || {_pct(_ieee('ppv', 'revenue'))} || ' % of revenue; MUV was ' || {_pct(_ieee('muv', 'revenue'))} || ' % of revenue'"
        ],
    ),
}


def _over(a: str, b: str) -> str:
    return _pct(_ieee(f"{a} - {b}", b))


_SITE_DESCRIPTION = f"""concat_ws(' ',
  CASE WHEN tot_cost_is_high THEN 'Actual ' || line_item_short || ' was ' || {_over("actual_total_cost", "budget_total_cost")} || ' % higher than budget' END,
  CASE WHEN unit_cost_is_high THEN 'Actual unit ' || line_item_short || ' per shipment was ' || {_over("actual_unit_cost", "budget_unit_cost")} || ' % higher than budget unit cost' END)"""
_SITE_LEADS = [
    f"site || ' actual ' || line_item_short || ' was ' || {_k('actual_total_cost')} || 'K NTD, budget ' || line_item_short || ' was ' || {_k('budget_total_cost')} || 'K NTD'",
    f"site || ' actual unit ' || line_item_short || ' per shipment was ' || {_whole('actual_unit_cost')} || ' NTD, budget unit ' || line_item_short || ' per shipment was ' || {_whole('budget_unit_cost')} || ' NTD'",
    f"site || ' R3M ' || line_item_short || ' was ' || {_k('r3m_total_cost')} || 'K NTD; RSM unit ' || line_item_short || ' per shipment was ' || {_whole('r3m_unit_cost')} || ' NTD'",
]

define(
    "raised",
    " UNION ALL ".join(
        f"SELECT {r} AS rule, reporting_month AS alert_month, '{title}' AS title, "
        f"CASE WHEN rule{r}_impact THEN 'high' ELSE 'medium' END AS importance, product AS object, "
        f"{text} AS description, [{', '.join(leads)}] AS leads FROM alert_rules WHERE rule{r}"
        for r, (title, text, leads) in _TEXTS.items()
    )
    + " UNION ALL SELECT 8, reporting_month, line_item_short || ' too high', "
    + "CASE WHEN rule8_impact THEN 'high' ELSE 'medium' END, site, "
    + f"{_SITE_DESCRIPTION}, [{', '.join(_SITE_LEADS)}] FROM site_rules WHERE rule8",
)
define(
    "numbered",
    "SELECT *, row_number() OVER (ORDER BY rule, alert_month, object, title, description) - 1 AS alert_id FROM raised",
)


def numbered(d: Domain) -> DataFrame:
    kpi = base(d)
    return alerts.number_alerts(alerting.all_alerts(kpi, site_base(d, kpi), d.params))


@query(
    "alert_texts",
    "K9 K10 K11 K13 F19 S1",
    "SELECT alert_id, alert_month, title, importance, object, description FROM numbered",
)
def alert_texts(d: Domain) -> DataFrame:
    return alerts.alert_table(numbered(d))


@query(
    "alert_leads",
    "K12 K13 F19",
    """
SELECT alert_id, row_number() OVER (ORDER BY alert_id, pos) - 1 AS lead_id, lead_desc FROM (
  SELECT alert_id, unnest(leads) AS lead_desc, generate_subscripts(leads, 1) AS pos FROM numbered)
""",
)
def alert_leads(d: Domain) -> DataFrame:
    return alerts.lead_table(numbered(d))


@query(
    "dense_ids",
    "K13 T1",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS id FROM orders""",
)
def dense_id_order(d: Domain) -> DataFrame:
    orders = d.table("orders").select("o_orderkey", "o_totalprice")
    return dense_ids(orders, ["o_totalprice", "o_orderkey"], "id")
