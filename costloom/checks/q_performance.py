"""Rollups, performance and health tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.checks.ctes import define
from costloom.checks.domain import EARLIEST, FIRST_YEAR, Domain
from costloom.checks.registry import query
from costloom.contracts import TABLES, conform
from costloom.functions.dates import month_start
from costloom.functions.missing import div_guarded
from costloom.operators.lookups import app_item_of, latest_actual_month, variance_category
from costloom.operators.reshape import pivot_sum
from costloom.operators.rollup import four_level
from costloom.operators.series import rolling_mean
from costloom.plans import performance
from costloom.session import settle

# --- the rollup on the plain star schema ----------------------------------------------------

FOUR_LEVEL_SQL = """
WITH base AS (
  SELECT r_name AS bg, CAST(date_trunc('month', l_shipdate) AS DATE) AS reporting_month,
    CASE l_returnflag WHEN 'A' THEN 'Actual' WHEN 'N' THEN 'Budget' ELSE 'R3M' END AS type,
    'S' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS site, p_type AS kind,
    floor(l_extendedprice * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS cents, l_quantity AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
levels AS (
  SELECT bg, reporting_month, type, site || '_' || kind AS cat_ind, cents, q FROM base
  UNION ALL SELECT bg, reporting_month, type, site, cents, q FROM base
  UNION ALL SELECT bg, reporting_month, type, 'ALL', cents, q FROM base
  UNION ALL SELECT bg, reporting_month, type, kind, cents, q FROM base)
SELECT bg, reporting_month, type, cat_ind, sum(cents) AS total_cost, sum(q) AS quantity,
  CASE WHEN sum(q) > 0 THEN sum(cents) / sum(q) END AS unit_cost
FROM levels GROUP BY bg, reporting_month, type, cat_ind
"""


@query("four_level_rollup", "A13 A14 F9 F10 F17 P3 P5", FOUR_LEVEL_SQL)
def four_level_rollup(d: Domain) -> DataFrame:
    base = (
        d.table("lineitem")
        .join(d.table("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(d.table("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(d.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(d.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("bg"),
            month_start(F.col("l_shipdate")).alias("reporting_month"),
            F.when(F.col("l_returnflag") == "A", "Actual")
            .when(F.col("l_returnflag") == "N", "Budget")
            .otherwise("R3M")
            .alias("type"),
            F.concat(F.lit("S"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("site"),
            F.col("p_type").alias("product_type"),
            F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("double").alias("total_cost"),
            F.col("l_quantity").alias("quantity"),
        )
    )
    unit = div_guarded(F.col("total_cost"), F.col("quantity"))
    return four_level(
        base,
        ["bg", "reporting_month", "type"],
        ["total_cost", "quantity"],
        post=lambda s: s.withColumn("unit_cost", unit),
    )


# --- pivots of the ledger ---------------------------------------------------------------------

_PIVOT = """
SELECT reporting_month, product, type, {cols}
FROM (SELECT ledger.*, {cat} AS cat FROM ledger LEFT JOIN merge_map ON line_item = accounting_item_desc)
WHERE cat IN ({names}) GROUP BY reporting_month, product, type
"""


def _sum_where(names: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN count(*) FILTER (cat = '{n}') > 0 THEN coalesce(sum(value) FILTER (cat = '{n}'), 0) END AS {n}"
        for n in names
    )


_APP = ["revenue", "material_cost", "other_cost", "opex", "moh", "production_volume", "shipment_volume"]
_VAR_CASE = (
    "CASE line_item WHEN 'Material cost_Purchase price variance' THEN 'price_variance' "
    "WHEN 'Material cost_Material usage variance' THEN 'usage_variance' "
    "WHEN 'Sales_Normal shipment' THEN 'shipment' "
    "WHEN 'Sales_Sales return & allowance' THEN 'allowance' END"
)
_VAR = ["price_variance", "usage_variance", "shipment", "allowance"]


def _names(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


@query("ledger_pivot_sum", "A1 R8 J11 C3", _PIVOT.format(cols=_sum_where(_APP), cat="app_item", names=_names(_APP)), shared=False)
def ledger_pivot_sum(d: Domain) -> DataFrame:
    mapped = app_item_of(d.ledger, d.merge_map)
    return pivot_sum(mapped, ["reporting_month", "product", "type"], "app_item", "value", _APP)


@query("variance_pivot", "A2 F15", _PIVOT.format(cols=_sum_where(_VAR), cat=_VAR_CASE, names=_names(_VAR)), shared=False)
def variance_pivot(d: Domain) -> DataFrame:
    tagged = d.ledger.withColumn("cat", variance_category(F.col("line_item")))
    return pivot_sum(tagged, ["reporting_month", "product", "type"], "cat", "value", _VAR)


define("app_sums", _PIVOT.format(cols=_sum_where(_APP), cat="app_item", names=_names(_APP)))
define("var_sums", _PIVOT.format(cols=_sum_where(_VAR), cat=_VAR_CASE, names=_names(_VAR)))
define(
    "stats",
    """
SELECT s.*, revenue - material_cost AS mva,
  revenue - material_cost - other_cost - opex - moh AS operating_income,
  price_variance + usage_variance AS material_total_variance,
  shipment + allowance AS revenue_amt_for_scrap,
  CASE WHEN production_volume > 0 THEN (price_variance + usage_variance) / production_volume END
    AS material_unit_variance
FROM app_sums s LEFT JOIN var_sums v USING (reporting_month, product, type)
""",
)


@query("ledger_stats", "J20 P5 F17", "SELECT * FROM stats", shared=False)
def ledger_stats(d: Domain) -> DataFrame:
    return performance.ledger_stats(d.ledger, d.merge_map)


# --- perf_kpi_model -----------------------------------------------------------------------------

define(
    "kpi_joined",
    """
SELECT k.* EXCLUDE (inventory),
  CASE WHEN count(inventory) OVER w = 2 THEN avg(inventory) OVER w END AS inventory,
  s.* EXCLUDE (reporting_month, product, type), u.unit_moh_actual, u.unit_moh_quote, p.project_status
FROM kpi k
LEFT JOIN (SELECT * FROM stats WHERE type = 'Actual') s USING (reporting_month, product)
LEFT JOIN (
  SELECT reporting_month, product, coalesce(sum(unit_moh_actual), 0) AS unit_moh_actual,
    coalesce(sum(unit_moh_quote), 0) AS unit_moh_quote
  FROM unit_moh GROUP BY reporting_month, product) u USING (reporting_month, product)
LEFT JOIN dim_project p USING (product)
WINDOW w AS (PARTITION BY product ORDER BY reporting_month ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
""",
)


def _clamp(x: str) -> str:
    return f"CASE WHEN ({x}) < 0 THEN 0 WHEN ({x}) > 1 THEN 1 ELSE ({x}) END"


def _closeness(a: str, t: str) -> str:
    return (
        f"CASE WHEN {a} > 0 THEN CASE WHEN {t} IS NULL THEN CAST(1 AS DOUBLE) "
        f"WHEN {t} <> 0 THEN {_clamp(f'1 - ({a} - {t}) / {t}')} END END"
    )


define(
    "scores",
    f"""
SELECT *,
  CASE WHEN apr > 0 AND shipment_volume IS NOT NULL THEN CASE WHEN shipment_volume / apr > 1 THEN 1 ELSE shipment_volume / apr END END AS s1,
  CASE WHEN apr > 0 AND production_volume IS NOT NULL THEN CASE WHEN production_volume / apr > 1 THEN 1 ELSE production_volume / apr END END AS s2,
  {_closeness("unit_moh_actual", "unit_moh_quote")} AS s3,
  {_closeness("ads", "ads_target")} AS s4,
  CASE WHEN yield_rate_current_target > 0 AND yield_rate IS NOT NULL THEN CASE WHEN yield_rate / yield_rate_current_target > 1 THEN 1 ELSE yield_rate / yield_rate_current_target END END AS s5,
  CASE WHEN revenue > 0 AND material_total_variance IS NOT NULL THEN {_clamp("1 - (material_total_variance / revenue) * 100")} END AS s6
FROM kpi_joined
""",
)


def _weight(i: int) -> str:
    names = ["shipment/apr", "production/apr", "moh/quote", "ads/ads_target", "yield/yield_target", "material/m_target"]
    return f"(SELECT max(weight) FILTER (idx = '{names[i]}') FROM weights)"


_TOP = " + ".join(f"coalesce(s{i + 1} * {_weight(i)}, 0)" for i in range(6))
_BOTTOM = " + ".join(f"CASE WHEN s{i + 1} IS NOT NULL THEN {_weight(i)} ELSE 0 END" for i in range(6))

define(
    "perf_kpi",
    f"""
SELECT reporting_month, bg, bu, site, product, ads, ads_target AS fg_ads_target, cogs AS cogs_for_ads,
  inventory AS avg_inventory_for_ads, apr, mps, fg_scrap_amount, scrap_rate AS fg_scrap_rate_target,
  yield_rate, yield_rate_current_target AS yield_rate_curr_target, yield_rate_final_target,
  max_capacity_volume AS max_capacity, revenue, material_total_variance, material_unit_variance,
  revenue_amt_for_scrap, production_volume AS production, shipment_volume AS shipment,
  unit_moh_actual, unit_moh_quote,
  CASE WHEN project_status = 'MP' AND ({_BOTTOM}) <> 0 THEN ({_TOP}) / ({_BOTTOM}) END AS health_score
FROM scores WHERE reporting_month >= DATE '{EARLIEST}-01-01'
""",
)

_KPI_COLUMNS = [
    c for c in TABLES["app.perf_kpi_model"].names if c not in ("currency", "fx_rate")
]


def perf_kpi(d: Domain, first_year: int = EARLIEST) -> DataFrame:
    full = performance.perf_kpi_model(
        d.kpi, d.ledger, d.unit_moh, d.merge_map, d.dim_project, d.weights, first_year
    )
    return full.select(*_KPI_COLUMNS)


@query(
    "perf_kpi_model",
    "G7 A1 A2 A3 C1 E1 E2 E3 E4 E5 E6 E7 E8 F16 F20 J6 J11 J20 J21 P2 P6 P10 S2 W1",
    f"SELECT * FROM perf_kpi WHERE reporting_month >= DATE '{FIRST_YEAR}-01-01'",
)
def perf_kpi_model(d: Domain) -> DataFrame:
    return perf_kpi(d, FIRST_YEAR)


@query(
    "health_score",
    "E8 E7 A3 J6",
    """SELECT reporting_month, product, health_score FROM perf_kpi WHERE health_score IS NOT NULL""",
)
def health_score(d: Domain) -> DataFrame:
    return (
        perf_kpi(d)
        .filter(F.col("health_score").isNotNull())
        .select("reporting_month", "product", "health_score")
    )


@query(
    "inventory_avg",
    "W1",
    """
SELECT reporting_month, product, inventory,
  CASE WHEN count(inventory) OVER w = 2 THEN avg(inventory) OVER w END AS avg_inventory
FROM kpi WINDOW w AS (PARTITION BY product ORDER BY reporting_month ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
""",
    shared=False,
)
def inventory_avg(d: Domain) -> DataFrame:
    mean = rolling_mean(F.col("inventory"), ["product"], "reporting_month", 2)
    return d.kpi.select("reporting_month", "product", "inventory", mean.alias("avg_inventory"))


# --- perf_overview_model ------------------------------------------------------------------------


def _ieee(a: str, b: str) -> str:
    return (
        f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) END ELSE ({a}) / ({b}) END"
    )


define(
    "rated",
    """
SELECT 'Actual' AS fx_type, month AS fx_date, fx FROM fx_actual
UNION ALL SELECT 'Budget', make_date(y, 1, 1), fx FROM fx_budget
UNION ALL SELECT 'R3M', month, fx FROM fx_r3m
""",
)


def rate_by_type(table: str, cols: str) -> str:
    """A table with a type, joined to the rate of its policy."""
    return f"""
SELECT {cols} FROM {table} z LEFT JOIN versions ON z.reporting_month = period
LEFT JOIN rated ON fx_type = z.type AND fx_date = CASE z.type
  WHEN 'Actual' THEN z.reporting_month
  WHEN 'Budget' THEN CAST(date_trunc('year', z.reporting_month) AS DATE)
  ELSE CAST(date_trunc('month', version) + INTERVAL 1 MONTH AS DATE) END
"""


define(
    "overview_base",
    f"""
SELECT f.*, revenue - material_cost AS mva,
  revenue - material_cost - other_cost - opex - moh AS operating_income,
  v.shipment + v.allowance AS revenue_amt_for_scrap, k.ads, k.fg_scrap_amount,
  {_ieee("k.fg_scrap_amount", "v.shipment + v.allowance")} AS scrap_rate, uq.unit_moh_quote
FROM (
  SELECT reporting_month, bg, site, product, type, {_sum_where(_APP)}
  FROM (SELECT ledger.*, app_item AS cat FROM ledger JOIN merge_map ON line_item = accounting_item_desc)
  GROUP BY reporting_month, bg, site, product, type) f
LEFT JOIN var_sums v USING (reporting_month, product, type)
LEFT JOIN (SELECT 'Actual' AS type, * FROM kpi) k USING (reporting_month, bg, site, product, type)
LEFT JOIN (
  SELECT reporting_month, product, coalesce(sum(unit_moh_quote), 0) AS unit_moh_quote FROM unit_moh
  WHERE moh_item <> 'Production quantity' GROUP BY reporting_month, product) uq USING (reporting_month, product)
""",
)

_OVERVIEW = (
    "reporting_month, bg, '' AS bu, site, product, type, revenue, mva, material_cost, other_cost, opex, "
    "operating_income, moh, production_volume AS production, shipment_volume AS shipment, ads, "
    "scrap_rate, unit_moh_quote, 'NTD' AS currency, fx AS fx_rate"
)

define(
    "overview",
    rate_by_type("overview_base", _OVERVIEW) + f" WHERE reporting_month >= DATE '{EARLIEST}-01-01'",
)


def overview(d: Domain) -> DataFrame:
    full = performance.perf_overview_model(
        d.ledger, d.kpi, d.unit_moh, d.merge_map, d.rates, d.versions, EARLIEST
    )
    return conform(full, TABLES["app.perf_overview_model"].schema)


@query(
    "perf_overview_model",
    "G8 G17 A1 A2 A4 IO5 J11 J13 J14 J19 J22 J23 P3 P7 R8",
    "SELECT * FROM overview",
)
def perf_overview_model(d: Domain) -> DataFrame:
    return overview(d)


# --- perf_overview_all ----------------------------------------------------------------------------

_SUMS = performance.OVERVIEW_SUMS + performance.KPI_SUMS


def four_levels(table: str, keys: str, measures: str, site: str = "site", kind: str = "product_type") -> str:
    """Four stacked passes over a table, one per level."""
    labels = [f"{site} || '_' || {kind}", site, "'ALL'", kind]
    parts = [f"SELECT {keys}, {label} AS cat_ind, {measures} FROM {table}" for label in labels]
    return " UNION ALL ".join(parts)


define(
    "overview_kpi",
    f"""
SELECT o.reporting_month, o.bg, o.site, o.product, o.type, product_type,
  {", ".join(f"o.{c}" for c in performance.OVERVIEW_SUMS)}, {", ".join(f"k.{c}" for c in performance.KPI_SUMS)}
FROM overview o LEFT JOIN (SELECT 'Actual' AS type, * FROM perf_kpi) k USING (reporting_month, product, type)
LEFT JOIN dim_project p ON p.product = o.product
""",
)

define(
    "overview_levels",
    f"""
SELECT bg, reporting_month, type, cat_ind, {", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in _SUMS)}
FROM ({four_levels("overview_kpi", "bg, reporting_month, type", ", ".join(_SUMS))})
GROUP BY bg, reporting_month, type, cat_ind
""",
)

define(
    "overview_rates",
    f"""
SELECT bg, reporting_month, type, cat_ind, {", ".join(performance.OVERVIEW_SUMS)},
  CASE WHEN type <> 'Actual' THEN (SELECT arg_min_null(fg_ads_target, (reporting_month, product)) FROM perf_kpi)
    ELSE ({_ieee("avg_inventory_for_ads", "cogs_for_ads")}) * 30 END AS ads,
  CASE WHEN type <> 'Actual' THEN (SELECT arg_min_null(fg_scrap_rate_target, (reporting_month, product)) FROM perf_kpi)
    ELSE {_ieee("fg_scrap_amount", "revenue_amt_for_scrap")} END AS scrap_rate
FROM overview_levels
""",
)


@query(
    "perf_overview_all",
    "G9 A13 A15 A24 F9 F14 J7 J13 J29 G17",
    rate_by_type(
        "overview_rates",
        "reporting_month, bg, cat_ind, type, "
        + ", ".join(performance.OVERVIEW_SUMS)
        + ", ads, scrap_rate, 'NTD' AS currency, fx AS fx_rate",
    ),
)
def perf_overview_all(d: Domain) -> DataFrame:
    kpi = settle(perf_kpi(d))
    out = performance.perf_overview_all(kpi, overview(d), d.dim_project, d.rates, d.versions)
    return conform(out, TABLES["app.perf_overview_all"].schema)


# --- health ---------------------------------------------------------------------------------------


def _no_inf(x: str) -> str:
    return f"CASE WHEN abs({x}) <> CAST('inf' AS DOUBLE) THEN ({x}) END"


define(
    "health",
    f"""
SELECT k.*, o.moh, {_no_inf(_ieee("k.shipment", "k.apr"))} AS shipment_rate,
  {_no_inf(_ieee("k.production", "k.apr"))} AS production_rate,
  {_no_inf(_ieee("k.material_total_variance", "k.revenue"))} AS material_cost_variance,
  {_no_inf(_ieee(_ieee("o.moh", "o.production"), "o.unit_moh_quote"))} AS unit_moh_rate
FROM perf_kpi k LEFT JOIN (SELECT * FROM overview WHERE type = 'Actual') o USING (reporting_month, product)
""",
)


@query(
    "health_kpi_model",
    "G10 J30 P20 F17",
    "SELECT reporting_month, bg, bu, site, product, shipment_rate, production_rate, unit_moh_rate, "
    "material_cost_variance, yield_rate, yield_rate_curr_target, ads, fg_ads_target, health_score FROM health",
)
def health_kpi_model(d: Domain) -> DataFrame:
    out = performance.health_kpi_model(perf_kpi(d), overview(d))
    return conform(out, TABLES["app.health_kpi_model"].schema)


_HEALTH = performance.HEALTH_SUMS

define(
    "health_typed",
    """
SELECT h.*, product_type, yield_rate * production AS yield_volume,
  yield_rate_curr_target * production AS yield_target_volume
FROM health h LEFT JOIN dim_project p ON p.product = h.product
""",
)

define(
    "health_levels",
    f"""
SELECT bg, reporting_month, cat_ind, {", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in _HEALTH)},
  sum(unit_moh_quote) / count(unit_moh_quote) AS quote
FROM ({four_levels("health_typed", "bg, reporting_month", ", ".join(_HEALTH) + ", unit_moh_quote")})
GROUP BY bg, reporting_month, cat_ind
""",
)


@query(
    "health_rates",
    "G11 A13 A17 P20 J7",
    f"""
SELECT reporting_month, bg, cat_ind, {_no_inf(_ieee("shipment", "apr"))} AS shipment_rate,
  {_no_inf(_ieee("production", "apr"))} AS production_rate,
  {_no_inf(_ieee(_ieee("moh", "production"), "quote"))} AS unit_moh_rate,
  {_no_inf(_ieee("material_total_variance", "revenue"))} AS material_cost_variance,
  {_no_inf(_ieee("yield_volume", "production"))} AS yield_rate,
  {_no_inf(_ieee("yield_target_volume", "production"))} AS yield_rate_curr_target,
  {_no_inf("(" + _ieee("avg_inventory_for_ads", "cogs_for_ads") + ") * 30")} AS ads
FROM health_levels
""",
)
def health_rates(d: Domain) -> DataFrame:
    health = performance.health_kpi_model(perf_kpi(d), overview(d))
    out = performance.health_kpi_group(health, d.dim_project)
    return conform(out, TABLES["app.health_kpi_group"].schema)


@query(
    "latest_month",
    "A12 T4 P7",
    "SELECT max(reporting_month) AS latest_month FROM ledger WHERE type = 'Actual'",
    shared=False,
)
def latest_month(d: Domain) -> DataFrame:
    return latest_actual_month(d.ledger)
