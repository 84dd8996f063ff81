"""Cost overview tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.checks.ctes import define
from costloom.checks.domain import CODES, EARLIEST, FIRST_YEAR, GROUPS, Domain
from costloom.checks.q_performance import four_levels
from costloom.checks.registry import query
from costloom.contracts import TABLES, conform
from costloom.operators.lookups import cost_category_code
from costloom.operators.reshape import (
    melt_types,
    pivot_mean,
    split_no_level2,
    split_rows,
    with_aggregate_level,
)
from costloom.plans import cost
from costloom.session import settle

TYPES = ["actual", "budget", "r3m"]

# --- every item for every entity ----------------------------------------------------------------

define("entities", "SELECT DISTINCT reporting_month, bg, bu, site, product FROM ledger")
define(
    "every_item",
    """
SELECT reporting_month, bg, bu, site, product, c.line_item AS cost_item_level1,
  c.line_itm_group AS cost_box_group, c.detailed_item AS cost_item_level2, c.short
FROM entities FULL JOIN control c USING (bg)
""",
)


@query(
    "item_densify",
    "J15 A22",
    """SELECT reporting_month, bg, bu, site, product, cost_item_level1, cost_box_group, cost_item_level2,
  short FROM every_item""",
)
def item_densify(d: Domain) -> DataFrame:
    return cost.every_item(d.ledger, d.control).withColumnRenamed("Frontnend_name level 1", "short")


# --- cost detail --------------------------------------------------------------------------------

_MOH = "coalesce(cost_item_level1 IN ('MOH_WEKS', 'MOH_WMI'), false)"
_WRONG = (
    "coalesce((i.site = 'WMI' AND cost_item_level1 = 'MOH_WEKS') OR "
    "(i.site = 'WKS' AND cost_item_level1 = 'MOH_WMI'), false)"
)


def _joins() -> str:
    out = "LEFT JOIN unit_moh u ON u.reporting_month = i.reporting_month AND u.product = i.product AND u.moh_item = i.cost_item_level2\n"
    for t in K.TYPES:
        a = t.lower()
        out += (
            f"LEFT JOIN (SELECT * FROM ledger WHERE type = '{t}') l{a} ON l{a}.reporting_month = i.reporting_month "
            f"AND l{a}.product = i.product AND l{a}.line_item = i.cost_item_level1\n"
            f"LEFT JOIN (SELECT reporting_month, product, avg(value) FILTER (line_item = 'Invoice quantity') AS s, "
            f"avg(value) FILTER (line_item = 'Production quantity') AS p FROM ledger WHERE type = '{t}' GROUP BY ALL) "
            f"q{a} ON q{a}.reporting_month = i.reporting_month AND q{a}.product = i.product\n"
        )
    return out + "LEFT JOIN fx_actual ON month = i.reporting_month"


def _detail(currency: str) -> str:
    by = " / fx" if currency == "USD" else ""
    costs = ", ".join(
        f"CASE WHEN NOT {_WRONG} THEN CASE WHEN {_MOH} THEN (u.unit_moh_{t}{by}) * q{t}.p ELSE l{t}.value{by} END END AS {t}_total_cost"
        for t in TYPES
    )
    quantities = ", ".join(f"q{t}.s AS {t}_shipment, q{t}.p AS {t}_production" for t in TYPES)
    return f"""
SELECT i.reporting_month, i.bg, i.bu, i.site, i.product, cost_box_group, cost_item_level1, cost_item_level2,
  {costs}, {quantities}, '{currency}' AS currency, fx AS fx_rate
FROM every_item i {_joins()}
WHERE i.reporting_month >= DATE '{EARLIEST}-01-01'
"""


define("detail", _detail("NTD"))
define("detail_usd", _detail("USD"))


def detail(d: Domain, currency: str = K.LOCAL, first_year: int = EARLIEST) -> DataFrame:
    full = cost.cost_overview_detail(
        d.ledger, d.control, d.unit_moh, d.rates, currency, first_year
    )
    return conform(full, TABLES["app.cost_overview_dtl"].schema)


@query(
    "cost_detail",
    "G12 A22 J15 J16 J17 J18 R6 S1 F14 P10 P14 IO5",
    f"SELECT * FROM detail WHERE reporting_month >= DATE '{FIRST_YEAR}-01-01'",
)
def cost_detail(d: Domain) -> DataFrame:
    return detail(d, first_year=FIRST_YEAR)


@query("cost_detail_foreign", "G12 F18 G17", "SELECT * FROM detail_usd")
def cost_detail_foreign(d: Domain) -> DataFrame:
    return detail(d, K.FOREIGN)


# --- first level ----------------------------------------------------------------------------------

define(
    "detail_typed",
    """
SELECT x.*, product_type, cost_cat_code, non_adj_flag FROM detail_usd x
LEFT JOIN dim_project p ON p.product = x.product
LEFT JOIN categories ON cost_cat_name = cost_item_level1
""",
)
define(
    "detail_long",
    " UNION ALL ".join(
        "SELECT reporting_month, bg, site, product_type, product, cost_cat_code, cost_item_level1, "
        f"cost_item_level2, '{t}' AS type, {t.lower()}_total_cost AS total_cost, {t.lower()}_shipment AS shipment, "
        f"{t.lower()}_production AS production FROM detail_typed"
        for t in K.TYPES
    ),
)
define(
    "level1_wide",
    f"""
SELECT reporting_month, bg, site, product_type, product, type,
  {", ".join(f"avg(total_cost) FILTER (cost_cat_code = '{c}') AS {c}" for c in CODES)}
FROM detail_long WHERE total_cost IS NOT NULL AND cost_cat_code IS NOT NULL GROUP BY ALL
""",
)
define(
    "level1_quantity",
    "SELECT DISTINCT reporting_month, bg, site, product_type, product, type, shipment, production FROM detail_long",
)


def level1_sql(standard: str, other: str) -> str:
    cols = ", ".join(CODES)
    unit = ", ".join(f"CASE WHEN sum({standard}) > 0 THEN coalesce(sum({c}), 0) / sum({standard}) END AS {c}" for c in CODES)
    passes = four_levels("level1_joined", "bg, reporting_month, type", f"{cols}, {standard}")
    return f"""
SELECT bg, reporting_month, type, cat_ind, {unit}, coalesce(sum({standard}), 0) AS {standard},
  CAST(NULL AS DOUBLE) AS {other}, '{standard}' AS standard
FROM ({passes}) GROUP BY bg, reporting_month, type, cat_ind
"""


define(
    "level1_joined",
    """
SELECT w.*, shipment, production FROM level1_wide w
LEFT JOIN level1_quantity USING (reporting_month, bg, site, product_type, product, type)
""",
)


@query(
    "cost_level1",
    "G13 A13 A14 A22 F9 F17 J7 J8 J26 R2 R7 S1 G17",
    f"""
SELECT bg, reporting_month, type, cat_ind, {", ".join(CODES)}, shipment, production, standard,
  'USD' AS currency, fx AS fx_rate
FROM (({level1_sql("shipment", "production")}) UNION ALL BY NAME ({level1_sql("production", "shipment")}))
LEFT JOIN fx_actual ON month = reporting_month
""",
)
def cost_level1(d: Domain) -> DataFrame:
    return cost.cost_overview_level1(detail(d, K.FOREIGN), d.dim_project, d.categories, d.rates, CODES)


# --- gap ------------------------------------------------------------------------------------------

define(
    "gap_groups",
    """
SELECT bg, reporting_month, site, product_type,
  'ucg_' || CASE split_part(cost_cat_code, '_', 1) WHEN 'oc' THEN 'other' WHEN 'mc' THEN 'mat'
    ELSE split_part(cost_cat_code, '_', 1) END AS grp,
  coalesce(sum(actual_total_cost), 0) AS cost
FROM detail_typed WHERE cost_cat_code IS NOT NULL GROUP BY ALL
""",
)
define(
    "gap_wide",
    f"""
SELECT g.*, ucg_non_adj FROM (
  SELECT bg, reporting_month, site, product_type,
    {", ".join(f"avg(cost) FILTER (grp = '{g}') AS {g}" for g in GROUPS)}, sum(cost) AS ucg_total
  FROM gap_groups GROUP BY ALL) g
LEFT JOIN (
  SELECT bg, reporting_month, site, product_type, coalesce(sum(actual_total_cost), 0) AS ucg_non_adj
  FROM detail_typed WHERE non_adj_flag = 1 GROUP BY ALL) USING (bg, reporting_month, site, product_type)
""",
)
_GAP = [*GROUPS, "ucg_total", "ucg_non_adj"]


@query(
    "cost_gap",
    "G14 A13 A18 A19 F11 F12 F20 J9 J28 G17",
    f"""
SELECT l.*, 'Actual' AS type, 'USD' AS currency, fx AS fx_rate FROM (
  SELECT bg, reporting_month, cat_ind, {", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in _GAP)}
  FROM ({four_levels("gap_wide", "bg, reporting_month", ", ".join(_GAP))}) GROUP BY bg, reporting_month, cat_ind) l
LEFT JOIN fx_actual ON month = reporting_month
""",
)
def cost_gap(d: Domain) -> DataFrame:
    return cost.cost_overview_gap(detail(d, K.FOREIGN), d.dim_project, d.categories, d.rates, GROUPS)


# --- second level -----------------------------------------------------------------------------------

define(
    "level2_rows",
    """
SELECT bg, reporting_month, type, product, cost_cat_code, 'aggregate' AS cost_item_level2, site, product_type,
  total_cost, shipment, production
FROM detail_long WHERE cost_item_level1 = cost_item_level2
UNION ALL
SELECT bg, reporting_month, type, product, cost_cat_code, cost_item_level2, site, product_type,
  total_cost, shipment, production
FROM detail_long WHERE (cost_item_level1 = cost_item_level2) IS NOT TRUE
UNION ALL
SELECT bg, reporting_month, type, product, cost_cat_code, 'aggregate', site, product_type,
  coalesce(sum(total_cost), 0), coalesce(sum(shipment), 0), coalesce(sum(production), 0)
FROM detail_long WHERE (cost_item_level1 = cost_item_level2) IS NOT TRUE AND cost_item_level1 IS NOT NULL
GROUP BY bg, reporting_month, site, product_type, product, cost_cat_code, cost_item_level1, type
""",
)


@query(
    "level2_unit_cost",
    "G15 A13 A16 A20 F17 J27 P15 R4 S1 G17",
    f"""
SELECT l.*, CASE WHEN shipment > 0 THEN total_cost / shipment END AS unit_cost_ship,
  CASE WHEN production > 0 THEN total_cost / production END AS unit_cost_prod,
  'USD' AS currency, fx AS fx_rate
FROM (
  SELECT bg, reporting_month, type, product AS project, cost_cat_code, cost_item_level2 AS cost_level2, cat_ind,
    coalesce(sum(total_cost), 0) AS total_cost, coalesce(sum(shipment), 0) AS shipment,
    coalesce(sum(production), 0) AS production
  FROM ({four_levels("level2_rows", "bg, reporting_month, type, product, cost_cat_code, cost_item_level2", "total_cost, shipment, production")})
  WHERE cost_cat_code IS NOT NULL AND cost_item_level2 IS NOT NULL
  GROUP BY bg, reporting_month, type, product, cost_cat_code, cost_item_level2, cat_ind) l
LEFT JOIN fx_actual ON month = reporting_month
""",
)
def level2_unit_cost(d: Domain) -> DataFrame:
    rows = cost.cost_overview_level2(detail(d, K.FOREIGN), d.dim_project, d.categories, d.rates)
    return conform(rows, TABLES["app.cost_overview_level2"].schema)


# --- the reshaping steps on their own -----------------------------------------------------------------


@query(
    "type_unpivot",
    "R2 R4",
    """
SELECT reporting_month, product, cost_item_level1, cost_item_level2, type, total_cost, shipment, production
FROM detail_long
""",
)
def type_unpivot(d: Domain) -> DataFrame:
    ids = ["reporting_month", "product", "cost_item_level1", "cost_item_level2"]
    families = {m: m for m in ("total_cost", "shipment", "production")}
    return melt_types(detail(d, K.FOREIGN), ids, families)


@query(
    "type_pivot_mean",
    "R5 R7 C4",
    f"""
SELECT reporting_month, line_item, {", ".join(f"sum(value) FILTER (type = '{t}') / count(value) FILTER (type = '{t}') AS {t.lower()}" for t in K.TYPES)}
FROM ledger WHERE value IS NOT NULL GROUP BY reporting_month, line_item
""",
    shared=False,
)
def type_pivot_mean(d: Domain) -> DataFrame:
    names = {t: t.lower() for t in K.TYPES}
    return pivot_mean(d.ledger, ["reporting_month", "line_item"], "type", "value", names)


@query(
    "level_split",
    "P14 P15 A20",
    """
SELECT part, cost_item_level2, count(*) AS n, sum(actual_total_cost) AS total FROM (
  SELECT CASE WHEN cost_item_level1 IN ('MOH_WEKS', 'MOH_WMI') THEN 'moh'
    WHEN cost_item_level1 = cost_item_level2 THEN 'single' ELSE 'several' END AS part,
    cost_item_level2, actual_total_cost FROM detail)
GROUP BY ALL
UNION ALL
SELECT 'labelled', cost_item_level2, count(*), sum(actual_total_cost) FROM (
  SELECT 'aggregate' AS cost_item_level2, actual_total_cost FROM detail
  UNION ALL SELECT cost_item_level2, actual_total_cost FROM detail WHERE cost_item_level1 <> cost_item_level2)
GROUP BY ALL
""",
)
def level_split(d: Domain) -> DataFrame:
    rows = settle(detail(d))
    moh, rest = split_rows(rows, cost.is_site_moh(F.col("cost_item_level1")))
    single, several = split_no_level2(rest)
    parts = [("moh", moh), ("single", single), ("several", several), ("labelled", with_aggregate_level(rows))]
    out = None
    for name, df in parts:
        counted = df.groupBy(F.lit(name).alias("part"), "cost_item_level2").agg(
            F.count(F.lit(1)).alias("n"), F.sum("actual_total_cost").alias("total")
        )
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "cost_category_lookup",
    "J8 J9",
    """SELECT reporting_month, product, cost_item_level1, cost_item_level2, cost_cat_code, non_adj_flag
FROM detail LEFT JOIN categories ON cost_cat_name = cost_item_level1""",
)
def cost_category_lookup(d: Domain) -> DataFrame:
    found = cost_category_code(detail(d), d.categories, flag=True)
    return found.select(
        "reporting_month", "product", "cost_item_level1", "cost_item_level2", "cost_cat_code", "non_adj_flag"
    )


@query(
    "unit_cost_rollup",
    "A13 A14 F17",
    f"""
SELECT bg, reporting_month, type, cat_ind,
  {", ".join(f"CASE WHEN sum(production) > 0 THEN coalesce(sum({c}), 0) / sum(production) END AS {c}" for c in ("mc_std", "oc_freight"))},
  coalesce(sum(production), 0) AS production
FROM ({four_levels("level1_joined", "bg, reporting_month, type", "mc_std, oc_freight, production")})
GROUP BY bg, reporting_month, type, cat_ind
""",
)
def unit_cost_rollup(d: Domain) -> DataFrame:
    typed = cost_category_code(
        detail(d, K.FOREIGN).join(d.dim_project.select("product", "product_type"), "product", "left"), d.categories
    )
    ids = ["reporting_month", "bg", "site", "product_type", "product"]
    long = melt_types(typed, [*ids, "cost_cat_code"], {"value": "total_cost", "production": "production"})
    # Every code takes part in the pivot, so that a product with other costs keeps its quantity.
    wide = pivot_mean(
        long, [*ids, "type"], "cost_cat_code", "value", CODES, [F.max("production").alias("production")]
    )
    return cost.unit_cost_rollup(wide, ["mc_std", "oc_freight"], "production")
