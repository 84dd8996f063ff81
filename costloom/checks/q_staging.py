"""Raw templates to staging tables, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.checks.ctes import define
from costloom.checks.domain import Domain, RAW_COLUMNS
from costloom.checks.registry import query
from costloom.contracts import TABLES, conform
from costloom.functions.dates import month_start
from costloom.operators.lookups import latest_by
from costloom.operators.reshape import melt, stack
from costloom.plans import staging
from costloom.session import ensure_checkpoint_dir, settle
from costloom.sources import Store, Template
from costloom.sources.templates import load_all

# --- normalised profit and loss ---------------------------------------------------------------

_RAW = [n for n, *_ in RAW_COLUMNS]
_QUOTED = ", ".join(f'"{n}"' for n in _RAW)

define(
    "latest_pl",
    """
SELECT * FROM raw_pl
QUALIFY row_number() OVER (PARTITION BY type, "Period", "Project" ORDER BY "Version" DESC) = 1
""",
)
define(
    "filled_pl",
    f"""
SELECT * REPLACE (coalesce("{K.SHIPPED_UNITS}", "{K.INVOICED_UNITS}") AS "{K.SHIPPED_UNITS}") FROM latest_pl
""",
)
define(
    "long_pl",
    " UNION ALL ".join(
        f"SELECT type, \"Year\", \"Month\", \"Period\", \"Site\", \"Project\", \"Version\", m, '{n}' AS variable, "
        f'"{n}" AS value FROM filled_pl'
        for n in _RAW
    ),
)
define(
    "normal_pl",
    """
SELECT p.type, "Year", "Month", m AS "Period", "Site", "Project", strptime("Version", '%Y%m%d')::DATE AS "Version",
  p.variable, value, accounting_item_desc, accounting_item_group, accounting_item_code,
  CASE WHEN accounting_item_desc NOT LIKE '%quantity%' THEN 'NTD' END AS currency, fx AS "FX",
  'SDBG' AS bg, '' AS bu
FROM long_pl p JOIN items_map i USING (variable) LEFT JOIN item_codes c USING (accounting_item_desc)
LEFT JOIN rated ON fx_type = p.type AND fx_date = CASE p.type
  WHEN 'Actual' THEN m WHEN 'Budget' THEN make_date(year(m), 1, 1)
  ELSE CAST(strptime("Version", '%Y%m%d') + INTERVAL 1 MONTH AS DATE) END
""",
)


def normal(d: Domain, kind: str) -> DataFrame:
    return staging.normalise_pl(d.raw_pl(kind), d.items_map, d.item_codes, d.rates, kind)


_NORMAL = (
    'type, "Year", "Month", "Period", "Site", "Project", "Version", variable, value, '
    'accounting_item_desc, accounting_item_group, accounting_item_code, currency, "FX", bg, bu'
)
_NORMAL_COLUMNS = [c.strip().strip('"') for c in _NORMAL.split(",")]

for _kind, _ids in (("Budget", "G1 W3 T2 F1 F8 F13 R1 J4 J5 J12 P3 P8"), ("R3M", "G1 F4 J12")):

    @query(f"pl_normalise_{_kind.lower()}", _ids, f"SELECT {_NORMAL} FROM normal_pl WHERE type = '{_kind}'", shared=False)
    def pl_normalise(d: Domain, kind: str = _kind) -> DataFrame:
        return normal(d, kind).select(*_NORMAL_COLUMNS)


_LEDGER = (
    "reporting_month, bg, bu, site, product, type, line_itm_group, line_item, value, currency, "
    "fx_rate, version"
)


@query(
    "pl_to_ledger",
    "G2 P2 P8 IO5",
    """
SELECT "Period" AS reporting_month, bg, bu, "Site" AS site, "Project" AS product, type,
  accounting_item_group AS line_itm_group, accounting_item_desc AS line_item, value, currency,
  "FX" AS fx_rate, "Version" AS version
FROM normal_pl WHERE type IN ('Budget', 'R3M') AND (accounting_item_group IS NOT NULL OR currency IS NULL)
""",
    shared=False,
)
def pl_to_ledger(d: Domain) -> DataFrame:
    shape = TABLES["staging.tbl_is_modeltype"].schema
    return stack(*[conform(staging.pl_to_ledger(normal(d, kind)), shape) for kind in ("Budget", "R3M")])


define(
    "moh_raw",
    """
SELECT normal_pl."Site" AS site, code AS model_code, "Project" AS model_name, type,
  CASE WHEN accounting_item_desc IN ('Depreciation-W-buy', 'IDL', 'Facilities', 'other utilities')
    THEN 'Fixed' ELSE 'Variable' END AS moh_item_type,
  accounting_item_desc, value AS amount, currency, "Period" AS period_start,
  'monthly' AS update_frequency, "Period" AS last_update_time, "Period" AS stat_dt
FROM normal_pl LEFT JOIN project_info ON "Project" = project_name
WHERE accounting_item_group IS NULL
""",
)


def moh_raw(d: Domain) -> DataFrame:
    parts = [staging.pl_to_moh_raw(normal(d, t), d.project_info, t) for t in K.TYPES]
    return stack(*parts)


@query(
    "pl_to_moh_raw",
    "G3 F14 J3 P1 P4 P9",
    "SELECT * FROM moh_raw",
)
def pl_to_moh_raw(d: Domain) -> DataFrame:
    return moh_raw(d).withColumnsRenamed({"Site": "site", "MOH_item_type": "moh_item_type"})


# --- actual history -----------------------------------------------------------------------------

define(
    "history_pl",
    " UNION ALL ".join(
        "SELECT 'Actual' AS type, m, product, "
        f"{{site}} AS site, '{n}' AS variable, {{src}} AS value FROM wide WHERE type = 'Actual'".replace(
            "{src}", f"coalesce(inv_q, all_q)" if n == K.SHIPPED_UNITS else src
        ).replace("{site}", "(CASE WHEN bn % 5 = 0 THEN 'WMI' WHEN bn % 5 = 1 THEN 'WKS' ELSE 'S' || lpad(CAST(bn AS VARCHAR), 2, '0') END)")
        for n, src, _, _ in RAW_COLUMNS
    ),
)
define(
    "is_model",
    """
SELECT 'PCA000' AS profit_center, 'SDBG' AS profit_center_name, '' AS model_code, product AS model_name,
  accounting_item_code, accounting_item_group, accounting_item_desc, value AS amount,
  CASE WHEN accounting_item_desc NOT LIKE '%quantity%' THEN 'NTD' END AS currency, m AS period_start,
  m AS last_update_time, m AS stat_dt, 'monthly' AS update_frequency
FROM history_pl JOIN items_map USING (variable) LEFT JOIN item_codes USING (accounting_item_desc)
WHERE accounting_item_group IS NOT NULL OR accounting_item_desc LIKE '%quantity%'
""",
)


def history(d: Domain) -> DataFrame:
    """Actual profit and loss without versions."""
    w = d.wide().filter(F.col("type") == "Actual")
    return w.select(
        F.year("m").alias("Year"),
        F.month("m").alias("Month"),
        F.date_format("m", "yyyy/MM").alias("Period"),
        d.site(F.col("product")).alias("Site"),
        F.col("product").alias("Project"),
        *[F.col(source).alias(name) for name, source, _, _ in RAW_COLUMNS],
    )


@query("actual_to_is_model", "G5 F8 F13 P3 P4 P8 R1 J4 J5", "SELECT * FROM is_model", shared=False)
def actual_to_is_model(d: Domain) -> DataFrame:
    return staging.actual_to_is_model(history(d), d.items_map, d.item_codes)


@query(
    "actual_ledger",
    "G5 F5 J2 J12 P2",
    """
SELECT period_start AS reporting_month, profit_center_name AS bg, '' AS bu, site, model_name AS product,
  'Actual' AS type, accounting_item_group AS line_itm_group, accounting_item_desc AS line_item,
  amount AS value, currency, fx AS fx_rate, make_date(year(period_start) - 1, 12, 1) AS version
FROM is_model LEFT JOIN project_info ON model_name = project_name LEFT JOIN fx_actual ON month = period_start
""",
    shared=False,
)
def actual_ledger(d: Domain) -> DataFrame:
    rows = staging.is_model_to_ledger(
        staging.actual_to_is_model(history(d), d.items_map, d.item_codes), d.project_info, d.rates
    )
    return conform(rows, TABLES["staging.tbl_is_modeltype"].schema)


# --- unit overhead ------------------------------------------------------------------------------

define(
    "positive_moh",
    """
SELECT * REPLACE (CASE WHEN amount > 0 THEN amount END AS amount) FROM moh_raw
WHERE accounting_item_desc <> 'Invoice quantity'
""",
)
define(
    "quote_moh",
    """
SELECT m AS period_start, product AS model_name, accounting_item_desc, value * fx AS unit_moh_quote FROM (
  SELECT m, product, unnest(['Depreciation-W-buy', 'IDL', ' Electricity&Water']) AS accounting_item_desc,
    unnest([dep / all_q, idl / all_q, elec / all_q]) AS value
  FROM wide WHERE type = 'Budget')
LEFT JOIN fx_actual ON month = m WHERE value > 0
UNION ALL
SELECT m, product, accounting_item_desc, NULL FROM (
  SELECT m, product, unnest(['Depreciation-W-buy', 'IDL', ' Electricity&Water']) AS accounting_item_desc,
    unnest([dep / all_q, idl / all_q, elec / all_q]) AS value
  FROM wide WHERE type = 'Budget') WHERE (value > 0) IS NOT TRUE
""",
)


def quote(d: Domain) -> DataFrame:
    """Raw quoted unit costs: budget cost per unit."""
    w = d.wide().filter(F.col("type") == "Budget")
    return w.select(
        F.year("m").alias("Year"),
        F.month("m").alias("Month"),
        F.date_format("m", "yyyy/MM").alias("Period"),
        d.site(F.col("product")).alias("Site"),
        F.col("product").alias("Project"),
        (F.col("dep") / F.col("all_q")).alias("Dep"),
        (F.col("idl") / F.col("all_q")).alias("IDL cost"),
        (F.col("elec") / F.col("all_q")).alias("Elec"),
        F.col("prod_q").alias("Prod qty"),
    )


def _ieee(a: str, b: str) -> str:
    return (
        f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) END ELSE ({a}) / ({b}) END"
    )


@query(
    "unit_moh",
    "G6 C4 P5 P6 P14 P21 P22 R5 J24 J25 F18",
    f"""
WITH cost AS (
  SELECT period_start, site, model_name, accounting_item_desc,
    {", ".join(f"avg(amount) FILTER (type = '{t}') AS {t.lower()}_c" for t in K.TYPES)}
  FROM positive_moh WHERE accounting_item_desc <> 'Production quantity' AND amount IS NOT NULL
  GROUP BY ALL),
units AS (
  SELECT period_start, site, model_name,
    {", ".join(f"avg(amount) FILTER (type = '{t}') AS {t.lower()}_q" for t in K.TYPES)}
  FROM positive_moh WHERE accounting_item_desc = 'Production quantity' AND amount IS NOT NULL
  GROUP BY ALL)
SELECT period_start AS reporting_month, 'SDBG' AS bg, '' AS bu, cost.site AS site, model_name AS product,
  accounting_item_desc AS moh_item, {", ".join(_ieee(f"{t.lower()}_c", f"{t.lower()}_q") + f" AS unit_moh_{t.lower()}" for t in K.TYPES)},
  unit_moh_quote, 'NTD' AS currency
FROM cost LEFT JOIN units USING (period_start, model_name)
LEFT JOIN quote_moh USING (period_start, model_name, accounting_item_desc)
""",
)
def unit_moh(d: Domain) -> DataFrame:
    quotes = staging.quote_by_item(quote(d), d.items_map, d.rates)
    return staging.unit_moh(settle(moh_raw(d)), quotes)


# --- KPI feeds --------------------------------------------------------------------------------------


def kpi_feeds(d: Domain) -> list[DataFrame]:
    """Six raw feeds whose months and models differ, one row per model and month each."""
    m, product = F.col("m"), F.col("product")
    q, cents, ln, t = F.col("q"), F.col("cents"), F.col("ln"), F.col("type")

    def feed(cond, *aggs, name="Model", month=m):
        return d.cube.filter(cond).groupBy(product.alias(name), month.alias("Month")).agg(*aggs)

    return [
        feed(
            t == "Actual",
            F.sum(q).alias("ADS"),
            F.sum(cents).alias("COGS NTD"),
            F.sum(F.when(ln == 1, cents)).alias("Inventory NTD"),
            F.max("max_q").alias("ads_target"),
        ),
        feed(t == "Budget", F.sum(q).alias("APR _volume"), name="project"),
        feed(t == "R3M", F.sum(q).alias("MPS _volume"), name="project"),
        feed(
            t == "Actual",
            F.sum(cents).alias("Actual Scrap AMT_USD"),
            F.max("max_disc").alias("scrap_rate"),
            name="W_Model",
            month=F.last_day(m),
        ),
        feed(
            t != "Budget",
            F.max("max_disc").alias("Yield rate"),
            F.max("max_tax").alias("yield_rate_current_target"),
            F.min("min_tax").alias("yield_rate_final_target"),
        ),
        feed(t != "Actual", F.max("max_q").alias("Units")),
    ]


define("feed_ads", "SELECT product, m, sum(q) AS ads, sum(cents) AS cogs, sum(cents) FILTER (ln = 1) AS inventory, max(q) AS ads_target FROM lines WHERE type = 'Actual' GROUP BY ALL")
define("feed_apr", "SELECT product, m, sum(q) AS apr FROM lines WHERE type = 'Budget' GROUP BY ALL")
define("feed_mps", "SELECT product, m, sum(q) AS mps FROM lines WHERE type = 'R3M' GROUP BY ALL")
define("feed_scrap", "SELECT product, m, sum(cents) AS scrap, max(disc) AS scrap_rate FROM lines WHERE type = 'Actual' GROUP BY ALL")
define("feed_yield", "SELECT product, m, max(disc) AS yield_rate, max(tax) AS yield_rate_current_target, min(tax) AS yield_rate_final_target FROM lines WHERE type <> 'Budget' GROUP BY ALL")
define("feed_capacity", "SELECT product, m, max(q) AS max_capacity_volume FROM lines WHERE type <> 'Actual' GROUP BY ALL")
define(
    "kpi_model_rows",
    """
SELECT m AS reporting_month, 'SDBG' AS bg, '' AS bu, p.site, f.product, ads, ads_target, cogs, inventory, apr, mps,
  scrap * fx AS fg_scrap_amount, scrap_rate, yield_rate, yield_rate_current_target, yield_rate_final_target,
  max_capacity_volume, 'NTD' AS currency, fx AS fx_rate
FROM feed_ads FULL JOIN feed_apr USING (product, m) FULL JOIN feed_mps USING (product, m)
FULL JOIN feed_scrap USING (product, m) FULL JOIN feed_yield USING (product, m)
FULL JOIN feed_capacity f USING (product, m)
LEFT JOIN dim_project p USING (product) LEFT JOIN fx_actual ON month = m
""".replace("f.product", "product"),
)

for _name, _unique in (("kpi_full_outer", False), ("kpi_full_outer_unique", True)):

    @query(_name, "G4 J1 J2 J12 F2 F18 P2 P3 C5", "SELECT * FROM kpi_model_rows")
    def kpi_full_outer(d: Domain, unique: bool = _unique) -> DataFrame:
        rows = staging.kpi_model(*kpi_feeds(d), d.project_info, d.rates, unique=unique)
        return conform(rows, TABLES["staging.tbl_kpi_model"].schema)


# --- dimensions -----------------------------------------------------------------------------------


@query(
    "dim_project",
    "IO9 P2 P3",
    """
SELECT product, site, product_code, product_type, project_status, mp_start_month,
  CAST(mp_start_month - INTERVAL 6 MONTH AS DATE) AS npi_start_month,
  CAST(mp_start_month + INTERVAL 2 MONTH AS DATE) AS shipment_start_month, 'SDBG' AS bg, '' AS bu
FROM dim_project
""",
)
def dim_project(d: Domain) -> DataFrame:
    return conform(staging.dim_project(d.project_info), TABLES["staging.dim_project"].schema)


@query(
    "product_status",
    "IO10 P2",
    """
SELECT product, site, product_code, product_type, project_status AS product_status, mp_start_month,
  CAST(mp_start_month - INTERVAL 6 MONTH AS DATE) AS npi_start_month,
  CAST(mp_start_month + INTERVAL 2 MONTH AS DATE) AS shipment_start_month, 'SDBG' AS bg, '' AS bu
FROM dim_project
""",
)
def product_status(d: Domain) -> DataFrame:
    dim = staging.dim_project(d.project_info)
    return conform(staging.product_status(dim), TABLES["app.health_product_status"].schema)


@query(
    "latest_version",
    "W3 T2",
    """
SELECT o_custkey, m, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderkey,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""",
)
def latest_version(d: Domain) -> DataFrame:
    orders = d.table("orders").select(
        "o_custkey",
        month_start(F.col("o_orderdate")).alias("m"),
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_totalprice",
    )
    return latest_by(orders, ["o_custkey", "m"], "o_orderdate", ["o_orderkey"])


@query(
    "pl_unpivot",
    "R1",
    " UNION ALL ".join(
        f"SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderpriority, '{v}' AS variable, {e} AS value "
        "FROM orders GROUP BY ALL"
        for v, e in (
            ("open (sum)", "sum(floor(o_totalprice)) FILTER (o_orderstatus = 'O')"),
            ("11.1 closed", "sum(floor(o_totalprice)) FILTER (o_orderstatus = 'F')"),
            ("largest", "max(o_totalprice)"),
        )
    ),
)
def pl_unpivot(d: Domain) -> DataFrame:
    price = F.floor("o_totalprice")
    wide = d.table("orders").groupBy(
        month_start(F.col("o_orderdate")).alias("m"), "o_orderpriority"
    ).agg(
        F.sum(F.when(F.col("o_orderstatus") == "O", price)).alias("open (sum)"),
        F.sum(F.when(F.col("o_orderstatus") == "F", price)).alias("11.1 closed"),
        F.max("o_totalprice").alias("largest"),
    )
    return melt(wide, ["m", "o_orderpriority"])


# --- sources and sinks ------------------------------------------------------------------------------


def _folder(d: Domain) -> str:
    """A fresh folder in the place that every executor can reach."""
    return f"{ensure_checkpoint_dir(d.spark).rstrip('/')}/costloom-{uuid.uuid4().hex}"


@query(
    "store_round_trip",
    "IO4 IO5 IO6 IO7 IO8",
    """
SELECT CASE WHEN month(m) % 2 = 0 THEN 'a' ELSE 'b' END AS part, "From", "To", count(*) AS n, sum("FX") AS total FROM (
  SELECT m, 'USD' AS "From", 'NTD' AS "To", fx AS "FX" FROM order_months JOIN fx_actual ON m = month
  UNION ALL SELECT m, 'EUR', 'NTD', fx + 4 FROM order_months JOIN fx_actual ON m = month)
GROUP BY ALL
""",
)
def store_round_trip(d: Domain) -> DataFrame:
    """Write rates with a surplus column to raw, empty and refill the table, copy it to staging."""
    store = Store(d.spark, _folder(d))
    rows = d.fx_actual.withColumns({"id": F.lit(1), "note": F.lit("x")})
    store.write(rows, "raw", "FX rate", mode="append")
    store.truncate("raw", "FX rate")
    store.write(rows, "raw", "FX rate", mode="append")
    store.copy("FX rate", "fx_rate")
    part = F.when(F.pmod(F.month("Month"), F.lit(2)) == 0, "a").otherwise("b")
    return (
        store.read("staging", "fx_rate")
        .groupBy(part.alias("part"), "From", "To")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("FX").alias("total"))
    )


@query(
    "month_overwrite",
    "IO6",
    "SELECT reporting_month, type, count(*) AS n, sum(value) AS total FROM ledger GROUP BY ALL",
)
def month_overwrite(d: Domain) -> DataFrame:
    """Store the ledger, then store the rows of one type again: months are replaced, not doubled."""
    store = Store(d.spark, _folder(d))
    rows = d.ledger.withColumns(
        {"currency": F.lit("NTD"), "fx_rate": F.lit(1.0), "version": F.col("reporting_month")}
    )
    store.write(rows, "staging", "tbl_is_modeltype")
    store.write(rows.filter(F.col("type") == "Budget"), "staging", "tbl_is_modeltype", mode="folders")
    return (
        store.read("staging", "tbl_is_modeltype")
        .groupBy("reporting_month", "type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )


@query(
    "template_load",
    "IO1 IO2 IO3 F1",
    """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Month", o_orderpriority AS "Model",
  sum(floor(o_totalprice)) AS "Units_sum" FROM orders GROUP BY ALL
""",
)
def template_load(d: Domain) -> DataFrame:
    """Write a CSV template with a bracketed header, then load it by manifest."""
    root = _folder(d)
    rows = d.table("orders").groupBy(
        F.date_format(month_start(F.col("o_orderdate")), "yyyy-MM-dd").alias("Month"),
        F.col("o_orderpriority").alias("Model"),
    ).agg(F.sum(F.floor("o_totalprice")).alias("Units(sum)"))
    rows.write.option("header", True).csv(f"{root}/in/Max capacity.csv")
    store = Store(d.spark, f"{root}/db")
    manifest = [Template("Max capacity", "Max capacity", ("Month",))]
    schema = "Month string, Model string, `Units(sum)` double"
    load_all(store, f"{root}/in", manifest, {"Max capacity": schema})
    return store.read("raw", "Max capacity")


@query(
    "union_by_name",
    "S1 S3",
    """
SELECT m, n, amount, CAST(NULL AS DOUBLE) AS best FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n, sum(floor(o_totalprice)) AS amount FROM orders GROUP BY 1)
UNION ALL
SELECT m, n, NULL, best FROM (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, count(*) AS n, max(l_extendedprice) AS best FROM lineitem GROUP BY 1)
""",
)
def union_by_name(d: Domain) -> DataFrame:
    orders = d.table("orders").groupBy(month_start(F.col("o_orderdate")).alias("m")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.floor("o_totalprice").cast("double")).alias("amount"),
    )
    lines = d.table("lineitem").groupBy(month_start(F.col("l_shipdate")).alias("m")).agg(
        F.max("l_extendedprice").alias("best"), F.count(F.lit(1)).alias("n")
    )
    return stack(orders, lines)


