"""The domain tables as SQL common table expressions, independent of the Spark code."""

from __future__ import annotations

import re

from costloom.checks.domain import (
    AHEAD,
    CATEGORIES,
    CONTROL,
    ITEMS,
    MERGE_MAP,
    PARAMS,
    RAW_COLUMNS,
    WEIGHTS,
)


def _v(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    return repr(x) if not isinstance(x, float) else f"CAST({x!r} AS DOUBLE)"


def _values(rows: list[tuple], cols: str) -> str:
    body = ", ".join("(" + ", ".join(_v(x) for x in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({cols})"


SITE = (
    "CASE WHEN {b} % 5 = 0 THEN 'WMI' WHEN {b} % 5 = 1 THEN 'WKS' "
    "ELSE 'S' || lpad(CAST({b} AS VARCHAR), 2, '0') END"
)

_MEASURES = """
  sum(cents) FILTER (shipped) AS ship_rev,
  -sum(CAST(floor(cents * disc) AS DOUBLE)) FILTER (shipped) AS ret,
  sum(floor(cents * (disc - CAST(0.05 AS DOUBLE)))) AS ppv,
  sum(floor(cents * (tax - CAST(0.04 AS DOUBLE)))) AS muv,
  sum(floor(cents * CAST(0.5 AS DOUBLE))) AS mat,
  sum(floor(cents * CAST(0.125 AS DOUBLE))) AS frt,
  sum(floor(cents * tax)) AS sga,
  sum(floor(cents * CAST(0.0625 AS DOUBLE))) FILTER (NOT shipped) AS dep,
  sum(floor(cents * CAST(0.03125 AS DOUBLE))) AS idl,
  sum(floor(cents * CAST(0.015625 AS DOUBLE))) FILTER (shipped) AS elec,
  sum(q) FILTER (shipped) AS inv_q,
  sum(q) AS all_q,
  sum(q) FILTER (NOT shipped) AS prod_q
"""

TABLES: dict[str, str] = {
    "lines": f"""
SELECT CAST(date_trunc('month', l_shipdate) + CASE WHEN l_returnflag = 'A' THEN INTERVAL 0 MONTH ELSE INTERVAL {AHEAD} MONTH END AS DATE) AS m, 'P' || CAST(CAST(substr(p_brand, 7) AS INT) % 8 AS VARCHAR) || '-' || p_type AS product,
  p_type, CAST(substr(p_brand, 7) AS INT) % 8 AS bn,
  CASE l_returnflag WHEN 'A' THEN 'Actual' WHEN 'N' THEN 'Budget' ELSE 'R3M' END AS type,
  l_linestatus = 'F' AS shipped, l_quantity AS q,
  floor(l_extendedprice * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS cents,
  l_discount AS disc, l_tax AS tax, l_linenumber AS ln
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "wide": f"SELECT m, product, bn, type, {_MEASURES} FROM lines GROUP BY m, product, bn, type",
    "ledger": " UNION ALL ".join(
        f"SELECT m AS reporting_month, 'SDBG' AS bg, '' AS bu, {SITE.format(b='bn')} AS site, product, "
        f"type, {_v(i)} AS line_item, CAST({_v(g)} AS VARCHAR) AS line_itm_group, {s} AS value FROM wide"
        for i, g, s in ITEMS
    ),
    "dim_project": f"""
SELECT 'P' || CAST(bn AS VARCHAR) || '-' || p_type AS product, {SITE.format(b="bn")} AS site,
  'C' || CAST(min(p_partkey) AS VARCHAR) AS product_code, p_type AS product_type,
  CASE WHEN bn % 4 = 0 THEN 'NPI' ELSE 'MP' END AS project_status,
  CASE WHEN bn % 7 <> 0 THEN CAST(DATE '1994-01-01' + to_months(CAST(bn AS INT)) AS DATE) END AS mp_start_month
FROM (SELECT p_partkey, p_type, CAST(substr(p_brand, 7) AS INT) % 8 AS bn FROM part) GROUP BY bn, p_type""",
    "kpi": f"""
SELECT m AS reporting_month, 'SDBG' AS bg, '' AS bu, {SITE.format(b='bn')} AS site, product, ads,
  CASE WHEN apr IS NOT NULL THEN CAST(20.0 AS DOUBLE) END AS ads_target, cogs, inventory, apr, mps,
  fg_scrap_amount, CAST(0.03125 AS DOUBLE) AS scrap_rate,
  CAST(1 AS DOUBLE) - fmod(bad, CAST(128 AS DOUBLE)) / CAST(1024 AS DOUBLE) AS yield_rate,
  CAST(0.96875 AS DOUBLE) AS yield_rate_current_target,
  CAST(0.984375 AS DOUBLE) AS yield_rate_final_target, max_capacity_volume
FROM (
  SELECT m, product, bn, sum(q) FILTER (type = 'Budget') AS apr, sum(q) FILTER (type = 'R3M') AS mps,
    sum(cents) FILTER (type = 'Actual' AND shipped) AS cogs,
    sum(cents) FILTER (type = 'R3M') AS inventory,
    sum(floor(cents * CAST(0.0625 AS DOUBLE))) FILTER (type = 'Actual' AND ln = 1) AS fg_scrap_amount,
    sum(q) FILTER (ln = 2) AS ads, sum(q) FILTER (ln = 3) AS bad, sum(q) AS max_capacity_volume
  FROM lines GROUP BY m, product, bn)""",
    "moh_base": """
SELECT m, product, bn, sum(cents) FILTER (type = 'Actual') AS a, sum(cents) FILTER (type = 'Budget') AS b,
  sum(cents) FILTER (type = 'R3M') AS r, sum(cents) AS e FROM lines GROUP BY m, product, bn""",
    "unit_moh": f"""
SELECT m AS reporting_month, 'SDBG' AS bg, '' AS bu, {SITE.format(b='bn')} AS site, product, moh_item,
  floor(a / k) / CAST(1024 AS DOUBLE) AS unit_moh_actual, floor(b / k) / CAST(1024 AS DOUBLE) AS unit_moh_budget,
  floor(r / k) / CAST(1024 AS DOUBLE) AS unit_moh_r3m,
  floor(e / (3 * k)) / CAST(1024 AS DOUBLE) AS unit_moh_quote
FROM moh_base, (VALUES ('IDL', CAST(64 AS DOUBLE)), ('Depreciation-W-buy', 96), (' Electricity&Water', 256),
  ('other utilities', 1000), ('Production quantity', 3)) i(moh_item, k)""",
    "raw_pl": """
SELECT type, CAST(year(m) AS INT) AS "Year", CAST(month(m) AS INT) AS "Month", strftime(m, '%Y/%m') AS "Period", """
    + SITE.format(b="bn")
    + """ AS "Site", product AS "Project", "Version", m, """
    + ", ".join(f'{s} AS "{n}"' for n, s, _, _ in RAW_COLUMNS)
    + f""" FROM (
  SELECT m, product, bn, type, strftime(m - to_months(CAST(1 + ln % 2 AS INT)), '%Y%m%d') AS "Version",
  {_MEASURES} FROM lines GROUP BY ALL)""",
    "items_map": _values(
        [(n, d, g) for n, _, d, g in RAW_COLUMNS if d],
        "variable, accounting_item_desc, accounting_item_group",
    ),
    "item_codes": _values(
        [(f"A{i:02d}", d) for i, (_, _, d, _) in enumerate(RAW_COLUMNS) if d],
        "accounting_item_code, accounting_item_desc",
    ),
    "merge_map": "SELECT accounting_item_desc, max(app_item) AS app_item FROM ("
    + _values(MERGE_MAP, "accounting_item_desc, app_item")
    + ") GROUP BY 1",
    "control": _values(CONTROL, "bg, line_item, line_itm_group, detailed_item, short"),
    "categories": _values(CATEGORIES, "cost_cat_code, cost_cat_name, non_adj_flag"),
    "weights": _values(WEIGHTS, "idx, weight"),
    "params": "SELECT param, value, CAST(d AS DATE) AS date FROM ("
    + _values(PARAMS, "param, value, d")
    + ")",
    "order_months": "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders",
    "fx_actual": "SELECT m AS month, CAST(16 << CAST(month(m) % 3 AS INT) AS DOUBLE) AS fx FROM order_months",
    "fx_budget": "SELECT DISTINCT year(m) AS y, CAST(31 AS DOUBLE) + (year(m) % 8) / CAST(8 AS DOUBLE) AS fx FROM order_months",
    "fx_r3m": "SELECT m AS month, CAST(29 AS DOUBLE) + month(m) / CAST(32 AS DOUBLE) AS fx FROM order_months",
    "versions": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
  max(CAST(date_trunc('month', o_orderdate) AS DATE) - CAST(o_custkey % 40 + 1 AS INT)) AS version
FROM orders GROUP BY 1""",
    "project_info": """
SELECT product AS project_name, site, product_code AS code, product_type, project_status,
  mp_start_month FROM dim_project""",
}


def define(name: str, sql: str) -> None:
    """Add a shared table."""
    TABLES[name] = sql


def _uses(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [t for t in TABLES if t in words]


def _closure(sql: str) -> list[str]:
    need: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for t in _uses(text):
            if t != own and t not in need:
                visit(TABLES[t], t)
                if t not in need:
                    need.append(t)

    visit(sql)
    return need


def with_tables(sql: str) -> str:
    """SQL preceded by the shared tables it names, in dependency order."""
    body = sql.strip()
    need = _closure(body)
    if not need:
        return body
    defs = ",\n".join(f"{t} AS MATERIALIZED ({TABLES[t].strip()})" for t in need)
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"{head}{defs},\n{body[len(head):]}"
    return f"WITH {defs}\n{body}"
