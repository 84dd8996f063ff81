"""Lookups, exchange rates, filters and small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.checks.ctes import define
from costloom.checks.domain import Domain
from costloom.checks.q_performance import rate_by_type
from costloom.checks.registry import query
from costloom.functions.dates import month_start
from costloom.functions.missing import any_of, sum0, total0
from costloom.operators import fx
from costloom.operators.joins import duplicate_keys, rows_matching, without_pairs
from costloom.operators.lookups import (
    item_code,
    item_description,
    latest_param,
    line_item_short,
    model_code_of_product,
    product_type,
    project_status,
    site_of_product,
    with_forecast_version,
)
from costloom.operators.rollup import ratio

# --- exchange rates ---------------------------------------------------------------------------


@query(
    "forecast_versions",
    "J14 A22 F1",
    "SELECT period, CAST(version AS DATE) AS version FROM versions",
)
def forecast_versions(d: Domain) -> DataFrame:
    return d.versions


@query(
    "fx_single_policy",
    "J12 F3 F4 P7",
    """
SELECT m, n, amount, a.fx AS actual_fx, b.fx AS budget_fx, r.fx AS r3m_fx,
  amount * a.fx AS local_amount, CAST(version AS DATE) AS version FROM (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, count(*) AS n,
    sum(floor(l_extendedprice)) AS amount FROM lineitem GROUP BY 1)
LEFT JOIN versions ON period = m LEFT JOIN fx_actual a ON a.month = m
LEFT JOIN fx_budget b ON b.y = year(m)
LEFT JOIN fx_r3m r ON r.month = CAST(date_trunc('month', version) + INTERVAL 1 MONTH AS DATE)
""",
)
def fx_single_policy(d: Domain) -> DataFrame:
    monthly = d.table("lineitem").groupBy(month_start(F.col("l_shipdate")).alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("l_extendedprice").cast("double")).alias("amount")
    )
    dated = with_forecast_version(monthly, d.versions, "m")
    for kind, name in (("Actual", "actual_fx"), ("Budget", "budget_fx"), ("R3M", "r3m_fx")):
        dated = fx.add_rate(dated, d.rates, "m", kind, "version").withColumnRenamed("FX", name)
    return dated.withColumn("local_amount", fx.foreign_to_local(F.col("amount"), F.col("actual_fx")))


define(
    "typed_months",
    "SELECT m AS reporting_month, product, type, sum(cents) AS amount FROM lines GROUP BY ALL",
)


def typed_months(d: Domain) -> DataFrame:
    return d.cube.groupBy(F.col("m").alias("reporting_month"), "product", "type").agg(
        F.sum("cents").alias("amount")
    )


@query(
    "fx_mixed_type",
    "J13 J14 A23 S1 G17",
    rate_by_type("typed_months", "reporting_month, product, type, amount, 'NTD' AS currency, fx AS fx_rate"),
    shared=False,
)
def fx_mixed_type(d: Domain) -> DataFrame:
    return fx.tag_local(typed_months(d), d.rates, d.versions)


@query(
    "fx_to_foreign",
    "F18 G17 J12",
    """SELECT reporting_month, product, type, amount / fx AS amount, 'USD' AS currency, fx AS fx_rate
FROM typed_months LEFT JOIN fx_actual ON month = reporting_month""",
    shared=False,
)
def fx_to_foreign(d: Domain) -> DataFrame:
    tagged = fx.tag_foreign(typed_months(d), d.rates)
    return fx.local_to_foreign(tagged, ["amount"], "fx_rate")


# --- lookups ------------------------------------------------------------------------------------


@query(
    "project_lookups",
    "J2 J3 J6 J7 C15",
    """
SELECT reporting_month, t.product, type, amount, site, code, project_status, product_type
FROM typed_months t LEFT JOIN project_info ON project_name = t.product
""",
    shared=False,
)
def project_lookups(d: Domain) -> DataFrame:
    rows = site_of_product(typed_months(d), d.project_info, "product")
    rows = rows.drop("AllieCode Name", "Project name")
    rows = model_code_of_product(rows, d.project_info, "product")
    rows = product_type(project_status(rows, d.dim_project), d.dim_project)
    return rows.drop("Project name").withColumnsRenamed({"AllieCode Name": "code", "Site": "site"})


@query(
    "item_lookups",
    "J4 J5 J10 C15",
    """
SELECT l_linenumber, v.variable, n, i.accounting_item_desc, i.accounting_item_group, k.accounting_item_code,
  c.short AS line_item_short
FROM (
  SELECT l_linenumber, CASE l_linenumber WHEN 1 THEN 'IDL cost' WHEN 2 THEN 'Dep' WHEN 3 THEN 'PPV'
    WHEN 4 THEN 'Sales normal' ELSE 'other' END AS variable, count(*) AS n FROM lineitem GROUP BY ALL) v
LEFT JOIN items_map i ON i.variable = v.variable
LEFT JOIN item_codes k ON k.accounting_item_desc = i.accounting_item_desc
LEFT JOIN control c ON c.line_item = i.accounting_item_desc
""",
)
def item_lookups(d: Domain) -> DataFrame:
    ln = F.col("l_linenumber")
    name = (
        F.when(ln == 1, "IDL cost").when(ln == 2, "Dep").when(ln == 3, "PPV")
        .when(ln == 4, "Sales normal").otherwise("other")
    )
    counted = d.table("lineitem").groupBy("l_linenumber", name.alias("variable")).agg(
        F.count(F.lit(1)).alias("n")
    )
    described = item_code(item_description(counted, d.items_map), d.item_codes)
    return line_item_short(described, d.control, "accounting_item_desc")


@query(
    "duplicate_keys",
    "C15",
    """SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS "count"
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_key_check(d: Domain) -> DataFrame:
    orders = d.table("orders").select("o_custkey", month_start(F.col("o_orderdate")).alias("m"))
    return duplicate_keys(orders, ["o_custkey", "m"])


@query(
    "params_latest",
    "T3 C14",
    """
SELECT reporting_month, scrap, amount, (SELECT arg_max(value, date) FROM params WHERE param = 'scrap_target') AS target
FROM (SELECT reporting_month, sum(fg_scrap_amount) AS scrap, sum(cogs) AS amount FROM kpi GROUP BY 1)
WHERE scrap > amount * (SELECT arg_max(value, date) FROM params WHERE param = 'scrap_target')
""",
    shared=False,
)
def params_latest(d: Domain) -> DataFrame:
    target = latest_param(d.params).filter(F.col("param") == "scrap_target").select("value").scalar()
    monthly = d.kpi.groupBy("reporting_month").agg(
        F.sum("fg_scrap_amount").alias("scrap"), F.sum("cogs").alias("amount")
    )
    limited = monthly.withColumn("target", target)
    return limited.filter(F.col("scrap") > F.col("amount") * F.col("target"))


# --- filters --------------------------------------------------------------------------------------


@query(
    "pair_filter",
    "P16 P17 P9",
    """
SELECT 'kept' AS part, l_returnflag, l_linestatus, count(*) AS n FROM lineitem
WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'R' AND l_linestatus = 'O')) GROUP BY ALL
UNION ALL
SELECT 'exact', l_returnflag, l_linestatus, count(*) FROM lineitem
WHERE l_returnflag = 'N' AND l_linestatus = 'O' GROUP BY ALL
UNION ALL
SELECT 'listed', l_returnflag, l_linestatus, count(*) FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY ALL
""",
)
def pair_filter(d: Domain) -> DataFrame:
    lines = d.table("lineitem")
    kept = without_pairs(lines, "l_returnflag", "l_linestatus", [("A", "F"), ("R", "O")])
    exact = rows_matching(lines, {"l_returnflag": "N", "l_linestatus": "O"})
    listed = lines.filter(any_of(F.col("l_returnflag"), ["A", "N"]))
    counts = [
        df.groupBy(F.lit(name).alias("part"), "l_returnflag", "l_linestatus").agg(
            F.count(F.lit(1)).alias("n")
        )
        for name, df in (("kept", kept), ("exact", exact), ("listed", listed))
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# --- aggregates -------------------------------------------------------------------------------------


@query(
    "mixed_aggregate",
    "A5 A3 A6 A7 C2",
    """
SELECT product, type, coalesce(sum(cents) FILTER (shipped AND ln = 7), 0) AS late_cents, sum(cents) AS cents,
  sum(q) / count(q) AS mean_q, max(q) AS max_q, count(*) AS n
FROM lines GROUP BY product, type HAVING count(*) >= 6
""",
)
def mixed_aggregate(d: Domain) -> DataFrame:
    late = F.when(F.col("shipped") & (F.col("ln") == 7), F.col("cents"))
    return (
        d.lines.groupBy("product", "type")
        .agg(
            sum0(late).alias("late_cents"),
            F.sum("cents").alias("cents"),
            F.avg("q").alias("mean_q"),
            F.max("q").alias("max_q"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("n") >= 6)
    )


@query(
    "global_share",
    "A10 F17",
    """
SELECT reporting_month, product, type, CASE WHEN (SELECT sum(amount) FROM typed_months) = 0 THEN NULL
  ELSE amount / (SELECT sum(amount) FROM typed_months) END AS share
FROM typed_months
""",
)
def global_share(d: Domain) -> DataFrame:
    rows = typed_months(d)
    total = rows.agg(F.sum("amount")).scalar()
    return rows.withColumn("total", total).select(
        "reporting_month", "product", "type", ratio("amount", "total").alias("share")
    )


@query(
    "sum_distinct_ratio",
    "A11",
    """
SELECT product, sum(DISTINCT q) AS distinct_sum, sum(q) AS total, sum(q) / sum(DISTINCT q) AS ratio
FROM lines GROUP BY product
""",
)
def sum_distinct_ratio(d: Domain) -> DataFrame:
    sums = d.lines.groupBy("product").agg(
        F.sum_distinct(F.col("q")).alias("distinct_sum"), F.sum("q").alias("total")
    )
    return sums.withColumn("ratio", ratio("total", "distinct_sum"))


@query(
    "distinct_rows",
    "A22 A23",
    "SELECT DISTINCT m, product, type FROM lines",
)
def distinct_rows(d: Domain) -> DataFrame:
    return d.lines.select("m", "product", "type").distinct()


@query(
    "conditional_sum",
    "A18 A19 A4 A8 A9",
    """
SELECT product, coalesce(sum(cents) FILTER (ln = 1), 0) AS flagged, sum(cents) FILTER (type <> 'R3M') AS not_r3m,
  coalesce(sum(cents) FILTER (type = 'Actual'), 0) + coalesce(sum(cents) FILTER (type = 'Budget' AND ln = 7 AND q = 50 AND tax > 0.079), 0) AS row_total
FROM lines GROUP BY product
""",
)
def conditional_sum(d: Domain) -> DataFrame:
    rare = (F.col("type") == "Budget") & (F.col("ln") == 7) & (F.col("q") == 50) & (F.col("tax") > 0.079)
    cents = F.col("cents")
    sums = d.lines.groupBy("product").agg(
        sum0(F.when(F.col("ln") == 1, cents)).alias("flagged"),
        F.sum(F.when(F.col("type") != "R3M", cents)).alias("not_r3m"),
        F.sum(F.when(F.col("type") == "Actual", cents)).alias("a"),
        F.sum(F.when(rare, cents)).alias("b"),
    )
    return sums.withColumn("row_total", total0(F.col("a"), F.col("b"))).drop("a", "b")


