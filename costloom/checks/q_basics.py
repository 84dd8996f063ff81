"""Scalar rules: dates, texts, missing values, filters on months, series windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.checks.ctes import define
from costloom.checks.domain import Domain
from costloom.checks.registry import query
from costloom.functions import dates
from costloom.functions.missing import (
    clamp01,
    div_guarded,
    div_ieee,
    finite,
    greatest_first,
    holds,
    inf_to_null,
    nan_to_null,
    positive_or_null,
)
from costloom.functions.text import fixed2, thousands, whole
from costloom.operators.series import (
    actual_until,
    append_next_month,
    lagged_mean,
    long_enough,
    series_length,
)
from costloom.plans.cost import level0
from costloom.plans.staging import _currency


@query(
    "date_functions",
    "F1 F2 F3 F4 F5 F6 F7 C13",
    """
SELECT d, date_trunc('month', d)::DATE AS month_start, date_trunc('month', d)::DATE AS parsed_month,
  d AS parsed_day, d AS parsed_version, CAST(year(d) AS INT) AS y,
  (date_trunc('month', d) + INTERVAL 1 MONTH)::DATE AS rate_month, make_date(year(d) - 1, 12, 1) AS december,
  (d + INTERVAL 1 MONTH)::DATE AS next_month,
  greatest(date_diff('day', d, DATE '1999-01-01'), 0) / CAST(30 AS DOUBLE) AS age, n
FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
""",
)
def date_functions(d: Domain) -> DataFrame:
    days = d.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )
    c = F.col("d")
    return days.select(
        "d",
        dates.month_start(c).alias("month_start"),
        dates.parse_month(F.date_format(c, "yyyy/MM")).alias("parsed_month"),
        dates.parse_day(F.date_format(c, "yyyy-MM-dd")).alias("parsed_day"),
        dates.parse_version(F.date_format(c, "yyyyMMdd")).alias("parsed_version"),
        F.year(c).alias("y"),
        dates.version_rate_month(c).alias("rate_month"),
        dates.december_before(c).alias("december"),
        dates.next_month(c).alias("next_month"),
        dates.months_in_production(F.lit("1999-01-01").cast("date"), c).alias("age"),
        "n",
    )


@query(
    "text_functions",
    "F8 F9 F11 F12 F14 F21",
    """
SELECT p_type, p_brand, n, CASE WHEN p_name LIKE '%ring%' THEN 'quantity' ELSE 'cost' END AS kind,
  CASE WHEN p_name LIKE '%ring%' THEN NULL ELSE 'NTD' END AS currency, p_brand || '_' || p_type AS label,
  'ucg_' || CASE p_type WHEN 'PROMO' THEN 'other' WHEN 'SMALL' THEN 'mat' ELSE 'x' END AS grp,
  'Predict' || upper(split_part(p_name, ' ', 1)) AS predicted
FROM (SELECT p_type, p_brand, p_name, count(*) AS n FROM part GROUP BY ALL)
""",
)
def text_functions(d: Domain) -> DataFrame:
    rows = d.table("part").groupBy("p_type", "p_brand", "p_name").agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("p_name").contains("ring"), "quantity").otherwise("cost")
    code = F.when(F.col("p_type") == "PROMO", "oc_1").when(F.col("p_type") == "SMALL", "mc_2").otherwise("x_3")
    return rows.select(
        "p_type",
        "p_brand",
        "n",
        kind.alias("kind"),
        _currency(kind).alias("currency"),
        F.concat_ws("_", "p_brand", "p_type").alias("label"),
        level0(code).alias("grp"),
        F.concat(F.lit("Predict"), F.upper(F.split("p_name", " ").getItem(0))).alias("predicted"),
    )


@query(
    "number_text",
    "F19 C12",
    """
SELECT l_orderkey, l_partkey, l_linenumber, x, printf('%.2f', x) AS two, printf('%.2f', -y) AS minus_two,
  CAST(CAST(round_even(y, 0) AS BIGINT) AS VARCHAR) AS whole, CAST(CAST(round_even(x / 1000, 0) AS BIGINT) AS VARCHAR) AS k
FROM (SELECT *, l_extendedprice * l_tax AS x, l_quantity * l_discount * CAST(12.5 AS DOUBLE) + CAST(0.125 AS DOUBLE) AS y FROM lineitem)
""",
)
def number_text(d: Domain) -> DataFrame:
    x = F.col("l_extendedprice") * F.col("l_tax")
    y = F.col("l_quantity") * F.col("l_discount") * 12.5 + 0.125
    return d.table("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        x.alias("x"),
        fixed2(x).alias("two"),
        fixed2(-y).alias("minus_two"),
        whole(y).alias("whole"),
        thousands(x).alias("k"),
    )


define(
    "pairs",
    """
SELECT product, ln, type, sum(cents) FILTER (disc > 0.09 AND q > 40) AS a, sum(q) FILTER (tax > 0.07 AND q > 45) AS b0,
  count(*) AS n FROM lines GROUP BY ALL
""",
)


@query(
    "ratio_rules",
    "C6 C7 C8 C9 C10 F16 F17 P18 P19 P20 P21",
    """
SELECT product, ln, type, coalesce(a, 0) AS a0, b, CASE WHEN b > 0 THEN a / b END AS guarded,
  CASE WHEN b = 0 THEN CASE WHEN a > 0 THEN CAST('inf' AS DOUBLE) WHEN a < 0 THEN CAST('-inf' AS DOUBLE) END ELSE a / b END AS ieee,
  CASE WHEN b <> 0 THEN a / b END AS cleaned, coalesce(a > 1000000, false) AS large,
  CASE WHEN a IS NOT NULL THEN CASE WHEN a / 9000000 > 1 THEN 1 ELSE a / 9000000 END END AS clamped,
  CASE WHEN a IS NOT NULL THEN CASE WHEN b > a THEN b ELSE a END END AS larger,
  (a IS NOT NULL AND b IS NOT NULL AND b <> 0) AS usable, CASE WHEN b > 0 THEN b END AS positive
FROM (SELECT *, CASE WHEN n % 7 = 0 THEN 0 ELSE b0 END AS b FROM pairs)
""",
)
def ratio_rules(d: Domain) -> DataFrame:
    late = (F.col("disc") > 0.09) & (F.col("q") > 40)
    big = (F.col("tax") > 0.07) & (F.col("q") > 45)
    rows = d.lines.groupBy("product", "ln", "type").agg(
        F.sum(F.when(late, F.col("cents"))).alias("a"),
        F.sum(F.when(big, F.col("q"))).alias("b0"),
        F.count(F.lit(1)).alias("n"),
    )
    rows = rows.withColumn("b", F.when(F.pmod("n", F.lit(7)) == 0, 0.0).otherwise(F.col("b0")))
    a, b = F.col("a"), F.col("b")
    ieee = div_ieee(a, b)
    return rows.select(
        "product", "ln", "type", F.coalesce(a, F.lit(0.0)).alias("a0"), "b",
        div_guarded(a, b).alias("guarded"),
        ieee.alias("ieee"),
        inf_to_null(nan_to_null(ieee)).alias("cleaned"),
        holds(a > 1000000).alias("large"),
        clamp01(a / 9000000.0).alias("clamped"),
        greatest_first(a, b).alias("larger"),
        finite(ieee).alias("usable"),
        positive_or_null(b).alias("positive"),
    )


@query(
    "month_filters",
    "P10 P11 P12 P13 F3",
    """
SELECT 'year' AS part, m, count(*) AS n FROM lines WHERE year(m) >= 1998 GROUP BY m
UNION ALL SELECT 'exact', m, count(*) FROM lines WHERE m = DATE '1997-03-01' GROUP BY m
UNION ALL SELECT 'history', m, count(*) FROM lines WHERE m <= DATE '1997-03-01' GROUP BY m
UNION ALL SELECT 'horizon', m, count(*) FROM lines WHERE m > DATE '1997-03-01' AND m <= DATE '1997-03-01' + 186 GROUP BY m
""",
)
def month_filters(d: Domain) -> DataFrame:
    m, day = F.col("m"), F.lit("1997-03-01").cast("date")
    parts = [
        ("year", dates.from_year(m, 1998)),
        ("exact", m == day),
        ("history", m <= day),
        ("horizon", dates.within_next_months(m, day)),
    ]
    frames = [
        d.cube.filter(cond).groupBy(F.lit(name).alias("part"), "m").agg(F.sum("n").alias("n"))
        for name, cond in parts
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- series ---------------------------------------------------------------------------------------

define(
    "months",
    "SELECT product, type, m, sum(cents) AS cents, sum(q) FILTER (ln > 3) AS late FROM lines GROUP BY ALL",
)


def months(d: Domain) -> DataFrame:
    return d.cube.groupBy("product", "type", "m").agg(
        F.sum("cents").alias("cents"), F.sum(F.when(F.col("ln") > 3, F.col("q"))).alias("late")
    )


@query(
    "moving_average",
    "W2 H2 T1 C11",
    """
SELECT product, type, m, late, CASE WHEN count(late) OVER w = 3 THEN avg(late) OVER w END AS ma
FROM months WINDOW w AS (PARTITION BY product, type ORDER BY m ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
ORDER BY product, type, m
""",
    shared=False,
)
def moving_average(d: Domain) -> DataFrame:
    ma = lagged_mean(F.col("late"), ["product", "type"], "m", 3)
    return months(d).select("product", "type", "m", "late", ma.alias("ma")).orderBy("product", "type", "m")


@query(
    "series_gate",
    "W4 A7 H6",
    """
SELECT part, kind, m, cents, n FROM (
  SELECT *, count(*) OVER (PARTITION BY part, kind) AS n FROM (
    SELECT l_partkey AS part, l_returnflag AS kind, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
      sum(floor(l_extendedprice * 100 + 0.5)) AS cents FROM lineitem GROUP BY ALL))
WHERE n >= 6
""",
    shared=False,
)
def series_gate(d: Domain) -> DataFrame:
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("double")
    month = F.trunc("l_shipdate", "month").alias("m")
    monthly = (
        d.table("lineitem")
        .groupBy(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("kind"), month)
        .agg(F.sum(cents).alias("cents"))
    )
    kept = long_enough(monthly, ["part", "kind"], 6)
    return kept.withColumn("n", series_length(["part", "kind"]))


@query(
    "next_month_rows",
    "W5 F6",
    """
SELECT product, type, m, cents, late FROM months
UNION ALL SELECT DISTINCT product, type, DATE '2002-01-01', NULL, NULL FROM months
""",
)
def next_month_rows(d: Domain) -> DataFrame:
    current = F.lit("2001-12-01").cast("date")
    return append_next_month(months(d), ["product", "type"], "m", current)


@query(
    "quantity_substitution",
    "W6 F14",
    """
SELECT product, m, actual, r3m, CASE WHEN m <= (SELECT max(m) FROM lines WHERE type = 'Actual')
  THEN actual ELSE r3m END AS quantity
FROM (SELECT product, m, sum(q) FILTER (type = 'Actual') AS actual, sum(q) FILTER (type = 'R3M') AS r3m FROM lines GROUP BY ALL)
""",
)
def quantity_substitution(d: Domain) -> DataFrame:
    t, q = F.col("type"), F.col("q")
    rows = d.cube.groupBy("product", "m").agg(
        F.sum(F.when(t == "Actual", q)).alias("actual"), F.sum(F.when(t == "R3M", q)).alias("r3m")
    )
    last = d.cube.filter(t == "Actual").agg(F.max("m"))
    rows = rows.withColumn("current", last.scalar())
    quantity = actual_until(F.col("m"), F.col("current"), F.col("actual"), F.col("r3m"))
    return rows.select("product", "m", "actual", "r3m", quantity.alias("quantity"))


