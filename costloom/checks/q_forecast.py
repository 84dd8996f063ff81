"""Forecasts per series and their write-back."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.checks.ctes import define
from costloom.checks.domain import CODES, Domain
from costloom.checks.q_cost import detail
from costloom.checks.q_performance import four_levels
from costloom.checks.registry import query
from costloom.operators import forecast
from costloom.operators.lookups import latest_actual_month
from costloom.plans import prediction
from costloom.session import settle

# --- the three models in SQL ------------------------------------------------------------------

_D = "CAST({} AS DOUBLE)"


def _solve(p: int) -> tuple[str, list[str]]:
    """Cramer's rule over centred sums c{i}{j}, 1 <= i <= j <= p, right side c0{i}."""
    if p == 1:
        return "c11", ["c01"]
    if p == 2:
        return "c11 * c22 - c12 * c12", ["c01 * c22 - c02 * c12", "c02 * c11 - c01 * c12"]
    k = {
        "00": "(c22 * c33 - c23 * c23)",
        "01": "(c13 * c23 - c12 * c33)",
        "02": "(c12 * c23 - c13 * c22)",
        "11": "(c11 * c33 - c13 * c13)",
        "12": "(c12 * c13 - c11 * c23)",
        "22": "(c11 * c22 - c12 * c12)",
    }
    det = f"c11 * {k['00']} + c12 * {k['01']} + c13 * {k['02']}"
    rows = [("00", "01", "02"), ("01", "11", "12"), ("02", "12", "22")]
    return det, [" + ".join(f"c0{i + 1} * {k[r[i]]}" for i in range(3)) for r in rows]


def _model(kind: str, p: int, keys: str) -> str:
    """One autoregressive model of order p per series."""
    pairs = list(combinations_with_replacement(range(p + 1), 2))
    here = f"{kind}{p} IS NOT NULL"
    sums = ", ".join(
        [f"count({kind}{p}) AS n"]
        + [f"sum({kind}{i} ORDER BY m) FILTER ({here}) AS s{i}" for i in range(p + 1)]
        + [f"sum({kind}{i} * {kind}{j} ORDER BY m) FILTER ({here}) AS q{i}{j}" for i, j in pairs]
    )
    centred = ", ".join(
        [f"CASE WHEN n > {p + 1} THEN q{i}{j} - s{i} * s{j} / n END AS c{i}{j}" for i, j in pairs]
        + [f"s{i} / nullif(n, 0) AS mean{i}" for i in range(p + 1)]
    )
    if p == 0:
        slopes, ok = "", "n > 1"
    else:
        det, tops = _solve(p)
        scale = " * ".join(f"c{i}{i}" for i in range(1, p + 1))
        ok = f"n > {p + 1} AND abs({det}) > CAST(1e-9 AS DOUBLE) * ({scale})"
        slopes = ", " + ", ".join(f"({t}) / ({det}) AS b{i + 1}" for i, t in enumerate(tops))
    rss = "c00" + "".join(f" - b{i} * c0{i}" for i in range(1, p + 1))
    icpt = "mean0" + "".join(f" - b{i} * mean{i}" for i in range(1, p + 1))
    bs = ", ".join(f"b{i} AS b{i}" if i <= p else f"CAST(0 AS DOUBLE) AS b{i}" for i in range(1, 4))
    return f"""
SELECT {keys}, ln(greatest(({rss}) / n, CAST(1e-12 AS DOUBLE))) + {2 * (p + 1)} / CAST(n AS DOUBLE) AS score,
  {p} AS ord, {1 if kind == "d" else 0} AS diff, {icpt} AS icpt, {bs}
FROM (SELECT *{slopes} FROM (SELECT {keys}, n, {centred} FROM (
  SELECT {keys}, {sums} FROM lagged GROUP BY {keys})) WHERE {ok})
"""


def predict_ctes(source: str, keys: list[str], month: str, y: str, current: str) -> str:
    """CTEs that end in `predicted`: keys, m, ma, es, arima."""
    k = ", ".join(keys)

    def same(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{x} = {b}.{x}" for x in keys)

    lags = ", ".join(f"lag(v, {i}) OVER w AS x{i}" for i in range(1, 5))
    diffs = ", ".join(f"x{i} - x{i + 1} AS d{i}" for i in range(4))
    models = " UNION ALL ".join(_model(kind, p, k) for kind in ("x", "d") for p in range(4))
    line = "icpt" + "".join(f" + CASE WHEN {i} < ord THEN b{i + 1} * {{{i}}} ELSE 0 END" for i in range(3))
    level = line.format("p0", "p1", "p2")
    step = line.format("(p0 - p1)", "(p1 - p2)", "(p2 - p3)")
    zero = "0 AS i, " + ", ".join(f"{_D.format(v)} AS {c}" for c, v in (("s", 0), ("c", 1), ("rr", 0), ("rc", 0), ("cc", 0)))

    def advance(table: str) -> str:
        cols = ", ".join("f." + x for x in keys)
        return f"""SELECT {cols}, alpha, f.i + 1, s + alpha * (v - s), (1 - alpha) * c,
    rr + (v - s) * (v - s), rc + (v - s) * c, cc + c * c
  FROM {table} f JOIN train t ON {same("f", "t")} AND t.i = f.i"""

    def least(table: str) -> str:
        cols = ", ".join("f." + x for x in keys)
        return f"""SELECT f.*, rr - rc * rc / cc AS sse, rc / cc AS start FROM {table} f JOIN counted n
  ON {same("f", "n")} AND f.i = n
  QUALIFY row_number() OVER (PARTITION BY {cols} ORDER BY rr - rc * rc / cc, alpha) = 1"""

    return f"""
cur AS (SELECT CAST({current} AS DATE) AS cur),
train AS (SELECT {k}, {month} AS m, CAST({y} AS DOUBLE) AS v,
  row_number() OVER (PARTITION BY {k} ORDER BY {month}) - 1 AS i FROM {source}, cur
  WHERE {month} <= cur AND {y} IS NOT NULL AND isfinite({y})),
counted AS (SELECT {k}, count(*) AS n FROM train GROUP BY ALL HAVING count(*) >= 2),
lagged AS (SELECT *, {diffs} FROM (SELECT {k}, m, v AS x0, {lags} FROM train WINDOW w AS (PARTITION BY {k} ORDER BY m))),
models AS ({models}),
ar AS (SELECT * FROM models QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY score, ord, diff) = 1),
fold AS (
  SELECT {k}, CAST(g AS DOUBLE) / 20 AS alpha, {zero} FROM counted, range(21) t(g)
  UNION ALL
  {advance("fold")}),
near AS ({least("fold")}),
fine AS (
  SELECT {k}, greatest(0, least(1, alpha + CAST(g AS DOUBLE) / 200)) AS alpha, {zero} FROM near, range(-9, 10) t(g)
  UNION ALL
  {advance("fine")}),
best AS ({least("fine")}),
levels AS (
  SELECT {k}, alpha, 0 AS i, start AS level FROM best
  UNION ALL
  SELECT {", ".join("l." + x for x in keys)}, alpha, l.i + 1, level + alpha * (v - level)
  FROM levels l JOIN train t ON {same("l", "t")} AND t.i = l.i),
spots AS (
  SELECT {k}, m, i FROM train SEMI JOIN counted USING ({k})
  UNION ALL SELECT {k}, CAST(cur + INTERVAL 1 MONTH AS DATE), n FROM counted, cur),
placed AS (SELECT s.*, {", ".join(f"t{j}.v AS p{j}" for j in range(4))} FROM spots s
  {" ".join(f"LEFT JOIN train t{j} ON {same('s', f't{j}')} AND t{j}.i = s.i - {j + 1}" for j in range(4))}),
predicted AS (SELECT {", ".join("z." + x for x in keys)}, z.m,
  CASE WHEN z.i >= 3 THEN (p2 + p1 + p0) / 3 END AS ma,
  CASE WHEN z.i >= 3 THEN level END AS es,
  CASE WHEN z.i >= 3 THEN CASE WHEN diff = 1 THEN p0 + ({step}) ELSE {level} END END AS arima
  FROM placed z JOIN levels l ON {same("z", "l")} AND l.i = z.i LEFT JOIN ar a ON {same("z", "a")})
"""


# --- models over monthly prices ------------------------------------------------------------------

define(
    "prices",
    "SELECT product, type, m, floor(sum(cents) / sum(q)) AS price FROM lines GROUP BY ALL",
)
_CUR = "(SELECT max(m) FROM prices WHERE type = 'Actual')"


def prices(d: Domain) -> DataFrame:
    return d.cube.groupBy("product", "type", "m").agg(
        F.floor(F.sum("cents") / F.sum("q")).cast("double").alias("price")
    )


def current_price_month(rows: DataFrame):
    return rows.filter(F.col("type") == "Actual").agg(F.max("m")).scalar()


@query(
    "forecast_models",
    "H2 H3 H4 H5 W2 W5 P19 J34 S3",
    "WITH RECURSIVE "
    + predict_ctes("prices", ["product", "type"], "m", "price", _CUR)
    + "SELECT * FROM predicted FULL JOIN (SELECT product, type, m FROM prices) USING (product, type, m)",
)
def forecast_models(d: Domain) -> DataFrame:
    rows = prices(d)
    return forecast.predict(rows, ["product", "type"], "m", "price", current_price_month(rows))


@query(
    "es_grid",
    "H3",
    "WITH RECURSIVE "
    + predict_ctes("prices", ["product", "type"], "m", "price", _CUR)
    + "SELECT product, type, CAST(n AS INT) AS n, alpha, start FROM best JOIN counted USING (product, type)",
)
def es_grid(d: Domain) -> DataFrame:
    rows = prices(d)
    hist = F.sort_array(F.collect_list(F.struct("m", "price")))
    series = (
        rows.withColumn("cur", current_price_month(rows))
        .filter(F.col("m") <= F.col("cur"))
        .groupBy("product", "type")
        .agg(hist.alias("hist"))
    )
    values = F.transform("hist", lambda r: r["price"])
    fitted = series.withColumn("es", forecast.best_smoothing(values))
    return fitted.select(
        "product", "type", F.size("hist").alias("n"), F.col("es.alpha").alias("alpha"),
        F.col("es.start").alias("start"),
    )


@query(
    "ar_model",
    "H4",
    "WITH RECURSIVE "
    + predict_ctes("prices", ["product", "type"], "m", "price", "DATE '2999-01-01'")
    + "SELECT product, type, ord AS order_used, diff AS differenced, icpt AS intercept, b1, b2, b3 FROM ar",
    shared=False,
)
def ar_model(d: Domain) -> DataFrame:
    fitted = forecast.ar_models(prices(d), ["product", "type"], "m", "price")
    return fitted.select(
        "product", "type", F.col("ar.order").alias("order_used"),
        F.col("ar.differenced").alias("differenced"), F.col("ar.intercept").alias("intercept"),
        "ar.b1", "ar.b2", "ar.b3",
    )


# --- unit costs of the cost detail ---------------------------------------------------------------

_SERIES = "bg, bu, site, product, cost_item_level1"
_LATEST = "(SELECT max(reporting_month) FROM ledger WHERE type = 'Actual')"


def _ieee(a: str, b: str) -> str:
    return (
        f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) END ELSE ({a}) / ({b}) END"
    )


define(
    "unit_series",
    f"""
SELECT * EXCLUDE (months), {_ieee("actual_total_cost", "actual_shipment")} AS actual_unit_cost_per_ship,
  {_ieee("actual_total_cost", "actual_production")} AS actual_unit_cost_per_prod
FROM (
  SELECT *, count(*) OVER (PARTITION BY {_SERIES}) AS months FROM (
    SELECT reporting_month, {_SERIES}, sum(coalesce(actual_total_cost, 0)) AS actual_total_cost,
      {", ".join(f"avg(coalesce({c}, 0)) AS {c}" for c in ("actual_shipment", "actual_production", "r3m_shipment", "r3m_production"))}
    FROM detail_usd WHERE reporting_month <= {_LATEST} + INTERVAL 1 MONTH
      AND NOT (site = 'WMI' AND cost_item_level1 = 'MOH_WEKS') AND NOT (site = 'WKS' AND cost_item_level1 = 'MOH_WMI')
    GROUP BY ALL))
WHERE months >= 6
""",
)


def unit_series(d: Domain) -> tuple[DataFrame, object]:
    current = latest_actual_month(d.ledger).scalar()
    return prediction.unit_cost_series(settle(detail(d, K.FOREIGN)), current), current


@query(
    "unit_cost_series",
    "H1 A5 A7 H6 P1 P12 P16 P18 W4 F6 F17",
    "SELECT * FROM unit_series",
)
def unit_cost_series(d: Domain) -> DataFrame:
    return unit_series(d)[0]


_KEYS = ["bg", "bu", "site", "product", "cost_item_level1", "standard"]
define(
    "unit_long",
    f"""
SELECT {_SERIES}, 'shipment' AS standard, reporting_month, actual_unit_cost_per_ship AS y FROM unit_series
UNION ALL SELECT {_SERIES}, 'production', reporting_month, actual_unit_cost_per_prod FROM unit_series
""",
)
_WIDE = f""", wide_predicted AS (SELECT {_SERIES}, m AS reporting_month, {", ".join(f"max({m}) FILTER (standard = '{s}') AS {m}_unit_cost_{s}" for s in ("shipment", "production") for m in ("ma", "es", "arima"))}
  FROM predicted GROUP BY ALL)"""


@query(
    "cost_prediction",
    "H1 H2 H3 H4 H5 H6 J34 P17 R3 W5 G17",
    "WITH RECURSIVE "
    + predict_ctes("unit_long", _KEYS, "reporting_month", "y", _LATEST)
    + _WIDE
    + f"""
SELECT x.*, 'USD' AS currency, fx AS fx_rate FROM (
  SELECT * FROM unit_series FULL JOIN wide_predicted USING ({_SERIES}, reporting_month)) x
LEFT JOIN fx_actual ON month = reporting_month
""",
)
def cost_prediction(d: Domain) -> DataFrame:
    series, current = unit_series(d)
    return prediction.tag_prediction(prediction.cost_prediction_detail(series, current), d.rates)


# --- write-back ------------------------------------------------------------------------------------

# Predictions are cut to these binary fractions on both sides, so that sums do not depend on their order.
_PARTS = {"ma": 64, "es": 16, "arima": 4}
_PREDICTED = [(f"{m}_unit_cost_{s}", by) for s in ("shipment", "production") for m, by in _PARTS.items()]

_ROLLUP_CTES = (
    f""", cut_predicted AS (SELECT reporting_month, {_SERIES}, actual_shipment, actual_production, r3m_shipment, r3m_production,
    {", ".join(f"floor(CASE WHEN isfinite({c}) THEN {c} END * {by} + CAST(0.3 AS DOUBLE)) / CAST({by} AS DOUBLE) AS {c}" for c, by in _PREDICTED)}
  FROM unit_series FULL JOIN wide_predicted USING ({_SERIES}, reporting_month)),
sized_predicted AS ("""
    + " UNION ALL ".join(
        f"SELECT r.reporting_month, r.bg, r.site, r.product, product_type, cost_cat_code, '{K.PREDICTED[m]}' AS type, "
        f"'{s}' AS standard, {m}_unit_cost_{s} * qty AS value, qty FROM ("
        f"SELECT *, CASE WHEN reporting_month <= {_LATEST} THEN actual_{s} ELSE r3m_{s} END AS qty FROM cut_predicted) r "
        "LEFT JOIN dim_project p ON p.product = r.product LEFT JOIN categories ON cost_cat_name = cost_item_level1"
        for s in ("shipment", "production")
        for m in _PARTS
    )
    + f"""),
predicted_wide AS (SELECT reporting_month, bg, site, product_type, product, type, standard, max(qty) AS qty,
    {", ".join(f"avg(value) FILTER (cost_cat_code = '{c}') AS {c}" for c in CODES)}
  FROM sized_predicted WHERE value IS NOT NULL AND cost_cat_code IS NOT NULL
  GROUP BY reporting_month, bg, site, product_type, product, type, standard)
"""
)


def cut_predictions(d: Domain) -> tuple[DataFrame, object]:
    """The predictions of all series, cut to binary fractions."""
    series, current = unit_series(d)
    predicted = prediction.cost_prediction_detail(series, current)
    finite = {c: F.when(F.abs(c) < float("inf"), F.col(c)) for c, _ in _PREDICTED}
    cuts = {c: F.floor(finite[c] * by + 0.3).cast("double") / float(by) for c, by in _PREDICTED}
    return predicted.withColumns(cuts), current


@query(
    "prediction_rollup",
    "G16 A13 A14 F21 J35 R3 R7 W6 A22 G17",
    "WITH RECURSIVE "
    + predict_ctes("unit_long", _KEYS, "reporting_month", "y", _LATEST)
    + _WIDE
    + _ROLLUP_CTES
    + f"""
SELECT bg, reporting_month, type, standard, cat_ind, {", ".join(CODES)}, r3m_shipment, r3m_production,
  'USD' AS currency, fx AS fx_rate
FROM (
  SELECT bg, reporting_month, type, standard, cat_ind,
    {", ".join(f"CASE WHEN sum(qty) > 0 THEN coalesce(sum({c}), 0) / sum(qty) END AS {c}" for c in CODES)},
    CASE WHEN standard = 'shipment' THEN coalesce(sum(qty), 0) END AS r3m_shipment,
    CASE WHEN standard = 'production' THEN coalesce(sum(qty), 0) END AS r3m_production
  FROM ({four_levels("predicted_wide", "bg, reporting_month, type, standard", ", ".join(CODES) + ", qty")})
  GROUP BY bg, reporting_month, type, standard, cat_ind)
LEFT JOIN fx_actual ON month = reporting_month
""",
)
def prediction_rollup(d: Domain) -> DataFrame:
    predicted, current = cut_predictions(d)
    return prediction.prediction_level1(
        predicted, d.dim_project, d.categories, d.rates, CODES, current
    )
