"""Unit-cost predictions and their write-back to the cost overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import next_month
from costloom.functions.missing import col, div_ieee, drop_null_keys, fill_zero
from costloom.functions.sums import exact_mean, exact_sum
from costloom.operators import forecast, fx
from costloom.operators.joins import without_pairs
from costloom.operators.lookups import cost_category_code, product_type
from costloom.operators.reshape import pivot_mean
from costloom.operators.rollup import four_level
from costloom.operators.series import actual_until, long_enough, spread_series

SERIES = ["bg", "bu", "site", "product", "cost_item_level1"]
MODELS = {"ma": "ma", "es": "es", "arima": "arima"}
STANDARDS = ["shipment", "production"]


def unit_cost_series(detail: DataFrame, current: Column, min_rows: int = 6) -> DataFrame:
    """Monthly cost and unit cost per series, for series with enough months.

    Rows up to the month after the current one, one per month and first-level item; missing
    numbers count as 0.
    """
    past = detail.filter(F.col("reporting_month") <= next_month(current))
    own = without_pairs(past, "site", "cost_item_level1", K.MOH_NOT_AT_SITE)
    means = ["actual_shipment", "actual_production", "r3m_shipment", "r3m_production"]
    slim = fill_zero(own.select("reporting_month", *SERIES, "actual_total_cost", *means))
    monthly = drop_null_keys(slim, ["reporting_month"]).groupBy("reporting_month", *SERIES).agg(
        exact_sum(F.col("actual_total_cost")).alias("actual_total_cost"),
        *[exact_mean(F.col(m)).alias(m) for m in means],
    )
    priced = monthly.withColumns(
        {
            "actual_unit_cost_per_ship": div_ieee(
                F.col("actual_total_cost"), F.col("actual_shipment")
            ),
            "actual_unit_cost_per_prod": div_ieee(
                F.col("actual_total_cost"), F.col("actual_production")
            ),
        }
    )
    return long_enough(spread_series(priced, SERIES), SERIES, min_rows)


def cost_prediction_detail(series: DataFrame, current: Column) -> DataFrame:
    """The series with three predictions per standard (app.cost_prediction_dtl).

    Both standards are predicted in one pass over the series partitions. The predicted month is
    kept also for series that hold no row for it.
    """
    y_of = {"shipment": "actual_unit_cost_per_ship", "production": "actual_unit_cost_per_prod"}
    options = [F.struct(F.lit(s).alias("standard"), col(y).alias("y")) for s, y in y_of.items()]
    keep = [c for c in series.columns if c not in SERIES and c != "reporting_month"]
    long = series.withColumn("_o", F.explode(F.array(*options))).select(
        *SERIES, "reporting_month", *keep, "_o.*"
    )
    predicted = forecast.predict(
        long, [*SERIES, "standard"], "reporting_month", "y", current, carry=keep, spread=False
    )
    return predicted.groupBy(*SERIES, "reporting_month").agg(
        *[F.max(c).alias(c) for c in keep],
        *[
            F.max(F.when(F.col("standard") == s, col(m))).alias(f"{out}_unit_cost_{s}")
            for s in STANDARDS
            for m, out in MODELS.items()
        ],
    )


def prediction_level1(
    predicted: DataFrame,
    dim_project: DataFrame,
    categories: DataFrame,
    rates: DataFrame,
    codes: list[str],
    current: Column,
) -> DataFrame:
    """Predicted unit cost by category at four levels, in the shape of app.cost_overview_level1.

    Predicted unit costs are multiplied by quantities (actual ones up to the current month,
    planned ones after it), averaged by category, summed and divided by the summed quantity.
    Both standards go through one pivot and one rollup.
    """
    typed = cost_category_code(product_type(predicted, dim_project), categories)
    sized = typed.withColumns(
        {
            f"r3m_{s}": actual_until(
                F.col("reporting_month"), current, F.col(f"actual_{s}"), F.col(f"r3m_{s}")
            )
            for s in STANDARDS
        }
    )
    rows = [
        F.struct(
            F.lit(K.PREDICTED[m]).alias("type"),
            F.lit(s).alias("standard"),
            (F.col(f"{m}_unit_cost_{s}") * F.col(f"r3m_{s}")).alias("value"),
            F.col(f"r3m_{s}").alias("quantity"),
        )
        for s in STANDARDS
        for m in K.PREDICTED
    ]
    ids = ["reporting_month", "bg", "site", "product_type", "product"]
    long = sized.select(*ids, "cost_cat_code", F.explode(F.array(*rows)).alias("_p")).select(
        *ids, "cost_cat_code", "_p.*"
    )
    wide = pivot_mean(
        long, [*ids, "type", "standard"], "cost_cat_code", "value", codes,
        [F.max("quantity").alias("quantity")],
    )
    rolled = four_level(wide, ["bg", "reporting_month", "type", "standard"], [*codes, "quantity"])
    units = rolled.withColumns(
        {c: F.when(F.col("quantity") > 0, col(c) / F.col("quantity")) for c in codes}
    ).withColumns(
        {f"r3m_{s}": F.when(F.col("standard") == s, F.col("quantity")) for s in STANDARDS}
    )
    return fx.tag_foreign(units.drop("quantity"), rates)


def tag_prediction(predicted: DataFrame, rates: DataFrame) -> DataFrame:
    return fx.tag_foreign(predicted, rates)
