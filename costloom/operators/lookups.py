"""Dimension lookups, latest-row selection and parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import parse_month, parse_version
from costloom.functions.missing import col, drop_null_keys
from costloom.operators.joins import left_lookup


def latest_by(df: DataFrame, keys: list[str], order: str, ties: list[str] | None = None) -> DataFrame:
    """One row per key: the last one in the given order, a missing order value coming last.

    Written as an aggregate, not a window, so that each task sends one candidate per key and a
    key with very many rows is no hot task. Keys that are missing form no group.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(
        col(order).isNull().alias("missing"),
        col(order).alias("order"),
        *[col(t).alias(f"tie{i}") for i, t in enumerate(ties or [])],
    )
    best = F.max_by(F.struct(*[col(c).alias(f"v{i}") for i, c in enumerate(rest)]), rank)
    picked = drop_null_keys(df, keys).groupBy(*[col(k) for k in keys]).agg(best.alias("_row"))
    return picked.select(
        *[col(k) for k in keys], *[F.col(f"_row.v{i}").alias(c) for i, c in enumerate(rest)]
    ).select(*[col(c) for c in df.columns])


def last_wins(dim: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """A dimension reduced to one value per key; by default the largest value is kept."""
    rank = col(order) if order else col(value)
    return dim.groupBy(col(key)).agg(F.max_by(col(value), rank).alias(value))


def app_item_of(ledger: DataFrame, merge_map: DataFrame, out: str = "app_item") -> DataFrame:
    """Ledger with the reporting item of each line item (missing if the map has none)."""
    dim = last_wins(merge_map, "accounting_item_desc", "app_item")
    return left_lookup(ledger, dim, "line_item", "accounting_item_desc", {"app_item": out}, "app_item_of")


def variance_category(line_item: Column) -> Column:
    out = F.lit(None).cast("string")
    for item, category in K.VARIANCE_OF_ITEM.items():
        out = F.when(line_item == item, category).otherwise(out)
    return out


def site_of_product(df: DataFrame, project_info: DataFrame, key: str) -> DataFrame:
    return left_lookup(
        df,
        project_info,
        key,
        "Project name",
        {"AllieCode Name": "AllieCode Name", "Site": "Site", "Project name": "Project name"},
        "site_of_product",
    )


def model_code_of_product(df: DataFrame, project_info: DataFrame, key: str) -> DataFrame:
    return left_lookup(
        df,
        project_info,
        key,
        "Project name",
        {"AllieCode Name": "AllieCode Name", "Project name": "Project name"},
        "model_code_of_product",
    )


def item_description(df: DataFrame, items_map: DataFrame, key: str = "variable") -> DataFrame:
    """Standard line-item name and group of a raw column name."""
    return left_lookup(
        df, items_map, key, "variable", ["accounting_item_desc", "accounting_item_group"], "item_description"
    )


def item_code(df: DataFrame, codes: DataFrame) -> DataFrame:
    return left_lookup(
        df, codes, "accounting_item_desc", "accounting_item_desc", ["accounting_item_code"], "item_code"
    )


def project_status(df: DataFrame, dim_project: DataFrame, key: str = "product") -> DataFrame:
    return left_lookup(df, dim_project, key, "product", ["project_status"], "project_status")


def product_type(df: DataFrame, dim_project: DataFrame, key: str = "product") -> DataFrame:
    return left_lookup(df, dim_project, key, "product", ["product_type"], "product_type")


def cost_category_code(
    df: DataFrame, categories: DataFrame, key: str = "cost_item_level1", flag: bool = False
) -> DataFrame:
    """Category code of a cost item, with its non-adjustable flag if asked for."""
    take = ["cost_cat_code", "non_adj_flag"] if flag else ["cost_cat_code"]
    return left_lookup(df, categories, key, "cost_cat_name", take, "cost_category_code")


def line_item_short(df: DataFrame, control: DataFrame, key: str = "cost_item_level1") -> DataFrame:
    """Short name of a cost item. A list with several rows per item repeats the input row."""
    return left_lookup(
        df, control, key, "line_item", {"Frontnend_name level 1": "line_item_short"}, "line_item_short"
    )


def forecast_versions(r3m_pl: DataFrame) -> DataFrame:
    """Latest version date of each period in the rolling forecast: (period, version)."""
    parsed = r3m_pl.select(
        parse_month(F.col("Period")).alias("period"), parse_version(F.col("Version")).alias("version")
    )
    return drop_null_keys(parsed, ["period"]).groupBy("period").agg(F.max("version").alias("version"))


def with_forecast_version(df: DataFrame, versions: DataFrame, month: str = "reporting_month") -> DataFrame:
    """Left lookup of the forecast version of a month."""
    return left_lookup(df, versions, month, "period", ["version"], "with_forecast_version")


def latest_param(params: DataFrame) -> DataFrame:
    """Latest value of every parameter."""
    return latest_by(params.select("param", "value", "date"), ["param"], "date", ["value"])


def params_row(params: DataFrame, names: list[str]) -> Column:
    """The latest values of some parameters as one struct, read by a scalar subquery."""
    latest = latest_param(params.filter(F.col("param").isin(names)))
    one = latest.agg(
        F.struct(
            *[F.max(F.when(F.col("param") == n, F.col("value"))).alias(n) for n in names]
        ).alias("params")
    )
    return one.scalar()


def latest_actual_month(ledger: DataFrame) -> DataFrame:
    """Largest month with Actual rows, as a one-row frame."""
    return ledger.filter(F.col("type") == "Actual").agg(
        F.max("reporting_month").alias("latest_month")
    )


def known_codes(categories: DataFrame, codes: list[str]) -> DataFrame:
    """Categories whose codes are among the declared columns; another code stops the job that uses them."""
    code = F.col("cost_cat_code")
    wrong = F.concat(F.lit("cost category without a column: "), code)
    checked = F.when(code.isNull() | code.isin(codes), code).otherwise(F.raise_error(wrong).cast("string"))
    return categories.withColumn("cost_cat_code", checked)
