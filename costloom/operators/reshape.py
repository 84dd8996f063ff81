"""Unpivot and pivot. Pivots are conditional aggregates: one shuffle, combined before it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.missing import any_of, col, drop_null_keys, sum_where
from costloom.functions.sums import exact_mean


def melt(df: DataFrame, ids: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Every column that is no id becomes a row; missing values are kept."""
    rest = [c for c in df.columns if c not in ids]
    wide = df.select(*[col(c) for c in ids], *[col(c).cast("double").alias(c) for c in rest])
    return wide.unpivot([col(c) for c in ids], [col(c) for c in rest], name, value)


def melt_types(df: DataFrame, ids: list[str], measures: dict[str, str]) -> DataFrame:
    """One row per type with every measure family beside it.

    `measures` maps an output column to its input suffix: {"shipment": "shipment"} reads
    actual_shipment, budget_shipment and r3m_shipment. One pass serves all families.
    """
    rows = [
        F.struct(
            F.lit(t).alias("type"),
            *[col(f"{t.lower()}_{suffix}").alias(out) for out, suffix in measures.items()],
        )
        for t in K.TYPES
    ]
    wide = df.select(*[col(c) for c in ids], F.explode(F.array(*rows)).alias("_t"))
    return wide.select(*[col(c) for c in ids], "_t.*")


def pivot_sum(
    df: DataFrame, keys: list[str], over: str | Column, value: str, names: dict[str, str] | list[str]
) -> DataFrame:
    """Sum by key and category, one column per category: 0 for a group without values, null for
    an absent one. Rows of other categories form no group."""
    names = names if isinstance(names, dict) else {n: n for n in names}
    cat = col(over) if isinstance(over, str) else over
    kept = drop_null_keys(df, keys).filter(any_of(cat, list(names)))
    return kept.groupBy(*[col(k) for k in keys]).agg(
        *[sum_where(cat == n, col(value)).alias(out) for n, out in names.items()]
    )


def pivot_mean(
    df: DataFrame, keys: list[str], over: str, value: str, names: dict[str, str] | list[str],
    carry: list[Column] | None = None,
) -> DataFrame:
    """Mean by key and category over present values; keys without any value are dropped."""
    names = names if isinstance(names, dict) else {n: n for n in names}
    kept = drop_null_keys(df, keys).filter(any_of(col(over), list(names)) & col(value).isNotNull())
    means = [exact_mean(F.when(col(over) == n, col(value))).alias(out) for n, out in names.items()]
    return kept.groupBy(*[col(k) for k in keys]).agg(*means, *(carry or []))


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_rows(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and all the others (also where it is unknown)."""
    known = F.coalesce(cond, F.lit(False))
    return df.filter(known), df.filter(~known)


def split_no_level2(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without second-level items (both levels equal), and rows with them."""
    return split_rows(df, F.col("cost_item_level1") == F.col("cost_item_level2"))


def with_aggregate_level(df: DataFrame) -> DataFrame:
    """Second-level rows plus their subtotals, in one pass.

    A row with a second level counts under its own label and under 'aggregate'; a row without
    one counts under 'aggregate' only. Summing the result gives item rows and subtotal rows.
    """
    same = F.coalesce(F.col("cost_item_level1") == F.col("cost_item_level2"), F.lit(False))
    total = F.lit(K.AGGREGATE)
    own = F.col("cost_item_level2")
    labels = (
        F.when(same, F.array(total))
        .when(F.col("cost_item_level1").isNull(), F.array(own))
        .otherwise(F.array(own, total))
    )
    return df.withColumn("cost_item_level2", F.explode(labels))
