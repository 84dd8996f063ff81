"""Intermediate tables in the folder that driver and executors share, and small column helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many rows of two or three numbers is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a folder in the warehouse where it is unset.

    On a cluster a warehouse on the driver's own disk is no place that executors share, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
        if named.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse gives {named}")
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: work done once, and a short lineage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcasting if it has few rows; otherwise Spark shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def columns(df: DataFrame) -> list[Column]:
    """All columns of `df`, also those with dots or blanks in their names."""
    return [df["`" + c.replace("`", "``") + "`"] for c in df.columns]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, also where `body` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
