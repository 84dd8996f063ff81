"""Sums and means that don't depend on the order of additions."""

from __future__ import annotations

import math
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from costloom.functions.sums import exact_mean, exact_sum
from costloom.operators.reshape import pivot_mean, pivot_sum
from costloom.operators.rollup import four_level
from tests.helpers import rows

numbers = st.lists(st.none() | st.floats(-1e12, 1e12).filter(lambda x: x == 0 or abs(x) > 1e-3), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(numbers)
def test_sum_is_the_exact_one(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first()
    present = [v for v in values if v is not None]
    if not present:
        assert got[:] == (None, None)
        return
    exact = float(sum(map(Fraction, present)))
    assert math.isclose(got[0], exact, rel_tol=4e-16, abs_tol=1e-16)
    assert math.isclose(got[1], exact / len(present), rel_tol=1e-15, abs_tol=1e-16)


def test_one_value_stays_as_it_is(spark):
    values = [0.1, -0.1, 31.37, -4000.7, 2.0**61, 1e-5, 0.0, 5e15 + 1]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    assert rows(df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")), "k", "s") == sorted(
        [(k, pytest.approx(v, rel=1e-13) if v == 1e-5 else v) for k, v in enumerate(values)])


@pytest.fixture(scope="module")
def bookings(spark):
    """Amounts in cents over a rate of 31.37: no sum of these is a double."""
    i = F.col("id")
    return spark.range(60000).select(
        F.concat(F.lit("S"), (i % 3).cast("string")).alias("site"), F.concat(F.lit("T"), (i % 5).cast("string")).alias("product_type"),
        F.lit("g").alias("bg"), F.concat(F.lit("i"), (i % 4).cast("string")).alias("item"),
        ((F.xxhash64("id") % 10_000_000) / 100 / 31.37).alias("v"))


def spread(df, n):
    """The same rows in another order over n partitions."""
    return df.repartition(n, F.rand(n)).sortWithinPartitions(F.rand(n + 1))


def test_sums_are_equal_on_3_and_211_partitions(spark, bookings):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in (3, 211):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = spread(bookings, n)
        w = Window.partitionBy("site")
        results.append((
            rows(four_level(df.withColumn("m", F.col("v")), ["bg"], ["v"], ["m"])),
            rows(pivot_sum(df, ["site"], "item", "v", ["i0", "i1"])),
            rows(pivot_mean(df, ["site"], "item", "v", ["i0", "i1"])),
            rows(df.agg(exact_sum(F.col("v")), exact_mean(F.col("v")))),
            rows(df.select("site", exact_sum(F.col("v"), w).alias("s")).distinct()),
        ))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
    plain = {spread(bookings, n).agg(F.sum("v")).first()[0] for n in (3, 5, 211)}
    assert len(plain) > 1  # what the exact sums are for
