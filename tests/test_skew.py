"""Results stay whole when one key holds a third of the rows, and properties on random frames."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costloom.operators.ids import dense_ids
from costloom.operators.joins import align, densify, hot_keys
from costloom.operators.lookups import latest_by
from costloom.operators.reshape import melt, pivot_sum
from costloom.operators.rollup import four_level

N = 30000
QUIET = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def hot(spark):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    return spark.range(0, N, 1, 12).withColumn("k", key)


def test_densify_hot_group(spark):
    entities = hot(spark).select(F.lit("g").alias("bg"), F.col("id").alias("product"))
    items = spark.range(5).select(F.lit("g").alias("bg"), F.col("id").alias("item"))
    out = densify(entities, items)
    assert out.count() == 5 * N
    assert out.select("product", "item").distinct().count() == 5 * N


def test_densify_spreads_the_hot_group(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        entities = hot(spark).select(F.lit("g").alias("bg"), F.col("id").alias("product"))
        items = spark.range(2).select(F.lit("g").alias("bg"), F.col("id").alias("item"))
        out = densify(entities, items).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in out) < 2 * 2 * N / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_hot_keys_are_salted(spark):
    """Half of the rows in one group: its items are copied for its salts, those of the other groups once."""
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 499).cast("string")))
    entities = spark.range(0, N, 1, 12).select(key.alias("bg"), F.col("id").alias("product"))
    items = entities.select("bg").distinct().crossJoin(spark.range(2).withColumnRenamed("id", "item"))
    hot = hot_keys(entities, ["bg"], 8).collect()
    assert [r["_copies"] for r in hot] == [16]  # half of the rows are four average partitions of eight
    uniform = spark.range(0, N, 1, 12).select((F.col("id") % 500).alias("bg"))
    assert hot_keys(uniform, ["bg"], 8).isEmpty()
    assert hot_keys(entities.limit(0), ["bg"], 8).isEmpty()
    out = densify(entities, items)
    assert out.count() == 2 * N and out.distinct().count() == 2 * N


def test_latest_of_a_hot_key(spark):
    out = {r.k: r.id for r in latest_by(hot(spark).withColumn("v", F.col("id")), ["k"], "v").collect()}
    assert out["hot"] == N - 3 and len(out) == 998


def test_ids_with_one_order_key(spark):
    df = hot(spark).select("k", "id")
    out = dense_ids(df, ["k"], "n")
    assert out.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (0, N - 1, N)
    first = out.filter("k = 'hot'").agg(F.min("n"), F.max("n")).first()
    assert first[1] - first[0] == N // 3 - 1


def test_align_with_a_hot_missing_key(spark):
    one = hot(spark).select(F.when(F.col("k") != "hot", F.col("id")).alias("k"), F.col("id").alias("a"))
    two = spark.createDataFrame([(None, 1), (5, 2)], "k long, b int")
    out = align([one, two], ["k"])
    assert out.count() == N + (0 if 5 % 3 else 1)
    assert out.filter("k is null and b = 1").count() == N // 3


cells = st.lists(
    st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", None]), st.integers(-9, 9) | st.none()),
    min_size=1, max_size=12)


@QUIET
@given(cells)
def test_rollup_adds_up(spark, data):
    df = spark.createDataFrame(
        [("g", f"S{s}", t, None if v is None else float(v)) for s, t, v in data],
        "bg string, site string, product_type string, v double")
    got = {r.cat_ind: r.v for r in four_level(df, ["bg"], ["v"]).collect()}
    assert got["ALL"] == sum(v for *_, v in data if v is not None)
    assert got["ALL"] == sum(v for k, v in got.items() if k in ("Sa", "Sb"))


@QUIET
@given(cells)
def test_pivot_and_melt_agree(spark, data):
    df = spark.createDataFrame(
        [(k, c, None if v is None else float(v)) for k, c, v in data], "k string, c string, v double")
    got = {(r.k, r.variable): r.value for r in melt(pivot_sum(df, ["k"], "c", "v", ["x", "y"]), ["k"]).collect()}
    want = {}
    for k, c, v in data:
        if c is not None:
            want[(k, c)] = want.get((k, c), 0.0) + (v or 0.0)
    assert {k: v for k, v in got.items() if v is not None} == want


def test_month_windows_are_bounded_by_the_calendar(spark):
    """Series operators get one row per month, whatever the number of input rows."""
    from costloom.plans import prediction

    detail = spark.range(20000).select(
        F.add_months(F.lit(dt.date(2018, 1, 1)), F.floor(F.col("id") / 7 % 12).cast("int")).alias("reporting_month"),
        F.lit("SDBG").alias("bg"), F.lit("").alias("bu"), F.lit("S01").alias("site"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("product"), F.lit("SGA").alias("cost_item_level1"),
        F.lit(1.0).alias("actual_total_cost"),
        *[F.lit(2.0).alias(c) for c in ("actual_shipment", "actual_production", "r3m_shipment", "r3m_production")])
    series = prediction.unit_cost_series(detail, F.lit(dt.date(2018, 12, 1)))
    assert series.groupBy("product").count().agg(F.max("count")).first()[0] <= 12
    assert series.agg(F.sum("actual_total_cost")).first()[0] == 20000.0
