"""Joins, lookups, reshaping, rollups, rates and ids on small frames."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from costloom.operators import fx
from costloom.operators.ids import dense_ids
from costloom.operators.joins import (
    align,
    align_apart,
    align_unique,
    densify,
    duplicate_keys,
    missing_keys,
    rows_matching,
    without_pairs,
)
from costloom.operators.lookups import (
    app_item_of,
    forecast_versions,
    known_codes,
    last_wins,
    latest_by,
    latest_param,
    params_row,
)
from costloom.operators.reshape import (
    melt,
    melt_types,
    pivot_mean,
    pivot_sum,
    split_rows,
    stack,
    with_aggregate_level,
)
from costloom.operators.rollup import four_level, per_quantity
from costloom.operators.series import (
    append_next_month,
    lagged_mean,
    long_enough,
    rolling_mean,
)
from costloom.plans.alerting import max_future_mps
from costloom.plans.cost import ledger_measures, moh_times_production, quantities, without_foreign_moh
from costloom.plans.jobs import category_codes
from tests.helpers import day, one, rows


def test_align_matches_outer_merges(spark):
    a = [("x", 1, 1.0), ("x", 1, 2.0), (None, 2, 3.0), ("y", None, 4.0)]
    b = [("x", 1, 10.0), ("z", 3, 20.0), (None, 2, 30.0), (None, 2, 31.0)]
    c = [("x", 1, 100.0), ("y", None, 200.0)]
    frames, pandas = [], []
    for name, data in (("a", a), ("b", b), ("c", c)):
        frames.append(spark.createDataFrame(data, f"k string, m int, {name} double"))
        pandas.append(pd.DataFrame(data, columns=["k", "m", name]))
    want = pandas[0].merge(pandas[1], on=["k", "m"], how="outer").merge(pandas[2], on=["k", "m"], how="outer")

    def shown(records):
        return sorted(str(tuple(x if isinstance(x, str) else None if pd.isna(x) else float(x) for x in r)) for r in records)

    got = align(frames, ["k", "m"]).select("k", "m", "a", "b", "c")
    assert shown(map(tuple, got.collect())) == shown(want[["k", "m", "a", "b", "c"]].itertuples(index=False))


def test_align_unique(spark):
    a = spark.createDataFrame([("x", 1.0), (None, 2.0)], "k string, a double")
    b = spark.createDataFrame([("x", 3.0), ("y", None)], "k string, b double")
    got = align_unique([a, b], ["k"]).select("k", "a", "b")
    assert rows(got) == [("x", 1.0, 3.0), ("y", None, None), (None, 2.0, None)]
    twice = b.unionByName(b)
    with pytest.raises(Exception, match="repeats a key"):
        align_unique([a, twice], ["k"]).collect()


def test_densify_keeps_both_sides(spark):
    entities = spark.createDataFrame([("g", "p1"), ("g", "p2"), ("h", "p3"), (None, "p4")], "bg string, product string")
    items = spark.createDataFrame([("g", "i1"), ("g", "i2"), ("k", "i3"), (None, "i4")], "bg string, item string")
    want = [("g", "p1", "i1"), ("g", "p1", "i2"), ("g", "p2", "i1"), ("g", "p2", "i2"), ("h", "p3", None),
            ("k", None, "i3"), (None, "p4", "i4")]
    for salts in (1, 7):
        got = rows(densify(entities, items, salts).select("bg", "product", "item"))
        assert sorted(map(str, got)) == sorted(map(str, want))
    with pytest.raises(ValueError):
        densify(entities, items.drop("bg"))


def test_filters(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), ("b", None)], "l string, r string")
    assert len(rows(without_pairs(df, "l", "r", [("a", "x")]))) == 3
    assert rows(rows_matching(df, {"l": "a", "r": "y"})) == [("a", "y")]
    yes, no = split_rows(df, F.col("l") == "a")
    assert (yes.count(), no.count()) == (2, 2)
    assert rows(duplicate_keys(df, ["l"])) == [("a", 2)]


def test_latest_by(spark):
    data = [("a", 1, "20180101", "old"), ("a", 1, "20180201", "new"), ("b", 1, "20180101", "x"),
            ("b", 1, None, "missing is last"), (None, 1, "20180101", "no group")]
    df = spark.createDataFrame(data, "k string, p int, version string, note string")
    assert rows(latest_by(df, ["k", "p"], "version"), "k", "note") == [("a", "new"), ("b", "missing is last")]
    params = spark.createDataFrame(
        [("t", 1.0, day("2018-01-01")), ("t", 2.0, day("2019-01-01")), ("u", 5.0, day("2017-01-01"))],
        "param string, value double, date date")
    assert rows(latest_param(params), "param", "value") == [("t", 2.0), ("u", 5.0)]
    assert one(spark, params_row(params, ["t", "u"])).asDict() == {"t": 2.0, "u": 5.0}


def test_dictionary_lookup(spark):
    merge_map = spark.createDataFrame([("i", "a"), ("i", "b"), ("j", "c")], "accounting_item_desc string, app_item string")
    assert rows(last_wins(merge_map, "accounting_item_desc", "app_item")) == [("i", "b"), ("j", "c")]
    ledger = spark.createDataFrame([("i",), ("z",), (None,)], "line_item string")
    assert sorted(map(str, rows(app_item_of(ledger, merge_map), "line_item", "app_item"))) == sorted(
        map(str, [("i", "b"), ("z", None), (None, None)]))


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "cost_cat_code string")
    assert category_codes(df) == ["a", "b"]


def test_pivots(spark):
    data = [("k", "x", None), ("k", "x", None), ("k", "y", 2.0), ("k", "y", 4.0), ("m", "w", 9.0), (None, "x", 1.0)]
    df = spark.createDataFrame(data, "k string, c string, v double")
    # 0 for a group without values, null for an absent one, no row for other categories
    assert rows(pivot_sum(df, ["k"], "c", "v", ["x", "y", "z"])) == [("k", 0.0, 6.0, None)]
    assert rows(pivot_mean(df, ["k"], "c", "v", ["x", "y"])) == [("k", None, 3.0)]


def test_melt_and_back(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 5.0, 7.0)], "id int, `a.b (c)` double, d double")
    long = melt(df, ["id"])
    assert len(rows(long)) == 4
    back = pivot_mean(long, ["id"], "variable", "value", {"a.b (c)": "x", "d": "y"})
    assert rows(back) == [(1, 2.0, None), (2, 5.0, 7.0)]


def test_melt_types(spark):
    df = spark.createDataFrame([("p", 1.0, 2.0, 3.0)], "p string, actual_s double, budget_s double, r3m_s double")
    assert rows(melt_types(df, ["p"], {"q": "s"})) == [("p", "Actual", 1.0), ("p", "Budget", 2.0), ("p", "R3M", 3.0)]


def test_aggregate_level(spark):
    data = [("a", "a", 1.0), ("b", "x", 2.0), ("b", "y", 3.0), (None, "z", 4.0), ("c", None, 5.0)]
    df = spark.createDataFrame(data, "cost_item_level1 string, cost_item_level2 string, v double")
    got = with_aggregate_level(df).groupBy("cost_item_level2").agg(F.sum("v").alias("v"))
    assert sorted(map(str, rows(got))) == sorted(map(str, [("aggregate", 11.0), ("x", 2.0), ("y", 3.0), ("z", 4.0), (None, 5.0)]))


def test_stack(spark):
    a = spark.createDataFrame([(1, "a")], "n int, s string")
    b = spark.createDataFrame([(2.0, 3)], "d double, n int")
    assert sorted(map(str, rows(stack(a, b).select("n", "s", "d")))) == sorted(map(str, [(1, "a", None), (3, None, 2.0)]))


def test_four_level(spark):
    data = [("g", "S01", "T1", 1.0, 2.0, 1.0), ("g", "S01", "T2", 2.0, 3.0, None), ("g", "S02", "T1", 4.0, None, 3.0),
            ("g", None, "T1", 8.0, 1.0, 5.0), (None, "S01", "T1", 99.0, 1.0, 1.0), ("g", "S03", "T3", None, 0.0, None)]
    df = spark.createDataFrame(data, "bg string, site string, product_type string, c double, q double, m double")
    got = four_level(df, ["bg"], ["c", "q"], means=["m"], post=lambda s: per_quantity(s, ["c"], "q"))
    by = {r.cat_ind: (r.c, r.q, r.m) for r in got.collect()}
    assert by["ALL"] == (15.0 / 6.0, 6.0, 3.0)
    assert by["S01"] == (0.6, 5.0, 1.0)
    assert by["S02"] == (None, 0.0, 3.0)
    assert by["T1"] == (13.0 / 3.0, 3.0, 3.0)
    assert by["S01_T2"] == (2.0 / 3.0, 3.0, None)
    assert by["S03_T3"] == (None, 0.0, None)
    assert len(by) == 1 + 3 + 3 + 4


def test_rollup_levels_agree(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "S01").otherwise(F.concat(F.lit("S0"), (F.col("id") % 7).cast("string"))).alias("site"),
        F.concat(F.lit("T"), (F.col("id") % 5).cast("string")).alias("product_type"),
        (F.col("id") % 11).cast("double").alias("v"), F.lit("g").alias("bg"))
    got = {r.cat_ind: r.v for r in four_level(df, ["bg"], ["v"]).collect()}
    total = got["ALL"]
    assert total == sum(v for k, v in got.items() if k[0] == "S" and "_" not in k)
    assert total == sum(v for k, v in got.items() if k[0] == "T")
    assert total == sum(v for k, v in got.items() if "_" in k)


def test_rates(spark):
    rate = "Month date, `From` string, `To` string, FX double"
    actual = spark.createDataFrame([(day("2018-12-01"), "USD", "NTD", 30.0), (day("2018-12-01"), "EUR", "NTD", 35.0)], rate)
    budget = spark.createDataFrame([(2018, "USD", "NTD", 31.0)], "Year int, `From` string, `To` string, FX double")
    r3m = spark.createDataFrame([(day("2019-01-01"), "USD", "NTD", 32.0), (day("2018-11-01"), "USD", "NTD", 33.0)], rate)
    rates = fx.rate_dimension(actual, budget, r3m)
    raw = spark.createDataFrame([("2018/12", "20181005"), ("2018/12", "20180905"), ("2019/02", "20181215")], "Period string, Version string")
    versions = forecast_versions(raw)
    assert rows(versions) == [(day("2018-12-01"), day("2018-10-05")), (day("2019-02-01"), day("2018-12-15"))]
    df = spark.createDataFrame(
        [("Actual", day("2018-12-01")), ("Budget", day("2018-12-01")), ("R3M", day("2018-12-01")), ("R3M", day("2019-02-01")),
         ("Actual", day("2019-01-01"))], "type string, reporting_month date")
    got = fx.tag_local(df, rates, versions)
    assert sorted(map(str, rows(got, "type", "fx_rate", "currency"))) == sorted(map(str, [
        ("Actual", 30.0, "NTD"), ("Budget", 31.0, "NTD"), ("R3M", 33.0, "NTD"), ("R3M", 32.0, "NTD"), ("Actual", None, "NTD")]))
    # a December version takes the January rate
    one_type = df.filter("type = 'R3M'").withColumn("Version", F.lit(day("2018-12-15")))
    assert rows(fx.add_rate(one_type, rates, policy="R3M"), "FX") == [(32.0,), (32.0,)]
    money = spark.createDataFrame([(60.0, 30.0), (1.0, 0.0), (1.0, None)], "v double, FX double")
    assert sorted(map(str, rows(fx.local_to_foreign(money, ["v"]), "v"))) == ["(2.0,)", "(None,)", "(None,)"]


def test_series(spark):
    data = [("a", day(f"2018-0{i}-01"), v) for i, v in enumerate([1.0, 3.0, None, 5.0, 7.0, 9.0], 1)] + [("b", day("2018-01-01"), 1.0)]
    df = spark.createDataFrame(data, "k string, m date, v double")
    v = F.col("v")
    got = df.select("k", "m", rolling_mean(v, ["k"], "m", 2).alias("two"), lagged_mean(v, ["k"], "m", 3).alias("three"))
    a = [(r.two, r.three) for r in got.filter("k = 'a'").orderBy("m").collect()]
    assert a == [(None, None), (2.0, None), (None, None), (None, None), (6.0, None), (8.0, None)]
    assert {r.k for r in long_enough(df, ["k"], 6).collect()} == {"a"}
    new = append_next_month(df, ["k"], "m", F.lit(day("2018-06-01")))
    assert rows(new.filter("m = date'2018-07-01'"), "k", "v") == [("a", None), ("b", None)]


def test_future_maximum(spark):
    data = [("p", day("2018-01-01"), 99.0), ("p", day("2018-02-01"), 5.0), ("p", day("2018-07-01"), 7.0), ("p", day("2018-08-01"), 88.0), ("q", day("2018-03-01"), None)]
    df = spark.createDataFrame(data, "product string, reporting_month date, mps double")
    assert rows(max_future_mps(df, F.lit(day("2018-01-01")))) == [("p", 7.0), ("q", None)]


def test_cost_rules(spark):
    cols = "site string, cost_item_level1 string, " + ", ".join(f"{t}_{m} double" for t in ("actual", "budget", "r3m") for m in ("total_cost", "production"))
    data = [("WMI", "MOH_WMI", 2.0, 3.0, 2.0, None, None, 3.0), ("WMI", "MOH_WEKS", 2.0, 3.0, 2.0, 3.0, 2.0, 3.0), (None, "SGA", 2.0, 3.0, 2.0, 3.0, 2.0, 3.0)]
    df = without_foreign_moh(moh_times_production(spark.createDataFrame(data, cols)))
    got = {r.cost_item_level1: (r.actual_total_cost, r.budget_total_cost, r.r3m_total_cost) for r in df.collect()}
    assert got == {"MOH_WMI": (6.0, None, None), "MOH_WEKS": (None, None, None), "SGA": (2.0, 2.0, 2.0)}
    ledger = spark.createDataFrame(
        [("p", "Actual", "Invoice quantity", 2.0), ("p", "Actual", "Invoice quantity", 4.0), ("p", "Budget", "Production quantity", 5.0), ("q", "R3M", "Invoice quantity", None)],
        "product string, type string, line_item string, value double").withColumn("reporting_month", F.lit(day("2018-01-01")))
    q = quantities(ledger_measures(ledger)).select("product", "actual_shipment", "actual_production", "budget_production", "r3m_shipment")
    assert rows(q) == [("p", 3.0, None, 5.0, None)]


def test_dense_ids(spark):
    df = spark.range(0, 10000, 1, 13).select((F.col("id") * 7919 % 10007).alias("v"), (F.col("id") % 2).alias("w"))
    got = dense_ids(df, ["w", "v"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(10000))
    assert [(r.w, r.v) for r in got] == sorted((r.w, r.v) for r in got)
    assert dense_ids(df.filter("v < 0"), ["v"], "n").count() == 0


def test_category_codes_are_bounded(spark):
    codes = spark.range(5).selectExpr("concat('c', id) AS cost_cat_code").union(spark.sql("SELECT NULL"))
    assert category_codes(codes) == ["c0", "c1", "c2", "c3", "c4"]
    with pytest.raises(ValueError):
        category_codes(codes, most=4)


def test_codes_outside_the_table_stop_the_job(spark):
    categories = spark.createDataFrame([("a", "x"), (None, "y"), ("b", "z")], "cost_cat_code string, cost_cat_name string")
    assert rows(known_codes(categories, ["a", "b", "c"]), "cost_cat_code") == [("a",), ("b",), (None,)]
    with pytest.raises(Exception, match="without a column: b"):
        known_codes(categories, ["a"]).collect()


def test_missing_keys_stay_and_match_nothing(spark):
    """A thousand rows without a key in each of six feeds give six thousand rows, not 10^18."""
    feeds = []
    for i in range(6):
        lost = spark.range(1000).select(F.lit(None).cast("string").alias("k"), F.when(F.col("id") % 2 == 0, 1).alias("m"),
                                        F.col("id").alias(f"v{i}"))
        known = spark.createDataFrame([("a", 1, 10 * i), (f"b{i}", 2, i)], f"k string, m int, v{i} long")
        feeds.append(lost.unionByName(known))
    for unique in (False, True):
        out = align_apart(feeds, ["k", "m"], unique)
        assert out.count() == 6 * 1000 + 1 + 6
        assert out.filter("k = 'a'").first()[2:] == tuple(10 * i for i in range(6))
        values = [F.col(f"v{i}") for i in range(6)]
        filled = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
        assert out.filter("k is null").filter(filled != 1).isEmpty()
    assert rows(missing_keys({"x": feeds[0], "y": feeds[1].filter("k = 'a'")}, ["k", "m"])) == [("x", 1000), ("y", 0)]
