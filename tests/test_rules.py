"""Missing values, division, texts and dates."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from costloom.functions import dates
from costloom.functions import missing as M
from costloom.functions.text import fixed2, thousands, whole
from costloom.operators.health import closeness, reach, variance_score, weighted_score
from tests.helpers import close, day, one, rows

INF = float("inf")


def lit(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize(
    "a, b, ieee, guarded",
    [
        (1.0, 2.0, 0.5, 0.5),
        (1.0, 0.0, INF, None),
        (-1.0, 0.0, -INF, None),
        (0.0, 0.0, None, None),
        (4.0, -2.0, -2.0, None),
        (None, 2.0, None, None),
        (1.0, None, None, None),
        (None, 0.0, None, None),
    ],
)
def test_division(spark, a, b, ieee, guarded):
    assert one(spark, M.div_ieee(lit(a), lit(b))) == ieee
    assert one(spark, M.div_guarded(lit(a), lit(b))) == guarded


def test_clamp_and_friends(spark):
    assert [one(spark, M.clamp01(lit(x))) for x in (-1.0, 0.25, 3.0, None)] == [0.0, 0.25, 1.0, None]
    assert [one(spark, M.positive_or_null(lit(x))) for x in (-1.0, 0.0, 2.0, None)] == [None, None, 2.0, None]
    assert one(spark, M.greatest_first(lit(None), lit(2.0))) is None
    assert one(spark, M.greatest_first(lit(1.0), lit(None))) == 1.0
    assert one(spark, M.greatest_first(lit(1.0), lit(2.0))) == 2.0
    assert one(spark, M.holds(lit(None) > 1)) is False
    assert one(spark, M.total0(lit(None), lit(2.0))) == 2.0
    assert [one(spark, M.finite(lit(x))) for x in (1.0, INF, float("nan"), None)] == [True, False, False, False]


def test_sums_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), (None, 5.0)], "k string, v double")
    got = M.drop_null_keys(df, ["k"]).groupBy("k").agg(M.sum0(F.col("v")).alias("s"))
    assert rows(got, "k", "s") == [("a", 0.0), ("b", 1.0)]


def test_frames(spark):
    df = spark.createDataFrame([("a", INF, 1), (None, float("nan"), None)], "k string, v double, n int")
    assert rows(M.inf_to_null_all(M.nan_to_null_all(df)), "v") == [(None,), (None,)]
    assert rows(M.fill_zero(df.withColumn("v", F.lit(None).cast("double")))) == [("", 0.0, 0), ("a", 0.0, 1)]


def test_fixed2_matches_binary_rounding(spark):
    rnd = random.Random(7)
    values = [0.0, 2.675, 0.125, 0.375, 1.005, 2.5, -0.125, -0.375, -0.001, 0.005, 0.015, 1e9 + 0.125, 99.995, 0.115]
    values += [rnd.randrange(-10**7, 10**7) / 1000 for _ in range(4000)]
    values += [rnd.randrange(-10**6, 10**6) / 8 / 2 ** rnd.randrange(6) for _ in range(2000)]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randrange(-4, 9) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", fixed2(F.col("v")).alias("t"), whole(F.col("v")).alias("w")).collect():
        assert r.t == f"{r.v:.2f}", r.v
        assert r.w == str(round(r.v)), r.v


def test_text_of_special_numbers(spark):
    assert [one(spark, fixed2(lit(x))) for x in (None, float("nan"), INF, -INF)] == ["nan", "nan", "inf", "-inf"]
    assert [one(spark, whole(lit(x))) for x in (None, INF, 2.5, 3.5)] == ["n/a", "n/a", "2", "4"]
    assert one(spark, thousands(lit(12500.0))) == "12"


def test_dates(spark):
    d = F.lit(day("2018-12-15"))
    assert one(spark, dates.month_start(d)) == day("2018-12-01")
    assert one(spark, dates.version_rate_month(d)) == day("2019-01-01")
    assert one(spark, dates.version_rate_month(F.lit(day("2018-03-31")))) == day("2018-04-01")
    assert one(spark, dates.december_before(d)) == day("2017-12-01")
    assert one(spark, dates.parse_month(F.lit("2018/07"))) == day("2018-07-01")
    assert one(spark, dates.parse_version(F.lit("20180731"))) == day("2018-07-31")
    assert one(spark, dates.parse_month(F.lit("July"))) is None
    assert close(one(spark, dates.months_in_production(d, F.lit(day("2018-12-01")))), 14 / 30)
    assert one(spark, dates.months_in_production(d, F.lit(day("2019-12-01")))) == 0.0
    start = F.lit(day("2018-01-01"))
    inside = [one(spark, dates.within_next_months(F.lit(day("2018-01-01") + dt.timedelta(n)), start)) for n in (0, 1, 186, 187)]
    assert inside == [False, True, True, False]
    assert one(spark, dates.from_year(F.lit(day("2018-01-01")), 2018)) is True
    assert one(spark, dates.from_year(F.lit(day("2017-12-31")), 2018)) is False


@pytest.mark.parametrize(
    "actual, target, score",
    [
        (1.0, 1.0, 1.0), (1.5, 1.0, 0.5), (3.0, 1.0, 0.0), (0.5, 1.0, 1.0),
        (0.0, 1.0, None), (None, 1.0, None), (1.0, None, 1.0), (1.0, 0.0, None),
    ],
)
def test_closeness(spark, actual, target, score):
    assert one(spark, closeness(lit(actual), lit(target))) == score


def test_reach_and_variance(spark):
    assert [one(spark, reach(lit(a), lit(b))) for a, b in ((1.0, 2.0), (3.0, 2.0), (None, 2.0), (1.0, 0.0))] == [0.5, 1.0, None, None]
    got = [one(spark, variance_score(lit(a), lit(b))) for a, b in ((0.5, 100.0), (-5.0, 100.0), (9.0, 100.0), (1.0, 0.0), (None, 1.0))]
    assert got == [0.5, 1.0, 0.0, None, None]


def test_weighted_score(spark):
    def named(values):
        return F.struct(*[lit(v).alias(k) for k, v in values.items()])

    weights = named({"a": 0.5, "b": 0.25})
    assert close(one(spark, weighted_score({"a": lit(1.0), "b": lit(0.0)}, weights)), 2 / 3)
    assert close(one(spark, weighted_score({"a": lit(None), "b": lit(0.5)}, weights)), 0.5)
    assert one(spark, weighted_score({"a": lit(None), "b": lit(None)}, weights)) is None
    assert math.isfinite(one(spark, weighted_score({"a": lit(0.3), "b": lit(0.9)}, weights)))
