"""Physical plans: one scan, one expand, no nested-loop joins, no hidden single-task windows."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from costloom.checks.registry import load

FOLDER = os.environ.get("COSTLOOM_TEST_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def built(spark, name: str) -> str:
    return plan(load()[name](spark, FOLDER))


def test_rollup_scans_the_fact_once(spark):
    text = built(spark, "four_level_rollup")
    assert text.count("Expand") == 1
    assert text.count("lineitem.parquet") == 1
    # dimensions are small enough to be broadcast here; sums combine before each shuffle
    assert text.count("BroadcastHashJoin") == 4
    assert text.count("Exchange hashpartitioning") == 2
    for unused in ("l_tax", "l_discount", "l_linestatus", "p_brand", "s_acctbal"):
        assert unused not in text


def test_pivots_shuffle_once(spark):
    from costloom.operators.reshape import pivot_mean, pivot_sum

    df = spark.createDataFrame([], "k string, c string, v double")
    for pivot in (pivot_sum, pivot_mean):
        assert plan(pivot(df, ["k"], "c", "v", ["x", "y", "z"])).count("Exchange") == 1


def test_latest_version_combines_before_its_shuffle(spark):
    text = built(spark, "latest_version")
    assert "Window" not in text
    assert text.count("Exchange") == 1 and "partial_max_by" in text


def test_year_filter_reaches_the_scan(spark, folder):
    from costloom.functions.dates import from_year

    spark.sql("select date'2018-01-01' as reporting_month, 1 as n").write.parquet(f"{folder}/t")
    text = plan(spark.read.parquet(f"{folder}/t").filter(from_year(F.col("reporting_month"), 2018)))
    assert "GreaterThanOrEqual(reporting_month,2018-01-01)" in text


def test_series_operators_share_one_partitioning(spark):
    """Gate, lags, model fits and the final regrouping need no shuffle after the series are spread."""
    from costloom.plans import prediction

    measures = ["actual_total_cost", "actual_shipment", "actual_production", "r3m_shipment", "r3m_production"]
    ddl = "reporting_month date, bg string, bu string, site string, product string, cost_item_level1 string, "
    detail = spark.createDataFrame([], ddl + ", ".join(f"{m} double" for m in measures))
    current = F.lit(dt.date(2019, 1, 1))
    series = prediction.unit_cost_series(detail, current)
    text = plan(prediction.cost_prediction_detail(series, current))
    above, below = text.split("REPARTITION_BY_NUM")
    assert above.count("Exchange") == 1  # the spreading itself
    assert below.count("Exchange") == 1  # monthly sums, combined before it


@pytest.mark.parametrize("name", sorted(load()))
def test_no_nested_loops_or_python(spark, name):
    text = built(spark, name)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "CollectLimit"):
        assert bad not in text


def test_without_broadcast(spark):
    """The joins do not depend on a side being small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("four_level_rollup", "cost_detail", "kpi_full_outer", "item_densify"):
            text = built(spark, name)
            assert "SortMergeJoin" in text
            assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_both_currencies_come_from_two_ledger_scans(spark, folder, monkeypatch):
    from costloom import constants as K
    from costloom.checks.domain import Domain
    from costloom.plans import cost

    d = Domain(spark, FOLDER)
    d.ledger.write.parquet(f"{folder}/booked")
    settled = []
    real = cost.settle
    monkeypatch.setattr(cost, "settle", lambda df: settled.append(df) or real(df))
    rated = cost.rated_detail(spark.read.parquet(f"{folder}/booked"), d.control, d.unit_moh, d.rates)
    plans = [plan(df) for df in (*settled, rated)]
    assert [p.count("/booked") for p in plans] == [1, 1, 0]
    local, foreign = (cost.detail_in(real(rated), c) for c in (K.LOCAL, K.FOREIGN))
    assert local.columns == foreign.columns
    assert not any("/booked" in plan(df) for df in (local, foreign))
