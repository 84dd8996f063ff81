"""Tables in buckets by product: joins on month and product move nothing, and results are the same."""

from __future__ import annotations

import re
import tempfile

import pytest

from costloom.plans import jobs, performance, staging
from costloom.sources import Store
from tests.helpers import day
from tests.test_jobs import MONTHS, fill

BUCKETS = 3


@pytest.fixture(scope="module")
def stores(spark):
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    plain = Store(spark, tempfile.mkdtemp(prefix="costloom-plain-"))
    bucketed = Store(spark, tempfile.mkdtemp(prefix="costloom-buckets-"), buckets=BUCKETS)
    for s in (plain, bucketed):
        fill(s)
        jobs.run_staging(s)
    yield plain, bucketed
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", before)


def moved(df):
    """Shuffles by product in a plan; small lookup tables may be grouped by keys of their own."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\([^)]*(?:product|model_name|Project)#[^)]*\)", plan)


def same(a, b):
    b = b.select(*[f"`{c}`" for c in a.columns])
    return a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def dims_only(spark):
    """Lookup tables may be broadcast; the monthly tables are too large for that."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8KB")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def perf_kpi(s):
    return performance.perf_kpi_model(
        s.read("staging", "tbl_kpi_model"), s.read("staging", "tbl_is_modeltype"), s.read("staging", "tbl_unitmoh_monthly"),
        s.read("raw", "line_item_merge_map"), s.read("staging", "dim_project"), s.read("raw", "health_score_weights"),
    )


def unit_moh(s):
    quotes = staging.quote_by_item(s.read("raw", "quote p&l"), s.read("raw", "raw_line_items_map"), jobs.rates(s))
    return staging.unit_moh(s.read("raw", "moh_raw"), quotes.filter("false"))


def test_kpis_with_results_and_overhead(stores, dims_only):
    plain, bucketed = stores
    assert len(moved(perf_kpi(plain))) >= 3
    assert moved(perf_kpi(bucketed)) == []
    assert same(perf_kpi(plain), perf_kpi(bucketed))


def test_costs_per_produced_unit(stores, dims_only):
    plain, bucketed = stores
    assert len(moved(unit_moh(plain))) >= 2
    # Only the quotes, which come from a raw table, move.
    assert not any("model_name" in m for m in moved(unit_moh(bucketed)))
    assert same(unit_moh(plain), unit_moh(bucketed))


def test_months_replaced_and_another_session(stores, spark, dims_only):
    plain, bucketed = stores
    for s in stores:
        ledger = s.read("staging", "tbl_is_modeltype")
        s.write_months(
            ledger.withColumn("value", ledger["value"] * 2), "staging", "tbl_is_modeltype",
            [MONTHS[4].isoformat()], types=["Actual"],
        )
    # The tables as a session meets them that did not write them.
    for t in spark.catalog.listTables():
        if t.name.startswith("costloom_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert same(perf_kpi(plain), perf_kpi(bucketed))
    assert moved(perf_kpi(bucketed)) == []
    plain_again = Store(spark, bucketed.root)
    assert same(plain_again.read("staging", "tbl_is_modeltype"), bucketed.read("staging", "tbl_is_modeltype"))
    month = bucketed.read("staging", "tbl_is_modeltype").filter(f"reporting_month = '{day(str(MONTHS[4]))}'")
    assert month.count() > 0


def test_jobs_on_buckets(stores):
    plain, bucketed = stores
    for s in stores:
        jobs.run_performance(s)
        jobs.run_cost(s)
    for table in ("perf_kpi_model", "perf_overview_all", "health_kpi_group", "cost_overview_dtl", "cost_overview_level2"):
        assert same(plain.read("app", table), bucketed.read("app", table)), table
