"""One changed month: its tables are written anew, other folders stay, and the result is that of a full run."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from costloom.plans import incremental, jobs
from costloom.sources import Store
from tests.helpers import day
from tests.test_jobs import MONTHS, fill

TABLES = [
    ("raw", "is_model"), ("raw", "moh_raw"), ("staging", "tbl_kpi_model"), ("staging", "tbl_is_modeltype"),
    ("staging", "tbl_unitmoh_monthly"), ("app", "perf_kpi_model"), ("app", "perf_overview_model"),
    ("app", "perf_overview_all"), ("app", "health_kpi_model"), ("app", "health_kpi_group"),
    ("app", "cost_overview_dtl"), ("app", "cost_overview_dtl_ntd"), ("app", "cost_overview_level1"),
    ("app", "cost_overview_gap"), ("app", "cost_overview_level2"), ("app", "cost_prediction_dtl"),
    ("app", "perf_alerts"), ("app", "perf_alert_leads"),
]


@pytest.fixture(scope="module")
def store(spark):
    s = Store(spark, tempfile.mkdtemp(prefix="costloom-months-"))
    fill(s)
    assert incremental.run_changed(s).all_
    return s


def months_of(parts):
    return {p.split("reporting_month=")[1] for p in parts if "reporting_month=" in p}


def change(store):
    """Another inventory in one month, another budget in a second one; both rows in another order."""
    ads = store.read("raw", "ADS")
    hit = (F.col("Model") == "P1") & (F.col("Month") == MONTHS[5])
    ads = ads.withColumn("Inventory NTD", F.when(hit, 9000.0).otherwise(F.col("Inventory NTD")))
    store.write(ads.orderBy(F.desc("Model")), "raw", "ADS")
    pl = store.read("raw", "budget p&l")
    hit = (F.col("Project") == "P2") & (F.col("Period") == MONTHS[8].strftime("%Y/%m"))
    pl = pl.withColumn("Freight", F.when(hit, F.col("Freight") * 4).otherwise(F.col("Freight")))
    store.write(pl.orderBy(F.desc("Period")), "raw", "budget p&l")


def test_fingerprints_do_not_depend_on_order(spark):
    rows = [("a", day("2018-01-01"), 1.0), ("b", day("2018-01-01"), None), ("b", day("2018-02-01"), 2.0)]
    ddl = "k string, Month date, v double"

    def marks(data, drop=()):
        df = spark.createDataFrame(data, ddl).drop(*drop).repartition(3)
        got = incremental.fingerprint(df, "t", F.col("Month")).collect()
        return {r.month: (r.n, r.total, r.parity) for r in got}

    first = marks(rows)
    assert first == marks(rows[::-1])
    other = marks([*rows[:2], ("b", day("2018-02-01"), 3.0)])
    assert first[day("2018-01-01")] == other[day("2018-01-01")]
    assert first[day("2018-02-01")] != other[day("2018-02-01")]
    assert marks([*rows, rows[2]])[day("2018-02-01")] != first[day("2018-02-01")]
    assert set(marks(rows, ["v"]).values()).isdisjoint(first.values())


def test_nothing_changed(store):
    before = {t: store.parts(*t) for t in TABLES}
    got = incremental.run_changed(store)
    assert not got.all_ and not got.months
    assert {t: store.parts(*t) for t in TABLES} == before


def test_changed_months_equal_a_full_run(store, spark):
    before = {t: store.parts(*t) for t in TABLES}
    change(store)
    got = incremental.run_changed(store)
    inventory, budget, after = (MONTHS[i].isoformat() for i in (5, 8, 6))
    assert not got.all_ and got.months == {"ADS": {inventory}, "budget p&l": {budget}}

    def moved(table):
        now = store.parts(*table)
        return months_of({p for p in {**now, **before[table]} if now.get(p) != before[table].get(p)})

    assert moved(("staging", "tbl_kpi_model")) == {inventory}
    assert moved(("staging", "tbl_is_modeltype")) == {budget}
    assert moved(("app", "perf_kpi_model")) == {inventory, after, budget}
    assert moved(("app", "perf_overview_all")) == {inventory, after, budget}
    assert moved(("app", "cost_overview_dtl")) == moved(("app", "cost_overview_gap")) == {budget}
    kinds = {p.split("/")[0] for p, f in store.parts("app", "cost_overview_level1").items()
             if f != before[("app", "cost_overview_level1")].get(p) and not p.startswith("type=Predict")}
    assert kinds == {"type=Actual", "type=Budget", "type=R3M"}

    full = Store(spark, tempfile.mkdtemp(prefix="costloom-full-"))
    fill(full)
    change(full)
    jobs.run_all(full)
    for table in TABLES:
        want, have = full.read(*table), store.read(*table).select(*[f"`{c}`" for c in full.read(*table).columns])
        assert want.exceptAll(have).isEmpty() and have.exceptAll(want).isEmpty(), table
    kpi = store.read("app", "perf_kpi_model").filter((F.col("product") == "P1") & (F.col("reporting_month") == MONTHS[6]))
    assert kpi.first()["avg_inventory_for_ads"] > 4000


def test_a_table_without_months_leads_to_a_full_run(store):
    weights = store.read("raw", "health_score_weights")
    store.write(weights.withColumn("weight", F.col("weight") * 2), "raw", "health_score_weights")
    now = incremental.fingerprints(store)
    assert incremental.touched(store, now).all_


def test_lookups_that_multiply_rows_are_reported(store):
    """A doubled project row: the job names the lookup, its rows on both sides, and the key."""
    info = store.read("raw", "project info")
    store.write(info.unionByName(info.filter("`Project name` = 'P2'")), "raw", "project info")
    report = jobs.run_staging(store)
    grown = {r.lookup: r for r in report if r.repeated_keys}
    ledger = grown["site_of_product: model_name"]
    products = store.read("raw", "is_model").groupBy("model_name").count().collect()
    count = {r["model_name"]: r["count"] for r in products}
    assert (ledger.rows_before, ledger.rows_after) == (sum(count.values()), sum(count.values()) + count["P2"])
    assert ledger.repeated_keys == ["P2 (2 rows)"]
    clean = [r for r in report if r.lookup.startswith("item_description")]
    assert clean and all(r.rows_before == r.rows_after and not r.repeated_keys for r in clean)
    kept = store.read("staging", "lookup_report").filter("size(repeated_keys) > 0").collect()
    assert {r.lookup for r in kept if r.job == "staging"} == set(grown)
    # The cost list names an item once per second level, so the alerts' short names repeat rows; that is reported too.
    assert {r.lookup for r in kept if r.job == "alerts"} == {"line_item_short: cost_item_level1"}
