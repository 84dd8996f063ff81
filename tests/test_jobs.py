"""Raw fixture tables through every job, checked against values computed here by hand rules."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.plans import jobs
from costloom.sources import Store
from tests.helpers import close, day

SITES = {"P1": "WMI", "P2": "WKS", "P3": "S01"}
MONTHS = [dt.date(2017 + (10 + i) // 12, (10 + i) % 12 + 1, 1) for i in range(16)]  # 2017-11 .. 2019-02
ITEMS = {
    "Sales normal": ("Sales_Normal shipment", "Sales"),
    "Sales returns": ("Sales_Sales return & allowance", "Sales"),
    "Std": ("Material cost_Standard", "Material cost"),
    "PPV": ("Material cost_Purchase price variance", "Material cost"),
    "MUV": ("Material cost_Material usage variance", "Material cost"),
    "Freight": ("Freight", "Other cost"),
    "SGA": ("SGA", "OPEX"),
    "MOH total": ("MOH total", "MOH"),
    "IDL c": ("IDL", None),
    "Dep c": ("Depreciation-W-buy", None),
    K.SHIPPED_UNITS: ("Invoice quantity", None),
    "Prod": ("Production quantity", None),
}


def amount(item: str, product: str, i: int, kind: str) -> float | None:
    n = int(product[1])
    scale = {"Actual": 1.0, "Budget": 0.5, "R3M": 0.75}[kind]
    base = {
        "Sales normal": 4000.0, "Sales returns": -100.0, "Std": 1000.0, "PPV": 20.0, "MUV": 12.0,
        "Freight": 300.0, "SGA": 200.0, "MOH total": 90.0, "IDL c": 64.0, "Dep c": 32.0,
        K.SHIPPED_UNITS: 50.0, "Prod": 40.0,
    }[item]
    if item == K.SHIPPED_UNITS and i == 3:
        return None
    return base * n * scale * (1 + i % 4)


def pl_rows(kind: str, with_version: bool = True):
    out = []
    for p in SITES:
        for i, m in enumerate(MONTHS if kind != "Actual" else MONTHS[:-1]):
            for back in (2, 1):
                version = (m.replace(day=1) - dt.timedelta(days=28 * back)).strftime("%Y%m%d")
                values = [amount(x, p, i, kind) for x in ITEMS]
                if back == 2:
                    values = [v and v * 9 for v in values]
                row = [m.year, m.month, m.strftime("%Y/%m"), SITES[p], p, version, *values, 7.0]
                if with_version or back == 1:
                    out.append(tuple(row))
    return out


def fill(s: Store) -> None:
    """Raw tables of three products and sixteen months."""

    def put(schema, table, data, ddl):
        s.write(s.spark.createDataFrame(data, ddl), schema, table, mode="append")

    pl = (
        "Year int, Month int, Period string, Site string, Project string, Version string, "
        + ", ".join(f"`{x}` double" for x in ITEMS)
        + f", `{K.INVOICED_UNITS}` double"
    )
    put("raw", "budget p&l", pl_rows("Budget"), pl)
    put("raw", "r3m p&l", pl_rows("R3M"), pl)
    put("raw", "actual p&l", pl_rows("Actual", with_version=False), pl)
    quote = [(m.year, m.month, m.strftime("%Y/%m"), SITES[p], p, 0.5, 0.25) for p in SITES for m in MONTHS]
    put("raw", "quote p&l", quote, "Year int, Month int, Period string, Site string, Project string, `IDL c` double, `Dep c` double")
    put("raw", "project info", [
        (p, SITES[p], f"C{p}", "Phone" if p != "P3" else "Accessory", "MP" if p != "P2" else "NPI",
         day("2017-01-01"), day("2016-06-01"), day("2017-02-01")) for p in SITES
    ], "`Project name` string, Site string, `AllieCode Name` string, `Product Type` string, `Current stage` string, `MP Start` date, `NPI Start` date, `Shipment Start` date")
    put("raw", "raw_line_items_map", [(k, d, g) for k, (d, g) in ITEMS.items()],
        "variable string, accounting_item_desc string, accounting_item_group string")
    put("raw", "accounting item mapping", [(f"A{i}", d) for i, (d, _) in enumerate(ITEMS.values())],
        "accounting_item_code string, accounting_item_desc string")
    app = {"Sales": "revenue", "Material cost": "material_cost", "Other cost": "other_cost", "OPEX": "opex", "MOH": "moh"}
    merge = [(d, app[g]) for d, g in ITEMS.values() if g]
    merge += [("Invoice quantity", "shipment_volume"), ("Production quantity", "production_volume")]
    put("raw", "line_item_merge_map", merge, "accounting_item_desc string, app_item string")
    put("raw", "health_score_weights", [(x, 0.125) for x in K.SCORES], "idx string, weight double")
    put("raw", "param_control", [("scrap_target", 0.01, day("2017-01-01")), ("corp_funding_rate", 0.1, day("2017-01-01"))],
        "param string, value double, date date")
    fx = [(m, "USD", "NTD", 30.0) for m in [*MONTHS, day("2019-03-01")]]
    put("raw", "FX rate", fx, "Month date, `From` string, `To` string, FX double")
    put("raw", "R3M_fx", [(m, a, b, 32.0) for m, a, b, _ in fx] + [(day("2017-10-01"), "USD", "NTD", 32.0)],
        "Month date, `From` string, `To` string, FX double")
    put("raw", "Budget_fx", [(y, "USD", "NTD", 31.0) for y in (2017, 2018, 2019)],
        "Year int, `From` string, `To` string, FX double")
    keyed = [(p, m) for p in SITES for m in MONTHS[:-1]]
    put("raw", "ADS", [(p, m, 30.0, 500.0, 400.0 + 10 * i, 20.0) for i, (p, m) in enumerate(keyed)],
        "Model string, Month date, ADS double, `COGS NTD` double, `Inventory NTD` double, ads_target double")
    put("raw", "APR", [(p, m, 1000.0) for p, m in keyed if p != "P3"], "project string, Month date, `APR _volume` double")
    put("raw", "MPS", [(p, m, 10.0) for p in SITES for m in MONTHS], "project string, Month date, `MPS _volume` double")
    put("raw", "Scrap amount", [(p, dt.date(m.year, m.month, 28), 5.0, 0.02) for p, m in keyed],
        "W_Model string, Month date, `Actual Scrap AMT_USD` double, scrap_rate double")
    put("raw", "yield rate", [(p, m, 0.9, 0.95, 0.97) for p, m in keyed],
        "Model string, Month date, `Yield rate` double, yield_rate_current_target double, yield_rate_final_target double")
    put("raw", "Max capacity", [(p, m, 1000.0) for p, m in keyed], "Model string, Month date, Units double")
    put("dim", "tbl_cost_control_list", [
        ("SDBG", "Freight", "Other cost", "Freight", "Freight"),
        ("SDBG", "SGA", "OPEX", "Selling", "SG&A"),
        ("SDBG", "SGA", "OPEX", "General", "SG&A"),
        ("SDBG", "MOH_WMI", "MOH", "IDL", "MOH"),
        ("SDBG", "MOH_WEKS", "MOH", "IDL", "MOH"),
    ], "bg string, line_item string, line_itm_group string, detailed_item string, `Frontnend_name level 1` string")
    put("app", "cost_category", [("oc_f", "Freight", 0), ("opex_s", "SGA", 1), ("moh_wmi", "MOH_WMI", 0), ("moh_weks", "MOH_WEKS", 0)],
        "cost_cat_code string, cost_cat_name string, non_adj_flag int")


@pytest.fixture(scope="module")
def store(spark):
    s = Store(spark, tempfile.mkdtemp(prefix="costloom-jobs-"))
    fill(s)
    jobs.run_all(s)
    return s


def test_staging(store):
    ledger = store.read("staging", "tbl_is_modeltype")
    # latest version only: values of the first version are nine times as large
    budget = ledger.filter("type = 'Budget' and product = 'P1' and line_item = 'Freight'")
    got = {r.reporting_month: r.value for r in budget.collect()}
    assert got == {m: amount("Freight", "P1", i, "Budget") for i, m in enumerate(MONTHS)}
    # 11.1 missing -> 11.9
    filled = ledger.filter("type = 'R3M' and product = 'P2' and line_item = 'Invoice quantity'")
    assert {r.reporting_month: r.value for r in filled.collect()}[MONTHS[3]] == 7.0
    assert ledger.filter("type = 'Actual'").select("fx_rate").distinct().collect()[0][0] == 30.0
    assert ledger.filter("type = 'Budget'").select("fx_rate").distinct().collect()[0][0] == 31.0
    assert {r[0] for r in ledger.filter("line_item = 'Invoice quantity'").select("currency").distinct().collect()} == {None}
    # quantities go to both tables
    moh = store.read("raw", "moh_raw")
    assert {r[0] for r in moh.select("accounting_item_desc").distinct().collect()} == {
        "IDL", "Depreciation-W-buy", "Invoice quantity", "Production quantity"}
    unit = store.read("staging", "tbl_unitmoh_monthly").filter("product = 'P1' and moh_item = 'IDL'")
    row = unit.filter(F.col("reporting_month") == MONTHS[0]).first()
    assert close(row.unit_moh_actual, 64.0 / 40.0) and close(row.unit_moh_quote, 15.0)
    kpi = store.read("staging", "tbl_kpi_model")
    assert kpi.count() == 3 * len(MONTHS)  # MPS reaches one month further than the other feeds
    scrap = kpi.filter("product = 'P1'").filter(F.col("reporting_month") == MONTHS[0]).first()
    assert close(scrap.fg_scrap_amount, 150.0) and scrap.site == "WMI"
    assert kpi.filter("product = 'P3' and apr is not null").count() == 0


def test_performance(store):
    kpi = store.read("app", "perf_kpi_model")
    assert kpi.agg(F.min("reporting_month")).first()[0] == day("2018-01-01")
    row = kpi.filter("product = 'P1'").filter(F.col("reporting_month") == MONTHS[4]).first()
    assert close(row.revenue, 3900.0) and close(row.material_total_variance, 32.0)
    assert kpi.filter("product = 'P2' and health_score is not null").count() == 0
    scores = [r[0] for r in kpi.filter("product = 'P1'").select("health_score").collect()]
    assert all(s is None or 0 <= s <= 1 for s in scores) and any(s is not None for s in scores)
    overview = store.read("app", "perf_overview_all")
    wide = overview.filter((F.col("reporting_month") == MONTHS[4]) & (F.col("type") == "Actual"))
    by = {r.cat_ind: r.revenue for r in wide.collect()}
    assert close(by["ALL"], 3900.0 * 6)
    assert close(by["ALL"], by["WMI"] + by["WKS"] + by["S01"])
    assert close(by["ALL"], by["Phone"] + by["Accessory"])
    planned = overview.filter("type = 'Budget'").select("ads", "scrap_rate").distinct().collect()
    assert [tuple(r) for r in planned] == [(20.0, 0.02)]
    assert store.read("app", "health_kpi_group").filter("cat_ind = 'ALL'").count() == 14
    assert store.read("app", "health_product_status").filter("product_status = 'MP'").count() == 2


def test_cost(store):
    detail = store.read("app", "cost_overview_dtl_ntd")
    at = detail.filter((F.col("product") == "P1") & (F.col("reporting_month") == MONTHS[4]))
    cost = {(r.cost_item_level1, r.cost_item_level2): r.actual_total_cost for r in at.collect()}
    assert close(cost[("Freight", "Freight")], 300.0)
    assert close(cost[("MOH_WMI", "IDL")], 64.0)  # per unit, times production
    assert cost[("MOH_WEKS", "IDL")] is None  # not at this site
    usd = store.read("app", "cost_overview_dtl").filter(
        (F.col("product") == "P1") & (F.col("reporting_month") == MONTHS[4]) & (F.col("cost_item_level1") == "Freight")
    ).first()
    assert close(usd.actual_total_cost, 10.0)
    level1 = store.read("app", "cost_overview_level1").filter(
        (F.col("reporting_month") == MONTHS[4]) & (F.col("type") == "Actual")
        & (F.col("cat_ind") == "ALL") & (F.col("standard") == "production")
    ).first()
    assert close(level1.oc_f, 10.0 * 6 / (40.0 * 6)) and level1.shipment is None
    gap = store.read("app", "cost_overview_gap").filter(
        (F.col("reporting_month") == MONTHS[4]) & (F.col("cat_ind") == "ALL")
    ).first()
    assert close(gap.ucg_other, 60.0) and close(gap.ucg_non_adj, 2 * 200.0 * 6 / 30)
    assert close(gap.ucg_total, gap.ucg_other + gap.ucg_opex + gap.ucg_moh)
    level2 = store.read("app", "cost_overview_level2").filter(
        (F.col("reporting_month") == MONTHS[4]) & (F.col("type") == "Actual")
        & (F.col("cat_ind") == "ALL") & (F.col("project") == "P1") & (F.col("cost_cat_code") == "opex_s")
    )
    by = {r.cost_level2: r.total_cost for r in level2.collect()}
    assert close(by["aggregate"], by["Selling"] + by["General"])


def test_forecast(store):
    dtl = store.read("app", "cost_prediction_dtl")
    new = dtl.filter(F.col("reporting_month") == MONTHS[-1])
    assert new.filter("ma_unit_cost_shipment is null").count() == 0
    one = new.filter("product = 'P1' and cost_item_level1 = 'Freight'").first()
    past = dtl.filter("product = 'P1' and cost_item_level1 = 'Freight'").orderBy("reporting_month").collect()
    last = [r.actual_unit_cost_per_prod for r in past if r.reporting_month < MONTHS[-1]][-3:]
    assert close(one.ma_unit_cost_production, sum(last) / 3)
    first = [r for r in past][:3]
    assert all(r.es_unit_cost_production is None for r in first)
    types = {r[0] for r in store.read("app", "cost_overview_level1").select("type").distinct().collect()}
    assert types == {"Actual", "Budget", "R3M", "PredictMA", "PredictES", "PredictARIMA"}


def test_alerts(store):
    alerts = store.read("app", "perf_alerts").orderBy("alert_id").collect()
    leads = store.read("app", "perf_alert_leads").orderBy("lead_id").collect()
    assert [a.alert_id for a in alerts] == list(range(len(alerts)))
    assert [x.lead_id for x in leads] == list(range(len(leads)))
    assert [x.alert_id for x in leads] == sorted(x.alert_id for x in leads)
    assert {x.alert_id for x in leads} == {a.alert_id for a in alerts}
    assert {a.title for a in alerts} == {
        "Capacity under-usage", "Shipment below APR", "Average days stock too high",
        "Scrap rate too high", "Yield rate target unmet", "Positive material cost variance",
        "Freight too high", "SG&A too high",
    }
    assert {a.alert_month for a in alerts} == {MONTHS[-2]}
    yields = [a for a in alerts if a.title == "Yield rate target unmet"]
    assert yields[0].description == (
        "P1 yield rate was 90.00 %, 5.00 % behind yield rate current target")
    freight = [a for a in alerts if a.title == "Freight too high" and a.object == "WMI"][0]
    assert freight.description.startswith("Actual Freight was 100.00 % higher than budget")


def test_second_run_replaces(store):
    before = store.read("app", "perf_kpi_model").count()
    level1 = store.read("app", "cost_overview_level1").count()
    jobs.run_performance(store)
    jobs.run_cost(store)
    assert store.read("app", "perf_kpi_model").count() == before
    assert store.read("app", "cost_overview_level1").count() == level1
