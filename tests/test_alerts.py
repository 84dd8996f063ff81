"""Rules on their thresholds, texts, and lead numbering."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costloom.operators import alerts
from costloom.operators.lookups import params_row
from costloom.plans import alerting
from tests.helpers import close, day, rows

KPI = {
    "reporting_month": day("2019-01-01"), "product": "P", "site": "WMI", "production": 600.0, "max_capacity": 1000.0,
    "max_mps": 600.0, "fixed_moh_cost": 2.0, "revenue": 1000.0, "shipment": 100.0, "apr": 100.0,
    "ads": 22.0, "fg_ads_target": 20.0, "fg_scrap_amount": 1.0, "revenue_amt_for_scrap": 100.0,
    "yield_rate": 0.95, "yield_rate_curr_target": 0.95, "yield_rate_final_target": 0.99,
    "cogs_for_ads": 500.0, "material_total_variance": 0.0, "ppv": 3.0, "muv": 4.0, "mp_no_of_month": 2.5,
}


@pytest.fixture(scope="module")
def params(spark):
    df = spark.createDataFrame(
        [("scrap_target", 0.01, day("2018-01-01")), ("corp_funding_rate", 0.5, day("2018-01-01"))],
        "param string, value double, date date")
    return params_row(df, ["corp_funding_rate", "scrap_target"])


def kpi(spark, *changes):
    names = list(KPI)
    kinds = ", ".join(f"{n} {'date' if n == 'reporting_month' else 'string' if n in ('product', 'site') else 'double'}" for n in names)
    return spark.createDataFrame([tuple({**KPI, **c}[n] for n in names) for c in changes], kinds)


FIRING = {
    1: {"production": 499.0, "max_mps": 400.0},
    2: {"shipment": 99.0},
    3: {"ads": 22.5},
    4: {"fg_scrap_amount": 1.5},
    5: {"yield_rate": 0.9},
    6: {"material_total_variance": 5.0},
}


def test_nothing_fires_on_the_thresholds(spark, params):
    on = {"production": 500.0, "max_mps": 500.0, "ads": 20.0 * 1.1}
    nothing = {n: None for n in KPI if n not in ("reporting_month", "product", "site")}
    flags = alerts.kpi_flags(kpi(spark, {}, on, nothing), params)
    assert alerts.kpi_alerts(flags).count() == 0


@pytest.mark.parametrize("rule", FIRING)
def test_each_rule_fires_alone(spark, params, rule):
    flags = alerts.kpi_flags(kpi(spark, {}, {**FIRING[rule], "product": "Q"}), params)
    found = alerts.kpi_alerts(flags).collect()
    assert [(a.rule, a.object) for a in found] == [(rule, "Q")]
    assert len(found[0].leads) == alerts.LEADS_PER_RULE[rule]
    row = flags.filter("product = 'Q'").first()
    want = {1: 600.0 * 2 / 2000, 2: 1.0 / 199, 3: 2.5 * 0.5 / 2000, 4: 0.005, 5: 0.05 * 500 / 1000, 6: 5.0 / 2000}
    assert close(row[f"rule{rule}_num"], want[rule])
    assert found[0].importance == "high"


def test_low_impact_is_medium(spark, params):
    flags = alerts.kpi_flags(kpi(spark, {**FIRING[6], "material_total_variance": 1e-6}), params)
    assert alerts.kpi_alerts(flags).first().importance == "medium"


def test_capacity_needs_both(spark, params):
    flags = alerts.kpi_flags(kpi(spark, {"production": 1.0}, {"max_mps": 1.0}, {"production": 1.0, "max_mps": None}), params)
    assert alerts.kpi_alerts(flags).count() == 0


def test_texts(spark, params):
    everything = {k: v for c in FIRING.values() for k, v in c.items()}
    found = {a.rule: a for a in alerts.kpi_alerts(alerts.kpi_flags(kpi(spark, everything), params)).collect()}
    assert found[1].description == "P reporting period production volume was only 49.90 % of max capacity"
    assert found[1].leads == [
        "P reporting period production volume was 0K, only 49.90 % of max capacity",
        "P Maximum MPS 6 month requirement was 0K, stays below 40.00 % of max capacity",
    ]
    assert found[2].leads == ["P shipment volume was 0K", "P APR was 0K"]
    assert found[3].description == "P finished goods ADS was 12.50 % over business rule"
    assert found[3].leads == ["P reporting month finished goods ADS 22.50 days, vs. ADS business rule of 20 days"]
    assert found[4].description == "P scrap rate 1.50 %, 0.50 % higher than 1.00 %"
    assert found[4].leads == ["P scrap rate 1.50 %, vs.inventory reserve of 1.00 %"]
    assert found[5].description == "P yield rate was 90.00 %, 5.00 % behind yield rate current target"
    assert found[5].leads == [
        "P yield rate 90.00 %, vs. yield rate current target of 95.00 %",
        "P has been in MP stage for 2 months. P yield rate was 90.00, vs. yield rate final target of 99.00 %",
    ]
    assert found[6].description == "P material cost variance(PPV + MUV) was 0.50 %"
    assert found[6].leads == ["P PPV was 0.30 % of revenue; MUV was 0.40 % of revenue"]


def test_missing_numbers_in_texts(spark, params):
    flags = alerts.kpi_flags(kpi(spark, {**FIRING[5], "mp_no_of_month": None, "yield_rate_final_target": None}), params)
    leads = alerts.kpi_alerts(flags).first().leads
    assert leads[1] == "P has been in MP stage for n/a months. P yield rate was 90.00, vs. yield rate final target of 95.00 %"


SITE = "reporting_month date, site string, line_item_short string, revenue double, actual_total_cost double, actual_shipment double, budget_total_cost double, budget_shipment double, r3m_total_cost double, r3m_shipment double"


def site(spark, *data):
    return spark.createDataFrame([(day("2019-01-01"), *d) for d in data], SITE)


def test_site_rule(spark):
    df = site(
        spark,
        ("A", "total", 1000.0, 121.0, 10.0, 100.0, 1.0, 50.0, 5.0),
        ("A", "exact", 1000.0, 120.0, 10.0, 100.0, 10.0, 50.0, 5.0),
        ("B", "unit", 500.0, 100.0, 10.0, 100.0, 20.0, 50.0, 0.0),
        ("B", "no budget", 500.0, 100.0, 10.0, 0.0, 20.0, 50.0, 5.0),
        ("C", "no units", 500.0, 110.0, 0.0, 100.0, 20.0, 50.0, 5.0),
    )
    flags = {r.line_item_short: r for r in alerts.site_flags(df).collect()}
    assert set(flags) == {"total", "exact", "unit", "no units"}
    assert (flags["total"].tot_cost_is_high, flags["total"].unit_cost_is_high) == (True, False)
    assert not flags["exact"].rule8
    assert flags["unit"].unit_cost_is_high and not flags["unit"].tot_cost_is_high
    # revenue values 1000 and 500 count once each
    assert close(flags["total"].rule8_num, 21.0 / 1500)
    assert close(flags["unit"].rule8_num, 5.0 * 10.0 / 1500)
    # infinite unit cost: the rule fires, the total gap is the impact
    assert flags["no units"].unit_cost_is_high and close(flags["no units"].rule8_num, 10.0 / 1500)
    found = {a.title: a for a in alerts.site_alerts(alerts.site_flags(df)).collect()}
    assert set(found) == {"total too high", "unit too high", "no units too high"}
    assert found["total too high"].description == "Actual total was 21.00 % higher than budget"
    assert found["unit too high"].description == "Actual unit unit per shipment was 100.00 % higher than budget unit cost"
    assert found["unit too high"].leads == [
        "B actual unit was 0K NTD, budget unit was 0K NTD",
        "B actual unit unit per shipment was 10 NTD, budget unit unit per shipment was 5 NTD",
        "B R3M unit was 0K NTD; RSM unit unit per shipment was n/a NTD",
    ]


def test_numbering(spark, params):
    products = [{**FIRING[r], "product": f"P{i}{r}"} for i in range(5) for r in FIRING]
    kpi_part = alerts.kpi_alerts(alerts.kpi_flags(kpi(spark, *products), params))
    site_part = alerts.site_alerts(alerts.site_flags(site(spark, ("A", "total", 1000.0, 121.0, 10.0, 100.0, 1.0, 50.0, 5.0))))
    numbered = alerts.number_alerts(kpi_part.unionByName(site_part))
    got = numbered.orderBy("alert_id").collect()
    assert [r.alert_id for r in got] == list(range(31))
    assert [(r.rule, r.object) for r in got] == sorted((r.rule, r.object) for r in got)
    want = [(r.alert_id, text) for r in got for text in r.leads]
    leads = alerts.lead_table(numbered).orderBy("lead_id").collect()
    assert [x.lead_id for x in leads] == list(range(len(want)))
    assert [(x.alert_id, x.lead_desc) for x in leads] == want


def test_inputs(spark):
    dim = spark.createDataFrame([("p", day("2019-01-01")), ("q", day("2020-01-01")), ("r", None)], "product string, mp_start_month date")
    assert rows(alerting.production_age(dim, F.lit(day("2019-03-02")))) == [("p", 2.0), ("q", 0.0)]
    moh = spark.createDataFrame([("p", " Electricity&Water", 1.0), ("p", "IDL", 2.0), ("p", "Labor", 9.0), ("q", "IDL", None)], "product string, moh_item string, unit_moh_actual double")
    assert rows(alerting.fixed_moh_cost(moh)) == [("p", 3.0), ("q", 0.0)]
