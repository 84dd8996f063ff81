"""End-to-end jobs over a Store, in the order in which tables depend on each other.

Each job takes `months`: without it every table is written as a whole, with it only the months given are (see
`incremental`). Unless it runs inside another `LookupWatch`, a job stores the row counts of its lookups.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.contracts import TABLES, Contract, conform, gap_contract, level1_contract, prediction_contract
from costloom.functions.dates import month_start, parse_month
from costloom.operators import alerts, fx
from costloom.operators.lookups import forecast_versions, known_codes, latest_actual_month
from costloom.operators.reshape import stack
from costloom.operators.watch import LookupRows, LookupWatch
from costloom.plans import alerting, cost, performance, prediction, staging
from costloom.session import settle
from costloom.sources.ingest import Loaded, ingest_all
from costloom.sources.store import Store
from costloom.sources.templates import Template

#: Months as yyyy-MM-dd; None stands for all.
Months = Iterable[str] | None
PL_TABLES = {"Budget": "budget p&l", "R3M": "r3m p&l", "Actual": "actual p&l"}
LEVEL1 = "cost_overview_level1"
FEEDS = ("ADS", "APR", "MPS", "Scrap amount", "yield rate", "Max capacity")


def _reporting() -> Column:
    return F.col("reporting_month")


def store_report(store: Store, job: str, report: list[LookupRows]) -> None:
    """Keep the row counts of a job's lookups in staging.lookup_report, in place of those of its last run."""
    contract = Contract(
        "job string, lookup string, rows_before long, rows_after long, repeated_keys array<string>", ["job"]
    )
    rows = [(job, r.lookup, r.rows_before, r.rows_after, r.repeated_keys) for r in report]
    frame = store.spark.createDataFrame(rows, contract.schema)
    store.write_branches(frame, "staging", "lookup_report", [job], contract)


def _job(run: Callable[..., None]) -> Callable[..., list[LookupRows]]:
    """A job that counts the rows of its lookups, stores the counts and returns them."""

    @functools.wraps(run)
    def watched(store: Store, *args: object, **kwargs: object) -> list[LookupRows]:
        with LookupWatch() as watch:
            run(store, *args, **kwargs)
        report = watch.report()
        store_report(store, run.__name__.removeprefix("run_"), report)
        return report

    return watched


def _put(
    store: Store,
    df: DataFrame,
    schema: str,
    table: str,
    months: Months = None,
    month: str = "reporting_month",
    types: list[str] | None = None,
    contract: Contract | None = None,
) -> None:
    """Write a whole table, or the months given; of the types given, where a table is split by type."""
    if months is None:
        store.write(df, schema, table, contract=contract)
    else:
        store.write_months(df, schema, table, months, month, contract, types=types)


def _in(df: DataFrame, months: Months, month: Callable[[], Column]) -> DataFrame:
    """Rows of the months given."""
    if months is None:
        return df
    return df.filter(month().isin([F.lit(m).cast("date") for m in sorted(set(months))]))


def _booked(store: Store, months: Months) -> tuple[DataFrame, DataFrame]:
    """Ledger and unit overhead of the months given; all that uses them works within a month."""
    tables = ("tbl_is_modeltype", "tbl_unitmoh_monthly")
    ledger, unit = (_in(store.read("staging", t), months, _reporting) for t in tables)
    return ledger, unit


def rates(store: Store) -> DataFrame:
    return fx.rate_dimension(
        store.read("raw", "FX rate"), store.read("raw", "Budget_fx"), store.read("raw", "R3M_fx")
    )


def run_ingest(
    store: Store, folder: str, manifest: list[Template] | None = None, suffix: str = ".csv"
) -> list[Loaded]:
    """Template files to raw tables, whole tables at a time; rows that don't fit go to `rejected rows`."""
    return ingest_all(store, folder, manifest, suffix, mode="replace")


@_job
def run_staging(
    store: Store,
    unique_feeds: bool = False,
    kpi_months: Months = None,
    pl_months: dict[str, set[str]] | None = None,
    unit_months: Months = None,
) -> None:
    """Raw tables to staging tables.

    Months may be given for the KPI table, for each type of the ledger, and for the unit overhead.
    """
    info = store.read("raw", "project info")
    fx_rates = rates(store)
    if pl_months is None:
        store.write(staging.dim_project(info), "staging", "dim_project")
        store.copy("FX rate", "fx_rate")
    if kpi_months is None or kpi_months:
        day = lambda: month_start(F.col("Month"))
        feeds = [_in(store.read("raw", t), kpi_months, day) for t in FEEDS]
        if kpi_months is None:
            astray = staging.missing_feed_keys(staging.kpi_feeds(*feeds))
            store.write(astray, "staging", "missing_keys")
        kpi = staging.kpi_model(*feeds, info, fx_rates, unique=unique_feeds)
        _put(store, kpi, "staging", "tbl_kpi_model", kpi_months)

    items, codes = store.read("raw", "raw_line_items_map"), store.read("raw", "accounting item mapping")
    changed = {kind: None if pl_months is None else pl_months[kind] for kind in PL_TABLES}
    raw = {
        kind: _in(store.read("raw", t), changed[kind], lambda: parse_month(F.col("Period")))
        for kind, t in PL_TABLES.items()
    }
    if pl_months is None or changed["Actual"]:
        history = staging.actual_to_is_model(raw["Actual"].drop("Version"), items, codes)
        _put(store, history, "raw", "is_model", changed["Actual"], "period_start")
    normal = {kind: staging.normalise_pl(raw[kind], items, codes, fx_rates, kind) for kind in PL_TABLES}
    booked = _in(store.read("raw", "is_model"), changed["Actual"], lambda: F.col("period_start"))
    ledger = {"Actual": staging.is_model_to_ledger(booked, info, fx_rates)}
    ledger |= {kind: staging.pl_to_ledger(normal[kind]) for kind in ("Budget", "R3M")}
    overhead = {kind: staging.pl_to_moh_raw(normal[kind], info, kind) for kind in PL_TABLES}
    if pl_months is None:
        # All types in one write, so that no reader finds a ledger with some of them.
        for (schema, table), frames in {("staging", "tbl_is_modeltype"): ledger, ("raw", "moh_raw"): overhead}.items():
            shape = TABLES[f"{schema}.{table}"].schema
            store.write(stack(*[conform(f, shape) for f in frames.values()]), schema, table)
    for kind, months in changed.items():
        if months:
            _put(store, ledger[kind], "staging", "tbl_is_modeltype", months, types=[kind])
            _put(store, overhead[kind], "raw", "moh_raw", months, "period_start", types=[kind])
    if unit_months is not None and not unit_months:
        return
    quotes = staging.quote_by_item(store.read("raw", "quote p&l"), items, fx_rates)
    unit = staging.unit_moh(_in(store.read("raw", "moh_raw"), unit_months, lambda: F.col("period_start")), quotes)
    _put(store, unit, "staging", "tbl_unitmoh_monthly", unit_months)


@_job
def run_performance(store: Store, first_year: int = K.FIRST_YEAR, months: Months = None) -> None:
    """Staging tables to performance and health tables."""
    fx_rates, versions = rates(store), forecast_versions(store.read("raw", "r3m p&l"))
    ledger, unit = _booked(store, months)
    kpi, dim = store.read("staging", "tbl_kpi_model"), store.read("staging", "dim_project")
    merge_map = store.read("raw", "line_item_merge_map")
    weights = store.read("raw", "health_score_weights")
    overview = performance.perf_overview_model(ledger, kpi, unit, merge_map, fx_rates, versions, first_year)
    _put(store, overview, "app", "perf_overview_model", months)
    scored = performance.perf_kpi_model(kpi, ledger, unit, merge_map, dim, weights, first_year)
    _put(store, scored, "app", "perf_kpi_model", months)
    perf_kpi, overview = store.read("app", "perf_kpi_model"), store.read("app", "perf_overview_model")
    wide = performance.perf_overview_all(perf_kpi, overview, dim, fx_rates, versions)
    _put(store, wide, "app", "perf_overview_all", months)
    if months is None:
        store.write(staging.product_status(dim), "app", "health_product_status")
    health = performance.health_kpi_model(perf_kpi, overview)
    _put(store, health, "app", "health_kpi_model", months)
    _put(store, performance.health_kpi_group(health, dim), "app", "health_kpi_group", months)


@_job
def run_cost(
    store: Store, first_year: int = K.FIRST_YEAR, months: Months = None, codes: list[str] | None = None
) -> None:
    """Staging tables to cost tables. `codes` declares the category columns anew, for a table that gets more of them."""
    fx_rates = rates(store)
    ledger, unit = _booked(store, months)
    dim, control = store.read("staging", "dim_project"), store.read("dim", "tbl_cost_control_list")
    codes = declared_codes(store, codes)
    categories = known_codes(store.read("app", "cost_category"), codes)
    rated = settle(cost.rated_detail(ledger, control, unit, fx_rates, first_year))
    for table, currency in (("cost_overview_dtl_ntd", K.LOCAL), ("cost_overview_dtl", K.FOREIGN)):
        _put(store, cost.detail_in(rated, currency), "app", table, months)
    detail = _in(store.read("app", "cost_overview_dtl"), months, _reporting)
    level1 = cost.cost_overview_level1(detail, dim, categories, fx_rates, codes)
    contract, planned = level1_contract(codes), ("r3m_shipment", "r3m_production")
    if months is None:
        store.write_branches(level1, "app", "cost_overview_level1", K.TYPES, contract, optional=planned)
    else:
        store.write_months(
            level1, "app", "cost_overview_level1", months, contract=contract, optional=planned, types=K.TYPES
        )
    groups = level0_groups(codes)
    gap = cost.cost_overview_gap(detail, dim, categories, fx_rates, groups)
    _put(store, gap, "app", "cost_overview_gap", months, contract=gap_contract(groups))
    level2 = cost.cost_overview_level2(detail, dim, categories, fx_rates)
    _put(store, level2, "app", "cost_overview_level2", months)


def category_codes(categories: DataFrame, most: int = 1000) -> list[str]:
    """The category codes as a sorted list, to name the columns of a new table.

    A table has a bounded number of columns: more than `most` codes are an error, found before more than that
    reach the driver.
    """
    rows = categories.select("cost_cat_code").filter("cost_cat_code is not null").distinct()
    codes = sorted(r[0] for r in rows.limit(most + 1).collect())
    if len(codes) > most:
        raise ValueError(f"more than {most} cost categories; a pivot cannot have a column for each")
    return codes


def declared_codes(store: Store, codes: list[str] | None = None) -> list[str]:
    """Category columns of the level-1 table: the ones given, else those that the stored table has.

    Before its first run there is no table, and its columns come from the category list.
    """
    if codes is not None:
        return sorted(codes)
    if not store.exists("app", LEVEL1):
        return category_codes(store.read("app", "cost_category"))
    fixed = set(level1_contract([]).names)
    return sorted(c for c in store.read("app", LEVEL1).columns if c not in fixed)


def level0_groups(codes: list[str]) -> list[str]:
    """Gap columns of a list of category codes."""
    heads = {c.split("_")[0] for c in codes}
    return sorted(K.LEVEL0_PREFIX + K.LEVEL0_NAMES.get(h, h) for h in heads)


@_job
def run_forecast(store: Store) -> None:
    """Cost detail to predictions, and predictions to the cost overview."""
    fx_rates = rates(store)
    current = latest_actual_month(store.read("staging", "tbl_is_modeltype")).scalar()
    series = prediction.unit_cost_series(store.read("app", "cost_overview_dtl"), current)
    predicted = prediction.tag_prediction(
        prediction.cost_prediction_detail(series, current), fx_rates
    )
    store.write(predicted, "app", "cost_prediction_dtl", contract=prediction_contract())
    codes = declared_codes(store)
    categories = known_codes(store.read("app", "cost_category"), codes)
    rows = prediction.prediction_level1(
        store.read("app", "cost_prediction_dtl").drop("currency", "fx_rate"),
        store.read("staging", "dim_project"), categories, fx_rates, codes, current,
    )
    store.write_branches(
        rows, "app", "cost_overview_level1", list(K.PREDICTED.values()), level1_contract(codes),
        optional=("shipment", "production"),
    )


@_job
def run_alerts(store: Store) -> None:
    """Performance and cost tables to alerts and leads."""
    ledger, unit = store.read("staging", "tbl_is_modeltype"), store.read("staging", "tbl_unitmoh_monthly")
    current = latest_actual_month(ledger).scalar()
    base = settle(
        alerting.alert_base(
            store.read("app", "perf_kpi_model"), unit, ledger, store.read("staging", "dim_project"),
            current,
        )
    )
    site = settle(
        alerting.site_alert_base(
            base, store.read("app", "cost_overview_dtl_ntd"),
            store.read("dim", "tbl_cost_control_list"), current,
        )
    )
    numbered = alerts.number_alerts(
        alerting.all_alerts(base, site, store.read("raw", "param_control"))
    )
    store.write(alerts.alert_table(numbered), "app", "perf_alerts")
    store.write(alerts.lead_table(numbered), "app", "perf_alert_leads")


def run_all(
    store: Store, first_year: int = K.FIRST_YEAR, folder: str | None = None, suffix: str = ".csv"
) -> list[Loaded]:
    """Everything: template files of `folder`, if given, to raw tables, and raw tables to alerts.

    Returns the row counts of the files.
    """
    loaded = run_ingest(store, folder, suffix=suffix) if folder else []
    run_staging(store)
    run_performance(store, first_year)
    run_cost(store, first_year)
    run_forecast(store)
    run_alerts(store)
    return loaded
