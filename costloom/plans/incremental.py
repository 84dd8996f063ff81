"""Recomputing only what a change of the raw tables touches.

Every raw table gets a fingerprint per month: row count, sum and parity of row hashes, so the order of rows and files
doesn't matter. Months whose fingerprint differs from the one of the last run are passed on along the tables:

* KPI feeds touch their month of the KPI table, and, through the two-row mean of the inventory, the next month that
  a product has.
* Profit-and-loss tables touch their month and type of the ledger and of the overhead, and with these the unit
  overhead, performance, health and cost tables of that month.
* Predictions come from whole series and alerts from the latest month, so both are computed anew after any change.
* Rates, projects, maps, weights, parameters and lists have no month; a change of one of them, a row without a month,
  or other columns in a raw table, lead to a full run.

Other months keep the folders they have. The fingerprints are stored last, so a run that fails is done again.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.contracts import Contract
from costloom.functions.dates import month_start, parse_month
from costloom.functions.missing import col
from costloom.plans import jobs
from costloom.sources.store import Store

FINGERPRINTS = Contract("table_name string, month date, n long, total string, parity long")
#: Tables without months: any change touches everything.
TIMELESS = (
    ("raw", "project info"), ("raw", "raw_line_items_map"), ("raw", "accounting item mapping"),
    ("raw", "line_item_merge_map"), ("raw", "health_score_weights"), ("raw", "param_control"), ("raw", "FX rate"),
    ("raw", "Budget_fx"), ("raw", "R3M_fx"), ("dim", "tbl_cost_control_list"), ("app", "cost_category"),
)
QUOTES = "quote p&l"


@dataclass
class Touched:
    """Months (yyyy-MM-dd) that changed per raw table; `all_` if the change has no month."""

    months: dict[str, set[str]] = field(default_factory=dict)
    all_: bool = False

    def of(self, *tables: str) -> set[str]:
        return set().union(*[self.months.get(t, set()) for t in tables])


def fingerprint(df: DataFrame, table: str, month: Column) -> DataFrame:
    """(table_name, month, n, total, parity), the same for any order of rows and columns."""
    names = sorted(df.columns)
    row = F.xxhash64(F.lit(",".join(names)), *[col(n) for n in names])
    hashed = df.select(month.alias("month"), row.alias("h"))
    return hashed.groupBy(F.lit(table).alias("table_name"), "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("total"),
        F.bit_xor("h").alias("parity"),
    )


def fingerprints(store: Store) -> DataFrame:
    """Fingerprints of all raw tables that the jobs read; one aggregate per table."""
    day, period = month_start(F.col("Month")), parse_month(F.col("Period"))
    monthly = [(t, day) for t in jobs.FEEDS] + [(t, period) for t in (*jobs.PL_TABLES.values(), QUOTES)]
    parts = [fingerprint(store.read("raw", t), t, m) for t, m in monthly]
    none = F.lit(None).cast("date")
    parts += [fingerprint(store.read(s, t), f"{s}.{t}", none) for s, t in TIMELESS]
    return reduce(DataFrame.unionByName, parts)


def touched(store: Store, now: DataFrame) -> Touched:
    """Months whose fingerprint is new, gone or different. What comes to the driver is bounded by tables and months."""
    if not store.exists("staging", "fingerprints"):
        return Touched(all_=True)
    keys, marks = ["table_name", "month"], ["n", "total", "parity"]
    before = store.read("staging", "fingerprints").select(*keys, F.struct(*marks).alias("old"))
    after = now.select(F.col("table_name").alias("t"), F.col("month").alias("m"), F.struct(*marks).alias("new"))
    same = (F.col("table_name") == F.col("t")) & F.col("month").eqNullSafe(F.col("m"))
    changed = before.join(after, same, "full").filter(~F.col("old").eqNullSafe(F.col("new")))
    out = Touched()
    for r in changed.select(F.coalesce("table_name", "t"), F.coalesce("month", "m")).collect():
        if r[1] is None:
            out.all_ = True
        else:
            out.months.setdefault(r[0], set()).add(r[1].isoformat())
    return out


def following_months(kpi: DataFrame, months: set[str]) -> set[str]:
    """Months in which a product's row before lies in one of the months given."""
    w = Window.partitionBy("product").orderBy("reporting_month")
    pairs = kpi.select("reporting_month", F.lag("reporting_month").over(w).alias("before"))
    hit = pairs.filter(F.col("before").isin([F.lit(m).cast("date") for m in sorted(months)]))
    return {r[0].isoformat() for r in hit.select("reporting_month").distinct().collect()}


def run_changed(store: Store, first_year: int = K.FIRST_YEAR) -> Touched:
    """Bring all tables up to date with the raw tables; the result is that of `jobs.run_all`."""
    now = fingerprints(store)
    store.write(now, "staging", "fingerprints_next", contract=FINGERPRINTS)
    now = store.read("staging", "fingerprints_next")
    change = touched(store, now)
    if change.all_:
        jobs.run_all(store, first_year)
    elif change.months:
        _run_months(store, change, first_year)
    store.write(now, "staging", "fingerprints", contract=FINGERPRINTS)
    return change


def _run_months(store: Store, change: Touched, first_year: int) -> None:
    kpi = change.of(*jobs.FEEDS)
    pl = {kind: change.of(table) for kind, table in jobs.PL_TABLES.items()}
    booked = set().union(*pl.values())
    unit = booked | change.of(QUOTES)
    after = following_months(store.read("staging", "tbl_kpi_model"), kpi) if kpi else set()
    jobs.run_staging(store, kpi_months=kpi, pl_months=pl, unit_months=unit)
    if kpi:
        after |= following_months(store.read("staging", "tbl_kpi_model"), kpi)
    jobs.run_performance(store, first_year, months=kpi | after | unit)
    if unit:
        jobs.run_cost(store, first_year, months=unit)
        jobs.run_forecast(store)
    jobs.run_alerts(store)
