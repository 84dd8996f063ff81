"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

from costloom.checks.registry import load

FOLDER = os.environ.get("COSTLOOM_TEST_TABLES", "/root/testdata/sf0.001")
NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def canonical(records):
    out = [tuple(plain(v) for v in r) for r in records]
    return sorted(out, key=lambda r: tuple((v is None, str(v) if isinstance(v, (str, dt.date)) else "", v if isinstance(v, (int, float)) else 0) for v in r))


@pytest.mark.parametrize("name", sorted(load()))
def test_query_matches_sql(spark, duck, name):
    query = load()[name]
    df = query(spark, FOLDER)
    columns = sorted(df.columns)
    got = canonical(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = duck.execute(query.sql)
    there = [c[0] for c in cursor.description]
    assert sorted(there) == columns
    want = canonical(tuple(r[there.index(c)] for c in columns) for r in cursor.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert set(load()) <= set(entry.queries())
    assert set(load()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == [
        "bg", "reporting_month", "type", "cat_ind", "total_cost", "quantity", "unit_cost"]


def test_gap_is_in_dollars(spark):
    gap = load()["cost_gap"](spark, FOLDER).filter("cat_ind = 'ALL'").agg({"ucg_total": "sum"}).first()[0]

    def total(name):
        rows = load()[name](spark, FOLDER).join(codes, "cost_item_level1")
        return rows.agg({"actual_total_cost": "sum"}).first()[0]

    looked = load()["cost_category_lookup"](spark, FOLDER)
    codes = looked.filter("cost_cat_code is not null").select("cost_item_level1").distinct()
    assert gap == pytest.approx(total("cost_detail_foreign"))
    assert gap < total("cost_detail") / 10


def ids(prefix, last, without=()):
    return {f"{prefix}{i}" for i in range(1, last + 1) if i not in without}


def test_every_operator_has_a_query():
    wanted = (
        ids("IO", 10) | ids("P", 22) | ids("J", 35) | ids("A", 24) | ids("R", 8) | ids("W", 6) | ids("T", 4)
        | ids("S", 3) | ids("F", 21) | ids("E", 8) | ids("G", 17) | ids("H", 6) | ids("K", 13, (7,)) | ids("C", 15)
    )
    covered = {c for q in load().values() for c in q.covers}
    assert covered == wanted
