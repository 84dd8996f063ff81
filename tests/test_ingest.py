"""Typed template files: what loads, what is rejected and why; the jobs from files on."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from costloom.plans import jobs
from costloom.sources import MANIFEST, Store, Template
from costloom.sources.ingest import REJECTED, ingest_all, ingest_template, judge, read_cells
from tests.helpers import day, rows
from tests.test_jobs import fill

BY_TABLE = {t.table: t for t in MANIFEST}


def put(folder, name, text):
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_every_row_is_loaded_or_rejected(spark, folder):
    put(folder, "FX rate.csv", (
        "Month,From,To,FX\n2018-01-01,USD,NTD,30.5\n2018-02-01,USD,NTD,\nbad,USD,NTD,1\n2018-03-01,USD,NTD,abc\n"
        '2018-13-01,"U ""x"", y",NTD,NaN\n2018-04-01,USD\n2018-05-01,USD,NTD,1,2\n 2018-06-01 ,USD,NTD,1e3\n'
        "2018-07-01 00:00:00,USD,NTD,Infinity\n"
    ))
    store = Store(spark, f"{folder}/db")
    got = ingest_template(store, folder, BY_TABLE["FX rate"])
    assert (got.read, got.loaded, got.rejected) == (9, 3, 6)
    table = store.read("raw", "FX rate")
    assert [f.dataType.simpleString() for f in table.schema.fields] == ["date", "string", "string", "double"]
    assert rows(table, "Month", "FX") == [(day("2018-01-01"), 30.5), (day("2018-02-01"), None), (day("2018-06-01"), 1000.0)]
    kept = {r.record: r.reasons for r in store.read("raw", REJECTED).collect()}
    assert kept["bad,USD,NTD,1"] == ["Month not a date: bad"]
    assert kept["2018-03-01,USD,NTD,abc"] == ["FX not a double: abc"]
    assert kept["2018-04-01,USD"] == kept["2018-05-01,USD,NTD,1,2"] == ["wrong number of fields"]
    assert kept["2018-07-01 00:00:00,USD,NTD,Infinity"] == ["FX not a double: Infinity"]
    assert sum("2018-13-01" in r for r in kept) == 1
    files = {r.file for r in store.read("raw", REJECTED).collect()}
    assert len(files) == 1 and files.pop().endswith("FX%20rate.csv")


def test_open_columns_patterns_and_whole_numbers(spark, folder):
    put(folder, "budget p&l.csv", (
        "Year,Month,Period,Site,Project,Version,Sales (normal),11.1 x\n2018,1.0,2018/01,W,P,20180101,1,\n"
        "2018,1,2018-01,W,P,20180101,x,2\n2018,1.5,2018/01,W,P,201801,1,2\n"
    ))
    store = Store(spark, f"{folder}/db")
    assert ingest_template(store, folder, BY_TABLE["budget p&l"]).rejected == 2
    assert [tuple(r) for r in store.read("raw", "budget p&l").collect()] == [
        (2018, 1, "2018/01", "W", "P", "20180101", 1.0, None)
    ]
    reasons = sorted(tuple(r.reasons) for r in store.read("raw", REJECTED).collect())
    assert reasons == [
        ("Month not a int: 1.5", "Version not yyyyMMdd: 201801"),
        ("Sales _normal not a double: x", "Period not yyyy/MM: 2018-01"),
    ]


def test_parquet_files_keep_their_types_and_are_checked(spark, folder):
    rows_ = [("a", day("2018-01-01"), "1.5"), ("b", None, "x"), ("c", day("2018-01-01"), None)]
    spark.createDataFrame(rows_, "Model string, Month date, Units string").write.parquet(f"{folder}/Max capacity.parquet")
    store = Store(spark, f"{folder}/db")
    got = ingest_template(store, folder, BY_TABLE["Max capacity"], suffix=".parquet")
    assert (got.read, got.loaded, got.rejected) == (3, 2, 1)
    assert rows(store.read("raw", "Max capacity")) == [("a", day("2018-01-01"), 1.5), ("c", day("2018-01-01"), None)]


def test_headers(spark, folder):
    put(folder, "ADS.csv", "Model,Month\na,2018-01-01\n")
    with pytest.raises(ValueError, match="COGS NTD"):
        judge(read_cells(spark, f"{folder}/ADS.csv"), BY_TABLE["ADS"])
    put(folder, "empty.csv", "Month,From,To,FX\n")
    cells = judge(read_cells(spark, f"{folder}/empty.csv"), BY_TABLE["FX rate"])
    assert cells.count() == 0


def test_missing_file_stops_before_anything_is_written(spark, folder):
    put(folder, "a.csv", "x\n1\n")
    store = Store(spark, f"{folder}/db")
    with pytest.raises(FileNotFoundError, match="b"):
        ingest_all(store, folder, [Template("a", "a"), Template("b", "b")])
    assert not store.exists("raw", "a")


def test_jobs_from_files(spark):
    """All raw tables of the job tests as files, through ingest and all jobs, give the tables of the raw frames."""
    root = tempfile.mkdtemp(prefix="costloom-files-")
    plain = Store(spark, f"{root}/plain")
    fill(plain)
    plain.write(spark.createDataFrame([("a", "b")], "owner string, deadline string"), "raw", "input owner and deadline")
    for t in MANIFEST:
        df = plain.read(t.schema, t.table)
        absent = {n: F.lit(None).cast("string") for n in t.types if n not in df.columns}
        df.withColumns(absent).write.option("header", True).csv(f"{root}/in/{t.file}.csv")
    store = Store(spark, f"{root}/db")
    loaded = jobs.run_all(store, folder=f"{root}/in")
    assert {x.table: x.loaded for x in loaded} == {t.table: plain.read(t.schema, t.table).count() for t in MANIFEST}
    assert not any(x.rejected for x in loaded)
    jobs.run_all(plain)
    for table in ("perf_overview_all", "cost_overview_level1", "perf_alerts"):
        want, got = plain.read("app", table), store.read("app", table)
        assert want.count() > 0
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
