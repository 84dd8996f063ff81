"""Stores, contracts and templates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costloom.contracts import TABLES, conform, level1_contract
from costloom.sources import MANIFEST, Store, Template, clean_headers, read_template
from costloom.sources.templates import lit_rows, load_all
from tests.helpers import day, rows


def test_conform(spark):
    schema = TABLES["staging.fx_rate"].schema
    df = spark.createDataFrame([(1, "2018-01-01", "USD", "NTD", 30, "x")], "id int, Month string, `From` string, `To` string, FX int, note string")
    out = conform(df, schema)
    assert out.schema.simpleString() == schema.simpleString()
    assert rows(out) == [(day("2018-01-01"), "USD", "NTD", 30.0)]
    with pytest.raises(ValueError, match="FX"):
        conform(df.drop("FX"), schema)
    assert rows(conform(df.drop("FX"), schema, ("FX",)), "FX") == [(None,)]


def test_every_contract_parses(spark):
    for contract in TABLES.values():
        assert [f.name for f in contract.schema.fields] == contract.names
        assert set(contract.partition_by) <= set(contract.names)


def test_replace_and_append(spark, folder):
    store = Store(spark, folder)
    data = [(day("2018-01-01"), "a", 1.0), (day("2018-02-01"), "b", float("inf"))]
    ledger = spark.createDataFrame(data, "reporting_month date, line_item string, value double")
    filled = TABLES["staging.tbl_is_modeltype"].names
    ledger = ledger.withColumns({n: F.lit(None).cast("string") for n in filled if n not in ledger.columns and n not in ("type", "version", "fx_rate")})
    ledger = ledger.withColumns({"type": F.lit("Actual"), "version": F.col("reporting_month"), "fx_rate": F.lit(1.0)})
    store.write(ledger, "staging", "tbl_is_modeltype")
    store.write(ledger.filter("line_item = 'a'").withColumn("value", F.lit(5.0)), "staging", "tbl_is_modeltype", mode="folders")
    assert rows(store.read("staging", "tbl_is_modeltype"), "line_item", "value") == [("a", 5.0), ("b", None)]
    store.write(ledger, "staging", "tbl_is_modeltype", mode="append")
    assert store.read("staging", "tbl_is_modeltype").count() == 4
    store.write(ledger.filter("line_item = 'b'"), "staging", "tbl_is_modeltype")
    assert rows(store.read("staging", "tbl_is_modeltype"), "line_item") == [("b",)]  # the other month is gone
    store.truncate("staging", "tbl_is_modeltype")
    assert store.read("staging", "tbl_is_modeltype").count() == 0


def test_nan_becomes_null_on_read(spark, folder):
    store = Store(spark, folder)
    spark.createDataFrame([(float("nan"), 7)], "v double, id int").write.parquet(store.path("raw", "x"))
    assert rows(store.read("raw", "x")) == [(None,)]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`a(b)` int, `c` int")
    assert clean_headers(df).columns == ["a_b", "c"]


def test_templates(spark, folder):
    with open(f"{folder}/FX rate.csv", "w") as f:
        f.write("Month,From,To,FX(mid)\n2018-01-01,USD,NTD,30.5\n2018-02-01,USD,NTD,\nbad,USD,NTD,1\n")
    schema = "Month string, `From` string, `To` string, `FX(mid)` double"
    df = read_template(spark, f"{folder}/FX rate.csv", schema, ("Month",), {"FX_mid": "FX"})
    assert df.columns == ["Month", "From", "To", "FX"]
    assert [(r.Month, r.FX) for r in df.collect()] == [(day("2018-01-01"), 30.5), (day("2018-02-01"), None), (None, 1.0)]
    store = Store(spark, f"{folder}/db")
    manifest = [Template("FX rate", "FX rate", ("Month",))]
    for _ in range(2):
        load_all(store, folder, manifest, {"FX rate": schema})
    assert store.read("raw", "FX rate").count() == 6


def test_manifest_names_each_table():
    tables = [(t.schema, t.table) for t in MANIFEST]
    assert len(tables) == len(set(tables)) == 22


def test_lit_rows(spark):
    assert rows(lit_rows(spark, "a string, b double", [("x", None), ("y", 2.0)])) == [("x", None), ("y", 2.0)]
    assert lit_rows(spark, "a string", []).count() == 0


def test_branches_are_replaced_whole(spark, folder):
    store, contract = Store(spark, folder), level1_contract(["oc_f"])
    ddl = "bg string, cat_ind string, oc_f double, standard string, type string, reporting_month date"
    missing = tuple(f.name for f in contract.schema if f.name not in ddl)

    def write(data, types):
        rows = [("SDBG", "ALL", 1.0, "shipment", t, day(m)) for t, m in data]
        store.write_branches(spark.createDataFrame(rows, ddl), "app", "level1", types, contract, missing)

    write([("Actual", "2018-01-01"), ("Actual", "2018-02-01"), ("R3M", "2018-01-01")], ["Actual", "R3M"])
    write([("PredictES", "2018-03-01")], ["PredictES"])
    write([("Actual", "2018-02-01")], ["Actual", "R3M"])
    got = {(r.type, str(r.reporting_month)) for r in store.read("app", "level1").collect()}
    assert got == {("Actual", "2018-02-01"), ("PredictES", "2018-03-01")}
    with pytest.raises(ValueError):
        write([("Budget", "2018-01-01")], ["Actual"])
