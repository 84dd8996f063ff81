"""Readers see a table before a write or after it; parts that a write doesn't touch stay where they are."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from costloom.contracts import Contract
from costloom.sources import Store
from tests.helpers import day, rows

LEVEL1 = Contract("reporting_month date, type string, oc_f double", ["type", "reporting_month"])


def frame(spark, data):
    cells = [(day(m), t, v) for m, t, v in data]
    return spark.createDataFrame(cells, "reporting_month date, type string, oc_f double")


def branches(store, df, types):
    store.write_branches(df, "app", "level1", types, LEVEL1)


def test_a_write_that_fails_between_two_branches_changes_nothing(spark, folder):
    store = Store(spark, folder)
    old = [("2018-01-01", "Actual", 1.0), ("2018-01-01", "R3M", 2.0), ("2018-02-01", "Budget", 3.0)]
    branches(store, frame(spark, old), ["Actual", "R3M", "Budget"])
    before, parts = store.read("app", "level1"), store.parts("app", "level1")
    new = frame(spark, [("2018-01-01", "Actual", 7.0), ("2018-01-01", "R3M", 8.0)])
    # The first branch can be written, the second one raises.
    stops = F.when(F.col("type") == "R3M", F.raise_error(F.lit("stopped")).cast("double")).otherwise(F.col("oc_f"))
    with pytest.raises(PySparkException, match="stopped"):
        branches(store, new.orderBy("type").withColumn("oc_f", stops), ["Actual", "R3M"])
    assert store.parts("app", "level1") == parts
    assert rows(store.read("app", "level1"), "type", "oc_f") == [("Actual", 1.0), ("Budget", 3.0), ("R3M", 2.0)]
    branches(store, new, ["Actual", "R3M"])
    assert rows(store.read("app", "level1"), "type", "oc_f") == [("Actual", 7.0), ("Budget", 3.0), ("R3M", 8.0)]
    # A frame read before goes on with the old rows, until they are cleaned away.
    assert rows(before, "type", "oc_f") == [("Actual", 1.0), ("Budget", 3.0), ("R3M", 2.0)]
    store.clean("app", "level1")
    assert store.read("app", "level1").count() == 3  # the first folder still holds Budget
    branches(store, frame(spark, [("2018-02-01", "Budget", 4.0)]), ["Budget"])
    assert len(store.clean("app", "level1")) == 1
    assert store.clean("app", "level1") == []
    assert rows(store.read("app", "level1"), "oc_f") == [(4.0,), (7.0,), (8.0,)]


def test_rows_outside_the_branches_change_nothing(spark, folder):
    store = Store(spark, folder)
    branches(store, frame(spark, [("2018-01-01", "Actual", 1.0)]), ["Actual"])
    with pytest.raises(ValueError, match="outside"):
        branches(store, frame(spark, [("2018-01-01", "Actual", 5.0), ("2018-01-01", "R3M", 5.0)]), ["Actual"])
    assert rows(store.read("app", "level1"), "oc_f") == [(1.0,)]


def test_months_are_replaced_and_others_keep_their_folders(spark, folder):
    store = Store(spark, folder)
    data = [(f"2018-0{m}-01", t, float(m)) for m in (1, 2, 3) for t in ("Actual", "R3M")]
    branches(store, frame(spark, data), ["Actual", "R3M"])
    before = store.parts("app", "level1")
    new = frame(spark, [("2018-02-01", "Actual", 9.0), ("2018-03-01", "Actual", 9.0), ("2018-02-01", "R3M", 9.0)])
    store.write_months(new, "app", "level1", ["2018-02-01", "2018-04-01"], contract=LEVEL1, types=["Actual"])
    after = store.parts("app", "level1")
    assert {p for p in after if after[p] != before[p]} == {"type=Actual/reporting_month=2018-02-01"}
    assert set(after) == set(before)
    got = {(r.type, r.reporting_month.month): r.oc_f for r in store.read("app", "level1").collect()}
    assert got == {(t, m): 9.0 if (t, m) == ("Actual", 2) else float(m) for m in (1, 2, 3) for t in ("Actual", "R3M")}
    # A month without rows goes, also when it is the last one.
    store.write_months(new.limit(0), "app", "level1", ["2018-01-01", "2018-02-01", "2018-03-01"], contract=LEVEL1)
    assert store.parts("app", "level1") == {}


def test_appends_and_tables_written_by_others(spark, folder):
    store = Store(spark, folder)
    plain = spark.createDataFrame([(1.0, "a")], "v double, k string")
    plain.write.parquet(store.path("raw", "t"))
    assert store.read("raw", "t").count() == 1
    store.write(plain, "raw", "t", mode="append")
    store.write(plain, "raw", "t", mode="append")
    assert store.read("raw", "t").count() == 3
    store.write(plain, "raw", "t")
    assert store.read("raw", "t").count() == 1
    frame(spark, [("2018-01-01", "Actual", 1.0), ("2018-02-01", "R3M", 1.0)]).write.partitionBy(
        "type", "reporting_month"
    ).parquet(store.path("app", "level1"))
    branches(store, frame(spark, [("2018-05-01", "R3M", 2.0)]), ["R3M"])
    got = rows(store.read("app", "level1"), "type", "oc_f")
    assert got == [("Actual", 1.0), ("R3M", 2.0)]


def test_truncate_keeps_columns_and_names_are_escaped(spark, folder):
    store = Store(spark, folder)
    odd = Contract("k string, v double", ["k"])
    data = spark.createDataFrame([("a/b=c %", 1.0), ("[x]*", 2.0), (None, 3.0)], "k string, v double")
    store.write(data, "app", "odd", contract=odd)
    store.write(data.filter("v = 2"), "app", "odd", mode="folders", contract=odd)
    assert rows(store.read("app", "odd")) == [(1.0, "a/b=c %"), (2.0, "[x]*"), (3.0, None)]
    store.truncate("app", "odd")
    assert store.read("app", "odd").count() == 0 and set(store.read("app", "odd").columns) == {"k", "v"}
