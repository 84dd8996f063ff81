"""Queries of the sources: typed ingest, lookups that repeat rows, replaced branches, changed months."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.checks.domain import Domain
from costloom.checks.registry import query
from costloom.contracts import Contract
from costloom.functions.dates import month_start
from costloom.operators.joins import left_lookup
from costloom.operators.watch import LookupWatch
from costloom.plans.incremental import fingerprint
from costloom.session import ensure_checkpoint_dir
from costloom.sources import Store
from costloom.sources.ingest import REJECTED, ingest_template
from costloom.sources.templates import Template

MONTHLY = Contract("reporting_month date, type string, n long, total double", ["type", "reporting_month"])


def _store(d: Domain) -> Store:
    """A store in a fresh folder of the place that every executor can reach."""
    return Store(d.spark, f"{ensure_checkpoint_dir(d.spark).rstrip('/')}/costloom-{uuid.uuid4().hex}")


@query(
    "ingest_rejects",
    "IO1 IO3",
    """
WITH cells AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 5 = 0 THEN ''
      ELSE strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS month,
    CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS units
  FROM orders)
SELECT 'loaded' AS state, coalesce(month, '') AS label, count(*) AS n, sum(CAST(units AS DOUBLE)) AS units
FROM cells WHERE month <> 'n/a' AND units <> 'x' GROUP BY month
UNION ALL
SELECT 'rejected', concat_ws(', ', CASE WHEN month = 'n/a' THEN 'Month not a date: n/a' END,
  CASE WHEN units = 'x' THEN 'Units not a double: x' END), count(*), NULL
FROM cells WHERE month = 'n/a' OR units = 'x' GROUP BY month = 'n/a', units = 'x', 2
UNION ALL
SELECT 'read', '', count(*), NULL FROM cells
""",
)
def ingest_rejects(d: Domain) -> DataFrame:
    """Load a template file of all orders with bad dates and numbers: every row is loaded or rejected, with a reason."""
    store = _store(d)
    key = F.col("o_orderkey")
    month = F.date_format(month_start(F.col("o_orderdate")), "yyyy-MM-dd")
    units = F.floor("o_totalprice").cast("long").cast("string")
    d.table("orders").select(
        F.when(key % 7 == 0, "n/a").when(key % 5 != 0, month).alias("Month"),
        key.cast("string").alias("Model"),
        F.when(key % 11 == 0, "x").otherwise(units).alias("Units"),
    ).write.option("header", True).csv(f"{store.root}/in/Max capacity.csv")
    template = Template("Max capacity", "Max capacity", columns="Month date, Model string, Units double")
    counts = ingest_template(store, f"{store.root}/in", template)
    loaded = store.read("raw", "Max capacity").groupBy(
        F.lit("loaded").alias("state"), F.coalesce(F.col("Month").cast("string"), F.lit("")).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("Units").alias("units"))
    rejected = store.read("raw", REJECTED).groupBy(
        F.lit("rejected").alias("state"), F.array_join("reasons", ", ").alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))
    read = d.spark.range(1).select(F.lit("read").alias("state"), F.lit("").alias("label"), F.lit(counts.read).cast("long").alias("n"))
    return loaded.unionByName(rejected, True).unionByName(read, True)


@query(
    "lookup_guard",
    "J2 J24",
    """
WITH dim AS (SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1),
joined AS (SELECT c.c_custkey FROM customer c LEFT JOIN dim ON c.c_nationkey = n_nationkey)
SELECT 'nation_of: c_nationkey' AS lookup, (SELECT count(*) FROM customer) AS rows_before,
  (SELECT count(*) FROM joined) AS rows_after, concat(n_nationkey, ' (2 rows)') AS repeated_key
FROM nation WHERE n_regionkey = 1
""",
)
def lookup_guard(d: Domain) -> DataFrame:
    """A lookup table with some keys twice: rows before and after the lookup, and the keys that repeat."""
    store = _store(d)
    nation = d.table("nation")
    dim = nation.unionByName(nation.filter("n_regionkey = 1"))
    with LookupWatch() as watch:
        placed = left_lookup(d.table("customer"), dim, "c_nationkey", "n_nationkey", ["n_name"], "nation_of")
        store.write(placed, "staging", "customers")
    rows = [(r.lookup, r.rows_before, r.rows_after, r.repeated_keys) for r in watch.report()]
    report = d.spark.createDataFrame(rows, "lookup string, rows_before long, rows_after long, keys array<string>")
    return report.select("lookup", "rows_before", "rows_after", F.explode("keys").alias("repeated_key"))


def _monthly(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("reporting_month", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "branch_replace",
    "IO6",
    """
SELECT reporting_month, type, count(*) AS n, sum(value) * CASE WHEN type = 'Budget' THEN 2 ELSE 1 END AS total
FROM ledger WHERE type <> 'Budget' OR month(reporting_month) <= 6 GROUP BY reporting_month, type
""",
)
def branch_replace(d: Domain) -> DataFrame:
    """One type of a stored table is replaced, months without new rows go; a refused write changes nothing."""
    store = _store(d)
    store.write_branches(_monthly(d.ledger), "app", "monthly", ["Actual", "Budget", "R3M"], MONTHLY)
    rows = store.read("app", "monthly")
    new = rows.filter("type = 'Budget' AND month(reporting_month) <= 6").withColumn("total", F.col("total") * 2)
    store.write_branches(new, "app", "monthly", ["Budget"], MONTHLY)
    try:
        store.write_branches(rows.withColumn("total", F.lit(0.0)), "app", "monthly", ["R3M"], MONTHLY)
    except ValueError:
        return store.read("app", "monthly")
    raise AssertionError("rows outside the branch were accepted")


@query(
    "changed_months",
    "G7 G8",
    """
WITH now AS (SELECT reporting_month, type, product, line_item,
    value + CASE WHEN month(reporting_month) = 3 AND type = 'R3M' THEN 1 ELSE 0 END AS value
  FROM ledger WHERE NOT (month(reporting_month) = 7 AND year(reporting_month) = 1997))
SELECT n.reporting_month, n.type, count(*) AS n, sum(n.value) AS total,
  month(n.reporting_month) = 3 AND EXISTS (SELECT 1 FROM ledger l WHERE l.type = 'R3M' AND l.reporting_month = n.reporting_month) AS moved
FROM now n GROUP BY n.reporting_month, n.type
""",
)
def changed_months(d: Domain) -> DataFrame:
    """Fingerprints find the months that changed; only these are computed again, and only their folders move."""
    store = _store(d)
    ledger = d.ledger.select("reporting_month", "type", "product", "line_item", "value")
    march = (F.month("reporting_month") == 3) & (F.col("type") == "R3M")
    july = (F.month("reporting_month") == 7) & (F.year("reporting_month") == 1997)
    now = ledger.filter(~july).withColumn("value", F.col("value") + F.when(march, 1).otherwise(0))
    store.write(_monthly(ledger), "app", "monthly", contract=MONTHLY)
    before = store.parts("app", "monthly")
    month = F.col("reporting_month")
    old, new = (fingerprint(df, "ledger", month).select("month", "n", "total", "parity") for df in (ledger, now))
    changed = old.exceptAll(new).unionByName(new.exceptAll(old)).select("month").distinct().collect()
    store.write_months(_monthly(now), "app", "monthly", [r[0].isoformat() for r in changed], contract=MONTHLY)
    after = store.parts("app", "monthly")
    moved = sorted(p.split("reporting_month=")[1] for p in after if after[p] != before.get(p))
    return store.read("app", "monthly").withColumn("moved", F.col("reporting_month").cast("string").isin(moved))
