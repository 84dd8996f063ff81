"""Tables as parquet folders {root}/{schema}/{table}.

Rows never lie in the table's folder itself: each write makes a folder of its own (`_rows-...`) below it, and a
pointer file (`_current.json`) names, for each partition, the folders that hold its rows. The pointer is moved
into place last, as one small file, so a reader sees a table before a write or after it, and a write that fails
changes nothing. Frames read before a write go on reading the old folders; `clean` removes those.

With `buckets` the tables that are joined on month and product are stored in buckets by product inside each month, and
read as such: Spark then joins and groups them by product, or by month and product, without moving them.

A table has one writer at a time. A folder without a pointer, written by something else, is read as it is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costloom.contracts import TABLES, Contract, conform
from costloom.functions.missing import inf_to_null_all, nan_to_null_all
from costloom.sources.files import Files

POINTER = "_current.json"
#: Partition path, such as `type=Actual/reporting_month=2018-01-01`, to the folders with its rows.
Parts = dict[str, list[str]]
#: Name of a written folder that the table had before it was a store's table.
_OUTSIDE = "."
#: Folder value of a missing partition value.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _cells(part: str) -> dict[str, str]:
    """Column and value of each level of a partition path."""
    pairs = [level.split("=", 1) for level in part.split("/") if level]
    return {name: unquote(value) for name, value in pairs}


def _spec(part: str) -> str:
    """A partition path as a partition in SQL."""
    cells = _cells(part).items()
    quoted = {n: "null" if v == _NULL else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for n, v in cells}
    return "PARTITION (" + ", ".join(f"`{n}` = {v}" for n, v in quoted.items()) + ")"


class Store:
    """Reads and writes the tables of one root folder.

    Any file system that Spark can reach will do. A relational source can be read instead with
    Spark's own `spark.read.jdbc`; the operators only take DataFrames.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self.buckets = buckets
        if buckets:
            # Buckets by product serve joins on month and product.
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table.replace(' ', '_').replace('&', 'and')}"

    def _pointer(self, schema: str, table: str) -> dict | None:
        text = self.files.text(f"{self.path(schema, table)}/{POINTER}")
        return json.loads(text) if text is not None else None

    def parts(self, schema: str, table: str) -> Parts:
        """Partitions of a table and the folders that hold their rows; empty without a pointer."""
        return (self._pointer(schema, table) or {"parts": {}})["parts"]

    def exists(self, schema: str, table: str) -> bool:
        return self.files.exists(self.path(schema, table))

    def read(self, schema: str, table: str) -> DataFrame:
        """A whole table, without its surrogate id. NaN becomes null here.

        A table with a contract is read with its declared schema, so no file is opened to learn it.
        """
        path, contract, pointer = self.path(schema, table), TABLES.get(f"{schema}.{table}"), self._pointer(schema, table)
        declared = contract.schema if contract else None
        if pointer is None:
            reader = self.spark.read.schema(declared) if declared else self.spark.read
            return nan_to_null_all(reader.parquet(path).drop("id"))
        kind = declared or T.StructType.fromJson(pointer["schema"])
        if self.buckets and contract:
            rows = self._bucketed(path, pointer, kind, contract.partition_by)
            if rows is not None:
                return nan_to_null_all(rows.drop("id"))
        of_folder: dict[str, list[str]] = {}
        for part, folders in pointer["parts"].items():
            for folder in folders:
                of_folder.setdefault(folder, []).append(part)
        frames = []
        for folder, live in sorted(of_folder.items()):
            base = path if folder == _OUTSIDE else f"{path}/{folder}"
            reader = self.spark.read.schema(kind)
            if len(live) == pointer["sizes"][folder]:
                frames.append(reader.parquet(base))
            else:
                frames.append(reader.option("basePath", base).parquet(*[f"{base}/{p}" for p in sorted(live)]))
        if not frames:
            return self.spark.createDataFrame([], kind).drop("id")
        return nan_to_null_all(reduce(DataFrame.unionByName, frames).drop("id"))

    def _publish(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        split: list[str],
        merge: Callable[[Parts, Parts], Parts],
    ) -> None:
        """Write rows to a folder of their own, then move the pointer to `merge(old parts, new parts)`."""
        path, folder = self.path(schema, table), f"_rows-{uuid.uuid4().hex}"
        known = TABLES.get(f"{schema}.{table}")
        bucket = known.bucket_by if known and self.buckets else None
        if bucket:
            # One task per bucket, so a month has one file per bucket.
            rows = df.repartition(self.buckets, F.col(bucket)).write.partitionBy(*split)
            rows = rows.bucketBy(self.buckets, bucket).sortBy(bucket).option("path", f"{path}/{folder}")
            rows.saveAsTable(f"costloom{folder.replace('-', '_')}")
            self.spark.sql(f"DROP TABLE costloom{folder.replace('-', '_')}")  # the files stay
        else:
            if split:
                # Spark sizes the output by folder at run time: small ones are merged, large ones cut.
                df = df.hint("rebalance", *[F.col(c) for c in split])
            df.write.partitionBy(*split).parquet(f"{path}/{folder}")
        new = dict.fromkeys(self.files.below(f"{path}/{folder}", len(split)), [folder])
        old = self._pointer(schema, table) or self._outside(path, split)
        parts = merge(old["parts"], new)
        used = {f for folders in parts.values() for f in folders}
        sizes = {f: n for f, n in {**old["sizes"], folder: len(new)}.items() if f in used}
        buckets = {f: b for f, b in old.get("buckets", {}).items() if f in used}
        if bucket:
            buckets[folder] = [self.buckets, bucket]
        pointer = {"schema": df.schema.jsonValue(), "parts": parts, "sizes": sizes, "buckets": buckets}
        self.files.replace_text(f"{path}/{POINTER}", json.dumps(pointer))

    def _bucketed(self, path: str, pointer: dict, kind: T.StructType, split: list[str]) -> DataFrame | None:
        """A table whose rows all lie in equal buckets, as a table of the session's catalog.

        Its partitions are where the pointer says, so months written at different times are still one table. None if
        the table isn't of that kind, or if rows were appended to a partition.
        """
        specs = {tuple(pointer.get("buckets", {}).get(f, ())) for folders in pointer["parts"].values() for f in folders}
        if len(specs) != 1 or specs == {()} or any(len(folders) > 1 for folders in pointer["parts"].values()):
            return None
        ((buckets, bucket),) = specs
        name = "costloom_" + hashlib.sha256(f"{path} {json.dumps(pointer['parts'], sort_keys=True)}".encode()).hexdigest()[:32]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)
            parts = [f"{_spec(p)} LOCATION '{path}/{folders[0]}/{p}'" for p, folders in sorted(pointer["parts"].items())]
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(split)}) "
                f"CLUSTERED BY (`{bucket}`) SORTED BY (`{bucket}`) INTO {buckets} BUCKETS LOCATION '{path}/_none'"
            )
            for at in range(0, len(parts), 500):
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts[at : at + 500])}")
        return self.spark.table(name)

    def _outside(self, path: str, split: list[str]) -> dict:
        """Pointer of a folder that something else has written; without parts if there is none."""
        if not any(not n.startswith(("_", ".")) for n in self.files.names(path)):
            return {"parts": {}, "sizes": {}}
        parts = self.files.below(path, len(split))
        return {"parts": {p: [_OUTSIDE] for p in parts}, "sizes": {_OUTSIDE: len(parts)}}

    def _shaped(
        self, df: DataFrame, schema: str, table: str, contract: Contract | None, optional: tuple[str, ...]
    ) -> tuple[DataFrame, list[str]]:
        contract = contract or TABLES.get(f"{schema}.{table}")
        if not contract:
            return inf_to_null_all(df), []
        return inf_to_null_all(conform(df, contract.schema, optional)), contract.partition_by

    def write(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        mode: str = "replace",
        contract: Contract | None = None,
        optional: tuple[str, ...] = (),
    ) -> None:
        """Store rows in the table's declared shape; infinities become null.

        `replace` replaces the whole table, also months and types that have no rows any more.
        `folders` replaces only the partitions (months, types) that the rows belong to, for tables
        that several steps fill. `append` adds rows.
        """
        merges: dict[str, Callable[[Parts, Parts], Parts]] = {
            "replace": lambda old, new: new,
            "folders": lambda old, new: {**old, **new},
            "append": lambda old, new: {p: old.get(p, []) + new.get(p, []) for p in {**old, **new}},
        }
        rows, split = self._shaped(df, schema, table, contract, optional)
        self._publish(rows, schema, table, split, merges[mode])

    def write_branches(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        values: list[str],
        contract: Contract,
        optional: tuple[str, ...] = (),
    ) -> None:
        """Replace the branches `values` of a table's first partition column; other branches stay.

        For tables that several steps fill: each step replaces its own types as a whole, also months
        that have no rows any more, and all of them at once. Rows outside `values` are an error.
        """
        branch = contract.partition_by[0]

        def merge(old: Parts, new: Parts) -> Parts:
            if {_cells(p)[branch] for p in new} - set(values):
                raise ValueError(f"{schema}.{table}: rows outside the branches {values}")
            return {p: f for p, f in old.items() if _cells(p)[branch] not in values} | new

        rows, split = self._shaped(df, schema, table, contract, optional)
        self._publish(rows, schema, table, split, merge)

    def write_months(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        months: Iterable[str],
        month: str = "reporting_month",
        contract: Contract | None = None,
        optional: tuple[str, ...] = (),
        types: Iterable[str] | None = None,
    ) -> None:
        """Replace the months given (as yyyy-MM-dd), also those that have no rows any more; the others stay.

        Rows of other months are left out; the filter reaches the scans behind `df` where the plan allows it.
        `types` limits the replacement to some types of a table that is split by type, too.
        """
        wanted, kinds = sorted(set(months)), None if types is None else set(types)
        rows, split = self._shaped(df, schema, table, contract, optional)

        def mine(part: str) -> bool:
            cells = _cells(part)
            return cells[month] in wanted and (kinds is None or cells["type"] in kinds)

        def merge(old: Parts, new: Parts) -> Parts:
            return {p: f for p, f in old.items() if not mine(p)} | new

        picked = rows.filter(F.col(month).isin([F.lit(m).cast("date") for m in wanted]))
        if kinds is not None:
            picked = picked.filter(F.col("type").isin(sorted(kinds)))
        self._publish(picked, schema, table, split, merge)

    def copy(self, table: str, target: str) -> None:
        """raw to staging, projected onto the target's columns."""
        self.write(self.read("raw", table), "staging", target)

    def truncate(self, schema: str, table: str) -> None:
        """Remove all rows and keep the columns."""
        contract = TABLES.get(f"{schema}.{table}")
        pointer = self._pointer(schema, table)
        kind = contract.schema if contract else None
        if kind is None:
            kind = T.StructType.fromJson(pointer["schema"]) if pointer else self.read(schema, table).schema
        empty = {"schema": kind.jsonValue(), "parts": {}, "sizes": {}}
        self.files.replace_text(f"{self.path(schema, table)}/{POINTER}", json.dumps(empty))

    def clean(self, schema: str, table: str) -> list[str]:
        """Remove the written folders that the pointer doesn't name; returns their names.

        Frames read before a later write lose their files, so nothing may be reading then.
        """
        path, pointer = self.path(schema, table), self._pointer(schema, table)
        if pointer is None:
            return []
        live = {f for folders in pointer["parts"].values() for f in folders}
        old = [n for n in self.files.names(path) if n.startswith("_rows-") and n not in live]
        for name in old:
            self.files.remove(f"{path}/{name}")
        return old
