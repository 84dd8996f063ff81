"""Loading template files with declared types; rows that don't fit go to a table of their own, with file and reason.

CSV cells are read as text, in Spark's permissive mode, with the corrupt-record column for lines of another
number of fields; each cell is then cast to its template's type. A row with a cell that can't be cast, or with
a wrong number of fields, is rejected as a whole and kept as text. So every row of a file is in its table or among
the rejected rows. Blank cells and NaN are missing values, which is no reason to reject.

The counts are observed while the accepted rows are written: a file without rejected rows is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costloom.functions.missing import col
from costloom.sources.store import Store
from costloom.sources.templates import MANIFEST, Template, clean_headers

REJECTED = "rejected rows"
_FILE, _CORRUPT, _REASONS, _RECORD = "_file", "_corrupt", "_reasons", "_record"
#: Cells that stand for a missing value, in lower case.
MISSING = ("", "nan")


@dataclass(frozen=True)
class Loaded:
    """Rows read from a template file, rows in its table, rows rejected."""

    table: str
    read: int
    loaded: int
    rejected: int


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a CSV file as text with clean headers, the file, and the line if its number of fields is wrong.

    Parquet files keep their types. A folder of CSV files has to have one header; another one is an error.
    """
    if not path.endswith(".csv"):
        cells = clean_headers(spark.read.parquet(path).withColumn(_FILE, F.col("_metadata.file_path")))
        return cells.withColumn(_CORRUPT, F.lit(None).cast("string"))
    names = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    reader = spark.read.schema(text).options(
        header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, enforceSchema=False, escape='"',
        # Pruned columns would hide lines with a wrong number of fields.
        columnPruning=False,
    )
    return clean_headers(reader.csv(path).withColumn(_FILE, F.col("_metadata.file_path")))


def _cast(cell: Column, kind: T.DataType) -> Column:
    """A text cell as a value of the type; null if it isn't one."""
    if isinstance(kind, T.DateType):
        return F.coalesce(F.try_to_date(cell, "yyyy-MM-dd"), F.try_to_date(cell, "yyyy-MM-dd HH:mm:ss"))
    if isinstance(kind, T.IntegralType):
        number = cell.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, T.FractionalType):
        number = cell.try_cast(kind)
        return F.when(~F.isnan(number) & (F.abs(number.cast("double")) < float("inf")), number)
    return cell.try_cast(kind)


def _text(name: str, kind: T.DataType) -> Column:
    """A cell as text; null if it stands for a missing value."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col(name), "yyyy-MM-dd HH:mm:ss")
    text = F.trim(col(name).cast("string"))
    return F.when(~F.lower(text).isin(*MISSING), text)


def judge(cells: DataFrame, template: Template) -> DataFrame:
    """Cells in their declared types, with file, reasons to reject (empty for a good row) and the row as text."""
    given = {f.name: f.dataType for f in cells.schema.fields if f.name not in (_FILE, _CORRUPT)}
    types, rest = template.types, T.StructType.fromDDL(f"x {template.rest}")[0].dataType
    absent = [n for n in types if n not in given]
    if absent:
        raise ValueError(f"template {template.file}: columns missing: {', '.join(absent)}")
    values: dict[str, Column] = {}
    reasons = [F.when(F.col(_CORRUPT).isNotNull(), F.lit("wrong number of fields"))]
    for name, kind in given.items():
        wanted = types.get(name, rest)
        text = _text(name, kind)
        if isinstance(wanted, T.StringType):
            values[name] = F.when(text.isNotNull(), col(name).cast("string"))
            continue
        value = col(name) if kind == wanted and not isinstance(kind, T.FractionalType) else _cast(text, wanted)
        values[name] = value
        reasons.append(_reason(name, f"not a {wanted.simpleString()}", text, value))
    for name, pattern in template.patterns:
        if name in given:
            text = _text(name, given[name])
            reasons.append(_reason(name, f"not {pattern}", text, F.try_to_date(text, pattern)))
    row = F.to_csv(F.struct(*[col(n).cast("string").alias(n) for n in given]))
    return cells.select(
        *[v.alias(n) for n, v in values.items()],
        _FILE,
        F.array_compact(F.array(*reasons)).alias(_REASONS),
        F.coalesce(_CORRUPT, row).alias(_RECORD),
    )


def _reason(name: str, what: str, text: Column, value: Column) -> Column:
    return F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{name} {what}: "), text))


def rejected_rows(judged: DataFrame, template: Template) -> DataFrame:
    """The rows that don't fit: table, file, reasons, record."""
    return judged.filter(F.size(_REASONS) > 0).select(
        F.lit(template.table).alias("table_name"),
        F.col(_FILE).alias("file"),
        F.col(_REASONS).alias("reasons"),
        F.col(_RECORD).alias("record"),
    )


def ingest_template(
    store: Store,
    folder: str,
    template: Template,
    rename: dict[str, str] | None = None,
    suffix: str = ".csv",
    mode: str = "append",
) -> Loaded:
    """Load one template file: good rows to its table, the others to `rejected rows`."""
    path = f"{folder.rstrip('/')}/{template.file}{suffix}"
    judged = judge(read_cells(store.spark, path), template)
    seen = Observation()
    bad = F.size(_REASONS) > 0
    counted = judged.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("rejected"))
    good = counted.filter(~bad).drop(_FILE, _REASONS, _RECORD)
    store.write(good.withColumnsRenamed(rename or {}), template.schema, template.table, mode=mode)
    counts = seen.get
    if counts["rejected"]:
        store.write(rejected_rows(judged, template), "raw", REJECTED, mode="append")
    return Loaded(template.table, counts["read"], counts["read"] - counts["rejected"], counts["rejected"])


def ingest_all(
    store: Store,
    folder: str,
    manifest: list[Template] | None = None,
    suffix: str = ".csv",
    mode: str = "append",
) -> list[Loaded]:
    """Load every template of the manifest. Files that are missing stop the load before anything is written."""
    manifest = manifest or MANIFEST
    files = {t.file: f"{folder.rstrip('/')}/{t.file}{suffix}" for t in manifest}
    absent = [f for f, path in files.items() if not store.files.exists(path)]
    if absent:
        raise FileNotFoundError(f"templates missing in {folder}: {', '.join(absent)}")
    if mode == "replace" and store.exists("raw", REJECTED):
        store.truncate("raw", REJECTED)
    return [ingest_template(store, folder, t, suffix=suffix, mode=mode) for t in manifest]
