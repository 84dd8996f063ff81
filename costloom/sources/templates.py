"""Input templates: CSV or parquet files with the columns of the workbook templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costloom.functions.dates import parse_day
from costloom.functions.missing import col, nan_to_null_all
from costloom.sources.store import Store


@dataclass(frozen=True)
class Template:
    """One input file, the table it goes to, its date columns, and the declared types of its columns.

    `columns` names columns as they are after header cleaning; all others have type `rest`.
    `patterns` are text columns that have to parse as a date of that pattern, though they stay text.
    """

    file: str
    table: str
    dates: tuple[str, ...] = ()
    schema: str = "raw"
    columns: str = ""
    rest: str = "string"
    patterns: tuple[tuple[str, str], ...] = ()

    @property
    def types(self) -> dict[str, T.DataType]:
        """Declared columns; the ones named in `dates` are dates."""
        declared = {f.name: f.dataType for f in T.StructType.fromDDL(self.columns).fields} if self.columns else {}
        return {**dict.fromkeys(self.dates, T.DateType()), **declared}


_PL = "Year int, Month int, Period string, Site string, Project string"
_PERIOD, _VERSION = ("Period", "yyyy/MM"), ("Version", "yyyyMMdd")
_RATE = "`From` string, `To` string, FX double"

# File names, table names, column names and date columns of the input templates.
MANIFEST = [
    Template(
        "yield rate", "yield rate", ("Month",),
        columns="Model string, Month date, `Yield rate` double, yield_rate_current_target double, "
        "yield_rate_final_target double",
    ),
    Template(
        "R3M p&l", "r3m p&l", columns=f"{_PL}, Version string", rest="double", patterns=(_PERIOD, _VERSION)
    ),
    Template(
        "project info", "project info", ("MP Start", "Shipment Start"),
        columns="`Project name` string, Site string, `AllieCode Name` string, `Product Type` string, "
        "`Current stage` string, `MP Start` date, `NPI Start` date, `Shipment Start` date",
    ),
    Template(
        "budget p&l", "budget p&l", columns=f"{_PL}, Version string", rest="double", patterns=(_PERIOD, _VERSION)
    ),
    Template(
        "Actual p&l for loading history only", "actual p&l",
        columns=f"{_PL}, Version string", rest="double", patterns=(_PERIOD, _VERSION),
    ),
    Template("FX rate", "FX rate", ("Month",), columns=f"Month date, {_RATE}"),
    Template("budget_rate", "Budget_fx", columns=f"Year int, {_RATE}"),
    Template("booking_rate", "R3M_fx", ("Month",), columns=f"Month date, {_RATE}"),
    Template(
        "Scrap amount", "Scrap amount", ("Month",),
        columns="W_Model string, Month date, `Actual Scrap AMT_USD` double, scrap_rate double",
    ),
    Template("input owner and deadline", "input owner and deadline"),
    Template(
        "ADS", "ADS", ("Month",),
        columns="Model string, Month date, ADS double, `COGS NTD` double, `Inventory NTD` double, ads_target double",
    ),
    Template(
        "APR", "APR", ("Month", "Version date"),
        columns="project string, Month date, `Version date` date, `APR _volume` double",
    ),
    Template(
        "accounting item mapping", "accounting item mapping",
        columns="accounting_item_code string, accounting_item_desc string",
    ),
    Template(
        "actual p&l to standard line item names mapping", "raw_line_items_map",
        columns="variable string, accounting_item_desc string, accounting_item_group string",
    ),
    Template("health_score_weights", "health_score_weights", columns="idx string, weight double"),
    Template(
        "line_item_to_app_item", "line_item_merge_map", columns="accounting_item_desc string, app_item string"
    ),
    Template("param_control", "param_control", ("date",), columns="param string, value double, date date"),
    Template(
        "SDBG cost item list", "tbl_cost_control_list", schema="dim",
        columns="bg string, line_item string, line_itm_group string, detailed_item string, "
        "`Frontnend_name level 1` string",
    ),
    Template(
        "app_cost_category", "cost_category", schema="app",
        columns="cost_cat_code string, cost_cat_name string, non_adj_flag int",
    ),
    Template(
        "MPS", "MPS", ("Month",), columns="project string, Month date, `MPS _volume` double"
    ),
    Template("Max capacity", "Max capacity", ("Month",), columns="Model string, Month date, Units double"),
    Template("quote p&l", "quote p&l", columns=_PL, rest="double", patterns=(_PERIOD,)),
]


def clean_headers(df: DataFrame) -> DataFrame:
    """Column names without brackets: '(' becomes '_' and ')' goes."""
    return df.toDF(*[c.replace("(", "_").replace(")", "") for c in df.columns])


def read_template(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    dates: tuple[str, ...] = (),
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """A template as a table: dates parsed, headers cleaned, columns renamed, NaN as null.

    A CSV file should come with a schema; without one all its columns are text. Date columns
    given as text are read as yyyy-MM-dd.
    """
    if path.endswith(".csv"):
        reader = spark.read.option("header", True)
        df = (reader.schema(schema) if schema else reader).csv(path)
    else:
        df = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parsed = {
        d: parse_day(col(d)) if isinstance(kinds[d], T.StringType) else col(d).cast("date")
        for d in dates
    }
    df = nan_to_null_all(clean_headers(df.withColumns(parsed)))
    return df.withColumnsRenamed(rename or {})


def load_template(
    store: Store,
    folder: str,
    template: Template,
    schema: T.StructType | str | None = None,
    rename: dict[str, str] | None = None,
    suffix: str = ".csv",
) -> None:
    """Read one template file and append it to its table."""
    path = f"{folder.rstrip('/')}/{template.file}{suffix}"
    df = read_template(store.spark, path, schema, template.dates, rename)
    store.write(df, template.schema, template.table, mode="append")


def load_all(
    store: Store,
    folder: str,
    manifest: list[Template] | None = None,
    schemas: dict[str, str] | None = None,
    suffix: str = ".csv",
) -> None:
    """Load every template of the manifest."""
    for template in manifest or MANIFEST:
        load_template(store, folder, template, (schemas or {}).get(template.table), suffix=suffix)


def lit_rows(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    """A small reference table written in code, such as a map or a list of weights."""
    schema = T.StructType.fromDDL(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    cells = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))
