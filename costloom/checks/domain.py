"""Domain tables derived by Spark from the shared test tables.

Brands form eight families; a family and a part type make a product. Line items are its monthly bookings (return flag = type,
line status = shipped or produced). Amounts are whole cents and rates are binary fractions, so
sums do not depend on their order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import month_start
from costloom.operators import fx
from costloom.operators.lookups import forecast_versions
from costloom.session import settle
from costloom.sources.templates import lit_rows

# First year of the tables, and the year that the queries on the first-year filter start with.
EARLIEST, FIRST_YEAR = 1992, 1996
# Budget and rolling forecast run this many months ahead of Actual, so plans exist after its latest month.
AHEAD = 6

# Ledger items: name, group, source column.
ITEMS = [
    ("Sales_Normal shipment", "Sales", "ship_rev"),
    ("Sales_Sales return & allowance", "Sales", "ret"),
    ("Material cost_Standard", "Material cost", "mat"),
    ("Material cost_Purchase price variance", "Material cost", "ppv"),
    ("Material cost_Material usage variance", "Material cost", "muv"),
    ("Freight", "Other cost", "frt"),
    ("SGA", "OPEX", "sga"),
    ("MOH total", "MOH", "idl"),
    ("Invoice quantity", None, "inv_q"),
    ("Production quantity", None, "prod_q"),
    ("Unmapped", "Other cost", "elec"),
]

# Raw profit-and-loss columns: name, source column, description, group.
RAW_COLUMNS = [
    (K.SHIPPED_UNITS, "inv_q", "Invoice quantity", None),
    (K.INVOICED_UNITS, "all_q", None, None),
    ("Sales normal", "ship_rev", "Sales_Normal shipment", "Sales"),
    ("Std material", "mat", "Material cost_Standard", "Material cost"),
    ("PPV", "ppv", "Material cost_Purchase price variance", "Material cost"),
    ("Dep", "dep", "Depreciation-W-buy", None),
    ("IDL cost", "idl", "IDL", None),
    ("Elec", "elec", " Electricity&Water", None),
    ("Prod qty", "prod_q", "Production quantity", None),
]

MERGE_MAP = [
    ("Sales_Normal shipment", "revenue"),
    ("Sales_Sales return & allowance", "revenue"),
    ("Material cost_Standard", "material_cost"),
    ("Material cost_Purchase price variance", "material_cost"),
    ("Material cost_Material usage variance", "material_cost"),
    ("Freight", "freight_old"),
    ("Freight", "other_cost"),
    ("SGA", "opex"),
    ("MOH total", "moh"),
    ("Invoice quantity", "shipment_volume"),
    ("Production quantity", "production_volume"),
]

# Cost list: bg, first-level item, group, second-level item, short name.
CONTROL = [
    ("SDBG", "Freight", "Other cost", "Freight", "Freight"),
    ("SDBG", "SGA", "OPEX", "Selling", "SG&A"),
    ("SDBG", "SGA", "OPEX", "General", "SG&A"),
    ("SDBG", "Material cost_Standard", "Material", "Material cost_Standard", "Material"),
    ("SDBG", "Material cost_Purchase price variance", "Material", "Material cost_Purchase price variance", "PPV"),
    ("SDBG", "MOH_WMI", "MOH", "IDL", "MOH"),
    ("SDBG", "MOH_WMI", "MOH", "Depreciation-W-buy", "MOH"),
    ("SDBG", "MOH_WEKS", "MOH", "IDL", "MOH"),
    ("SDBG", "MOH_WEKS", "MOH", "other utilities", "MOH"),
    ("XXBG", "Freight", "Other cost", "Air", "Freight"),
]

CATEGORIES = [
    ("oc_freight", "Freight", 0),
    ("opex_sga", "SGA", 1),
    ("mc_std", "Material cost_Standard", 0),
    ("mc_ppv", "Material cost_Purchase price variance", 0),
    ("moh_wmi", "MOH_WMI", 1),
    ("moh_weks", "MOH_WEKS", 0),
]
CODES = sorted(c for c, _, _ in CATEGORIES)
GROUPS = ["ucg_mat", "ucg_moh", "ucg_opex", "ucg_other"]

WEIGHTS = [
    ("shipment/apr", 0.25),
    ("production/apr", 0.25),
    ("moh/quote", 0.125),
    ("ads/ads_target", 0.125),
    ("yield/yield_target", 0.125),
    ("material/m_target", 0.125),
]

PARAMS = [
    ("scrap_target", 0.5, "1995-01-01"),
    ("scrap_target", 0.015625, "2000-01-01"),
    ("corp_funding_rate", 0.25, "1996-01-01"),
    ("corp_funding_rate", 0.125, "1999-06-01"),
    ("unused", 1.0, "1999-06-01"),
]


def family() -> Column:
    return F.pmod(F.substring("p_brand", 7, 9).cast("int"), F.lit(8))


def product_name() -> Column:
    return F.concat(F.lit("P"), F.col("family").cast("string"), F.lit("-"), F.col("p_type"))


class Domain:
    """Lazy frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str, shared: bool = True):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.shared = shared

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_lines(self) -> DataFrame:
        """Line items with family, part type, month and whole cents."""
        part = self.table("part").select("p_partkey", family().alias("family"), "p_type")
        month = month_start(F.col("l_shipdate"))
        return (
            self.table("lineitem")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.when(F.col("l_returnflag") == "A", month).otherwise(F.add_months(month, AHEAD)).alias("m"),
                "family",
                "p_type",
                "l_returnflag",
                "l_linestatus",
                F.col("l_linenumber").alias("ln"),
                F.col("l_quantity").alias("q"),
                F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("double").alias("cents"),
                F.col("l_discount").alias("disc"),
                F.col("l_tax").alias("tax"),
            )
        )

    @staticmethod
    def named(df: DataFrame) -> DataFrame:
        """Keys of the line items as product, type and shipped."""
        flag = F.col("l_returnflag")
        kind = F.when(flag == "A", "Actual").when(flag == "N", "Budget").otherwise("R3M")
        names = {
            "product": product_name(),
            "type": kind,
            "shipped": F.col("l_linestatus") == "F",
        }
        return df.withColumns(names).drop("family", "p_type", "l_returnflag", "l_linestatus")

    @property
    def lines(self) -> DataFrame:
        """Line items with month, product, type and whole cents."""
        return self.named(self.raw_lines)

    @cached_property
    def cube(self) -> DataFrame:
        """Line items summed by month, product, type, line number and status.

        The domain tables below all come from these few cells. A query that uses several of them
        stores the cells, so that the line items are read and joined once; a query with one use
        leaves them to the optimizer, which prunes what it does not need.
        """
        cents = F.col("cents")

        def part(c: Column) -> Column:
            return F.sum(F.floor(c).cast("double"))

        keys = ["m", "family", "p_type", "l_returnflag", "l_linestatus", "ln"]
        cells = self.raw_lines.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("q").alias("q"),
            F.sum("cents").alias("cents"),
            part(cents * F.col("disc")).alias("discount"),
            part(cents * (F.col("disc") - 0.05)).alias("ppv"),
            part(cents * (F.col("tax") - 0.04)).alias("muv"),
            part(cents * F.col("tax")).alias("sga"),
            part(cents * 0.5).alias("half"),
            part(cents * 0.125).alias("eighth"),
            part(cents * 0.0625).alias("sixteenth"),
            part(cents * 0.03125).alias("p32"),
            part(cents * 0.015625).alias("p64"),
            F.max("q").alias("max_q"),
            F.max("disc").alias("max_disc"),
            F.max("tax").alias("max_tax"),
            F.min("tax").alias("min_tax"),
        )
        return settle(self.named(cells)) if self.shared else self.named(cells)

    @staticmethod
    def measures() -> dict[str, Column]:
        shipped = F.col("shipped")
        return {
            "ship_rev": F.sum(F.when(shipped, F.col("cents"))),
            "ret": -F.sum(F.when(shipped, F.col("discount"))),
            "ppv": F.sum("ppv"),
            "muv": F.sum("muv"),
            "mat": F.sum("half"),
            "frt": F.sum("eighth"),
            "sga": F.sum("sga"),
            "dep": F.sum(F.when(~shipped, F.col("sixteenth"))),
            "idl": F.sum("p32"),
            "elec": F.sum(F.when(shipped, F.col("p64"))),
            "inv_q": F.sum(F.when(shipped, F.col("q"))),
            "all_q": F.sum("q"),
            "prod_q": F.sum(F.when(~shipped, F.col("q"))),
        }

    def wide(self, *extra: str) -> DataFrame:
        """Monthly sums per product and type."""
        return self.cube.groupBy("m", "product", "type", *extra).agg(
            *[c.alias(n) for n, c in self.measures().items()]
        )

    @staticmethod
    def site(product: Column) -> Column:
        number = F.substring(product, 2, 1).cast("int")
        return (
            F.when(F.pmod(number, F.lit(5)) == 0, "WMI")
            .when(F.pmod(number, F.lit(5)) == 1, "WKS")
            .otherwise(F.concat(F.lit("S"), F.lpad(number.cast("string"), 2, "0")))
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """staging.tbl_is_modeltype"""
        rows = [
            F.struct(
                F.lit(item).alias("line_item"),
                F.lit(group).cast("string").alias("line_itm_group"),
                F.col(source).alias("value"),
            )
            for item, group, source in ITEMS
        ]
        return self.wide().select(
            F.col("m").alias("reporting_month"),
            F.lit(K.BG).alias("bg"),
            F.lit(K.BU).alias("bu"),
            self.site(F.col("product")).alias("site"),
            "product",
            "type",
            F.inline(F.array(*rows)),
        )

    @cached_property
    def dim_project(self) -> DataFrame:
        """staging.dim_project"""
        parts = self.table("part").groupBy(family().alias("family"), "p_type").agg(
            F.min("p_partkey").alias("first_part")
        )
        number, product = F.col("family"), product_name()
        start = F.add_months(F.lit("1994-01-01").cast("date"), number)
        return parts.select(
            product.alias("product"),
            self.site(product).alias("site"),
            F.concat(F.lit("C"), F.col("first_part").cast("string")).alias("product_code"),
            F.col("p_type").alias("product_type"),
            F.when(F.pmod(number, F.lit(4)) == 0, "NPI").otherwise("MP").alias("project_status"),
            F.when(F.pmod(number, F.lit(7)) != 0, start).alias("mp_start_month"),
        )

    @cached_property
    def project_info(self) -> DataFrame:
        """raw.project info"""
        d = self.dim_project
        return d.select(
            F.col("product").alias("Project name"),
            F.col("site").alias("Site"),
            F.col("product_code").alias("AllieCode Name"),
            F.col("product_type").alias("Product Type"),
            F.col("project_status").alias("Current stage"),
            F.col("mp_start_month").alias("MP Start"),
            F.add_months("mp_start_month", -6).alias("NPI Start"),
            F.add_months("mp_start_month", 2).alias("Shipment Start"),
        )

    @cached_property
    def kpi(self) -> DataFrame:
        """staging.tbl_kpi_model"""
        q, cents, ln, t = F.col("q"), F.col("cents"), F.col("ln"), F.col("type")
        actual = t == "Actual"
        sums = self.cube.groupBy("m", "product").agg(
            F.sum(F.when(t == "Budget", q)).alias("apr"),
            F.sum(F.when(t == "R3M", q)).alias("mps"),
            F.sum(F.when(actual & F.col("shipped"), cents)).alias("cogs"),
            F.sum(F.when(t == "R3M", cents)).alias("inventory"),
            F.sum(F.when(actual & (ln == 1), F.col("sixteenth"))).alias("fg_scrap_amount"),
            F.sum(F.when(ln == 2, q)).alias("ads"),
            F.sum(F.when(ln == 3, q)).alias("bad"),
            F.sum(q).alias("max_capacity_volume"),
        )
        return sums.select(
            F.col("m").alias("reporting_month"),
            F.lit(K.BG).alias("bg"),
            F.lit(K.BU).alias("bu"),
            self.site(F.col("product")).alias("site"),
            "product",
            "ads",
            F.when(F.col("apr").isNotNull(), F.lit(20.0)).alias("ads_target"),
            "cogs",
            "inventory",
            "apr",
            "mps",
            "fg_scrap_amount",
            F.lit(0.03125).alias("scrap_rate"),
            (F.lit(1.0) - F.pmod(F.col("bad"), F.lit(128.0)) / 1024.0).alias("yield_rate"),
            F.lit(0.96875).alias("yield_rate_current_target"),
            F.lit(0.984375).alias("yield_rate_final_target"),
            "max_capacity_volume",
        )

    @cached_property
    def unit_moh(self) -> DataFrame:
        """staging.tbl_unitmoh_monthly, with costs per unit as multiples of 1/1024."""
        w = self.cube.groupBy("m", "product").agg(
            *[
                F.sum(F.when(F.col("type") == t, F.col("cents"))).alias(t) for t in K.TYPES
            ],
            F.sum("cents").alias("every"),
        )
        items = [("IDL", 64), ("Depreciation-W-buy", 96), (" Electricity&Water", 256), ("other utilities", 1000), ("Production quantity", 3)]

        def unit(name: str, by: int) -> Column:
            return F.floor(F.col(name) / float(by)).cast("double") / 1024.0

        rows = [
            F.struct(
                F.lit(item).alias("moh_item"),
                unit("Actual", by).alias("unit_moh_actual"),
                unit("Budget", by).alias("unit_moh_budget"),
                unit("R3M", by).alias("unit_moh_r3m"),
                unit("every", 3 * by).alias("unit_moh_quote"),
            )
            for item, by in items
        ]
        return w.select(
            F.col("m").alias("reporting_month"),
            F.lit(K.BG).alias("bg"),
            F.lit(K.BU).alias("bu"),
            self.site(F.col("product")).alias("site"),
            "product",
            F.inline(F.array(*rows)),
        )

    def raw_pl(self, kind: str) -> DataFrame:
        """raw profit and loss of one type, with two versions of most months."""
        back = -(F.lit(1) + F.pmod(F.col("ln"), F.lit(2)))
        versions = self.cube.filter(F.col("type") == kind).withColumn(
            "Version", F.date_format(F.add_months(F.col("m"), back), "yyyyMMdd")
        )
        sums = versions.groupBy("m", "product", "Version").agg(
            *[c.alias(n) for n, c in self.measures().items()]
        )
        return sums.select(
            F.year("m").alias("Year"),
            F.month("m").alias("Month"),
            F.date_format("m", "yyyy/MM").alias("Period"),
            self.site(F.col("product")).alias("Site"),
            F.col("product").alias("Project"),
            "Version",
            *[F.col(source).alias(name) for name, source, _, _ in RAW_COLUMNS],
        )

    @cached_property
    def items_map(self) -> DataFrame:
        rows = [(n, d, g) for n, _, d, g in RAW_COLUMNS if d]
        return lit_rows(
            self.spark, "variable string, accounting_item_desc string, accounting_item_group string", rows
        )

    @cached_property
    def item_codes(self) -> DataFrame:
        rows = [(f"A{i:02d}", d) for i, (_, _, d, _) in enumerate(RAW_COLUMNS) if d]
        return lit_rows(self.spark, "accounting_item_code string, accounting_item_desc string", rows)

    @cached_property
    def merge_map(self) -> DataFrame:
        return lit_rows(self.spark, "accounting_item_desc string, app_item string", MERGE_MAP)

    @cached_property
    def control(self) -> DataFrame:
        ddl = (
            "bg string, line_item string, line_itm_group string, detailed_item string, "
            "`Frontnend_name level 1` string"
        )
        return lit_rows(self.spark, ddl, CONTROL)

    @cached_property
    def categories(self) -> DataFrame:
        return lit_rows(
            self.spark, "cost_cat_code string, cost_cat_name string, non_adj_flag int", CATEGORIES
        )

    @cached_property
    def weights(self) -> DataFrame:
        return lit_rows(self.spark, "idx string, weight double", WEIGHTS)

    @cached_property
    def params(self) -> DataFrame:
        return lit_rows(self.spark, "param string, value double, date date", PARAMS)

    @cached_property
    def order_months(self) -> DataFrame:
        return self.table("orders").select(month_start(F.col("o_orderdate")).alias("m")).distinct()

    @cached_property
    def fx_actual(self) -> DataFrame:
        """Monthly rates of two currency pairs, for the months that have orders.

        Powers of two, so that amounts stay exact when they are divided by a rate.
        """
        m = self.order_months
        usd = m.select(
            F.col("m").alias("Month"), F.lit("USD").alias("From"), F.lit("NTD").alias("To"),
            F.element_at(F.array(F.lit(16.0), F.lit(32.0), F.lit(64.0)), F.month("m") % 3 + 1).alias("FX"),
        )
        return usd.unionByName(usd.withColumns({"From": F.lit("EUR"), "FX": F.col("FX") + 4.0}))

    @cached_property
    def fx_budget(self) -> DataFrame:
        y = self.order_months.select(F.year("m").alias("Year")).distinct()
        return y.select(
            "Year", F.lit("USD").alias("From"), F.lit("NTD").alias("To"),
            (31.0 + F.pmod(F.col("Year"), F.lit(8)) / 8.0).alias("FX"),
        )

    @cached_property
    def fx_r3m(self) -> DataFrame:
        return self.order_months.select(
            F.col("m").alias("Month"), F.lit("USD").alias("From"), F.lit("NTD").alias("To"),
            (29.0 + F.month("m") / 32.0).alias("FX"),
        )

    @cached_property
    def rates(self) -> DataFrame:
        return fx.rate_dimension(self.fx_actual, self.fx_budget, self.fx_r3m)

    @cached_property
    def r3m_versions_raw(self) -> DataFrame:
        """Period and version columns of a rolling forecast, many rows per period."""
        month = month_start(F.col("o_orderdate"))
        version = F.date_sub(month, (F.pmod(F.col("o_custkey"), F.lit(40)) + 1).cast("int"))
        return self.table("orders").select(
            F.date_format(month, "yyyy/MM").alias("Period"),
            F.date_format(version, "yyyyMMdd").alias("Version"),
        )

    @cached_property
    def versions(self) -> DataFrame:
        return forecast_versions(self.r3m_versions_raw)
