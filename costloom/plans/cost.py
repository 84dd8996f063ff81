"""Staging tables to the cost overview tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.dates import from_year
from costloom.functions.missing import any_of, col, div_guarded, drop_null_keys
from costloom.functions.sums import exact_mean, exact_sum
from costloom.operators import fx
from costloom.operators.joins import densify
from costloom.operators.lookups import cost_category_code, product_type
from costloom.operators.reshape import melt_types, pivot_mean, with_aggregate_level
from costloom.operators.rollup import four_level, per_quantity
from costloom.session import settle

ENTITY = ["reporting_month", "bg", "bu", "site", "product"]
COSTS = [f"{t.lower()}_total_cost" for t in K.TYPES]


def every_item(ledger: DataFrame, control: DataFrame) -> DataFrame:
    """Every month and product of the ledger with every item of the cost list."""
    entities = settle(ledger.select(*ENTITY).distinct())
    return densify(entities, control).withColumnsRenamed(
        {
            "detailed_item": "cost_item_level2",
            "line_item": "cost_item_level1",
            "line_itm_group": "cost_box_group",
        }
    )


def is_site_moh(level1: Column) -> Column:
    return any_of(level1, K.SITE_MOH)


def _slot(kind: str, part: str) -> str:
    return f"_{kind.lower()}_{part}"


def ledger_measures(ledger: DataFrame) -> DataFrame:
    """Sum and mean of each type per (month, product, item), one row per key.

    Costs and quantities both come from these rows, so the ledger is aggregated once.
    """
    keys = ["reporting_month", "product", "line_item"]
    typed = drop_null_keys(ledger, keys).filter(F.col("type").isin(K.TYPES))
    value = {t: F.when(F.col("type") == t, F.col("value")) for t in K.TYPES}
    return typed.groupBy(*keys).agg(
        *[exact_sum(value[t]).alias(_slot(t, "ledger")) for t in K.TYPES],
        *[exact_mean(value[t]).alias(_slot(t, "mean")) for t in K.TYPES],
    )


def ledger_costs(measures: DataFrame) -> DataFrame:
    """Amount of each type per (month, product, item), one row per key.

    Summed once by type, so the join that follows cannot multiply rows; on a ledger with one row
    per key and type this is the row's value.
    """
    return measures.drop(*[_slot(t, "mean") for t in K.TYPES])


def quantities(measures: DataFrame) -> DataFrame:
    """Mean shipped and produced quantity of each type per (month, product): six columns."""
    names = {K.INVOICE_QUANTITY: "shipment", K.PRODUCTION_QUANTITY: "production"}
    means = {
        f"{t.lower()}_{q}": F.when(F.col("line_item") == i, F.col(_slot(t, "mean")))
        for t in K.TYPES
        for i, q in names.items()
    }
    known = F.coalesce(*[F.col(_slot(t, "mean")) for t in K.TYPES]).isNotNull()
    rows = measures.filter(any_of(F.col("line_item"), list(names)) & known)
    return rows.groupBy("reporting_month", "product").agg(*[F.max(c).alias(n) for n, c in means.items()])


def with_total_cost(items: DataFrame, measures: DataFrame, unit_moh: DataFrame) -> DataFrame:
    """Adds the three total costs.

    Site overhead is looked up by second-level item, everything else by first-level item. Each
    row carries only the key of its own lookup, so both are joined in one pass over the items.
    """
    moh = is_site_moh(F.col("cost_item_level1"))
    keyed = items.withColumns(
        {
            "_moh_item": F.when(moh, F.col("cost_item_level2")),
            "_line_item": F.when(~moh, F.col("cost_item_level1")),
        }
    )
    unit = unit_moh.select(
        "reporting_month",
        "product",
        F.col("moh_item").alias("_moh_item"),
        *[F.col(f"unit_moh_{t.lower()}").alias(f"_{t.lower()}_moh") for t in K.TYPES],
    )
    booked = ledger_costs(measures).withColumnRenamed("line_item", "_line_item")
    joined = keyed.join(unit, ["reporting_month", "product", "_moh_item"], "left").join(
        booked, ["reporting_month", "product", "_line_item"], "left"
    )
    costs = {
        f"{t}_total_cost": F.when(moh, F.col(f"_{t}_moh")).otherwise(F.col(f"_{t}_ledger"))
        for t in ("actual", "budget", "r3m")
    }
    drop = [f"_{t}_{s}" for t in ("actual", "budget", "r3m") for s in ("moh", "ledger")]
    return joined.withColumns(costs).drop("_moh_item", "_line_item", *drop)


def moh_times_production(df: DataFrame) -> DataFrame:
    """Site overhead comes per unit, so it is multiplied by the produced quantity."""
    moh = is_site_moh(F.col("cost_item_level1"))
    return df.withColumns(
        {
            f"{t}_total_cost": F.when(
                moh, F.col(f"{t}_total_cost") * F.col(f"{t}_production")
            ).otherwise(F.col(f"{t}_total_cost"))
            for t in ("actual", "budget", "r3m")
        }
    )


def without_foreign_moh(df: DataFrame) -> DataFrame:
    """Clears the cost of overhead that belongs to another site."""
    wrong = F.lit(False)
    for site, item in K.MOH_NOT_AT_SITE:
        wrong = wrong | F.coalesce(
            (F.col("site") == site) & (F.col("cost_item_level1") == item), F.lit(False)
        )
    return df.withColumns({c: F.when(~wrong, F.col(c)) for c in COSTS})


def rated_detail(
    ledger: DataFrame,
    control: DataFrame,
    unit_moh: DataFrame,
    rates: DataFrame,
    first_year: int = K.FIRST_YEAR,
) -> DataFrame:
    """Cost, quantity and rate of every item in local currency; overhead still per unit.

    The tables of both currencies come from these rows. The ledger is read twice: for its measures
    and for its months and products. Both are stored, because two joins read them.
    """
    measures = settle(ledger_measures(ledger))
    items = every_item(ledger, control).filter(from_year(F.col("reporting_month"), first_year))
    costed = with_total_cost(items, measures, unit_moh)
    sized = costed.join(quantities(measures), ["reporting_month", "product"], "left")
    return fx.add_rate(sized, rates)


def detail_in(rated: DataFrame, currency: str) -> DataFrame:
    """The rated detail as the table of one currency.

    The foreign-currency table divides the costs by the month's rate, before overhead is multiplied
    by the production.
    """
    if currency == K.FOREIGN:
        rated = fx.local_to_foreign(rated, COSTS)
    masked = without_foreign_moh(moh_times_production(rated))
    return masked.withColumn("currency", F.lit(currency)).withColumnRenamed("FX", "fx_rate")


def cost_overview_detail(
    ledger: DataFrame,
    control: DataFrame,
    unit_moh: DataFrame,
    rates: DataFrame,
    currency: str = K.LOCAL,
    first_year: int = K.FIRST_YEAR,
) -> DataFrame:
    """Total cost and quantity of every item by type (app.cost_overview_dtl and _dtl_ntd)."""
    return detail_in(rated_detail(ledger, control, unit_moh, rates, first_year), currency)


def both_standards(
    rolled: DataFrame, codes: list[str], quantity_of: dict[str, str]
) -> DataFrame:
    """Unit costs per shipped and per produced unit from one table of sums.

    Each standard gives one row with its own quantity; the other quantity is missing there.
    """
    kept = [c for c in rolled.columns if c not in codes and c not in quantity_of.values()]
    options = []
    for standard, quantity in quantity_of.items():
        parts = [div_guarded(col(c), col(quantity)).alias(c) for c in codes]
        sizes = [
            (col(q) if s == standard else F.lit(None).cast("double")).alias(q)
            for s, q in quantity_of.items()
        ]
        options.append(F.struct(F.lit(standard).alias("standard"), *parts, *sizes))
    rows = rolled.select(*[col(c) for c in kept], F.explode(F.array(*options)).alias("_o"))
    return rows.select(*[col(c) for c in kept], "_o.*")


def cost_overview_level1(
    detail: DataFrame,
    dim_project: DataFrame,
    categories: DataFrame,
    rates: DataFrame,
    codes: list[str],
    agg: str = "mean",
) -> DataFrame:
    """Unit cost by category and type at four levels (app.cost_overview_level1).

    Inside a category the second-level items of a product are averaged (`agg="sum"` adds them).
    The quantity of a type is the same on every item row of a product and month, so it is
    carried through the pivot instead of being joined back.
    """
    typed = cost_category_code(product_type(detail, dim_project), categories)
    ids = ["reporting_month", "bg", "site", "product_type", "product", "cost_cat_code"]
    measures = {"value": "total_cost", "shipment": "shipment", "production": "production"}
    long = melt_types(typed, ids, measures)
    carry = [F.max("shipment").alias("shipment"), F.max("production").alias("production")]
    keys = ["reporting_month", "bg", "site", "product_type", "product", "type"]
    if agg == "mean":
        wide = pivot_mean(long, keys, "cost_cat_code", "value", codes, carry)
    else:
        kept = drop_null_keys(long, keys).filter(F.col("value").isNotNull())
        sums = [exact_sum(F.when(F.col("cost_cat_code") == c, F.col("value"))).alias(c) for c in codes]
        wide = kept.filter(any_of(F.col("cost_cat_code"), codes)).groupBy(*keys).agg(*sums, *carry)
    rolled = four_level(wide, ["bg", "reporting_month", "type"], [*codes, "shipment", "production"])
    both = both_standards(rolled, codes, {"shipment": "shipment", "production": "production"})
    return fx.tag_foreign(both, rates)


def level0(code: Column) -> Column:
    """Top-level gap column of a category code: its first part, renamed and prefixed."""
    head = F.split(code, "_").getItem(0)
    named = head
    for short, long in K.LEVEL0_NAMES.items():
        named = F.when(head == short, long).otherwise(named)
    return F.concat(F.lit(K.LEVEL0_PREFIX), named)


def cost_overview_gap(
    detail: DataFrame,
    dim_project: DataFrame,
    categories: DataFrame,
    rates: DataFrame,
    groups: list[str],
) -> DataFrame:
    """Actual cost by top-level group, in total, and not adjustable (app.cost_overview_gap).

    All parts are conditional sums, so the pivot, the total and the non-adjustable part need one
    aggregate and no join.
    """
    typed = cost_category_code(product_type(detail, dim_project), categories, flag=True)
    cost = F.col("actual_total_cost")
    group = level0(F.col("cost_cat_code"))
    known = typed.filter(F.col("cost_cat_code").isNotNull()).withColumn("_group", group)
    parts = known.withColumns(
        {
            **{g: F.when(F.col("_group") == g, cost) for g in groups},
            "ucg_total": F.when(F.col("_group").isin(groups), cost),
            "ucg_non_adj": F.when(F.col("non_adj_flag") == 1, cost),
            "type": F.lit("Actual"),
        }
    )
    sums = [*groups, "ucg_total", "ucg_non_adj"]
    rolled = four_level(parts, ["bg", "reporting_month", "type"], sums)
    return fx.tag_foreign(rolled, rates)


def level2_unit_costs(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "unit_cost_ship": div_guarded(F.col("total_cost"), F.col("shipment")),
            "unit_cost_prod": div_guarded(F.col("total_cost"), F.col("production")),
        }
    )


def cost_overview_level2(
    detail: DataFrame, dim_project: DataFrame, categories: DataFrame, rates: DataFrame
) -> DataFrame:
    """Unit cost of second-level items and their subtotals (app.cost_overview_level2)."""
    typed = cost_category_code(product_type(detail, dim_project), categories)
    ids = [
        "reporting_month", "bg", "site", "product_type", "product", "cost_cat_code",
        "cost_item_level1", "cost_item_level2",
    ]
    families = {"total_cost": "total_cost", "shipment": "shipment", "production": "production"}
    rows = with_aggregate_level(melt_types(typed, ids, families))
    keys = ["bg", "reporting_month", "type", "product", "cost_cat_code", "cost_item_level2"]
    rolled = four_level(rows, keys, list(families), post=level2_unit_costs)
    named = rolled.withColumnsRenamed({"product": "project", "cost_item_level2": "cost_level2"})
    return fx.tag_foreign(named, rates)


def unit_cost_rollup(
    wide: DataFrame, cols: list[str], quantity: str | None = None
) -> DataFrame:
    """Four-level sums of cost columns, divided by a summed quantity if one is named."""
    if quantity is None:
        return four_level(wide, ["bg", "reporting_month", "type"], cols)
    return four_level(
        wide,
        ["bg", "reporting_month", "type"],
        [*cols, quantity],
        post=lambda df: per_quantity(df, cols, quantity),
    )
