"""Alert rules over KPI rows and site costs: flags, impact, texts, leads and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.missing import div_ieee, greatest_first, holds, nan_to_null, sum0
from costloom.functions.text import fixed2, whole
from costloom.operators.ids import dense_ids

LEADS_PER_RULE = {1: 2, 2: 2, 3: 1, 4: 1, 5: 2, 6: 1, 8: 3}


def _c(name: str) -> Column:
    return F.col(name)


def kpi_flags(
    base: DataFrame,
    params: Column,
    impact: float = K.IMPACT,
    production_share: float = K.PRODUCTION_SHARE,
    ads_share: float = K.ADS_SHARE,
) -> DataFrame:
    """Adds the flag, impact number and importance flag of rules 1 to 6.

    Sums over all rows (revenue, shipment) come from one scalar subquery; `params` is a struct
    with `corp_funding_rate` and `scrap_target`.
    """
    totals = base.agg(
        F.struct(
            sum0(F.col("revenue")).alias("revenue"),
            sum0(F.col("shipment")).alias("shipment"),
        ).alias("t")
    ).scalar()
    df = base.withColumns({"_totals": totals, "_params": params})
    revenue, shipment = _c("_totals.revenue"), _c("_totals.shipment")
    rate, target = _c("_params.corp_funding_rate"), _c("_params.scrap_target")
    low = F.lit(production_share) * _c("max_capacity")
    df = df.withColumns(
        {
            "scrap_target": target,
            "production_is_low": holds(_c("production") < low),
            "future_is_low": holds(_c("max_mps") < low),
            "rule1_num": div_ieee(
                (_c("max_capacity") - _c("max_mps")) * _c("fixed_moh_cost"), revenue
            ),
            "rule2": holds(_c("shipment") < _c("apr")),
            "rule2_num": div_ieee(_c("apr") - _c("shipment"), shipment),
            "rule3": holds(_c("ads") > _c("fg_ads_target") * F.lit(ads_share)),
            "rule3_num": div_ieee((_c("ads") - _c("fg_ads_target")) * rate, revenue),
            "scrap_rate": div_ieee(_c("fg_scrap_amount"), _c("revenue_amt_for_scrap")),
            "rule5": holds(_c("yield_rate") < _c("yield_rate_curr_target")),
            "rule5_num": div_ieee(
                (_c("yield_rate_curr_target") - _c("yield_rate")) * _c("cogs_for_ads"),
                _c("revenue"),
            ),
            "material_share": div_ieee(_c("material_total_variance"), _c("revenue")),
            "rule6_num": div_ieee(_c("material_total_variance"), revenue),
        }
    )
    df = df.withColumns(
        {
            "rule1": _c("production_is_low") & _c("future_is_low"),
            "rule4": holds(_c("scrap_rate") > _c("scrap_target")),
            "rule4_num": _c("scrap_rate") - _c("scrap_target"),
            "rule6": holds(_c("material_share") > 0),
        }
    )
    over = {f"rule{r}_impact": holds(_c(f"rule{r}_num") > impact) for r in range(1, 7)}
    return df.withColumns(over).drop("_totals", "_params")


def site_flags(
    base: DataFrame, impact: float = K.IMPACT, share: float = K.COST_SHARE
) -> DataFrame:
    """Rule 8 over site and item totals: total or unit cost too far above budget."""
    total = base.agg(F.sum_distinct(_c("revenue")).alias("t")).scalar()
    df = base.withColumn("_revenue", total).withColumns(
        {
            f"{t}_unit_cost": div_ieee(_c(f"{t}_total_cost"), _c(f"{t}_shipment"))
            for t in ("actual", "budget", "r3m")
        }
    )
    unit_gap = nan_to_null(_c("actual_unit_cost") - _c("budget_unit_cost"))
    df = df.withColumns(
        {
            "tot_cost_is_high": holds(
                _c("actual_total_cost") > F.lit(share) * _c("budget_total_cost")
            ),
            "unit_cost_is_high": holds(
                _c("actual_unit_cost") > F.lit(share) * _c("budget_unit_cost")
            ),
            "tot_cost_impact": div_ieee(
                _c("actual_total_cost") - _c("budget_total_cost"), _c("_revenue")
            ),
            "unit_cost_impact": div_ieee(
                nan_to_null(unit_gap * _c("actual_shipment")), _c("_revenue")
            ),
        }
    )
    df = df.withColumns(
        {
            "rule8": _c("tot_cost_is_high") | _c("unit_cost_is_high"),
            "rule8_num": greatest_first(_c("tot_cost_impact"), _c("unit_cost_impact")),
        }
    ).withColumn("rule8_impact", holds(_c("rule8_num") > impact))
    return df.filter(_c("budget_total_cost") > 0).drop("_revenue")


def _say(*parts: str | Column) -> Column:
    """Sentence from texts and columns; a missing name shows as 'nan'."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("nan")) for p in parts]
    return F.concat(*cols)


def _spell(df: DataFrame, two: dict[str, Column], percent: dict[str, Column], near: dict[str, Column]) -> DataFrame:
    """Adds map `_n` from names to numbers as text: two decimals, percent, nearest whole.

    One rounding expression serves all numbers of a kind, which keeps the generated code small.
    """
    fixed = {**two, **{k: v * F.lit(100.0) for k, v in percent.items()}}

    def as_map(values: dict[str, Column]) -> Column:
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("double"))])

    df = df.withColumns(
        {
            "_fixed": F.transform_values(as_map(fixed), lambda _, v: fixed2(v)),
            "_near": F.transform_values(as_map(near), lambda _, v: whole(v)),
        }
    )
    return df.withColumn("_n", F.map_concat("_fixed", "_near")).drop("_fixed", "_near")


def _n(name: str) -> Column:
    return F.col("_n")[name]


def spell_kpi(flags: DataFrame) -> DataFrame:
    """Numbers that the texts of rules 1 to 6 show."""
    thousand = F.lit(1000.0)
    return _spell(
        flags,
        two={"ads": _c("ads")},
        percent={
            "used": div_ieee(_c("production"), _c("max_capacity")),
            "planned": div_ieee(_c("max_mps"), _c("max_capacity")),
            "below": _c("rule2_num"),
            "ads_over": div_ieee(_c("ads"), _c("fg_ads_target")) - F.lit(1.0),
            "scrap": _c("scrap_rate"),
            "scrap_target": _c("scrap_target"),
            "scrap_over": _c("rule4_num"),
            "rate": _c("yield_rate"),
            "target": _c("yield_rate_curr_target"),
            "behind": _c("yield_rate_curr_target") - _c("yield_rate"),
            "final": F.coalesce(_c("yield_rate_final_target"), _c("yield_rate_curr_target")),
            "material": _c("material_share"),
            "ppv": div_ieee(_c("ppv"), _c("revenue")),
            "muv": div_ieee(_c("muv"), _c("revenue")),
        },
        near={
            "production_k": _c("production") / thousand,
            "max_mps_k": _c("max_mps") / thousand,
            "shipment_k": _c("shipment") / thousand,
            "apr_k": _c("apr") / thousand,
            "ads_target": _c("fg_ads_target"),
            "months": _c("mp_no_of_month"),
        },
    )


def kpi_texts() -> dict[int, tuple[Column, list[Column]]]:
    """Description and leads of rules 1 to 6."""
    who = _c("product")
    # Fixed texts of descriptions and leads.
    return {
        1: (
            _say(who, " reporting period production volume was only ", _n("used"), " % of max capacity"),
            [
                _say(who, " reporting period production volume was ", _n("production_k"), "K, only ",
                     _n("used"), " % of max capacity"),
                _say(who, " Maximum MPS 6 month requirement was ", _n("max_mps_k"),
                     "K, stays below ", _n("planned"), " % of max capacity"),
            ],
        ),
        2: (
            _say(who, " shipment volume ", _n("below"), " % below APR"),
            [
                _say(who, " shipment volume was ", _n("shipment_k"), "K"),
                _say(who, " APR was ", _n("apr_k"), "K"),
            ],
        ),
        3: (
            _say(who, " finished goods ADS was ", _n("ads_over"), " % over business rule"),
            [
                _say(who, " reporting month finished goods ADS ", _n("ads"),
                     " days, vs. ADS business rule of ", _n("ads_target"), " days"),
            ],
        ),
        4: (
            _say(who, " scrap rate ", _n("scrap"), " %, ", _n("scrap_over"), " % higher than ",
                 _n("scrap_target"), " %"),
            [
                _say(who, " scrap rate ", _n("scrap"), " %, vs.inventory reserve of ",
                     _n("scrap_target"), " %"),
            ],
        ),
        5: (
            _say(who, " yield rate was ", _n("rate"), " %, ", _n("behind"),
                 " % behind yield rate current target"),
            [
                _say(who, " yield rate ", _n("rate"), " %, vs. yield rate current target of ",
                     _n("target"), " %"),
                _say(who, " has been in MP stage for ", _n("months"), " months. ", who,
                     " yield rate was ", _n("rate"), ", vs. yield rate final target of ",
                     _n("final"), " %"),
            ],
        ),
        6: (
            _say(who, " material cost variance(PPV + MUV) was ", _n("material"), " %"),
            [
                _say(who, " PPV was ", _n("ppv"), " % of revenue; MUV was ", _n("muv"),
                     " % of revenue"),
            ],
        ),
    }


def spell_site(flags: DataFrame) -> DataFrame:
    """Numbers that the texts of rule 8 show."""

    def over(actual: str, budget: str) -> Column:
        return div_ieee(_c(actual) - _c(budget), _c(budget))

    types = ("actual", "budget", "r3m")
    return _spell(
        flags,
        two={},
        percent={
            "total": over("actual_total_cost", "budget_total_cost"),
            "unit": over("actual_unit_cost", "budget_unit_cost"),
        },
        near={
            **{f"{t}_k": _c(f"{t}_total_cost") / F.lit(1000.0) for t in types},
            **{f"{t}_unit": _c(f"{t}_unit_cost") for t in types},
        },
    )


def site_texts() -> tuple[Column, list[Column]]:
    """Description and leads of rule 8."""
    who, item = _c("site"), _c("line_item_short")
    total = _say("Actual ", item, " was ", _n("total"), " % higher than budget")
    unit = _say("Actual unit ", item, " per shipment was ", _n("unit"),
                " % higher than budget unit cost")
    described = F.concat_ws(
        " ", F.when(_c("tot_cost_is_high"), total), F.when(_c("unit_cost_is_high"), unit)
    )
    leads = [
        _say(who, " actual ", item, " was ", _n("actual_k"), "K NTD, budget ", item, " was ",
             _n("budget_k"), "K NTD"),
        _say(who, " actual unit ", item, " per shipment was ", _n("actual_unit"),
             " NTD, budget unit ", item, " per shipment was ", _n("budget_unit"), " NTD"),
        _say(who, " R3M ", item, " was ", _n("r3m_k"), "K NTD; RSM unit ", item,
             " per shipment was ", _n("r3m_unit"), " NTD"),
    ]
    return described, leads


def _importance(rule: int) -> Column:
    return F.when(_c(f"rule{rule}_impact"), "high").otherwise("medium")


def kpi_alerts(flags: DataFrame) -> DataFrame:
    """One row per product and rule that fires."""
    fired = []
    for rule, (description, leads) in kpi_texts().items():
        alert = F.struct(
            F.lit(rule).alias("rule"),
            F.lit(K.TITLES[rule]).alias("title"),
            _importance(rule).alias("importance"),
            description.alias("description"),
            F.array(*leads).alias("leads"),
        )
        fired.append(F.when(_c(f"rule{rule}"), alert))
    one = spell_kpi(flags).select(
        _c("reporting_month").alias("alert_month"),
        _c("product").alias("object"),
        F.explode(F.array_compact(F.array(*fired))).alias("a"),
    )
    return one.select("a.rule", "alert_month", "a.title", "a.importance", "object",
                      "a.description", "a.leads")


def site_alerts(flags: DataFrame) -> DataFrame:
    """One row per site and item that rule 8 fires for."""
    described, leads = site_texts()
    return spell_site(flags.filter(_c("rule8"))).select(
        F.lit(8).alias("rule"),
        _c("reporting_month").alias("alert_month"),
        _say(_c("line_item_short"), " too high").alias("title"),
        _importance(8).alias("importance"),
        _c("site").alias("object"),
        described.alias("description"),
        F.array(*leads).alias("leads"),
    )


def number_alerts(alerts: DataFrame) -> DataFrame:
    """Alert ids from 0, in the order of rule, month, object, title and description."""
    return dense_ids(alerts, ["rule", "alert_month", "object", "title", "description"], "alert_id")


def alert_table(numbered: DataFrame) -> DataFrame:
    return numbered.select("alert_id", "alert_month", "title", "importance", "object", "description")


def lead_table(numbered: DataFrame) -> DataFrame:
    """Leads with ids from 0, in alert order.

    The number of leads is fixed per rule, so a lead's id follows from its alert's id and the
    number of alerts per rule; no second sort is needed.
    """
    counts = [F.sum(F.when(_c("rule") == r, 1).otherwise(0)).alias(f"r{r}") for r in LEADS_PER_RULE]
    per_rule = numbered.agg(F.struct(*counts).alias("n")).scalar()
    df = numbered.withColumn("_n", per_rule)
    first = F.lit(None).cast("long")
    leads_before = alerts_before = F.lit(0).cast("long")
    for rule, per in LEADS_PER_RULE.items():
        first = F.when(
            _c("rule") == rule, leads_before + (_c("alert_id") - alerts_before) * F.lit(per)
        ).otherwise(first)
        size = F.coalesce(_c(f"_n.r{rule}"), F.lit(0))
        leads_before = leads_before + size * F.lit(per)
        alerts_before = alerts_before + size
    rows = df.select("alert_id", first.alias("_first"), F.posexplode("leads").alias("_at", "lead_desc"))
    return rows.select("alert_id", (_c("_first") + _c("_at")).alias("lead_id"), "lead_desc")
