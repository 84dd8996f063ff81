"""Health score: six scores in [0, 1] and their weighted mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.missing import at_most_one, clamp01, div_guarded


def reach(done: Column, planned: Column) -> Column:
    """Share of a plan that was reached, at most 1; missing unless the plan is positive."""
    return at_most_one(div_guarded(done, planned))


def closeness(actual: Column, target: Column) -> Column:
    """1 at or below the target, falling by the relative excess, at least 0.

    Missing unless the actual value is positive. Without a target the score is 1; a target of 0
    has no relative excess, so the score is missing.
    """
    excess = (actual - target) / target
    return F.when(
        actual > 0,
        F.when(target.isNull(), F.lit(1.0)).when(target != 0, clamp01(F.lit(1.0) - excess)),
    )


def variance_score(variance: Column, revenue: Column) -> Column:
    """1 without material variance, falling by 1 per percent of revenue."""
    share = div_guarded(variance, revenue)
    return clamp01(F.lit(1.0) - share * F.lit(100.0))


def six_scores() -> dict[str, Column]:
    c = F.col
    return {
        "shipment/apr": reach(c("shipment_volume"), c("apr")),
        "production/apr": reach(c("production_volume"), c("apr")),
        "moh/quote": closeness(c("unit_moh_actual"), c("unit_moh_quote")),
        "ads/ads_target": closeness(c("ads"), c("ads_target")),
        "yield/yield_target": reach(c("yield_rate"), c("yield_rate_current_target")),
        "material/m_target": variance_score(c("material_total_variance"), c("revenue")),
    }


def score_weights(weights: DataFrame) -> Column:
    """The six weights as one struct, read by a scalar subquery."""
    one = weights.agg(
        F.struct(
            *[F.max(F.when(F.col("idx") == s, F.col("weight"))).alias(s) for s in K.SCORES]
        ).alias("weights")
    )
    return one.scalar()


def weighted_score(scores: dict[str, Column], weights: Column) -> Column:
    """Weighted mean over the scores that are present; missing if none is."""
    top = bottom = F.lit(0.0)
    for name, score in scores.items():
        w = weights.getField(name)
        top = top + F.coalesce(score * w, F.lit(0.0))
        bottom = bottom + F.when(score.isNotNull(), F.coalesce(w, F.lit(0.0))).otherwise(F.lit(0.0))
    return F.when(bottom != 0, top / bottom)


def health_score(df: DataFrame, weights: DataFrame, status: str = "project_status") -> DataFrame:
    """Adds `health_score`, only for products in mass production."""
    w = score_weights(weights)
    named = df.withColumns({f"_score_{i}": s for i, s in enumerate(six_scores().values())})
    cols = {n: F.col(f"_score_{i}") for i, n in enumerate(K.SCORES)}
    score = F.when(F.col(status) == K.MASS_PRODUCTION, weighted_score(cols, w))
    return named.withColumn("health_score", score).drop(*[f"_score_{i}" for i in range(len(cols))])
