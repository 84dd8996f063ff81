"""The four-level rollup: site and product type, site, everything, product type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom import constants as K
from costloom.functions.missing import col, div_guarded, div_ieee, drop_null_keys, sum0
from costloom.functions.sums import exact_sum


def four_level(
    df: DataFrame,
    keys: list[str],
    sums: list[str],
    means: list[str] | None = None,
    post: Callable[[DataFrame], DataFrame] | None = None,
    site: str = "site",
    kind: str = "product_type",
    label: str = "cat_ind",
) -> DataFrame:
    """Aggregate at four levels with one scan and label each row with its level's category.

    Rows are first summed at the finest level, so the copies that grouping sets make (four per
    row) are made of groups, not of input rows; both steps combine before their shuffle, which
    keeps hot groups cheap. Sums without any value are 0; means ignore missing values. `post`
    gets the frame of sums (and means) and returns it with derived columns.
    """
    means = means or []
    finest = [*keys, site, kind]
    kept = drop_null_keys(df, keys)
    base = kept.groupBy(*[col(k) for k in finest]).agg(
        *[sum0(col(s)).alias(s) for s in sums],
        *[exact_sum(col(m)).alias(f"_s_{m}") for m in means],
        *[F.count(col(m)).alias(f"_n_{m}") for m in means],
    )
    k = [col(x) for x in keys]
    s, t = col(site), col(kind)
    cubes = base.groupingSets([[*k, s, t], [*k, s], k, [*k, t]], *k, s, t).agg(
        F.grouping(site).alias("_no_site"),
        F.grouping(kind).alias("_no_kind"),
        *[exact_sum(col(x)).alias(x) for x in sums],
        *[F.try_divide(exact_sum(F.col(f"_s_{m}")), F.sum(f"_n_{m}").cast("double")).alias(m) for m in means],
    )
    no_site, no_kind = F.col("_no_site") == 1, F.col("_no_kind") == 1
    # A missing site or type has no label of its own, but counts in the levels above.
    labelled = cubes.filter((no_site | s.isNotNull()) & (no_kind | t.isNotNull())).withColumn(
        label,
        F.when(no_site & no_kind, F.lit(K.ALL))
        .when(no_kind, s)
        .when(no_site, t)
        .otherwise(F.concat_ws("_", s, t)),
    )
    out = labelled.select(*k, label, *[col(x) for x in [*sums, *means]])
    return post(out) if post else out


def per_quantity(df: DataFrame, cols: list[str], quantity: str) -> DataFrame:
    """Divide summed columns by a summed quantity where it is positive."""
    return df.withColumns({c: div_guarded(col(c), col(quantity)) for c in cols})


def ratio(a: str, b: str) -> Column:
    return div_ieee(F.col(a), F.col(b))
