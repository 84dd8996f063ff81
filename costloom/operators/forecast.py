"""Per-series forecasts: moving average, exponential smoothing, autoregression.

One row per (series, month) goes in; one row per (series, month) comes out, with one more month
per series. Series are grouped once; every model is a native expression on the group, so nothing
leaves the JVM. A group is bounded by the calendar: one value per month.

Autoregression uses orders up to 3, on levels and on first differences, fitted by least squares
with an intercept; the model with the least per-observation AIC is kept. Its values are those of
AR models, not of a search over models with moving-average terms.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costloom.functions.dates import next_month
from costloom.functions.missing import finite
from costloom.operators.series import spread_series

LAG = 3
COARSE = [i / 20 for i in range(21)]
FINE = [i / 200 for i in range(-9, 10)]
_MIN_RSS = 1e-12
_MIN_DET = 1e-9


# --- exponential smoothing -----------------------------------------------------------------


def _dbl(x: float = 0.0) -> Column:
    return F.lit(x).cast("double")


def smoothing_error(values: Column, alpha: Column) -> Column:
    """Squared error and best starting level for one smoothing weight.

    The fitted level is linear in the starting level, s + c * start, so one pass carries s, c
    and the sums that give the best start in closed form.
    """
    start = F.struct(
        _dbl().alias("s"), _dbl(1.0).alias("c"),
        _dbl().alias("rr"), _dbl().alias("rc"), _dbl().alias("cc"),
    )

    def step(a: Column, y: Column) -> Column:
        r = y - a["s"]
        return F.struct(
            (a["s"] + alpha * r).alias("s"),
            ((F.lit(1.0) - alpha) * a["c"]).alias("c"),
            (a["rr"] + r * r).alias("rr"),
            (a["rc"] + r * a["c"]).alias("rc"),
            (a["cc"] + a["c"] * a["c"]).alias("cc"),
        )

    def end(a: Column) -> Column:
        return F.struct(
            (a["rr"] - a["rc"] * a["rc"] / a["cc"]).alias("sse"),
            alpha.alias("alpha"),
            (a["rc"] / a["cc"]).alias("start"),
        )

    return F.aggregate(values, start, step, end)


def best_smoothing(values: Column, coarse: list[float] | None = None, fine: list[float] | None = None) -> Column:
    """Weight and starting level of least squared error; the smaller weight wins a tie.

    The best weight of a coarse grid is refined by a fine grid of offsets around it.
    """

    def least(weights: Column) -> Column:
        return F.array_min(F.transform(weights, lambda a: smoothing_error(values, a)))

    offsets = F.array(*[_dbl(x) for x in (FINE if fine is None else fine)])
    near = least(F.array(*[_dbl(a) for a in (coarse or COARSE)]))["alpha"]

    def around(a: Column) -> Column:
        return F.transform(offsets, lambda x: F.greatest(_dbl(), F.least(_dbl(1.0), a + x)))

    return F.element_at(F.transform(F.array(near), lambda a: least(around(a))), 1)


def smoothed_levels(values: Column, alpha: Column, start: Column) -> Column:
    """Level before every value and after the last one: n + 1 one-step predictions."""
    init = F.struct(start.alias("l"), F.array(start).alias("all"))

    def step(a: Column, y: Column) -> Column:
        level = a["l"] + alpha * (y - a["l"])
        return F.struct(level.alias("l"), F.concat(a["all"], F.array(level)).alias("all"))

    return F.aggregate(values, init, step, lambda a: a["all"])


# --- autoregression ------------------------------------------------------------------------


def _lagged(df: DataFrame, series: list[str], month: str, y: str, order: int) -> DataFrame:
    """Levels x0..x{order} and first differences d0..d{order}; index = lag."""
    w = W.partitionBy(*series).orderBy(month)
    df = df.withColumns(
        {f"_x{i}": F.col(y) if i == 0 else F.lag(y, i).over(w) for i in range(order + 2)}
    )
    return df.withColumns(
        {f"_d{i}": F.col(f"_x{i}") - F.col(f"_x{i + 1}") for i in range(order + 1)}
    )


def _moments(kind: str, p: int) -> dict[str, Column]:
    """Count, sums and cross sums of lags 0..p over rows where lag p exists."""
    v = [F.col(f"_{kind}{i}") for i in range(p + 1)]
    ok = v[p].isNotNull()
    out = {f"n_{kind}{p}": F.count(v[p]).cast("double")}
    for i in range(p + 1):
        out[f"s_{kind}{p}_{i}"] = F.sum(F.when(ok, v[i]))
    for i, j in combinations_with_replacement(range(p + 1), 2):
        out[f"q_{kind}{p}_{i}{j}"] = F.sum(F.when(ok, v[i] * v[j]))
    return out


def _solve(g: list[list[Column]], h: list[Column]) -> tuple[Column, list[Column]]:
    """Determinant and solution numerators of a symmetric system of size 1 to 3 (Cramer)."""
    if len(h) == 1:
        return g[0][0], [h[0]]
    if len(h) == 2:
        det = g[0][0] * g[1][1] - g[0][1] * g[0][1]
        return det, [h[0] * g[1][1] - h[1] * g[0][1], h[1] * g[0][0] - h[0] * g[0][1]]
    c00 = g[1][1] * g[2][2] - g[1][2] * g[1][2]
    c01 = g[0][2] * g[1][2] - g[0][1] * g[2][2]
    c02 = g[0][1] * g[1][2] - g[0][2] * g[1][1]
    c11 = g[0][0] * g[2][2] - g[0][2] * g[0][2]
    c12 = g[0][1] * g[0][2] - g[0][0] * g[1][2]
    c22 = g[0][0] * g[1][1] - g[0][1] * g[0][1]
    det = g[0][0] * c00 + g[0][1] * c01 + g[0][2] * c02
    return det, [
        h[0] * c00 + h[1] * c01 + h[2] * c02,
        h[0] * c01 + h[1] * c11 + h[2] * c12,
        h[0] * c02 + h[1] * c12 + h[2] * c22,
    ]


class _Model:
    """Expressions of one autoregressive model over its moments, in stages.

    Each stage is a set of columns that the next stage reads, so no expression is repeated.
    """

    def __init__(self, kind: str, p: int):
        self.kind, self.p, self.tag = kind, p, f"{kind}{p}"
        self.n = F.col(f"n_{self.tag}")
        self.pairs = list(combinations_with_replacement(range(p + 1), 2))

    def _c(self, i: int, j: int) -> Column:
        return F.col(f"c_{self.tag}_{min(i, j)}{max(i, j)}")

    def _s(self, i: int) -> Column:
        return F.col(f"s_{self.tag}_{i}")

    def centred(self) -> dict[str, Column]:
        n, tag = self.n, self.tag
        return {
            f"c_{tag}_{i}{j}": F.when(
                n > self.p + 1, F.col(f"q_{tag}_{i}{j}") - self._s(i) * self._s(j) / n
            )
            for i, j in self.pairs
        }

    def solved(self) -> dict[str, Column]:
        if self.p == 0:
            return {}
        lags = range(1, self.p + 1)
        det, tops = _solve([[self._c(i, j) for j in lags] for i in lags], [self._c(0, i) for i in lags])
        return {f"det_{self.tag}": det, **{f"t_{self.tag}_{i + 1}": t for i, t in enumerate(tops)}}

    def slopes(self) -> dict[str, Column]:
        if self.p == 0:
            return {}
        scale = self._c(1, 1)
        for i in range(2, self.p + 1):
            scale = scale * self._c(i, i)
        det = F.col(f"det_{self.tag}")
        good = (self.n > self.p + 1) & (F.abs(det) > _MIN_DET * scale)
        return {
            f"b_{self.tag}_{i}": F.when(good, F.col(f"t_{self.tag}_{i}") / det)
            for i in range(1, self.p + 1)
        }

    def model(self) -> Column:
        """(score, order, differenced, intercept, b1..b3), or null if the model has no fit."""
        b = [F.col(f"b_{self.tag}_{i}") for i in range(1, self.p + 1)]
        rss, icpt = self._c(0, 0), F.try_divide(self._s(0), self.n)
        for i, slope in enumerate(b):
            rss = rss - slope * self._c(0, i + 1)
            icpt = icpt - slope * F.try_divide(self._s(i + 1), self.n)
        score = F.log(F.greatest(F.try_divide(rss, self.n), F.lit(_MIN_RSS))) + F.try_divide(
            F.lit(2.0 * (self.p + 1)), self.n
        )
        fields = F.struct(
            score.alias("score"),
            F.lit(self.p).alias("order"),
            F.lit(1 if self.kind == "d" else 0).alias("differenced"),
            icpt.alias("intercept"),
            *[(b[i] if i < self.p else _dbl()).alias(f"b{i + 1}") for i in range(LAG)],
        )
        return F.when(b[0].isNotNull() if b else self.n > 1, fields)


def ar_models(
    df: DataFrame,
    series: list[str],
    month: str,
    y: str,
    order: int = LAG,
    split: list[str] | None = None,
    extra: list[Column] | None = None,
) -> DataFrame:
    """Best autoregressive model of every series as struct `ar`, beside `extra` aggregates.

    Lags run over rows that agree in the `split` columns.
    """
    models = [_Model(k, p) for k in ("x", "d") for p in range(order + 1)]
    sums: dict[str, Column] = {}
    for m in models:
        sums.update(_moments(m.kind, m.p))
    extra = extra or []
    grouped = _lagged(df, [*series, *(split or [])], month, y, order).groupBy(*series).agg(
        *extra, *[v.alias(k) for k, v in sums.items()]
    )
    keep = [c for c in grouped.columns if c not in sums]
    for stage in (_Model.centred, _Model.solved, _Model.slopes):
        grouped = grouped.withColumns({k: v for m in models for k, v in stage(m).items()})
    best = F.array_min(F.array_compact(F.array(*[m.model() for m in models])))
    return grouped.select(*keep, best.alias("ar"))


def ar_prediction(model: Column, before: list[Column]) -> Column:
    """Prediction from the values before: before[0] is the previous one.

    Lags that a model does not use are not needed to be present.
    """
    b = [model.getField(f"b{i + 1}") for i in range(LAG)]

    def line(v: list[Column]) -> Column:
        out = model.getField("intercept")
        for i in range(LAG):
            out = out + F.when(F.lit(i) < model.getField("order"), b[i] * v[i]).otherwise(_dbl())
        return out

    diffs = [before[i] - before[i + 1] for i in range(LAG)]
    return F.when(model.getField("differenced") == 1, before[0] + line(diffs)).otherwise(line(before))


# --- the three predictions together --------------------------------------------------------


def predict(
    df: DataFrame,
    series: list[str],
    month: str,
    y: str,
    current: Column,
    carry: list[str] | None = None,
    spread: bool = True,
) -> DataFrame:
    """All rows of every series, and one for the month after `current`, with `ma`, `es`, `arima`.

    The input holds one row per series and month. Training rows are those with a finite value,
    up to the current month; other rows stay without predictions. A series needs two training
    rows (three with the new one). The first three smoothing and autoregressive values are
    missing, as is a moving average without three values before it. `carry` names further
    columns to keep, which saves a join back to the input. `spread` distributes the series over
    all shuffle partitions; leave it out when the input is already spread by series.
    """
    carry = carry or []
    df = spread_series(df, series) if spread else df
    trains = finite(F.col(y)) & (F.col(month) <= current)
    flagged = df.withColumns({"_y": F.when(trains, F.col(y)), "_train": trains})
    pair = F.struct(F.col(month).alias("m"), F.col("_y").alias("y"))
    kept = F.struct(F.col(month).alias("m"), F.struct(F.lit(1).alias("_"), *carry).alias("row"))
    fitted = ar_models(
        flagged, series, month, "_y", split=["_train"],
        extra=[
            F.sort_array(F.collect_list(F.when(F.col("_train"), pair))).alias("hist"),
            F.collect_list(kept).alias("all"),
        ],
    )
    enough = F.size("hist") >= 2
    fitted = fitted.withColumns(
        {
            "vals": F.transform("hist", lambda r: r["y"]),
            "all": F.map_from_entries("all"),
            "seen": F.transform("hist", lambda r: r["m"]),
            "new": F.when(enough, F.array(next_month(current))).otherwise(F.array().cast("array<date>")),
        }
    )
    fitted = fitted.withColumn("es", F.when(enough, best_smoothing(F.col("vals"))))
    levels = smoothed_levels(F.col("vals"), F.col("es.alpha"), F.col("es.start"))
    months = F.array_union(F.map_keys("all"), F.col("new"))
    rows = fitted.withColumn("levels", F.when(enough, levels)).select(
        *series, "seen", "vals", "levels", "ar", "all", F.explode(months).alias(month)
    )
    at = F.array_position(F.col("seen"), F.col(month)).cast("int")
    pos = F.when(at > 0, at - 1).when(F.col(month) == next_month(current), F.size("seen"))
    rows = rows.withColumns({"pos": pos, "_kept": F.try_element_at("all", F.col(month))})
    before = [
        F.when(F.col("pos") > i, F.get(F.col("vals"), F.col("pos") - (i + 1))) for i in range(LAG + 1)
    ]
    rows = rows.withColumns({f"_p{i}": b for i, b in enumerate(before)})
    p = [F.col(f"_p{i}") for i in range(LAG + 1)]
    late = F.col("pos") >= LAG
    return rows.select(
        *series,
        month,
        *[F.col(f"_kept.{c}").alias(c) for c in carry],
        F.when(late, (p[2] + p[1] + p[0]) / F.lit(3.0)).alias("ma"),
        F.when(late, F.get(F.col("levels"), F.col("pos"))).alias("es"),
        F.when(late, ar_prediction(F.col("ar"), p)).alias("arima"),
    )
