"""Forecast models against plain recursions and least squares."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costloom.operators import forecast
from tests.helpers import close, day, one

SCHEMA = "k string, m date, y double"


def month(i: int) -> dt.date:
    return dt.date(2015 + i // 12, i % 12 + 1, 1)


def frame(spark, series: dict[str, list[float | None]]):
    data = [(k, month(i), v) for k, ys in series.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(data, SCHEMA)


def levels(ys, alpha, start):
    out = [start]
    for y in ys:
        out.append(out[-1] + alpha * (y - out[-1]))
    return out


def sse(ys, alpha, start):
    return sum((y - p) ** 2 for y, p in zip(ys, levels(ys, alpha, start)))


def random_series(seed: int, n: int) -> list[float]:
    rnd = random.Random(seed)
    out = [100.0, 103.0, 99.0]
    while len(out) < n:
        out.append(40 + 0.5 * out[-1] + 0.3 * out[-2] - 0.2 * out[-3] + rnd.gauss(0, 4))
    return out[:n]


@pytest.mark.parametrize("seed, n", [(1, 24), (2, 60), (3, 6)])
def test_smoothing_is_the_best_of_its_grid(spark, seed, n):
    ys = random_series(seed, n)
    best = one(spark, forecast.best_smoothing(F.array(*[F.lit(y) for y in ys])))
    assert close(best.sse, sse(ys, best.alpha, best.start), 1e-6)
    # no other start, and no weight of the coarse grid, does better
    for shift in (-1.0, 0.5, 3.0):
        assert sse(ys, best.alpha, best.start + shift) > best.sse
    for alpha in forecast.COARSE:
        for start in np.linspace(min(ys), max(ys), 41):
            assert sse(ys, alpha, start) >= best.sse - 1e-6
    shown = one(spark, forecast.smoothed_levels(F.array(*[F.lit(y) for y in ys]), F.lit(best.alpha), F.lit(best.start)))
    assert all(close(a, b) for a, b in zip(shown, levels(ys, best.alpha, best.start), strict=True))


def ar_by_lstsq(ys):
    """Best (score, order, differenced, coefficients) by least squares."""
    found = []
    for diff in (0, 1):
        z = np.diff(ys) if diff else np.array(ys)
        for p in range(4):
            n = len(z) - p
            if n <= (p + 1 if p else 1):
                continue
            x = np.column_stack([np.ones(n)] + [z[p - i : len(z) - i] for i in range(1, p + 1)])
            target = z[p:]
            coef, *_ = np.linalg.lstsq(x, target, rcond=None)
            rss = float(((target - x @ coef) ** 2).sum())
            found.append((np.log(max(rss / n, 1e-12)) + 2 * (p + 1) / n, p, diff, coef))
    return min(found, key=lambda f: f[:3])


@pytest.mark.parametrize("seed, n", [(1, 40), (5, 24), (9, 80), (12, 7)])
def test_autoregression_matches_least_squares(spark, seed, n):
    ys = random_series(seed, n)
    model = forecast.ar_models(frame(spark, {"a": ys}), ["k"], "m", "y").first()["ar"]
    _, p, diff, coef = ar_by_lstsq(ys)
    assert (model.order, model.differenced) == (p, diff)
    got = [model.intercept, model.b1, model.b2, model.b3][: p + 1]
    assert all(close(a, b, 1e-5) for a, b in zip(got, coef))


def test_random_walk_is_differenced(spark):
    rnd = random.Random(4)
    ys = [100.0]
    for _ in range(79):
        ys.append(ys[-1] + 2 + rnd.gauss(0, 1))
    model = forecast.ar_models(frame(spark, {"a": ys}), ["k"], "m", "y").first()["ar"]
    assert model.differenced == 1


def test_predictions(spark):
    gap = random_series(8, 24)
    gap[5] = None
    gap[9] = float("inf")
    series = {
        "long": random_series(7, 24),
        "gap": gap,
        "constant": [5.0] * 8,
        "short": [1.0, 2.0],
        "single": [3.0] + [None] * 5,
        "empty": [None] * 6,
    }
    df = frame(spark, series).withColumn("extra", F.col("y") * 2)
    current = F.lit(month(23))
    out = forecast.predict(df, ["k"], "m", "y", current, carry=["extra"])
    by = {}
    for r in out.orderBy("k", "m").collect():
        by.setdefault(r.k, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {
        "long": 25, "gap": 25, "constant": 9, "short": 3, "single": 6, "empty": 6}
    ys = series["long"]
    best = one(spark, forecast.best_smoothing(F.array(*[F.lit(y) for y in ys])))
    want = levels(ys, best.alpha, best.start)
    _, p, diff, coef = ar_by_lstsq(ys)
    assert diff == 0
    for i, r in enumerate(by["long"]):
        assert close(r.extra, 2 * ys[i] if i < 24 else None)
        if i < 3:
            assert (r.ma, r.es, r.arima) == (None, None, None)
        else:
            assert close(r.ma, sum(ys[i - 3 : i]) / 3)
            assert close(r.es, want[i])
            assert close(r.arima, coef[0] + sum(coef[j] * ys[i - j] for j in range(1, p + 1)), 1e-5)
    # rows without a finite value are left out of the training series, but stay in the output
    missing = by["gap"][5]
    assert (missing.m, missing.ma, missing.es) == (month(5), None, None)
    kept = [v for v in gap if v is not None and v != float("inf")]
    assert close(by["gap"][6].ma, sum(kept[2:5]) / 3)
    assert close(by["gap"][-1].ma, sum(kept[-3:]) / 3)
    last = by["constant"][-1]
    assert last.m == month(24) and close(last.ma, 5.0) and close(last.es, 5.0) and close(last.arima, 5.0)
    assert all(r.ma is None and r.es is None and r.arima is None for k in ("single", "empty", "short") for r in by[k])
    assert by["short"][-1].m == month(24)


def test_rows_after_the_current_month_are_not_trained_on(spark):
    ys = random_series(3, 20)
    cut = forecast.predict(frame(spark, {"a": ys}), ["k"], "m", "y", F.lit(month(11)))
    alone = forecast.predict(frame(spark, {"a": ys[:12]}), ["k"], "m", "y", F.lit(month(11)))
    a = {r.m: (r.ma, r.es, r.arima) for r in cut.collect()}
    b = {r.m: (r.ma, r.es, r.arima) for r in alone.collect()}
    assert len(a) == 20 and len(b) == 13
    assert all(a[m] == b[m] for m in b)
    assert all(v == (None, None, None) for m, v in a.items() if m > month(12))
    assert day("2016-01-01") in a
