from __future__ import annotations

import datetime as dt
import math


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *cols):
    """Rows as sorted tuples, missing values last."""
    picked = df.select(*cols) if cols else df
    out = [tuple(r) for r in picked.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def one(spark, expr):
    """Value of a column expression."""
    return spark.range(1).select(expr.alias("x")).first()[0]


def close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=rel, abs_tol=1e-9)
