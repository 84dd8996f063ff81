"""Rows before and after each lookup, counted while a job writes its tables.

A left lookup keeps every input row and repeats it where the lookup table has its key more than once, as a merge does.
Inside `with LookupWatch() as watch:` each lookup counts its rows on both sides by `DataFrame.observe`, so no input
is read again; `watch.report()` then names the repeated keys of the lookups that multiplied rows. Outside nothing is
counted, and plans are as they are without this module (an observed frame stops some of the optimizer's moves).
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from contextvars import ContextVar, Token
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_active: ContextVar[LookupWatch | None] = ContextVar("lookup_watch", default=None)
#: Repeated keys that a report names per lookup.
NAMED = 20
#: Seconds to wait for counts after the job; they arrive with its last action, if they arrive.
PATIENCE = 5.0


@dataclass(frozen=True)
class LookupRows:
    """Rows of one lookup. Counts are null if the optimizer or an empty input left the lookup out."""

    lookup: str
    rows_before: int | None
    rows_after: int | None
    repeated_keys: list[str]


@dataclass(frozen=True)
class _Counted:
    lookup: str
    before: Observation
    after: Observation
    dim: DataFrame
    keys: list[str]


class LookupWatch:
    """Collects the lookups of the frames that are built while it is active."""

    def __init__(self) -> None:
        self._counted: list[_Counted] = []
        self._token: Token | None = None

    def __enter__(self) -> LookupWatch:
        self._token = _active.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _active.reset(self._token)

    def add(
        self, lookup: str, df: DataFrame, dim: DataFrame, keys: list[str], join: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        before, after = Observation(), Observation()
        self._counted.append(_Counted(lookup, before, after, dim, keys))
        rows = F.count(F.lit(1)).alias("rows")
        return join(df.observe(before, rows)).observe(after, rows)

    def report(self) -> list[LookupRows]:
        """One entry per lookup whose frame some action has computed, in the order of building.

        More rows after than before may also come from a task that ran twice before a shuffle; the repeated keys are
        looked up in the lookup table itself, so a lookup without repeated keys has multiplied nothing.
        """
        counts = _counts([o for c in self._counted for o in (c.before, c.after)])
        out = []
        for c, before, after in zip(self._counted, counts[::2], counts[1::2], strict=True):
            grown = before is not None and after is not None and after > before
            out.append(LookupRows(c.lookup, before, after, _repeated(c.dim, c.keys) if grown else []))
        return out


def _counts(observations: list[Observation]) -> list[int | None]:
    """Counts of the observations that an action has filled; reading one that none has filled would wait for ever."""
    found: list[int | None] = [None] * len(observations)

    def read(i: int) -> None:
        found[i] = observations[i].get["rows"]

    threads = [threading.Thread(target=read, args=(i,), daemon=True) for i in range(len(observations))]
    for t in threads:
        t.start()
    for i, t in enumerate(threads):
        # Only the first ones wait: what has not come by then was never computed.
        t.join(PATIENCE if not any(x.is_alive() for x in threads[:i]) else 0.05)
    return list(found)


def _repeated(dim: DataFrame, keys: list[str]) -> list[str]:
    groups = dim.groupBy(*[_col(k) for k in keys]).count().filter(F.col("count") > 1)
    known = groups.dropna(subset=[f"`{k}`" for k in keys]) if keys else groups
    shown = F.concat_ws(", ", *[_col(k).cast("string") for k in keys])
    name = F.concat(shown, F.lit(" ("), F.col("count").cast("string"), F.lit(" rows)"))
    return [r[0] for r in known.select(name.alias("name")).orderBy("name").limit(NAMED).collect()]


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def counted(
    lookup: str, df: DataFrame, dim: DataFrame, keys: list[str], join: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`join(df)`, with its rows counted if a watch is active."""
    watch = _active.get()
    return join(df) if watch is None else watch.add(lookup, df, dim, keys, join)
