"""Embedding whitening: leading principal components by spectrum slicing, and the whitened coordinates of every row.

Vectors become integers x = floor(64 * c) + 1000000. One pass over the table adds up x per dimension, a second one
the products of the centred x (NumPy blocks inside the tasks, partial sums added by Spark), so only the covariance,
a matrix of the dimension whatever the number of rows, reaches the driver. There:

* The covariance is reduced to a tridiagonal matrix by reflections. Shifted by s it is L D L^T, and by Sylvester's
  law of inertia the number of negative entries in D is the number of eigenvalues below s. Bisection on these
  counts gives each of the leading eigenvalues an interval of its own.
* Rayleigh quotient iteration starts inside the interval and converges cubically; a quotient that leaves the
  interval is replaced by the middle of a shorter one.
* The counts left and right of the result certify that it is the eigenvalue with that number. Equal eigenvalues
  can't be parted; their vectors are any orthonormal basis, in a fixed order.

A third pass measures how far the covariance of the whitened values is from the identity, a fourth returns them.

Results of edge cases: rows with a null or empty vector, or with a null, NaN or infinite entry, go. So do rows with an entry
for which floor(64 * c) lies beyond 2^52, where doubles aren't integers one apart any more, and rows whose dimension
isn't the commonest one (the smaller at a tie). Null and repeated ids stay; repeated rows count as often as they
occur. An empty table gives no rows. A component without variance (eigenvalue not above the rounding of the largest)
has null `whitened` and takes no part in `identity_error`; `explained` is null if there is no variance at all, and
`identity_error` is null without a component that has some. `deviation` is null where it doesn't fit a long;
`deviation_exact` is a decimal of 38 digits, and null beyond them. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Entries beyond this have no exact neighbours as doubles.
WIDEST = 2.0**52
#: Rows of one matrix product.
BLOCK = 4096
EPS = float(np.finfo(float).eps)
_LOW = (1 << 26) - 1


@dataclass(frozen=True)
class Fit:
    """What the passes over the table have found; of the size of the covariance."""

    n: int
    total: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.total)

    @property
    def middle(self) -> np.ndarray:
        """The integer next to each mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.total], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what is left of the means beside `middle`; at most n / 2."""
        return [s - self.n * int(m) for s, m in zip(self.total, self.middle, strict=True)]

    @property
    def usable(self) -> np.ndarray:
        """Components with a variance above rounding."""
        top = float(self.values.max(initial=0.0))
        return self.values > self.dim * EPS * top

    @property
    def projector(self) -> np.ndarray:
        """Centred x to whitened values; NaN for components without variance."""
        safe = np.where(self.usable, self.values, np.nan)
        return self.vectors / np.sqrt(safe)


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of all vectors of a batch, whether each one counts, and the x of all entries, end to end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    flat = column.values[ends[0] : ends[-1]].cast(pa.float64())
    entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = (ends - ends[0]).astype(np.int64)
    sizes = np.diff(ends)
    with np.errstate(all="ignore"):
        scaled = np.floor(entries * SCALE)
        wrong = ~(np.abs(scaled) <= WIDEST)
    before = np.concatenate([[0], np.cumsum(wrong)])
    good = (before[ends[1:]] == before[ends[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    x = np.where(wrong, 0, scaled).astype(np.int64) + SHIFT
    return sizes, good, x


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The x of the vectors that count and have `dim` entries, and their places in the batch."""
    sizes, good, x = integers(column)
    good &= sizes == dim
    return x[np.repeat(good, sizes)].reshape(-1, dim), np.flatnonzero(good)


def _sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns; high and low parts apart, so that none overflows."""
    high, low = (x >> 26).sum(0), (x & _LOW).sum(0)
    return [(int(h) << 26) + int(v) for h, v in zip(high, low, strict=True)]


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors of the commonest dimension and the exact sum of x per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            sizes, good, x = integers(batch.column(0))
            for dim in np.unique(sizes[good & (sizes > 0)]).tolist():
                mine = good & (sizes == dim)
                part = _sums(x[np.repeat(mine, sizes)].reshape(-1, dim))
                counts[dim] = counts.get(dim, 0) + int(mine.sum())
                sums[dim] = [a + b for a, b in zip(sums.get(dim, [0] * dim), part, strict=True)]
        for dim, n in counts.items():
            cells = [Decimal(n), *map(Decimal, sums[dim])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(cells)), pa.array(range(-1, dim)), pa.array(cells, pa.decimal128(28, 0))],
                ["dim", "pos", "part"],
            )

    parts = vectors.mapInArrow(add, "dim long, pos long, part decimal(28,0)")
    added = parts.groupBy("dim", "pos").agg(F.sum("part").alias("total"))
    common = added.filter("pos = -1").orderBy(F.col("total").desc(), "dim").select("dim").limit(1).collect()
    if not common:
        return 0, []
    dim = common[0]["dim"]
    rows = {r["pos"]: int(r["total"]) for r in added.filter(F.col("dim") == dim).collect()}
    return rows[-1], [rows[i] for i in range(dim)]


def gram(vectors: DataFrame, prepare: Callable[[np.ndarray], np.ndarray], dim: int, width: int) -> np.ndarray:
    """Sum over all rows of the outer product of `prepare(x)` with itself.

    Tasks send the upper triangle of their sum; Spark adds these up, one group per cell.
    """
    upper = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for batch in batches:
            x, _ = matrix(batch.column(0), dim)
            for start in range(0, len(x), BLOCK):
                y = prepare(x[start : start + BLOCK])
                total += y.T @ y
                some = True
        if some:
            cells = total[upper]
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0]), pa.array(upper[1]), pa.array(cells)], ["row", "col", "part"]
            )

    parts = vectors.mapInArrow(multiply, "row long, col long, part double")
    out = np.zeros((width, width))
    for r in parts.groupBy("row", "col").agg(F.sum("part").alias("cell")).collect():
        out[r["row"], r["col"]] = out[r["col"], r["row"]] = r["cell"]
    return out


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and subdiagonal of a tridiagonal matrix with the eigenvalues of the symmetric matrix `v`."""
    a = v.copy()
    d = len(a)
    off = np.zeros(max(d - 1, 0))
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        length = float(np.linalg.norm(x))
        if not np.abs(x[1:]).any():
            off[k] = x[0]
            continue
        off[k] = -np.copysign(length, x[0])
        x[0] -= off[k]
        x /= np.linalg.norm(x)
        block = a[k + 1 :, k + 1 :]
        p = block @ x
        p -= (x @ p) * x
        block -= 2 * (np.outer(x, p) + np.outer(p, x))
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return np.diag(a).copy(), off


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues below each shift: negative pivots of L D L^T of the shifted matrix."""
    tiny = EPS * EPS * max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)), 1e-200)
    squares = np.concatenate([[0.0], off * off])
    count = np.zeros(len(shifts), dtype=np.int64)
    pivot = np.ones(len(shifts))
    for value, square in zip(diagonal, squares, strict=True):
        pivot = value - shifts - square / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues of the symmetric matrix `v`, falling, and their vectors as columns."""
    d = len(v)
    k = min(most, d)
    norm = float(np.abs(v).sum(1).max(initial=0.0))
    if norm == 0:
        return np.zeros(k), np.eye(d)[:, :k]
    diagonal, off = tridiagonal(v)
    place = d - 1 - np.arange(k)  # eigenvalues smaller than the one with this number
    margin = 8 * d * EPS * norm
    low, high = np.full(k, -norm - margin), np.full(k, norm + margin)

    def halve(low: np.ndarray, high: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = (low + high) / 2
        left = below(diagonal, off, middle) > place
        return np.where(left, low, middle), np.where(left, middle, high)

    for _ in range(70):
        low, high = halve(low, high, place)
        alone = below(diagonal, off, high + margin) - below(diagonal, off, low - margin) == 1
        if (alone | (high - low <= margin)).all():
            break
    rng = np.random.default_rng(13)
    values, found = np.zeros(k), np.zeros((d, 0))
    for i in range(k):
        values[i], x = _quotients(v, found, rng.standard_normal(d), low[i : i + 1], high[i : i + 1],
                                  place[i : i + 1], halve, margin)
        near = below(diagonal, off, np.array([values[i] - margin, values[i] + margin]))
        if not near[0] <= place[i] < near[1]:
            raise ArithmeticError(f"the counts don't certify eigenvalue {i + 1}")
        x = x if x[np.abs(x).argmax()] > 0 else -x
        found = np.column_stack([found, x])
    return values, found


def _quotients(
    v: np.ndarray,
    found: np.ndarray,
    start: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    place: np.ndarray,
    halve: Callable[..., tuple[np.ndarray, np.ndarray]],
    margin: float,
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration for the eigenvalue between `low` and `high`, orthogonal to the vectors found."""
    x = _unit(start, found)
    shift = float(low[0] + high[0]) / 2
    best: tuple[float, float, np.ndarray] | None = None
    for _ in range(80):
        x = _unit(_solve(v, shift, x, margin), found)
        image = v @ x
        quotient = float(x @ image)
        error = float(np.linalg.norm(image - quotient * x))
        inside = low[0] - margin <= quotient <= high[0] + margin
        if inside and (best is None or error < best[0]):
            best = (error, quotient, x)
        elif inside and error <= margin and best is not None:
            break  # as exact as doubles get
        if inside and error <= (high[0] - low[0]) / 4:
            shift = quotient
        else:
            low, high = halve(low, high, place)
            shift = float(low[0] + high[0]) / 2
    if best is None:
        raise ArithmeticError("no vector for an interval of the spectrum")
    return best[1], best[2]


def _solve(v: np.ndarray, shift: float, x: np.ndarray, margin: float) -> np.ndarray:
    """Solution of (v - shift) y = x; a shift that is an eigenvalue to the last bit moves a little."""
    while True:
        try:
            y = np.linalg.solve(v - shift * np.eye(len(v)), x)
            if np.isfinite(y).all():
                return y / np.abs(y).max()
        except np.linalg.LinAlgError:
            pass
        shift += margin / 16


def _unit(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """`x` orthogonal to the columns found, of length one."""
    for _ in range(2):
        x = x / np.linalg.norm(x)
        x = x - found @ (found.T @ x)
    return x / np.linalg.norm(x)


def centred(n: int, total: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x minus its exact mean: the integer part before, the rest after the change to doubles."""
    bare = Fit(n, total, np.zeros((0, 0)), np.zeros(0), 0.0)
    middle, rest = bare.middle, np.array([r / n for r in bare.rest])
    return lambda x: (x - middle) - rest


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Fit | None:
    """Means, leading components and their variances of a one-column table of vectors; None without any."""
    n, total = totals(vectors)
    if not n:
        return None
    covariance = gram(vectors, centred(n, total), len(total), len(total)) / n
    values, found = leading(covariance, most)
    return Fit(n, total, found, np.maximum(values, 0.0), float(np.trace(covariance)))


def identity_error(vectors: DataFrame, model: Fit) -> float | None:
    """Largest entry of the whitened values' covariance minus the identity, measured on the values themselves."""
    use = model.usable
    width = int(use.sum())
    if not width:
        return None
    centre, projector = centred(model.n, model.total), model.projector[:, use]
    spread = gram(vectors, lambda x: centre(x) @ projector, model.dim, width) / model.n
    return float(np.abs(spread - np.eye(width)).max())


def _deviations(x: np.ndarray, model: Fit) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact."""
    z, rest = x - model.middle, np.array(model.rest, dtype=np.int64)
    widest = model.n * int(np.abs(z).max(initial=0)) + int(np.abs(rest).max(initial=0))
    if widest**2 * model.dim >= 2**63:
        z, rest = z.astype(object), rest.astype(object)
    return ((z * model.n - rest) ** 2).sum(1).tolist()


def whiten(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector: its id, n, deviation, deviation_exact and the list `whitened`.

    Also `explained` (a list, one per component) and `identity_error`, the same on all rows.
    """
    slim = df.select(F.col(ident), F.col(vector).cast("array<double>").alias("vector"))
    model = fit(slim.select("vector"), most)
    kind = slim.schema[0].dataType.simpleString()
    schema = f"`{ident}` {kind}, deviation long, deviation_exact decimal(38,0), whitened array<double>"
    if model is None:
        empty = df.sparkSession.createDataFrame([], schema)
        return _with_fit(empty, 0, F.lit(None).cast("array<double>"), None)
    centre, projector, usable = centred(model.n, model.total), model.projector, model.usable
    width = len(usable)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = matrix(batch.column(1), model.dim)
            values = (centre(x) @ projector).ravel()
            cells = pa.array(values, mask=np.tile(~usable, len(x)))
            exact = _deviations(x, model)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array([e if e < 2**63 else None for e in exact], pa.int64()),
                    pa.array([Decimal(e) if e < 10**38 else None for e in exact], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, width), pa.int32()), cells),
                ],
                [ident, "deviation", "deviation_exact", "whitened"],
            )

    error = identity_error(slim.select("vector"), model)
    share = [e / model.trace if model.trace > 0 else None for e in model.values.tolist()]
    return _with_fit(slim.mapInArrow(project, schema), model.n, F.lit(share).cast("array<double>"), error)


def _with_fit(rows: DataFrame, n: int, explained: Column, error: float | None) -> DataFrame:
    return rows.withColumns(
        {
            "n": F.lit(n).cast("long"),
            "explained": explained,
            "identity_error": F.lit(error).cast("double"),
        }
    )


def whitening_report(df: DataFrame) -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact."""
    rows = whiten(df.select("vec_id", "embedding"))
    long = rows.select(
        "vec_id", "n", "deviation", "explained", "identity_error", "deviation_exact",
        F.posexplode("whitened").alias("at", "whitened"),
    )
    return long.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
        "deviation_exact",
    )
