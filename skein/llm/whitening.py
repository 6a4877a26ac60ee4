"""Whitening of embeddings through a covariance found by polarisation.

An entry c becomes the integer x = floor(64 c) + 1,000,000. The covariance of two dimensions follows
from variances alone: var(i + j) = var(i) + var(j) + 2 cov(i, j). So one pass sums the squared
centred values of every dimension and of the sum of every pair of dimensions, all of them integers
and exact; differences of those give V, which is assembled and handed to ``eigh``.

Values are centred before they are squared: by the integer nearest to the dimension's mean, which is
known from the pass before, and what that rounding leaves (less than a half) is taken off exactly.

Four passes over the vectors (sums, squares, check, output), each with the same small state however
many rows there are: a task hands over one number for each dimension or pair, these are added by a
shuffle, and the driver receives width * (width + 1) / 2 numbers, a matter of the vectors' width alone.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry are left out; all
others, repeated rows and rows without an id among them, are fitted and returned once each. Vectors
of unequal width are an error. An empty table, or vectors of width 0, give no rows. A direction without
variance (eigenvalue within ``FLAT`` of the trace) can't be scaled to 1: its ``whitened`` is null, and
it is left out of ``identity_error``. Entries whose 64-fold leaves the range of 2^61 count as that bound.
``deviation`` is null where a long can't hold it. Only the two named columns are read, so others never clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import give_back

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Share of the trace below which a direction counts as having no variance.
FLAT = 1e-12
#: Rows of a tile; with entries below ``NARROW`` the squares of a tile's pair sums fit 64 bits.
TILE = 2_048
NARROW = 1 << 24
_LIMIT = float(1 << 61)
_SUMS = "i int, j int, s decimal(38,0)"
_ROWS = "vec_id long, component int, deviation long, whitened double, explained double"


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v (doubles) of the rows whose vector is whole and finite."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~bad)


def tiles(batches: Iterator[pa.RecordBatch], width: int, at: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with their integer matrices."""
    for b in batches:
        for start in range(0, b.num_rows, TILE):
            part = b.slice(start, TILE)
            c = part.column(at).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
            with np.errstate(over="ignore"):
                yield part, np.clip(np.floor(SCALE * c), -_LIMIT, _LIMIT).astype(np.int64) + OFFSET


def exact(values: np.ndarray) -> np.ndarray:
    """The same integers, as Python's unbounded ones if their squares could leave 64 bits."""
    return values if not values.size or max(int(values.max()), -int(values.min())) < NARROW else values.astype(object)


def _totals(vectors: DataFrame, width: int, per_tile: Callable[[np.ndarray], np.ndarray], i: list[int], j: list[int]) -> dict[tuple[int, int], int]:
    """{(i, j): sum over all rows}: one number a task and cell, added by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(len(i), dtype=object)
        for _, x in tiles(batches, width):
            acc = acc + per_tile(x).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(a) for a in acc], pa.decimal128(38, 0))], ["i", "j", "s"])
        give_back()

    rows = vectors.select("v").mapInArrow(run, _SUMS).groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    return {(r["i"], r["j"]): int(r["s"]) for r in rows}


def _column_sums(x: np.ndarray) -> np.ndarray:
    wide = x.size and max(int(x.max()), -int(x.min())) >= 1 << 50
    return (x.astype(object) if wide else x).sum(axis=0)


def _squares(centre: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Sums of squares of a tile: of every dimension, then of the sum of every pair (i < j)."""

    def run(x: np.ndarray) -> np.ndarray:
        e = exact(centred(x, centre))
        out = [(e * e).sum(axis=0)]
        for i in range(e.shape[1] - 1):
            t = e[:, i: i + 1] + e[:, i + 1:]
            out.append((t * t).sum(axis=0) if t.dtype == object else np.einsum("rc,rc->c", t, t))
        return np.concatenate(out)

    return run


def centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    return x - np.array(centre, dtype=np.int64)  # both within 2^61 and a little


@dataclass
class Whitening:
    """A fit: ``n`` vectors, their integer sums, the integer centres, eigenvalues and eigenvectors (columns)."""
    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def centre(self) -> list[int]:
        return [round_div(s, self.n) for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """n times what the integer centre leaves of the mean."""
        return [s - self.n * m for s, m in zip(self.sums, self.centre)]

    @property
    def explained(self) -> np.ndarray:
        trace = float(np.trace(self.covariance))
        return self.values / trace if trace else np.full(len(self.values), np.nan)

    def projection(self) -> np.ndarray:
        """Columns scaled to variance 1; NaN where there is none."""
        flat = self.values <= FLAT * np.trace(self.covariance)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(flat, np.nan, self.vectors / np.sqrt(np.maximum(self.values, 0)))


def round_div(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all of ``usable`` vectors; None without any."""
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    n, width = shape["n"], shape["most"]
    if not n or not width:
        return None
    if shape["least"] != width:
        raise ValueError(f"vectors have {shape['least']} to {width} entries")
    one = list(range(width))
    totals = _totals(vectors, width, _column_sums, one, one)
    sums = [totals[i, i] for i in one]
    centre = [round_div(s, n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    pairs = [(i, i) for i in one] + [(i, j) for i in one for j in range(i + 1, width)]
    q = _totals(vectors, width, _squares(centre), [i for i, _ in pairs], [j for _, j in pairs])
    # n^2 times the variances of dimensions and of pair sums, then polarisation; all integers
    var = {(i, j): n * q[i, j] - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for i, j in pairs}
    cov = np.empty((width, width))
    for i, j in pairs:
        twice = 2 * var[i, i] if i == j else var[i, j] - var[i, i] - var[j, j]
        cov[i, j] = cov[j, i] = twice / (2 * n * n)  # one rounding
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    basis = basis[:, order]
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(len(order))])
    return Whitening(n, sums, cov, np.maximum(values[order], 0), basis)


def _projected(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    shift, matrix, centre = np.array([r / model.n for r in model.rest]), model.projection(), model.centre
    return lambda x: (centred(x, centre).astype(np.float64) - shift) @ matrix


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured."""
    width, project = len(model.sums), _projected(model)
    live = np.flatnonzero(~np.isnan(model.projection()).any(axis=0))
    k = len(live)
    if not k:
        return 0.0
    i, j = [list(map(int, a)) for a in np.triu_indices(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for _, x in tiles(batches, width):
            w = project(x)[:, live]
            total += w.sum(axis=0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([-1] * k + i, pa.int32()), pa.array([*range(k), *j], pa.int32()), pa.array(np.concatenate([total, products[i, j]]))],
                                         ["i", "j", "s"])

    rows = vectors.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    got = {(r["i"], r["j"]): r["s"] / model.n for r in rows}
    return max(abs(got[a, b] - got[-1, a] * got[-1, b] - (a == b)) for a, b in zip(i, j))


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Exact sum over dimensions of (n x - S)^2: n^2 sum e^2 - 2 n sum e rest + sum rest^2."""
    e = exact(centred(x, model.centre))
    small = max(map(abs, model.rest)) * NARROW * len(model.rest) < 1 << 62
    rest = np.array(model.rest, dtype=np.int64 if small else object)
    squares, mixed = (e * e).sum(axis=1), (e * rest).sum(axis=1)
    own, n = sum(r * r for r in model.rest), model.n
    return [n * n * a - 2 * n * b + own for a, b in zip(squares.tolist(), mixed.tolist())]


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component, deviation, whitened, explained: one row for each vector and component."""
    width, project, k = len(model.sums), _projected(model), len(model.values)
    explained = model.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in tiles(batches, width, at=1):
            rows = len(x)
            ids = part.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
            dev = [d if d < 1 << 63 else None for d in _deviations(x, model)]
            w = project(x).ravel()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(dev, pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                 pa.array(w, mask=np.isnan(w)), pa.array(np.tile(explained, rows), from_pandas=True)],
                ["vec_id", "component", "deviation", "whitened", "explained"])
        give_back()

    return vectors.select("vec_id", "v").mapInArrow(run, _ROWS)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of all usable vectors."""
    rows = usable(vectors, vec_id, embedding)
    model = fit(rows, components)
    if model is None:
        out, n, error = rows.sparkSession.createDataFrame([], _ROWS), 0, 0.0
    else:
        out, n, error = transform(rows, model), model.n, identity_error(rows, model)
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(float(error)).alias("identity_error"))
