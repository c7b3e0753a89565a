"""Whitening of embeddings by a covariance matrix that is put together from variances only.

Entries become integers x = floor(256 * c). The fit list holds every distinct x vector once: n of them,
with sums S per dimension. Tasks add up, exactly, (n*x - S)^2 for every dimension and for the sum of every
pair of dimensions. By polarisation, half of what a pair's sum has above its two parts is their covariance,
so the driver gets d*(d+1)/2 integers, rebuilds the matrix and takes its eigenvectors. It is the dimension
that bounds what reaches the driver, not the number of rows.

Rows whose vector is null, empty or holds a null or non-finite entry are left out. If lengths differ, the
length most distinct vectors have is taken (the longer of two as frequent) and rows of other lengths are left
out. Repeated rows get a result each and count once in the fit. Null ids are kept. Components whose
eigenvalue is zero up to rounding have no whitened value and are left out, so a single vector, or an empty
table, gives no rows. Other columns are not read. Entries beyond 2**54, and deviations beyond a BIGINT,
stop the query: they cannot be given exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank.llm.tables import saved
from rillrank.llm.tasks import map_batches, slices

SCALE = 256
ROWS = 1024
LARGEST = 1 << 62
#: Eigenvalues below this share of their sum are rounding.
ZERO = 1e-12
#: Totals travel in two parts, so that a DECIMAL sum over all tasks never runs out of digits.
_PART = 40
_LIMB = 22

X = "_x"


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums `sums`; row k of `axes` is the eigenvector of `values[k]`, the largest first."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float = 0.0


def quantised(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """`keys` and the integer vector `_x` of each row that has one."""
    chosen = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
                       F.col(f"`{column}`").cast("array<double>").alias("v"))
    fields = [T.StructField(f"k{i}", chosen.schema[f"k{i}"].dataType) for i in range(len(keys))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROWS):
            vectors = part.column("v")
            lengths = np.asarray(vectors.value_lengths().fill_null(0))
            # Entries of null rows are not among those of `flatten`.
            entries = vectors.flatten()
            values = np.asarray(entries.cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
            good = lengths > 0
            bad = ~np.isfinite(values)
            rows = np.repeat(np.arange(len(lengths)), lengths)
            good[rows[bad]] = False
            kept = values[good[rows]]
            if len(kept) and np.abs(kept).max() >= 2.0 ** 54:
                raise ValueError("an entry is beyond 2**54")
            x = np.floor(SCALE * kept).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths[good])]).astype(np.int32)
            chosen = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(f"k{i}").filter(chosen) for i in range(len(keys))],
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))],
                [*[f"k{i}" for i in range(len(keys))], X])

    return map_batches(chosen, run, T.StructType([*fields, T.StructField(X, T.ArrayType(T.LongType()))]), ROWS)


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as rows; all have the same length."""
    vectors = part.column(X)
    return np.asarray(vectors.flatten(), dtype=np.int64).reshape(len(vectors), -1)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n*x - S, as integers of any size where 64 bits could run over."""
    most = max(n * max(int(np.abs(x).max(initial=0)), 1), *(abs(s) for s in sums), 1)
    if 4 * most < LARGEST:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def square_sums(p: np.ndarray) -> list[int]:
    """The exact sum of squares of each column, over at most 2**18 rows."""
    if p.dtype == object:
        return [int(s) for s in (p * p).sum(axis=0)] if len(p) else [0] * p.shape[1]
    rest, limbs = np.abs(p), []
    while rest.any():
        limbs.append(rest & ((1 << _LIMB) - 1))
        rest = rest >> _LIMB
    total = [0] * p.shape[1]
    for i, a in enumerate(limbs):
        for j in range(i, len(limbs)):
            shift = _LIMB * (i + j) + (i != j)
            for k, s in enumerate(np.einsum("ij,ij->j", a, limbs[j]).tolist()):
                total[k] += s << shift
    return total


def _totals(points: DataFrame, add) -> dict[tuple[int, int], int]:
    """Sums over all tasks of the integers by (i, j) that `add(vectors)` gives for a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}
        for part in slices(batches, ROWS):
            if len(part):
                for at, value in add(_matrix(part)):
                    held[at] = held.get(at, 0) + value
        if held:
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in held], pa.int32()), pa.array([j for _, j in held], pa.int32()),
                pa.array([Decimal(v >> _PART) for v in held.values()], pa.decimal128(38, 0)),
                pa.array([v & ((1 << _PART) - 1) for v in held.values()], pa.int64()),
            ], ["i", "j", "high", "low"])

    parts = map_batches(points, run, "i INT, j INT, high DECIMAL(38,0), low BIGINT", ROWS)
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"),
                                       F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    return {(r["i"], r["j"]): (int(r["high"]) << _PART) + int(r["low"]) for r in rows}


def _column_sums(x: np.ndarray) -> Iterator[tuple[tuple[int, int], int]]:
    yield (-1, -1), len(x)
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    for i in range(x.shape[1]):
        yield (i, i), (int(high[i]) << 32) + int(low[i])


def _pair_squares(n: int, sums: tuple[int, ...]):
    def add(x: np.ndarray) -> Iterator[tuple[tuple[int, int], int]]:
        u = centred(x, n, sums)
        for i in range(u.shape[1]):
            # The dimension itself, then its sum with each later one.
            both = u[:, i:] + u[:, i:i + 1]
            both[:, 0] = u[:, i]
            for j, s in enumerate(square_sums(both), i):
                yield (i, j), s
    return add


def covariance(squares: dict[tuple[int, int], int], d: int, n: int) -> np.ndarray:
    """The matrix from the sums of squares by dimension (i, i) and by pair sum (i, j), divisor n."""
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = squares[i, i] / n ** 3
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (squares[i, j] - squares[i, i] - squares[j, j]) / (2 * n ** 3)
    return out


def fit(df: DataFrame, column: str, components: int = 4) -> Whitening | None:
    """None if there is nothing to fit. Distinct vectors are combined on the map side, so a vector that a third
    of all rows repeat is shuffled once per task."""
    points = saved(quantised(df, column, []).distinct(), "points")
    common = points.groupBy(F.size(X).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    d = common["d"]
    points = points.where(F.size(X) == d)
    totals = _totals(points, _column_sums)
    n, sums = totals[-1, -1], tuple(totals[i, i] for i in range(d))
    v = covariance(_totals(points, _pair_squares(n, sums)), d, n)
    values, axes = np.linalg.eigh(v)
    trace = float(np.trace(v))
    kept = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > ZERO * trace]
    if not kept:
        return None
    axes = axes[:, kept].T
    # One of the two signs: the entry furthest from zero is positive.
    axes = axes * np.sign(axes[np.arange(len(kept)), np.abs(axes).argmax(axis=1)])[:, None]
    model = Whitening(n, sums, values[kept], axes, trace)
    return Whitening(n, sums, values[kept], axes, trace, _identity_error(points, model))


def _project(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n*x - S, and (x - S/n) on each axis over the root of its eigenvalue."""
    u = centred(x, model.n, model.sums)
    return u, (u / model.n).astype(np.float64) @ model.axes.T / np.sqrt(model.values)


def _identity_error(points: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, in a centred one-pass aggregate."""
    names = [f"w{k}" for k in range(len(model.values))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROWS):
            if len(part):
                white = _project(_matrix(part), model)[1]
                yield pa.RecordBatch.from_arrays([pa.array(white[:, k]) for k in range(len(names))], names)

    white = map_batches(points, run, ", ".join(f"{c} DOUBLE" for c in names), ROWS)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = white.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, model: Whitening | None, column: str, key: str) -> DataFrame:
    """Per row with a vector and per component (from 1): `key`, component, n, deviation (the sum over dimensions of
    (n*x - S)^2), whitened, explained (the component's share of the variance) and the model's identity_error."""
    rows = quantised(df, column, [key])
    kind = rows.schema["k0"].dataType
    out = T.StructType([
        T.StructField("k0", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    if model is None:
        return df.sparkSession.createDataFrame([], out).withColumnRenamed("k0", key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(model.values)
        for part in slices(batches, ROWS):
            if not len(part):
                continue
            u, white = _project(_matrix(part), model)
            deviation = square_sums(u.T)
            if max(deviation) >= 1 << 63:
                raise OverflowError("a deviation is beyond a BIGINT")
            rows = len(u) * count
            yield pa.RecordBatch.from_arrays([
                part.column("k0").take(pa.array(np.repeat(np.arange(len(u)), count))),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(u))),
                pa.array(np.full(rows, model.n, np.int64)),
                pa.array(np.repeat(np.array(deviation, dtype=np.int64), count)),
                pa.array(white.reshape(-1)),
                pa.array(np.tile(model.values / model.trace, len(u))),
                pa.array(np.full(rows, model.identity_error)),
            ], out.names)

    same = rows.where(F.size(X) == len(model.sums))
    return map_batches(same, run, out, ROWS).withColumnRenamed("k0", key)
