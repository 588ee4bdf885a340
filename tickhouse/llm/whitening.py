"""Embedding whitening from one distributed covariance.

1. Rows without a vector or with a null or non-finite entry go.  Every other
   entry c becomes the whole number ``floor(64 * c) + 1000000``.
2. The *fit list*, each distinct vector once, is written to the shared folder.
   Its size n and the sums S per dimension are exact: tasks add whole numbers,
   Spark adds the tasks' sums as decimals.
3. Covariance, divisor n: each task centres its vectors (the whole part of the
   mean comes off in whole numbers, the rest in doubles), multiplies, and
   returns one d x d matrix however many vectors it read; Spark adds them.
4. The driver holds that d x d matrix only: Householder reflections make it
   tridiagonal, bisection on Sturm counts finds the leading eigenvalues,
   inverse iteration the vectors, orthogonalised again within clusters of
   close eigenvalues, and the reflections are undone.
5. The components (d x 16 at most) travel with the tasks, which project every
   row.  The covariance of the whitened fit list is measured the same way as
   in step 3 and compared with the identity.

What the driver and a task hold grows with the vectors' length, never with
their number.

Cases: entries beyond ``LARGEST`` would leave the 64-bit range and count as
non-finite; all vectors have one length, the most frequent (of equally
frequent ones the longest), rows of another length are dropped as not
comparable; repeated rows each keep their result and count once in the fit;
a null key stays null; eigenvalues that are zero to rounding have no
component, so equal vectors, a single one or an empty table give no rows;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.common import DOUBLE, LONG, fields, stored

COMPONENTS = 16
SCALE, SHIFT = 64.0, 1_000_000
#: 64 * c + SHIFT stays a 64-bit whole number below this.
LARGEST = float(1 << 40)
ROWS = 4096


class Whitening(NamedTuple):
    """What the fit list gives: moments, eigenpairs, and the measured error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


# --- eigenpairs of a small symmetric matrix ---------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit normals of the Householder reflections."""
    a = np.array(matrix, float)
    d = len(a)
    normals = []
    for k in range(d - 2):
        x = a[k + 1 :, k]
        normal = np.zeros(d)
        size = np.abs(x[1:]).max(initial=0.0)
        if size > 0:
            v = x / max(size, abs(x[0]))
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            normal[k + 1 :] = v / np.linalg.norm(v)
            p = a @ normal
            w = p - normal * (normal @ p)
            a -= 2 * (np.outer(normal, w) + np.outer(w, normal))
        normals.append(normal)
    return np.diag(a).copy(), np.diag(a, 1).copy(), normals


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of the values ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    square = off * off
    below = np.zeros(len(at), int)
    q = np.full(len(at), 1.0)
    for i, a in enumerate(diagonal):
        q = a - at - (square[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection down to the last bit."""
    d = len(diagonal)
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    slack = 2 * np.finfo(float).eps * d * max(abs(low), abs(high))
    rank = d - 1 - np.arange(min(count, d))  # number of eigenvalues below the wanted one
    left = np.full(len(rank), low - slack)
    right = np.full(len(rank), high + slack)
    while True:
        middle = left + (right - left) / 2
        if ((middle <= left) | (middle >= right)).all():
            return middle
        less = sturm_counts(diagonal, off, middle) <= rank
        left, right = np.where(less, middle, left), np.where(less, right, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """Solves (T - shift) x = b by elimination with row exchanges."""
    d = len(diagonal)
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), 1e-300)
    main, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    x = b.copy()
    for i in range(d - 1):
        below = off[i]
        if abs(main[i]) >= abs(below):
            if main[i] == 0:
                main[i] = tiny
            factor = below / main[i]
            main[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
        else:
            factor = main[i] / below
            main[i], up[i], main[i + 1], up2[i], up[i + 1] = (
                below,
                main[i + 1],
                up[i] - factor * main[i + 1],
                up[i + 1],
                -factor * up[i + 1],
            )
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
    if abs(main[-1]) < tiny:
        main[-1] = tiny
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < d:
            x[i] -= up2[i] * x[i + 2]
        x[i] /= main[i] if abs(main[i]) > tiny else tiny
    return x


def eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as columns."""
    d = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0))
    if d < 2 or not scale:
        return np.diag(matrix)[:count].copy(), np.eye(d)[:, :count]
    diagonal, off, normals = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, count)
    norm = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)
    near = 1e-3 * norm  # closer eigenvalues belong to one cluster
    random = np.random.default_rng(7)
    vectors = np.zeros((d, len(values)))
    cluster = 0
    shift = np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > near:
            cluster = j
        # equal eigenvalues are told apart by a few last bits
        shift = min(value, shift - 4 * np.finfo(float).eps * norm)
        x = random.standard_normal(d)
        for _ in range(4):
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x))
            for _ in range(2):
                x -= vectors[:, cluster:j] @ (vectors[:, cluster:j].T @ x)
            if not np.linalg.norm(x):
                x = random.standard_normal(d)
        vectors[:, j] = x / np.linalg.norm(x)
    for normal in reversed(normals):
        vectors -= 2 * np.outer(normal, normal @ vectors)
    return values * scale, vectors


# --- distributed moments -----------------------------------------------------


def grid(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(key, x): the whole-number vectors of the rows that stay."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda c: F.coalesce(F.abs(c) <= F.lit(LARGEST), F.lit(False)))
    whole = F.transform(v, lambda c: F.floor(c * F.lit(SCALE)) + F.lit(SHIFT))
    kept = vectors.where(F.coalesce(sound, F.lit(False))).select(
        F.col(key).alias("key"), whole.alias("x")
    )
    length = (
        kept.groupBy(F.size("x").alias("d"))
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), F.desc("d"))
        .first()
    )
    return kept.where(F.size("x") == (length["d"] if length else 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class _Centre(NamedTuple):
    """The mean as a whole part and a rest, so that centring loses no digits."""

    whole: np.ndarray
    rest: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest


def _centre(n: int, sums: list[int]) -> _Centre:
    whole = [s // n for s in sums]
    rest = [float(Decimal(s - n * w) / n) for s, w in zip(sums, whole, strict=True)]
    return _Centre(np.array(whole, np.int64), np.array(rest))


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(0))
                # halves, so that no sum of a batch leaves 64 bits
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(x.shape[1])),
                        pa.array(np.full(x.shape[1], len(x))),
                        pa.array(high),
                        pa.array(low),
                    ],
                    names=["dim", "rows", "high", "low"],
                )

    parts = fit.mapInArrow(run, fields(dim=LONG, rows=LONG, high=LONG, low=LONG))
    whole = "decimal(38,0)"
    rows = (
        parts.groupBy("dim")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.col("high").cast(whole)).alias("high"),
            F.sum(F.col("low").cast(whole)).alias("low"),
        )
        .orderBy("dim")
        .collect()
    )
    if not rows:
        return 0, []
    return rows[0]["rows"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _second_moments(fit: DataFrame, centre: _Centre, project: np.ndarray | None = None) -> np.ndarray:
    """Sum of products of the centred (and projected) vectors: one matrix per task, added by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                y = centre(_matrix(batch.column(0).slice(at, ROWS)))
                y = y if project is None else y @ project
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i * len(total) + j), pa.array(total[i, j])], names=["cell", "part"]
            )

    parts = fit.mapInArrow(run, fields(cell=LONG, part=DOUBLE))
    rows = parts.groupBy("cell").agg(F.sum("part").alias("part")).collect()
    d = len(centre.whole) if project is None else project.shape[1]
    out = np.zeros((d, d))
    for r in rows:
        i, j = divmod(r["cell"], d)
        out[i, j] = out[j, i] = r["part"]
    return out


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors ``fit_list`` (column ``x``)."""
    n, sums = _sums(fit_list)
    if not n or not sums:
        return Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, 0.0)
    centre = _centre(n, sums)
    covariance = _second_moments(fit_list, centre) / n
    trace = float(np.trace(covariance))
    values, vectors = eigenpairs(covariance, components)
    real = values > len(sums) * np.finfo(float).eps * max(trace, 0.0)
    values, vectors = values[real], vectors[:, real]
    error = 0.0
    if len(values):
        # the mean of the centred vectors is zero to rounding: measured, not assumed
        white = _second_moments(fit_list, centre, vectors / np.sqrt(values)) / n
        error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, trace, error)


def project(rows: DataFrame, model: Whitening, key: str = "vec_id") -> DataFrame:
    """One row per row of (key, x) and component."""
    schema = T.StructType(
        [
            T.StructField(key, rows.schema["key"].dataType),
            *fields(
                component=T.IntegerType(),
                n=LONG,
                deviation=LONG,
                whitened=DOUBLE,
                explained=DOUBLE,
                identity_error=DOUBLE,
            ).fields,
        ]
    )
    count = len(model.values)
    if not count:
        return rows.sparkSession.createDataFrame([], schema)
    centre = _centre(model.n, model.sums)
    weights = model.vectors / np.sqrt(model.values)
    whole = np.array([int(w) for w in centre.whole], dtype=object)
    # n * x - S = n * (x - whole) - (S - n * whole)
    left = [s - model.n * int(w) for s, w in zip(model.sums, whole, strict=True)]
    n, error = model.n, model.identity_error
    explained = model.values / model.trace

    def deviations(x: np.ndarray) -> list[int | None]:
        y = x - centre.whole
        widest = (n * float(np.abs(y).max(initial=0)) + n) ** 2 * max(1, y.shape[1])
        if widest < float(1 << 62):
            off = n * y - np.array(left, np.int64)
            return (off * off).sum(axis=1).tolist()
        off = n * y.astype(object) - np.array(left, dtype=object)
        return [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column(1))
                white = centre(x) @ weights
                m = len(x)
                again = pa.array(np.repeat(np.arange(m), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(again),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * count, n)),
                        pa.array(deviations(x), pa.int64()).take(again),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * count, error)),
                    ],
                    names=schema.names,
                )

    return rows.select("key", "x").mapInArrow(run, schema)


def whitened(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Per row and component: key, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is null where the exact sum leaves 64 bits.
    """
    rows = grid(vectors, key, vector)
    fit_list = stored(rows.select("x").distinct(), "fit-list")
    return project(rows, fit(fit_list, components), key)
