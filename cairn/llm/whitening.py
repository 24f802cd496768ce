"""Whitening of embeddings by a distributed singular value decomposition.

Every block of centred rows is compressed to the triangle R of its QR decomposition, and
triangles are stacked and compressed again, so the covariance, which would square the
condition number, is never formed. A one-sided Jacobi method turns R's columns by plane
rotations until they are orthogonal: their lengths are the singular values, the
rotations multiplied together the components.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

#: States that one task or the driver merges, and rows that are worked on at once.
FAN, BLOCK = 32, 4096
#: Entries of this size or more can't be summed exactly in 64 bits and count as not finite.
LARGEST = float(1 << 40)


def quantized(vector: Column) -> Column:
    """floor(64 * c) + 1000000 for each entry c; null for a null vector and one with null, non-finite or huge entries."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.when(vector.isNotNull() & fine, F.transform(entries, lambda c: F.floor(c * 64) + 1_000_000))


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """The vectors of the first column, rows of int64, BLOCK at most at once."""
    for batch in batches:
        rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for i in range(0, len(rows), BLOCK):
            yield rows[i : i + BLOCK]


def folded(x: DataFrame, dims: int, step: Callable, merge: Callable):
    """The state that `step(state or None, block)` and `merge(state, state)` make of all rows; None of no rows.

    Each task folds its blocks to one state of fixed size. While there are more than FAN states, tasks
    merge FAN of them at a time; the driver merges the last ones.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for block in _blocks(batches, dims):
            state = step(state, block)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "state": [pickle.dumps(state)]})

    def united(states: list[bytes]):
        out = pickle.loads(states[0])
        for s in states[1:]:
            out = merge(out, pickle.loads(s))
        return out

    def level(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = [s for b in batches for s in b.column("state").to_pylist()]  # FAN at most
        yield pa.RecordBatch.from_pydict({"part": [key[0].as_py()], "state": [pickle.dumps(united(states))]})

    schema = "part long, state binary"
    states = materialize(x.mapInArrow(local, schema))
    while states.count() > FAN:
        dense = states.select(F.floor(F.col("part") / FAN).cast("long").alias("part"), "state")
        states = materialize(dense.groupBy("part").applyInArrow(level, schema))
    got = [bytes(r["state"]) for r in states.select("state").collect()]
    return united(got) if got else None


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _sums(state, block: np.ndarray):
    """Rows and sums, the sums in integers of any size."""
    own = block.sum(axis=0).astype(object)
    return (len(block) + state[0], own + state[1]) if state else (len(block), own)


def jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors (columns) of `a`, by one-sided Jacobi rotations.

    A round of a tournament turns disjoint pairs of columns at once; sweeps go on until no pair is
    further from orthogonal than rounding.
    """
    d = a.shape[1]
    a, v = a.astype(np.float64), np.eye(d)
    if d > 1:
        seats = np.arange(d + d % 2)  # one seat stays free if d is odd
        eps = np.finfo(np.float64).eps * max(1.0, np.sqrt(len(a)))
        noise = (1e-3 * np.finfo(np.float64).eps) ** 2 * (a * a).sum()  # of a column that rounding left of nothing
        for _ in range(sweeps):
            turned = False
            for _ in range(len(seats) - 1):
                p, q = seats[: len(seats) // 2], seats[: len(seats) // 2 - 1 : -1]
                p, q = p[both := (p < d) & (q < d)], q[both]
                x, y = a[:, p], a[:, q]
                xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
                off = (np.abs(xy) > eps * np.sqrt(xx * yy)) & (np.minimum(xx, yy) > noise)
                if off.any():
                    turned = True
                    zeta = (yy[off] - xx[off]) / (2 * xy[off])
                    t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                    c = 1 / np.hypot(1.0, t)
                    s = c * t
                    p, q = p[off], q[off]
                    for m in (a, v):
                        m[:, p], m[:, q] = c * m[:, p] - s * m[:, q], s * m[:, p] + c * m[:, q]
                seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
            if not turned:
                break
    sizes = np.sqrt((a * a).sum(axis=0))
    order = np.argsort(-sizes, kind="stable")
    return sizes[order], v[:, order]


def _centred(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, by the integer n*x - S, rounded once."""
    return _scaled(block, n, sums).astype(np.float64) / n


def _scaled(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, exact: in 64 bits where they suffice, else in integers of any size."""
    if max(n * int(np.abs(block).max(initial=0)), max(map(abs, sums))) < 2**62:
        return block * n - sums.astype(np.int64)
    return block.astype(object) * n - sums


def _deviations(block: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The sum of squares of n*x - S over the dimensions, exact."""
    scaled = _scaled(block, n, sums)
    if scaled.dtype != object and float(np.abs(scaled).max(initial=0)) ** 2 * max(1, block.shape[1]) >= 2**62:
        scaled = scaled.astype(object)
    return [int(s) for s in (scaled * scaled).sum(axis=1)]


def _moments(state, rows: np.ndarray):
    """(rows, mean, products of deviations) of a block, united with `state`."""
    mean = rows.mean(axis=0)
    centred = rows - mean
    own = (len(rows), mean, centred.T @ centred)
    return _united(state, own) if state else own


def _united(a, b):
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def whiten(df: DataFrame, vector: str, most: int = 16) -> DataFrame:
    """Add `n`, `deviation`, `whitened`, `explained` (arrays of a number a component) and `identity_error` to the rows whose vector holds finite numbers only.

    Vectors are quantized to integers; the fit list is each distinct one once, so copies, however
    many, have no weight. Sums are exact. The components are the first `most`, at most as many as
    dimensions. One whose deviation can't be told from rounding has null in `whitened`: it has no
    direction of its own. `deviation` is null beyond 64 bits. Rows with a null vector, or with null, non-finite or
    huge entries (2**40 and more) are left out, as are those of another length than the most
    frequent (of two as frequent the longer). Repeated rows stay. Without rows, or of vectors
    without entries, the result is empty. Columns with the added names are replaced.
    """
    added = ("n", "deviation", "whitened", "explained", "identity_error")
    df = df.drop(*added)
    name = free_name(df, "x")
    rows = df.withColumn(name, quantized(F.col(vector))).where(F.col(name).isNotNull())
    shown = rows.select(F.col(name).alias("x"))
    lengths = shown.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths["dims"] if lengths else 0
    schema = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if not dims:
        return df.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.sparkSession.createDataFrame([], schema).schema])
    fit = materialize(shown.where(F.size("x") == dims).distinct())

    n, sums = folded(fit, dims, _sums, lambda a, b: (a[0] + b[0], a[1] + b[1]))
    compress = lambda r, block: _triangle(_centred(block, n, sums) if r is None else np.vstack([r, _centred(block, n, sums)]))
    r = folded(fit, dims, compress, lambda a, b: _triangle(np.vstack([a, b])))
    sizes, components = jacobi(r)
    values = sizes**2 / n
    told = sizes > max(n, dims) * np.finfo(np.float64).eps * max(sizes[0], 1e-300)
    k = min(most, dims)
    scale = np.where(told[:k], np.sqrt(np.where(told[:k], values[:k], 1.0)), np.nan)
    turn = components[:, :k] / scale
    explained = (values[:k] / values.sum()).tolist() if values.sum() > 0 else [0.0] * k
    live = np.flatnonzero(told[:k])
    error = None
    if len(live):
        _, _, products = folded(fit, dims, lambda s, block: _moments(s, _centred(block, n, sums) @ turn[:, live]), _united)
        error = float(np.abs(products / n - np.eye(len(live))).max())

    @F.arrow_udf("deviation long, whitened array<double>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            deviation, out = [], []
            for block in _blocks(iter([pa.RecordBatch.from_arrays([batch], ["x"])]), dims):
                deviation += _deviations(block, n, sums)
                out.append(_centred(block, n, sums) @ turn)
            flat = np.concatenate(out).ravel() if out else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k), pa.int32()), pa.array(flat, pa.float64(), mask=np.isnan(flat)))
            yield pa.StructArray.from_arrays([pa.array([d if d < 2**63 else None for d in deviation], pa.int64()), lists], ["deviation", "whitened"])

    seen = free_name(rows, "seen")
    out = rows.where(F.size(name) == dims).withColumn(seen, project(F.col(name)))
    return out.withColumns({
        "n": F.lit(n).cast("long"), "deviation": F.col(f"{seen}.deviation"), "whitened": F.col(f"{seen}.whitened"),
        "explained": F.array(*map(F.lit, explained)), "identity_error": F.lit(error).cast("double"),
    }).drop(name, seen)
