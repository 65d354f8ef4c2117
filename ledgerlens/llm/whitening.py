"""Embedding whitening with exact covariances from variances alone (polarisation).

For integer vectors x of a list of n distinct vectors with sums S, y = n * x - S is centred and exact. One pass adds up y_i^2 for every
dimension and (y_i + y_j)^2 for every pair, as whole numbers; since (a + b)^2 = a^2 + b^2 + 2ab, half of the pair's sum less the two
single ones is the sum of products, and so every covariance is the nearest double to an exact fraction. Only these sums (one per pair
of dimensions, whatever the number of rows) reach the driver, where the matrix is decomposed.

Defined results: rows whose vector is null or holds a null, NaN, infinite or (64 c beyond 2^62) unrepresentable entry are dropped; of
vectors of several lengths the most frequent length counts (of equally frequent ones the longer) unless `dims` names one; the others and empty ones
are dropped. Equal vectors count once in the fit and get their own rows in the result; ids can be null or repeated. A component without
variance (fewer distinct vectors than dimensions, constant dimensions) has null in `whitened` and does not enter identity_error.
`deviation` is null where a long cannot hold it. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, exact_totals, matrix, usable_vector

SCALE, SHIFT = 64, 1_000_000
_HALF = 24
_LONG = 2**63 - 1
_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in longs where they hold the squares' parts (46 bits), else in Python's integers."""
    if len(x) and n * int(np.abs(x).max()) < 2**62 and max(map(abs, sums)) < 2**62:
        y = n * x - np.array(sums, np.int64)
        if np.abs(y).max() < 2**46:
            return y
    return n * x.astype(object) - np.array(sums, object)


def _squares(q: np.ndarray) -> list[int]:
    """Sum of the squares of each row of q."""
    if q.dtype == object:
        return [sum(v * v for v in row) for row in q]
    total = [0] * len(q)
    for at in range(0, q.shape[1], 1 << 14):  # 2^14 squares of 48 bits fit
        high, low = q[:, at:at + (1 << 14)] >> _HALF, q[:, at:at + (1 << 14)] & ((1 << _HALF) - 1)
        parts = [np.einsum("ij,ij->i", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
        total = [t + (a << 2 * _HALF) + (b << _HALF + 1) + c for t, a, b, c in zip(total, *parts)]
    return total


def _eigen(squares: dict[int, int], n: int, dims: int, keep: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues, their vectors as columns, and the trace of the covariance."""
    v = np.zeros((dims, dims))
    for i in range(dims):
        v[i, i] = squares[i * dims + i] / n**3
        for j in range(i):
            v[i, j] = v[j, i] = (squares[j * dims + i] - squares[i * dims + i] - squares[j * dims + j]) / (2 * n**3)
    values, vectors = np.linalg.eigh(v)
    trace = sum(squares[i * dims + i] for i in range(dims)) / n**3
    return values[::-1][:keep], vectors[:, ::-1][:, :keep], trace


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, dims: int | None = None) -> DataFrame:
    """id_col, component, n, deviation, whitened, explained, identity_error: one row per usable row and component."""
    spark = df.sparkSession
    vector = F.col(vector_col)
    usable = df.select(F.col(id_col).alias("id"), vector.alias("v")).where((F.size("v") > 0) & usable_vector(F.col("v"), SCALE))
    if dims is None:
        first = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        dims = first["d"] if first else 0
    kind = df.select(id_col).schema[0].dataType.simpleString()
    whole = F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = usable.where(F.size("v") == dims).select("id", whole.alias("x"))
    scratch = Scratch(spark)
    fit = scratch.save(rows.select("x").distinct(), "fit")

    def add_up(batches: Iterator[pa.RecordBatch]) -> dict[int, int]:
        out: dict[int, int] = defaultdict(int)
        for batch in batches:
            x = matrix(batch.column(0), dims)
            out[-1] += len(x)
            wide = x.astype(object) if len(x) and len(x) * int(np.abs(x).max()) >= 2**62 else x
            for i, s in enumerate(wide.sum(axis=0).tolist() if len(x) else ()):
                out[i] += s
        return out

    totals = exact_totals(fit, add_up)
    n, sums = totals[-1], [totals[i] for i in range(dims)]
    if not n or not dims:
        scratch.drop_all_but(0)
        return spark.createDataFrame([], f"`{id_col}` {kind}, {_RESULT}")

    def square(batches: Iterator[pa.RecordBatch]) -> dict[int, int]:
        out: dict[int, int] = defaultdict(int)
        for batch in batches:
            y = np.ascontiguousarray(_centred(matrix(batch.column(0), dims), n, sums).T)
            for i, s in enumerate(_squares(y)):
                out[i * dims + i] += s
            for i in range(dims - 1):
                for j, s in enumerate(_squares(y[i + 1:] + y[i]), i + 1):
                    out[i * dims + j] += s
        return out

    values, vectors, trace = _eigen(exact_totals(fit, square), n, dims, components)
    live = values > trace * dims * np.finfo(float).eps
    turn = vectors[:, live] / np.sqrt(values[live])
    k = int(live.sum())

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = _centred(x, n, sums)
        return y, (y / n).astype(float) @ turn

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            x = matrix(batch.column(0), dims)
            w = np.column_stack([project(x)[1], np.ones(len(x))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "value"])

    found = fit.mapInArrow(moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    moment = np.zeros((k + 1) ** 2)
    for r in found:
        moment[r.place] = r.value / n
    moment = moment.reshape(k + 1, k + 1)
    error = float(np.abs(moment[:k, :k] - np.outer(moment[k, :k], moment[k, :k]) - np.eye(k)).max(initial=0))
    scratch.drop_all_but(0)
    share = [float(e) / trace if trace else None for e in values]

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = len(values)
        for batch in batches:
            y, w = project(matrix(batch.column(1), dims))
            full = np.full((len(y), kept), np.nan)
            full[:, np.flatnonzero(live)] = w
            # Squares of up to 46 bits: as many longs as dimensions fit if they are small, else Python adds them up.
            if y.dtype != object and len(y) and int(np.abs(y).max()) ** 2 * dims <= _LONG:
                deviation = np.einsum("ij,ij->i", y, y).tolist()
            else:
                deviation = [s if s <= _LONG else None for s in (sum(v * v for v in row) for row in y.tolist())]
            b = len(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(b), kept))), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), b)),
                 pa.array(np.full(b * kept, n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(b), kept))),
                 pa.array(full.ravel(), mask=np.isnan(full.ravel())), pa.array(share * b, pa.float64()), pa.array(np.full(b * kept, error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(result, f"`{id_col}` {kind}, {_RESULT}")
