"""k-means with ns-bounds (Newling and Fleuret, 2016): exact rounds in which most vectors are not compared with all centroids.

Every vector keeps its distance to its centroid and to the second nearest one, with the round in which each was taken. Centroids of
all rounds are kept (rounds x clusters, whatever the number of vectors). In a later round the first distance can have grown, and
the second shrunk, by no more than the norm of the centroids' *total* displacement since that round, which is never more than the sum of
their moves from round to round. Where the loosened bounds still part, the vector stays; else the own distance is taken anew; and only if that
fails too is the vector compared with all centroids. Distances, sums and means are whole numbers; only bounds are doubles, loosened by more than they round.

A round writes the state once to the shared folder (the vectors' small integers take a byte or so each) and adds up only the vectors that
changed their cluster; the state before it is deleted.

Defined results: rows whose vector does not have exactly `dims` components, or holds a null, NaN, infinite or (scaled, beyond 2^62)
unrepresentable one, are dropped. Rows with equal ids and vectors are separate points. Starting vectors with equal hashes (repeated ids;
null ids count as empty text) are taken in the order of their components. Ties go to the smaller number; with fewer
vectors than `k` there are fewer centroids. Distances and sums beyond a long are null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, exact_totals, matrix, usable_vector

_SLACK = 1e-9
_LONG = 2**63 - 1
_STATE = "x array<long>, cluster int, was int, near double, near_at int, next double, next_at int"


def _fits(*parts: np.ndarray) -> bool:
    """Whether squared distances between such vectors, and all sums on the way, are exact in doubles."""
    most = max((int(np.abs(p).max()) for p in parts if p.size), default=0)
    return parts[0].shape[1] * 4 * most**2 < 2**53


def to_all(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids."""
    if _fits(x, centroids):
        a, c = x.astype(float), centroids.astype(float)
        return (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)
    return np.array([[sum((int(p) - int(q)) ** 2 for p, q in zip(row, c)) for c in centroids] for row in x], object).reshape(len(x), len(centroids))


def to_own(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to the centroid in the same row of own."""
    if _fits(x, own):
        return ((x.astype(float) - own.astype(float)) ** 2).sum(1)
    return np.array([sum((int(p) - int(q)) ** 2 for p, q in zip(a, b)) for a, b in zip(x, own)], object)


class Bounds:
    """Centroids of all rounds so far and how far each has come since an earlier one."""

    def __init__(self, history: list[np.ndarray]):
        self.history, self.now = history, history[-1]
        moved = [np.sqrt(to_own(self.now, c).astype(float)) * (1 + _SLACK) for c in history]
        self.moved = np.array(moved).reshape(len(history), -1)
        order = np.argsort(self.moved, axis=1)
        self.most_by = order[:, -1]
        at = np.arange(len(history))
        self.most, self.second = self.moved[at, order[:, -1]], self.moved[at, order[:, -2]] if len(self.now) > 1 else np.zeros(len(history))

    def others(self, since: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The longest way of any centroid but the own one."""
        return np.where(self.most_by[since] == own, self.second[since], self.most[since])

    def assign(self, x: np.ndarray, state: tuple[np.ndarray, ...] | None) -> tuple[np.ndarray, ...]:
        """cluster, near, near_at, next, next_at of each vector in the latest round."""
        t = len(self.history) - 1
        if state is None:
            state = tuple(np.zeros(len(x), kind) for kind in (np.int32, float, np.int32, float, np.int32))
            rescan = np.arange(len(x))
        else:
            state = tuple(np.array(s) for s in state)
            cluster, near, near_at, next_, next_at = state
            lower = next_ * (1 - _SLACK) - self.others(next_at, cluster)
            upper = near * (1 + _SLACK) + self.moved[near_at, cluster]
            unsure = np.flatnonzero(~(upper < lower))
            near[unsure] = np.sqrt(to_own(x[unsure], self.now[cluster[unsure]]).astype(float))
            near_at[unsure] = t
            rescan = unsure[~(near[unsure] * (1 + _SLACK) < lower[unsure])]
        if len(rescan):
            cluster, near, near_at, next_, next_at = state
            far = to_all(x[rescan], self.now)
            cluster[rescan] = np.array([int(row.argmin()) for row in far])
            least = np.sort(far, axis=1)[:, :2].astype(float)
            near[rescan] = np.sqrt(least[:, 0])
            next_[rescan] = np.sqrt(least[:, 1]) if far.shape[1] > 1 else np.inf
            near_at[rescan] = next_at[rescan] = t
        return state


def _sums(x: np.ndarray, label: np.ndarray, sign: int, dims: int, out: dict[int, int]) -> None:
    for c in np.unique(label).tolist():
        part = x[label == c]
        part = part.astype(object) if part.size and len(part) * int(np.abs(part).max()) >= 2**62 else part
        for i, s in enumerate(part.sum(axis=0).tolist()):
            out[c * (dims + 1) + i] += sign * s
        out[c * (dims + 1) + dims] += sign * len(part)


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5,
            scale: int = 256, seed: str = "2") -> DataFrame:
    """id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector after `rounds` rounds and a last assignment."""
    spark = df.sparkSession
    kind = df.select(id_col).schema[0].dataType.simpleString()
    whole = F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    points = (df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where((F.size("v") == dims) & usable_vector(F.col("v"), scale))
              .select("id", whole.alias("x")))
    scratch = Scratch(spark)
    start = (points.select("x", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256).alias("h"))
             .orderBy("h", "x").limit(k).collect())
    names = [id_col, "cluster", "distance"]
    schema = f"`{id_col}` {kind}, cluster int, distance long"
    if not start:
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    history = [np.array([r.x for r in start], np.int64)]
    k = len(start)
    totals: dict[int, int] = defaultdict(int)
    state = points

    def assigned(batch: pa.RecordBatch, bounds: Bounds) -> tuple[np.ndarray, tuple[np.ndarray, ...], np.ndarray | None]:
        x = matrix(batch.column(1), dims)
        if batch.num_columns == 2:
            return x, bounds.assign(x, None), None
        cluster, near, near_at, next_, next_at = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4, 5, 6, 7))
        return x, bounds.assign(x, (cluster, near, near_at, next_, next_at)), cluster

    for _ in range(rounds):
        def step(batches: Iterator[pa.RecordBatch], history=tuple(history)) -> Iterator[pa.RecordBatch]:
            bounds = Bounds(list(history))
            for batch in batches:
                _, (now, near, near_at, next_, next_at), was = assigned(batch, bounds)
                was = pa.nulls(len(now), pa.int32()) if was is None else pa.array(was, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(now, pa.int32()), was, pa.array(near), pa.array(near_at, pa.int32()),
                     pa.array(next_), pa.array(next_at, pa.int32())], ["id", "x", "cluster", "was", "near", "near_at", "next", "next_at"])

        state = scratch.save(state.mapInArrow(step, f"id {kind}, {_STATE}"), "state")
        scratch.drop_all_but(1)

        def changes(batches: Iterator[pa.RecordBatch]) -> dict[int, int]:
            out: dict[int, int] = defaultdict(int)
            for batch in batches:
                x, now = matrix(batch.column(0), dims), batch.column(1).to_numpy(zero_copy_only=False)
                _sums(x, now, 1, dims, out)
                if not batch.column(2).null_count:  # all or none: the first round has no earlier clusters
                    _sums(x, batch.column(2).to_numpy(zero_copy_only=False), -1, dims, out)
            return out

        moved = state.where(~F.col("cluster").eqNullSafe(F.col("was"))).select("x", "cluster", "was")
        for place, change in exact_totals(moved, changes).items():
            totals[place] += change
        centroids = history[-1].copy()
        for c in range(k):
            if count := totals[c * (dims + 1) + dims]:
                centroids[c] = [totals[c * (dims + 1) + i] // count for i in range(dims)]
        history.append(centroids)

    def last(batches: Iterator[pa.RecordBatch], history=tuple(history)) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(list(history))
        for batch in batches:
            x, (now, *_), _ = assigned(batch, bounds)
            distance = [int(d) if d <= _LONG else None for d in to_own(x, bounds.now[now]).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(now, pa.int32()), pa.array(distance, pa.int64())], names)

    found = Scratch(spark).save(state.mapInArrow(last, schema), "clusters")
    scratch.drop_all_but(0)
    # One row per cluster; a sum with an unrepresentable distance in it is unrepresentable too.
    whole_sum = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")
    inertia = {r.cluster: r.s if r.s is None else int(r.s) for r in found.groupBy("cluster").agg(whole_sum).collect()}
    fits = lambda s: s if s is not None and s <= _LONG else None
    total = None if None in inertia.values() else fits(sum(inertia.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    per_cluster = spark.createDataFrame([(c, fits(s), total, digest[c]) for c, s in inertia.items()],
                                        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per_cluster), "cluster").select(*names, "cluster_inertia", "inertia", "centroid_sha256")
