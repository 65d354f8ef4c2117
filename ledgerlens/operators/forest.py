"""Isolation forest: the trees are grown and applied in Spark tasks.

Liu, Ting, Zhou: Isolation Forest, ICDM 2008. A tree isolates points by random
splits; points with short paths are anomalies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens import schemas as S
from ledgerlens.functions.scalars import as_col
from ledgerlens.session import materialize_scratch

NODE_SCHEMA = "tree int, node int, feature int, threshold double, path double, sample_size int"
# Draws that any engine can repeat: hexadecimal digits of an MD5.
HASH_DIGITS = 15
TREE_DIGITS = 7
PRIME = 2**31 - 1
OVERSAMPLE = 2


def fit_scaler(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Mean and population deviation per feature over rows without NULLs."""
    names = features or S.FEATURE_COLUMNS
    clean = df.dropna(subset=names)
    cells = [F.struct(F.lit(f).alias("feature"), F.avg(F.col(f).cast("double")).alias("mean"),
                      F.stddev_pop(F.col(f).cast("double")).alias("std"), F.count("*").alias("rows")) for f in names]
    return clean.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def average_path(n):
    """Mean path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    m = np.where(big, n, 3.0)
    return np.where(big, 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m, out)


def _digits(digits: int, *parts) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:digits], 16)


def _grow(points: np.ndarray, seed: int, tree: int, max_depth: int) -> list[tuple]:
    """Nodes as (node, feature, threshold, path): the root is 1, the children of i are 2i and 2i + 1, and a row goes to the second one if
    its feature is above the threshold. A leaf has no feature, but the expected path length of its rows."""
    nodes, todo = [], [(1, points)]
    while todo:
        node, part = todo.pop()
        depth = node.bit_length() - 1
        low, high = part.min(axis=0), part.max(axis=0)
        free = np.flatnonzero(high > low)
        if depth >= max_depth or len(free) == 0:
            nodes.append((node, None, None, depth + float(average_path(len(part)))))
            continue
        feature = int(free[_digits(8, seed, tree, node, "feature") % len(free)])
        at, to = float(low[feature]), float(high[feature])
        cut = at + _digits(13, seed, tree, node, "cut") / 2.0**52 * (to - at)
        cut = cut if cut < to else at  # rounding can reach the maximum, which has to go right
        nodes.append((node, feature, cut, None))
        right = part[:, feature] > cut
        todo += [(2 * node, part[~right]), (2 * node + 1, part[right])]
    return nodes


def _pool(rows: DataFrame, size: int, n: int, seed: int) -> DataFrame:
    """The `size` rows with the least hashes of their keys (repeated rows once), n being about the number of rows.

    Rows above a bound are left out at the scan; it is set so that about OVERSAMPLE * size rows pass and widened until enough do, so the
    rows that are sorted at the end are bounded by the forest's parameters.
    """
    hash_ = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "_key")), 1, HASH_DIGITS), 16, 10).cast("long")
    hashed = rows.withColumn("_hash", hash_)
    share = min(1.0, OVERSAMPLE * size / max(n, 1))
    while True:
        passed = hashed.where(F.col("_hash") < int(share * 16**HASH_DIGITS)).distinct()
        if share >= 1.0 or passed.count() >= size:
            return passed.orderBy("_hash", "_key").limit(size)
        share = min(1.0, share * 4)


def train_isolation_forest(df: DataFrame, features: list[str] | None = None, *, key: str = "transaction_id", trees: int = 200,
                           sample_size: int = 256, seed: int = 42) -> DataFrame:
    """Grow the trees; returns their nodes, at most trees * 2 * sample_size rows.

    The trees draw from a pool of trees * sample_size rows, those with the least hashes of all (all rows of a smaller table); each
    tree takes the sample_size rows of the pool that come first in an order of its own. All draws follow from key, tree, node and
    seed, so a re-run grows the same forest, and SQL can.
    """
    names = features or S.FEATURE_COLUMNS
    clean = df.dropna(subset=names)
    n = clean.count()
    if n == 0:
        raise ValueError("no complete rows to train on")
    cols = [f"_f{i}" for i in range(len(names))]
    rows = clean.select(F.col(key).cast("string").alias("_key"), *[F.col(f).cast("double").alias(c) for c, f in zip(cols, names)])
    pool = _pool(rows, trees * sample_size, n, seed)
    # A row of two factors per tree.
    factors = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(1 + _digits(TREE_DIGITS, seed, t, "factor")).cast("long").alias("a"),
                                 F.lit(_digits(TREE_DIGITS, seed, t, "shift")).cast("long").alias("b")) for t in range(trees)])
    dealt = pool.select("*", F.inline(factors)).withColumn("_order", (F.col("_hash") % PRIME * F.col("a") + F.col("b")) % PRIME)
    first = Window.partitionBy("tree").orderBy("_order", "_hash", "_key", *cols)
    drawn = dealt.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= sample_size).select("tree", *cols)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree, size = int(group["tree"].iloc[0]), len(group)
        nodes = _grow(group[cols].to_numpy(dtype=float), seed, tree, depth_of(size))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "path"]).astype({"feature": "Int32"})
        return out.assign(tree=tree, sample_size=size)[["tree", "node", "feature", "threshold", "path", "sample_size"]]

    return drawn.groupBy("tree").applyInPandas(build, NODE_SCHEMA)


def depth_of(size: int) -> int:
    return max(1, math.ceil(math.log2(max(size, 2))))


def _walkable(nodes: pd.DataFrame, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree as arrays by node number. Leaves above the last level send every row to their first child, down to the last level,
    so that all rows take the same number of steps."""
    feature, threshold, path = np.zeros(2 << levels, np.int64), np.full(2 << levels, np.inf), np.zeros(2 << levels)
    inner = nodes["feature"].notna().to_numpy()
    at = nodes["node"].to_numpy()
    feature[at[inner]], threshold[at[inner]] = nodes["feature"][inner].astype(np.int64), nodes["threshold"][inner]
    for node, length in zip(at[~inner].tolist(), nodes["path"][~inner]):
        path[node << (levels - node.bit_length() + 1)] = length
    return feature, threshold, path


def score_isolation_forest(df: DataFrame, model: DataFrame, features: list[str] | None = None, *, output: str = "ml_score",
                           raw: bool = False) -> DataFrame:
    """Add an anomaly score: 1 is the most anomalous row of the batch, 0 the least.

    NULL features count as 0. With `raw`, the score is 2^(-mean path / c), which does
    not depend on the rest of the batch. Only the feature columns go to Python.
    """
    names = features or S.FEATURE_COLUMNS
    spark = df.sparkSession
    # Bounded by the forest's parameters (trees * 2 * sample_size nodes), not by the data.
    nodes = model.orderBy("tree", "node").toPandas()
    scale = float(average_path(nodes["sample_size"].max())) or 1.0
    levels = depth_of(int(nodes["sample_size"].max()))
    shared = spark.sparkContext.broadcast([_walkable(g, levels) for _, g in nodes.groupby("tree")])
    width = len(names)

    @F.pandas_udf("double")
    def isolation(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            flat, base = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * width
            total = np.zeros(len(x))
            for feature, threshold, path in forest:
                at = np.ones(len(x), dtype=np.int64)
                for _ in range(levels):
                    at = 2 * at + (flat[base + feature[at]] > threshold[at])
                total += path[at]
            yield pd.Series(np.exp2(-(total / len(forest)) / scale))

    inputs = [F.coalesce(as_col(f).cast("double"), F.lit(0.0)) for f in names]
    scored = df.withColumn("_raw", isolation(*inputs))
    if raw:
        return scored.withColumnRenamed("_raw", output)
    # Python scoring runs once; the batch minimum and maximum and the result read its table.
    stored = materialize_scratch(scored, "scores")
    low, high = stored.agg(F.min("_raw")).scalar(), stored.agg(F.max("_raw")).scalar()
    spread = F.when(high > low, (F.col("_raw") - low) / (high - low)).otherwise(F.lit(0.0))
    return stored.withColumn(output, F.round(spread, 4)).drop("_raw")


def ml_alerts(scored: DataFrame, existing: DataFrame | None = None, threshold: float = 0.7, extra: tuple[str, ...] = ()) -> DataFrame:
    """Alerts for scores above the threshold whose transaction has no alert yet."""
    hits = scored.where(F.col("ml_score") > threshold)
    if existing is not None:
        hits = new_alerts_only(hits, existing)
    text = F.concat(F.lit("Isolation Forest score: "), F.format_string("%.4f", F.col("ml_score").cast("double")))
    return hits.select("transaction_id", F.lit("ML_ANOMALY").alias("reason_code"), F.col("ml_score").alias("severity_score"),
                       text.alias("description"), *extra)


def new_alerts_only(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    return candidates.join(existing.select("transaction_id"), "transaction_id", "left_anti")
