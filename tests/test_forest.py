import hashlib
import math

import numpy as np
import pytest

from ledgerlens.operators import forest, rules
from ledgerlens.sources import sinks
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    rows = [(f"n{i:03d}", float(rng.uniform(10, 500)), float(rng.uniform(-60, 60)), float(rng.uniform(-100, 100))) for i in range(190)]
    rows += [(f"o{i:03d}", float(rng.uniform(50_000, 100_000)), float(rng.uniform(85, 90)), float(rng.uniform(170, 180))) for i in range(10)]
    return spark.createDataFrame(rows, "transaction_id string, amount double, latitude double, longitude double")


@pytest.fixture(scope="module")
def trees(frame):
    return forest.train_isolation_forest(frame, trees=60)


def test_scores_separate_outliers(frame, trees):
    out = forest.score_isolation_forest(frame, trees)
    stats = {r["outlier"]: r for r in out.groupBy(F.col("transaction_id").startswith("o").alias("outlier")).agg(
        F.avg("ml_score").alias("mean"), F.min("ml_score").alias("low"), F.max("ml_score").alias("high"), F.count("*").alias("n")).collect()}
    assert stats[True]["n"] == 10 and stats[False]["n"] == 190
    assert stats[True]["mean"] > stats[False]["mean"] + 0.3
    assert min(s["low"] for s in stats.values()) == 0.0 and max(s["high"] for s in stats.values()) == 1.0
    raw = forest.score_isolation_forest(frame, trees, raw=True).agg(F.min("ml_score"), F.max("ml_score")).collect()[0]
    assert 0 < raw[0] < raw[1] < 1


def test_same_seed_same_forest(frame, trees):
    again = forest.train_isolation_forest(frame.repartition(5), trees=60)
    assert sorted(again.collect(), key=str) == sorted(trees.collect(), key=str)
    other = forest.train_isolation_forest(frame, trees=60, seed=7)
    assert sorted(other.collect(), key=str) != sorted(trees.collect(), key=str)


def test_nulls_count_as_zero_and_keep_the_row(spark, frame, trees):
    holes = frame.withColumn("latitude", F.when(F.col("transaction_id") != "n000", F.col("latitude")))
    out = forest.score_isolation_forest(holes, trees)
    assert out.count() == 200 and out.where("ml_score is null").count() == 0
    with pytest.raises(ValueError):
        forest.train_isolation_forest(frame.withColumn("amount", F.lit(None).cast("double")))


def plain_forest(rows, trees, size, seed=42):
    """The forest in plain Python: {(tree, node): (feature, threshold, path)}."""
    digits = lambda n, *parts: int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:n], 16)
    pool = sorted({(digits(15, seed, k), str(k), *map(float, x)) for k, *x in rows})[:trees * size]
    out = {}
    for tree in range(trees):
        a, b = 1 + digits(7, seed, tree, "factor"), digits(7, seed, tree, "shift")
        sample = sorted(pool, key=lambda r: ((r[0] % (2**31 - 1) * a + b) % (2**31 - 1), *r))[:size]
        todo, depth_limit = [(1, [r[2:] for r in sample])], max(1, math.ceil(math.log2(max(len(sample), 2))))
        while todo:
            node, points = todo.pop()
            depth = node.bit_length() - 1
            free = [i for i in range(3) if len({p[i] for p in points}) > 1]
            if depth == depth_limit or not free:
                n = len(points)
                c = 0 if n < 2 else 1 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
                out[tree, node] = (None, None, pytest.approx(depth + c))
                continue
            i = free[digits(8, seed, tree, node, "feature") % len(free)]
            low, high = min(p[i] for p in points), max(p[i] for p in points)
            cut = low + digits(13, seed, tree, node, "cut") / 2**52 * (high - low)
            cut = cut if cut < high else low
            out[tree, node] = (i, cut, None)
            todo += [(2 * node, [p for p in points if p[i] <= cut]), (2 * node + 1, [p for p in points if p[i] > cut])]
    return out


@pytest.mark.parametrize("rows,trees,size", [(1, 3, 8), (50, 20, 64), (3000, 8, 64), (40_000, 10, 16)])
def test_forest_equals_plain_python(spark, rows, trees, size):
    """One way for every size: fewer rows than a sample, than all samples, and many more."""
    df = spark.range(rows).select(F.col("id").alias("transaction_id"), *[(F.xxhash64("id", F.lit(i)) % 1000).cast("double").alias(c)
                                                                         for i, c in enumerate(("amount", "latitude", "longitude"))])
    model = forest.train_isolation_forest(df.union(df.where("id % 3 = 0")) if rows < 100 else df, trees=trees, sample_size=size).collect()
    none = lambda v: None if v is None or v != v else v
    got = {(r["tree"], r["node"]): (r["feature"], none(r["threshold"]), none(r["path"])) for r in model}
    assert got == plain_forest([tuple(r) for r in df.collect()], trees, size)
    assert {r["sample_size"] for r in model} == {min(size, rows)}


def test_a_repeated_row_does_not_crowd_the_pool(spark):
    """Half of all rows are one: the bound is widened until the pool is full."""
    df = spark.range(4000).select(F.greatest("id", F.lit(3600)).alias("transaction_id"), *[F.greatest("id", F.lit(3600)).cast("double").alias(c) for c in ("amount", "latitude", "longitude")])
    got = forest.train_isolation_forest(df, trees=5, sample_size=64)
    want = forest.train_isolation_forest(df.distinct(), trees=5, sample_size=64)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_path_length_against_a_plain_walk(frame, trees):
    nodes = {}
    for r in trees.collect():
        nodes.setdefault(r["tree"], {})[r["node"]] = r
    psi = max(r["sample_size"] for t in nodes.values() for r in t.values())

    def walk(tree, x):
        at = 1
        while tree[at]["feature"] is not None:
            at = 2 * at + (x[tree[at]["feature"]] > tree[at]["threshold"])
        return tree[at]["path"]
    got = {r["transaction_id"]: r["ml_score"] for r in forest.score_isolation_forest(frame, trees, raw=True).collect()}
    for r in frame.limit(20).collect():
        mean = np.mean([walk(t, r[1:]) for t in nodes.values()])
        assert got[r["transaction_id"]] == pytest.approx(2 ** (-mean / float(forest.average_path(psi))))


def test_model_round_trip_and_alerts(spark, frame, trees, tmp_path):
    with pytest.raises(FileNotFoundError):
        sinks.load_model(spark, f"{tmp_path}/none")
    sinks.save_model(trees, forest.fit_scaler(frame), f"{tmp_path}/m")
    loaded, scaler = sinks.load_model(spark, f"{tmp_path}/m")
    assert sorted(loaded.collect(), key=str) == sorted(trees.collect(), key=str) and scaler.count() == 3
    scored = forest.score_isolation_forest(frame, loaded)
    known = scored.where("ml_score > 0.7").limit(1).select("transaction_id")
    found = forest.ml_alerts(scored, known)
    assert found.count() == scored.where("ml_score > 0.7").count() - 1
    log = rules.alert_envelope(found, alert_time=F.lit("2026-01-01").cast("timestamp"), ml=True).collect()
    assert all(r["ml_score"] == r["severity_score"] and r["rule_score"] is None for r in log)


def test_constant_batch_scores_zero(spark, trees):
    df = spark.createDataFrame([("a", 1.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0)], "transaction_id string, amount double, latitude double, longitude double")
    assert {r["ml_score"] for r in forest.score_isolation_forest(df, trees).collect()} == {0.0}
