"""Clustering, whitening and packing against plain forms."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from ledgerlens.llm import clusters, packing, whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def vectors(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for name in ("x", "v", "id", "cluster", "was", "n", "place", "value", "component", "h", "near"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def drawn(number, dims, seed, centres=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (number, dims))
    if centres:
        x = x * 0.2 + rng.normal(0, 1, (centres, dims))[rng.integers(0, centres, number)]
    return x.astype(np.float32)


def odd(dims):
    nan, inf = float("nan"), float("inf")
    fine = [0.25] * (dims - 1)
    return [(900, None), (901, []), (902, fine), (903, [*fine, None]), (904, [*fine, nan]), (905, [*fine, inf]), (906, [*fine, 3.0e38]), (None, [*fine, 0.5]), (907, [*fine, 0.5]), (907, [*fine, 0.5])]


# ---------------------------------------------------------------- clusters

def plain_k_means(rows, dims, k, rounds, scale=256):
    kept = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(c) < 2**62 / scale for c in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [x for _, x in first]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda x: min(range(len(centres)), key=lambda c: (square(x, centres[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in kept:
            groups[nearest(x)].append(x)
        for c, xs in groups.items():
            centres[c] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [(i, nearest(x), x) for i, x in kept]
    distance = [square(x, centres[c]) for _, c, x in found]
    each = Counter()
    for (_, c, _), d in zip(found, distance):
        each[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, c, d, each[c], sum(distance), sha[c]) for (i, c, _), d in zip(found, distance))


@pytest.mark.parametrize("number, dims, k, rounds, centres", [(700, 8, 12, 5, 9), (500, 5, 7, 1, 0), (60, 3, 40, 5, 0), (5, 4, 40, 3, 0)])
def test_clusters_equal_plain_k_means(spark, number, dims, k, rounds, centres):
    x = drawn(number, dims, number, centres)
    x[number // 2:number // 2 + number // 5] = x[0]  # copies: ties and centroids that start equal
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + odd(dims)
    found = clusters.cluster(vectors(spark, rows), dims=dims, k=k, rounds=rounds)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == plain_k_means(rows, dims, k, rounds)


def test_clusters_of_large_numbers_and_none(spark):
    rows = [(i, [float(c) * 1e9 for c in v]) for i, v in enumerate(drawn(40, 3, 5))]
    found = clusters.cluster(vectors(spark, rows), dims=3, k=4, rounds=3).collect()
    want = plain_k_means([(i, [float(np.float32(c)) for c in v]) for i, v in rows], 3, 4, 3)
    fits = lambda s: s if s < 2**63 else None
    assert Counter((r.vec_id, r.cluster, r.centroid_sha256) for r in found) == Counter((w[0], w[1], w[5]) for w in want)
    assert Counter(r.distance for r in found) == Counter(fits(w[2]) for w in want)
    assert clusters.cluster(vectors(spark, odd(3)[:6]), dims=3).collect() == []
    assert clusters.cluster(vectors(spark, []), dims=3).collect() == []


def test_bounds_skip_and_never_err():
    """Bounds taken in earlier rounds: the same clusters as full scans, with few scans, and total displacement below the sum of moves."""
    x = np.floor(256 * drawn(3000, 16, 3, 10)).astype(np.int64)
    rng = np.random.default_rng(1)
    history, state, scanned = [x[:10]], None, []
    scan = clusters.to_all
    for _ in range(12):
        bounds = clusters.Bounds(history)
        sizes = []
        clusters.to_all = lambda a, c, sizes=sizes: sizes.append(len(a)) or scan(a, c)
        try:
            state = bounds.assign(x, state)
        finally:
            clusters.to_all = scan
        scanned.append(sum(sizes))
        assert (state[0] == scan(x, history[-1]).argmin(axis=1)).all()
        # Centroids that swing to and fro: summed moves grow, displacement does not.
        history.append(history[0] + rng.integers(-6, 7, history[0].shape))
    assert scanned[0] == len(x) and max(scanned[1:]) < len(x) / 4
    last = clusters.Bounds(history)
    summed = sum(np.sqrt(((a - b) ** 2).sum(axis=1)) for a, b in zip(history[1:], history[2:]))
    assert (last.moved[1] < summed).all()


# ---------------------------------------------------------------- whitening

def plain_whitening(rows, keep):
    x = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[n * a - s for a, s in zip(v, sums)] for v in fit], object)
    exact = y.T.dot(y)
    values, vectors_ = np.linalg.eigh(np.array([[v / n**3 for v in row] for row in exact], float))
    return x, n, sums, values[::-1][:keep], vectors_[:, ::-1][:, :keep], sum(exact[i][i] for i in range(len(sums))) / n**3


@pytest.mark.parametrize("number, dims, copies", [(400, 6, 150), (60, 20, 10)])
def test_whitening_equals_numpy(spark, number, dims, copies):
    x = drawn(number, dims, number) * np.linspace(0.5, 3, dims).astype(np.float32)
    x[1:1 + copies] = x[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    bad = [r for r in odd(dims) if r[0] is not None and r[0] < 907]
    found = whitening.whiten(vectors(spark, rows + bad), components=16).collect()
    xs, n, sums, values, turn, trace = plain_whitening(rows, 16)
    keep = min(16, dims)
    assert len(found) == number * keep and {r.component for r in found} == set(range(1, keep + 1))
    want = {(i, k + 1): sum((v - s / n) * e for v, s, e in zip(xs[i], sums, turn[:, k])) / math.sqrt(values[k]) for i in xs for k in range(keep)}
    sign = {}
    for r in found:
        w = want[r.vec_id, r.component]
        assert r.n == n and r.deviation == sum((n * v - s) ** 2 for v, s in zip(xs[r.vec_id], sums))
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9) and r.identity_error < 1e-9
        if abs(w) > 1e-6:
            assert sign.setdefault(r.component, math.copysign(1, w * r.whitened)) * r.whitened == pytest.approx(w, rel=1e-6, abs=1e-9)


def test_whitening_is_exact_beyond_longs(spark):
    """Squares of 100 bits and more; a far-off mean, where covariances from uncentred doubles would be lost."""
    for factor in (2.0**20, 2.0**38):
        rows = [(i, [float(c) * factor + 3 * factor for c in v]) for i, v in enumerate(drawn(50, 4, 9))]
        rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
        found = whitening.whiten(vectors(spark, rows)).collect()
        xs, n, sums, values, _, trace = plain_whitening(rows, 16)
        for r in found:
            d = sum((n * v - s) ** 2 for v, s in zip(xs[r.vec_id], sums))
            assert r.deviation == (d if d < 2**63 else None)
            assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9) and r.identity_error < 1e-9
    a = np.random.default_rng(2).integers(-2**45, 2**45, (3, 40000))
    assert whitening._squares(a) == [sum(v * v for v in row) for row in a.tolist()] == whitening._squares(a.astype(object))


def test_whitening_without_variance_and_without_rows(spark):
    found = whitening.whiten(vectors(spark, [(1, [1.0, 2.0, 0.5]), (2, [1.0, 3.0, 0.5]), (2, [1.0, 3.0, 0.5]), (None, [1.0, 2.0, 0.5]), (3, [1.0, 2.0])])).collect()
    assert len(found) == 12 and {r.n for r in found} == {2}
    assert {round(abs(r.whitened), 9) for r in found if r.component == 1} == {1.0}
    assert all(r.whitened is None and r.explained == pytest.approx(0) for r in found if r.component > 1)
    alone = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in alone] == [(None, None, 0)] * 2
    assert whitening.whiten(vectors(spark, [])).collect() == [] == whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect()


# ---------------------------------------------------------------- packing

def token_rows(rows, size):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    for i, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), size):
            part = ids[k:k + size]
            yield i, k // size, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


@pytest.mark.parametrize("size, shard", [(2048, 4096), (64, 10)])
def test_packing_of_odd_rows(frame, odd_rows, size, shard):
    cut = packing.pieces(frame(odd_rows), TOKENIZER, size=size)
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in cut.collect()) == Counter(token_rows(odd_rows, size))
    placed = packing.place(cut, packing.pack(cut, size=size, shard=shard))
    check(placed, size)
    whole = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        s = whole[r.sequence_id]
        assert bytes(s.ids[4 * r.offset:4 * (r.offset + r.length)]) == bytes(r.ids)
        assert (r.offset, r.length, r.doc_id, r.piece) in [tuple(p) for p in s.parts]
    assert sum(s.n_tokens for s in whole.values()) == sum(t[3] for t in token_rows(odd_rows, size))


def check(placed, size):
    at = defaultdict(list)
    for r in placed.collect():
        at[r.sequence_id].append((r.offset, r.length))
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= size
    return len(at)


def lengths_frame(spark, lengths):
    return spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "row long, length int").repartition(3)


def test_packing_comes_near_the_bound_across_shards(spark):
    lengths = np.random.default_rng(4).integers(300, 1200, 2000)
    cut = lengths_frame(spark, lengths)
    found = check(packing.place(cut, packing.pack(cut, shard=250)), 2048)
    least = -(-int(lengths.sum()) // 2048)
    fit = lambda part: int(packing.best_fit(np.sort(part)[::-1], 2048).max()) + 1
    # Better than eight shards alone, and than best fit over all pieces at once.
    assert found <= 1.005 * least and found < fit(lengths) <= sum(map(fit, np.array_split(lengths, 8)))
    assert check(packing.place(cut, packing.pack(cut, shard=250)), 2048) == found


def test_packing_with_a_third_of_all_rows_alike_and_without_rows(spark):
    cut = lengths_frame(spark, [7] * 1000 + [100] * 50 + list(range(1, 100)) * 10)
    assert check(packing.place(cut, packing.pack(cut, size=100, shard=200)), 100) <= 1.02 * (7000 + 5000 + 49500) / 100 + 1
    assert packing.pack(lengths_frame(spark, [])).collect() == []


def test_empty_texts_and_table(frame):
    assert packing.pieces(frame([]), TOKENIZER).collect() == []
    cut = packing.pieces(frame([(1, None, None, None), (1, "", None, None)]), TOKENIZER)
    assert [(r.length, bytes(r.ids)) for r in cut.collect()] == [(1, bytes(4))] * 2


def fills(lengths, bins):
    return np.bincount(bins, weights=lengths).astype(int)


@pytest.mark.parametrize("size, lengths, start, want", [
    (10, [6, 4, 5, 5], [0, 1, 2, 3], [10, 10]),  # moves
    (20, [11, 8, 10, 9], [0, 0, 1, 1], [20, 18]),  # 19 and 19: a 9 for an 8
    (20, [10, 9, 7, 4, 6], [0, 0, 1, 1, 1], [20, 16]),  # 19 and 17: a 4 and a 6 for a 9
])
def test_search_grows_the_squares(size, lengths, start, want):
    lengths = np.array(lengths)
    assert sorted(fills(lengths, packing.search(lengths, np.array(start), size, 100)).tolist(), reverse=True)[:2] == want


def test_search_improves_random_packings():
    rng = np.random.default_rng(7)
    for trial in range(20):
        lengths = rng.integers(10, 60, 80)
        start = np.arange(80) // 2 if trial % 2 else packing.best_fit(lengths, 120)
        found = packing.search(lengths, start, 120, 5000)
        f = fills(lengths, found)
        assert f.max() <= 120 and f.sum() == lengths.sum()
        assert len(set(found)) <= len(set(start)) and len(set(found)) <= -(-lengths.sum() // 120) + 2
        # A local optimum: no single move or one-for-one exchange is left that grows the squares.
        for i in range(80):
            for b in set(found) - {found[i]}:
                if f[b] + lengths[i] <= 120:
                    assert f[b] + lengths[i] <= f[found[i]]
