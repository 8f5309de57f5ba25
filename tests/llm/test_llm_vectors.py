"""Exact integer clustering and product codes against brute force in Python's own integers."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stocklens.llm import clustering, codes, integers

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v int, cluster string, tie int, dim int"


def rows_of(rng, n, dim, spread=1.0):
    centre = rng.normal(0, spread, (4, dim))
    rows = [(i * 3, [float(x) for x in centre[i % 4] + rng.normal(0, 0.2, dim)], i % 3 or None) for i in range(n)]
    rows += [(9000, None, 1), (9001, [None] * dim, 1), (9002, [math.nan] * dim, 2), (9003, [math.inf] + [0.0] * (dim - 1), 2), (9004, [], 1)]
    rows += [(9005, [0.0] * dim, 1), (None, [1.0] * dim, 1), (9006, [1.0, -2.0], 1), rows[3], rows[3], (rows[5][0], [0.5] * dim, 1)]
    rows += [(8000 + i, [0.25] * dim, 7) for i in range(n // 2)]  # a third of all alike
    return [(*r, "x", 1, "y", 2, 3) for r in rows]


def floors(v, scale):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * x) for x in v]


def nearest(v, centres):
    return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))


def means(vectors, centres):
    groups = {}
    for v in vectors:
        groups.setdefault(nearest(v, centres)[1], []).append(v)
    return [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centres)]


def test_limb_products_are_exact():
    rng = np.random.default_rng(4)
    for inner, bits in ((1, 31), (4, 29), (64, 28), (7, 12), (16, 29)):
        a, b = (rng.integers(-(2**bits), 2**bits, (9, inner)) for _ in range(2))
        a[0], b[0], b[1] = -(2**bits), 2**bits - 1, 0
        expect = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert integers.exact_product(a, b).tolist() == expect
        a, b = a >> 2, b >> 2
        assert integers.squared_distances(a, b).tolist() == [[sum((int(x) - int(y)) ** 2 for x, y in zip(r, s)) for s in b] for r in a]
    parts = integers.limbs(np.array([[-(2**40) - 5, 2**50 + 3]]), 24)
    assert len(parts) == 3 and sum(int(p[0, 0]) << (24 * i) for i, p in enumerate(parts)) == -(2**40) - 5


def test_distances_beyond_a_long_are_refused():
    ids, at = pa.array([1, 2]), 2.0**28
    assert [m.tolist() for _, m in integers.floored(ids, pa.array([[at, -at], None]), 1)] == [[[2**28, -(2**28)]]]
    with pytest.raises(ValueError, match="fit a long"):
        list(integers.floored(ids, pa.array([[1.0, 2.0], [2.0**31, 0.0]]), 1))


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 1)])
def test_hilbert_keys_walk_the_grid(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = clustering.hilbert_keys(grid, bits)
    assert len(set(keys)) == len(grid)
    walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()  # one step at a time


def test_boxes_never_drop_the_nearest():
    rng = np.random.default_rng(6)
    for _ in range(200):
        block, centroids = rng.integers(-9, 9, (5, 3)), rng.integers(-30, 30, (8, 3))
        may = clustering.candidates(block.min(axis=0)[None], block.max(axis=0)[None], centroids)[0]
        for v in block:
            far = ((centroids - v) ** 2).sum(axis=1)
            assert may[far == far.min()].all()


def test_boxes_rule_out_most_centroids_of_clustered_vectors():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-60, 60, (16, 64))
    rows = centroids[rng.integers(0, 16, 20_000)] + rng.integers(-8, 9, (20_000, 64))
    low, high = rows.min(axis=0), rows.max(axis=0)
    keys = clustering.hilbert_keys((rows - low) * 15 // (high - low))
    rows = rows[sorted(range(len(rows)), key=keys.__getitem__)]
    starts = np.arange(0, len(rows), 64)
    may = clustering.candidates(np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts), centroids)
    assert may.sum(axis=1).mean() < 3 and np.median(may.sum(axis=1)) == 1


@pytest.mark.parametrize(("n", "block"), [(60, 8), (9, 64)])
def test_clusters_equal_brute_force(spark, n, block):
    rows = rows_of(np.random.default_rng(n), n, 6)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, clusters = clustering.cluster_vectors(df, clusters=7, rounds=3, dimension=6, block=block)
    kept = [(r[0], v) for r in rows if (v := floors(r[1], 64)) and len(v) == 6]
    key = lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:7]]
    for _ in range(3):
        centres = means([v for _, v in kept], centres)
    expect = [(i, k, d) for i, v in kept for d, k in [nearest(v, centres)]]
    sort = lambda rs: sorted(rs, key=str)
    assert sort(map(tuple, got.select("vec_id", "cluster", "distance").collect())) == sort(expect)
    total = sum(d for _, _, d in expect)
    used = sorted({k for _, k, _ in expect})
    assert sorted(map(tuple, clusters.collect())) == [(k, centres[k], sum(d for _, c, d in expect if c == k), total) for k in used]


def test_clusters_of_little(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert [x.collect() for x in clustering.cluster_vectors(none, dimension=6)] == [[], []]
    lone = spark.createDataFrame([(None, [1.0] * 6, 1, "", 1, "", 1, 1)], SCHEMA)
    assert [x.collect() for x in clustering.cluster_vectors(lone, dimension=6)] == [[], []]  # nothing to start from


def test_codes_equal_brute_force(spark):
    rows = rows_of(np.random.default_rng(8), 50, 8)
    rows += [(7000 + i, [float(i), 2.0, 3.0, -float(i * i)], 1, "x", 1, "y", 2, 3) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, books = codes.compress(df, parts=4, entries=16, rounds=2)
    expect, learnt, errors = [], {}, {}
    kept = [(r[0], v, r[2]) for r in rows if (v := floors(r[1], 256)) is not None]
    for dim in {len(v) for _, v, _ in kept}:
        mine = [r for r in kept if len(r[1]) == dim]
        if not dim or dim % 4:
            expect += [(i, dim, None, None, label) for i, _, label in mine]
            continue
        cut = lambda v, p, w=dim // 4: v[p * w : (p + 1) * w]
        first = sorted(mine, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
        book = [[cut(v, p) for _, v, _ in first] for p in range(4)]
        for _ in range(2):
            book = [means([cut(v, p) for _, v, _ in mine], book[p]) for p in range(4)]
        learnt[dim] = [x for part in book for entry in part for x in entry]
        for i, v, label in mine:
            found = [nearest(cut(v, p), book[p]) for p in range(4)]
            expect.append((i, dim, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
            errors[label] = errors.get(label, 0) + expect[-1][3]
    expect = [(i, dim, code, error, errors.get(label)) for i, dim, code, error, label in expect]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expect, key=str)
    assert {r.dim: r.codebooks for r in books.collect()} == learnt


def test_codes_of_nothing(spark):
    got, books = codes.compress(spark.createDataFrame([], SCHEMA), parts=4)
    assert got.collect() == books.collect() == []
    got, _ = codes.compress(spark.createDataFrame([(1, [1.0], 1, "", 1, "", 1, 1)], SCHEMA), parts=4)
    assert [(r.vec_id, r.code, r.error) for r in got.collect()] == [(1, None, None)]


def test_a_code_has_digits_for_every_entry(spark):
    rows = [(i, [float(i)], 1, "", 1, "", 1, 1) for i in range(300)]
    got, _ = codes.compress(spark.createDataFrame(rows, SCHEMA), parts=1, entries=300, rounds=1)
    assert {r.vec_id: r.code for r in got.where(F.col("vec_id") > 250).collect()} == {i: f"{i:03x}" for i in range(251, 300)}
