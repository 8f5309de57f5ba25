"""Exact and approximate search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocklens.llm import ann, topk
from stocklens.llm.queries import op5_permutation_ann

SCHEMA = "vec_id long, embedding array<float>, score int, id string, v int"
SF = "/root/testdata/sf0.01"


def odd_rows(rng, n=120, dim=6):
    rows = [(i, [float(x) for x in rng.integers(-3, 4, dim) / 8]) for i in range(n)]
    rows += [(200, None), (201, [None] * dim), (202, [float("nan")] * dim), (203, [float("inf")] + [0.0] * (dim - 1)), (204, []), (205, [0.0] * dim)]
    rows += [(None, [1.0] * dim), (210, [1.0, 2.0]), (212, [2.0, 1.0]), (3, rows[3][1]), (7, rows[7][1])]
    return [(i, v, 1, "x", 2) for i, v in rows]


def taking_part(rows, zero):
    out = []
    for i, v, *_ in rows:
        v32 = None if v is None else [None if x is None else float(np.float32(x)) for x in v]
        if i is not None and v32 and all(x is not None and np.isfinite(x) for x in v32) and (zero or any(v32)):
            out.append((i, v32))
    return out


def test_exact_top_k_equals_brute_force(spark):
    rows = odd_rows(np.random.default_rng(1))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = topk.exact_top_k(df, df.where(F.col("vec_id") % 10 == 0), k=5, block=8)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    expect = []
    part = taking_part(rows, True)
    for q, qv in {i: v for i, v in part if i % 10 == 0}.items():
        scored = []
        for i, v in part:
            if i != q and len(v) == len(qv):
                scored.append((-sum(int(np.floor(256 * a)) * int(np.floor(256 * b)) for a, b in zip(qv, v)), i))
        expect += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(expect)


def test_exact_top_k_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.exact_top_k(none, none).collect() == []
    lone = spark.createDataFrame([(0, [1.0], 1, "", 1)], SCHEMA)
    assert topk.exact_top_k(lone, lone).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**18 + i), -float(2**17)], 0, "", 0) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.query_id, r.vec_id): r.score for r in topk.exact_top_k(df, df.where("vec_id = 4"), k=3).collect()}
    assert got == {(4, j): 65536 * ((2**18 + 4) * (2**18 + j) + 2**34) for j in (19, 18, 17)}


def test_scores_beyond_a_long_are_refused(spark):
    wide = spark.createDataFrame([(i, [2.0**18] * 768, 0, "", 0) for i in range(3)], SCHEMA)
    with pytest.raises(Exception, match="may not fit a long"):
        topk.exact_top_k(wide, wide.where("vec_id = 1"), k=2).collect()
    tall = spark.createDataFrame([(i, [1e6 + i, -1.0], 0, "", 0) for i in range(3)], SCHEMA)
    got = {r.vec_id: r.score for r in topk.exact_top_k(tall, tall.where("vec_id = 1"), k=3).collect()}
    assert got == {i: 65536 * ((10**6 + 1) * (10**6 + i) + 1) for i in (0, 2)}  # floor(256 * 1e6), not clipped


def test_footrule_over_postings_equals_its_definition():
    rng = np.random.default_rng(3)
    data, pivots = rng.standard_normal((50, 8)), rng.standard_normal((20, 8))
    files, order = ann.InvertedFiles(data, pivots, 7), ann.nearest_pivots(data, pivots, 7)
    query = ann.nearest_pivots(rng.standard_normal((1, 8)), pivots, 7)[0].tolist()
    for row, total in zip(order.tolist(), files.footrule(np.array(query)), strict=True):
        assert total == sum(abs((row.index(p) if p in row else 7) - at) for at, p in enumerate(query))


def test_ann_handles_odd_rows_and_small_tables(spark):
    rows = odd_rows(np.random.default_rng(2))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    part = taking_part(rows, False)
    got = ann.nearest(df, df.where(F.col("vec_id") % 10 == 0), k=4, rerank=1.0, shard=16, block=8).collect()
    expect = []
    for q, qv in {i: v for i, v in part if i % 10 == 0}.items():
        near = sorted((float(np.sqrt(((np.array(v) - np.array(qv)) ** 2).sum())), i) for i, v in part if i != q and len(v) == len(qv))
        expect += [(q, r + 1, i, d) for r, (d, i) in enumerate(near[:4])]
    assert sorted(map(tuple, got)) == sorted(expect)  # with everything reranked it is exact
    none = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(none, none).collect() == []


def test_ann_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, data = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = op5_permutation_ann(spark, SF).collect()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((data - data[ids == q][0]) ** 2).sum(axis=1))
        true = [i for i in ids[np.lexsort((ids, far))].tolist() if i != q][:10]
        mine = {r.vec_id: r.score for r in got if r.query_id == q}
        assert all(s == pytest.approx(far[ids == i][0], rel=1e-12) for i, s in mine.items())
        hits, total = hits + len(mine.keys() & set(true)), total + 10
    assert hits / total >= 0.9
