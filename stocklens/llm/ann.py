"""Approximate nearest neighbours by a permutation index with pivot inverted files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import clash_free
from stocklens.llm.vectors import usable

#: Pivots: a sample of this many vectors, the ones with the smallest hash of their id.
PIVOTS = 1024
#: Nearest pivots that represent a vector and that are posted.
PREFIX = 256
#: Share of each shard, best footrule distance first, whose true distance is computed.
RERANK = 0.35
#: Vectors of a shard, whose inverted files are held in memory at once.
SHARD = 8192
#: Queries per pass over the index; a block is what is broadcast.
BLOCK = 4096


def nearest_pivots(matrix: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Per row the positions of its nearest pivots, nearest first, ties to the earlier pivot."""
    far = (pivots * pivots).sum(axis=1)[None, :] - 2.0 * matrix @ pivots.T
    prefix = min(prefix, len(pivots))
    near = np.sort(np.argpartition(far, prefix - 1, axis=1)[:, :prefix], axis=1)
    order = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1).astype(np.int32)


class InvertedFiles:
    """Of a shard: for each pivot the rows that have it among their nearest, and its place there."""

    def __init__(self, matrix: np.ndarray, pivots: np.ndarray, prefix: int) -> None:
        order = nearest_pivots(matrix, pivots, prefix)
        self.rows, self.prefix = len(matrix), order.shape[1]
        post = np.argsort(order.ravel(), kind="stable")
        self.row = (post // self.prefix).astype(np.int32)
        self.place = (post % self.prefix).astype(np.int32)
        self.start = np.searchsorted(order.ravel()[post], np.arange(len(pivots) + 1))

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Distance to each row: places moved, a pivot that the row lacks standing after its last.

        Starts from the distance of a row that shares no pivot and corrects it along the
        postings of the query's pivots only."""
        total = np.full(self.rows, int((self.prefix - np.arange(len(query))).sum()), dtype=np.int32)
        for at, pivot in enumerate(query):
            s = slice(self.start[pivot], self.start[pivot + 1])
            total[self.row[s]] += np.abs(self.place[s] - at) - (self.prefix - at)
        return total


def _shards(batches: Iterator[pa.RecordBatch], size: int):
    held: dict[int, list] = {}
    for batch in batches:
        for ids, matrix in usable(batch.column(0), batch.column(1), drop_zero=True):
            for i in range(0, len(ids), size):
                parts = held.setdefault(matrix.shape[1], [])
                parts.append((ids[i : i + size], matrix[i : i + size]))
                if sum(len(p[0]) for p in parts) >= size:
                    yield tuple(np.concatenate(x) for x in zip(*held.pop(matrix.shape[1]), strict=True))
    for parts in held.values():
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision, from the differences of the original components."""
    gap = rows - query
    return np.sqrt((gap * gap).sum(axis=1))


def _search(pivots, queries, k, prefix, rerank, shard):
    def run(batches):
        for ids, matrix in _shards(batches, shard):
            dim = matrix.shape[1]
            if dim not in queries:
                continue
            files = InvertedFiles(matrix, pivots[dim], prefix)
            take = min(len(ids), max(2 * k, int(np.ceil(rerank * len(ids)))))
            out = [[], [], []]
            for (qid, vector), near in zip(queries[dim], nearest_pivots(np.array([v for _, v in queries[dim]]), pivots[dim], prefix), strict=True):
                rule = files.footrule(near)
                best = np.argpartition(rule, take - 1)[:take] if take < len(ids) else np.arange(len(ids))
                best = best[ids[best] != qid]
                true = distances(matrix[best], vector)
                order = np.lexsort((ids[best], true))[:k]
                out[0].append(np.full(len(order), qid))
                out[1].append(ids[best][order])
                out[2].append(true[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out[0]), pa.int64()), pa.array(np.concatenate(out[1]), pa.int64()), pa.array(np.concatenate(out[2]), pa.float64())],
                names=["query_id", "vec_id", "score"],
            )

    return run


def _plain(batches):
    for batch in batches:
        for ids, matrix in usable(batch.column(0), batch.column(1), drop_zero=True):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(list(matrix), pa.list_(pa.float64()))], names=["id", "v"])


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest vectors found for each query, its own row excluded.

    A vector is represented by its ``prefix`` nearest of ``pivots`` pivots, in order, and
    posted in one inverted file per pivot. Shards of at most ``shard`` vectors hold the files
    of their own rows; a query walks the files of its own pivots, every row gets its footrule
    distance, the best ``rerank`` share of each shard (2 k at least) is ranked by true
    distance, and the shards' answers are merged. The share is the same at every size and
    every row is indexed; only the pivots are a bounded sample (smallest hashes of ids).

    Queries go in blocks of about ``block``. Null, empty, zero or non-finite vectors and rows
    without id take no part; only vectors of a query's dimension are its candidates; repeated
    rows count separately; of repeated query ids the smallest vector is used. Other columns
    are ignored; an empty table gives no rows.
    """
    spark, sc = vectors.sparkSession, vectors.sparkSession.sparkContext
    rows = clash_free(vectors, id_col, vec_col)
    sample = rows.mapInArrow(_plain, "id long, v array<double>").withColumn("d", F.size("v"))
    dims = [r.d for r in sample.select("d").distinct().collect()]
    by_dim = {}
    for d in dims:
        got = sample.where(F.col("d") == d).orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()
        by_dim[d] = np.array([r.v for r in got])
    asked = clash_free(queries, id_col, vec_col).mapInArrow(_plain, "id long, v array<double>").groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() * 5 // (4 * block)))
    out = None
    for b in range(blocks):
        mine: dict[int, list] = {}
        for r in asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect():  # bounded by the block
            mine.setdefault(len(r.v), []).append((r.id, np.array(r.v)))
        shared = sc.broadcast((by_dim, mine))
        found = rows.mapInArrow(lambda it, s=shared: _search(*s.value, k, prefix, rerank, shard)(it), "query_id long, vec_id long, score double")
        out = found if out is None else out.unionAll(found)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
