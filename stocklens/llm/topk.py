"""Exact top-k search by distributed selection on score histograms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import clash_free
from stocklens.llm.vectors import usable

#: Queries per pass over the candidates; a block is what is broadcast (2 MB at 64 components).
BLOCK = 4096
#: Bins per query and round of the histograms.
BINS = 1024
#: Scores below this fit a long with room for the histograms' ranges.
REACH = 2.0**61


def quantise(matrix: np.ndarray, scale: float = 256.0) -> np.ndarray:
    """Floors of the scaled components. Components so large that a score might not fit are
    refused: no result could hold it."""
    found = np.floor(scale * matrix)
    most = float(np.abs(found).max(initial=0.0))
    if matrix.shape[1] * most * most >= REACH:
        raise ValueError(f"components up to {most:.6g} after scaling: inner products of {matrix.shape[1]} of them may not fit a long")
    return found.astype(np.int64)


def integer_scores(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where every sum fits 53 bits, else by integers."""
    if float(np.abs(rows).max()) * float(np.abs(queries).max()) * rows.shape[1] < 2.0**53:
        return (rows.astype(np.float64) @ queries.T.astype(np.float64)).astype(np.int64)
    return rows @ queries.T


class Block:
    """A bounded block of queries, by dimension, with the state of its selection.

    The range that holds a query's kth value is [low, high), in bins of ``width``; ``need``:
    how many of the k lie in it."""

    def __init__(self, rows: list, k: int) -> None:
        rows = sorted(rows, key=lambda r: r[0])
        self.k, self.ids = k, np.array([r[0] for r in rows], dtype=np.int64)
        dims = np.array([len(r[1]) for r in rows])
        self.groups = {int(d): np.flatnonzero(dims == d) for d in np.unique(dims)}
        self.vectors = {d: np.array([rows[i][1] for i in at], dtype=np.int64) for d, at in self.groups.items()}
        self.need = np.full(len(rows), k, dtype=np.int64)
        self.low = np.zeros(len(rows), dtype=np.int64)
        self.high = np.zeros(len(rows), dtype=np.int64)
        self.width = np.ones(len(rows), dtype=np.int64)

    def scored(self, batches: Iterator[pa.RecordBatch]):
        """``(dimension, candidate ids, scores, own)`` of all candidates, a few thousand at a time."""
        for batch in batches:
            for ids, matrix in usable(batch.column(0), batch.column(1)):
                if (at := self.groups.get(matrix.shape[1])) is None:
                    continue
                step = max(1, 4_000_000 // len(at))
                for i in range(0, len(ids), step):
                    part = ids[i : i + step]
                    yield matrix.shape[1], part, integer_scores(quantise(matrix[i : i + step]), self.vectors[matrix.shape[1]]), part[:, None] == self.ids[at]


def _histogram(block: Block):
    """Per task: counts of the scores in each query's range. Bins below the one that holds the
    task's own kth value are not sent: at least k scores lie above them, so they hold no kth
    value of the whole; a task sends at most k bins of a query."""

    def run(batches):
        counts = {d: np.zeros((len(at), BINS), dtype=np.int64) for d, at in block.groups.items()}
        for d, _, score, own in block.scored(batches):
            at = block.groups[d]
            bins = (score - block.low[at]) // block.width[at]
            seen = (score >= block.low[at]) & (score < block.high[at]) & ~own
            flat = (np.arange(len(at)) * BINS + np.clip(bins, 0, BINS - 1))[seen]
            counts[d] += np.bincount(flat, minlength=counts[d].size).reshape(counts[d].shape)
        for d, at in block.groups.items():
            above = counts[d][:, ::-1].cumsum(axis=1)[:, ::-1] - counts[d]
            q, b = np.nonzero((counts[d] > 0) & (above < block.need[at][:, None]))
            columns = (at[q], b, counts[d][q, b], block.need[at[q]])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["q", "bin", "n", "need"])

    return run


def _selected(block: Block):
    """Candidates above a query's kth value, and of those that equal it the k smallest ids."""

    def run(batches):
        ties: dict[int, list[int]] = {}
        for d, ids, score, own in block.scored(batches):
            at = block.groups[d]
            score = np.where(own, np.iinfo(np.int64).min, score)
            row, q = np.nonzero(score > block.low[at])
            yield _rows(block.ids[at[q]], ids[row], score[row, q])
            row, q = np.nonzero(score == block.low[at])
            order = np.lexsort((ids[row], q))
            row, q = row[order], q[order]
            first = np.searchsorted(q, q)
            for i in np.flatnonzero(np.arange(len(q)) - first < block.k):
                ties.setdefault(int(at[q[i]]), []).append(int(ids[row[i]]))
        for q, held in ties.items():
            held = np.sort(np.array(held, dtype=np.int64))[: block.k]
            yield _rows(np.full(len(held), block.ids[q]), held, np.full(len(held), block.low[q]))

    return run


def _rows(q, ids, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, ids, score)], names=["query_id", "vec_id", "score"])


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """The ``k`` highest integer inner products of each query with all vectors but its own.

    Every component x becomes floor(256 x). Scores are never sorted or shuffled: each round
    counts them into histograms over the range that holds the kth value, per-task histograms
    are added up by Spark, and the range shrinks 1024-fold until it is one integer. Then the
    scores above it, and as many equal ones as are missing, smallest id first, are the answer.

    Queries go in blocks of about ``block``, each a few passes over the vectors; only a block
    is broadcast. Null, empty or non-finite vectors and rows without id take no part; vectors
    of another dimension are no candidates of a query; repeated candidate rows count
    separately; of repeated query ids the smallest vector is used. Other columns are ignored.
    An empty table gives no rows. Components of which an inner product might not fit a long
    raise an error; nothing is clipped.
    """
    spark = vectors.sparkSession
    rows = clash_free(vectors, id_col, vec_col)
    asked = clash_free(queries, id_col, vec_col).mapInArrow(_quantised, "id long, v array<long>").groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() * 5 // (4 * block)))
    parts = []
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)
        state = Block([(r.id, r.v) for r in mine.collect()], k)  # bounded by the block
        if len(state.ids):
            parts.append(_search(rows, state))
    out = spark.createDataFrame([], "query_id long, vec_id long, score long") if not parts else parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def _quantised(batches):
    for batch in batches:
        for ids, matrix in usable(batch.column(0), batch.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(list(quantise(matrix)), pa.list_(pa.int64()))], names=["id", "v"])


def _search(rows: DataFrame, block: Block) -> DataFrame:
    sc = rows.sparkSession.sparkContext

    def largest(batches):
        top = {}
        for batch in batches:
            for _, matrix in usable(batch.column(0), batch.column(1)):
                d, v = matrix.shape[1], quantise(matrix).astype(np.float64)
                top[d] = max(top.get(d, 0.0), float((v * v).sum(axis=1).max()))
        yield pa.RecordBatch.from_arrays([pa.array(list(top), pa.int64()), pa.array(list(top.values()), pa.float64())], names=["d", "s"])

    longest = {r.d: r.s for r in rows.mapInArrow(largest, "d long, s double").groupBy("d").agg(F.max("s").alias("s")).collect()}
    for d, at in block.groups.items():
        # No score is beyond the product of the lengths.
        reach = np.sqrt((block.vectors[d].astype(np.float64) ** 2).sum(axis=1) * longest.get(d, 0.0)) * (1 + 1e-9) + 1
        reach = np.minimum(reach, REACH).astype(np.int64)  # of rounding only: quantise refuses what is beyond
        block.low[at], block.high[at], block.width[at] = -reach, reach + 1, 2 * reach // BINS + 1
    open_ = np.ones(len(block.ids), dtype=bool)
    while open_.any():
        shared = sc.broadcast(block)
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        # The highest bin with enough scores in and above it holds the kth value; one row a
        # query of the block comes back.
        picked = (
            rows.mapInArrow(lambda it, s=shared: _histogram(s.value)(it), "q long, bin long, n long, need long")
            .groupBy("q", "bin").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
            .withColumn("upto", F.sum("n").over(down)).where("upto >= need")
            .groupBy("q").agg(F.max(F.struct("bin", "n", "upto")).alias("h")).collect()
        )
        found = {r.q: r.h for r in picked}
        for q in np.flatnonzero(open_):
            if (h := found.get(q)) is None:  # fewer than k candidates: all are wanted
                block.low[q], open_[q] = -(2**62), False
            else:
                block.low[q] += h.bin * block.width[q]
                block.high[q] = min(block.high[q], block.low[q] + block.width[q])
                block.need[q] -= h.upto - h.n
                open_[q] = block.width[q] > 1
        block.width = np.where(open_, -(-block.width // BINS), 1)
    shared = sc.broadcast(block)
    return rows.mapInArrow(lambda it, s=shared: _selected(s.value)(it), "query_id long, vec_id long, score long")
