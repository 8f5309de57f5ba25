"""Centroid clustering over Hilbert-ordered blocks with zone maps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import clash_free, written
from stocklens.llm.integers import exact_product, floor_mean, floored, list_matrix, long_lists

#: Vectors of a block, which shares one box.
BLOCK = 64
#: Bits of a component in the Hilbert key.
BITS = 4
#: Blocks taken at once by a task.
BLOCKS_AT_ONCE = 128
_LABELLED = "vec_id long, cluster int, distance long"
_BLOCK_SCHEMA = "ids array<long>, vectors array<long>, low array<long>, high array<long>"


def hilbert_keys(matrix: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Places of rows of non-negative integers below ``2 ** bits`` on the Hilbert curve, as
    strings of bytes that sort alike (Skilling's transform, over all rows at once)."""
    axes = matrix.T.astype(np.int64).copy()
    dims = len(axes)
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for axis in axes:
            set_ = (axis & bit) != 0
            swap = np.where(set_, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(set_, below, swap)
            axis ^= swap
        bit >>= 1
    for i in range(1, dims):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], dtype=np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(axes[-1] & bit, bit - 1, 0)
        bit >>= 1
    axes ^= turn
    planes = np.stack([(axes >> b) & 1 for b in range(bits - 1, -1, -1)])  # bit, axis, row
    packed = np.packbits(planes.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _points(scale: int, dimension: int):
    def run(batches):
        for batch in batches:
            for rows, matrix in floored(batch.column(0), batch.column(1), scale):
                if matrix.shape[1] == dimension:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), long_lists(matrix)], names=["id", "v"])

    return run


def _keyed(low: np.ndarray, high: np.ndarray):
    """Adds the Hilbert key of each vector, its components scaled to the box of all of them."""
    span = np.maximum(high - low, 1)

    def run(batches):
        for batch in batches:
            matrix = list_matrix(batch.column("v"), len(low))
            cells = ((matrix - low) * ((1 << BITS) - 1) // span) if len(matrix) else matrix
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(hilbert_keys(cells), pa.binary()), batch.column("tie")], names=["id", "v", "key", "tie"]
            )

    return run


def _blocks(block: int, dim: int):
    """Cuts a task's sorted rows into blocks with the least and largest value of each component."""

    def made(ids: pa.Array, matrix: np.ndarray) -> pa.RecordBatch:
        starts = np.arange(0, len(matrix), block)
        offsets = pa.array(np.append(starts, len(matrix)).astype(np.int32))
        low, high = np.minimum.reduceat(matrix, starts), np.maximum.reduceat(matrix, starts)
        vectors = pa.ListArray.from_arrays(pa.array((np.append(starts, len(matrix)) * dim).astype(np.int32)), pa.array(matrix.ravel()))
        columns = [pa.ListArray.from_arrays(offsets, ids), vectors, long_lists(low), long_lists(high)]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "vectors", "low", "high"])

    def run(batches):
        ids, rest = pa.array([], pa.int64()), np.empty((0, dim), dtype=np.int64)
        for batch in batches:
            ids = pa.concat_arrays([ids, batch.column("id")])
            rest = np.concatenate([rest, list_matrix(batch.column("v"), dim)])
            full = len(rest) // block * block
            if full:
                yield made(ids[:full], rest[:full])
                ids, rest = pa.concat_arrays([ids[full:]]), rest[full:].copy()
        if len(rest):
            yield made(ids, rest)

    return run


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Per block which centroids may be nearest to some vector in its box.

    A centroid is out if its least distance to the box is more than the largest distance that
    some other centroid can have to a point in the box; equal bounds stay, for ties."""
    low, high, centroids = (x.astype(np.float64) for x in (low, high, centroids))
    least, most = np.empty((len(low), len(centroids))), np.empty((len(low), len(centroids)))
    for k, c in enumerate(centroids):
        below, above = low - c, c - high
        least[:, k] = (np.maximum(np.maximum(below, above), 0.0) ** 2).sum(axis=1)
        most[:, k] = (np.maximum(-below, -above) ** 2).sum(axis=1)
    # The bounds may be rounded where they pass 2 ** 53; the slack keeps them bounds.
    return least * (1 - 1e-12) <= most.min(axis=1, keepdims=True) * (1 + 1e-12)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, measured: bool):
    """``(ids, vectors, clusters, distances)`` of groups of blocks that have the same candidates.

    Where no distance is wanted, blocks with one candidate need no comparison."""
    dim = centroids.shape[1]
    norms = (centroids * centroids).sum(axis=1)
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCKS_AT_ONCE):
            batch = whole.slice(at, BLOCKS_AT_ONCE)
            may = candidates(list_matrix(batch.column("low"), dim), list_matrix(batch.column("high"), dim), centroids)
            ids, vectors = batch.column("ids").flatten(), batch.column("vectors").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            block = np.repeat(np.arange(batch.num_rows), batch.column("ids").value_lengths().to_numpy())
            sets, of = np.unique(may, axis=0, return_inverse=True)
            for s, chosen in enumerate(sets):
                rows, some = np.flatnonzero((of.ravel() == s)[block]), np.flatnonzero(chosen)
                mine = vectors[rows]
                if len(some) == 1 and not measured:
                    yield None, mine, np.full(len(rows), some[0]), None
                    continue
                own = (mine * mine).sum(axis=1)
                rest = norms[some] - 2 * exact_product(mine, centroids[some])
                near = rest.argmin(axis=1)  # the first of equal ones, which is the smaller number
                yield ids.take(pa.array(rows)), mine, some[near], own + rest[np.arange(len(rows)), near]


def _sums(centroids: np.ndarray):
    """Per task the count and the exact component sums of each cluster."""

    def run(batches):
        count = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros(centroids.shape, dtype=np.int64)
        for _, vectors, cluster, _ in _assigned(batches, centroids, False):
            count += np.bincount(cluster, minlength=len(centroids))
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            total[found] += np.add.reduceat(vectors[order], first)
        at = np.flatnonzero(count)
        dim = centroids.shape[1]
        columns = (np.repeat(at, dim), np.tile(np.arange(dim), len(at)), np.repeat(count[at], dim), total[at].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["cluster", "place", "n", "s"])

    return run


def _labels(centroids: np.ndarray):
    def run(batches):
        for ids, _, cluster, distance in _assigned(batches, centroids, True):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def zone_mapped(points: DataFrame, dim: int, block: int = BLOCK) -> DataFrame:
    """``points (id, v)`` in Hilbert order, one row a block: its ids, vectors and box."""
    corners = points.select(F.posexplode("v").alias("place", "x")).groupBy("place").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    box = {r.place: r for r in corners.collect()}  # one row a component
    if not box:
        return points.sparkSession.createDataFrame([], _BLOCK_SCHEMA)
    low, high = (np.array([box[i][side] for i in range(dim)], dtype=np.int64) for side in ("low", "high"))
    # Equal vectors have equal keys: the tie spreads them over the ranges.
    keyed = points.withColumn("tie", F.monotonically_increasing_id()).mapInArrow(_keyed(low, high), "id long, v array<long>, key binary, tie long")
    sorted_ = keyed.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("id", "v")
    return written(sorted_.mapInArrow(_blocks(block, dim), _BLOCK_SCHEMA), "blocks")


def cluster_vectors(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, scale: int = 64, dimension: int = 64, seed: int = 1,
    block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """Every vector's cluster after ``rounds`` of exact integer k-means, and the clusters.

    Components become floor(``scale`` x). The first centroids are the ``clusters`` vectors with
    the smallest SHA-256 of ``<seed>:<id>``, in that order. A round gives every vector to the
    nearest centroid (squared Euclidean distance, ties to the smaller number) and replaces
    every centroid that has vectors by the floors of their mean; then they are given once more.
    Two frames: ``vec_id, cluster, distance`` (squared), and one row for each cluster that has
    vectors, ``cluster, centroid`` (its components), ``cluster_inertia, inertia``.

    Vectors are sorted along a Hilbert curve once and written in blocks of ``block`` with the
    box that holds them. A pass drops the centroids that a block's box rules out and compares
    its vectors with the others, exactly; the answer doesn't depend on the blocks. A task sends
    one sum a cluster and component; only these, the box and the centroids meet the driver.

    Null vectors, vectors of another dimension and those with null or non-finite components
    have no row. Rows without an id are clustered but never start a centroid; repeated rows
    count each, and of equal ids the smaller vector starts first. With fewer vectors than
    ``clusters`` there are as many centroids as vectors with an id; without any, and for an
    empty table, there are no rows. Other columns are ignored. Components beyond what lets a
    squared distance fit a long, and sums beyond a long, raise an error.
    """
    spark = vectors.sparkSession
    of_clusters = "cluster int, centroid array<long>, cluster_inertia long, inertia long"
    source = clash_free(vectors, id_col, vec_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("v"))
    points = written(source.mapInArrow(_points(scale, dimension), "id long, v array<long>"), "points")
    start = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = points.where("id IS NOT NULL").select("v", start.alias("key")).orderBy("key", "v").limit(clusters).collect()
    if not first:
        return spark.createDataFrame([], _LABELLED), spark.createDataFrame([], of_clusters)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    blocks = zone_mapped(points, dimension, block)
    for _ in range(rounds):
        found = blocks.mapInArrow(_sums(centroids), "cluster long, place long, n long, s long").groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        centroids = centroids.copy()
        for r in found.collect():  # clusters x dimension rows
            centroids[r.cluster, r.place] = floor_mean(r.s, r.n)
    labelled = written(blocks.mapInArrow(_labels(centroids), _LABELLED), "clusters")
    inertia = {r.cluster: r.s for r in labelled.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row a cluster
    totals = [(k, centroids[k].tolist(), inertia[k], sum(inertia.values())) for k in sorted(inertia)]
    return labelled, spark.createDataFrame(totals, of_clusters)
