"""Vector code compression: product codes learnt with exact integer arithmetic."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import written
from stocklens.llm.integers import exact_product, floor_mean, floored, list_matrix, long_lists

#: Vectors coded at once by a task.
STEP = 4096


def _floored(scale: int):
    def run(batches):
        for batch in batches:
            for rows, matrix in floored(batch.column(0), batch.column(1), scale):
                at = pa.array(rows)
                columns = [batch.column(0).take(at), long_lists(matrix), batch.column(2).take(at), pa.array(np.full(len(rows), matrix.shape[1]), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "label", "dim"])

    return run


class Codebooks:
    """For vectors of one dimension: entries by part, entry and place within the part."""

    def __init__(self, vectors: np.ndarray, parts: int) -> None:
        self.parts, self.width = parts, vectors.shape[1] // parts
        self.entries = np.ascontiguousarray(vectors.reshape(len(vectors), parts, self.width).transpose(1, 0, 2))

    def nearest(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row and part the first nearest entry, and the squared distance to it."""
        cut = matrix.reshape(len(matrix), self.parts, self.width)
        index, error = (np.empty((len(matrix), self.parts), dtype=np.int64) for _ in range(2))
        for p, book in enumerate(self.entries):
            part = np.ascontiguousarray(cut[:, p])
            rest = (book * book).sum(axis=1) - 2 * exact_product(part, book)
            index[:, p] = rest.argmin(axis=1)
            error[:, p] = (part * part).sum(axis=1) + rest[np.arange(len(part)), index[:, p]]
        return index, error


def _steps(batches, books: dict[int, Codebooks]):
    for whole in batches:
        dims = whole.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            if dim not in books:
                continue
            rows = np.flatnonzero(dims == dim)
            for at in range(0, len(rows), STEP):
                batch = whole.take(pa.array(rows[at : at + STEP]))
                yield batch, books[dim], list_matrix(batch.column("v"), dim)


def _sums(books: dict[int, Codebooks]):
    """Per task the count and the exact component sums of each entry that some part chose."""

    def run(batches):
        count = {d: np.zeros(b.entries.shape[:2], dtype=np.int64) for d, b in books.items()}
        total = {d: np.zeros(b.entries.shape, dtype=np.int64) for d, b in books.items()}
        for _, book, matrix in _steps(batches, books):
            dim = matrix.shape[1]
            index, _ = book.nearest(matrix)
            cut = matrix.reshape(len(matrix), book.parts, book.width)
            for p in range(book.parts):
                count[dim][p] += np.bincount(index[:, p], minlength=count[dim].shape[1])
                order = np.argsort(index[:, p], kind="stable")
                found, first = np.unique(index[order, p], return_index=True)
                total[dim][p, found] += np.add.reduceat(cut[order, p], first)
        for dim, book in books.items():
            part, entry = np.nonzero(count[dim])
            rows, width = len(part), book.width
            columns = (np.full(rows * width, dim), np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), rows), np.repeat(count[dim][part, entry], width), total[dim][part, entry].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["dim", "part", "entry", "place", "n", "s"])

    return run


def _coded(books: dict[int, Codebooks]):
    def run(batches):
        for batch, book, matrix in _steps(batches, books):
            index, error = book.nearest(matrix)
            digits = max(2, -(-(book.entries.shape[1] - 1).bit_length() // 4))
            code = ["".join(f"{i:0{digits}x}" for i in row) for row in index.tolist()]
            columns = [batch.column("id"), batch.column("dim"), batch.column("label"), pa.array(code, pa.string()), pa.array(error.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "dim", "label", "code", "error"])

    return run


def compress(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, DataFrame]:
    """Product codes of all vectors, ``vec_id, dim, code, error, label_error``, and the codebooks
    of each dimension, ``dim, codebooks``.

    Components become floor(``scale`` x) and a vector is cut into ``parts`` equal parts, each
    place with a codebook of its own, which starts as that part of the ``entries`` smallest ids'
    vectors. A round gives each part to the nearest entry (squared Euclidean distance, ties to
    the lower index) and replaces the entries in use by the floors of their parts' mean; then
    the parts are given once more. ``code`` has two hex digits a part (as many as the largest
    index takes, beyond 256 entries), ``error`` the squared distances summed over the parts,
    ``label_error`` the errors summed over the rows of equal label, nulls together, and
    ``codebooks`` the entries' components by part, entry and place.

    Nearest entries come from products of doubles over limbs of the integers, none of which is
    rounded. A task sends one sum per entry and place; only these sums and the codebooks
    (``entries`` vectors) meet the driver.

    Null vectors and those with null or non-finite components have no row. Vectors of each
    dimension are coded apart, with their own codebooks; if their dimension isn't a multiple
    of ``parts`` (or is zero) code and error are null. Rows without an id are coded
    and start a codebook only after all others; of repeated ids the smaller vector comes first,
    each counted. With fewer vectors than ``entries`` the codebooks are shorter. Other columns
    are ignored; an empty table gives no rows. Components beyond what lets a squared distance
    fit a long, and sums beyond a long, raise an error.
    """
    spark = vectors.sparkSession
    names = {"id": F.col(f"`{id_col}`").cast("long"), "v": F.col(f"`{vec_col}`"), "label": F.col(f"`{label_col}`")}
    source = vectors.select(*[c.alias(n) for n, c in names.items()])
    label = dict(source.dtypes)["label"]
    points = written(source.mapInArrow(_floored(scale), f"id long, v array<long>, label {label}, dim int"), "points")
    dims = [r.dim for r in points.select("dim").distinct().collect()]
    books: dict[int, Codebooks] = {}
    for dim in dims:
        if dim and dim % parts == 0:
            first = points.where(F.col("dim") == dim).orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
            books[dim] = Codebooks(np.array([r.v for r in first], dtype=np.int64), parts)
    for _ in range(rounds):
        found = (
            points.mapInArrow(_sums(books), "dim long, part long, entry long, place long, n long, s long")
            .groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        )
        for r in found.collect():  # as many rows as the codebooks have components
            books[r.dim].entries[r.part, r.entry, r.place] = floor_mean(r.s, r.n)
    coded = written(points.mapInArrow(_coded(books), f"vec_id long, dim int, label {label}, code string, error long"), "codes")
    odd = points.where(~F.col("dim").isin(list(books))) if books else points
    coded = coded.unionAll(odd.select(F.col("id").alias("vec_id"), "dim", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")))
    summed = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    codes = coded.join(summed, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "dim", "code", "error", "label_error")
    return codes, spark.createDataFrame([(d, b.entries.ravel().tolist()) for d, b in books.items()], "dim int, codebooks array<long>")
