"""Quality classifier: naive Bayes scaled n-gram indicators under a linear hinge loss."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.llm.bpe import text_buffers

#: Hashed n-grams; bounds what is counted, fitted and broadcast.
BUCKETS = 1 << 18
#: Labelled rows that the linear model is fitted on at the most (smallest hashes of ids; half
#: of them of each label). The log-count ratios come from all labelled rows.
FIT_ROWS = 16_000
#: Bytes whose n-grams are made at once, to the next white space.
CHUNK = 1 << 20
SMOOTH = 1.0
COST = 1.0
PASSES = 12


def _word_shapes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word a number for its look: case, length, the marks at its end, and whether it
    repeats the word before it; and where it starts."""
    blank = (text == 0x20) | ((text >= 0x09) & (text <= 0x0D))
    edge = np.diff(np.concatenate([[1], blank.astype(np.int8), [1]]))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, dtype=np.uint64), start
    upper = np.concatenate([[0], np.cumsum((text >= 0x41) & (text <= 0x5A))])
    lower = np.concatenate([[0], np.cumsum(((text >= 0x61) & (text <= 0x7A)) | (text >= 0x80))])
    letter = ((text >= 0x41) & (text <= 0x5A)) | ((text >= 0x61) & (text <= 0x7A)) | (text >= 0x80)
    size = stop - start
    capital = upper[start + 1] - upper[start]
    code = capital + 2 * (upper[stop] - upper[start] > capital) + 4 * (lower[stop] > lower[start]) + 8 * np.minimum(size // 3, 7)
    last = np.where(letter[stop - 1], 0, text[stop - 1].astype(np.int64))
    before = np.maximum(stop - 2, start)
    code = code + 64 * last + (64 << 8) * np.where(letter[before], 0, text[before].astype(np.int64))
    spread = np.cumsum(text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (text.astype(np.uint64) << np.uint64(17)))
    total = spread[stop - 1] - np.where(start > 0, spread[np.maximum(start - 1, 0)], np.uint64(0))
    again = np.zeros(len(start), dtype=np.int64)
    again[1:] = (total[1:] == total[:-1]) & (size[1:] == size[:-1]) & (text[start[1:]] == text[start[:-1]])
    return (code + (1 << 24) * again).astype(np.uint64), start


def _mixed(x: np.ndarray, family: int, buckets: int) -> np.ndarray:
    x = (x + np.uint64(family)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _pieces(text: np.ndarray):
    """``(begin, end)`` of pieces that end before white space: a word stays in one piece."""
    begin = 0
    while begin < len(text):
        end = begin + CHUNK
        while end < len(text):
            part = text[end : end + CHUNK]
            blanks = np.flatnonzero((part == 0x20) | ((part >= 0x09) & (part <= 0x0D)))
            if len(blanks):
                end += int(blanks[0])
                break
            end += len(part)
        end = min(end, len(text))
        yield begin, end
        begin = end


def ngrams(text: np.ndarray, buckets: int, seen: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text's n-grams: three bytes, and one to three word shapes. Texts
    are read whole, a bounded piece at a time: a piece begins two bytes and three words back,
    so that it has the n-grams over the cut (the first of these words serves the next one's
    shape only). ``seen`` is scratch of ``buckets`` longs."""
    found = np.empty(0, dtype=np.int64)
    back = 0  # where the last three words begin
    for begin, end in _pieces(text):
        codes = []
        part = text[max(0, begin - 2) : end]
        if len(part) > 2:
            wide = part.astype(np.uint64)
            codes.append(_mixed(wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16), 1 << 60, buckets))
        shapes, start = _word_shapes(text[back:end])
        run = shapes = shapes[1:] if back else shapes
        if len(start) >= 3:
            back += int(start[-3])
        for n in (1, 2, 3):
            if len(shapes) >= n:
                if n > 1:
                    run = run[: len(shapes) - n + 1] * np.uint64(0x100000001B3) + shapes[n - 1 :]
                codes.append(_mixed(run, n << 61, buckets))
        if codes:
            both = np.concatenate([found, *codes])
            seen[both] = np.arange(len(both))
            found = both[seen[both] == np.arange(len(both))]
    return found


def _each(texts: pa.Array, buckets: int):
    seen = np.empty(buckets, dtype=np.int64)
    data, offsets = text_buffers(texts)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield ngrams(data[a:b], buckets, seen)


def descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: np.ndarray, passes: int, seed: int = 0) -> np.ndarray:
    """Weights of the linear hinge-loss model of the scaled indicators, by dual coordinate
    descent; the last one is the bias. Rows have length one."""
    weights = np.zeros(len(scale) + 1)
    values = []
    for r in rows:
        v = np.append(scale[r], 1.0)
        values.append(v / np.sqrt((v * v).sum()))
    rows = [np.append(r, len(scale)) for r in rows]
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, v, y = rows[i], values[i], labels[i]
            slope = y * (weights[at] @ v) - 1.0
            new = min(max(alpha[i] - slope, 0.0), cost[i])
            if new != alpha[i]:
                weights[at] += (new - alpha[i]) * y * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights


def margin(row: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> float:
    v = scale[row]
    return float((weights[row] @ v + weights[-1]) / np.sqrt((v * v).sum() + 1.0))


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins, by Newton's method."""
    good = (labels > 0).sum()
    want = np.where(labels > 0, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - want) * margins).sum() + 1e-3 * a, (p - want).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, float, float]:
    """``(weights, slope, shift)``; labels are +1 and -1. The curve is fitted on margins of
    rows that the descent for it has not seen (every fifth), the weights then on all rows."""
    if len(rows) == 0 or len(set(labels.tolist())) < 2:
        return np.zeros(len(scale) + 1), 1.0, 0.0 if len(rows) == 0 else 4.0 * float(labels[0])
    share = np.array([(labels == y).mean() for y in (-1, 1)])
    cost = COST * np.where(labels > 0, 0.5 / share[1], 0.5 / share[0])
    out = np.arange(len(rows)) % 5 == 4
    trial = descend([r for r, o in zip(rows, out, strict=True) if not o], labels[~out], scale, cost[~out], passes)
    told = np.array([margin(r, scale, trial) for r, o in zip(rows, out, strict=True) if o])
    slope, shift = calibrated(told, labels[out]) if len(set(labels[out].tolist())) == 2 else (4.0, 0.0)
    return descend(rows, labels, scale, cost, passes), slope, shift


class Model:
    def __init__(self, scale: np.ndarray, weights: np.ndarray, slope: float, shift: float) -> None:
        self.scale, self.weights, self.slope, self.shift = scale.astype(np.float32), weights.astype(np.float32), slope, shift

    def score(self, row: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin(row, self.scale, self.weights) + self.shift, -700, 700))))


def train(labelled: DataFrame, buckets: int = BUCKETS, fit_rows: int = FIT_ROWS, passes: int = PASSES) -> Model:
    """A model from ``labelled (doc_id, text, label)``, label 1 (good) or 0; other rows are left out.

    Document counts of every n-gram in either class come from all rows, added up by Spark; the
    descent sees at most ``fit_rows`` of them, repeated rows once, in one task. Both are bounded
    by their parameters, and so is the model. Without rows of both labels the model is a constant."""
    hashed = F.col("hash") if "hash" in labelled.columns else F.xxhash64("text").alias("hash")
    known = labelled.where("label IN (0, 1)").select("doc_id", F.col("text").cast("string").alias("text"), F.col("label").cast("int").alias("label"), hashed)

    def counted(batches):
        counts, docs = np.zeros((2, buckets), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            for y, row in zip(label.tolist(), _each(batch.column(1), buckets), strict=True):
                counts[y, row] += 1
                docs[y] += 1
        some = np.flatnonzero(counts.any(axis=0))
        columns = (np.append(some, -1), np.append(counts[0, some], docs[0]), np.append(counts[1, some], docs[1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["bucket", "bad", "good"])

    counts = np.zeros((2, buckets + 1))
    told = known.mapInArrow(counted, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    table = told.toPandas()  # at most one row a bucket
    counts[:, table["bucket"].to_numpy()] = table[["bad", "good"]].to_numpy(dtype=float).T
    share = [(counts[y, :-1] + SMOOTH) / (counts[y, :-1] + SMOOTH).sum() for y in (0, 1)]
    scale = np.log(share[1] / share[0])

    def descended(batches):
        rows, labels = [], []
        for batch in batches:
            rows += [r.astype(np.int32) for r in _each(batch.column(1), buckets)]
            labels += batch.column(batch.schema.get_field_index("label")).to_pylist()
        weights, slope, shift = fit(rows, np.where(np.array(labels, dtype=int) > 0, 1, -1), scale, passes)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([slope]), pa.array([shift])], names=["w", "a", "b"])

    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("hash")]
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("label") == y).select("doc_id", "hash", "label").distinct().orderBy(*order).limit(fit_rows // 2)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most fit_rows keys are broadcast, so only the sample's texts are shuffled; repeated rows
    # are one, so that the bound holds whatever the ids.
    sample = known.join(F.broadcast(chosen.select("doc_id", "hash").distinct()), ["doc_id", "hash"], "left_semi")
    sample = sample.groupBy("doc_id", "hash").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    sample = sample.select("doc_id", "text", "label", "hash").orderBy(*order).coalesce(1)
    got = sample.mapInArrow(descended, "w binary, a double, b double").collect()
    weights, slope, shift = (np.frombuffer(got[0].w), got[0].a, got[0].b) if got else (np.zeros(buckets + 1), 1.0, 0.0)
    return Model(scale, weights, slope, shift)


def score(docs: DataFrame, model: Model, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``score``, the chance of a good label, from the text alone.

    Null and empty texts get the score of a text without n-grams. A column named ``score`` is
    replaced, all others stay; rows are never dropped; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))

    def scored(batches):
        for batch in batches:
            row = batch.column(0)
            texts = row.field(row.type.get_field_index("text"))
            scores = [shared.value.score(r) for r in _each(texts, buckets)]
            yield pa.RecordBatch.from_arrays([row, pa.array(scores, pa.float64())], names=["row", "score"])

    schema = StructType(list(rows.schema)).add("score", "double")
    return rows.mapInArrow(scored, schema).select(*[F.col("row").getField(c).alias(c) for c in kept], "score")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, hash, label)`` of the documents that may be learnt from, the text's hash
    made before the join so that choosing rows moves no texts. A document with several labels
    counts once if they agree and else not at all."""
    told = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
    told = told.where("label = other").select("doc_id", "label").where(~held_out(F.col("doc_id")))
    # Labels grow with the corpus: joined by shuffle at every size.
    return docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).join(told.hint("merge"), "doc_id")
