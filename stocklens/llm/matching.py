"""Best-fit packing: large pieces matched in pairs, smaller ones best-fit into what is left."""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import written
from stocklens.llm.words import coder

#: Tokens of a sequence.
CAPACITY = 2048
#: Characters of texts that a task codes at once.
TEXT_AT_ONCE = 1 << 21
_PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, doc_tokens long, task int, place long"
_RUNS = "task int, length long, runs array<struct<first:long,base:long,per:long,at:long>>"


class Bins:
    """Groups of sequences that hold the same lengths: how many, and what each holds.

    ``plan[length]`` lists ``(pieces, group, per, at)``: the next ``pieces`` pieces of that length
    go to ``group``, ``per`` to a sequence, the first at place ``at``."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.used = capacity, 0
        self.plan: dict[int, list[tuple[int, int, int, int]]] = {}
        self.gaps: list[int] = []  # sorted
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, sequences)

    def new(self, sequences: int) -> int:
        self.used += sequences
        return self.used - sequences

    def put(self, length: int, base: int, sequences: int, per: int, at: int) -> int:
        self.plan.setdefault(length, []).append((sequences * per, base, per, at))
        return at + per * length

    def leave(self, base: int, sequences: int, filled: int) -> None:
        gap = self.capacity - filled
        if gap and sequences:
            if gap not in self.open:
                bisect.insort(self.gaps, gap)
            self.open.setdefault(gap, []).append((base, sequences))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """The group with the smallest gap that holds ``length``: ``(gap, base, sequences)``."""
        i = bisect.bisect_left(self.gaps, length)
        if i == len(self.gaps):
            return None
        gap = self.gaps[i]
        base, sequences = self.open[gap].pop()
        if not self.open[gap]:
            del self.open[gap], self.gaps[i]
        return gap, base, sequences


def match(counts: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """Places for ``counts[length]`` pieces of each length, as few sequences as it can.

    Pieces above a third of the capacity go at most two to a sequence, so they are matched:
    from the longest on, each takes the longest other that fits; as what fits a longer one fits
    a shorter one too, no matching has more pairs. Smaller pieces follow, longest first, each
    into the fullest sequence that holds it, or a new one where none does. All pieces of a
    length are placed in a few steps, so the work depends on the capacity and not on the pieces.
    """
    bins = Bins(capacity)
    left = {n: c for n, c in counts.items() if 3 * n > capacity and c}
    lengths = sorted(left)
    for big in reversed(lengths):
        fit = bisect.bisect_right(lengths, min(big, capacity - big)) - 1
        while left[big] and fit >= 0:
            small = lengths[fit]
            pairs = left[big] // 2 if small == big else min(left[big], left[small])
            if pairs:
                base = bins.new(pairs)
                at = bins.put(big, base, pairs, 2 if small == big else 1, 0)
                if small != big:
                    at = bins.put(small, base, pairs, 1, at)
                    left[small] -= pairs
                left[big] -= 2 * pairs if small == big else pairs
                bins.leave(base, pairs, at)
            fit -= 1
        if left[big]:
            base = bins.new(left[big])
            bins.leave(base, left[big], bins.put(big, base, left[big], 1, 0))
            left[big] = 0
    for length in sorted((n for n, c in counts.items() if 3 * n <= capacity and c), reverse=True):
        rest = counts[length]
        while rest:
            if (found := bins.take(length)) is None:
                per = capacity // length
                found = (capacity, bins.new(-(-rest // per)), -(-rest // per))
            gap, base, sequences = found
            filled, per = capacity - gap, gap // length
            whole = min(sequences, rest // per)
            if whole:
                bins.leave(base, whole, bins.put(length, base, whole, per, filled))
                rest -= whole * per
            if rest and whole < sequences:  # the last ones, fewer than fill a sequence's gap
                bins.leave(base + whole, 1, bins.put(length, base + whole, 1, rest, filled))
                rest, whole = 0, whole + 1
            bins.leave(base + whole, sequences - whole, filled)
    return bins


def _cut(path: str, end_id: int, capacity: int):
    """Codes texts and cuts those above the capacity; each piece knows its place among the
    pieces of its length in the task."""

    def run(batches):
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            low = 0
            while low < len(docs):
                high, size = low, 0
                while high < len(docs) and (high == low or size + len(texts[high] or "") <= TEXT_AT_ONCE):
                    size += len(texts[high] or "")
                    high += 1
                rows = []
                for doc, ids in zip(docs[low:high], coder(path).encode([t or "" for t in texts[low:high]]), strict=True):
                    own = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        raw = part.tobytes()
                        rows.append((doc, piece, start, len(part), raw, zlib.crc32(raw), len(own), task, int(seen[len(part)])))
                        seen[len(part)] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _PIECES.split(", ")])
                low = high

    return run


def _runs(plan: dict[int, np.ndarray]):
    """For a task's pieces of a length the groups that they go to, ``first`` the place among
    them at which a group's turn comes."""

    def run(batches):
        for batch in batches:
            out = []
            for length, first, n in zip(*(batch.column(c).to_pylist() for c in ("length", "first", "n")), strict=True):
                heads, base, per, at = plan[length]
                low, high = np.searchsorted(heads, first, side="right") - 1, np.searchsorted(heads, first + n)
                out.append([{"first": int(heads[i]) - first, "base": int(base[i]), "per": int(per[i]), "at": int(at[i])} for i in range(low, high)])
            kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("first", "base", "per", "at")]))
            yield pa.RecordBatch.from_arrays([batch.column("task"), batch.column("length"), pa.array(out, kind)], names=["task", "length", "runs"])

    return run


def _laid(bins: Bins) -> dict[int, np.ndarray]:
    """Per length the heads of its groups among its pieces, and the groups."""
    out = {}
    for length, steps in bins.plan.items():
        pieces, base, per, at = np.array(steps, dtype=np.int64).T
        out[length] = np.array([np.cumsum(pieces) - pieces, base, per, at])
    return out


def pack_matched(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of sequences of at most ``capacity`` tokens, as few sequences as best fit finds.

    A document is its ids and ``end_id``; only one above the capacity is cut, into pieces of
    the capacity and a last one. Columns: ``doc_id, piece`` (from 0), ``start`` (its document's
    ids before it), ``length, ids`` (little-endian 32-bit), ``ids_crc32, doc_tokens,
    sequence_id, offset`` (its place there, without gaps from 0).

    Texts are coded once and the pieces written. The packing needs only how many pieces of each
    length there are (one row a length comes to the driver, at most ``capacity``): see
    ``match``. It says for every length which pieces, counted over the whole corpus, go to which
    sequences. A piece's number is its place in its task and the pieces of its length in
    earlier tasks; no order and no group is gathered, and a length that a third of all pieces
    share is spread like any other. The result is that of packing all of them at once.

    Null and empty texts are the end id alone; null or repeated ids are kept as they are, each
    row a document; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = written(rows.mapInArrow(_cut(tokenizer, end_id, capacity), _PIECES), "pieces")
    counts = written(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    plan = pieces.sparkSession.sparkContext.broadcast(_laid(match(total, capacity)))  # a few rows a length
    runs = first.mapInArrow(lambda it: _runs(plan.value)(it), _RUNS)
    mine = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("place")), -1)
    turn = F.col("place") - F.col("mine.first")
    return (
        pieces.join(runs.hint("merge"), ["task", "length"]).withColumn("mine", mine)  # grows with the tasks: by shuffle at every size
        .withColumn("sequence_id", F.col("mine.base") + F.floor(turn / F.col("mine.per")))
        .withColumn("offset", F.col("mine.at") + turn % F.col("mine.per") * F.col("length"))
        .select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )
