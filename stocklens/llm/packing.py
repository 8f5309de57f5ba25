"""Hierarchical multi-length packing of documents into token sequences."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.bpe import encoded

#: Window lengths of the tiers, longest first; all powers of two.
TIERS = (2048, 1024, 512, 256)
#: Tokens that a task gathers before it packs them; what is left over joins the next lot.
LOT = 1 << 21
#: Tokens of a step group.
STEP_TOKENS = 16 * 2048
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window int, step_group long"
)


class Piece:
    """Ids [start, start + length) of a document of ``total`` ids."""

    __slots__ = ("doc", "ids", "length", "start", "total")

    def __init__(self, doc, total: int, start: int, ids: np.ndarray) -> None:
        self.doc, self.total, self.start, self.ids, self.length = doc, total, start, ids, len(ids)

    def split(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.total, self.start, self.ids[:at]), Piece(self.doc, self.total, self.start + at, self.ids[at:])


class Shelf:
    """Pieces of at most a window, sorted by length, routed to the tier that just holds them."""

    def __init__(self, tiers: tuple[int, ...]) -> None:
        self.tiers = tiers
        self.held: dict[int, list[Piece]] = {w: [] for w in tiers}
        self.count = dict.fromkeys(tiers, 0)

    def put(self, piece: Piece) -> None:
        tier = min(w for w in self.tiers if w >= piece.length)
        bisect.insort(self.held[tier], piece, key=lambda p: p.length)
        self.count[tier] += piece.length

    def _take(self, tier: int, at: int) -> Piece:
        piece = self.held[tier].pop(at)
        self.count[tier] -= piece.length
        return piece

    def fit(self, gap: int, below: int) -> Piece | None:
        """The longest piece of at most ``gap`` tokens from the tiers up to ``below``."""
        for w in self.tiers:
            if w <= below and (row := self.held[w]) and (at := bisect.bisect_right(row, gap, key=lambda p: p.length)):
                return self._take(w, at - 1)
        return None

    def any(self, below: int) -> Piece:
        """For a gap that nothing fits: the longest piece of the shortest tier that has one, to be cut."""
        return self._take(next(w for w in reversed(self.tiers) if w <= below and self.held[w]), -1)

    def tokens(self, below: int) -> int:
        return sum(n for w, n in self.count.items() if w <= below)


def pack(shelf: Shelf) -> Iterator[tuple[int, list[Piece]]]:
    """Yield ``(window, pieces)``, every window full; what can't fill one stays on the shelf.

    Each tier, longest first, opens a window with its longest piece and fills the gap from its
    own and the shorter tiers, longest fitting piece first; the last gap, too small for any
    piece, takes the head of a short piece, whose rest goes back to its own tier."""
    for window in shelf.tiers:
        shortest = window == shelf.tiers[-1]
        while (shelf.held[window] or shortest) and shelf.tokens(window) >= window:
            pieces, room = [], window
            while room:
                piece = shelf.fit(room, window)
                if piece is None:
                    piece, rest = shelf.any(window).split(room)
                    shelf.put(rest)
                pieces.append(piece)
                room -= piece.length
            yield window, pieces


def balanced(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[tuple[int, int, list[Piece]]]:
    """``(window, group, pieces)``: each tier's sequences dealt to groups of ``step_tokens``
    tokens, back and forth in order of attention cost (the squares of their pieces' lengths),
    so that the steps of a tier cost about the same."""
    out, group = [], 0
    for window in sorted({w for w, _ in windows}, reverse=True):
        mine = sorted((p for w, p in windows if w == window), key=lambda ps: -sum(p.length**2 for p in ps))
        groups = max(1, -(-len(mine) * window // step_tokens))
        for i, pieces in enumerate(mine):
            turn, at = divmod(i, groups)
            out.append((window, group + (at if turn % 2 == 0 else groups - 1 - at), pieces))
        group += groups
    return out


def _packer(path: str, end_id: int, tiers: tuple[int, ...], lot: int, step_tokens: int):
    def run(batches):
        longest = tiers[0]
        shelf, full, held, sequence, groups = Shelf(tiers), [], 0, 0, 0
        base = TaskContext.get().partitionId() << 36

        def flush(last: bool):
            nonlocal full, held, sequence, groups
            windows = full + list(pack(shelf))
            if last:  # the sequences of a task that may need padding
                pieces, room = [], longest
                while (piece := shelf.fit(longest, longest)) is not None:
                    head, rest = piece.split(min(room, piece.length))
                    pieces.append(head)
                    room -= head.length
                    if rest.length:
                        shelf.put(rest)
                    if not room:
                        windows.append((longest, pieces))
                        pieces, room = [], longest
                if pieces:
                    windows.append((longest, pieces))
            full, held = [], shelf.tokens(longest)
            columns: list[list] = [[] for _ in range(9)]
            dealt = balanced(windows, step_tokens)
            for window, group, pieces in dealt:
                offset = 0
                for p in pieces:
                    row = (p.doc, p.start, p.length, p.ids.astype("<u4").tobytes(), p.total, base + sequence, offset, window, base + groups + group)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += p.length
                sequence += 1
            groups += 1 + max((g for _, g, _ in dealt), default=-1)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            docs = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for row, ids, offsets in encoded(batch, path):
                for i in range(len(offsets) - 1):
                    own = np.append(ids[offsets[i] : offsets[i + 1]], np.uint32(end_id))
                    total = len(own)
                    whole = total - total % longest
                    for at in range(0, whole, longest):
                        full.append((longest, [Piece(docs[row + i], total, at, own[at : at + longest])]))
                    if total > whole:
                        shelf.put(Piece(docs[row + i], total, whole, own[whole:]))
                    held += total
                    if held >= lot:
                        yield flush(False)
        yield flush(True)

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, lot: int = LOT,
    step_tokens: int = STEP_TOKENS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of token sequences, at most ``tiers[0]`` long: columns of ``SCHEMA``.

    A document is its ids and ``end_id``. Full longest windows are cut off it; its remainder is
    routed to the tier of the shortest window that holds it. Each tier is packed, long windows
    taking shorter tiers' pieces into their gaps, and a piece is cut where a gap is smaller
    than any; so every sequence fills its window, but for one a task at the most. ``ids`` are
    little-endian 32-bit ids; ``step_group`` deals a tier's sequences to steps of about
    ``step_tokens`` tokens and equal attention cost.

    Tasks pack their own part of the table in lots of ``lot`` tokens; nothing is shuffled and
    a rerun task gives the same sequences under the same numbers. Null and empty texts are the
    end id alone; null or repeated ids are kept as they are; other columns are ignored; an
    empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_packer(tokenizer, end_id, tuple(sorted(tiers, reverse=True)), lot, step_tokens), SCHEMA)
