"""Byte-level BPE over whole Arrow batches.

The ids are those of the ``tokenizers`` library with ``encode_special_tokens`` (special
strings inside a text are ordinary text). Only distinct pre-tokens are coded: texts are
split into pre-tokens by numpy over the batch's bytes, looked up by a 64-bit hash, compared
with the bytes found there, and their ids are copied out of a table. Texts with characters outside ASCII and the Latin
letters up to U+017F, or with control characters, go to the library as a whole.
"""

from __future__ import annotations

import json
import os
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER, DIGIT, OTHER, SPACE, ODD = range(5)
#: Bytes split at once; temporaries are about 60 times that.
SEGMENT = 1 << 19
#: Distinct pre-tokens kept; a full table is started anew, which costs time only.
KEPT = 500_000


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, ODD, dtype=np.uint8)
    kinds[0x21:0x7F] = OTHER
    for a, z in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0xC0), (0xC3, 0xC6)):  # also the bytes of U+00C0 to U+017F
        kinds[a:z] = LETTER
    kinds[0x30:0x3A] = DIGIT
    kinds[[0x09, 0x0A, 0x0D, 0x20]] = SPACE
    return kinds


KINDS = _byte_kinds()
#: A pre-token's first bytes are compared as so many words of eight.
HEAD = 4
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def _heads(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first ``8 HEAD`` bytes of each pre-token as words, zeros after its end."""
    words = np.ndarray(len(raw) + 8 * HEAD, dtype="<u8", buffer=raw + bytes(8 * (HEAD + 1)), strides=(1,))
    out = np.zeros((len(starts), HEAD), dtype=np.uint64)
    out[:, 0] = words[starts] & MASKS[np.minimum(sizes, 8)]
    for k in range(1, HEAD):
        some = np.flatnonzero(sizes > 8 * k)
        out[some, k] = words[starts[some] + 8 * k] & MASKS[np.minimum(sizes[some] - 8 * k, 8)]
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, a null being an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself where it is one in
    Latin-1, else the next free character from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _merger(path: str):
    """A faster coder of single pre-tokens, given as bytes, for the same vocabulary, where its ids are the order
    of its merges (tests hold both against each other); else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    first = len(_byte_letters())
    if any(model["vocab"].get(a + b) != first + i for i, (a, b) in enumerate(pairs)):
        return None
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if i < first + len(pairs)}
    return tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class BytePairEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.piece = _merger(path) or (lambda raw: self.library.encode(raw.decode(), add_special_tokens=False).ids)
        rng = np.random.default_rng(20)
        self.byte_value = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        base = int(rng.integers(2**60, 2**62)) * 2 + 1
        self.base, self.unbase = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        self.power = self.unpower = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.long: dict[int, bytes] = {}
        self.head = np.zeros((1 << 16, HEAD), dtype=np.uint64)
        self.bytes = np.zeros(1 << 16, np.int64)
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.first, self.size, self.filled = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the offsets of each text's ids."""
        kinds = KINDS[data]
        odd = kinds == ODD
        # U+00D7 and U+00F7 are no letters.
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        seen = np.concatenate([[0], np.cumsum(odd)])
        strange = np.flatnonzero(seen[offsets[1:]] > seen[offsets[:-1]])
        parts, counts, at = [], np.zeros(len(offsets) - 1, dtype=np.int64), 0
        for text in [*strange, len(offsets) - 1]:
            if text > at:
                self._plain(data, kinds, offsets[at : text + 1], parts, counts[at:text])
            if text < len(offsets) - 1:
                ids = self.library.encode(bytes(data[offsets[text] : offsets[text + 1]]).decode("utf-8", "replace"), add_special_tokens=False).ids
                parts.append(np.array(ids, dtype=np.uint32))
                counts[text] = len(ids)
            at = text + 1
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), np.concatenate([[0], np.cumsum(counts)])

    def _plain(self, data, kinds, offsets, parts, counts) -> None:
        begin, end = int(offsets[0]), int(offsets[-1])
        while begin < end:
            stop = min(end, begin + SEGMENT)
            if stop < end:
                stop = self._cut(data, kinds, offsets, begin, stop, end)
            low, high = np.searchsorted(offsets, begin, side="right") - 1, np.searchsorted(offsets, stop, side="left")
            heads = np.unique(np.clip(offsets[low:high] - begin, 0, None))
            starts, lengths, ids = self._segment(data[begin:stop], kinds[begin:stop], heads)
            upto = np.concatenate([[0], np.cumsum(lengths)])
            edge = np.searchsorted(starts, np.clip(offsets[low : high + 1] - begin, 0, stop - begin))
            counts[low:high] += np.diff(upto[edge])
            parts.append(ids)
            begin = stop

    @staticmethod
    def _cut(data, kinds, offsets, begin, stop, end) -> int:
        """A text's start, or a space between a non-space and a letter: a pre-token starts there."""
        head = int(offsets[np.searchsorted(offsets, stop, side="right") - 1])
        if head > begin:
            return head
        while True:
            window = slice(begin + 1, stop - 1)
            good = np.flatnonzero((data[window] == 0x20) & (kinds[begin : stop - 2] != SPACE) & (kinds[begin + 2 : stop] == LETTER))
            if len(good):
                return begin + 1 + int(good[-1])
            if stop >= end:
                return end
            stop = min(end, stop + SEGMENT)

    def _segment(self, data: np.ndarray, kinds: np.ndarray, heads: np.ndarray):
        n = len(data)
        start = np.empty(n, dtype=bool)
        start[0] = True
        start[1:] = kinds[1:] != kinds[:-1]
        start[heads] = True
        same = np.ones(n, dtype=bool)  # the next byte is of the same text
        same[-1] = False
        same[heads[heads > 0] - 1] = False
        # The last of several spaces stands apart when something follows; a blank joins it.
        last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & same[:-1])
        start[last] = True
        start[last[data[last] == 0x20] + 1] = False
        # Contractions: an apostrophe alone, at a start, before certain letters.
        quote = np.flatnonzero((data[:-1] == 0x27) & start[:-1] & (kinds[1:] == LETTER) & same[:-1])
        if len(quote):
            one = data[quote + 1]
            two = np.where((quote + 2 < n) & same[quote + 1], data[np.minimum(quote + 2, n - 1)], 0)
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for at, size in ((quote[short], 2), (quote[long], 3)):
                start[at + 1] = False
                if size == 3:
                    start[at + 2] = False
                after = at + size
                start[after[after < n]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)
        keys = self._keys(data, starts, ends)
        code, distinct = pd.factorize(keys)
        sample = np.empty(len(distinct), dtype=np.int64)
        sample[code[::-1]] = np.arange(len(code))[::-1]
        raw, sizes = data.tobytes(), ends - starts
        head, like = _heads(raw, starts, sizes), sample[code]
        if (sizes != sizes[like]).any() or (head != head[like]).any() or any(
            raw[starts[i] : ends[i]] != raw[starts[like[i]] : ends[like[i]]] for i in np.flatnonzero(sizes > 8 * HEAD).tolist()
        ):
            return self._apart(raw, starts, ends)
        if len(self.slot) + len(distinct) > KEPT:
            self._forget()
        slots = np.fromiter(map(self.slot.get, distinct.tolist(), repeat(-1)), dtype=np.int64, count=len(distinct))
        old = np.flatnonzero(slots >= 0)
        if not self._same(raw, slots[old], starts[sample[old]], sizes[sample[old]], head[sample[old]]):
            return self._apart(raw, starts, ends)
        if len(new := np.flatnonzero(slots < 0)):
            where = sample[new]
            slots[new] = self._learn(distinct[new], [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)], head[where])
        size = self.size[slots][code]
        total = np.cumsum(size)
        at = np.arange(total[-1]) + np.repeat(self.first[slots][code] - (total - size), size)
        return starts, size, self.ids[at]

    def _keys(self, data, starts, ends) -> np.ndarray:
        if len(self.power) < len(data):
            self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), self.base)]))
            self.unpower = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data), self.unbase)]))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.byte_value[data] * self.power[: len(data)], out=sums[1:])
        key = (sums[ends] - sums[starts]) * self.unpower[starts]
        return key ^ ((ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _same(self, raw: bytes, slots, starts, sizes, head) -> bool:
        """Whether pre-tokens have the bytes that the table holds for them."""
        if (self.bytes[slots] != sizes).any() or (self.head[slots] != head).any():
            return False
        more = np.flatnonzero(sizes > 8 * HEAD)
        return all(self.long[s] == raw[a : a + n] for s, a, n in zip(slots[more].tolist(), starts[more].tolist(), sizes[more].tolist(), strict=True))

    def _apart(self, raw: bytes, starts, ends):
        """A segment in which different pre-tokens share a hash: each by its own bytes."""
        held: dict[bytes, list[int]] = {}
        found = []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if (text := raw[a:b]) not in held:
                held[text] = self.piece(text)
            found.append(held[text])
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return starts, size, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(size.sum()))

    def _learn(self, keys: np.ndarray, texts: list[bytes], head: np.ndarray) -> np.ndarray:
        found = [self.piece(t) for t in texts]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))
        slot = len(self.slot)
        while slot + len(found) > len(self.first):
            self.first, self.size, self.bytes = (np.append(x, np.zeros_like(x)) for x in (self.first, self.size, self.bytes))
            self.head = np.concatenate([self.head, np.zeros_like(self.head)])
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        slots = np.arange(slot, slot + len(found))
        self.size[slots] = sizes
        self.first[slots] = self.filled + np.cumsum(sizes) - sizes
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)
        self.slot.update(zip(keys.tolist(), slots.tolist(), strict=True))
        self.head[slots], self.bytes[slots] = head, np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        more = np.flatnonzero(self.bytes[slots] > 8 * HEAD)
        self.long.update((slot + i, texts[i]) for i in more.tolist())
        return slots


_ENCODERS: dict[str, BytePairEncoder] = {}


def encoder(path: str) -> BytePairEncoder:
    """One encoder per Python worker, with the table that earlier tasks have filled."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BytePairEncoder(path)
    return _ENCODERS[path]


def encoded(batch: pa.RecordBatch, path: str):
    """Yield ``(first row, ids, offsets)`` for groups of the batch's texts of bounded size."""
    data, offsets = text_buffers(batch.column(batch.schema.get_field_index("text")))
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + 4 * SEGMENT, side="right")) - 1)
        low, high = int(offsets[row]), int(offsets[stop])
        yield (row, *encoder(path).encode(data[low:high], offsets[row : stop + 1] - low))
        row = stop
