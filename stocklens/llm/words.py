"""Ids of word-level BPE vocabularies over whole texts.

For vocabularies that drop white space and whose pre-tokens hold none: what stands between two
blanks has the same ids in every text, so each distinct such chunk is coded by the library once
and found again by its characters. The ids are those of the ``tokenizers`` library with
``encode_special_tokens`` (special strings inside a text are ordinary text).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np

from stocklens.llm.bpe import _byte_letters

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters of text that are coded at once; a longer text is cut before a blank.
SEGMENT = 1 << 19
#: Chunks and ids kept; a full table is started anew, which costs time only.
KEPT, KEPT_IDS = 500_000, 4_000_000
#: Separators of Python's ``split`` that are signs to the library.
SIGNS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: What a vocabulary's file says of its pre-tokens, and the end mark of its words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: The same for lower-case text up to U+017F without blanks, where no letters compose.
LAST = "\u017f"
_LETTER, _DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}]+")


def _merger(path: str) -> Callable[[bytes], list[int]] | None:
    """A faster coder of single pre-tokens, given with 0xFF after them, for a vocabulary with
    the pre-tokens of ``SPLIT`` whose ids are single bytes and then the order of its merges
    (tests hold it against the library); else None. No text holds the byte 0xFF: it stands for
    the end mark, and joins the byte before it first, as it does there from the start."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    if PATTERN not in json.dumps(whole["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\"):
        return None
    model, letters = whole["model"], _byte_letters()
    if model.get("end_of_word_suffix") != END:
        return None
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    first = 2 * len(letters)
    if any(model["vocab"].get(a + b) != first + i for i, (a, b) in enumerate(pairs)):
        return None
    ranks = {}
    for token, i in model["vocab"].items():
        body = token.removesuffix(END)
        if i < first + len(pairs):
            ranks[bytes(letters[c] for c in body) + b"\xff" * (body != token)] = i
    return tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class WordCoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.piece = _merger(path)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids, self.filled = np.empty(1 << 16, dtype=np.uint32), 0
        self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        held, size = [], 0
        for text in [*texts, None]:
            if held and (text is None or size + len(text) > SEGMENT):
                out += self._encoded(held)
                held, size = [], 0
            if text is not None and len(text) > SEGMENT:
                out.append(np.concatenate([x for part in segments(text) for x in self._encoded([part])]))
            elif text is not None:
                held.append(text)
                size += len(text)
        return out

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.slot) > KEPT or self.filled > KEPT_IDS:
            self._forget()
        odd = {i: self.library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if any(s in t for s in SIGNS)}
        chunks = [[] if i in odd else (t.lower() if t.isascii() else t).split() for i, t in enumerate(texts)]
        counts = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        flat = list(chain.from_iterable(chunks))
        slots = np.fromiter(map(self.slot.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        if len(new := np.flatnonzero(slots < 0)):
            self._learn(list(dict.fromkeys(flat[i] for i in new.tolist())))
            slots[new] = [self.slot[flat[i]] for i in new.tolist()]
        size = self.size[slots]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(upto[-1]) + np.repeat(self.first[slots] - upto[:-1], size)]
        edge = upto[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [np.array(odd[i], dtype=np.uint32) if i in odd else ids[a:b] for i, (a, b) in enumerate(zip(edge, edge[1:], strict=False))]

    def _learn(self, chunks: list[str]) -> None:
        """Codes new chunks: by their pre-tokens where those are plain, else by the library."""
        strange = [] if self.piece else chunks
        if self.piece:
            plain = []
            for chunk in chunks:
                (plain if chunk.isascii() or max(chunk) <= LAST else strange).append(chunk)
            found = [list(chain.from_iterable(self.piece(p.encode() + b"\xff") for p in SPLIT.findall(c.lower()))) for c in plain]
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self._keep(plain, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum())), sizes)
        if strange:
            # In one call, apart by a blank; an id's place tells its chunk.
            coded = self.library.encode(" ".join(strange), add_special_tokens=False)
            heads = np.cumsum([0, *(len(c) + 1 for c in strange)])
            places = np.fromiter((a for a, _ in coded.offsets), dtype=np.int64, count=len(coded))
            self._keep(strange, np.array(coded.ids, dtype=np.uint32), np.diff(np.searchsorted(places, heads)))

    def _keep(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        slot = len(self.slot)
        while slot + len(chunks) > len(self.first):
            self.first, self.size = np.append(self.first, np.zeros_like(self.first)), np.append(self.size, np.zeros_like(self.size))
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.first[slot : slot + len(chunks)] = self.filled + np.cumsum(sizes) - sizes
        self.size[slot : slot + len(chunks)] = sizes
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)
        self.slot.update(zip(chunks, range(slot, slot + len(chunks)), strict=True))


def segments(text: str, size: int | None = None) -> Iterator[str]:
    """The text in parts of about ``size`` characters, each cut before a blank: no pre-token and
    no composed character reaches over one."""
    at, size = 0, size or SEGMENT
    while len(text) - at > size:
        cut = text.rfind(" ", at + 1, at + size)
        if cut < 0:
            cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """One coder per Python worker, with the table that earlier tasks have filled."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]
