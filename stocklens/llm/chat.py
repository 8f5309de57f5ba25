"""Chat formatting with loss masks aligned to tokens by their offsets."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: A conversation is rendered and encoded whole up to this many characters or TURNS turns;
#: a longer one goes on in a next part, which begins with a turn.
CHARACTERS = 1 << 20
TURNS = 1024
PARTS = "conv_id long, part long, piece int, n_turns long, formatted string, ids binary, loss binary"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    """No ``<|`` is left, so no text can hold a control string; ``unescape`` takes it back."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]], loss_role: str) -> tuple[str, np.ndarray]:
    """The formatted turns, and the sorted spans of the texts that bear loss."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        if role == loss_role and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, STOP]
        at += len(head) + len(body) + len(STOP)
    return "".join(out), np.array(spans, dtype=np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """``render`` taken back."""
    turns = []
    for turn in formatted.split(START)[1:]:
        role, _, rest = turn.partition(SEPARATOR)
        turns.append((unescape(role), unescape(rest.removesuffix(STOP))))
    return turns


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """1 for tokens inside a span. Both are sorted, so each span's first and last token are
    found by binary search."""
    mask = np.zeros(len(offsets) + 1, dtype=np.int8)
    first = np.searchsorted(offsets[:, 0], spans[:, 0], side="left")
    last = np.searchsorted(offsets[:, 1], spans[:, 1], side="right")
    np.add.at(mask, first, 1)
    np.add.at(mask, last, -1)
    return mask.cumsum()[:-1].astype(np.uint8)


_CODERS: dict = {}


def coder(path: str):
    """The tokenizer with the template's control strings, whose offsets cover every character."""
    if path not in _CODERS:
        from tokenizers import Tokenizer, processors

        made = Tokenizer.from_file(path)
        made.add_special_tokens([START, SEPARATOR, STOP])
        made.post_processor = processors.ByteLevel(trim_offsets=False)
        _CODERS[path] = made
    return _CODERS[path]


def _formatter(path: str, loss_role: str, characters: int):
    def run(batches: Iterator[pa.RecordBatch]):
        key, turns, size, piece = None, [], 0, 0

        def flush():
            formatted, spans = render(turns, loss_role)
            code = coder(path).encode(formatted, add_special_tokens=False)
            offsets = np.array(code.offsets, dtype=np.int64).reshape(-1, 2)
            row = (key[0], key[1], piece, len(turns), formatted, np.array(code.ids, dtype="<u4").tobytes(), loss_mask(offsets, spans).tobytes())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary())
            names = [x.split()[0] for x in PARTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for conv, part, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key is not None and ((conv, part) != key or size > characters):
                    yield flush()
                    piece, turns, size = (piece + 1 if (conv, part) == key else 0), [], 0
                key = (conv, part)
                turns.append((role, text))
                size += len(role) + len(text)
        if key is not None:
            yield flush()

    return run


def format_chats(turns: DataFrame, tokenizer: str, loss_role: str = "assistant", span: int = TURNS, characters: int = CHARACTERS) -> DataFrame:
    """Formatted conversations of ``turns (conv_id, turn, role, text)``: columns of ``PARTS``.

    Turns are ordered by ``turn`` (null first), ties by role and text. A conversation is
    rendered with marked turns, encoded once with offsets, and ``loss`` (a byte per token of
    ``ids``, little-endian 32-bit) is 1 on the tokens of ``loss_role`` texts; markers are
    tokens of their own, so no token crosses a text's edge. Control strings in roles and texts
    are escaped, and ``parse`` gives back what went in. A conversation of over ``span`` turn
    numbers or ``characters`` goes on in further parts, so none has to fit a task; their
    formatted texts on end, by part and piece, are the conversation.

    Null roles and texts are empty; rows with a null conv_id are one conversation; repeated
    rows are turns of their own; other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.floor(F.col("turn") / span), F.lit(-1)).cast("long").alias("part"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn",
    )
    sorted_ = rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "turn", "role", "text")
    return sorted_.select("conv_id", "part", "role", "text").mapInArrow(_formatter(tokenizer, loss_role, characters), PARTS)


def _digester(path: str):
    def run(batches):
        key, state = None, None

        def row():
            n, turns, chars, loss, formatted = state
            columns = (key[0], n, turns.hexdigest(), chars, loss.hexdigest(), formatted)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [x.split()[0] for x in DIGEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for conv, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if key is None or key[0] != conv:
                    if key is not None:
                        yield row()
                    key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(ids.as_buffer(), dtype="<u4")
                mask = np.concatenate([[0], np.frombuffer(loss.as_buffer(), dtype=np.uint8), [0]])
                formatted = coder(path).decode(ids.tolist(), skip_special_tokens=False)
                state[4] += len(formatted)
                for role, text in parse(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                edge = np.flatnonzero(np.diff(mask.astype(np.int8)))
                for a, b in edge.reshape(-1, 2).tolist():
                    text = unescape(coder(path).decode(ids[a:b].tolist(), skip_special_tokens=False))
                    state[2] += len(text)
                    state[3].update(text.encode())
        if key is not None:
            yield row()

    return run


def digests(parts: DataFrame, tokenizer: str) -> DataFrame:
    """What ``format_chats`` wrote, read back from its ids and mask alone: columns of ``DIGEST``.

    A digest runs over a conversation from its first to its last turn, so its parts meet in one
    task; they pass through it one by one and only the state of the hash is held."""
    rows = parts.select("conv_id", "part", "piece", "ids", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return rows.select("conv_id", "ids", "loss").mapInArrow(_digester(tokenizer), DIGEST)
