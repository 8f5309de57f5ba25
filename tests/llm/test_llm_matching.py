"""Packing by matching: the word coder against the library, the plan against packing piece by piece."""

import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stocklens.llm import matching, words
from stocklens.llm.queries import word_tokenizer

ODD = [None, "", " ", "It's 'tis WE'LL\n\n ''s", "<|endoftext|> a", "日本 €x Σας é ß\x1c\x1d", "A" * 3000, "word " * 9000, "İı ǅ 12²½  x", "<|startoftext|>"]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(word_tokenizer())
    made.encode_special_tokens = True
    return made


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def coded(coder, texts):
    return [x.tolist() for x in coder.encode([t or "" for t in texts])]


def test_word_coder_equals_library(library, monkeypatch):
    coder, rng = words.WordCoder(word_tokenizer()), random.Random(5)
    assert coded(coder, ODD) == ids_of(library, ODD)
    alphabet = "aB's tdRE\t\r\n\x0b\x1c\x1f\x85\xa0\x00.,!1²¼ªµß×éÀİŁſǅ'’́Σσς日  　᠎​"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)]
    assert coded(coder, texts) == ids_of(library, texts)
    signs = [f"aB{chr(c)}'s{chr(c)} {chr(c)} I" for c in (*range(0x700), *range(0x2000, 0x2100))]
    assert coded(coder, signs) == ids_of(library, signs)
    monkeypatch.setattr(words, "SEGMENT", 50)
    monkeypatch.setattr(words, "KEPT", 20)
    texts = ["".join(rng.choices("abc de f'Ś\n", k=900)) for _ in range(20)]
    assert coded(coder, texts) == ids_of(library, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_word_coder_on_any_text(texts):
    library = Tokenizer.from_file(word_tokenizer())
    library.encode_special_tokens = True
    assert coded(words.coder(word_tokenizer()), texts) == ids_of(library, texts)


def test_merger_equals_library_on_made_words(library):
    import json

    coder, rng = words.WordCoder(word_tokenizer()), random.Random(9)
    assert coder.piece is not None
    with open(word_tokenizer(), encoding="utf-8") as f:
        parts = [t for t in (x.removesuffix("</w>") for x in json.load(f)["model"]["vocab"]) if t.isascii() and t.isalpha()]
    made = [*parts, *("".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(60_000))]
    made += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéàßñøı.,'-0129²", k=rng.randint(1, 14))) for _ in range(30_000)]
    mine = coder.encode([" ".join(made)])[0].tolist()
    assert mine == library.encode(" ".join(made), add_special_tokens=False).ids
    plain = words.WordCoder(word_tokenizer())
    plain.piece = None  # a vocabulary of another make: the library for every chunk
    assert plain.encode([" ".join(made[-5000:])])[0].tolist() == coder.encode([" ".join(made[-5000:])])[0].tolist()


def piece_by_piece(lengths, capacity):
    """The same packing, one piece after the other: sequences as lists of lengths."""
    bins, left = [], sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    while left:
        big = left.pop(0)
        partner = next((n for n in left if n + big <= capacity), None)
        if partner:
            left.remove(partner)
        bins.append([big, partner] if partner else [big])
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fits = [b for b in bins if sum(b) + n <= capacity]
        if fits:
            max(fits, key=sum).append(n)
        else:
            bins.append([n])
    return bins


def contents(bins):
    held = collections.defaultdict(list)
    for length, steps in bins.plan.items():
        for pieces, base, per, at in steps:
            for i in range(pieces):
                held[base + i // per].append((at + i % per * length, length))
    return held


def test_plan_equals_packing_piece_by_piece():
    rng = random.Random(1)
    for capacity in (10, 24, 60):
        for _ in range(150):
            lengths = [min(capacity, int(rng.paretovariate(rng.choice((0.4, 1, 2))))) for _ in range(rng.randint(0, 70))]
            bins = matching.match(collections.Counter(lengths), capacity)
            held = contents(bins)
            assert sorted(held) == list(range(bins.used))
            for rows in held.values():
                end = 0
                for at, length in sorted(rows):
                    assert at == end
                    end += length
                assert end <= capacity
            assert sorted(n for rows in held.values() for _, n in rows) == sorted(lengths)
            mine = piece_by_piece(lengths, capacity)
            assert bins.used == len(mine)
            assert collections.Counter(sum(n for _, n in rows) for rows in held.values()) == collections.Counter(map(sum, mine))


def test_matching_has_the_most_pairs():
    """Against the best over all ways, by trying them."""
    rng = random.Random(2)

    def fewest(left):
        if not left:
            return 0
        rest = left[1:]
        return 1 + min([fewest(rest), *(fewest(rest[:i] + rest[i + 1 :]) for i, n in enumerate(rest) if n + left[0] <= 30)])

    for _ in range(60):
        lengths = [rng.randint(11, 25) for _ in range(rng.randint(1, 8))]
        assert matching.match(collections.Counter(lengths), 30).used == fewest(sorted(lengths))


def unpacked(rows, expect, capacity):
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for doc, ids in expect.items():
        at = 0
        for i, r in enumerate(sorted(pieces.pop(doc), key=lambda r: r.start)):
            assert (r.piece, r.start, r.doc_tokens, r.length) == (i, at, len(ids), min(capacity, len(ids) - at))
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length] and r.ids_crc32 == zlib.crc32(r.ids)
            at += r.length
        assert at == len(ids)
    assert not pieces
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


def test_packed_documents_are_whole_and_few(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(5, "doc_id")
    expect = {r.doc_id: ids + [0] for r, ids in zip(docs.collect(), ids_of(library, [r.text for r in docs.collect()]))}
    for capacity in (2048, 300):
        rows = matching.pack_matched(docs, word_tokenizer(), capacity=capacity).collect()
        found = unpacked(rows, expect, capacity)
        assert found == len(piece_by_piece([r.length for r in rows], capacity))
        assert found >= -(-sum(map(len, expect.values())) // capacity)


def test_packed_odd_documents(spark, library):
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(ODD)] + [(None, "no id", "y", 2, 2), (-5, "below zero", "y", 2, 2), (2**62, "far", "y", 2, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, task int, mine int").repartition(3)
    expect = {r[0]: ids + [0] for r, ids in zip(rows, ids_of(library, [r[1] for r in rows]))}
    unpacked(matching.pack_matched(docs, word_tokenizer()).collect(), expect, 2048)
    again = matching.pack_matched(docs.unionAll(docs), word_tokenizer()).collect()
    assert sum(r.doc_id == 1 for r in again) == 2  # repeated rows are packed each
    assert matching.pack_matched(docs.limit(0), word_tokenizer()).collect() == []


def test_one_length_is_spread(spark):
    docs = spark.createDataFrame([(i, "") for i in range(5000)], "doc_id long, text string").repartition(7)
    rows = matching.pack_matched(docs, word_tokenizer()).collect()
    assert collections.Counter(r.sequence_id for r in rows) == {0: 2048, 1: 2048, 2: 904}
    assert len({(r.sequence_id, r.offset) for r in rows}) == 5000
