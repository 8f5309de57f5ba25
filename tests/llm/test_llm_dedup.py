"""Line dedup, SimHash near-dedup and connected components against brute force."""

import random

import pytest
import xxhash

from stocklens.llm import line_dedup, simhash
from stocklens.llm.common import connected_components


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(1000, 1200)] + [(5, 2000 + i) for i in range(300)] + [(rng.randrange(3000, 3400), rng.randrange(3000, 3400)) for _ in range(300)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert got == components({x for e in linked for x in e}, linked)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(rng):
    base = [" ".join(rng.choices(["Alpha", "beta", "gamma", "Été", "delta", "x y", "eps"], k=rng.randint(1, 200))) for _ in range(40)]
    out = list(base)
    for t in base:
        words = t.split(" ")
        for _ in range(6):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(["one", "two", "beta"])
            out.append(" ".join(words))
    return out + ["", None, " \n\t", "a", "A", "a b", "a  b c", base[0], base[0] + "\n", "w " * 30000]


def test_simhash_equals_brute_force(spark):
    rng = random.Random(8)
    texts = near_texts(rng)
    rows = [(i * 3, t, "fp", 1) for i, t in enumerate(texts)] + [(0, texts[0], "again", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, node int").repartition(4)
    got = simhash.near_duplicates(df, tree=8).collect()
    assert len(got) == len(rows)
    prints = {i: fingerprint(t) for i, t, *_ in rows}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints and all(len(r.fingerprint) == 16 for r in got)
    ids = sorted(prints)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {r.doc_id: r.component_id for r in got} == components(ids, edges)


def test_simhash_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b c d", 1), (4, "a b c d", 1), (None, "lonely text of no id", 1)], "doc_id long, text string, x int")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(df).collect()) == [(0, 0), (0, 4), (4, 4)]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_links_within_a_hot_shard(spark):
    """Codes that all share three of four blocks: one shard, cut into many trees."""
    rng = random.Random(1)
    codes = sorted({rng.randrange(1 << 16) for _ in range(600)})
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "node long, fp long")
    links = simhash.links(frame, tree=50).collect()
    assert all((codes[r.a] ^ codes[r.b]).bit_count() <= 3 for r in links)
    edges = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 3]
    nodes = range(len(codes))
    assert components(nodes, [(r.a, r.b) for r in links]) == components(nodes, edges)
    assert len(links) < 20 * len(codes)


def deduped(rows, least):
    """By definition: delete every run of at least ``least`` words that began earlier."""
    docs = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(n, i) for n, (_, t) in enumerate(docs) if t is not None for i in range(len(t.split("\n")))]
    split = [[] if t is None else t.split("\n") for _, t in docs]
    gone = set()
    for at, (n, i) in enumerate(lines):
        best = 0
        for m, j in lines[:at]:
            k = 0
            while i + k < len(split[n]) and j + k < len(split[m]) and split[n][i + k] == split[m][j + k]:
                k += 1
            best = max(best, k)
        if sum(len(x.split()) for x in split[n][i : i + best]) >= least:
            gone |= {(n, i + k) for k in range(best)}
    return {
        d: (None if t is None else "\n".join(x for i, x in enumerate(split[n]) if (n, i) not in gone), len(split[n]), sum((n, i) in gone for i in range(len(split[n]))))
        for n, (d, t) in enumerate(docs)
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["", "a", "a b", "c d e", "f", "g h i j", "  "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 9)))) for i in range(25)]
    passage = "\n".join(rng.choices(pool, k=6) + ["one line of quite a few words"])
    rows += [(100 + i, "\n".join([f"own {i}", passage, rng.choice(pool)])) for i in range(8)]
    rows += [(200, None), (201, ""), (202, rows[0][1]), (None, rows[1][1]), (203, "\n".join(["k l"] * 40)), (204, "z " * 5000), (205, "z " * 5000)]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n_lines int, u int, runs int").repartition(4)
    out = line_dedup.dedup_lines(df, min_words=6)
    assert out.columns == ["doc_id", "text", "u", "runs", "n_lines", "n_deleted", "deleted_runs"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in out.collect()}
    assert got == deduped(rows, 6)


def test_line_dedup_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c\nd e f"), (1, "a b c\nd e f"), (2, "a b c\nd e f")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(df, 4).collect()) == [(1, "a b c\nd e f"), (1, "a b c\nd e f"), (2, "")]
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


def test_line_dedup_takes_repeated_rows_once(spark, monkeypatch):
    """Three rows of one long document, with and without an id, have its lines once in every doubling."""
    text, ranks = "\n".join(f"line {i}" for i in range(64)), line_dedup.suffix_ranks

    def counted(lines, *more):
        assert lines.count() == 3 * 64
        levels = ranks(lines, *more)
        assert len(levels) > 4 and all(level.count() <= 3 * 64 for level in levels)
        return levels

    monkeypatch.setattr(line_dedup, "suffix_ranks", counted)
    rows = [(None, text)] * 3 + [(1, text)] * 3 + [(2, text + " more")] + [(None, None)] * 2
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.n_lines, r.n_deleted) for r in got) == sorted(
        [(0, text, 64, 0)] * 3 + [(1, "", 64, 64)] * 3 + [(2, "line 63 more", 64, 63)] + [(0, "", 0, 0)] * 2
    )


def test_suffix_ranks_order_suffixes(spark):
    """Sorted as deep as asked, ranks equal the order of the suffixes by their lines' ids."""
    rng = random.Random(6)
    docs = [[rng.choice((1, 2, 3)) for _ in range(rng.randint(1, 12))] for _ in range(30)]
    rows = [(d, 0, i, len(ls), v, 0, 16) for d, ls in enumerate(docs) for i, v in enumerate(ls)]
    lines = spark.createDataFrame(rows, "doc long, u long, i int, n int, l1 long, l2 long, need int").repartition(3)
    ranks = {}
    for level in line_dedup.suffix_ranks(lines, "test-suffixes"):
        ranks |= {(r.doc, r.i): r["rank"] for r in level.collect()}
    order = sorted((tuple(docs[d][i:]), d, i) for d in range(len(docs)) for i in range(len(docs[d])))
    first = {}
    for at, (suffix, _, _) in enumerate(order):
        first.setdefault(suffix, at + 1)
    assert ranks == {(d, i): first[s] for s, d, i in order}
