"""The corpus pipeline: stages on odd documents, their decisions, and the whole run."""

import pathlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stocklens.llm.common import table, written

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def odd(spark):
    docs = table(spark, SF, "documents")
    clashes = {n: F.lit(i) for i, n in enumerate(("score", "n_lines", "mix_epoch", "row", "rest", "component_id", "key"))}
    more = spark.createDataFrame([(None, None, None, None, None), (10**6, "", None, "s", 0), (10**6 + 1, None, "en", "s", 0), (10**6 + 2, "w x y " * 30000, "en", None, 1)], docs.schema)
    return docs.unionByName(more).unionByName(docs.where("doc_id = 3")).withColumns(clashes)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stage_keeps_columns_and_takes_odd_documents(spark, odd, name, stage):
    out = written(stage(spark, odd, SF), "test-stage")
    assert out.columns == odd.columns and out.count() > 0
    assert written(stage(spark, odd.limit(0), SF), "test-none").count() == 0


def test_decisions(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    deduped = written(corpus_pipeline.drop_repeated_lines(spark, docs, SF), "test-lines").collect()
    assert all(set(r.text.split("\n")) <= set(rows[r.doc_id].text.split("\n")) for r in deduped)
    near = written(corpus_pipeline.keep_one_of_near_copies(spark, docs.unionByName(docs.where("doc_id < 9")), SF), "test-near").collect()
    from stocklens.llm.simhash import near_duplicates

    assert sorted(r.doc_id for r in near) == sorted({r.component_id for r in near_duplicates(docs).collect()})
    mixed = written(corpus_pipeline.mix_sources(spark, docs, SF), "test-mix").collect()
    assert {r.doc_id for r in mixed} == set(rows) and all(r == rows[r.doc_id] for r in mixed)


def test_clashing_ids_lose_no_other_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (None, c, "s"), (None, c, "s"), (None, a, "s"), (7, "", "s"), (8, None, "s"), (9, b, "t"), (9, b, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(3, a, "s"), (5, b, "s"), (None, c, "s"), (7, "", "s")], key=str)


def test_rows_are_packed_in_the_order_of_the_mixture(spark):
    docs = table(spark, SF, "documents")
    from stocklens.llm import mixing

    mixed = mixing.mix(docs, max_repetition=corpus_pipeline.MAX_REPETITION)
    order = [r.doc_id for r in mixed.orderBy("mix_epoch", "mix_block", "mix_doc").collect()]
    back = written(corpus_pipeline.mix_sources(spark, docs, SF), "test-order")
    assert [r.doc_id for r in corpus_pipeline.in_file_order(back).collect()] == order
    plain = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert corpus_pipeline.in_file_order(plain).collect() == plain.collect()


def near_groups(rows):
    """Rows in groups of fingerprints that are linked by at most three bits, pair by pair."""
    from stocklens.llm.simhash import fingerprint

    prints = [fingerprint((r.text or "").encode()) for r in rows]
    groups = list(range(len(rows)))

    def root(i):
        while groups[i] != i:
            i = groups[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                groups[root(i)] = root(j)
    out = {}
    for i, r in enumerate(rows):
        out.setdefault(root(i), []).append(r)
    return list(out.values())


def later_copies(rows, least=50):
    """Line dedup by its rule, over all runs of lines of at least ``least`` words: of equal runs
    all but the first, by id and place, go."""
    words = lambda x: len([w for w in re.split(r"[ \t-\r]+", x) if w])
    first, gone = {}, {}
    texts = {r.doc_id: r.text.split("\n") for r in rows if r.text is not None}
    runs = []
    for doc, lines in texts.items():
        for i in range(len(lines)):
            total = 0
            for j in range(i, len(lines)):
                total += words(lines[j])
                if total >= least:
                    runs.append((doc, i, j, "\n".join(lines[i : j + 1]) + f"/{j - i}"))
                    break
        for j in range(len(lines)):
            total = 0
            for i in range(j, -1, -1):
                total += words(lines[i])
                if total >= least:
                    runs.append((doc, i, j, "\n".join(lines[i : j + 1]) + f"/{j - i}"))
                    break
    for doc, i, j, text in sorted(set(runs)):
        if text in first and first[text] != (doc, i):
            gone.setdefault(doc, set()).update(range(i, j + 1))
        else:
            first[text] = (doc, i)
    out = {}
    for doc, lines in texts.items():
        kept = [x for i, x in enumerate(lines) if i not in gone.get(doc, ())]
        if kept or not lines:
            out[doc] = "\n".join(kept)
    return out


def test_run_equals_stage_by_stage_brute_force(spark):
    """The rows of ``run`` against plain Python: which documents stay, with which text, how often."""
    from stocklens.llm import quality

    docs = table(spark, SF, "documents")
    model = quality.train(quality.labelled(docs, table(spark, SF, "labels")))
    seen = np.empty(quality.BUCKETS, dtype=np.int64)
    rows = {r.doc_id: r for r in docs.collect()}
    good = [r for r in rows.values() if model.score(quality.ngrams(np.frombuffer((r.text or "").encode(), np.uint8), quality.BUCKETS, seen)) >= 0.5]
    assert 0 < len(good) < len(rows)
    texts = later_copies(good)
    Row = type(good[0])
    left = [Row(**{**r.asDict(), "text": texts[r.doc_id]}) for r in good if r.doc_id in texts]
    kept = {min(g, key=lambda r: r.doc_id).doc_id for g in near_groups(left)}
    assert len(kept) < len(left) < len(good)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(corpus_pipeline.tokenizer())
    library.encode_special_tokens = True
    expect = {d: library.encode(texts[d], add_special_tokens=False).ids + [1] for d in kept}
    copies = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == expect[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(expect[r.doc_id])
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.length
    assert copies.keys() == kept
    times = {d: n / len(expect[d]) for d, n in copies.items()}
    # Whole copies; no source more than twice as often as the largest, whose documents are taken once.
    assert all(t == int(t) and 1 <= t <= 3 for t in times.values())
    sizes = {}
    for d in kept:
        sizes[rows[d].source] = sizes.get(rows[d].source, 0) + len(expect[d])
    assert all(times[d] == 1 for d in kept if rows[d].source == max(sizes, key=sizes.get))


def test_run_packs_whole_documents(spark):
    packed = corpus_pipeline.run(spark, SF).collect()
    sizes = {}
    for r in packed:
        sizes.setdefault((r.sequence_id, r.window), []).append((r.offset, r.length))
        assert len(np.frombuffer(r.ids, "<u4")) == r.length
    for (_, window), parts in sizes.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert all(total[r.doc_id] % r.doc_tokens == 0 for r in packed)  # whole copies


def test_guards():
    """No local checkpoints, cross joins, swallowed imports or code of others that imports this."""
    for p in [*(ROOT / "stocklens" / "llm").glob("*.py"), ROOT / "corpus_pipeline.py"]:
        text = p.read_text(encoding="utf-8")
        assert not re.search(r"localCheckpoint|crossJoin|except ImportError|tempfile|\.rdd\b", text), p
    for p in (ROOT / "stocklens").rglob("*.py"):
        if p.parent.name != "llm":
            assert "stocklens.llm" not in p.read_text(encoding="utf-8"), p
    mixing = (ROOT / "stocklens" / "llm" / "mixing.py").read_text(encoding="utf-8")
    assert not re.search(r"mapIn|applyIn|udf|toPandas|pyarrow|numpy", mixing)
