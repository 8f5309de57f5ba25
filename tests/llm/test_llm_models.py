"""Quality classifier, language-model scoring and mixing."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle.compare import compare, duck
from stocklens.llm import lm, mixing, quality
from stocklens.llm.queries import ORACLE, QUERIES, tokenizer

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    rows = QUERIES["op8_quality_nbsvm"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r.score for r in rows if r.held_out and known.get(r.doc_id) == 1]
    bad = [r.score for r in rows if r.held_out and known.get(r.doc_id) == 0]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97 and np.mean([s >= 0.5 for s in good]) > 0.97


def test_quality_never_learns_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 1), (2, None), (4, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.label for r in quality.labelled(docs, labels).collect()}
    expect = {i: i % 2 for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}
    expect.pop(0, None)  # labelled both ways
    assert got == expect


def test_quality_odd_rows_and_constant_models(spark):
    docs = spark.createDataFrame([(1, None, 3, "r"), (2, "", 3, "r"), (None, "w " * 60000, 3, "r"), (4, "x", 3, "r"), (4, "x", 3, "r")],
                                 "doc_id long, text string, score int, row string")
    nothing = spark.createDataFrame([], "doc_id long, text string, label int")
    out = quality.score(docs, quality.train(nothing))
    assert out.columns == ["doc_id", "text", "row", "score"]
    assert [r.score for r in out.collect()] == [0.5] * 5
    ones = spark.createDataFrame([(i, f"good text {i}", 1) for i in range(5)], "doc_id long, text string, label int")
    assert all(r.score > 0.9 for r in quality.score(docs, quality.train(ones)).collect())
    assert quality.score(docs.limit(0), quality.train(ones)).collect() == []


def test_ngrams_read_whole_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    text = rng.choice(np.frombuffer(b"ab cd! E", np.uint8), 5000)
    seen = np.empty(quality.BUCKETS, dtype=np.int64)
    whole = set(quality.ngrams(text, quality.BUCKETS, seen).tolist())
    bytes_only = {int(quality._mixed(np.array([int(text[i]) | int(text[i + 1]) << 8 | int(text[i + 2]) << 16], dtype=np.uint64), 1 << 60, quality.BUCKETS)[0]) for i in range(4998)}
    assert bytes_only <= whole
    monkeypatch.setattr(quality, "CHUNK", 700)
    assert bytes_only <= set(quality.ngrams(text, quality.BUCKETS, seen).tolist())


def test_all_ngrams_of_a_long_text_whatever_the_piece(monkeypatch):
    rng = np.random.default_rng(11)
    words = ["a", "Bee", "cEd,", "dd", "EEE.", "f" * 90, "z9!", "na\u00efve", "again", "again"]
    text = "".join(str(rng.choice(words)) + str(rng.choice([" ", "\n", "  ", "\t"])) for _ in range(1500))
    seen = np.empty(quality.BUCKETS, dtype=np.int64)
    for t in (text, text.strip(), " " + text, "x" * 700, "", " "):
        data, whole = np.frombuffer(t.encode(), np.uint8), None
        for piece in (1 << 20, 1000, 64, 7, 1):
            monkeypatch.setattr(quality, "CHUNK", piece)
            got = sorted(quality.ngrams(data, quality.BUCKETS, seen).tolist())
            whole = got if whole is None else whole
            assert got == whole


def test_the_fit_is_bounded_whatever_the_ids(spark, monkeypatch):
    rows = [(i % 3, f"text {i % 50} of some words {i % 7}", i % 2) for i in range(900)] + [(5, "the same row", 1)] * 300
    known = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4)
    sizes = []
    monkeypatch.setattr(type(known), "mapInArrow", _counted(type(known).mapInArrow, sizes))
    quality.train(known, fit_rows=10)
    assert max(sizes) <= 10


def _counted(real, sizes):
    """Rows that reach a task of the fit."""

    def run(self, f, schema, *a, **k):
        if "w binary" in str(schema):
            sizes.append(self.count())
        return real(self, f, schema, *a, **k)

    return run


def test_dual_descent_meets_the_hinge_optimum():
    """Against plain subgradient steps on the same objective."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(200)]
    truth = rng.standard_normal(30)
    labels = np.where([truth[r].sum() + rng.standard_normal() > 0 for r in rows], 1, -1)
    scale, cost = rng.uniform(0.5, 1.5, 30), np.full(200, 1.0)
    dense = np.zeros((200, 31))
    for i, r in enumerate(rows):
        dense[i, r], dense[i, 30] = scale[r], 1.0
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - labels * (dense @ w)).sum()

    found, w = quality.descend(rows, labels, scale, cost, 300), np.zeros(31)
    for t in range(1, 6000):
        out = labels * (dense @ w) < 1
        w -= (w - (labels[out, None] * dense[out]).sum(axis=0)) / (t + 10)
    assert loss(found) <= loss(w) * 1.001


@pytest.fixture(scope="module")
def tokens(spark):
    return lm.token_table(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer())


def test_training_helps_and_order_matters(spark, tokens):
    untrained = lm.score_tokens(tokens, lm.train(tokens, 50257, rounds=0)).agg(F.sum("log_likelihood")).first()[0]
    net = lm.train(tokens, 50257)
    scored = lm.score_tokens(tokens, net).toPandas()
    assert len(scored) == tokens.count() and scored["log_likelihood"].sum() > untrained * 0.9
    rng, plain = np.random.default_rng(0), tokens.toPandas()
    plain["ids"] = [rng.permutation(np.frombuffer(b, "<u4")).astype("<u4").tobytes() for b in plain["ids"]]
    mixed = lm.score_tokens(spark.createDataFrame(plain, "doc_id long, ids binary"), net).toPandas()
    both = scored.merge(mixed, on="doc_id")
    both = both[both["n_tokens_x"] > 30]
    assert (both["log_likelihood_x"] > both["log_likelihood_y"]).mean() > 0.95


def test_conditionals_are_probabilities_and_sum_over_tokens(spark, tokens):
    net = lm.train(tokens, 50257, rounds=1)
    around = np.array([[5], [50257], [17], [900]])
    every = np.arange(50257)
    assert math.isclose(np.exp(net.conditional(every, np.repeat(around, 50257, axis=1))).sum(), 1.0, rel_tol=1e-3)
    ids = np.array([3, 9, 9, 4, 7])
    frame = spark.createDataFrame([(1, ids.astype("<u4").tobytes()), (2, b""), (None, ids[:1].astype("<u4").tobytes())], "doc_id long, ids binary")
    got = {r.doc_id: r for r in lm.score_tokens(frame, net).collect()}
    padded = [50257, 50257, *ids, 50257, 50257]
    one = sum(net.conditional(ids[i : i + 1], np.array([[padded[i]], [padded[i + 1]], [padded[i + 3]], [padded[i + 4]]]))[0] for i in range(5))
    assert math.isclose(got[1].log_likelihood, one, rel_tol=1e-5)
    assert (got[2].n_tokens, got[2].log_likelihood, got[2].mean_log_likelihood) == (0, 0.0, None) and got[None].n_tokens == 1


def test_untrained_tree_has_the_counts_shares():
    rng = np.random.default_rng(2)
    for vocabulary, branch in ((1, 4), (3, 4), (4, 4), (50, 2), (50, 7), (400, 32)):
        counts = np.floor(rng.pareto(1, vocabulary) * 20)
        net = lm.Network(counts, branch=branch)
        net.out[0, :, :-1] = 0
        every = np.arange(vocabulary)
        told = net.conditional(every, np.zeros((4, vocabulary), dtype=int))
        assert np.allclose(told, np.log((counts + 0.5) / (counts + 0.5).sum()), atol=1e-3)
        steps = 1 + (net.second >= 0) + net.deep
        order = np.argsort(counts, kind="stable")
        assert (np.diff(steps[order]) <= 0).all()  # no more choices for a token that is more frequent
        assert steps @ (counts + 0.5) / (counts + 0.5).sum() <= -told @ (counts + 0.5) / (counts + 0.5).sum() / np.log(branch) + 1 + 1e-6


def small_network(branch):
    rng = np.random.default_rng(5)
    counts = np.floor(rng.pareto(0.8, 60) * 9)
    net = lm.Network(counts, width=4, branch=branch, window=2, seed=3)
    net.out[:, :, :-1] += rng.standard_normal(net.out[:, :, :-1].shape) * 0.3
    net.place += rng.standard_normal(net.place.shape).astype(np.float32) * 0.2
    net.shift += rng.standard_normal(net.shift.shape).astype(np.float32) * 0.2
    return net, rng


@pytest.mark.parametrize("branch", [2, 5, 16])
def test_steps_follow_the_gradient_by_differences(branch):
    """Every slope of a step against differences of the loss, entry by entry."""
    net, rng = small_network(branch)
    text = rng.integers(0, 60, 70)
    stretch, at = np.concatenate([[60, 60], text, [60, 60]]).astype(np.int32), np.flatnonzero(rng.random(70) < 0.8)
    padded = stretch

    def loss():
        around = np.stack([padded[at + 2 + g] for g in (-2, -1, 1, 2)])
        return -net.conditional(padded[at + 2], around).sum()

    def slope(part, index, eps=2e-2):
        old = part[index]
        part[index] = old + eps
        up = loss()
        part[index] = old - eps
        down = loss()
        part[index] = old
        return (up - down) / (2 * eps)

    every = {n: np.array([slope(getattr(net, n), i) for i in np.ndindex(getattr(net, n).shape)]).reshape(getattr(net, n).shape) for n in ("token", "shift", "place")}
    nodes = {k: np.array([slope(net.out, (k, *i)) for i in np.ndindex(net.out.shape[1:])]).reshape(net.out.shape[1:]) for k in range(len(net.out))}
    learner = lm.Learner(net, 0.1)
    before = {n: getattr(net, n).copy() for n in ("token", "shift", "place", "out")}
    learner.step(stretch, at)
    uses = np.zeros(61)
    for g in (-2, -1, 1, 2):
        np.add.at(uses, padded[at + 2 + g], 1)
    assert learner.moved[:61].tolist() == uses.tolist() and learner.moved[61] == len(at)

    def moved(name, expect, square):
        assert np.allclose(before[name] - getattr(net, name), 0.1 * expect / np.sqrt(1e-2 + square), atol=2e-3), name

    for name in ("shift", "place"):
        moved(name, every[name] / len(at), (every[name] / len(at)) ** 2)
    mean = every["token"] / np.maximum(uses, 1)[:, None]
    moved("token", mean, (mean**2).mean(axis=1, keepdims=True))
    choices = learner.moved[61:]
    mean = np.stack([nodes[k] / max(choices[k], 1) for k in range(len(net.out))])
    moved("out", mean, mean**2)


def test_scores_equal_the_choices_one_by_one():
    net, rng = small_network(3)
    for _ in range(20):
        ids = rng.integers(0, 60, rng.integers(1, 40)).astype(np.int32)
        wide, place = lm.spread(ids, np.array([0, len(ids)]), 2, 60)
        told = net.told(net.over(wide), ids)
        for i, token in enumerate(ids):
            total = net.shift + sum(net.place[j] * net.token[wide[place[i] + g]] for j, g in enumerate((-2, -1, 1, 2)))
            hidden, log = np.append(np.tanh(total), 1.0), 0.0
            way = [(0, net.turns[0][token])] + [(net.second[token], net.turns[1][token])] * int(net.second[token] >= 0)
            way += [(net.node[k], net.turn[k]) for k in range(net.first[token], net.first[token] + net.deep[token])]
            for node, turn in way:
                logits = net.out[node] @ hidden
                log += logits[turn] - np.log(np.exp(logits).sum())
            assert math.isclose(told[i], log, abs_tol=1e-4)


def test_rare_tokens_depend_on_the_context():
    """Ids 8 and 9 are as frequent; which of the two comes is told by their neighbours alone."""
    counts = np.array([400, 400, 9, 9, 9, 9, 9, 9, 50, 50, *[0] * 200], dtype=float)
    net = lm.Network(counts, branch=4)
    every, contexts = np.arange(len(counts)), [np.full((4, 1), c) for c in (0, 1)]
    learner, rng = lm.Learner(net, 0.15), np.random.default_rng(0)
    for _ in range(60):
        which = rng.integers(0, 2, 256)
        stretch = np.stack([which, which, 8 + which, which, which], axis=1).ravel().astype(np.int32)
        learner.step(stretch, np.arange(256) * 5)
    lead = [np.diff(net.conditional(np.array([8, 9]), np.repeat(c, 2, axis=1)))[0] for c in contexts]
    assert lead[0] < -1 and lead[1] > 1
    for c in contexts:
        assert math.isclose(np.exp(net.conditional(every, np.repeat(c, len(every), axis=1))).sum(), 1.0, rel_tol=1e-3)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_rounds_learn_from_every_position_once(monkeypatch, rounds):
    rng = np.random.default_rng(1)
    sizes = [1, 2, 0, 500, 97, *rng.integers(0, 60, 30).tolist(), 5000]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    texts = [np.arange(a, b, dtype="<u4") for a, b in zip(edges[:-1], edges[1:])]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], names=["ids"])
    seen, count = [], int(edges[-1])
    monkeypatch.setattr(lm.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))

    def step(self, stretch, at):
        w, own = self.net.window, stretch[at + self.net.window]
        text = np.searchsorted(edges, own, side="right") - 1
        for g in (-2, -1, 1, 2):  # neighbours are those of the text, or what lies beyond it
            there = (own + g >= edges[text]) & (own + g < edges[text + 1])
            assert (stretch[at + w + g] == np.where(there, own + g, count)).all()
        seen.append(own)

    monkeypatch.setattr(lm.Learner, "step", step)
    for r in range(rounds):
        list(lm._trained(lm.Network(np.ones(count)), r, rounds, 0, 64, 0.1)(iter([batch])))
        assert sum(map(len, seen)) < count or r == rounds - 1
    assert sorted(np.concatenate(seen).tolist()) == list(range(count))


def test_steps_hold_no_positions_of_other_rounds(monkeypatch):
    """A stretch is as long as the runs that its round masks, with a window around each."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 60, n).astype("<u4") for n in (9 * lm.RUN + 7, 3, lm.RUN, 0, 4 * lm.RUN + 1)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], names=["ids"])
    seen = []
    monkeypatch.setattr(lm.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
    monkeypatch.setattr(lm.Learner, "step", lambda self, stretch, at: seen.append((len(stretch), len(at))))
    for r in range(2):
        list(lm._trained(lm.Network(np.ones(60)), r, 2, 0, lm.BATCH, 0.1)(iter([batch])))
    assert sum(n for _, n in seen) == sum(map(len, texts)) and len(seen) == 2
    assert sum(n for n, _ in seen) == sum(map(len, texts)) + 4 * sum(-(-len(t) // lm.RUN) for t in texts)


@pytest.mark.parametrize("large", [False, True])
def test_steps_and_scores_with_large_logits(large):
    """Choices whose exponentials leave a float's range are shifted, and others are not changed by it."""
    net, rng = small_network(3)
    if large:
        net.out[:, :, :-1] *= 400
    ids = rng.integers(0, 60, 300).astype(np.int32)
    wide, place = lm.spread(ids, np.array([0, len(ids)]), 2, 60)
    hidden = net.over(wide)
    assert net.calm(net.stands(ids)[1]) != large
    told, exact = net.told(hidden, ids), np.zeros(len(ids))
    for i, token in enumerate(ids):
        way = [(0, net.turns[0][token])] + [(net.second[token], net.turns[1][token])] * int(net.second[token] >= 0)
        way += [(net.node[k], net.turn[k]) for k in range(net.first[token], net.first[token] + net.deep[token])]
        for node, turn in way:
            logits = (net.out[node] @ np.append(hidden[i], 1.0)).astype(float)
            exact[i] += logits[turn] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
    assert np.allclose(told, exact, rtol=1e-3, atol=1e-3 if not large else 0.1) and np.isfinite(told).all()
    learner = lm.Learner(net, 0.1)
    learner.step(wide, place - 2)
    assert np.isfinite(net.out).all() and np.isfinite(net.token).all()


def test_scoring_odd_documents(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (None, "word " * 30000, "a"), (4, "x y z", "a"), (4, "x y z", "a")], "doc_id long, text string, ids string")
    rows = lm.score_documents(docs, tokenizer(), 50257, rounds=1).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 3, 3, 30001]
    assert lm.score_documents(docs.limit(0), tokenizer(), 50257).collect() == []


def mixture(rows, t, budget, seed, block_tokens):
    """The mixture by its definition: (doc_id, epoch) pairs."""
    import hashlib

    key16 = lambda *p: hashlib.md5("|".join(map(str, p)).encode()).hexdigest()[:16]
    sources = {}
    for i, text, source in rows:
        sources.setdefault(source or "", []).append(("" if i is None else str(i), 1 + len((text or "").split())))
    size = {s: sum(n for _, n in docs) for s, docs in sources.items()}
    total, most = sum(size.values()), max(size.values())
    z, out = sum((n / total) ** t for n in size.values()), []
    for s, docs in sources.items():
        epochs = (most / size[s]) ** (1 - t) if budget is None else (size[s] / total) ** t / z * budget / size[s]
        goal = math.floor(epochs * size[s])
        blocks = math.ceil(size[s] / block_tokens)
        whole, rest = divmod(goal, size[s])
        out += [(name, e) for name, _ in docs for e in range(whole)]
        place = sorted((key16(seed, s, whole, int(hashlib.md5(n.encode()).hexdigest()[:8], 16) % blocks), key16(seed, whole, n), n, c) for n, c in docs)
        for at in place:
            if sum(c for b, d, _, c in place if (b, d) <= at[:2]) <= rest:
                out.append((at[2], whole))
    return sorted(out)


@pytest.mark.parametrize("how", [{"max_repetition": 2.0}, {"target_entropy": 0.97}, {"target_entropy": 0.97, "budget": 1500.0}, {"budget": 300.0}])
def test_mixing_equals_its_definition(spark, how):
    rows = [(i, " ".join(["w"] * (i % 13)), f"s{min(i % 7, 3)}") for i in range(200)]
    rows += [(300, None, None), (301, "", ""), (302, "x " * 900, "s0"), (None, "a b", "s1"), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, blocks int, key string").repartition(4)
    got = mixing.mix(docs, seed=3, block_tokens=100, **how)
    told = mixing.plan(docs, seed=3, block_tokens=100, **how).collect()
    t = told[0].exponent
    assert sorted((str(r.doc_id) if r.doc_id is not None else "", r.mix_epoch) for r in got.collect()) == mixture(rows, t, how.get("budget"), 3, 100)
    assert got.columns[:5] == ["doc_id", "text", "source", "blocks", "key"]
    weights = {r.key: r.weight for r in told}
    assert math.isclose(sum(weights.values()), 1.0, abs_tol=1e-6)
    if "target_entropy" in how:
        assert -sum(w * math.log(w) for w in weights.values()) >= 0.97 * math.log(len(weights)) - 1e-5
    if "max_repetition" in how:
        assert max(r.goal / r.tokens for r in told) <= 2.0 and min(r.goal / r.tokens for r in told) == 1.0


def test_mixing_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none, max_repetition=2.0).collect() == []


def test_mixing_runs_no_python(spark):
    text = QUERIES["op10_source_mixing"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    r = compare(spark, duck(sf), sf, name, QUERIES[name], ORACLE[name])
    assert r["columns_match"] and r["exact"], r
