"""Masked pseudo-likelihood of documents under a bidirectional window network."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.bpe import encoded
from stocklens.llm.common import written

#: Tokens seen on either side of the one that is predicted.
WINDOW = 2
WIDTH = 16
#: Ways on from a node of the tree of tokens; bounds the cost of a choice.
BRANCH = 32
#: Passes over the corpus; the positions are dealt to them, and each masks and learns from its own.
ROUNDS = 2
BATCH = 16384
RATE = 0.6
#: Positions predicted at once when scoring, and those whose first choice is.
CHUNK, TILE = 1 << 14, 1024
#: Positions whose windows are summed at once; their vectors stay in a core's cache.
BLOCK = 1024
#: Logits up to this one need no shift before their exponentials.
STEADY = 60
#: Positions of a text that the same round masks.
RUN = 1024


class Scratch:
    """Memory that steps and scores use again: fresh memory costs more than the sums in it."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, rows: int, width: int) -> np.ndarray:
        found = self.held.get(name)
        if found is None or len(found) < rows or found.shape[1] != width:
            found = self.held[name] = np.empty((rows, width), dtype=np.float32)
        return found[:rows]


class Network:
    """Token vectors, weighted by their place in the window and summed, through tanh, predict
    the token between them by a few choices, each a softmax over at most ``branch`` ways, that
    lead down a tree to it: the Huffman tree with that many ways of the tokens' corpus counts,
    so that a token takes as few choices as its frequency allows. All choices meet the same
    hidden vector with vectors of their own; untrained, they give the counts' shares."""

    def __init__(self, counts: np.ndarray, width: int = WIDTH, branch: int = BRANCH, window: int = WINDOW, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        vocabulary, self.window, self.branch = len(counts), window, branch
        shares = self._plant(counts + 0.5)
        # The last row stands for what lies beyond a document's ends.
        self.token = (rng.standard_normal((vocabulary + 1, width)) * 0.1).astype(np.float32)
        self.place = np.ones((2 * window, width), dtype=np.float32)
        self.shift = np.zeros(width, dtype=np.float32)
        # The last component is the bias; a way that isn't there has no chance.
        self.out = np.zeros((len(shares), branch, width + 1), dtype=np.float32)
        self.out[0, :, :-1] = rng.standard_normal((branch, width)) * 0.1
        self.out[:, :, -1] = shares

    def _plant(self, weights: np.ndarray) -> np.ndarray:
        """The choices on the way to each token: ``turns[0]`` at the root, ``turns[1]`` at the node
        ``second`` (-1: there is none), and from ``first`` on ``deep`` pairs of ``node`` and
        ``turn`` below. Returns the logarithms of the ways' shares, root first."""
        vocabulary, branch = len(weights), self.branch
        heap = list(zip(weights.tolist(), range(vocabulary), strict=True))
        heapq.heapify(heap)
        above, turn, shares = np.full(2 * vocabulary + 1, -1), np.zeros(2 * vocabulary + 1, dtype=np.int64), []
        size = (vocabulary - 2) % (branch - 1) + 2 if vocabulary > 1 else 1  # so that the root is full
        while len(heap) > 1 or not shares:
            least = [heapq.heappop(heap) for _ in range(size)][::-1]
            made, mass = vocabulary + len(shares), np.array([w for w, _ in least])
            for place, (_, child) in enumerate(least):
                above[child], turn[child] = made, place
            shares.append(np.concatenate([np.log(mass / mass.sum()), np.full(branch - size, -80.0)]))
            heapq.heappush(heap, (float(mass.sum()), made))
            size = branch
        root, at, upward = vocabulary + len(shares) - 1, np.arange(vocabulary), []
        while (at != root).any():
            up = np.where(at == root, root, above[at])
            upward.append((np.where(at == root, -1, root - up), turn[at]))
            at = up
        nodes, ways = (np.array(x) for x in zip(*upward, strict=True))
        depth = (nodes >= 0).sum(axis=0)
        every = np.arange(vocabulary)
        self.second = np.where(depth > 1, nodes[np.maximum(depth - 2, 0), every], -1).astype(np.int32)
        self.turns = [ways[depth - 1, every].astype(np.int32), np.where(depth > 1, ways[np.maximum(depth - 2, 0), every], 0).astype(np.int32)]
        self.deep = np.maximum(depth - 2, 0).astype(np.int16)
        self.first = np.cumsum(self.deep, dtype=np.int64) - self.deep
        height = np.arange(self.deep.sum()) - np.repeat(self.first, self.deep)
        self.node, self.turn = (x[height, np.repeat(every, self.deep)].astype(np.int32) for x in (nodes, ways))
        return np.array(shares[::-1], dtype=np.float32)

    DENSE = ("place", "shift")

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = np.take(self.token, around[0], axis=0)
        total *= self.place[0]
        total += self.shift
        for j in range(1, len(around)):
            part = np.take(self.token, around[j], axis=0)
            part *= self.place[j]
            total += part
        return np.tanh(total, out=total)

    def over(self, stretch: np.ndarray, scratch: Scratch | None = None) -> np.ndarray:
        """Hidden vectors of the positions of a stretch that are a window from its ends."""
        scratch, width = scratch or Scratch(), self.token.shape[1]
        vectors = np.take(self.token, stretch, axis=0, out=scratch("vectors", len(stretch), width), mode="clip")
        return self.windows(vectors, self.tiles(), scratch("hidden", len(stretch) - 2 * self.window, width), scratch("part", BLOCK, width))

    def gaps(self) -> list[int]:
        """Where a window's vectors stand, from its first place on."""
        return [g for g in range(2 * self.window + 1) if g != self.window]

    def tiles(self) -> np.ndarray:
        """The places' weights and the shift, repeated for a block's rows: numpy works through
        arrays of one shape in one go, but row by row where it has to repeat a short one."""
        return np.repeat(np.concatenate([self.place, self.shift[None]])[:, None], BLOCK, axis=1)

    def windows(self, vectors: np.ndarray, tiles: np.ndarray, out: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Hidden vectors of a stretch with these token vectors, into ``out``; ``other`` is a block's room."""
        for a in range(0, len(out), BLOCK):
            total = out[a : a + BLOCK]
            n = len(total)
            for j, g in enumerate(self.gaps()):
                if j:
                    total += np.multiply(vectors[g + a : g + a + n], tiles[j, :n], out=other[:n])
                else:
                    np.multiply(vectors[g + a : g + a + n], tiles[j, :n], out=total)
                    total += tiles[-1, :n]
            np.tanh(total, out=total)
        return out

    def conditional(self, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Log-probability of each id between its neighbours (a row of ``around`` per place)."""
        return self.told(self.hidden(around), ids)

    def told(self, hidden: np.ndarray, ids: np.ndarray, at: np.ndarray | None = None, scratch: Scratch | None = None) -> np.ndarray:
        """Log-probability of each id given its hidden vector, the one at ``at`` if that is given:
        the sum over the choices to it."""
        order, stands = self.stands(ids)
        ids, n = np.take(ids, order), len(ids)
        scratch = scratch or Scratch()
        wide, ones = with_ones(hidden, order if at is None else np.take(at, order), scratch), np.ones(self.branch, dtype=np.float32)
        room, starts = scratch("room", min(n, TILE), self.branch), np.arange(min(n, TILE)) * self.branch
        sums, masses = np.zeros(n, dtype=np.float32), np.ones((2, n), dtype=np.float32)
        taken, calm = [np.take(t, ids).astype(np.int64) for t in self.turns], self.calm(stands)
        for level, node, a, b in stands:
            logits = np.matmul(wide[a:b], self.out[node].T, out=room[: b - a])
            if not calm:
                steady(logits)
            sums[a:b] += np.take(logits, starts[: b - a] + taken[level][a:b])
            np.matmul(np.exp(logits, out=logits), ones, out=masses[level, a:b])
        sums -= np.log(masses[0])
        sums -= np.log(masses[1])
        below = Below(self, ids)
        if below.any:
            logits = steady(np.take(wide, below.rows, axis=0) @ self.out[below.node].transpose(0, 2, 1))
            logs = np.take(logits, below.real * self.branch + below.turns)
            logs -= np.take(np.log(np.exp(logits, out=logits).reshape(-1, self.branch) @ ones), below.real)
            sums += np.bincount(below.row, weights=logs, minlength=n)
        found = np.empty(n)
        found[order] = sums
        return found

    def stands(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
        """The order of ids by their second choice, and ``(level, node, begin, end)`` of those in
        this order that stand together at a node of the first two levels, ``TILE`` at the most."""
        order, found, first = grouped(np.take(self.second, ids) + 1, len(self.out) + 1)
        ends = np.append(first[1:], len(ids))
        runs = [(0, 0, 0, len(ids))] + [(1, n - 1, a, b) for n, a, b in zip(found.tolist(), first.tolist(), ends.tolist(), strict=True) if n]
        return order, [(level, node, i, min(i + TILE, b)) for level, node, a, b in runs for i in range(a, b, TILE)]

    def calm(self, stands: list[tuple[int, int, int, int]]) -> bool:
        """Whether no logit there can be large, hidden components being between -1 and 1."""
        ways = self.out[sorted({node for _, node, _, _ in stands})]
        return bool(len(ways)) and bool((np.abs(ways[:, :, :-1]).sum(axis=2) + ways[:, :, -1]).max() <= STEADY)


class Below:
    """The choices of ids below the first two levels, in rows of equal length that stand at one
    node each. A node with many choices has many rows, so a common one makes none longer.
    ``nodes`` are the distinct ones, ``counts`` their choices, ``first`` and ``parts`` their
    first rows and how many; ``node`` is each row's. ``rows`` are the positions, one past the
    last where a row has filling. Choice by choice, in the nodes' order: ``real`` its place among
    the rows', ``row`` its position and ``turns`` the way it takes. ``level`` holds, for each of
    the levels, the choices there: no position is twice among them."""

    def __init__(self, net: Network, ids: np.ndarray) -> None:
        deep = np.take(net.deep, ids)
        some = np.flatnonzero(deep)
        self.any = len(some) > 0
        if not self.any:
            return
        deep = deep[some].astype(np.int64)
        row, begin = np.repeat(some, deep), np.cumsum(deep) - deep
        step = np.arange(len(row)) - np.repeat(begin, deep)
        at = step + np.repeat(net.first[ids[some]], deep)
        order, self.nodes, first = grouped(net.node[at], len(net.out))
        self.counts = np.diff(np.append(first, len(row)))
        long = int(np.clip(1 << int(np.ceil(np.log2(len(row) / len(first)))), 4, 64))
        self.parts = -(-self.counts // long)
        self.node, self.first = np.repeat(self.nodes, self.parts), np.cumsum(self.parts) - self.parts
        self.real = np.arange(len(row)) + np.repeat(self.first * long - first, self.counts)
        self.row, self.turns, step = row[order], net.turn[at[order]], step[order]
        self.rows = np.full(len(self.node) * long, len(ids))
        self.rows[self.real] = self.row
        self.rows = self.rows.reshape(-1, long)
        self.level = [np.flatnonzero(step == k) for k in range(int(deep.max()))]


def with_ones(hidden: np.ndarray, order: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The rows in an order, each with a one at its end, which meets the bias, and a row of zeros."""
    n, width = hidden.shape
    wide = scratch("with ones", n + 1, width + 1)
    wide[:-1, :-1] = hidden
    wide[:, -1] = 1
    wide[-1] = 0
    return np.take(wide, np.append(order, n), axis=0, out=scratch("in order", len(order) + 1, width + 1), mode="clip")


def steady(logits: np.ndarray) -> np.ndarray:
    """Shifted by each row's largest, if exponentials could leave a float's range."""
    if logits.size and logits.max() > STEADY:
        logits -= logits.max(axis=-1, keepdims=True)
    return logits


def grouped(numbers: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts numbers, the distinct ones, and where each begins in the order."""
    short = numbers.astype(np.uint16) if below <= 1 << 16 else numbers  # two bytes are sorted by their digits
    order = np.argsort(short, kind="stable")
    sorted_ = short[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(order) else order
    return order, sorted_[first].astype(np.int64), first


class Learner:
    """AdaGrad steps on a network; remembers how often each token's and node's vectors were moved.

    A step takes positions of a stretch of text, in order: a token's vector is fetched once for
    all windows that it stands in, windows are slices of the stretch, and so are the slopes that
    come back. Choices at one node are products of matrices."""

    def __init__(self, net: Network, rate: float) -> None:
        self.net, self.rate = net, rate
        self.square = {n: np.full_like(getattr(net, n), 1e-2) for n in Network.DENSE}
        self.token_square = np.full(len(net.token), 1e-2, dtype=np.float32)
        self.out_square = np.full_like(net.out, 1e-2)
        self.moved = np.zeros(len(net.token) + len(net.out), dtype=np.int64)
        self.steps = 0
        self.ones, self.starts = np.ones(net.branch, dtype=np.float32), np.arange(TILE) * net.branch
        self.rows_ones = np.ones(BLOCK, dtype=np.float32)
        self.scratch = Scratch()

    def step(self, stretch: np.ndarray, at: np.ndarray) -> None:
        """Learn from the positions ``at`` of a ``stretch`` of ids that begins and ends a window
        before the first and after the last of them."""
        net, w, n = self.net, self.net.window, len(at)
        inside, gaps, tiles = len(stretch) - 2 * w, net.gaps(), net.tiles()
        vectors = self._scratch("vectors", len(stretch))
        np.take(net.token, stretch, axis=0, out=vectors, mode="clip")
        hidden = net.windows(vectors, tiles, self._scratch("hidden", inside), self._scratch("part", BLOCK))
        pulled, used = self._choose(hidden, stretch[at + w], at), np.zeros(inside, dtype=np.int64)
        used[at] = 1
        slopes = {"shift": np.zeros_like(net.shift), "place": np.zeros_like(net.place)}
        pushed, part, uses = self._scratch("pushed", len(stretch)), self._scratch("part", BLOCK), np.zeros(len(stretch), dtype=np.int64)
        pushed[:] = 0
        for a in range(0, inside, BLOCK):
            here, back = hidden[a : a + BLOCK], pulled[a : a + BLOCK]
            b = a + len(here)
            here *= here
            back *= np.subtract(1.0, here, out=here)
            ones = self.rows_ones[: b - a]
            slopes["shift"] += ones @ back / n
            for j, g in enumerate(gaps):
                slopes["place"][j] += ones @ np.multiply(back, vectors[g + a : g + b], out=part[: b - a]) / n
                pushed[g + a : g + b] += np.multiply(back, tiles[j, : b - a], out=part[: b - a])
        for g in gaps:
            uses[g : g + inside] += used
        self._tokens(stretch, pushed, uses)
        for name, slope in slopes.items():
            self.square[name] += slope * slope
            getattr(net, name)[...] -= self.rate * slope / np.sqrt(self.square[name])
        self.steps += 1

    def _scratch(self, name: str, rows: int) -> np.ndarray:
        return self.scratch(name, rows, self.net.token.shape[1])

    def _tokens(self, stretch: np.ndarray, pushed: np.ndarray, uses: np.ndarray) -> None:
        """Move the vectors of the stretch's tokens by the mean slope over their uses."""
        order, rows, first = grouped(stretch, len(self.net.token))
        uses = np.add.reduceat(np.take(uses, order), first)
        sorted_ = np.take(pushed, order, axis=0, out=self._scratch("sorted", len(order)), mode="clip")
        # Two floats at a time, as a complex number's parts.
        total = np.add.reduceat(sorted_.view(np.complex64) if sorted_.shape[1] % 2 == 0 else sorted_, first, axis=0).view(np.float32)
        if not uses.all():
            rows, total, uses = rows[uses > 0], total[uses > 0], uses[uses > 0]
        total /= uses[:, None].astype(np.float32)
        self.token_square[rows] += np.einsum("ij,ij->i", total, total) / total.shape[1]
        self.net.token[rows] -= (self.rate * total / np.sqrt(self.token_square[rows])[:, None]).astype(np.float32)
        self.moved[rows] += uses

    def _choose(self, hidden: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Move the choices on the ways to ``ids``, which stand at ``at``; the slopes of all hidden
        vectors come back."""
        net, ones = self.net, self.ones
        order, stands = net.stands(ids)
        ids, at, n = np.take(ids, order), np.take(at, order), len(ids)
        wide, back = with_ones(hidden, at, self.scratch), self._scratch("back", n + 1)
        back[n] = 0
        room, part = self.scratch("room", TILE, net.branch), self._scratch("part", max(BLOCK, TILE))
        taken, calm = [np.take(t, ids).astype(np.int64) for t in net.turns], net.calm(stands)
        slopes: dict[int, np.ndarray] = {}
        uses: dict[int, int] = {}
        for level, node, a, b in stands:
            seen, ways = wide[a:b], net.out[node]
            error = np.matmul(seen, ways.T, out=room[: b - a])
            if not calm:
                steady(error)
            np.exp(error, out=error)
            error /= (error @ ones)[:, None]
            error.reshape(-1)[self.starts[: b - a] + taken[level][a:b]] -= 1.0
            if level:
                back[a:b] += np.matmul(error, ways[:, :-1], out=part[: b - a])
            else:
                np.matmul(error, ways[:, :-1], out=back[a:b])
            slopes[node] = slopes[node] + error.T @ seen if node in slopes else error.T @ seen
            uses[node] = uses.get(node, 0) + b - a
        self._move(np.array(list(slopes)), np.stack(list(slopes.values())), np.array(list(uses.values())))
        below = Below(net, ids)
        if below.any:
            seen, ways = np.take(wide, below.rows, axis=0), net.out[below.node]
            error = steady(seen @ ways.transpose(0, 2, 1))
            np.exp(error, out=error)
            flat = error.reshape(-1, net.branch)
            flat /= (flat @ ones)[:, None]
            error.reshape(-1)[below.real * net.branch + below.turns] -= 1.0
            pulled = np.take((error @ ways[:, :, :-1]).reshape(-1, hidden.shape[1]), below.real, axis=0)
            for there in below.level:
                back[below.row[there]] += pulled[there]
            each = error.transpose(0, 2, 1) @ seen  # filling meets zeros
            slope = each[below.first]
            for k in range(1, int(below.parts.max())):
                more = np.flatnonzero(below.parts > k)
                slope[more] += each[below.first[more] + k]
            self._move(below.nodes, slope, below.counts)
        place = np.full(len(hidden), n)  # a position that is not among them gets zeros
        place[at] = np.arange(n)
        return np.take(back, place, axis=0, out=self._scratch("pulled", len(hidden)), mode="clip")

    def _move(self, nodes: np.ndarray, slope: np.ndarray, uses: np.ndarray) -> None:
        """Move the vectors of nodes by the mean slope over their uses."""
        slope /= uses[:, None, None].astype(np.float32)
        square = self.out_square[nodes]
        square += slope * slope
        self.out_square[nodes] = square
        slope *= self.rate
        slope /= np.sqrt(square, out=square)
        self.net.out[nodes] -= slope
        self.moved[len(self.net.token) + nodes] += uses


def spread(ids: np.ndarray, offsets: np.ndarray, window: int, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts on end with ``beyond`` a window wide before, between and after them, and each id's
    place there: what stands around a position is then its text's ids or ``beyond``."""
    texts = len(offsets) - 1
    place = np.arange(len(ids)) + window * (np.repeat(np.arange(texts), np.diff(offsets)) + 1)
    wide = np.full(len(ids) + window * (texts + 1), beyond, dtype=np.int32)
    wide[place] = ids
    return wide, place


def token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: little-endian 32-bit ids of every text, as a shared table."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for _, ids, offsets in encoded(batch, tokenizer):
                out += [ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    return written(rows.mapInArrow(run, "doc_id long, ids binary"), "lm-tokens")


def _texts(batch: pa.RecordBatch, limit: int = 1 << 20):
    """``(first row, ids, offsets)`` of a batch's documents, about a million ids at a time."""
    column = batch.column(batch.schema.get_field_index("ids")).cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(edges, edges[row] + 4 * limit, side="right")) - 1)
        yield row, data[edges[row] : edges[stop]].copy().view("<u4").astype(np.int32), (edges[row : stop + 1] - edges[row]) // 4
        row = stop


def corpus_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in the corpus."""

    def run(batches):
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for _, ids, _ in _texts(batch):
                counts += np.bincount(ids, minlength=vocabulary)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["id", "n"])

    counts = np.zeros(vocabulary)
    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # one row an id
    counts[rows["id"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    return counts


def runs(ids: np.ndarray, offsets: np.ndarray, rounds: int, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the texts' positions: where each begins, its length, its text, and the one round
    that masks it. Runs are dealt to rounds by their place in the text and by the sum of its ids,
    the same in any task."""
    sizes = np.diff(offsets)
    upto = np.concatenate([[0], np.cumsum(ids, dtype=np.int64)])
    sums = upto[offsets[1:]] - upto[offsets[:-1]] + sizes
    each = -(-sizes // run)
    text = np.repeat(np.arange(len(sizes)), each)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    return offsets[text] + nth * run, np.minimum(sizes[text] - nth * run, run), text, ((sums[text] + nth + 1) * 0x9E3779B1 >> 16) % rounds


def stretched(ids: np.ndarray, offsets: np.ndarray, first: np.ndarray, long: np.ndarray, text: np.ndarray, window: int, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of texts on end, each between a window of what stands there in its text or
    ``beyond``, and where their positions are in it."""
    sizes = long + 2 * window
    begin, edge = np.cumsum(sizes) - sizes, np.full(window, beyond, dtype=np.int32)
    wide = np.take(np.concatenate([edge, ids, edge]), np.arange(sizes.sum()) + np.repeat(first - begin, sizes))
    for k in range(window):
        wide[begin[first - window + k < offsets[text]] + k] = beyond
        wide[(begin + window + long + k)[first + long + k >= offsets[text + 1]]] = beyond
    return wide, np.arange(long.sum()) + np.repeat(begin + window - (np.cumsum(long) - long), long)


def _trained(net: Network, round_: int, rounds: int, seed: int, batch_size: int, rate: float):
    """A task learns from its own documents and sends what it has moved: per token or (numbered
    after them) node that it met the vectors, times the number of uses; the dense parts times
    its steps."""

    def run(batches):
        task = TaskContext.get().partitionId()
        rng, learner, beyond = np.random.default_rng([seed, round_, task]), Learner(net, rate), len(net.token) - 1
        for batch in batches:
            for _, ids, offsets in _texts(batch):
                first, long, text, turn = runs(ids, offsets, rounds)
                own = turn == round_
                if not own.any():
                    continue
                wide, at = stretched(ids, offsets, first[own], long[own], text[own], net.window, beyond)
                for i in rng.permutation(np.arange(0, len(at), batch_size)).tolist():
                    part = at[i : i + batch_size]
                    low = part[0] - net.window
                    learner.step(wide[low : part[-1] + net.window + 1], part - part[0])
        if not learner.steps:
            return
        rows = np.flatnonzero(learner.moved)
        weight = learner.moved[rows]
        tokens, nodes = rows[rows < len(net.token)], rows[rows >= len(net.token)] - len(net.token)
        moved = [*(net.token[tokens] * weight[: len(tokens), None]).astype("<f8"), *(net.out[nodes] * weight[len(tokens) :, None, None]).astype("<f8")]
        dense = np.concatenate([getattr(net, n).ravel() for n in Network.DENSE])
        index = np.append(rows, -1)
        sums = [*moved, (dense * learner.steps).astype("<f8")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(index, pa.int64()), pa.array(np.full(len(index), task), pa.int64()), pa.array(np.append(weight, learner.steps), pa.int64()), pa.array([s.tobytes() for s in sums], pa.binary())],
            names=["row", "task", "weight", "total"],
        )

    return run


def _averaged(batches):
    """Weighted means, row by row; rows come sorted by row and task."""
    row, total, weight = None, None, 0
    out: list[list] = [[], []]
    for batch in batches:
        for r, w, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            t = np.frombuffer(t.as_buffer(), dtype="<f8")
            if r != row:
                if row is not None:
                    out[0].append(row)
                    out[1].append((total / weight).astype("<f4").tobytes())
                row, total, weight = r, t.copy(), w
            else:
                total += t
                weight += w
    if row is not None:
        out[0].append(row)
        out[1].append((total / weight).astype("<f4").tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["row", "mean"])


def train(tokens: DataFrame, vocabulary: int, rounds: int = ROUNDS, batch_size: int = BATCH, rate: float = RATE, seed: int = 0, **shape) -> Network:
    """A network learnt from every document of ``tokens (doc_id, ids)``.

    Each round every task masks the positions that are dealt to it, so that the rounds together
    predict every token once, and makes numpy steps from the shared network; the tasks' networks
    are averaged by Spark, each vector by its uses. Only the model (a few vectors a token at the
    most) comes back to the driver."""
    sc = tokens.sparkSession.sparkContext
    net = Network(corpus_counts(tokens, vocabulary), seed=seed, **shape)
    for r in range(rounds):
        shared = sc.broadcast(net)
        told = tokens.select("ids").mapInArrow(lambda it, s=shared, r=r: _trained(_copy(s.value), r, rounds, seed, batch_size, rate)(it), "row long, task long, weight long, total binary")
        means = told.repartition("row").sortWithinPartitions("row", "task").mapInArrow(_averaged, "row long, mean binary")
        for m in means.toLocalIterator():
            values = np.frombuffer(m.mean, dtype="<f4")
            if m.row >= len(net.token):
                net.out[m.row - len(net.token)] = values.reshape(net.out.shape[1:])
                continue
            if m.row >= 0:
                net.token[m.row] = values
                continue
            for name in Network.DENSE:
                part = getattr(net, name)
                part[...] = values[: part.size].reshape(part.shape)
                values = values[part.size :]
    return net


def _copy(net: Network) -> Network:
    """Workers keep a broadcast value for their next task; training changes its own copy."""
    own = object.__new__(Network)
    own.__dict__ = {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in net.__dict__.items()}
    return own


def score_tokens(tokens: DataFrame, net: Network) -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood)``: the sum over all of a
    document's tokens of their log-probability given the tokens on both sides."""
    shared = tokens.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        scratch = Scratch()
        for batch in batches:
            model, sums, sizes = shared.value, [], []
            for _, ids, offsets in _texts(batch):
                w, logs = model.window, np.zeros(len(ids))
                wide, place = spread(ids, offsets, w, len(model.token) - 1)
                for i in range(0, len(ids), CHUNK):
                    at = place[i : i + CHUNK]
                    hidden = model.over(wide[at[0] - w : at[-1] + w + 1], scratch)
                    logs[i : i + CHUNK] = model.told(hidden, ids[i : i + CHUNK], at - at[0], scratch)
                sums += [float(logs[a:b].sum()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                sizes += np.diff(offsets).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], names=["doc_id", "n_tokens", "log_likelihood"])

    scored = tokens.mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double")
    return scored.withColumn("mean_log_likelihood", F.try_divide("log_likelihood", "n_tokens"))


def score_documents(docs: DataFrame, tokenizer: str, vocabulary: int, **training) -> DataFrame:
    """Train on ``docs`` and score each of its rows (see ``train`` and ``score_tokens``).

    Null and empty texts have no tokens, a sum of 0 and a null mean; null and repeated ids are
    kept as they are; whole texts are scored; other columns are ignored; an empty table gives
    no rows."""
    tokens = token_table(docs, tokenizer)
    return score_tokens(tokens, train(tokens, vocabulary, **training))
