"""SimHash near-duplicates: fingerprints, linked through BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.llm.bpe import text_buffers
from stocklens.llm.common import connected_components, cut, written

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints of one tree; a larger shard is split into several, met pair by pair.
TREE = 4096
#: Shingles hashed at once.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is set in more than half the hashes of the text's shingles."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(begins), CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[i : i + CHUNK], ends[i : i + CHUNK], strict=True)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > len(begins)).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``, the 64 bits as a signed long. Null and empty texts have zero."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            raw = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(raw, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Children keyed by their Hamming distance to the parent."""

    def __init__(self, codes: list[int]) -> None:
        self.codes = codes
        self.children: list[dict[int, int]] = [{} for _ in codes]
        for new in range(1, len(codes)):
            at = 0
            while True:
                gap = (codes[at] ^ codes[new]).bit_count()
                if (below := self.children[at].get(gap)) is None:
                    self.children[at][gap] = new
                    break
                at = below

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(node, positions of the queries within the radius of it)``.

        All queries that reach a node are measured against it at once; by the triangle
        inequality only edges keyed within the radius of a query's distance lead to matches."""
        todo = [(0, np.arange(len(queries), dtype=np.int32))]
        while todo:
            node, at = todo.pop()
            gap = np.bitwise_count(queries[at] ^ np.uint64(self.codes[node])).astype(np.int64)
            if (hit := at[gap <= radius]).size:
                yield node, hit
            for key, child in self.children[node].items():
                if (follow := at[np.abs(gap - key) <= radius]).size:
                    todo.append((child, follow))


def _linker(radius: int, tree: int):
    def links(nodes: np.ndarray, codes: np.ndarray, side: np.ndarray):
        """A spanning forest of the links between a shard's two sides, or within it if it has one."""
        label, out = np.arange(len(nodes)), []
        trees = np.flatnonzero(side == 0)
        asked = np.flatnonzero(side == 1) if (side == 1).any() else trees
        for i in range(0, len(trees), tree):
            part = trees[i : i + tree]
            for node, hits in BKTree([int(c) for c in codes[part]]).within(codes[asked], radius):
                at, met = part[node], asked[hits]
                for other in np.unique(label[met]).tolist():
                    if other != label[at]:
                        out.append((nodes[at], nodes[met[label[met] == other][0]]))
                        label[label == other] = label[at]
        return out

    def run(batches):
        """Rows come sorted by shard; a shard is held until its last row has been seen."""
        shard, held = None, []
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            keys = columns[0]
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if held and keys[a] != shard:
                    out += _finish(held, links)
                    held = []
                if b > a:
                    shard = keys[a]
                    held.append([c[a:b] for c in columns[1:]])
            yield _pairs(out)
        yield _pairs(_finish(held, links))

    return run


def _finish(held, links) -> list:
    if sum(len(h[0]) for h in held) < 2:
        return []
    nodes, codes, side = (np.concatenate([h[i] for h in held]) for i in range(3))
    return links(nodes, codes.view(np.uint64), side)


def _pairs(found: list) -> pa.RecordBatch:
    both = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def links(codes: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """``(a, b)`` of ``codes (node, fp)``, all fps distinct: enough links for the components of
    all pairs within ``radius`` bits.

    Cut into radius + 1 blocks of bits, two codes within the radius agree on one block at
    least, so a shard is the codes with one value in one block and its BK-trees see only those.
    Trees go to their shard's task by a shuffle rather than from the driver, as they hold the
    fingerprints of all documents. A shard over ``tree`` codes is dealt to parts, and each pair
    of parts is a shard of its own, so that no task holds more than two parts. A task sends
    a spanning forest of its links, never all pairs.
    """
    blocks = radius + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    values = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) if b - a < 64 else F.col("fp") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    posted = codes.select("node", "fp", F.posexplode(F.array(*values)).alias("block", "value"))
    big = posted.groupBy("block", "value").agg(F.count("*").alias("n")).where(F.col("n") > tree)
    big = cut(big.select("block", "value", F.ceil(F.col("n") / tree).cast("int").alias("parts")))
    dealt = posted.join(big, ["block", "value"], "left").select(
        "node", "fp", "block", "value", F.coalesce("parts", F.lit(1)).alias("parts"),
    ).withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int"))
    pairs = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        F.xxhash64("block", "value", F.least("mine", "other"), F.greatest("mine", "other")).alias("shard"), "node", "fp",
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    together = pairs.repartition("shard").sortWithinPartitions("shard", "fp", "side")
    return together.mapInArrow(_linker(radius, tree), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree: int = TREE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row: 16 hexadecimal digits, and the
    smallest id reachable over links between fingerprints of ``radius`` or fewer bits' distance.

    Fingerprints are made once and written to the shared folder. Rows with one fingerprint are
    one node, named by their smallest id, so neither trees nor components ever see copies.
    Null and empty texts share fingerprint zero and are linked like any other. Rows with a null
    id keep their fingerprint and get the component of it (null if nothing else has it);
    repeated rows come out repeated. Other columns are ignored; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, shingle, id_col, text_col), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL").select("node", "fp"), "simhash-nodes")
    parts = connected_components(links(nodes, radius, tree))
    named = nodes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def marked(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree: int = TREE, text_col: str = "text") -> DataFrame:
    """``(row, place, group)``: every row of ``docs`` as a struct, with a number of its own and the
    component of its fingerprint (a fingerprint of it), as a written table.

    Components are those of ``near_duplicates``, but named by fingerprints: ids play no part, so
    null, repeated and clashing ones join nothing."""
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            raw = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(raw, dtype=np.uint64).view(np.int64))], names=["row", "fp"])

    schema = StructType([kept.schema["row"]]).add("fp", "long")
    rows = written(kept.mapInArrow(run, schema).withColumn("place", F.monotonically_increasing_id()), "simhash-rows")
    nodes = written(rows.select("fp").distinct().select(F.col("fp").alias("node"), "fp"), "simhash-nodes")
    parts = connected_components(links(nodes, radius, tree)).withColumnRenamed("node", "fp")
    return rows.join(parts, "fp", "left").select("row", "place", F.coalesce("component", "fp").alias("group"))
