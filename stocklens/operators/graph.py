"""Logistics-network operators on DataFrames.

The reference converts the supply plan to pandas and runs a single-machine graph library.
Here a graph is an edge DataFrame ``(src, dst)`` and every metric is a Spark job:

* degrees: one explode + one aggregate (map-side combine, so a hub with a third of all
  edges is reduced before the shuffle);
* strongly connected components: trim, path contraction by pointer doubling, then forward
  max-colour / backward reachability (the coloring algorithm of Orzan, also used by
  distributed graph systems), a frontier loop of joins and aggregates;
* hierarchy levels: one breadth-first search from all sources at once, a source being a bit;
  its state is nodes x ceil(sources / 64) rows.

Each round writes only the rows that it adds or changes, with ``checkpoint()`` into the
session's checkpoint folder (reliable storage: a lost executor does not lose state), and
counts them in the same job. Hubs are split (``_Layout``). Loops stop at convergence; there is
no round cap that could cut results short. ``spark.cleaner.referenceTracking.cleanCheckpoints``
lets Spark remove superseded rounds.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stocklens.operators.quality import distinct_scalar, value_counts
from stocklens.session import ensure_checkpoint_dir

# Fixed values of the reference's report (labels of graphs and node kinds).
CD_CD = "CD→CD"
CD_STORE = "CD→Loja"
CD = "CD"
STORE = "Loja"
BOTH_GRAPHS = "CD→CD + CD→Loja"


def _ckpt(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed and written by one job."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _ckpt_sized(df: DataFrame) -> tuple[DataFrame, int]:
    """``_ckpt`` with the number of rows, observed by the checkpoint's own job."""
    obs = Observation()
    out = _ckpt(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return out, int(obs.get["rows"])


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read back. Unlike a checkpoint it has the size
    that its files have: a checkpoint keeps the estimate of its plan, which joins multiply, and
    in a loop of joins that number outgrows any plan."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A node set whose measured size is at most this is broadcast to the joins of a loop, which
# spares the edges a shuffle; a larger one is joined by shuffle.
BROADCAST_BYTES = 32 << 20


def _ckpt_nodes(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``_ckpt`` of a node set with its rows and about its bytes in memory, both observed."""
    obs = Observation()
    longest = F.max(F.octet_length("node")) if df.schema["node"].dataType.typeName() == "string" else F.max(F.lit(8))
    out = _ckpt(df.observe(obs, F.count(F.lit(1)).alias("rows"), longest.alias("longest")))
    rows, size = int(obs.get["rows"]), int(obs.get["longest"] or 0)
    return out, rows, rows * (16 + 8 * len(df.columns) + size)


def _small(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df  # BROADCAST: measured bytes


# A loop's deltas are merged into one after this many rounds, so that plans stay small.
COMPACT_AFTER = 8


class _Deltas:
    """The state of a loop as what each round added to it. A round writes only its new rows;
    ``merge`` folds rows of earlier rounds, and is what a reader of the state applies, too."""

    def __init__(self, first: DataFrame, merge) -> None:
        self.parts, self.merge = [first], merge

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)

    def add(self, fresh: DataFrame) -> None:
        self.parts.append(fresh)
        if len(self.parts) > COMPACT_AFTER:
            self.parts = [_ckpt(self.merge(self.all()))]


# Edges that one node may have in one partition of a loop's edge layout; the edges of a node
# with more are split, and its frontier row goes to each part.
HUB_EDGES = 1_000_000


class _Layout:
    """A static edge set laid out for the loop joins: hash-partitioned and sorted by the join
    key and its part before it is checkpointed (the checkpoint keeps both), so every round
    shuffles only the small frontier, never the edges (the Pregel layout)."""

    def __init__(self, edges: DataFrame, key: str, other: str, hub_edges: int | None = None) -> None:
        self.key, bound = key, hub_edges or HUB_EDGES
        hubs = edges.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound)
        sized = hubs.select(F.col(key).alias("node"), F.ceil(F.col("n") / bound).cast("int").alias("parts"))
        found, self.n_hubs, size = _ckpt_nodes(sized)
        self.hubs = _small(found.withColumnRenamed("node", key), size)  # at most edges / hub_edges rows
        if self.n_hubs:
            edges = edges.join(self.hubs, key, "left").withColumn(
                "part", F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1))).cast("int")
            ).drop("parts")
        else:
            edges = edges.withColumn("part", F.lit(0))
        self.edges = _ckpt(edges.repartition(key, "part").sortWithinPartitions(key, "part"))

    def step(self, frontier: DataFrame) -> DataFrame:
        """``frontier`` (whose node column is the key) joined with the edges of its nodes."""
        if self.n_hubs:
            split = frontier.join(self.hubs, self.key, "left")
            frontier = split.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        else:
            frontier = frontier.withColumn("part", F.lit(0))
        return frontier.join(self.edges, [self.key, "part"])


def _edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))


# --------------------------------------------------------------------------- G1 G2 G3

def cd_cd_edges(plan: DataFrame) -> DataFrame:
    """G1: distinct supplying -> delivering CD pairs with two different, non-NULL ends."""
    rows = plan.where(
        F.col("supplying_cd").isNotNull() & F.col("delivering_cd").isNotNull() & (F.col("supplying_cd") != F.col("delivering_cd"))
    )
    return rows.select(F.col("supplying_cd").alias("src"), F.col("delivering_cd").alias("dst")).distinct()


def cd_store_edges(plan: DataFrame) -> DataFrame:
    """Distinct delivering CD -> store pairs, both non-NULL (a self-loop stays)."""
    rows = plan.where(F.col("delivering_cd").isNotNull() & F.col("store").isNotNull())
    return rows.select(F.col("delivering_cd").alias("src"), F.col("store").alias("dst")).distinct()


def plan_edges(plan: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G1 and G2 from one pass over ``plan``: ``cd_cd_edges``, ``cd_store_edges`` and the number of
    plan lines (one row, ``total_records``), read from the distinct pairs, which are stored.

    A line gives a pair of each kind, and equal pairs meet before they are shuffled. Whatever
    reads edges more than once reads files instead of the joins that a plan may be."""
    ends = {"cd": ("supplying_cd", "delivering_cd"), "store": ("delivering_cd", "store")}
    types = {c: _type(plan, c) for pair in ends.values() for c in pair}
    one = next(iter(types.values())) if len(set(types.values())) == 1 else "string"
    pairs = plan.select(
        F.explode(F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.col(a).cast(one).alias("src"), F.col(b).cast(one).alias("dst")) for kind, (a, b) in ends.items()
        ])).alias("x")
    ).groupBy("x.kind", "x.src", "x.dst").agg(F.count(F.lit(1)).alias("lines"))
    pairs = _stored(pairs)

    def of(kind: str) -> DataFrame:
        known = pairs.where((F.col("kind") == kind) & F.col("src").isNotNull() & F.col("dst").isNotNull())
        return known.select(*[F.col(c).cast(types[n]).alias(c) for c, n in zip(("src", "dst"), ends[kind])])

    lines = pairs.where(F.col("kind") == "store").agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("total_records"))
    return _stored(of("cd").where(F.col("src") != F.col("dst"))), of("store"), lines


def plan_profile(plan: DataFrame) -> DataFrame:
    """Line counts and distinct ids of the supply plan (one row)."""
    a, e, s = F.col("supplying_cd"), F.col("delivering_cd"), F.col("store")
    cd_cd = a.isNotNull() & e.isNotNull() & (a != e)
    cd_store = e.isNotNull() & s.isNotNull()
    own = a.isNotNull() & (a == e) & s.isNotNull()
    other = cd_cd & s.isNotNull()
    lines = plan.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(cd_cd).alias("cd_cd_lines"),
        F.count_if(cd_store).alias("cd_store_lines"),
        F.count_if(own).alias("own_store_lines"),
        F.count_if(other).alias("other_cd_lines"),
    )
    # Distinct ids one by one (no Expand of every line), from the distinct edges where they hold them.
    cds, stores = cd_cd_edges(plan), cd_store_edges(plan)
    return lines.select(
        "total_lines",
        "cd_cd_lines",
        distinct_scalar(cds, "src").alias("cd_cd_suppliers"),
        distinct_scalar(cds, "dst").alias("cd_cd_receivers"),
        "cd_store_lines",
        distinct_scalar(stores, "src").alias("cd_store_cds"),
        distinct_scalar(stores, "dst").alias("cd_store_stores"),
        "own_store_lines",
        "other_cd_lines",
        distinct_scalar(plan, "supplying_cd").alias("distinct_supplying_cds"),
    )


# --------------------------------------------------------------------------- G4 G5 G6

def graph_nodes(edges: DataFrame) -> DataFrame:
    """Distinct end points, column ``node``."""
    e = _edges(edges)
    return e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct()


def density(edges: DataFrame) -> DataFrame:
    """Nodes, edges and directed density m / (n (n - 1)); 0 when n <= 1."""
    e = _edges(edges).distinct()
    n = graph_nodes(e).agg(F.count(F.lit(1)).alias("n")).scalar()
    m = e.agg(F.count(F.lit(1)).alias("m"))
    dens = F.when(n > 1, F.col("m") / (n * (n - 1)).cast("double")).otherwise(F.lit(0.0))
    return m.select(n.alias("nodes"), F.col("m").alias("edges"), dens.alias("density"))


#: Values of ``_ends``' ``open``: edges from, to, and both from and to other nodes.
OPEN_IN, OPEN_OUT, OPEN_BOTH = 1, 2, 3


def _ends(edges: DataFrame) -> DataFrame:
    """Per node its edges in and out, and in ``open`` on which sides other nodes are."""
    e = _edges(edges).withColumn("other", F.coalesce(F.col("src") != F.col("dst"), F.lit(False)))
    ends = e.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), F.when(F.col("other"), OPEN_OUT).otherwise(0).alias("open")),
                F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), F.when(F.col("other"), OPEN_IN).otherwise(0).alias("open")),
            )
        ).alias("x")
    ).select("x.*")
    return ends.groupBy("node").agg(F.sum("i").cast("long").alias("in_degree"), F.sum("o").cast("long").alias("out_degree"), F.bit_or("open").alias("open"))


def stored_ends(edges: DataFrame) -> DataFrame:
    """What ``scc`` and the node tables need of every node, from one pass over the edges."""
    return _stored(_ends(edges))


def degrees(edges: DataFrame) -> DataFrame:
    """In, out and total degree per node (a self-loop adds one to each of in and out)."""
    return _degrees(_ends(edges))


def _degrees(ends: DataFrame) -> DataFrame:
    return ends.select("node", (F.col("in_degree") + F.col("out_degree")).alias("degree"), "in_degree", "out_degree")


# --------------------------------------------------------------------------- G7 G8

#: Trimming or contracting goes on while a round takes at least this share of the nodes.
WORTH = 8


class _Contracted:
    """Paths of nodes with one edge in and one out, taken out of a graph: ``members (node,
    start)`` and ``paths (start, before, after)``, the nodes around the path."""

    def __init__(self, members: DataFrame, paths: DataFrame) -> None:
        self.members, self.paths = members, paths

    def labelled(self, labels: DataFrame) -> DataFrame:
        """The members' components, given those of the other nodes: a path lies in a cycle just
        if it starts and ends at one component; otherwise each of its nodes is alone."""
        ends = [labels.select(F.col("node").alias(n), F.col("scc_id").alias(f"c_{n}")) for n in ("before", "after")]
        paths = self.paths.join(ends[0], "before").join(ends[1], "after")
        closed = paths.where(F.col("c_before") == F.col("c_after")).select("start", F.col("c_before").alias("scc_id"))
        return self.members.join(closed, "start", "left").select("node", F.coalesce("scc_id", "node").alias("scc_id"))


def _contract(e: DataFrame, active: DataFrame, n_active: int):
    """Takes the paths out of ``e``: ``(edges, active, contracted, rings)``, or None where they
    hold too few nodes. ``rings`` are closed paths, components of their own.

    Every node of a path finds the path's start by pointer doubling, so rounds grow with the
    logarithm of the longest path. Only nodes that are still on their way are joined, and
    pointers of those are distinct, so a path with a third of all nodes is no hot key."""
    none = F.lit(None).cast(_type(e, "src"))
    ends = e.select(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"), F.col("src").alias("before"), none.alias("after")).unionByName(
        e.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"), none.alias("before"), F.col("dst").alias("after"))
    )
    sums = [F.sum("i").alias("i"), F.sum("o").alias("o"), F.max("before").alias("before"), F.max("after").alias("after")]
    inner, obs = ends.groupBy("node").agg(*sums).where("i = 1 AND o = 1").select("node", "before", "after"), Observation()
    inner = _stored(inner.observe(obs, F.count(F.lit(1)).alias("rows")))
    n_inner = int(obs.get["rows"])
    if n_inner * WORTH < n_active:
        return None
    also = inner.select(F.col("node").alias("other"), F.lit(True).alias("is_inner"))
    known = (
        inner.join(also.select(F.col("other").alias("before"), F.col("is_inner").alias("from_inner")), "before", "left")
        .join(also.select(F.col("other").alias("after"), F.col("is_inner").alias("to_inner")), "after", "left")
    )
    known = _stored(known.select("node", "before", "after", F.coalesce("from_inner", F.lit(False)).alias("from_inner"), F.coalesce("to_inner", F.lit(False)).alias("to_inner")))
    walk = known.select("node", F.when(F.col("from_inner"), F.col("before")).otherwise(F.col("node")).alias("at"), F.col("node").alias("most"), (~F.col("from_inner")).alias("done"))
    arrived, open_, hops = [walk.where("done")], walk.where("NOT done"), 1
    while hops < 2 * n_inner:
        ahead = reduce(DataFrame.unionByName, [*arrived, open_]).select(F.col("node").alias("at"), F.col("at").alias("to"), F.col("most").alias("more"), F.col("done").alias("there"))
        moved = open_.join(ahead, "at").select("node", F.col("to").alias("at"), F.greatest("most", "more").alias("most"), F.col("there").alias("done"))
        obs = Observation()
        moved = _stored(moved.observe(obs, F.count_if(~F.col("done")).alias("open")))
        arrived.append(moved.where("done"))
        open_, hops = moved.where("NOT done"), 2 * hops
        if not obs.get["open"]:
            break
    members = _stored(reduce(DataFrame.unionByName, arrived).select("node", F.col("at").alias("start")))
    paths = members.join(known, "node").groupBy("start").agg(
        F.max(F.when(F.col("node") == F.col("start"), F.col("before"))).alias("before"), F.max(F.when(~F.col("to_inner"), F.col("after"))).alias("after")
    )
    paths = _stored(paths)
    gone = inner.select("node")
    rest = e.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
    across = paths.where(F.col("before") != F.col("after")).select(F.col("before").alias("src"), F.col("after").alias("dst"))
    edges = _stored(rest.select("src", "dst").unionByName(across).distinct())
    return edges, active.join(gone, "node", "left_anti"), _Contracted(members, paths), open_.select("node", F.col("most").alias("scc_id"))


def scc(edges: DataFrame, hub_edges: int | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Strongly connected component of every node: (node, scc_id, scc_size).

    ``scc_id`` is the largest node id of the component. A node alone, with or without a
    self-loop, is its own component of size 1.

    Long paths cost the logarithm of their length: nodes with one edge in and one out are
    contracted to an edge (``_contract``) and take their component from the ends of their path
    afterwards. Nodes without an edge in or out are trimmed. What is left is coloured. Each
    round writes the rows that it changed.

    The first trim needs no more than ``ends`` (``stored_ends(edges)``; computed if not given), and
    only the edges between nodes that it leaves are written.
    """
    ends = stored_ends(edges) if ends is None else ends
    found: list[DataFrame] = [ends.where(F.col("open") != OPEN_BOTH).select("node", F.col("node").alias("scc_id"))]
    contracted: list[_Contracted] = []
    active, n_active, size = _ckpt_nodes(ends.where(F.col("open") == OPEN_BOTH).select("node"))
    if n_active:
        e = _ckpt(_restrict(_edges(edges).where(F.col("src") != F.col("dst")), _small(active, size)).distinct())
    restricted = True  # e has only edges between active nodes

    while n_active:
        # Trim and contract: each round reads two checkpointed leaves (edges, active nodes):
        # constant-size plans.
        while n_active:
            live, restricted = e if restricted else _restrict(e, _small(active, size)), False
            ends = live.select(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(
                live.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"))
            )
            # A node without an in-edge or an out-edge inside the active graph is alone.
            kept = ends.groupBy("node").agg(F.max("i").alias("i"), F.max("o").alias("o")).where((F.col("i") == 1) & (F.col("o") == 1))
            kept, n_kept, kept_size = _ckpt_nodes(kept.select("node"))
            trimmed = n_active - n_kept
            if trimmed:
                alone = active.join(kept, "node", "left_anti")
                found.append(alone.select("node", F.col("node").alias("scc_id")))
            active, n_before, n_active, size = kept, n_active, n_kept, kept_size
            if not n_active or trimmed * WORTH >= n_before:
                continue
            e = _ckpt(_restrict(e, _small(active, size)))
            shorter = _contract(e, active, n_active)
            if shorter is None:
                if not trimmed:
                    break
                continue
            e, rest, paths, rings = shorter
            found.append(rings)
            contracted.append(paths)
            active, n_active, size = _ckpt_nodes(rest)
        if not n_active:
            break

        # Forward: colour = largest id that reaches the node. Colours only grow, so a node's
        # colour is the largest of its deltas.
        out_edges = _Layout(e, "src", "dst", hub_edges)
        start = active.select("node", F.col("node").alias("color"))
        colors = _Deltas(start, lambda df: df.groupBy("node").agg(F.max("color").alias("color")))
        frontier = start
        while True:
            cand = out_edges.step(frontier.withColumnRenamed("node", "src"))
            both = cand.select(F.col("dst").alias("node"), F.col("color").alias("new"), F.lit(None).cast(_type(start, "color")).alias("old")).unionByName(
                colors.all().select("node", F.lit(None).cast(_type(start, "color")).alias("new"), F.col("color").alias("old"))
            )
            grown = both.groupBy("node").agg(F.max("new").alias("new"), F.max("old").alias("old")).where(F.col("new") > F.col("old"))
            frontier, n_changed = _ckpt_sized(grown.select("node", F.col("new").alias("color")))
            if n_changed == 0:
                break
            colors.add(frontier)
        color, _, size = _ckpt_nodes(colors.merge(colors.all()))

        # Backward: the component of root c = nodes of colour c that reach c inside colour c.
        src_c = color.select(F.col("node").alias("src"), F.col("color").alias("c1"))
        dst_c = color.select(F.col("node").alias("dst"), F.col("color").alias("c2"))
        src_c, dst_c = _small(src_c, size), _small(dst_c, size)
        same = _ckpt(e.join(src_c, "src").join(dst_c, "dst").where(F.col("c1") == F.col("c2")).select("src", "dst"))
        in_edges = _Layout(same, "dst", "src", hub_edges)
        roots = color.where(F.col("node") == F.col("color"))
        marked = _Deltas(roots, lambda df: df.distinct())
        frontier = roots
        while True:
            preds = in_edges.step(frontier.withColumnRenamed("node", "dst")).select(F.col("src").alias("node"), "color")
            both = preds.withColumn("old", F.lit(0)).unionByName(marked.all().withColumn("old", F.lit(1)))
            fresh = both.groupBy("node", "color").agg(F.max("old").alias("old")).where(F.col("old") == 0).drop("old")
            frontier, n_new = _ckpt_sized(fresh)
            if n_new == 0:
                break
            marked.add(frontier)
        done, _, size = _ckpt_nodes(marked.merge(marked.all()))
        found.append(done.select("node", F.col("color").alias("scc_id")))

        # Nodes of one component share a colour: drop the found ones and cross-colour edges.
        active, n_active, size = _ckpt_nodes(active.join(_small(done.select("node"), size), "node", "left_anti"))
        e = same  # cross-colour edges dropped; restricted in the trim

    members = reduce(DataFrame.unionByName, found)
    for paths in reversed(contracted):
        members = _stored(members)
        members = members.unionByName(paths.labelled(members))
    # A label is some node of the component; its largest may have been contracted.
    sizes = members.groupBy("scc_id").agg(F.count(F.lit(1)).alias("scc_size"), F.max("node").alias("largest"))
    return members.join(sizes, "scc_id").select("node", F.col("largest").alias("scc_id"), "scc_size")


def _type(df: DataFrame, col: str):
    return df.schema[col].dataType


def _restrict(e: DataFrame, nodes: DataFrame) -> DataFrame:
    keep_src = nodes.select(F.col("node").alias("src"))
    keep_dst = nodes.select(F.col("node").alias("dst"))
    return e.join(keep_src, "src", "left_semi").join(keep_dst, "dst", "left_semi")


def scc_summary(components: DataFrame) -> DataFrame:
    """Components, with / without cycles, nodes in cycles, largest cycle (0 if none).

    A component is a cycle when it has more than one node (a lone self-loop is not).
    """
    per = components.select("scc_id", "scc_size").distinct()
    cyc = F.col("scc_size") > 1
    return per.agg(
        F.count(F.lit(1)).alias("total_sccs"),
        F.count_if(cyc).alias("sccs_with_cycles"),
        F.count_if(~cyc).alias("isolated_sccs"),
        F.coalesce(F.sum(F.when(cyc, F.col("scc_size"))), F.lit(0)).cast("long").alias("nodes_in_cycles"),
        F.coalesce(F.max(F.when(cyc, F.col("scc_size"))), F.lit(0)).cast("long").alias("largest_cycle"),
    )


# --------------------------------------------------------------------------- G9 G10

def sources(edges: DataFrame) -> DataFrame:
    """Nodes without an incoming edge."""
    e = _edges(edges)
    return graph_nodes(e).join(e.select(F.col("dst").alias("node")), "node", "left_anti")


def cd_levels(edges: DataFrame, hub_edges: int | None = None) -> DataFrame:
    """level = max over sources of the BFS (shortest) distance from that source.

    Nodes reachable from no source are absent. Without any source every node is level 0.

    All sources search at once: a source is a bit, 64 of them a word, and a node's row per word
    holds the sources that have reached it. A round ORs the frontier's new bits over the edges
    and keeps those that a node lacks; a source reaches a node first in the round of its
    distance, so a node's level is the last round in which it gained a bit.
    """
    e, _ = _ckpt_sized(_edges(edges).distinct())
    srcs, n_src = _ckpt_sized(sources(e).withColumn("id", F.monotonically_increasing_id()))
    if n_src == 0:
        return graph_nodes(e).select("node", F.lit(0).cast("long").alias("level"))
    bit = F.expr("shiftleft(1L, CAST(id & 63 AS INT))")
    first = srcs.select("node", F.shiftright("id", 6).alias("word"), bit.alias("bits"), F.lit(0).cast("long").alias("level"))
    merged = [F.bit_or("bits").alias("bits"), F.max("level").alias("level")]
    reached = _Deltas(first, lambda df: df.groupBy("node", "word").agg(*merged))
    layout = _Layout(e, "src", "dst", hub_edges)
    frontier, level, none = first, 0, F.lit(0).cast("long")
    while True:
        level += 1
        cand = layout.step(frontier.select(F.col("node").alias("src"), "word", "bits"))
        both = cand.select(F.col("dst").alias("node"), "word", F.col("bits").alias("new"), none.alias("old")).unionByName(
            reached.all().select("node", "word", none.alias("new"), F.col("bits").alias("old"))
        )
        seen = both.groupBy("node", "word").agg(F.bit_or("new").alias("new"), F.bit_or("old").alias("old"))
        fresh = seen.select("node", "word", F.col("new").bitwiseAND(F.bitwise_not("old")).alias("bits"), F.lit(level).cast("long").alias("level"))
        frontier, n_new = _ckpt_sized(fresh.where(F.col("bits") != 0))
        if n_new == 0:
            break
        reached.add(frontier)
    return reached.all().groupBy("node").agg(F.max("level").alias("level"))


def store_levels(edges: DataFrame) -> DataFrame:
    """Multi-source BFS from every node with out-degree > 0 (level 0); every other node
    has an in-edge from such a node, so it is level 1. Closed form, no iteration."""
    return store_levels_of(degrees(edges))


def store_levels_of(nodes: DataFrame) -> DataFrame:
    """``store_levels`` from nodes with their ``out_degree``."""
    return nodes.select("node", F.when(F.col("out_degree") > 0, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("level"))


def hierarchy_summary(levels: DataFrame, n_sources: Column) -> DataFrame:
    """Sources, maximum depth, distinct levels (one row); see ``level_distribution``."""
    return levels.agg(
        F.coalesce(F.max("level"), F.lit(0)).cast("long").alias("max_depth"),
        F.countDistinct("level").alias("distinct_levels"),
    ).select(n_sources.alias("sources"), "max_depth", "distinct_levels")


def level_distribution(levels: DataFrame) -> DataFrame:
    """A10: number of nodes per level."""
    return levels.groupBy("level").agg(F.count(F.lit(1)).alias("nodes"))


# --------------------------------------------------------------------------- G11 G12 U1

def node_metrics(cd_edges: DataFrame, store_edges: DataFrame) -> DataFrame:
    """G11 + U1: one row per node and graph: node, node_type, graph, degrees, level,
    scc_size, in_cycle. A node present in both graphs has two rows (as in the reference)."""
    return cd_cd_nodes(cd_edges).unionByName(cd_store_nodes(store_edges))


def _graph_nodes_table(edges: DataFrame, levels: DataFrame, graph: str, node_type: Column, comps: DataFrame | None, ends: DataFrame) -> DataFrame:
    comps = (comps if comps is not None else scc(edges, ends=ends)).select("node", "scc_id", "scc_size")
    base = _degrees(ends).join(comps, "node", "left").join(levels, "node", "left")
    size = F.coalesce(F.col("scc_size"), F.lit(1)).cast("long")
    return base.select(
        "node",
        node_type.alias("node_type"),
        F.lit(graph).alias("graph"),
        "degree",
        "in_degree",
        "out_degree",
        F.coalesce(F.col("level"), F.lit(0)).cast("long").alias("level"),
        size.alias("scc_size"),
        (size > 1).alias("in_cycle"),
        F.coalesce(F.col("scc_id"), F.col("node")).alias("scc_id"),
    )


def cd_cd_nodes(cd_edges: DataFrame, levels: DataFrame | None = None, comps: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Node rows of the CD->CD graph (``levels`` = G9, ``comps`` = G7 output, ``ends`` =
    ``stored_ends``; computed if not given)."""
    lv = levels if levels is not None else cd_levels(cd_edges)
    return _graph_nodes_table(cd_edges, lv, CD_CD, F.lit(CD), comps, ends if ends is not None else stored_ends(cd_edges))


def cd_store_nodes(store_edges: DataFrame, levels: DataFrame | None = None, comps: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Node rows of the CD->store graph: a node with out-edges is a CD, otherwise a store."""
    ends = ends if ends is not None else stored_ends(store_edges)
    kind = F.when(F.col("out_degree") > 0, F.lit(CD)).otherwise(F.lit(STORE))
    lv = levels if levels is not None else store_levels_of(ends)
    return _graph_nodes_table(store_edges, lv, CD_STORE, kind, comps, ends)


def edge_table(cd_edges: DataFrame, store_edges: DataFrame) -> DataFrame:
    """G12 + U1: origin, destination, edge_type, origin_type, destination_type."""

    def tag(e: DataFrame, kind: str, dst_type: str) -> DataFrame:
        return _edges(e).select(
            F.col("src").alias("origin"),
            F.col("dst").alias("destination"),
            F.lit(kind).alias("edge_type"),
            F.lit(CD).alias("origin_type"),
            F.lit(dst_type).alias("destination_type"),
        )

    return tag(cd_edges, CD_CD, CD).unionByName(tag(store_edges, CD_STORE, STORE))


# --------------------------------------------------------------------------- A11 T3

def network_totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node rows, edge rows, CD rows, store rows, rows in cycles; plus distinct CD ids
    (a CD in both graphs is two rows, Q19)."""
    n_edges = edges.agg(F.count(F.lit(1))).scalar()
    return nodes.agg(
        F.count(F.lit(1)).alias("total_nodes"),
        F.count_if(F.col("node_type") == CD).alias("cd_rows"),
        F.count_if(F.col("node_type") == STORE).alias("store_rows"),
        F.count_if(F.col("in_cycle")).alias("nodes_in_cycles"),
        F.countDistinct(F.when(F.col("node_type") == CD, F.col("node"))).alias("cd_distinct"),
    ).select("total_nodes", n_edges.alias("total_edges"), "cd_rows", "store_rows", "nodes_in_cycles", "cd_distinct")


def top_degree(edges: DataFrame, side: str = "src", k: int = 10) -> DataFrame:
    """The k ids with the most edges on one side (``src`` = out-degree / stores served,
    ``dst`` = in-degree), ties by id."""
    return value_counts(_edges(edges).select(F.col(side).alias("node")), "node", k, name="edges")


def top_nodes(nodes: DataFrame, k: int = 10) -> DataFrame:
    """Node rows with the largest total degree (ties by graph, then id)."""
    return nodes.orderBy(F.col("degree").desc(), F.col("graph").asc(), F.col("node").asc()).limit(k)


# --------------------------------------------------------------------------- G15 J9

def network_layout(nodes: DataFrame) -> DataFrame:
    """Drawing attributes of each node row: y = max level - level (max over the whole
    table, a scalar subquery), x = (degree % 10) * 0.2 - 1, colour, size, label."""
    max_level = nodes.agg(F.max("level")).scalar()
    deg = F.col("degree")
    colour = F.when(F.col("in_cycle"), F.lit("red")).when(F.col("node_type") == CD, F.lit("blue")).otherwise(F.lit("green"))
    label = F.format_string(
        "<b>%s</b><br>Tipo: %s<br>Grafo: %s<br>Grau Total: %d<br>Grau Entrada: %d<br>Grau Saída: %d"
        "<br>Nível Hierárquico: %d<br>SCC Size: %d<br>Em Ciclo: %s",
        F.col("node").cast("string"), F.col("node_type"), F.col("graph"), deg, F.col("in_degree"),
        F.col("out_degree"), F.col("level"), F.col("scc_size"),
        F.when(F.col("in_cycle"), F.lit("Sim")).otherwise(F.lit("Não")),
    )
    return nodes.select(
        "node",
        "graph",
        ((deg % 10).cast("double") * 0.2 - 1.0).alias("x"),
        (max_level - F.col("level")).alias("y"),
        colour.alias("colour"),
        F.greatest(F.lit(10), F.least(F.lit(50), deg * 2)).cast("long").alias("size"),
        label.alias("label"),
    )


def edge_coordinates(edges: DataFrame, layout: DataFrame) -> DataFrame:
    """Both end points of every edge in the layout. An id with two layout rows uses the
    first one (the CD->CD row); edges with a missing end are skipped."""
    rank = F.when(F.col("graph") == CD_CD, F.lit(0)).otherwise(F.lit(1))
    pos = layout.select("node", rank.alias("_rank"), "x", "y")
    best = pos.groupBy("node").agg(F.min(F.struct("_rank", "x", "y")).alias("p")).select("node", "p.x", "p.y")
    o = best.select(F.col("node").alias("origin"), F.col("x").alias("x0"), F.col("y").alias("y0"))
    d = best.select(F.col("node").alias("destination"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    return edges.select("origin", "destination").join(o, "origin").join(d, "destination").select(
        "origin", "destination", "x0", "y0", "x1", "y1"
    )
