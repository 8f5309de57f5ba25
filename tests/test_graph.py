import json
import os
import random

import pytest
from pyspark.sql import functions as F

from stocklens.operators import graph as G
from stocklens.sources import report as R

# The golden case, the 25 edges of the reference's only output document (FIXTURES.md section 2).
GOLDEN = {
    "1200": "1088 1400 1401 1445 1475 1500 1600 1624 1635 1760 1895",
    "1400": "1673 1887 2241",
    "1401": "1640",
    "1475": "1445 1624",
    "1887": "1454 1736 1792 1875 1877 1999",
    "1895": "0022 1778",
}


def golden(spark):
    rows = [(s, d) for s, ds in GOLDEN.items() for d in ds.split()]
    return spark.createDataFrame(rows, "src string, dst string")


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def test_golden_network(spark):
    e = golden(spark)
    d = G.density(e).first()
    assert (d.nodes, d.edges, d.density) == (24, 25, 0.04528985507246377)
    lv = G.cd_levels(e)
    assert dict(G.level_distribution(lv).collect()) == {0: 1, 1: 11, 2: 6, 3: 6}
    levels = dict(lv.collect())
    assert levels["1445"] == 1 and levels["1624"] == 1  # shortest path, not longest (Q21)
    s = G.scc_summary(G.scc(e)).first()
    assert (s.total_sccs, s.sccs_with_cycles, s.nodes_in_cycles, s.largest_cycle) == (24, 0, 0, 0)
    out = dict(G.top_degree(e, "src").collect())
    assert out == {"1200": 11, "1887": 6, "1400": 3, "1475": 2, "1895": 2, "1401": 1}
    inn = G.top_degree(e, "dst").collect()
    assert [(r.node, r.edges) for r in inn[:2]] == [("1445", 2), ("1624", 2)]
    hs = G.hierarchy_summary(lv, G.sources(e).agg(F.count(F.lit(1))).scalar()).first()
    assert (hs.sources, hs.max_depth, hs.distinct_levels) == (1, 3, 4)


def test_cycles_self_loops_and_sources(spark):
    e = edges(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 6), (7, 1)])
    comps = {r.node: (r.scc_id, r.scc_size) for r in G.scc(e).collect()}
    assert comps[1] == comps[2] == comps[3] == (3, 3)
    assert comps[4] == comps[5] == (5, 2)
    assert comps[6] == (6, 1)  # a lone self-loop is not a cycle
    assert sum(1 for _ in comps) == 7
    levels = dict(G.cd_levels(e).collect())
    assert levels == {7: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5}  # 6 reachable from no source: absent
    deg = {r.node: (r.in_degree, r.out_degree, r.degree) for r in G.degrees(e).collect()}
    assert deg[6] == (1, 1, 2)  # self-loop adds one to in and out


def test_pure_cycle_without_source_is_all_level_zero(spark):
    e = edges(spark, [(1, 2), (2, 3), (3, 1)])
    assert sorted(G.cd_levels(e).collect()) == [(1, 0), (2, 0), (3, 0)]
    assert G.scc_summary(G.scc(e)).first().largest_cycle == 3


def test_scc_sizes_sum_to_node_count_and_condensation_is_acyclic(spark):
    pairs = [(i, (i * 7 + 3) % 40) for i in range(40)] + [(i, (i + 1) % 40) for i in range(0, 40, 3)]
    e = edges(spark, pairs)
    comps = G.scc(e)
    n = G.graph_nodes(e).count()
    sizes = comps.select("scc_id", "scc_size").distinct().agg(F.sum("scc_size")).first()[0]
    assert sizes == n == comps.count()
    c = comps.select("node", "scc_id")
    cond = (
        e.join(c.withColumnRenamed("node", "src").withColumnRenamed("scc_id", "a"), "src")
        .join(c.withColumnRenamed("node", "dst").withColumnRenamed("scc_id", "b"), "dst")
        .where("a <> b").select("a", "b").distinct()
    )
    # the condensation has no cycle: every one of its components is a single node
    assert G.scc(cond.withColumnRenamed("a", "src").withColumnRenamed("b", "dst")).where("scc_size > 1").count() == 0


def test_node_in_both_graphs_and_store_levels(spark):
    plan = spark.createDataFrame(
        [(1, 2, 100), (2, 2, 101), (1, 3, 2), (None, 4, 102), (3, 3, 3)],
        "supplying_cd long, delivering_cd long, store long",
    )
    cd = G.cd_cd_edges(plan)
    st = G.cd_store_edges(plan)
    assert sorted(map(tuple, cd.collect())) == [(1, 2), (1, 3)]
    assert (3, 3) in set(map(tuple, st.collect()))  # CD delivering to itself stays
    nodes = G.node_metrics(cd, st).collect()
    node2 = [r for r in nodes if r.node == 2]
    assert {r.graph for r in node2} == {G.CD_CD, G.CD_STORE}  # listed once per graph (U1)
    lv = dict(G.store_levels(st).collect())
    assert lv[2] == 0 and lv[100] == 1 and lv[3] == 0
    prof = G.plan_profile(plan).first()
    assert (prof.total_lines, prof.cd_cd_lines, prof.own_store_lines, prof.other_cd_lines) == (5, 2, 2, 2)


def test_report_write_and_read_back(spark, scratch):
    from stocklens.plans import network as N

    plan = spark.createDataFrame(
        [(s, d, 900) for s, ds in GOLDEN.items() for d in ds.split()],
        "supplying_cd string, delivering_cd string, store int",
    ).withColumn("store", F.col("store").cast("string"))
    net = N.build_network(plan)
    rep = N.network_report(net)
    R.write_network_report(rep, net.nodes, net.edges, f"{scratch}/net")
    r, e, n = R.read_written_report(spark, f"{scratch}/net")
    row = r.first()
    assert row.hierarquia_cd_cd.profundidade_maxima == 3
    assert row.hierarquia_cd_cd.distribuicao_niveis == {"0": 1, "1": 11, "2": 6, "3": 6}
    assert row.analise_cd_cd.top_cds_por_grau_saida["1200"] == 11
    assert e.where("tipo = 'CD→CD'").count() == 25
    assert n.where("grafo = 'CD→CD'").count() == 24


def test_read_reference_layout_document(spark, scratch):
    doc = {
        "metadata": {"tipo_analise": "CD→CD", "data_processamento": "2025-01-01 00:00:00",
                     "tabela_origem": "plan", "total_registros_processados": 3},
        "estatisticas_gerais": {"total_nos": 3, "total_arestas": 2, "densidade": 0.3333333333333333},
        "hierarquia_cd_cd": {"cds_fonte": 1, "profundidade_maxima": 1, "niveis_unicos": 2,
                             "distribuicao_niveis": {"0": 1, "1": 2}},
        "conexoes": [{"origem": "1", "destino": "0022", "tipo": "CD→CD", "origem_tipo": "CD", "destino_tipo": "CD"},
                     {"origem": "1", "destino": "3", "tipo": "CD→CD", "origem_tipo": "CD", "destino_tipo": "CD"}],
        "nos": [{"id": "0022", "tipo": "CD", "grau_total": 1, "grau_entrada": 1, "grau_saida": 0,
                 "nivel_hierarquico": 1, "em_ciclo": False, "scc_size": 1}],
    }
    path = os.path.join(scratch, "doc.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=2, ensure_ascii=False)
    rep = R.read_network_report(spark, path)
    assert rep.first().estatisticas_gerais.total_arestas == 2
    e = R.report_edges(rep)
    assert sorted(r.destino for r in e.collect()) == ["0022", "3"]  # leading zeros kept
    recomputed = G.density(e.select(F.col("origem").alias("src"), F.col("destino").alias("dst"))).first()
    assert recomputed.density == doc["estatisticas_gerais"]["densidade"]
    assert R.report_nodes(rep).first().id == "0022"


def test_hub_edges_are_split_and_results_stay(spark):
    """A hub with most edges: its edges lie in several parts, and a lower bound changes nothing."""
    import random

    rnd = random.Random(3)
    edges = [(0, i) for i in range(1, 400)] + [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(i, 0) for i in range(300, 310)] + [(900, 0), (901, 5)]
    df = spark.createDataFrame(edges, "src long, dst long")
    layout = G._Layout(df, "src", "dst", hub_edges=50)
    assert layout.edges.where("src = 0").select("part").distinct().count() >= 8
    whole = {tuple(r) for r in G.cd_levels(df).collect()}
    assert whole == {tuple(r) for r in G.cd_levels(df, hub_edges=20).collect()}
    assert {tuple(r) for r in G.scc(df).collect()} == {tuple(r) for r in G.scc(df, hub_edges=20).collect()}


def test_levels_of_many_sources_and_long_chain(spark):
    """More sources than bits of a word, over a chain longer than a compaction."""
    edges = [(1000 + i, i % 7) for i in range(150)] + [(i, i + 1) for i in range(25)]
    levels = {r.node: r.level for r in G.cd_levels(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert levels == {**{1000 + i: 0 for i in range(150)}, **{i: i + 1 for i in range(26)}}


def components_by_hand(pairs):
    """Mutual reachability by search from every node."""
    out, nodes = {}, {x for p in pairs for x in p}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)

    def reach(start):
        seen, todo = set(), [start]
        while todo:
            for y in out.get(todo.pop(), ()):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return seen

    ahead = {x: reach(x) | {x} for x in nodes}
    groups = {x: {y for y in ahead[x] if x in ahead[y]} for x in nodes}
    return {x: (max(g), len(g)) for x, g in groups.items()}


def found(df):
    return {r.node: (r.scc_id, r.scc_size) for r in df.collect()}


def test_contracted_paths_equal_brute_force(spark):
    rng = random.Random(7)
    shapes = [
        [(k, k + 1) for k in range(9)] + [(9, 0), (4, 20), (20, 21), (21, 3), (5, 30), (30, 31)],  # ears and tails on a ring
        [(1, 9), (9, 2), (2, 8), (8, 1), (2, 7), (7, 2), (3, 1)],  # two rings in one node
        [(k, (k + 1) % 7) for k in range(7)] + [(10 + k, 10 + (k + 1) % 5) for k in range(5)] + [(99, 99)],  # closed paths
        [(0, 1), (1, 0), (1, 2), (2, 3), (3, 2)],
    ]
    for _ in range(8):
        n = rng.randint(6, 40)
        pairs = {(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(n // 2, 2 * n))}
        # Long paths between and off the random nodes.
        for k in range(5):
            a, b, steps = rng.randrange(n), rng.randrange(n), [1000 * (k + 1) + j for j in rng.sample(range(500), rng.randint(1, 9))]
            pairs |= set(zip([a, *steps], [*steps, b]))
        shapes.append(sorted(pairs))
    # All in one graph, as parts that don't meet.
    pairs = [(a + 10_000 * k, b + 10_000 * k) for k, shape in enumerate(shapes) for a, b in shape]
    assert found(G.scc(edges(spark, pairs))) == components_by_hand(pairs)


def test_long_chain_and_ring_take_few_rounds(spark, monkeypatch):
    rounds = []
    for name in ("_ckpt", "_stored"):
        monkeypatch.setattr(G, name, lambda df, real=getattr(G, name): rounds.append(1) or real(df))
    n = 10_000
    label = lambda c: (F.col(c) * 7919 % n).cast("long").alias(c)  # noqa: E731  ids in no order along the path
    chain = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")).select(label("src"), label("dst"))
    assert G.scc(chain).where("scc_size = 1 AND node = scc_id").count() == n
    assert len(rounds) < 40
    rounds.clear()
    ring = spark.range(n).select(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst")).select(label("src"), label("dst"))
    assert G.scc(ring).groupBy("scc_id", "scc_size").count().collect() == [(n - 1, n, n)]
    assert len(rounds) < 40


def counted(spark, rows, schema):
    """A plan, and how many of its rows have been made so far."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, schema).mapInArrow(count, schema), made


PLAN = "supplying_cd long, delivering_cd long, store long"
LINES = [(1, 2, 100), (1, 2, 100), (2, 2, 101), (1, 3, 2), (None, 4, 102), (3, 3, 3), (2, None, 100), (3, 1, None)]


@pytest.mark.parametrize("name", ["a11_network_totals", "t3_top_nodes", "g11_node_metrics", "g15_network_layout", "j9_edge_coordinates", "s5_read_network_report"])
def test_network_queries_make_the_plan_once(spark, monkeypatch, name):
    from stocklens.plans.registry import REGISTRY
    from stocklens.sources import testdata

    plan, made = counted(spark, LINES, PLAN)
    monkeypatch.setattr(testdata, "supply_plan_network", lambda *_: plan)
    assert REGISTRY[name](spark, "unused").count()
    assert made.value == len(LINES)


def test_plan_edges_equal_the_edges_one_by_one(spark):
    plan = spark.createDataFrame([(a and f"0{a}", b and f"0{b}", c) for a, b, c in LINES], "supplying_cd string, delivering_cd string, store int")
    cd, st, lines = G.plan_edges(plan)
    for found, one in ((cd, G.cd_cd_edges(plan)), (st, G.cd_store_edges(plan))):
        assert found.dtypes == one.dtypes
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, one.collect()))
    assert lines.first().total_records == len(LINES)


def test_a_plan_without_lines_is_refused(spark):
    from stocklens.plans import network as N

    with pytest.raises(ValueError, match="supply plan rows"):
        N.build_network(spark.createDataFrame([], PLAN))


def test_only_edges_between_nodes_open_on_both_sides_are_written(spark, monkeypatch):
    sizes = []
    real = G._ckpt
    monkeypatch.setattr(G, "_ckpt", lambda df: sizes.append((df.columns, (out := real(df)).count())) or out)
    e = edges(spark, [(c, 100 + s) for c in range(5) for s in range(40)] + [(1, 2), (2, 1), (7, 7), (None, 3), (3, None)])
    assert found(G.scc(e).where("node IN (1, 2, 7, 100)")) == {1: (2, 2), 2: (2, 2), 7: (7, 1), 100: (100, 1)}
    assert max(n for c, n in sizes if "src" in c) == 2
