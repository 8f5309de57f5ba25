"""Network silver: node / edge tables, per-graph statistics and the report."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.dates import timestamp_of
from stocklens.operators import graph as G
from stocklens.operators import quality
from stocklens.session import ensure_checkpoint_dir

PLAN_TABLE = "supply plan"


@dataclass
class Network:
    """The analysed network of one supply plan. The edges and the iterative results (levels, node
    tables) are written once in ``build_network``; every output reuses them. ``lines`` is the
    number of plan lines (one row, ``total_records``)."""

    lines: DataFrame
    cd_edges: DataFrame
    store_edges: DataFrame
    cd_levels: DataFrame
    store_levels: DataFrame
    cd_nodes: DataFrame
    store_nodes: DataFrame

    @property
    def nodes(self) -> DataFrame:
        """Node rows of both graphs (without the internal ``scc_id``)."""
        return self.cd_nodes.unionByName(self.store_nodes).drop("scc_id")

    @property
    def edges(self) -> DataFrame:
        """G12 + U1: edge rows of both graphs."""
        return G.edge_table(self.cd_edges, self.store_edges)


def build_network(plan: DataFrame, concurrent: bool = True) -> Network:
    """G1 G2 G6 G7 G9 G10 G11 over one plan.

    The three iterative computations (BFS levels of the CD->CD graph, components of each
    graph) are independent; with ``concurrent`` they are driven from three threads, so
    Spark runs their jobs side by side in the same application (each round is small and
    latency-bound, so they overlap well; on a cluster the FAIR scheduler shares executors).
    """
    ensure_checkpoint_dir(plan.sparkSession)
    cd_edges, store_edges, lines = G.plan_edges(plan)
    quality.require_rows(lines.where(F.col("total_records") > 0), what="supply plan rows")
    cd_ends, store_ends = G.stored_ends(cd_edges), G.stored_ends(store_edges)
    loops = {
        "cd_levels": lambda: G.cd_levels(cd_edges).checkpoint(eager=True),
        "cd_scc": lambda: G.scc(cd_edges, ends=cd_ends).checkpoint(eager=True),
        "store_scc": lambda: G.scc(store_edges, ends=store_ends).checkpoint(eager=True),
    }
    if concurrent:
        with ThreadPoolExecutor(max_workers=len(loops)) as pool:
            futures = {name: pool.submit(fn) for name, fn in loops.items()}
            done = {name: f.result() for name, f in futures.items()}
    else:
        done = {name: fn() for name, fn in loops.items()}
    cd_levels = done["cd_levels"]
    store_levels = G.store_levels_of(store_ends)
    cd_nodes = G.cd_cd_nodes(cd_edges, cd_levels, done["cd_scc"], cd_ends).checkpoint(eager=True)
    store_nodes = G.cd_store_nodes(store_edges, store_levels, done["store_scc"], store_ends).checkpoint(eager=True)
    return Network(lines, cd_edges, store_edges, cd_levels, store_levels, cd_nodes, store_nodes)


def _entries_map(df: DataFrame, key: str, value: str) -> Column:
    """A bounded frame (top-k rows, or one row per level) as a map, via a scalar subquery."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value))))).scalar()


def _one(df: DataFrame, col: str) -> Column:
    return df.select(col).scalar()


def _sides(nodes: DataFrame) -> DataFrame:
    """Distinct senders and receivers, and edges, of a graph's node table (one row)."""
    return nodes.agg(
        F.count_if(F.col("out_degree") > 0).alias("senders"),
        F.count_if(F.col("in_degree") > 0).alias("receivers"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"),
    )


def _top(nodes: DataFrame, degree: str, k: int = 10) -> Column:
    """``top_degree`` as a map, from the node table: a row per node instead of one per edge."""
    some = nodes.where(F.col(degree) > 0).orderBy(F.col(degree).desc(), F.col("node").asc()).limit(k)
    return _entries_map(some, "node", degree)


def _scc_struct(nodes: DataFrame, in_cycles_name: str) -> Column:
    summary = G.scc_summary(nodes)
    return F.struct(
        _one(summary, "total_sccs").alias("total_sccs"),
        _one(summary, "sccs_with_cycles").alias("sccs_com_ciclos"),
        _one(summary, "isolated_sccs").alias("sccs_isoladas"),
        _one(summary, "nodes_in_cycles").alias(in_cycles_name),
        _one(summary, "largest_cycle").alias("maior_ciclo"),
    )


def _hier_struct(levels: DataFrame, n_sources: Column, sources_name: str) -> Column:
    hier = G.hierarchy_summary(levels, n_sources)
    return F.struct(
        _one(hier, "sources").alias(sources_name),
        _one(hier, "max_depth").alias("profundidade_maxima"),
        _one(hier, "distinct_levels").alias("niveis_unicos"),
        _entries_map(G.level_distribution(levels), "level", "nodes").alias("distribuicao_niveis"),
    )


def network_report(net: Network, processed_at: dt.datetime | None = None, source_table: str = PLAN_TABLE) -> DataFrame:
    """One row of nested statistics. The key names and labels, which must
    equal those of the published JSON report.

    Every value is an aggregate attached as a scalar subquery; the per-node and per-edge
    arrays are not packed into this row (they grow with the network): ``write_network_report``
    writes them as datasets of their own next to it.
    """
    totals = G.network_totals(net.nodes, net.edges)
    ts = timestamp_of(processed_at)
    cd, st = _sides(net.cd_nodes), _sides(net.store_nodes)
    n_sources = net.cd_nodes.agg(F.count_if(F.col("in_degree") == 0)).scalar()
    n_store_cds = _one(st, "senders")
    return net.lines.select(
        F.struct(
            F.lit(G.BOTH_GRAPHS).alias("tipo_analise"),
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("data_processamento"),
            F.lit(source_table).alias("tabela_origem"),
            F.col("total_records").alias("total_registros_processados"),
        ).alias("metadata"),
        F.struct(
            _one(totals, "total_nodes").alias("total_nos"),
            _one(totals, "total_edges").alias("total_conexoes"),
            _one(totals, "cd_rows").alias("cds_unicos"),
            _one(totals, "store_rows").alias("lojas_unicas"),
            _one(totals, "nodes_in_cycles").alias("nos_em_ciclos"),
        ).alias("estatisticas_gerais"),
        F.struct(
            _one(cd, "senders").alias("cds_unicos_atendem"),
            _one(cd, "receivers").alias("cds_unicos_atendidos"),
            _one(cd, "edges").alias("total_conexoes"),
            _top(net.cd_nodes, "out_degree").alias("top_cds_por_grau_saida"),
            _top(net.cd_nodes, "in_degree").alias("top_cds_por_grau_entrada"),
        ).alias("analise_cd_cd"),
        _scc_struct(net.cd_nodes, "cds_em_ciclos").alias("complexidade_cd_cd"),
        _hier_struct(net.cd_levels, n_sources, "cds_fonte").alias("hierarquia_cd_cd"),
        F.struct(
            n_store_cds.alias("cds_unicos_entregam"),
            _one(st, "receivers").alias("lojas_unicas_atendidas"),
            _one(st, "edges").alias("total_conexoes"),
            _top(net.store_nodes, "out_degree").alias("top_cds_por_lojas_atendidas"),
        ).alias("analise_cd_loja"),
        _scc_struct(net.store_nodes, "filiais_em_ciclos").alias("complexidade_cd_loja"),
        _hier_struct(net.store_levels, n_store_cds, "cds_no_grafo").alias("hierarquia_cd_loja"),
    )
