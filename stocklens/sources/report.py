"""Network report as JSON (S5 read, S6 write).

The reference writes one JSON document holding the statistics and two arrays (edges and
nodes). Packing the arrays into one document moves the whole network through one process,
so the writer here produces a folder:

    <path>/report/      one JSON line: the statistics row (bounded size)
    <path>/connections/ JSON lines, one per edge  (written in parallel)
    <path>/nodes/       JSON lines, one per node  (written in parallel)

Key names and value types follow the reference's document. The reader accepts both this
folder and a single document in the reference's layout (``multiLine``), whose arrays are
exploded back into rows by ``report_edges`` / ``report_nodes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key names of the published document.
L, S, D, B = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()
COUNTS = T.MapType(S, L)

EDGE = T.StructType([T.StructField(n, S) for n in ("origem", "destino", "tipo", "origem_tipo", "destino_tipo")])
NODE = T.StructType(
    [T.StructField("id", S), T.StructField("tipo", S), T.StructField("grafo", S)]
    + [T.StructField(n, L) for n in ("grau_total", "grau_entrada", "grau_saida", "nivel_hierarquico")]
    + [T.StructField("em_ciclo", B), T.StructField("scc_size", L)]
)


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


REPORT = _struct(
    [
        ("metadata", _struct([("tipo_analise", S), ("data_processamento", S), ("tabela_origem", S), ("total_registros_processados", L)])),
        (
            "estatisticas_gerais",
            _struct(
                [("total_nos", L), ("total_arestas", L), ("total_conexoes", L), ("densidade", D), ("nos_visualizados", L),
                 ("arestas_visualizadas", L), ("cds_unicos", L), ("lojas_unicas", L), ("nos_em_ciclos", L)]
            ),
        ),
        (
            "analise_cd_cd",
            _struct([("cds_unicos_atendem", L), ("cds_unicos_atendidos", L), ("total_conexoes", L),
                     ("top_cds_por_grau_saida", COUNTS), ("top_cds_por_grau_entrada", COUNTS)]),
        ),
        ("complexidade_cd_cd", _struct([("total_sccs", L), ("sccs_com_ciclos", L), ("sccs_isoladas", L), ("cds_em_ciclos", L), ("maior_ciclo", L)])),
        ("hierarquia_cd_cd", _struct([("cds_fonte", L), ("profundidade_maxima", L), ("niveis_unicos", L), ("distribuicao_niveis", COUNTS)])),
        (
            "analise_cd_loja",
            _struct([("cds_unicos_entregam", L), ("lojas_unicas_atendidas", L), ("total_conexoes", L), ("top_cds_por_lojas_atendidas", COUNTS)]),
        ),
        ("complexidade_cd_loja", _struct([("total_sccs", L), ("sccs_com_ciclos", L), ("sccs_isoladas", L), ("filiais_em_ciclos", L), ("maior_ciclo", L)])),
        ("hierarquia_cd_loja", _struct([("cds_no_grafo", L), ("profundidade_maxima", L), ("niveis_unicos", L), ("distribuicao_niveis", COUNTS)])),
        ("conexoes", T.ArrayType(EDGE)),
        ("nos", T.ArrayType(NODE)),
    ]
)


def read_network_report(spark: SparkSession, path: str) -> DataFrame:
    """A report document in the reference's layout (one multi-line JSON file), with an
    explicit schema; keys missing from a document read as NULL."""
    return spark.read.schema(REPORT).option("multiLine", "true").json(path)


def report_edges(report: DataFrame) -> DataFrame:
    """Edges of a report document as rows (origem, destino, tipo, origem_tipo, destino_tipo)."""
    return report.select(F.inline("conexoes"))


def report_nodes(report: DataFrame) -> DataFrame:
    """Nodes of a report document as rows."""
    return report.select(F.inline("nos"))


def edges_as_report_rows(edges: DataFrame) -> DataFrame:
    """Edge table (G12) in the report's key names, ids as strings."""
    return edges.select(
        F.col("origin").cast("string").alias("origem"),
        F.col("destination").cast("string").alias("destino"),
        F.col("edge_type").alias("tipo"),
        F.col("origin_type").alias("origem_tipo"),
        F.col("destination_type").alias("destino_tipo"),
    )


def nodes_as_report_rows(nodes: DataFrame) -> DataFrame:
    """Node table (G11) in the report's key names, ids as strings."""
    return nodes.select(
        F.col("node").cast("string").alias("id"),
        F.col("node_type").alias("tipo"),
        F.col("graph").alias("grafo"),
        F.col("degree").alias("grau_total"),
        F.col("in_degree").alias("grau_entrada"),
        F.col("out_degree").alias("grau_saida"),
        F.col("level").alias("nivel_hierarquico"),
        F.col("in_cycle").alias("em_ciclo"),
        F.col("scc_size").alias("scc_size"),
    )


#: Edges and nodes that one document may hold; a larger network is written as a folder.
DOCUMENT_ROWS = 1_000_000


def write_report_document(report: DataFrame, nodes: DataFrame, edges: DataFrame, path: str, rows: int = DOCUMENT_ROWS, mode: str = "overwrite") -> None:
    """S6 as one document of the published layout: the statistics with the arrays ``conexoes``
    and ``nos`` inside, sorted. For exchange: one document is made by one process, so a
    network of more than ``rows`` edges and nodes is refused (``write_network_report`` has no
    such bound)."""
    arcs, points = edges_as_report_rows(edges), nodes_as_report_rows(nodes)
    size = arcs.select(F.lit(1)).unionAll(points.select(F.lit(1))).limit(rows + 1).count()
    if size > rows:
        raise ValueError(f"more than {rows} edges and nodes for one document; write_network_report has no bound")

    def packed(df: DataFrame) -> Column:
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns)))).scalar()

    whole = report.select("*", packed(arcs).alias("conexoes"), packed(points).alias("nos"))
    whole.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_network_report(report: DataFrame, nodes: DataFrame, edges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Statistics row + edge and node datasets as UTF-8 JSON lines under ``path``."""
    report.coalesce(1).write.mode(mode).json(f"{path}/report")
    edges_as_report_rows(edges).write.mode(mode).json(f"{path}/connections")
    nodes_as_report_rows(nodes).write.mode(mode).json(f"{path}/nodes")


def read_written_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read back what ``write_network_report`` wrote: (report, edges, nodes)."""
    return (
        spark.read.schema(REPORT).json(f"{path}/report"),
        spark.read.schema(EDGE).json(f"{path}/connections"),
        spark.read.schema(NODE).json(f"{path}/nodes"),
    )
