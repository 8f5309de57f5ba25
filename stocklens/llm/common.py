"""Helpers shared by the operators: tables, shared scratch folders, connected components."""

from __future__ import annotations

import os
import uuid

import stocklens
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from stocklens.session import ensure_checkpoint_dir

#: Words everywhere are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: texts are long, and a task holds a few copies of a batch.
BATCH_ROWS = 1000


def on_workers(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, and let Python workers of one that was started
    elsewhere find this checkout (on a cluster the package is installed or sent with
    ``--py-files``; that part changes nothing there)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.abspath(stocklens.__file__)))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (root, known.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here and a lost
    executor costs only its running tasks. Parquet keeps it several times smaller than a
    checkpoint of rows."""
    spark = df.sparkSession
    on_workers(spark)
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for small frames."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def clash_free(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra columns, whatever their names, never meet ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node of ``edges (a, b)``.

    Large-star / small-star contraction: every node hands its neighbours to the smallest one,
    so the depth of a component shrinks by a power in each round and the edge count never
    grows. A node's neighbours are never gathered: each star is an aggregate and a join, and
    the join with a hot node is one that Spark may split. A round's edges are checkpointed;
    the loop ends when a round changes nothing, without a limit of rounds.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut(both)
    state = None
    while True:
        around = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
