"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``docs``, whatever further columns it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm import line_dedup, mixing, packing, quality, simhash
from stocklens.llm.common import on_workers, table, written
from stocklens.llm.queries import tokenizer

#: Documents with at least this chance of a good label stay.
MIN_QUALITY = 0.5
#: No source is repeated more than so often as the largest one.
MAX_REPETITION = 2.0
#: The classifier's stage can't be expressed in SQL.
ORACLE_SQL = None

_OURS = ("doc_id", "text", "source")


def _carried(docs: DataFrame) -> DataFrame:
    """``doc_id, text, source`` and the other columns as one, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in _OURS]
    return docs.select(*_OURS, F.struct(F.lit(True).alias("carried"), *rest).alias("rest"))


def _restored(rows: DataFrame, like: DataFrame) -> list[Column]:
    return [F.col(c) if c in _OURS else F.col("rest").getField(c).alias(c) for c in like.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from the labelled documents; those it rejects go.

    A text without n-grams (null or empty) gets the model's score for nothing. Without labels
    of both kinds every document scores alike; if that is below the mark the label says so."""
    model = quality.train(quality.labelled(docs, table(spark, sf_dir, "labels")))
    return quality.score(_carried(docs), model).where(F.col("score") >= MIN_QUALITY).select(*_restored(docs, docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup; a document that had lines and has none left goes, null and empty texts stay."""
    done = line_dedup.dedup_lines(_carried(docs))
    return done.where("n_deleted = 0 OR n_deleted < n_lines").select(*_restored(done, docs))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup; of each component of fingerprints one row stays: the one with the
    smallest id, then the smallest hash of its text. A row without an id stays only where no
    other row of its component has one. Ids decide nothing else, so different texts under one
    id stay or go each with its own component."""
    rows = simhash.marked(docs, shingle=3, radius=3)
    doc = F.col("row.doc_id")
    best = F.min(F.struct(doc.isNull().alias("none"), doc.alias("id"), F.xxhash64("row.text").alias("hash"), "place"))
    kept = rows.groupBy("group").agg(best.alias("best")).select(F.col("best.place").alias("place"))
    # One row a component, which grows with the corpus: by shuffle at every size.
    return rows.join(kept.hint("merge"), "place", "left_semi").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Temperature mixing; rows come in the order of the mixture, documents of the smaller
    sources more than once, every document at least once."""
    mixed = mixing.mix(_carried(docs), max_repetition=MAX_REPETITION)
    order = ("mix_epoch", "mix_block", "mix_doc")
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*_restored(mixed, docs))


def in_file_order(docs: DataFrame) -> DataFrame:
    """Rows of written files in the order in which the files and their rows were written: Spark
    deals files to tasks by size. Frames that are not read from files stay as they are."""
    if "_metadata" in docs.columns or not docs.inputFiles():
        return docs
    placed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "_metadata.file_name", "_metadata.row_index")
    order = ("file_name", "row_index")
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of sequences with their token ids, a task's sequences from documents
    that stand together in the mixture."""
    return packing.pack_documents(in_file_order(docs), tokenizer(), end_id=1)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", keep_one_of_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; rows as ``packing.SCHEMA`` has them."""
    on_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
