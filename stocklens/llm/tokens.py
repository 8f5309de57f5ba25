"""Token counts of flat, unindexed token files by scanning for the end-of-document id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocklens.llm.bpe import encoded

#: The end-of-document id. Its two bytes, high byte first, are one character of UTF-8, so that
#: Spark's own text writer can lay it between records; vocabularies must end below it.
END = 0xC480
END_TEXT = "Ā"
#: A document's stream begins with its id, 13 bits a word, so that files need no index; HEAD_NULL for no id.
HEAD, HEAD_BITS, HEAD_NULL = 5, 13, 1 << 13
#: Ids searched at once.
BLOCK = 1 << 20
#: Documents of a file: bounds what one task holds (about 10 MB of ids for ordinary documents).
FILE_DOCUMENTS = 4096


def head_words(doc) -> list[int]:
    if doc is None:
        return [HEAD_NULL] * HEAD
    return [(doc >> (HEAD_BITS * i)) & (HEAD_NULL - 1) for i in range(HEAD)]


def head_value(words: np.ndarray):
    if words[0] == HEAD_NULL:
        return None
    value = sum(int(w) << (HEAD_BITS * i) for i, w in enumerate(words)) % (1 << 64)
    return value - (1 << 64) if value >= 1 << 63 else value


def _streams(path: str):
    def run(batches):
        for batch in batches:
            docs = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for row, ids, offsets in encoded(batch, path):
                if len(ids) and int(ids.max()) >= END:
                    raise ValueError(f"the vocabulary has ids of {END} and more")
                wide = ids.astype(">u2")
                out = [
                    np.array(head_words(docs[row + i]), dtype=">u2").tobytes() + wide[offsets[i] : offsets[i + 1]].tobytes()
                    for i in range(len(offsets) - 1)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write flat files of big-endian 16-bit ids: per document its id, its tokens, ``END``.

    Spark's text writer lays them, so they land wherever Spark can write and a task that is
    run again leaves no half files. Null texts are empty; null ids are kept."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    streams = rows.mapInArrow(_streams(tokenizer), "value binary").select(F.col("value").cast("string"))
    streams.write.option("lineSep", END_TEXT).option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)


def _separators(block: int):
    """Per file and block: documents that end in it, and at its end the document that is open."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(content.as_buffer(), dtype=">u2")
                out: list[list] = [[], [], [], [], []]
                for number, begin in enumerate(range(0, len(ids), block)):
                    ends = begin + np.flatnonzero(ids[begin : begin + block] == END)
                    begins = np.append(ends + 1, np.int64(0))[:-1] if len(ends) else ends
                    starts = [0 if begin == 0 else None, *begins.tolist()]  # a block doesn't know what came before it
                    stops = [*ends.tolist(), None]
                    for place, (start, stop) in enumerate(zip(starts, stops, strict=True)):
                        if start is None or start < len(ids):
                            out[0].append(number)
                            out[1].append(place)
                            out[2].append(None if start is None else head_value(ids[start : start + HEAD].astype(np.int64)))
                            out[3].append(start)
                            out[4].append(stop)
                names = ["path", "block", "place", "doc_id", "start", "stop"]
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(out[0]), pa.string()), *(pa.array(x, pa.int64()) for x in out)], names=names)

    return run


def count_tokens(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_tokens)`` of every document in the token files under ``path``.

    Each file is searched block by block, all separators of a block at once. A document that
    runs over blocks is stitched by a prefix scan: the piece that has an end but no start takes
    the last start before it in its file, however many blocks lie between. An empty folder gives
    no rows; a document cut off before its end id is not counted."""
    files = spark.read.format("binaryFile").load(path)
    found = files.select("path", "content").mapInArrow(_separators(block), "path string, block long, place long, doc_id long, start long, stop long")
    before = Window.partitionBy("path").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, 0)
    stitched = found.select(
        F.last(F.when(F.col("start").isNotNull(), F.struct("doc_id", "start")), ignorenulls=True).over(before).alias("open"), "stop"
    )
    return stitched.where("stop IS NOT NULL").select("open.doc_id", (F.col("stop") - F.col("open.start") - HEAD).alias("n_tokens"))
