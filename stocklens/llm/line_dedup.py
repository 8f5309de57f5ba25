"""Line dedup: repeated runs of lines found in a suffix array of line ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.llm.common import written

#: A repeated run counts from this many words.
MIN_WORDS = 50
LINES = "doc long, u long, i int, n int, l1 long, l2 long, forth int, back int"
POSITION = ("doc", "u", "i")


def _lines(min_words: int):
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc, u, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if text is None:
                    continue
                lines = text.encode().split(b"\n")
                n = len(lines)
                ids = np.frombuffer(b"".join(map(xxhash.xxh128_digest, lines)), dtype="<i8").reshape(-1, 2)
                upto = np.concatenate([[0], np.cumsum([len(line.split()) for line in lines])])
                ahead = np.searchsorted(upto, upto[:-1] + min_words) - np.arange(n)
                forth = np.where(upto[:-1] + min_words <= upto[-1], ahead, 0)
                start = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
                back = np.where(upto[1:] >= min_words, np.arange(1, n + 1) - start, 0)
                for column, values in zip(out, ([doc] * n, [u] * n, range(n), [n] * n, ids[:, 0], ids[:, 1], forth, back), strict=True):
                    column.extend(values)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            names = [x.split()[0] for x in LINES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return run


def _starts(keys: tuple[str, ...], prefixes: tuple[int, ...]):
    """Over sorted rows: the place in this partition where the group of each key prefix begins,
    and whether a row is surely alone with its key."""

    def run(batches):
        pid, seen, before, begun, waiting = TaskContext.get().partitionId(), 0, None, [0] * len(prefixes), None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
            place = seen + np.arange(batch.num_rows)
            starts, new = [], np.zeros(batch.num_rows, dtype=bool)
            for p, prefix in enumerate(prefixes):
                new = np.zeros(batch.num_rows, dtype=bool)
                for c, column in enumerate(columns[:prefix]):
                    new[1:] |= column[1:] != column[:-1]
                    new[0] |= before is None or column[0] != before[c]
                start = np.maximum.accumulate(np.where(new, place, begun[p]))
                begun[p] = int(start[-1])
                starts.append(start)
            if waiting is not None:
                yield _ended(*waiting, bool(new[0]))
            waiting = (batch, pid, starts, new, seen == 0)
            before, seen = [c[-1] for c in columns], seen + batch.num_rows
        if waiting is not None:
            yield _ended(*waiting, False)

    return run


def _ended(batch, pid, starts, new, first, next_new) -> pa.RecordBatch:
    alone = new & np.append(new[1:], next_new)
    if first:
        alone[0] = False  # the partition before may hold its key, too
    columns = [*batch.columns, pa.array(np.full(batch.num_rows, pid, dtype=np.int32)), *(pa.array(s, pa.int64()) for s in starts), pa.array(alone)]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "pid", *(f"start{p}" for p in range(len(starts))), "alone"])


def in_order(rows: DataFrame, keys: tuple[str, ...], prefixes: tuple[int, ...], name: str) -> DataFrame:
    """``rows`` with ``place0``, ``place1``, ...: how many rows sort before the group that
    shares the first ``prefixes[p]`` of ``keys``; and ``alone``, true for most keys of one row.

    Rows are range-partitioned by the keys and then by position, so that a group of any size is
    spread; each task numbers its own rows, and a scan over the tasks' counts and last keys (a
    row a task) makes the numbers global, also for a group that runs over tasks."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*keys, *POSITION).sortWithinPartitions(*keys, *POSITION)
    schema = StructType(list(ranged.schema))
    for column in ("pid integer", *(f"start{p} long" for p in range(len(prefixes))), "alone boolean"):
        schema = schema.add(column.split()[0], column.split()[1])
    numbered = written(ranged.mapInArrow(_starts(keys, prefixes), schema), name)
    tasks = numbered.groupBy("pid").agg(
        F.count("*").alias("n"), F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high"),
        *[F.max(f"start{p}").alias(f"last{p}") for p in range(len(prefixes))],
    ).collect()
    offset, last, table = 0, None, []
    for t in sorted(tasks, key=lambda t: t.pid):
        carried = []
        for p, prefix in enumerate(prefixes):
            goes_on = last is not None and tuple(t.low)[:prefix] == last[0][:prefix]
            carried.append(last[1][p] if goes_on else offset)
        table.append((t.pid, offset, *carried))
        last = (tuple(t.high), [carried[p] if t[f"last{p}"] == 0 else offset + t[f"last{p}"] for p in range(len(prefixes))])
        offset += t.n
    firsts = spark.createDataFrame(table, "pid int, offset long" + "".join(f", carried{p} long" for p in range(len(prefixes))))
    places = [F.when(F.col(f"start{p}") == 0, F.col(f"carried{p}")).otherwise(F.col("offset") + F.col(f"start{p}")).alias(f"place{p}") for p in range(len(prefixes))]
    return numbered.join(F.broadcast(firsts), "pid").select(*rows.columns, *places, "alone")  # a row a task


def suffix_ranks(lines: DataFrame, name: str = "suffixes") -> list[DataFrame]:
    """Prefix doubling: per level k a frame ``(doc, u, i, rank, alone, last)`` whose rank orders
    the suffixes by their first 2^k lines and is the same for those that share them.

    ``lines (doc, u, i, n, l1, l2, need)``: a line is its 128-bit id, suffixes end with their
    document. Level k + 1 sorts the pairs of ranks at i and i + 2^k. Suffixes that are alone, or
    have ended, keep their rank, which is their place in the suffix array, and are sorted no
    more. The sort goes on while suffixes that still share a rank have runs (``need`` lines)
    longer than what is sorted."""
    base = lines.select(*POSITION, "n", "need", "l1", "l2")
    first = in_order(base, ("l1", "l2"), (2,), f"{name}-0")
    now = first.select(*POSITION, "n", "need", (F.col("place0") + 1).alias("rank"), "alone", F.lit(False).alias("last"))
    levels, settled = [], None
    reach = 1
    while True:
        levels.append(now.select(*POSITION, "rank", "alone", "last"))
        open_ = now.where("NOT alone AND NOT last")
        if not (open_.agg(F.max("need")).first()[0] or 0) >= 2 * reach:
            return levels
        rest = now.where("alone OR last").select(*POSITION, "rank")
        settled = rest if settled is None else settled.unionAll(rest)
        ranks = settled.unionAll(open_.select(*POSITION, "rank"))
        ahead = ranks.select(F.col("doc").alias("doc2"), F.col("u").alias("u2"), (F.col("i") - reach).alias("i2"), F.col("rank").alias("next"))
        pairs = open_.join(ahead, F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("u") == F.col("u2")) & (F.col("i") == F.col("i2")), "left")
        pairs = pairs.select(*POSITION, "n", "need", "rank", F.coalesce("next", F.lit(0)).alias("next"))
        placed = in_order(written(pairs, f"{name}-pairs"), ("rank", "next"), (1, 2), f"{name}-{len(levels)}")
        now = placed.select(*POSITION, "n", "need", (F.col("rank") + F.col("place1") - F.col("place0")).alias("rank"), "alone", (F.col("next") == 0).alias("last"))
        reach *= 2


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc, u, start, length, first_doc, first_line)``: runs of lines that occur before.

    A run of just ``min_words`` words from some line on, or up to some line, is an interval of
    the suffix array whose common prefix is at least the run: two ranks of a power of two lines,
    which overlap, name it. All its members but the first by (document, line) are later copies.
    Together these runs cover exactly the maximal runs of ``min_words`` or more words that have
    begun before, at any earlier line, in any document."""
    lines = docs.mapInArrow(_lines(min_words), LINES)
    # Rows that repeat in id and text are one document: its lines are taken once, as each
    # doubling joins lines by their place.
    if not docs.where("text IS NOT NULL").groupBy("doc", "u").count().where("count > 1").isEmpty():
        lines = lines.dropDuplicates(POSITION)
    lines = written(lines, "lines")
    wanted = lines.select(
        *POSITION[:2], F.explode(F.array(
            F.struct("i", F.col("forth").alias("length")), F.struct((F.col("i") + 1 - F.col("back")).alias("i"), F.col("back").alias("length")),
        )).alias("run")
    ).select("doc", "u", "run.i", "run.length").where("length > 0").distinct()
    # What a line needs: the longest run from it. Lines inside runs need as much as the run has left,
    # which is never more; so the longest run of the lines that are still open is the bound.
    need = wanted.groupBy(*POSITION).agg(F.max("length").alias("need"))
    told = lines.alias("a").join(need.alias("b"), F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.u") == F.col("b.u")) & (F.col("a.i") == F.col("b.i")), "left")
    levels = suffix_ranks(written(told.select("a.doc", "a.u", "a.i", "n", "l1", "l2", F.coalesce("need", F.lit(0)).alias("need")), "lines-needed"))
    names = None
    for k, level in enumerate(levels):
        own = level.where("NOT alone").select(F.col("doc").alias("d"), F.col("u").alias("v"), F.col("i").alias("at"), F.lit(k).alias("level"), F.col("rank"))
        names = own if names is None else names.unionAll(own)
    names = written(names, "names")
    asked = wanted.withColumn("k", F.floor(F.log2("length") + 1e-9).cast("int")).where(F.col("k") < len(levels))

    def named(runs: DataFrame, at, name: str) -> DataFrame:
        where = F.col("doc").eqNullSafe(F.col("d")) & (F.col("u") == F.col("v")) & (at == F.col("at")) & (F.col("k") == F.col("level"))
        return runs.join(names, where).drop("d", "v", "at", "level").withColumnRenamed("rank", name)

    runs = named(asked, F.col("i"), "head")
    runs = written(named(runs, F.col("i") + F.col("length") - F.pow(F.lit(2), F.col("k")).cast("int"), "tail"), "runs")
    key = ["length", "head", "tail"]
    firsts = runs.groupBy(*key).agg(F.min(F.struct(*POSITION)).alias("first"), F.count("*").alias("members")).where("members > 1")
    later = runs.join(firsts.drop("members"), key).where(~F.struct(*POSITION).eqNullSafe(F.col("first")))
    return later.select("doc", "u", F.col("i").alias("start"), "length", F.col("first.doc").alias("first_doc"), F.col("first.i").alias("first_line"))


def _deleter(batches):
    for batch in batches:
        row, runs = batch.column(0), batch.column(1).to_pylist()
        texts, total, gone = [], [], []
        for text, mine in zip(row.field(row.type.get_field_index("text")).to_pylist(), runs, strict=True):
            lines = [] if text is None else text.split("\n")
            kept = np.ones(len(lines), dtype=bool)
            for r in mine or ():
                kept[r["start"] : r["start"] + r["length"]] = False
            texts.append(text if kept.all() else "\n".join(line for line, k in zip(lines, kept, strict=True) if k))
            total.append(len(lines))
            gone.append(int((~kept).sum()))
        yield pa.RecordBatch.from_arrays(
            [row, pa.array(texts, pa.string()), pa.array(total, pa.int32()), pa.array(gone, pa.int32()), batch.column(1)],
            names=["row", "new_text", "n_lines", "n_deleted", "deleted_runs"],
        )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs of lines deleted from ``text``, and
    ``n_lines``, ``n_deleted`` and ``deleted_runs (start, length, first_doc, first_line)``.

    A line goes if it lies in a run of consecutive lines of one document, of ``min_words`` or
    more words, that begins at an earlier place too: a smaller ``doc_id`` (null first), or a
    smaller line of the document; the copies may overlap. The first copy stays. Lines end at
    line feeds and are compared byte by byte.

    Rows are never dropped: a text whose lines all go is empty. Null texts stay null, an empty
    text is one empty line. Documents with one id are ordered by a hash of their texts; rows that
    repeat in id and text are one document and come out repeated and alike. Columns named like
    ours are replaced, others stay. An empty table gives no rows."""
    own = ("n_lines", "n_deleted", "deleted_runs")
    kept = [c for c in docs.columns if c not in own]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("u"), F.col("text").cast("string").alias("text"))
    runs = repeated_runs(slim, min_words).groupBy("doc", "u").agg(F.collect_list(F.struct("start", "length", "first_doc", "first_line")).alias("runs"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("doc_id").cast("long").alias("mine"), F.xxhash64("text").alias("hash"))
    both = rows.join(runs, F.col("mine").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("u")), "left").select("row", "runs")
    schema = StructType([both.schema["row"]]).add("new_text", "string").add("n_lines", "integer").add("n_deleted", "integer").add("deleted_runs", both.schema["runs"].dataType)
    out = both.mapInArrow(_deleter, schema)
    return out.select(*[F.col("new_text").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in kept], *own)
