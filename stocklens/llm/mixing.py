"""Temperature mixing of sources to target weights, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import word_count, written

#: Halvings of the exponent's interval [0, 1].
STEPS = 24
#: Tokens of a block, about; blocks are permuted, and documents in them.
BLOCK_TOKENS = 1 << 18


def _key(seed: int, *parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])), 1, 16)


def exponent(sizes: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, steps: int = STEPS) -> float:
    """The exponent t of the weights share^t, found by bisection of [0, 1]; 1 leaves the shares.

    ``max_repetition``: the smallest t at which no source is repeated more than so many times
    as often as the largest one. ``target_entropy`` (a part of the logarithm of the number of
    sources): the largest t at which the weights' entropy is at least that. A step is one
    aggregate over the sources; a few numbers come back."""
    total, most, least, n = sizes.agg(F.sum("tokens"), F.max("tokens"), F.min("tokens"), F.count("*")).first()
    if not n:
        return 1.0
    if max_repetition is not None:
        low, high = 0.0, 1.0
        if (most / least) <= max_repetition:
            return 0.0
        for _ in range(steps):
            mid = (low + high) / 2
            over = sizes.agg(F.max(F.pow(F.lit(float(most)) / F.col("tokens"), F.lit(1 - mid))) > max_repetition).first()[0]
            low, high = (mid, high) if over else (low, mid)
        return high
    if not target_entropy:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))

    def flat_enough(t: float) -> bool:
        z, zl = sizes.agg(F.sum(F.pow(share, F.lit(t))), F.sum(F.pow(share, F.lit(t)) * F.lit(t) * F.log(share))).first()
        return math.log(z) - zl / z >= target_entropy * math.log(n)

    low, high = 0.0, 1.0
    if flat_enough(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if flat_enough(mid) else (low, mid)
    return low


def plan(
    docs: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: float | None = None,
    seed: int = 0, block_tokens: int = BLOCK_TOKENS, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row a source: its tokens, exponent, weight, whole epochs, and where its last epoch stops.

    ``budget`` is the number of tokens of the mixture; without one it is the least that has
    every document at least once. A source's budget is spent on whole epochs, then on the
    blocks of one more, in their permuted order; the block in which it ends is cut between
    documents. So a permuted epoch's used part is what sorts up to ``(last_block, last_doc)``.
    """
    slim = written(docs.select(*_row(source_col, id_col, text_col)), "mixing")
    sizes = written(slim.groupBy("key").agg(F.sum("tokens").alias("tokens")), "mixing-sources")
    t = exponent(sizes, target_entropy, max_repetition)
    total, most = sizes.agg(F.sum("tokens"), F.max("tokens")).first()
    share = F.col("tokens") / F.lit(float(total or 1))
    z = sizes.agg(F.sum(F.pow(share, F.lit(t)))).first()[0] or 1.0
    weight = F.pow(share, F.lit(t)) / F.lit(z)
    epochs = F.pow(F.lit(float(most or 1)) / F.col("tokens"), F.lit(1 - t)) if budget is None else weight * F.lit(float(budget)) / F.col("tokens")
    goals = written(
        sizes.select(
            "key", "tokens", F.lit(t).alias("exponent"), F.round(weight, 9).alias("weight"), F.floor(epochs * F.col("tokens")).alias("goal"),
            F.ceil(F.col("tokens") / block_tokens).alias("blocks"),
        ).withColumn("epochs", F.floor(F.col("goal") / F.col("tokens")))
        .withColumn("rest", F.col("goal") - F.col("epochs") * F.col("tokens")),
        "mixing-goals",
    )
    last = slim.join(goals.select("key", "blocks", "epochs", "rest"), "key").where("rest > 0")
    keyed = last.select("key", "tokens", "rest", *keys(seed, F.col("epochs")))
    spent = Window.partitionBy("key").orderBy("block_key")
    blocks = keyed.groupBy("key", "block_key").agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
    ends = (
        blocks.withColumn("upto", F.sum("n").over(spent)).where("upto > rest")
        .groupBy("key").agg(F.min(F.struct("block_key", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))).alias("end"))
        .select("key", F.col("end.block_key").alias("block_key"), F.col("end.left").alias("left"))
    )
    # Only the documents of one block a source are left here.
    inside = keyed.join(ends, ["key", "block_key"]).withColumn("upto", F.sum("tokens").over(Window.partitionBy("key").orderBy("doc_key")))
    cuts = ends.join(inside.where("upto <= left").groupBy("key").agg(F.max("doc_key").alias("last_doc")), "key", "left")
    return goals.join(cuts.select("key", F.col("block_key").alias("last_block"), F.coalesce("last_doc", F.lit("")).alias("last_doc")), "key", "left")


def _row(source_col: str, id_col: str, text_col: str) -> list[Column]:
    return [
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("key"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("name"),
        (word_count(F.col(f"`{text_col}`")) + 1).cast("long").alias("tokens"),
    ]


def keys(seed: int, epoch: Column, key: str = "key", name: str = "name") -> list[Column]:
    """Sort keys of a row in an epoch: of its block, and of itself in the block. The block
    of a document stays, its place changes with the epoch. Needs ``blocks``, its source's number of blocks."""
    spread = F.conv(F.substring(F.md5(F.col(name)), 1, 8), 16, 10).cast("long")
    block = F.pmod(spread, F.col("blocks"))
    return [_key(seed, F.col(key), epoch, block).alias("block_key"), _key(seed, epoch, F.col(name)).alias("doc_key")]


def mix(docs: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None, budget: float | None = None, seed: int = 0, block_tokens: int = BLOCK_TOKENS, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as often as the mixture has them, with ``mix_epoch``, ``mix_block``, ``mix_doc``,
    ``mix_tokens``, ``mix_exponent`` and ``mix_weight``.

    Token shares of the sources are raised to an exponent (see ``exponent``), and the
    normalised weights are met by whole epochs and permuted blocks (see ``plan``). Sorted by
    the first three columns the rows are the mixture in training order. A document counts its
    words and one for its end, so an empty or null text counts one. Null and empty sources are
    one source; documents with equal (or null) ids share a place and stay or go together;
    repeated rows are mixed as rows of their own. Columns of ``docs`` are kept as they are; one
    that has the name of ours is replaced. An empty table gives no rows.

    Texts are never shuffled: a row's number of copies follows from its own hash and its
    source's row of the plan, which Spark broadcasts if it is small and else joins.
    """
    columns = docs.columns
    told = plan(docs, target_entropy, max_repetition, budget, seed, block_tokens, source_col, id_col, text_col)
    told = written(told.withColumnRenamed("tokens", "source_tokens"), "mixing-plan")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), *_row(source_col, id_col, text_col)).join(told, "key")
    here = row.select("*", *keys(seed, F.col("epochs")))
    within = (F.col("block_key") < F.col("last_block")) | ((F.col("block_key") == F.col("last_block")) & (F.col("doc_key") <= F.col("last_doc")))
    copies = F.col("epochs") + F.when(F.coalesce(within, F.lit(False)), 1).otherwise(0)
    each = here.withColumn("copies", copies).where("copies > 0").select(
        "row", "key", "name", "blocks", "tokens", "exponent", "weight", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("mix_epoch")
    )
    block_key, doc_key = keys(seed, F.col("mix_epoch"))
    own = ("mix_epoch", "mix_block", "mix_doc", "mix_tokens", "mix_exponent", "mix_weight")
    return each.select(
        *[F.col("row").getField(c).alias(c) for c in columns if c not in own], "mix_epoch", block_key.alias("mix_block"), doc_key.alias("mix_doc"),
        F.col("tokens").alias("mix_tokens"), F.col("exponent").alias("mix_exponent"), F.col("weight").alias("mix_weight"),
    )
