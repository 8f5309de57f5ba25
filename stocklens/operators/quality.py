"""Data quality, de-duplication and run control.

Every check returns a DataFrame (one row or one row per finding); nothing is collected
inside an operator. ``require_rows`` is the only operator that runs an action: it is a
guard meant to stop a pipeline.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stocklens.params import RunParams
from stocklens.session import ensure_checkpoint_dir


# --------------------------------------------------------------------------- A5 / A7 / A8

def duplicate_keys(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """A5: keys that occur more than once, with their count (partial aggregation, skew-safe)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def distinct_keys(df: DataFrame, cols: tuple[str, ...] | list[str]) -> DataFrame:
    """Distinct combinations of ``cols``."""
    return df.select(*cols).distinct()


def distinct_count(df: DataFrame, cols: tuple[str, ...] | list[str]) -> DataFrame:
    """Number of distinct non-NULL values of each column (one row), in one pass over ``df``.

    A row becomes one small row a column, of which the map side keeps each value once before
    anything is shuffled, so a value that a third of all rows have is sent once a task."""
    return by_value(df, cols).agg(*distinct_values(cols))


def by_value(df: DataFrame, cols: tuple[str, ...] | list[str], **kept: Column) -> DataFrame:
    """A row for each value that ``column`` number so and so of ``cols`` has, in one pass over
    ``df``; the aggregates ``kept`` are taken over the first column's rows only."""
    every = df.select(*cols, *[c for c in df.columns if kept and c not in cols])
    types = {f.name: f.dataType for f in every.schema}

    def row(i: int) -> Column:
        own = lambda c, here: (F.col(c) if here else F.lit(None)).cast(types[c])
        return F.struct(
            F.lit(i).alias("column"), *[own(c, i == j).alias(f"value_{j}") for j, c in enumerate(cols)],
            *[own(c, i == 0).alias(c) for c in every.columns if c not in cols],
        )

    rows = every.select(F.explode(F.array(*[row(i) for i in range(len(cols))])).alias("row")).select("row.*")
    grouped = rows.groupBy("column", *[f"value_{j}" for j in range(len(cols))])
    return grouped.agg(*[a.alias(name) for name, a in kept.items()]) if kept else grouped.agg(F.count(F.lit(1)).alias("n"))


def distinct_values(cols: tuple[str, ...] | list[str], names: tuple[str, ...] | None = None) -> list[Column]:
    """The numbers of non-NULL values of ``cols``, over the rows of ``by_value``."""
    return [
        F.count_if((F.col("column") == i) & F.col(f"value_{i}").isNotNull()).alias(name)
        for i, name in enumerate(names or [f"distinct_{c}" for c in cols])
    ]


def distinct_scalar(df: DataFrame, col: str | Column) -> Column:
    """The number of distinct non-NULL values of ``col`` as a scalar subquery: for a plain scan,
    of which it reads the one column. ``distinct_count`` reads a dearer plan once for all."""
    values = df.select((F.col(col) if isinstance(col, str) else col).alias("v")).where("v IS NOT NULL").distinct()
    return values.agg(F.count(F.lit(1))).scalar()


def value_counts(df: DataFrame, col: str, k: int | None = None, name: str = "count") -> DataFrame:
    """Frequency of each value, highest first (ties by value); top ``k`` if given."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    ordered = counts.orderBy(F.col(name).desc(), F.col(col).asc())
    return ordered.limit(k) if k is not None else counts


def dedupe(
    df: DataFrame,
    keys: tuple[str, ...] | list[str],
    order: tuple[Column, ...] | list[Column] = (),
) -> DataFrame:
    """One row per key, deterministic survivor.

    The survivor is the row with the largest ``order`` values, remaining ties broken by the
    largest value of the other columns, so reruns and repartitions pick the same row.
    Implemented as ``max(struct)`` per key: an aggregate with a map-side partial step, so a
    key holding a third of all rows is reduced before the shuffle (a row_number window would
    sort all of them in one task).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_fields = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    packed = F.struct(*order_fields, *[F.col(c) for c in rest]).alias("_row")
    best = df.select(*keys, packed).groupBy(*keys).agg(F.max("_row").alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


# --------------------------------------------------------------------------- P10

def dev_sample(df: DataFrame, keys: tuple[str, ...] | list[str], params: RunParams) -> DataFrame:
    """P10: TEST-mode sample, deterministic and join-consistent.

    Keeps the rows whose key falls in bucket 0 of ``params.sample_buckets`` by its md5: the same
    keys on both sides of a join (Q16), and all rows of a kept key. A predicate on the key, so
    it may stand before or after the window filters. A development feature: RUN mode never samples.
    """
    if not params.sampled:
        return df
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % params.sample_buckets
    return df.where(bucket == 0)


# --------------------------------------------------------------------------- V1-V3, V5

def require_rows(*dfs: DataFrame, what: str = "inputs") -> None:
    """V1: raise when every input is empty (one cheap ``isEmpty`` job per input)."""
    if all(df.isEmpty() for df in dfs):
        raise ValueError(f"all {what} are empty")


def row_presence(**inputs: DataFrame) -> DataFrame:
    """V1 as a table: whether each input has a row; each is read up to its first one."""
    rows = [df.sparkSession.range(1).select(F.lit(name).alias("input"), df.exists().alias("has_rows")) for name, df in inputs.items()]
    return reduce(DataFrame.unionAll, rows)


def audit_keys(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """V2: number of duplicated keys and of rows in them (one row)."""
    dups = duplicate_keys(df, keys)
    return dups.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("rows_in_duplicates"),
    )


def audit_join(left: DataFrame, joined: DataFrame, probe: str) -> DataFrame:
    """V3: rows before / after a left join, growth, matched rows, match % (2 decimals).

    Empty input gives a NULL percentage instead of a division error (Q14).
    """
    before = left.agg(F.count(F.lit(1)).alias("rows_before"))
    after = joined.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count(F.col(probe)).alias("matched_rows"),
    )
    # Two one-row aggregates side by side: union + max (no join needed).
    one = before.unionByName(after, allowMissingColumns=True).agg(
        F.max("rows_before").alias("rows_before"),
        F.max("rows_after").alias("rows_after"),
        F.max("matched_rows").alias("matched_rows"),
    )
    return one.select(
        "rows_before",
        "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("row_growth"),
        "matched_rows",
        F.round(F.try_divide(F.col("matched_rows") * 100.0, F.col("rows_after")), 2).alias("match_pct"),
    )


def observed(df: DataFrame, name: str, probe: str | None = None, **metrics: Column) -> tuple[DataFrame, Observation]:
    """V5, V3: counters that are filled by the action that writes ``df``: its rows, with
    ``probe`` the rows that a left join has matched, and any further aggregates."""
    obs = Observation(name)
    more = [F.count(F.col(probe)).alias("matched")] if probe else []
    more += [c.alias(n) for n, c in metrics.items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *more), obs


#: Values of a bitmap that ``bitmap_construct_agg`` fills; ids of that many go to one bitmap.
BITMAP = 32768


def observed_run(sales: DataFrame, params: RunParams, name: str = "run", branch_limit: int = BITMAP) -> tuple[DataFrame, "RunSummary"]:
    """V5 filled by the write of ``sales`` itself: no further scan of the output or its plan.

    Counts rows, window and money, sums exact, distinct days by the bits of the run's window
    and distinct branches by bitmaps over their numbers. A bitmap is 4 KB of what each task
    sends; there are as many as ``branch_limit`` needs, and with a number outside of it the
    branches are not counted (None), as the count would not be exact. Distinct SKUs are text,
    which no bounded state counts exactly: as every key has one row a day of the dense table,
    keys are counted by their first day instead."""
    first = F.col("date") == F.lit(params.start)
    metrics: dict[str, Column] = {
        "first_day": F.min("date"), "last_day": F.max("date"), "keys": F.count_if(first), "sale_days": F.sum("sold").cast("long"),
        "revenue": F.sum(F.col("revenue").cast("decimal(28,2)")), "qty": F.sum(F.col("qty").cast("decimal(28,2)")),
        "least_branch": F.min("branch"), "largest_branch": F.max("branch"),
    }
    offset = F.datediff("date", F.lit(params.start))
    for w in range(params.lookback_days // 64 + 1):
        here = (offset >= 64 * w) & (offset < 64 * (w + 1))
        bit = F.expr(f"shiftleft(CAST(1 AS BIGINT), datediff(date, DATE '{params.start.isoformat()}') - {64 * w})")
        metrics[f"days_{w}"] = F.bit_or(F.when(here, bit).otherwise(F.lit(0).cast("long")))
    for w in range(-(-branch_limit // BITMAP)):
        here = (F.col("branch") >= BITMAP * w) & (F.col("branch") < BITMAP * (w + 1))
        metrics[f"branches_{w}"] = F.bitmap_construct_agg(F.when(here, (F.col("branch") - BITMAP * w).cast("long")))
    out, obs = observed(sales, name, **metrics)
    return out, RunSummary(obs, params, branch_limit)


class RunSummary:
    """What ``observed_run`` has counted, once the write is done."""

    def __init__(self, obs: Observation, params: RunParams, branch_limit: int) -> None:
        self.obs, self.params, self.branch_limit = obs, params, branch_limit

    def row(self) -> dict:
        seen = self.obs.get
        counted = seen["least_branch"] is None or 0 <= seen["least_branch"] <= seen["largest_branch"] < self.branch_limit

        def bits(prefix: str, value) -> int:
            return sum(value(v) for k, v in seen.items() if k.startswith(prefix) and v is not None)

        return {
            "rows": seen["rows"], "keys": seen["keys"], "sale_days": seen["sale_days"] or 0,
            "distinct_branches": bits("branches_", lambda v: int.from_bytes(v, "little").bit_count()) if counted else None,
            "distinct_days": bits("days_", lambda v: (v & (2**64 - 1)).bit_count()),
            "revenue": float(seen["revenue"] or 0), "qty": float(seen["qty"] or 0),
            "first_day": seen["first_day"], "last_day": seen["last_day"],
            "window_start": self.params.start, "window_end": self.params.as_of,
        }

    def frame(self, spark) -> DataFrame:
        schema = ("rows long, keys long, sale_days long, distinct_branches long, distinct_days long, revenue double, qty double, "
                  "first_day date, last_day date, window_start date, window_end date")
        row = self.row()
        return spark.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema)


def observed_join(left: DataFrame, join, probe: str, name: str = "join") -> tuple[DataFrame, "JoinAudit"]:
    """V3 filled by the write of the joined rows: ``join(left)`` with the rows before and after
    counted on the way. A sort-merge or broadcast join reads its left side once, so the count
    before it is right; a side that Spark reads twice (a reused or skew-split stage) would
    count twice, so ``JoinAudit.row`` refuses a join that seems to lose rows."""
    before, seen_before = observed(left, f"{name}-before")
    after, seen_after = observed(join(before), f"{name}-after", probe)
    return after, JoinAudit(seen_before, seen_after)


class JoinAudit:
    def __init__(self, before: Observation, after: Observation) -> None:
        self.before, self.after = before, after

    def row(self) -> dict:
        before, after, matched = self.before.get["rows"], self.after.get["rows"], self.after.get["matched"]
        if before > after:
            raise ValueError(f"a left join of {before} rows wrote {after}: the left side was read more than once")
        return {
            "rows_before": before, "rows_after": after, "row_growth": after - before, "matched_rows": matched,
            "match_pct": round(matched * 100.0 / after, 2) if after else None,
        }


def run_summary(sales: DataFrame, params: RunParams) -> DataFrame:
    """V5: rows, window and distinct branches / SKUs / days of an output (one row), which is read
    once: its days are summed to one row per branch and SKU, whose days are bits of words."""
    words = range(params.lookback_days // 64 + 1)
    offset = F.datediff("date", F.lit(params.start))
    bits = []
    for w in words:
        shift = F.expr(f"shiftleft(CAST(1 AS BIGINT), datediff(date, DATE '{params.start.isoformat()}') - {64 * w})")
        bits.append(F.bit_or(F.when((offset >= 64 * w) & (offset < 64 * (w + 1)), shift).otherwise(F.lit(0).cast("long"))).alias(f"w{w}"))
    per_key = sales.groupBy("branch", "sku").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), *bits)
    days = reduce(lambda a, b: a + b, [F.bit_count(F.bit_or(f"w{w}")) for w in words])
    kept = {"rows": F.sum("rows"), "first_day": F.min("first_day"), "last_day": F.max("last_day")} | {f"w{w}": F.bit_or(f"w{w}") for w in words}
    return by_value(per_key, ("branch", "sku"), **kept).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        *distinct_values(("branch", "sku"), ("distinct_branches", "distinct_skus")),
        F.coalesce(days, F.lit(0)).cast("long").alias("distinct_days"),
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
    ).select("rows", "distinct_branches", "distinct_skus", "distinct_days", "first_day", "last_day",
             F.lit(params.start).alias("window_start"), F.lit(params.as_of).alias("window_end"))


# --------------------------------------------------------------------------- V6-V9

def check_ref(df: DataFrame, dim: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """V6: rows of ``df`` whose key has no row in ``dim`` (referential integrity), counted by key."""
    dim_keys = dim.select(*keys).distinct()
    orphans = df.join(dim_keys, on=list(keys), how="left_anti")
    return orphans.groupBy(*keys).agg(F.count(F.lit(1)).alias("orphan_rows"))


def check_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """V7: rows below ``lo``, above ``hi`` and NULL (one row)."""
    c = F.col(col)
    below = F.count_if(c < F.lit(lo)) if lo is not None else F.lit(0).cast("long")
    above = F.count_if(c > F.lit(hi)) if hi is not None else F.lit(0).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        below.alias("below_min"),
        above.alias("above_max"),
        F.count_if(c.isNull()).alias("null_rows"),
    )


def group_quantiles(df: DataFrame, value: str, by: tuple[str, ...] | list[str], qs: tuple[float, ...], partitions: int | None = None) -> DataFrame:
    """Exact quantiles per group (linear interpolation between the closest ranks, the
    definition of ``percentile`` / ``quantile_cont``) without holding a group in one task.

    Equal values of a group are counted first, then range-partitioned by (group, value), so a
    group with a third of all rows is spread over many partitions. The partitioning is sampled,
    so it is checkpointed once with each row's partition before it is read twice: for the
    counts of the partitions (one row per partition and group) and for the ranks inside them.
    Only the values at the two ranks around each quantile position are kept. Columns: ``by`` +
    ``q0``, ``q1``, ...
    """
    by = list(by)
    spark = df.sparkSession
    conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
    n_parts = partitions or (int(conf) if conf.isdigit() else spark.sparkContext.defaultParallelism)
    vals = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ensure_checkpoint_dir(spark)
    ranged = vals.repartitionByRange(n_parts, *by, "_v").withColumn("_pid", F.spark_partition_id()).checkpoint()
    part = ranged.groupBy("_pid", *by).agg(F.sum("_c").alias("_pc"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(
        "_pid", *by,
        F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_off"),
        F.sum("_pc").over(Window.partitionBy(*by)).alias("_n"),
    )
    upto = F.sum("_c").over(Window.partitionBy("_pid", *by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    on = F.col("r._pid") == F.col("p._pid")
    for c in by:
        on &= F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
    ranked = ranged.withColumn("_upto", upto).alias("r").join(part.alias("p"), on)
    last = F.col("_off") + F.col("_upto") - 1  # ranks from 0, of the value's first and last row
    ranked = ranked.select(*[F.col(f"r.{c}").alias(c) for c in by], "_n", "_v", (last - F.col("_c") + 1).alias("_first"), last.alias("_last"))
    positions = [F.lit(q) * (F.col("_n") - 1) for q in qs]

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank <= F.col("_last")), F.col("_v")))

    near = reduce(lambda a, b: a | b, [(F.col("_first") <= F.ceil(p)) & (F.floor(p) <= F.col("_last")) for p in positions])
    aggs = []
    for i, p in enumerate(positions):
        aggs += [at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}")]
    grouped = ranked.where(near).groupBy(*by, "_n").agg(*aggs)
    out = []
    for i, p in enumerate(positions):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = (F.ceil(p) - p) * lo + (p - F.floor(p)) * hi
        out.append(F.when(F.ceil(p) == F.floor(p), lo).otherwise(between).alias(f"q{i}"))
    return grouped.select(*by, *out)


def check_outliers(df: DataFrame, col: str, by: tuple[str, ...] | list[str]) -> DataFrame:
    """V8: rows outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] of their group (our rule).

    Quartiles are exact and distributed (``group_quantiles``); the per-group fences (one
    row per group) are joined back by key.
    """
    q = group_quantiles(df, col, by, (0.25, 0.75))
    bounds = q.select(
        *by,
        (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("lower_fence"),
        (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("upper_fence"),
    )
    v = F.col(col).cast("double")
    flagged = df.join(bounds, on=list(by), how="inner")
    return flagged.where((v < F.col("lower_fence")) | (v > F.col("upper_fence")))


def check_dates(df: DataFrame, keys: tuple[str, ...] | list[str], date_col: str = "date") -> DataFrame:
    """V9: gaps in each key's daily series: (keys, gap_start, gap_end, missing_days).

    ``lag`` over the key partition; the series is per key and bounded by the history window.
    """
    w = Window.partitionBy(*keys).orderBy(date_col)
    prev = F.lag(date_col).over(w)
    steps = df.select(*keys, F.col(date_col), prev.alias("_prev"))
    gaps = steps.where(F.datediff(F.col(date_col), F.col("_prev")) > 1)
    return gaps.select(
        *keys,
        F.date_add(F.col("_prev"), 1).alias("gap_start"),
        F.date_sub(F.col(date_col), 1).alias("gap_end"),
        (F.datediff(F.col(date_col), F.col("_prev")) - 1).alias("missing_days"),
    )


# --------------------------------------------------------------------------- S7

def describe_table(df: DataFrame, count: bool = True) -> DataFrame:
    """The schema as rows (position, name, type, nullable), with the table's row count as a
    scalar subquery; with ``count=False`` no data is read."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    out = spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
    return out.withColumn("row_count", df.agg(F.count(F.lit(1))).scalar()) if count else out
