"""Sales operators: filters, value x quantity join, daily aggregation, densification, channels.

Scale notes
-----------
* Both channels are filtered and joined in one pass (the reference scans the quantity table
  and joins it once per channel).
* Aggregation happens before any key-grain shuffle: A1 has a map-side partial aggregate,
  so a hot (branch, sku) key reaches the shuffle as at most one row per day and map task.
* The dense grid (keys x days, the largest intermediate) is never shuffled or joined: each
  key's <= lookback+1 daily rows are packed into a map after the key shuffle and the grid
  is generated in place by ``inline(transform(sequence(...)))``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.columns import sale_flag, scaled, unscaled
from stocklens.functions.dates import year_month
from stocklens.operators.quality import by_value, distinct_values

# Fixed values of the source system (must equal the reference's literals).
BALANCE_STATE = "1 - SALDO"        # goods state excluded from sales
OFFLINE_TYPE = "LOJA FISICA"       # business type of the physical-store channel
OFF, ON = "OFF", "ON"              # channel suffixes of the output columns

VALUE_COLS = ("revenue", "qty")
SALES_COLUMNS = (
    "date", "year_month", "branch", "sku",
    "revenue_off", "qty_off", "sold_off",
    "revenue_on", "qty_on", "sold_on",
    "revenue", "qty", "sold",
)


def _zero() -> Column:
    return F.lit(0).cast("long")


# --------------------------------------------------------------------------- P1 / P2 / J1

def filter_sales(rated: DataFrame, channel: str | None, start: dt.date, end: dt.date) -> DataFrame:
    """Valid value lines of one channel (``OFF``/``ON``) or of both (``None``).

    NULL goods states fail ``!=`` and are dropped; a NULL business type belongs to no channel.
    """
    cond = (
        (F.col("goods_state") != BALANCE_STATE)
        & F.col("approval_date").between(F.lit(start), F.lit(end))
        & (F.col("sale_value") >= 0)
        & (F.col("cost_value") >= 0)
    )
    if channel == OFF:
        cond &= F.col("business_type") == OFFLINE_TYPE
    elif channel == ON:
        cond &= F.col("business_type") != OFFLINE_TYPE
    elif channel is None:
        cond &= F.col("business_type").isNotNull()
    else:
        raise ValueError(f"channel must be {OFF!r}, {ON!r} or None")
    return rated.where(cond)


def filter_quantity(qty: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Non-negative quantities invoiced inside the window; two columns."""
    return qty.where((F.col("quantity") >= 0) & F.col("invoice_date").between(F.lit(start), F.lit(end))).select(
        "fact_key", "quantity"
    )


def join_value_quantity(rated: DataFrame, qty: DataFrame) -> DataFrame:
    """Inner equi-join on the fact key (M:N when keys repeat; audit with ``audit_keys``)."""
    return rated.join(qty, on="fact_key", how="inner")


def channel_of() -> Column:
    return F.when(F.col("business_type") == OFFLINE_TYPE, F.lit(OFF)).otherwise(F.lit(ON))


def branch_of() -> Column:
    """Offline sales belong to the selling branch, online ones to the issuing branch (Q23)."""
    return F.when(F.col("business_type") == OFFLINE_TYPE, F.col("selling_branch")).otherwise(F.col("issuing_branch"))


def sales_lines(rated: DataFrame, qty: DataFrame, start: dt.date, end: dt.date, channel: str | None = None) -> DataFrame:
    """P1 + P2 + J1 for one or both channels: (date, sku, branch, channel, sale_value, quantity, cost_value)."""
    joined = join_value_quantity(filter_sales(rated, channel, start, end), filter_quantity(qty, start, end))
    return joined.select(
        F.col("approval_date").alias("date"),
        F.col("sku"),
        branch_of().alias("branch"),
        channel_of().alias("channel"),
        F.col("sale_value"),
        F.col("quantity"),
        F.col("cost_value"),
    )


# --------------------------------------------------------------------------- A1

def daily_sales(lines: DataFrame) -> DataFrame:
    """A1: revenue, quantity and cost per (date, sku, branch, channel); sums exact, output double."""
    return lines.groupBy("date", "sku", "branch", "channel").agg(
        unscaled(F.sum(scaled("sale_value"))).alias("revenue"),
        unscaled(F.sum(scaled("quantity"))).alias("qty"),
        unscaled(F.sum(scaled("cost_value", 4)), 4).alias("cost"),
    ).withColumn("year_month", year_month("date"))


def daily_sales_wide(lines: DataFrame) -> DataFrame:
    """A1 for both channels in one aggregate: one row per (branch, sku, date) with per-channel
    sums in integer cents (exact, codegen)."""
    off = F.col("channel") == OFF

    def part(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, scaled(c)).otherwise(_zero()))

    return lines.groupBy("branch", "sku", "date").agg(
        part(off, "sale_value").alias("revenue_off"),
        part(off, "quantity").alias("qty_off"),
        part(~off, "sale_value").alias("revenue_on"),
        part(~off, "quantity").alias("qty_on"),
    )


# --------------------------------------------------------------------------- J2 / J3

def day_sequence(start: dt.date, end: dt.date) -> Column:
    return F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))


def date_key_grid(keys: DataFrame, start: dt.date, end: dt.date, date_col: str = "date") -> DataFrame:
    """Every key x every day of [start, end]; a generator, not a join."""
    return keys.select("*", F.explode(day_sequence(start, end)).alias(date_col))


def densify(
    daily: DataFrame,
    keys: tuple[str, ...] | list[str],
    values: tuple[str, ...] | list[str],
    start: dt.date,
    end: dt.date,
    date_col: str = "date",
) -> DataFrame:
    """The grid (keys present in ``daily``) x [start, end], values of ``daily`` or 0.

    Same rows as ``date_key_grid(keys) LEFT JOIN daily`` + zero fill, computed without the
    join: ``daily`` must hold one row per (keys, date); days outside the window are ignored.
    """
    entry = F.struct(F.col(date_col).alias("d"), F.struct(*[F.col(v) for v in values]).alias("v"))
    packed = daily.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_days"))
    types = {f.name: f.dataType for f in daily.schema.fields}

    def fill(d: Column) -> Column:
        hit = F.try_element_at(F.col("_days"), d)
        return F.struct(
            d.alias(date_col),
            *[F.coalesce(hit.getField(v), F.lit(0).cast(types[v])).alias(v) for v in values],
        )

    return packed.select(*keys, F.inline(F.transform(day_sequence(start, end), fill)))


def dense_channel_sales(rated: DataFrame, qty: DataFrame, channel: str, start: dt.date, end: dt.date) -> DataFrame:
    """One channel as the reference builds it: P1, P2, J1, A1, J2+J3, sale flag."""
    lines = sales_lines(rated, qty, start, end, channel)
    daily = lines.groupBy("branch", "sku", "date").agg(
        F.sum(scaled("sale_value")).alias("revenue"), F.sum(scaled("quantity")).alias("qty")
    )
    dense = densify(daily, ("branch", "sku"), VALUE_COLS, start, end)
    return dense.select(
        "date",
        year_month("date").alias("year_month"),
        "branch",
        "sku",
        unscaled("revenue").alias("revenue"),
        unscaled("qty").alias("qty"),
        sale_flag("qty").alias("sold"),
    )


# --------------------------------------------------------------------------- J4

def merge_channels(off: DataFrame, on: DataFrame) -> DataFrame:
    """Full outer merge of the two dense channels on (date, year_month, branch, sku).

    Written as union + group-by (one shuffle, map-side combine) instead of a full outer join;
    a side without the key contributes zeros, exactly like the outer join + fillna(0).
    """
    keys = ("date", "year_month", "branch", "sku")
    tagged = off.select(*keys, F.lit(OFF).alias("channel"), "revenue", "qty", "sold").unionByName(
        on.select(*keys, F.lit(ON).alias("channel"), "revenue", "qty", "sold")
    )
    is_off = F.col("channel") == OFF

    def pick(cond: Column, c: str) -> Column:
        v = F.col(c).cast("long") if c == "sold" else scaled(c)
        return F.sum(F.when(cond, v).otherwise(_zero()))

    merged = tagged.groupBy(*keys).agg(
        pick(is_off, "revenue").alias("revenue_off"),
        pick(is_off, "qty").alias("qty_off"),
        pick(is_off, "sold").cast("int").alias("sold_off"),
        pick(~is_off, "revenue").alias("revenue_on"),
        pick(~is_off, "qty").alias("qty_on"),
        pick(~is_off, "sold").cast("int").alias("sold_on"),
    )
    return _with_totals(merged)


def _with_totals(df: DataFrame) -> DataFrame:
    """Money and quantities arrive as integer cents; published as double."""
    return df.select(
        "date", "year_month", "branch", "sku",
        unscaled("revenue_off").alias("revenue_off"),
        unscaled("qty_off").alias("qty_off"),
        "sold_off",
        unscaled("revenue_on").alias("revenue_on"),
        unscaled("qty_on").alias("qty_on"),
        "sold_on",
        unscaled(F.col("revenue_off") + F.col("revenue_on")).alias("revenue"),
        unscaled(F.col("qty_off") + F.col("qty_on")).alias("qty"),
        (F.col("sold_off") + F.col("sold_on")).cast("int").alias("sold"),
    )


# --------------------------------------------------------------------------- fused pipeline body

def dense_daily_sales(rated: DataFrame, qty: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """P1 P2 J1 A1 J2 J3 J4 P7 D2 in one plan: dense daily sales per branch x SKU x channel.

    Result equals ``merge_channels(dense_channel_sales(OFF), dense_channel_sales(ON))`` with
    one join, one pre-aggregated day shuffle and one key shuffle.
    """
    lines = sales_lines(rated, qty, start, end, None)
    daily = daily_sales_wide(lines)
    dense = densify(daily, ("branch", "sku"), ("revenue_off", "qty_off", "revenue_on", "qty_on"), start, end)
    flagged = dense.select(
        "date",
        year_month("date").alias("year_month"),
        "branch",
        "sku",
        "revenue_off", "qty_off", sale_flag("qty_off").alias("sold_off"),
        "revenue_on", "qty_on", sale_flag("qty_on").alias("sold_on"),
    )
    return _with_totals(flagged)


# --------------------------------------------------------------------------- A2 / A3 / T1

def exact_sum(c: str) -> Column:
    """Sum of a double column that holds cent values, done in integer cents (exact and
    order independent)."""
    return unscaled(F.sum(scaled(c)))


def sales_stats(sales: DataFrame) -> DataFrame:
    """A2: one row of global statistics over the dense sales table, which is read once: it is
    summed to one row per branch and SKU, and the distinct branches and SKUs are counted over
    those rows."""
    cents = ("revenue", "qty", "revenue_off", "revenue_on", "qty_off", "qty_on")
    per_key = sales.groupBy("branch", "sku").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sold").cast("long").alias("sold"), *[F.sum(scaled(c)).alias(c) for c in cents]
    )

    def total(c: str) -> Column:
        return unscaled(F.sum(c))

    return by_value(per_key, ("branch", "sku"), **{c: F.sum(c) for c in ("rows", "sold", *cents)}).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("total_rows"),
        total("revenue").alias("revenue_total"),
        total("qty").alias("qty_total"),
        F.sum("sold").cast("long").alias("sale_days"),
        total("revenue_off").alias("revenue_off"),
        total("revenue_on").alias("revenue_on"),
        total("qty_off").alias("qty_off"),
        total("qty_on").alias("qty_on"),
        *distinct_values(("branch", "sku"), ("distinct_branches", "distinct_skus")),
    )


def branch_totals(sales: DataFrame) -> DataFrame:
    """A3: five sums per branch."""
    return sales.groupBy("branch").agg(
        exact_sum("revenue").alias("revenue_total"),
        exact_sum("revenue_off").alias("revenue_off"),
        exact_sum("revenue_on").alias("revenue_on"),
        exact_sum("qty").alias("qty_total"),
        F.sum("sold").cast("long").alias("sale_days"),
    )


def top_branches(sales: DataFrame, k: int = 10) -> DataFrame:
    """The k branches with the highest revenue (ties by branch id)."""
    return branch_totals(sales).orderBy(F.col("revenue_total").desc(), F.col("branch").asc()).limit(k)
