"""Master-table operators: row numbers, period totals, moving averages, per-key summary, join.

Scale notes
-----------
The reference computes 18 period totals and 10 moving averages as 29 window columns at row
grain and then keeps one value per key. Catalyst does not fold those windows into the
aggregate, so here every per-key value is a conditional sum inside ONE ``groupBy`` with a
map-side partial aggregate (``sales_summary``): one shuffle of at most one row per key and
map task, no sort, no row-grain window. The row-grain series (W1, W3) stay available as
operators; they share one partitioning and one sort, and each partition holds one key's
window of days (bounded by the look-back, not by the data volume).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions.columns import scaled, unscaled
from stocklens.functions.dates import month_end, period_bounds
from stocklens.operators import filters

KEY = ("branch", "sku")
MEASURES = ("revenue", "qty")
MA_DAYS = (7, 14, 30, 60, 90)
TRAILING = ("mtd", "ytd", "last7d", "last30d", "last90d", "last4w")
MONTHS = ("m1", "m2", "m3")


def _cents(c: str) -> Column:
    """Money / quantity as integer cents: exact sums that stay in generated code."""
    return scaled(c)


def _csum(cond: Column | None, c: str) -> Column:
    v = _cents(c)
    return unscaled(F.sum(v if cond is None else F.when(cond, v).otherwise(F.lit(0).cast("long"))))


# --------------------------------------------------------------------------- W1 / W3 / W5

def with_row_number(df: DataFrame, keys=KEY, order: str = "date") -> DataFrame:
    """Row number per key by date."""
    return df.withColumn("row_number", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def moving_averages(df: DataFrame, days=MA_DAYS, keys=KEY, order: str = "date", measures=MEASURES) -> DataFrame:
    """Per row, sum over the current and n-1 preceding rows divided by n (constant n, Q5).

    All frames share one partitioning and one sort (added in one ``withColumns``). Window
    sums run on integer cents, so the result does not depend on summation order.
    """
    base = Window.partitionBy(*keys).orderBy(order)
    cols = {}
    for n in days:
        w = base.rowsBetween(-(n - 1), 0)
        for m in measures:
            cols[f"{m}_mm{n}d"] = unscaled(F.sum(_cents(m)).over(w)) / F.lit(float(n))
    return df.withColumns(cols)


def latest_per_key(df: DataFrame, keys, order: str, cols) -> DataFrame:
    """Each column's value on the key's latest ``order`` (what the reference's ``first``
    of the moving averages intends, Q6). ``max_by`` is an aggregate: partial, skew-safe."""
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col(order)).alias(c) for c in cols])


# --------------------------------------------------------------------------- W2 / W4

def period_conditions(as_of: dt.date, month_mode: str = "first_day", date_col: str = "date") -> dict[str, Column]:
    """W4 as predicates: period name -> condition on the date column.

    Trailing periods are lower bounds (``>=``); the previous months are equality with their
    first day (``first_day``, the reference) or the whole month (``full_month``).
    """
    b = period_bounds(as_of)
    d = F.col(date_col)
    conds = {p: d >= F.lit(b[p]) for p in TRAILING}
    for p in MONTHS:
        if month_mode == "first_day":
            conds[p] = d == F.lit(b[p])
        elif month_mode == "full_month":
            conds[p] = d.between(F.lit(b[p]), F.lit(month_end(b[p])))
        else:
            raise ValueError("month_mode must be 'first_day' or 'full_month'")
    return conds


def period_bounds_columns(as_of: Column) -> dict[str, Column]:
    """W4 as column expressions of a date column (for as-of dates read from data)."""
    first = F.trunc(as_of, "month")
    return {
        "mtd_start": first,
        "ytd_start": F.trunc(as_of, "year"),
        "last7d_start": F.date_sub(as_of, 7),
        "last14d_start": F.date_sub(as_of, 14),
        "last30d_start": F.date_sub(as_of, 30),
        "last60d_start": F.date_sub(as_of, 60),
        "last90d_start": F.date_sub(as_of, 90),
        "last4w_start": F.date_sub(as_of, 28),
        "m1_start": F.add_months(first, -1),
        "m2_start": F.add_months(first, -2),
        "m3_start": F.add_months(first, -3),
    }


def period_totals_exprs(as_of: dt.date, month_mode: str = "first_day", measures=MEASURES) -> list[Column]:
    """W2 as aggregate expressions: 9 periods x measures conditional sums."""
    out = []
    for p, cond in period_conditions(as_of, month_mode).items():
        for m in measures:
            out.append(_csum(cond, m).alias(f"{m}_{p}"))
    return out


def period_totals(sales: DataFrame, as_of: dt.date, month_mode: str = "first_day") -> DataFrame:
    """Per key, the 18 period totals."""
    return sales.groupBy(*KEY).agg(*period_totals_exprs(as_of, month_mode))


def moving_average_last_exprs(as_of: dt.date, days=MA_DAYS, measures=MEASURES) -> list[Column]:
    """W3 + W5 fused: the moving average on the last day = sum of the last n days / n.

    Equal to the window value on ``as_of`` when the series is dense and ends on ``as_of``
    (the dense sales table is, by construction).
    """
    d = F.col("date")
    out = []
    for n in days:
        cond = d > F.lit(as_of - dt.timedelta(days=n))
        for m in measures:
            out.append((_csum(cond, m) / F.lit(float(n))).alias(f"{m}_mm{n}d"))
    return out


# --------------------------------------------------------------------------- A6

def distinct_days(start: dt.date, end: dt.date, cond: Column | None = None, date_col: str = "date") -> Column:
    """Exact number of distinct days in [start, end] (where ``cond`` holds) per group.

    Each day sets bit (day - start) of a bitmap kept in 64-bit words; the count is the
    popcount of the OR of the words. ``bit_or`` is a native aggregate (hash aggregate,
    map-side partial, generated code) where ``count(DISTINCT)`` would expand every row.
    """
    offset = F.datediff(F.col(date_col), F.lit(start))
    words = ((end - start).days + 1 + 63) // 64
    total = None
    for w in range(words):
        hit = (offset >= 64 * w) & (offset < 64 * (w + 1))
        if cond is not None:
            hit = hit & cond
        shift = F.expr(f"shiftleft(CAST(1 AS BIGINT), datediff({date_col}, DATE '{start.isoformat()}') - {64 * w})")
        bit = F.when(hit, shift).otherwise(F.lit(0).cast("long"))
        count = F.bit_count(F.bit_or(bit))
        total = count if total is None else total + count
    return total.cast("long")


def sales_summary(sales: DataFrame, as_of: dt.date, month_mode: str = "first_day", start: dt.date | None = None) -> DataFrame:
    """One row per (branch, sku) with 7 totals, 18 period values, 10 moving averages and
    day statistics, in a single aggregate over the days [start, as_of] (default: 90 days
    back, the reference's window; rows outside it are not read, as the reference filters
    its load).

    grid_days / grid_first / grid_last keep the reference's meaning (days of the zero-filled
    series, Q22); active_days / first_sale / last_sale count days with a positive quantity.
    """
    start = start or as_of - dt.timedelta(days=90)
    sold_day = F.col("qty") > 0
    window = sales.where(F.col("date").between(F.lit(start), F.lit(as_of)))
    return window.groupBy(*KEY).agg(
        _csum(None, "revenue").alias("revenue_total"),
        _csum(None, "qty").alias("qty_total"),
        F.sum("sold").cast("long").alias("sale_days"),
        _csum(None, "revenue_off").alias("revenue_off_total"),
        _csum(None, "qty_off").alias("qty_off_total"),
        _csum(None, "revenue_on").alias("revenue_on_total"),
        _csum(None, "qty_on").alias("qty_on_total"),
        *period_totals_exprs(as_of, month_mode),
        *moving_average_last_exprs(as_of),
        distinct_days(start, as_of).alias("grid_days"),
        F.min("date").alias("grid_first"),
        F.max("date").alias("grid_last"),
        distinct_days(start, as_of, sold_day).alias("active_days"),
        F.min(F.when(sold_day, F.col("date"))).alias("first_sale"),
        F.max(F.when(sold_day, F.col("date"))).alias("last_sale"),
    )


# --------------------------------------------------------------------------- P4 / P6 / J8 / P7

CURRENT_NAMES = {"stock_qty": "current_stock_qty", "stock_value": "current_stock_value", "dde": "current_dde"}


def current_stock(stock: DataFrame, as_of: dt.date) -> DataFrame:
    """P4 + P6: the as-of snapshot of a stock table, stock columns renamed to 'current'."""
    return filters.rename_drop(filters.snapshot(stock, as_of), CURRENT_NAMES)


def build_master(stock: DataFrame, summary: DataFrame, as_of: dt.date, processed_at: Column | None = None) -> DataFrame:
    """J8 + P7: stock LEFT JOIN sales summary on (branch, sku); revenue_*/qty_* NULL -> 0
    (the day statistics stay NULL for keys without sales, Q8); as-of date and processing time.

    The summary is unique per key, so the left join keeps the stock row count.
    """
    joined = stock.join(summary, on=list(KEY), how="left")
    filled = filters.fill_zero_prefix(joined, ("revenue_", "qty_"))
    out = filled.withColumn("date", F.lit(as_of))
    return out.withColumn("processed_at", processed_at) if processed_at is not None else out
