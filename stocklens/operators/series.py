"""Series over periods: trend and season of channels (K13), stock health over snapshots (K7).

A key's months or snapshot days are few, so windows and packed series are per key and bounded
by the history; what grows with the data is aggregated on the map side before its one shuffle.
Slopes and indices come from exact integer sums, so they don't depend on partitioning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions.columns import safe_div, scaled, unscaled
from stocklens.operators.kpis import CENTS

#: Months that a trend, and whole years that a season, needs at least (our rule).
MIN_TREND_MONTHS = 6
MIN_SEASON_YEARS = 2
#: A month's share of its year is kept in millionths.
MICRO = 1_000_000
_WIDE = "decimal(38,0)"


# --------------------------------------------------------------------------- K13: months

def monthly_sales(lines: DataFrame, end: dt.date, by: tuple[str, ...] = ("branch", "channel")) -> DataFrame:
    """Revenue in cents per ``by`` and month, from the key's first month with a sale to ``end``'s;
    months without sales are zero. Columns: ``by, month`` (its first day), ``position`` (from
    0), ``cents``. ``lines`` are sales lines (J1: ``date, sale_value``, ...)."""
    month = F.trunc("date", "month").alias("month")
    monthly = lines.groupBy(*by, month).agg(F.sum(scaled("sale_value")).alias("cents"))
    packed = monthly.groupBy(*by).agg(F.min("month").alias("first"), F.map_from_entries(F.collect_list(F.struct("month", "cents"))).alias("held"))
    months = F.sequence("first", F.lit(end.replace(day=1)), F.expr("INTERVAL 1 MONTH"))
    grid = packed.select(*by, "held", F.posexplode(months).alias("position", "month"))
    return grid.select(*by, "month", "position", F.coalesce(F.try_element_at("held", F.col("month")), F.lit(0)).cast("long").alias("cents"))


def sales_trend(monthly: DataFrame, by: tuple[str, ...] = ("branch", "channel")) -> DataFrame:
    """K13 trend: least-squares slope of a key's monthly revenue, in currency a month, and as a
    share of its mean month. NULL with fewer than ``MIN_TREND_MONTHS`` months.

    The slope is that of ``regr_slope``, as one quotient of exact sums. One aggregate with a
    map-side step; a month is one row, so a hot key is as small as any."""
    x, y = F.col("position").cast(_WIDE), F.col("cents").cast(_WIDE)
    sums = monthly.groupBy(*by).agg(
        F.count(F.lit(1)).alias("months"), F.min("month").alias("first_month"), F.max("month").alias("last_month"),
        F.sum("position").cast("long").alias("sx"), F.sum(F.col("position") * F.col("position")).cast("long").alias("sxx"),
        F.sum("cents").cast(_WIDE).alias("sy"), F.sum(x.cast("decimal(10,0)") * y.cast("decimal(27,0)")).cast(_WIDE).alias("sxy"),
    )
    n = F.col("months")
    over = (n.cast("decimal(10,0)") * F.col("sxy").cast("decimal(27,0)")).cast(_WIDE) - (F.col("sx").cast("decimal(15,0)") * F.col("sy").cast("decimal(22,0)")).cast(_WIDE)
    under = n * F.col("sxx") - F.col("sx") * F.col("sx")
    long_enough = n >= MIN_TREND_MONTHS
    slope = F.when(long_enough, safe_div(over.cast("double"), under.cast("double") * 100.0))
    mean = safe_div(F.col("sy").cast("double"), n.cast("double") * 100.0)
    return sums.select(
        *by, "months", "first_month", "last_month", unscaled("sy").alias("revenue"), slope.alias("trend"), safe_div(slope, mean).alias("trend_share")
    )


def season_index(monthly: DataFrame, by: tuple[str, ...] = ("branch", "channel")) -> DataFrame:
    """K13 season: for every key and calendar month the mean, over the key's whole calendar years,
    of the month's revenue over that year's mean month; 1 is an average month. Years without
    revenue are left out; NULL with fewer than ``MIN_SEASON_YEARS`` whole years (our rule).
    Columns: ``by, calendar_month, years, season_index``."""
    year = F.year("month").alias("year")
    packed = monthly.groupBy(*by, year).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").cast("decimal(28,0)").alias("total"),
        F.collect_list(F.struct(F.month("month").alias("calendar_month"), "cents")).alias("months"),  # at most 12
    )
    whole = (F.col("n") == 12) & (F.col("total") > 0)
    rows = packed.select(*by, F.when(whole, F.col("total")).alias("total"), F.inline("months"))
    micro = F.expr(f"CAST(CAST(cents AS DECIMAL(20,0)) * {12 * MICRO} AS DECIMAL(30,0)) DIV total")
    found = rows.select(*by, "calendar_month", micro.alias("micro")).groupBy(*by, "calendar_month").agg(F.count("micro").alias("years"), F.sum("micro").alias("s"))
    index = F.when(F.col("years") >= MIN_SEASON_YEARS, safe_div(F.col("s").cast("double"), F.col("years").cast("double") * float(MICRO)))
    return found.select(*by, "calendar_month", "years", index.alias("season_index"))


def season_adjusted(monthly: DataFrame, by: tuple[str, ...] = ("branch", "channel")) -> DataFrame:
    """Every month's revenue, its change on the same month of the year before, its seasonal
    index and the revenue without the season (NULL where there is no index or it is zero). The
    key's months are one window partition, and the indices join on the key and calendar month."""
    before = F.lag("cents", 12).over(Window.partitionBy(*by).orderBy("month"))
    rows = monthly.withColumn("before", before).withColumn("calendar_month", F.month("month"))
    index = season_index(monthly, by).select(*by, "calendar_month", "season_index")
    revenue = unscaled("cents")
    return rows.join(index, [*by, "calendar_month"]).select(
        *by, "month", revenue.alias("revenue"), unscaled("before").alias("revenue_year_before"),
        safe_div((F.col("cents") - F.col("before")).cast("double"), F.col("before").cast("double")).alias("change_on_year"),
        "season_index", safe_div(revenue, F.col("season_index")).alias("adjusted_revenue"),
    )


# --------------------------------------------------------------------------- K7: snapshots

def between_days(snapshots: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Snapshots of [start, end]; on a table partitioned by ``date`` only those partitions are read."""
    return snapshots.where(F.col("date").between(F.lit(start), F.lit(end)))


def health_series(snapshots: DataFrame, days: int = 30, by: tuple[str, ...] = ("branch", "sku")) -> DataFrame:
    """K7 over periods: each snapshot of a key with the one before it, whatever days lie between,
    and with what the last ``days`` calendar days hold.

    ``snapshots``: ``date, by, stock_value, coverage_days, health_level``, one row a key and day.
    Adds ``prev_date, days_since_prev, prev_stock_value, prev_coverage_days, prev_health_level,
    value_change`` (share), ``mean_stock_value``, ``snapshots_in_window`` and ``critical_days``
    (snapshots at level critical) of the window, which ends with the day. Missing days are no
    rows: the frame is a range of days, not of rows. One shuffle and sort on the key."""
    key = Window.partitionBy(*by).orderBy("date")
    window = Window.partitionBy(*by).orderBy("day").rangeBetween(1 - days, 0)
    rows = snapshots.withColumn("day", F.unix_date("date"))
    value = F.col("stock_value").cast(CENTS)

    def prev(c: str) -> Column:
        return F.lag(c).over(key)

    out = rows.select(
        "date", *by, "stock_value", "coverage_days", "health_level",
        prev("date").alias("prev_date"), F.datediff("date", prev("date")).alias("days_since_prev"),
        prev("stock_value").alias("prev_stock_value"), prev("coverage_days").alias("prev_coverage_days"), prev("health_level").alias("prev_health_level"),
        F.sum(value).over(window).alias("_s"), F.count(value).over(window).alias("_n"), F.count(F.lit(1)).over(window).alias("snapshots_in_window"),
        F.count_if(F.col("health_level") == "critical").over(window).alias("critical_days"),
    )
    change = safe_div(F.col("stock_value") - F.col("prev_stock_value"), F.col("prev_stock_value"))
    mean = safe_div(F.col("_s").cast("double"), F.col("_n").cast("double"))
    return out.withColumns({"value_change": change, "mean_stock_value": mean}).drop("_s", "_n")


def health_totals(snapshots: DataFrame) -> DataFrame:
    """K7 by day: stock value, mean coverage and SKUs at each level, with the snapshot day before.
    Aggregated to one row a day first; the window runs over days only."""
    levels = {f"{x}_keys": F.count_if(F.col("health_level") == x) for x in ("critical", "low", "ok", "excess", "unknown")}
    cover = F.sum(F.col("coverage_days").cast("decimal(20,6)")).cast("double")
    daily = snapshots.groupBy("date").agg(
        F.sum(F.col("stock_value").cast(CENTS)).cast("double").alias("stock_value"),
        safe_div(cover, F.count("coverage_days").cast("double")).alias("coverage_days"),
        *[c.alias(n) for n, c in levels.items()],
    )
    order = Window.orderBy("date")
    prev = F.lag("stock_value").over(order)
    return daily.select(
        "*", F.lag("date").over(order).alias("prev_date"), prev.alias("prev_stock_value"),
        safe_div(F.col("stock_value") - prev, prev).alias("value_change"),
    )
