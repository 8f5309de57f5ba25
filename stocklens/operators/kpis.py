"""Documented KPI layer.

The reference names these KPIs in its documentation but gives few formulas; where it gives
none, the rule used here is stated in the docstring (marked "our rule"). Inputs are the
master tables (``build_master``) and the dense sales table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions.columns import safe_div
from stocklens.session import ensure_checkpoint_dir

CENTS = "decimal(28,2)"


def _sum_cents(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(CENTS))


# --------------------------------------------------------------------------- K1 K2 K3 K4

def inventory_value(master: DataFrame, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """K1: stock value by location."""
    return master.groupBy(*by).agg(_sum_cents("current_stock_value").cast("double").alias("inventory_value"))


def coverage_days(master: DataFrame, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """K2: mean coverage (days) weighted by stock value (our weight); keys without a
    coverage value are left out of both sums."""
    has = F.col("current_cover").isNotNull()
    w = F.when(has, F.col("current_stock_value").cast(CENTS))
    num = F.sum(w * F.col("current_cover").cast("decimal(20,6)"))
    den = F.sum(w)
    return master.groupBy(*by).agg(safe_div(num.cast("double"), den.cast("double")).alias("coverage_days"))


def aging_value(master: DataFrame, as_of: dt.date, days: int = 30, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """K3: stock value of keys whose last day with a sale is more than ``days`` before
    ``as_of`` or absent (our rule: age from ``last_sale``, not the grid end, Q22)."""
    aged = F.col("last_sale").isNull() | (F.col("last_sale") < F.lit(as_of - dt.timedelta(days=days)))
    value = F.col("current_stock_value").cast(CENTS)
    return master.groupBy(*by).agg(
        F.sum(F.when(aged, value).otherwise(F.lit(0).cast(CENTS))).cast("double").alias("aged_value"),
        F.sum(value).cast("double").alias("stock_value"),
    ).withColumn("aged_pct", safe_div(F.col("aged_value") * 100.0, F.col("stock_value")))


def rupture_pct(master: DataFrame, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """K4: share of the last-30-day revenue earned by keys now out of stock (our rule)."""
    out = F.coalesce(F.col("current_stock_qty"), F.lit(0)) <= 0
    rev = F.col("revenue_last30d").cast(CENTS)
    return master.groupBy(*by).agg(
        F.sum(F.when(out, rev).otherwise(F.lit(0).cast(CENTS))).cast("double").alias("rupture_revenue"),
        F.sum(rev).cast("double").alias("revenue_last30d"),
    ).withColumn("rupture_pct", safe_div(F.col("rupture_revenue") * 100.0, F.col("revenue_last30d")))


# --------------------------------------------------------------------------- K5 K6 K10

def stock_by_location(stores: DataFrame, cds: DataFrame, by: tuple[str, ...] = ("sku",)) -> DataFrame:
    """K5: quantity in transit, in stores and in CDs (union of both masters, one aggregate)."""
    both = stores.select(*by, "stock_kind", "current_stock_qty", "in_transit").unionByName(
        cds.select(*by, "stock_kind", "current_stock_qty", "in_transit")
    )
    qty = F.col("current_stock_qty").cast(CENTS)
    zero = F.lit(0).cast(CENTS)
    return both.groupBy(*by).agg(
        F.coalesce(F.sum("in_transit"), F.lit(0)).cast("long").alias("in_transit_qty"),
        F.sum(F.when(F.col("stock_kind") == "LOJA", qty).otherwise(zero)).cast("double").alias("store_qty"),
        F.sum(F.when(F.col("stock_kind") == "CD", qty).otherwise(zero)).cast("double").alias("cd_qty"),
    )


def stock_by_type(master: DataFrame, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """K6: safety stock and cycle stock (target - safety, our rule)."""
    return master.groupBy(*by).agg(
        F.coalesce(F.sum("safety_stock"), F.lit(0)).cast("long").alias("safety_stock"),
        F.coalesce(F.sum(F.col("target_stock") - F.col("safety_stock")), F.lit(0)).cast("long").alias("cycle_stock"),
    )


def turnover(master: DataFrame, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """Cost of sales / stock value (our rule)."""
    return master.groupBy(*by).agg(
        safe_div(_sum_cents("cmv_sales_value").cast("double"), _sum_cents("current_stock_value").cast("double")).alias("turnover")
    )


# --------------------------------------------------------------------------- K7

HEALTH_LEVELS = ("critical", "low", "ok", "excess", "unknown")


def health_level(cover: Column, target: Column) -> Column:
    """Level from coverage / target coverage (our rule: < 0.5 critical, < 1 low, <= 1.5 ok,
    else excess; unknown without a target)."""
    ratio = safe_div(cover.cast("double"), target.cast("double"))
    return (
        F.when(ratio.isNull(), F.lit("unknown"))
        .when(ratio < 0.5, F.lit("critical"))
        .when(ratio < 1.0, F.lit("low"))
        .when(ratio <= 1.5, F.lit("ok"))
        .otherwise(F.lit("excess"))
    )


def previous_health(stock: DataFrame) -> DataFrame:
    """The earlier period for ``inventory_health``: value, coverage and level of an enriched
    stock table (J5) of an earlier day."""
    cover, target = F.col("current_cover"), F.col("target_cover")
    return stock.select(
        "branch", "sku", F.col("stock_value").cast("double").alias("stock_value"), cover.alias("coverage_days"),
        health_level(cover, target).alias("health_level"),
    )


def inventory_health(master: DataFrame, as_of: dt.date, aging_days: int = 30, previous: DataFrame | None = None) -> DataFrame:
    """K7: per branch x SKU: value, coverage, aging flag, rupture flag and health level.
    ``previous`` (an earlier health table or ``previous_health``) adds the previous value,
    coverage and level; keys that it lacks have none."""
    cover, target = F.col("current_cover"), F.col("target_cover")
    aged = F.col("last_sale").isNull() | (F.col("last_sale") < F.lit(as_of - dt.timedelta(days=aging_days)))
    health = master.select(
        "branch",
        "sku",
        F.lit(as_of).alias("date"),
        F.col("current_stock_value").alias("stock_value"),
        cover.alias("coverage_days"),
        target.alias("target_coverage_days"),
        safe_div(cover.cast("double"), target.cast("double")).alias("coverage_ratio"),
        aged.alias("aged"),
        (F.coalesce(F.col("current_stock_qty"), F.lit(0)) <= 0).alias("in_rupture"),
        health_level(cover, target).alias("health_level"),
    )
    if previous is None:
        return health
    prev = previous.select(
        "branch", "sku", F.col("stock_value").alias("prev_stock_value"), F.col("coverage_days").alias("prev_coverage_days"),
        F.col("health_level").alias("prev_health_level"),
    )
    return health.join(prev, ["branch", "sku"], "left")


# --------------------------------------------------------------------------- K8

def time_dimension(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """K8: calendar attributes of every distinct date present in the facts."""
    d = F.col(date_col)
    return dates.select(d.alias("date")).distinct().select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.weekofyear("date").alias("week"),
        F.dayofweek("date").alias("day_of_week"),
        (F.year("date") * 100 + F.month("date")).alias("year_month"),
    )


def product_dimension(sales: DataFrame) -> DataFrame:
    """K8: one row per SKU with the branches that sell it and its first / last sale day."""
    sold = F.col("qty") > 0
    return sales.groupBy("sku").agg(
        F.countDistinct("branch").alias("branches"),
        F.min(F.when(sold, F.col("date"))).alias("first_sale"),
        F.max(F.when(sold, F.col("date"))).alias("last_sale"),
    )


def branch_dimension(stock: DataFrame) -> DataFrame:
    """K8: stores and CDs with their kind and status."""
    return stock.select("branch", "stock_place", "store_status").distinct()


def store_dimension(stock: DataFrame, branches: DataFrame) -> DataFrame:
    """K8: one row per store: status, and state and region from ``branches (branch, state, region)``."""
    stores = branch_dimension(stock).where(F.col("stock_place") == "L").drop("stock_place")
    return stores.join(branches, "branch", "left").select("branch", "store_status", "state", "region")


def cd_dimension(stock: DataFrame, branches: DataFrame) -> DataFrame:
    """K8: one row per distribution centre, with its state and region."""
    cds = branch_dimension(stock).where(F.col("stock_place") == "D").select("branch").distinct()
    return cds.join(branches, "branch", "left").select("branch", "state", "region")


def category_dimension(products: DataFrame) -> DataFrame:
    """K8: categories of ``products (sku, category)`` with their number of SKUs."""
    return products.select("sku", "category").distinct().groupBy("category").agg(F.count(F.lit(1)).alias("skus"))


def region_dimension(branches: DataFrame) -> DataFrame:
    """K8: regions with their number of states and branches."""
    per_state = branches.select("region", "state", "branch").distinct().groupBy("region", "state").agg(F.count(F.lit(1)).alias("n"))
    return per_state.groupBy("region").agg(F.count(F.lit(1)).alias("states"), F.sum("n").alias("branches"))


def sales_fact(sales: DataFrame) -> DataFrame:
    """K8: the days of the dense table on which something was sold, at its grain."""
    return sales.where(F.col("sold") > 0).select("date", "branch", "sku", "revenue_off", "qty_off", "revenue_on", "qty_on", "revenue", "qty")


def inventory_fact(stores: DataFrame, cds: DataFrame) -> DataFrame:
    """K8: current stock of stores and CDs (both masters), one row per branch x SKU."""
    cols = ("date", "branch", "sku", "stock_kind", "current_stock_qty", "current_stock_value", "in_transit", "safety_stock", "target_stock", "current_dde")
    both = [m.select(*cols).withColumn("in_transit", F.col("in_transit").cast("long")).withColumn("safety_stock", F.col("safety_stock").cast("long"))
            .withColumn("target_stock", F.col("target_stock").cast("long")) for m in (stores, cds)]
    return stack_kpis(*both)


# --------------------------------------------------------------------------- K9

def cumulative_share(df: DataFrame, value: str, key: str, partitions: int | None = None) -> DataFrame:
    """Running share of ``value`` in descending order (ties by ``key``), computed without a
    single-partition window. Rows are range-partitioned by the order; that partitioning is
    sampled, so it is checkpointed once with each row's partition before it is read twice: for
    the partitions' sums (one row each, whose prefix sums are joined back) and for the running
    sums inside the partitions."""
    order = [F.col(value).desc(), F.col(key).asc()]
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.withColumn("_v", F.col(value).cast(CENTS)).repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint()
    part = ranged.groupBy("_pid").agg(F.sum("_v").alias("_ps"))
    offsets = part.select(
        "_pid", (F.sum("_ps").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off")
    )
    total = part.agg(F.sum("_ps")).scalar()
    inner = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumn("_run", F.sum("_v").over(inner)).join(offsets, "_pid")
    cum = F.col("_run") + F.coalesce(F.col("_off"), F.lit(0).cast(CENTS))
    return running.select(*df.columns, cum.alias("_cum"), total.alias("_total"))


def abc_class(sales_by_sku: DataFrame, value: str = "revenue", key: str = "sku") -> DataFrame:
    """K9: ABC class by cumulative share of ``value`` (our rule: <= 80 % A, <= 95 % B, else C)."""
    c = cumulative_share(sales_by_sku, value, key)
    cls = (
        F.when(F.col("_cum") * 100 <= F.col("_total") * 80, F.lit("A"))
        .when(F.col("_cum") * 100 <= F.col("_total") * 95, F.lit("B"))
        .otherwise(F.lit("C"))
    )
    return c.select(
        *sales_by_sku.columns,
        safe_div(F.col("_cum").cast("double"), F.col("_total").cast("double")).alias("cumulative_share"),
        cls.alias("abc_class"),
    )


# --------------------------------------------------------------------------- K11 K12 K13

def project_stock(master: DataFrame, days: int = 7) -> DataFrame:
    """Projected stock for d = 1..days as max(0, stock - d * 7-day average quantity)
    and the coverage in days (stock / 7-day average), our rule."""
    stock = F.col("current_stock_qty").cast("double")
    rate = F.col("qty_mm7d")
    rows = master.select("branch", "sku", stock.alias("stock"), rate.alias("rate"), F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day"))
    return rows.select(
        "branch",
        "sku",
        "day",
        F.greatest(F.lit(0.0), F.col("stock") - F.col("day") * F.col("rate")).alias("projected_stock"),
        safe_div(F.col("stock"), F.col("rate")).alias("coverage_days"),
    )


def rupture_alerts(master: DataFrame) -> DataFrame:
    """Keys whose stock is below lead time x 30-day average quantity + safety stock."""
    need = F.col("lead_time") * F.col("qty_mm30d") + F.col("safety_stock")
    return master.where(F.col("current_stock_qty").cast("double") < need).select(
        "branch", "sku", F.col("current_stock_qty").cast("double").alias("stock"), need.alias("required_stock")
    )


def channel_trend(sales: DataFrame, by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """Monthly offline / online revenue, online share and change on the previous month
    (window per ``by`` over months: one row per month, bounded by the history)."""
    monthly = sales.groupBy(*by, "year_month").agg(
        _sum_cents("revenue_off").alias("off"), _sum_cents("revenue_on").alias("on")
    )
    total = F.col("off") + F.col("on")
    w = Window.partitionBy(*by).orderBy("year_month")
    prev = F.lag(total).over(w)
    return monthly.select(
        *by,
        "year_month",
        F.col("off").cast("double").alias("revenue_off"),
        F.col("on").cast("double").alias("revenue_on"),
        safe_div(F.col("on").cast("double"), total.cast("double")).alias("online_share"),
        safe_div((total - prev).cast("double"), prev.cast("double")).alias("revenue_change"),
    )


# --------------------------------------------------------------------------- A12 U2 A13

def stack_kpis(*kpis: DataFrame) -> DataFrame:
    """UNION ALL of one-row KPI frames with the same columns."""
    out = kpis[0]
    for k in kpis[1:]:
        out = out.unionByName(k)
    return out


def company_kpis(health: DataFrame, as_of: dt.date) -> DataFrame:
    """Total stock value and mean coverage days of one day's health table (K7 with
    ``previous``) against the previous period, with the % change: one aggregate over the
    table, one row per metric. Values are sums of cents and means of exact sums."""
    today = health.where(F.col("date") == F.lit(as_of))

    def mean(c: str) -> Column:
        return safe_div(F.sum(F.col(c).cast("decimal(20,6)")).cast("double"), F.count(c).cast("double"))

    one = today.agg(
        _sum_cents("stock_value").cast("double").alias("v"), _sum_cents("prev_stock_value").cast("double").alias("pv"),
        mean("coverage_days").alias("c"), mean("prev_coverage_days").alias("pc"),
    )

    def metric(name: str, now: str, before: str) -> Column:
        change = safe_div(F.col(now) - F.col(before), F.col(before)) * 100
        return F.struct(
            F.lit(name).alias("metric_name"), F.col(now).alias("current_value"), F.col(before).alias("previous_value"),
            change.alias("change_percentage"),
        )

    # The metric names of the documented view.
    return one.select(F.inline(F.array(metric("Total Inventory", "v", "pv"), metric("Coverage Days", "c", "pc"))))


GRAINS = ("day", "week", "month", "quarter")


def kpi_rollup(sales: DataFrame, grain: str = "month", by: tuple[str, ...] = ("branch",)) -> DataFrame:
    """Revenue, quantity and sale days per period of ``grain`` and ``by``, with
    ROLLUP subtotals over ``by`` (NULL = all)."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    period = F.date_trunc(grain, F.col("date")).cast("date").alias("period")
    return (
        sales.select(period, *by, "revenue", "qty", "sold")
        .rollup("period", *by)
        .agg(
            _sum_cents("revenue").cast("double").alias("revenue"),
            _sum_cents("qty").cast("double").alias("qty"),
            F.sum("sold").cast("long").alias("sale_days"),
        )
        .where(F.col("period").isNotNull())
    )


def kpi_cube(sales: DataFrame, grain: str = "month", by: tuple[str, ...] = ("region", "category"), sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """A13 with totals that can be told apart: revenue, quantity and sale days per period of
    ``grain`` for the given grouping ``sets`` of ``by`` (every subset, a cube, by default).

    ``grouping_id`` has one bit a column of ``by``, the first the highest, set where the row is
    a total over it; ``level`` names the columns that are not summed over (``all`` if none). So
    the row of the keys that have no category (NULL, bit clear) and the total over categories
    (NULL, bit set) are two rows. Sales are summed to the finest keys before the sets copy
    rows, so the copies are of periods and keys, not of sales."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    if sets is None:
        sets = [tuple(c for i, c in enumerate(by) if not mask >> (len(by) - 1 - i) & 1) for mask in range(1 << len(by))]
    if odd := {c for s in sets for c in s} - set(by):
        raise ValueError(f"not grouped by: {sorted(odd)}")
    period = F.date_trunc(grain, F.col("date")).cast("date").alias("period")
    finest = sales.groupBy(period, *by).agg(_sum_cents("revenue").alias("revenue"), _sum_cents("qty").alias("qty"), F.sum("sold").cast("long").alias("sold"))
    out = finest.groupingSets([["period", *s] for s in sets], "period", *by).agg(
        _sum_cents("revenue").cast("double").alias("revenue"), _sum_cents("qty").cast("double").alias("qty"), F.sum("sold").alias("sale_days"),
        F.grouping_id("period", *by).alias("grouping_id"),  # the period is in every set: its bit is clear
    )
    kept = [F.when(F.shiftright("grouping_id", len(by) - 1 - i).bitwiseAND(F.lit(1)) == 0, F.lit(c)) for i, c in enumerate(by)]
    named = F.concat_ws(",", *kept)
    return out.select("period", *by, "grouping_id", F.when(named == "", F.lit("all")).otherwise(named).alias("level"), "revenue", "qty", "sale_days")


# --------------------------------------------------------------------------- J10

def main_cd(plan: DataFrame) -> DataFrame:
    """The CD of each store: the one that delivers most lines of the plan to it (ties: the
    smallest id), so that a store with several CDs is not several rows."""
    ids = plan.select(F.col("store").try_cast("int").alias("store"), F.col("delivering_cd").try_cast("int").alias("delivering_cd"))
    lines = ids.where("delivering_cd IS NOT NULL AND store IS NOT NULL").groupBy("store", "delivering_cd").agg(F.count(F.lit(1)).alias("n"))
    best = lines.groupBy("store").agg(F.min(F.struct((-F.col("n")).alias("n"), "delivering_cd")).alias("best"))
    return best.select(F.col("store").alias("branch"), F.col("best.delivering_cd").alias("cd"))


def allocation_view(master: DataFrame, stores: DataFrame, cds: DataFrame, products: DataFrame, plan: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """One row per store x SKU with the columns of the documented view: region and state
    (``stores``: branch, state, region), the store's CD (J6's plan, ``main_cd``), category
    (``products``: sku, category), stock value, coverage, value of aged stock, share of the
    last 30 days' revenue that is out of stock (K4 of the key), health level, and the stock
    value and coverage forecast after ``days`` days (K11; value at the present value per unit,
    our rule). Dimensions are unique on their keys, so no row is multiplied; AQE broadcasts
    them after measuring them."""
    key = ["branch", "sku"]
    health = inventory_health(master, as_of).where(F.col("date") == F.lit(as_of))
    units = F.col("current_stock_qty").cast("double")
    ahead = project_stock(master, days).where(F.col("day") == days).select(*key, "projected_stock")
    more = (
        master.select(*key, units.alias("_units"), F.col("qty_mm7d").alias("_rate"))
        .join(rupture_pct(master, tuple(key)).select(*key, "rupture_pct"), key)
        .join(ahead, key)
    )
    return (
        health.join(more, key)
        .join(stores.select("branch", "state", "region"), "branch")
        .join(main_cd(plan), "branch", "left")
        .join(cds.select(F.col("branch").alias("cd"), F.col("state").alias("cd_state")), "cd", "left")
        .join(products.select("sku", "category"), "sku")
        .select(
            "region", "state", F.col("cd").alias("distribution_center"), "cd_state", F.col("branch").alias("store"), "category", "sku",
            F.col("stock_value").alias("current_stock_value"), "coverage_days",
            F.when(F.col("aged"), F.col("stock_value")).otherwise(F.lit(0.0)).alias("aging_value"),
            F.col("rupture_pct").alias("rupture_percentage"), "health_level",
            (F.col("projected_stock") * safe_div(F.col("stock_value"), F.col("_units"))).alias("forecast_stock_value"),
            safe_div(F.col("projected_stock"), F.col("_rate")).alias("forecast_coverage_days"),
        )
    )
