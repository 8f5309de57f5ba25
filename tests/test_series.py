"""Trend and season of sales, stock health over snapshots, totals that can be told apart."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stocklens.operators import kpis, series

DAY = dt.date(2001, 6, 30)
LINES = "date date, branch int, channel string, sale_value decimal(18,2)"


def months(first, n):
    return [dt.date(first.year + (first.month - 1 + k) // 12, (first.month - 1 + k) % 12 + 1, 1) for k in range(n)]


def lines_of(values):
    """One line per (branch, month, value), on some day of the month."""
    rng = random.Random(1)
    return [(m.replace(day=rng.randint(1, 28)), b, "OFF", f"{v:.2f}") for b, m, v in values]


def monthly(spark, values, end=DAY):
    rows = spark.createDataFrame(lines_of(values), "date date, branch int, channel string, v string").withColumn("sale_value", F.col("v").cast("decimal(18,2)"))
    return series.monthly_sales(rows, end)


def test_months_without_sales_are_zero(spark):
    got = monthly(spark, [(1, dt.date(2001, 1, 1), 5), (1, dt.date(2001, 4, 1), 7), (1, dt.date(2001, 4, 1), 1), (2, dt.date(2001, 6, 1), 3)]).collect()
    found = {(r.branch, r.month.month): (r.position, r.cents) for r in got}
    assert found == {(1, 1): (0, 500), (1, 2): (1, 0), (1, 3): (2, 0), (1, 4): (3, 800), (1, 5): (4, 0), (1, 6): (5, 0), (2, 6): (0, 300)}


def test_trend_is_the_least_squares_slope(spark):
    rng = random.Random(3)
    start = dt.date(1998, 9, 1)
    values = [(b, m, round(1000 * b + 13.25 * k + rng.random() * 50, 2)) for b in (1, 2, 3) for k, m in enumerate(months(start, 34))]
    values += [(9, dt.date(2001, 2, 1), 4.0)]  # five months
    table = monthly(spark, values)
    got = {r.branch: r for r in series.sales_trend(table).collect()}
    expect = {r.branch: r.slope for r in table.groupBy("branch").agg(F.regr_slope(F.col("cents") / 100.0, F.col("position").cast("double")).alias("slope")).collect()}
    for b in (1, 2, 3):
        assert got[b].months == 34 and got[b].trend == pytest.approx(expect[b], rel=1e-9)
        assert got[b].trend_share == pytest.approx(got[b].trend / (got[b].revenue / 34), rel=1e-12)
    assert (got[9].months, got[9].trend, got[9].trend_share) == (5, None, None)


def test_season_of_whole_years(spark):
    shape = [2, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0]
    values = [(1, m, 100.0 * (y + 1) * shape[m.month - 1]) for y in range(3) for m in months(dt.date(1998 + y, 1, 1), 12)]
    values += [(2, m, 10.0) for m in months(dt.date(2000, 1, 1), 12)]  # one whole year only
    table = monthly(spark, [v for v in values if v[2]])
    got = {(r.branch, r.calendar_month): (r.years, r.season_index) for r in series.season_index(table).collect()}
    assert [got[1, m] for m in range(1, 13)] == [(3, pytest.approx(float(x), abs=1e-6)) for x in shape]
    assert all(got[2, m] == (1, None) for m in range(1, 13))  # too short a history
    adjusted = {(r.branch, r.month): r for r in series.season_adjusted(table).collect()}
    r = adjusted[1, dt.date(1999, 1, 1)]
    assert (r.revenue, r.revenue_year_before, r.change_on_year) == (400.0, 200.0, 1.0)
    assert r.adjusted_revenue == pytest.approx(200.0)
    december = adjusted[1, dt.date(1999, 12, 1)]
    assert (december.revenue, december.change_on_year, december.adjusted_revenue) == (0.0, None, None)
    assert adjusted[2, dt.date(2000, 5, 1)].adjusted_revenue is None


def test_no_sales_no_series(spark):
    empty = series.monthly_sales(spark.createDataFrame([], LINES), DAY)
    assert series.sales_trend(empty).collect() == series.season_index(empty).collect() == series.season_adjusted(empty).collect() == []


SNAPSHOT = "date date, branch int, sku string, stock_value double, coverage_days int, health_level string"


def test_series_over_missing_days(spark):
    day = lambda n: DAY - dt.timedelta(days=n)
    rows = [(day(40), 1, "A", 100.0, 10, "ok"), (day(29), 1, "A", 50.0, 5, "critical"), (day(1), 1, "A", None, None, "critical"), (day(0), 1, "A", 75.0, 7, "low"),
            (day(0), 1, "B", 8.0, 1, "low")]
    got = {(r.date, r.sku): r for r in series.health_series(spark.createDataFrame(rows, SNAPSHOT).repartition(3), 30).collect()}
    last = got[DAY, "A"]
    assert (last.prev_date, last.days_since_prev, last.prev_stock_value, last.value_change) == (day(1), 1, None, None)
    assert (last.snapshots_in_window, last.critical_days, last.mean_stock_value) == (3, 2, 62.5)  # 29 days back is in, 40 is not
    second = got[day(29), "A"]
    assert (second.prev_date, second.days_since_prev, second.prev_health_level, second.value_change) == (day(40), 11, "ok", -0.5)
    assert (got[DAY, "B"].prev_date, got[DAY, "B"].snapshots_in_window) == (None, 1)
    totals = {r.date: r for r in series.health_totals(spark.createDataFrame(rows, SNAPSHOT)).collect()}
    assert (totals[DAY].stock_value, totals[DAY].coverage_days, totals[DAY].low_keys, totals[DAY].prev_date) == (83.0, 4.0, 2, day(1))
    assert totals[day(29)].value_change == -0.5


def test_snapshots_are_pruned_and_replaced_by_partition(spark, scratch):
    from stocklens.sources.loaders import overwrite_partitions

    rows = [(DAY - dt.timedelta(days=k), 1, "A", float(k), 1, "ok") for k in range(4)]
    df = spark.createDataFrame(rows, SNAPSHOT)
    path = f"{scratch}/snapshots"
    overwrite_partitions(df, path, ("date",))
    overwrite_partitions(df.where(F.col("date") == F.lit(DAY)).withColumn("stock_value", F.lit(9.0)), path, ("date",))
    read = series.between_days(spark.read.parquet(path), DAY - dt.timedelta(days=1), DAY)
    assert sorted(r.stock_value for r in read.collect()) == [1.0, 9.0]
    assert spark.read.parquet(path).count() == 4
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in scan
    assert sum(read.inputFiles() != [] and f"date={DAY}" in f for f in spark.read.parquet(path).inputFiles()) == 1


def test_totals_differ_from_keys_without_category(spark):
    rows = [(DAY, "N", "A", 1.0, 1.0, 1), (DAY, "N", None, 2.0, 1.0, 1), (DAY, "S", None, 4.0, 1.0, 0), (DAY, None, "A", 8.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "date date, region string, category string, revenue double, qty double, sold int")
    got = {(r.level, r.region, r.category): (r.grouping_id, r.revenue) for r in kpis.kpi_cube(df).collect()}
    assert got["all", None, None] == (3, 15.0)
    assert got["category", None, None] == (2, 6.0)  # no category, over all regions
    assert got["region", None, None] == (1, 8.0)  # no region, over all categories
    assert got["region,category", "N", None] == (0, 2.0)
    assert got["region", "N", None] == (1, 3.0)
    assert len(got) == 4 + 3 + 2 + 1
    some = kpis.kpi_cube(df, sets=[("region",), ()]).collect()
    assert sorted(r.level for r in some) == ["all", "region", "region", "region"]
    with pytest.raises(ValueError):
        kpis.kpi_cube(df, sets=[("state",)])
