import datetime as dt

from pyspark.sql import functions as F

from stocklens.functions.dates import period_bounds
from stocklens.operators import master, sales
from stocklens.plans.fixtures import Inputs

from conftest import SF_SMALL


def test_m3_is_the_third_previous_month_all_year():
    for month in range(1, 13):
        b = period_bounds(dt.date(2025, month, 15))
        assert len({b["m1"], b["m2"], b["m3"]}) == 3  # the "minus 62 days" rule repeats M2 in Feb/Sep (Q2)
        assert b["m3"].day == 1
    b = period_bounds(dt.date(2025, 9, 30))
    assert (b["m1"], b["m2"], b["m3"]) == (dt.date(2025, 8, 1), dt.date(2025, 7, 1), dt.date(2025, 6, 1))
    assert b["last7d"] == dt.date(2025, 9, 23)  # "last 7 days" keeps 8 days (Q4)


def _dense(spark):
    i = Inputs(spark, SF_SMALL)
    return i, sales.dense_daily_sales(i.rated_sales, i.quantity_sales, i.params.start, i.params.as_of)


def test_fused_moving_average_equals_window_on_last_day(spark):
    i, dense = _dense(spark)
    cols = [f"{m}_mm{n}d" for n in master.MA_DAYS for m in master.MEASURES]
    by_window = master.latest_per_key(master.moving_averages(dense), master.KEY, "date", cols)
    fused = master.sales_summary(dense, i.params.as_of).select(*master.KEY, *cols)
    assert by_window.exceptAll(fused).count() == 0 and fused.exceptAll(by_window).count() == 0


def test_month_modes_differ_only_in_previous_months(spark):
    i, dense = _dense(spark)
    a = master.period_totals(dense, i.params.as_of, "first_day")
    b = master.period_totals(dense, i.params.as_of, "full_month")
    same = [c for c in a.columns if not c.endswith(("_m1", "_m2", "_m3"))]
    assert a.select(*same).exceptAll(b.select(*same)).count() == 0
    tot = b.agg(F.sum("revenue_m1")).first()[0]
    first_day = a.agg(F.sum("revenue_m1")).first()[0]
    assert tot >= first_day


def test_summary_day_statistics(spark):
    i, dense = _dense(spark)
    s = master.sales_summary(dense, i.params.as_of)
    days = (i.params.as_of - i.params.start).days + 1
    row = s.agg(F.min("grid_days"), F.max("grid_days"), F.max("active_days"), F.min("grid_first"), F.max("grid_last")).first()
    assert row[0] == row[1] == days  # the zero-filled grid: every key has every day (Q22)
    assert row[2] <= days
    assert (row[3], row[4]) == (i.params.start, i.params.as_of)


def test_build_master_keeps_stock_rows_and_fills_only_sales_columns(spark):
    i, dense = _dense(spark)
    from stocklens.operators import stock

    st = stock.enrich_stock(stock.prepare_stock(i.stock, "LOJA", i.params.as_of), stock.clean_gef(i.gef))
    cur = master.current_stock(st, i.params.as_of)
    m = master.build_master(cur, master.sales_summary(dense, i.params.as_of), i.params.as_of)
    assert m.count() == cur.count()
    sales_cols = [c for c in m.columns if c.startswith(("revenue_", "qty_"))]
    assert m.where(" OR ".join(f"{c} IS NULL" for c in sales_cols)).count() == 0
    # keys without sales keep NULL day statistics (Q8)
    no_sales = m.where("grid_days IS NULL")
    assert no_sales.where("revenue_total <> 0").count() == 0
