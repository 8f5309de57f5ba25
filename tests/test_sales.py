import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stocklens.operators import quality, sales
from stocklens.plans.fixtures import Inputs
from stocklens.sources.contracts import QUANTITY_SALES, RATED_SALES

from conftest import SF_SMALL

D0 = dt.date(2024, 3, 1)
D1 = dt.date(2024, 3, 3)


def rated(spark, rows):
    return spark.createDataFrame(rows, RATED_SALES)


def qty(spark, rows):
    return spark.createDataFrame(rows, QUANTITY_SALES)


def line(key, day, state="2 - NOVO", btype="LOJA FISICA", value="10.00", cost="1.0000", sku="A", sell=1, issue=2):
    return (key, day, state, btype, Decimal(value), Decimal(cost), sku, sell, issue)


def test_filter_drops_balance_null_state_negative_and_null_type(spark):
    df = rated(spark, [
        line("k1", D0),
        line("k2", D0, state="1 - SALDO"),
        line("k3", D0, state=None),
        line("k4", D0, value="-1.00"),
        line("k5", D0, btype=None),
        line("k6", D0, btype="SITE"),
        line("k7", dt.date(2024, 2, 1)),
    ])
    off = {r.fact_key for r in sales.filter_sales(df, sales.OFF, D0, D1).collect()}
    on = {r.fact_key for r in sales.filter_sales(df, sales.ON, D0, D1).collect()}
    both = {r.fact_key for r in sales.filter_sales(df, None, D0, D1).collect()}
    assert off == {"k1"}
    assert on == {"k6"}  # NULL business type is in neither channel (Q: != drops NULL)
    assert both == {"k1", "k6"}


def test_dense_grid_zero_fill_and_channel_totals(spark):
    r = rated(spark, [
        line("a", D0, value="10.00"),
        line("b", D0, btype="SITE", value="5.00", issue=1),
        line("c", dt.date(2024, 3, 2), sku="B", value="7.00"),
    ])
    q = qty(spark, [("a", Decimal("2"), D0), ("b", Decimal("1"), D0), ("c", Decimal("0"), dt.date(2024, 3, 2))])
    out = sales.dense_daily_sales(r, q, D0, D1).orderBy("sku", "date").collect()
    # keys: (1, A) and (1, B); 3 days each
    assert len(out) == 6
    a0 = [x for x in out if x.sku == "A" and x.date == D0][0]
    assert (a0.revenue_off, a0.revenue_on, a0.revenue) == (10.0, 5.0, 15.0)
    assert (a0.sold_off, a0.sold_on, a0.sold) == (1, 1, 2)  # channel flags add up (Q7)
    b1 = [x for x in out if x.sku == "B" and x.date == dt.date(2024, 3, 2)][0]
    assert b1.revenue == 7.0 and b1.sold == 0  # quantity 0: revenue kept, no sale flag
    assert sum(x.revenue for x in out) == 22.0  # zero fill keeps the sums
    assert {x.year_month for x in out} == {202403}


def test_invoice_outside_window_drops_the_line(spark):
    r = rated(spark, [line("a", D1)])
    q = qty(spark, [("a", Decimal("1"), dt.date(2024, 3, 5))])  # invoiced after the window (Q10)
    assert sales.dense_daily_sales(r, q, D0, D1).count() == 0


def test_fused_plan_equals_reference_structure(spark):
    i = Inputs(spark, SF_SMALL)
    start, end = i.params.start, i.params.as_of
    fused = sales.dense_daily_sales(i.rated_sales, i.quantity_sales, start, end)
    off = sales.dense_channel_sales(i.rated_sales, i.quantity_sales, sales.OFF, start, end)
    on = sales.dense_channel_sales(i.rated_sales, i.quantity_sales, sales.ON, start, end)
    merged = sales.merge_channels(off, on)
    assert fused.exceptAll(merged.select(*fused.columns)).count() == 0
    assert merged.exceptAll(fused.select(*merged.columns)).count() == 0
    keys = fused.select("branch", "sku").distinct().count()
    assert fused.count() == keys * ((end - start).days + 1)  # grid rows = keys x days
    assert fused.where(F.col("revenue") != F.col("revenue_off") + F.col("revenue_on")).count() == 0


def test_result_unchanged_after_repartition(spark):
    i = Inputs(spark, SF_SMALL)
    a = sales.dense_daily_sales(i.rated_sales, i.quantity_sales, i.params.start, i.params.as_of)
    b = sales.dense_daily_sales(i.rated_sales.repartition(7), i.quantity_sales.repartition(3), i.params.start, i.params.as_of)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_require_rows_raises_on_all_empty(spark):
    empty = spark.createDataFrame([], RATED_SALES)
    with pytest.raises(ValueError):
        quality.require_rows(empty, empty)
    quality.require_rows(empty, rated(spark, [line("a", D0)]))


def test_top_branches_orders_by_revenue_then_id(spark):
    i = Inputs(spark, SF_SMALL)
    dense = sales.dense_daily_sales(i.rated_sales, i.quantity_sales, i.params.start, i.params.as_of)
    top = sales.top_branches(dense, 3).collect()
    assert len(top) <= 3
    assert [t.revenue_total for t in top] == sorted([t.revenue_total for t in top], reverse=True)
