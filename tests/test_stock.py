import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stocklens.operators import quality, stock
from stocklens.sources.contracts import GEF, GEF_METRICS, STOCK, SUPPLY_PLAN

AS_OF = dt.date(2024, 3, 3)
TS = dt.datetime(2024, 3, 3, 6, 0)


def stock_rows(spark, rows):
    return spark.createDataFrame(rows, STOCK)


def srow(branch, sku, place="L", status="ATIVA", value="10.00", cmv="5.00", day=AS_OF, ts=TS):
    return (day, sku, branch, place, status, Decimal("1.00"), Decimal(value), Decimal(cmv), ts)


def gef_row(branch, sku, base=1):
    return (AS_OF, branch, sku, *[base + k for k in range(len(GEF_METRICS))])


def test_prepare_stock_filters_and_zero_divisor(spark):
    df = stock_rows(spark, [
        srow(1, "A"),
        srow(1, "B", cmv="0.00"),
        srow(2, "A", status="INATIVA"),
        srow(3, "A", day=dt.date(2024, 3, 1)),
        srow(20, "A", place="D", status=None),
    ])
    stores = {(r.branch, r.sku): r.dde for r in stock.prepare_stock(df, "LOJA", AS_OF).collect()}
    assert stores == {(1, "A"): 2.0, (1, "B"): None}  # DDE NULL on a zero divisor (Q13)
    cds = stock.prepare_stock(df, "CD", AS_OF).collect()
    assert [(r.branch, r.stock_kind) for r in cds] == [(20, "CD")]


def test_dedupe_is_deterministic(spark):
    df = stock_rows(spark, [srow(1, "A", value="10.00"), srow(1, "A", value="30.00"), srow(1, "A", value="20.00")])
    for parts in (1, 3):
        out = stock.prepare_stock(df.repartition(parts), "LOJA", AS_OF).collect()
        assert len(out) == 1 and out[0].stock_value == Decimal("30.00")


def test_enrich_keeps_rows_and_rollup(spark):
    st = stock.prepare_stock(stock_rows(spark, [srow(1, "A"), srow(2, "A"), srow(3, "A")]), "LOJA", AS_OF)
    g = spark.createDataFrame([gef_row(1, "A", 1), gef_row(1, "A", 1), gef_row(2, "A", 3)], GEF)
    assert quality.audit_keys(stock.gef_feed(g), stock.KEYS).collect()[0].duplicate_keys == 1
    clean = stock.clean_gef(g)
    joined = stock.enrich_stock(st, clean)
    audit = quality.audit_join(st, joined, "safety_stock").collect()[0]
    assert (audit.rows_before, audit.rows_after, audit.row_growth, audit.matched_rows) == (3, 3, 0, 2)
    assert audit.match_pct == 66.67
    plan = spark.createDataFrame([(20, 21, 1), (20, 21, 1), (20, 21, 2)], SUPPLY_PLAN)
    roll = stock.rollup_gef_to_cd(stock.map_store_to_cd(clean, plan)).collect()
    assert len(roll) == 1
    r = roll[0]
    assert r.branch == 21 and r.safety_stock == 1 + 3  # summed
    assert r.lead_time == (2 + 4) / 2  # averaged


def test_audit_join_empty_input_gives_null_pct(spark):
    st = stock.prepare_stock(stock_rows(spark, []), "LOJA", AS_OF)
    audit = quality.audit_join(st, st, "dde").collect()[0]
    assert audit.rows_after == 0 and audit.match_pct is None


def test_snapshot_keeps_one_day(spark):
    from stocklens.operators import filters

    df = spark.range(3).select(F.date_add(F.lit(AS_OF), -F.col("id").cast("int")).alias("date"))
    assert filters.snapshot(df, AS_OF).count() == 1
