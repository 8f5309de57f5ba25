import datetime as dt

from pyspark.sql import functions as F

from stocklens.operators import kpis


def test_abc_class_and_partition_independence(spark):
    rows = [(f"s{i}", float(v)) for i, v in enumerate([50, 30, 10, 5, 3, 2])]
    df = spark.createDataFrame(rows, "sku string, revenue double")
    for parts in (1, 3, 6):
        out = {r.sku: (r.abc_class, r.cumulative_share) for r in kpis.abc_class(df.repartition(parts)).collect()}
        assert out["s0"] == ("A", 0.5)
        assert out["s1"][0] == "A" and out["s1"][1] == 0.8
        assert out["s2"][0] == "B" and out["s3"][0] == "B"
        assert out["s4"][0] == "C" and out["s5"] == ("C", 1.0)


def test_kpi_rollup_grains(spark):
    days = spark.range(60).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("date"),
        F.lit(1).alias("branch"),
        F.lit(2.5).alias("revenue"),
        F.lit(1.0).alias("qty"),
        F.lit(1).alias("sold"),
    )
    monthly = {r.period: r.revenue for r in kpis.kpi_rollup(days, "month").where("branch IS NULL").collect()}
    assert monthly[dt.date(2024, 1, 1)] == 31 * 2.5 and monthly[dt.date(2024, 2, 1)] == 29 * 2.5


def test_company_kpis_now_against_before(spark):
    day = dt.date(2024, 2, 29)
    rows = [(1, "A", day, 100.0, 10, 80.0, 8), (2, "A", day, 50.0, None, 20.0, 4), (3, "B", day, 0.0, 20, None, None), (4, "B", dt.date(2024, 1, 1), 9.0, 9, 9.0, 9)]
    health = spark.createDataFrame(rows, "branch int, sku string, date date, stock_value double, coverage_days int, prev_stock_value double, prev_coverage_days int")
    k = {r.metric_name: tuple(r)[1:] for r in kpis.company_kpis(health, day).collect()}
    assert k == {"Total Inventory": (150.0, 100.0, 50.0), "Coverage Days": (15.0, 6.0, 150.0)}


def test_store_with_two_cds_is_one_allocation_row(spark):
    plan = spark.createDataFrame([("20", "0022", "0001"), ("20", "0022", "0001"), ("20", "21", "1"), ("20", "23", "2"), ("20", None, "2")],
                                 "supplying_cd string, delivering_cd string, store string")
    assert {(r.branch, r.cd) for r in kpis.main_cd(plan).collect()} == {(1, 22), (2, 23)}
    master = spark.createDataFrame([(1, "A", 10.0, 100.0, 5, 10, dt.date(2024, 2, 1), 2.0, 30.0)],
                                   "branch int, sku string, current_stock_qty double, current_stock_value double, current_cover int, target_cover int, last_sale date, qty_mm7d double, revenue_last30d double")
    places = spark.createDataFrame([(1, "S", "R"), (22, "T", "R")], "branch int, state string, region string")
    products = spark.createDataFrame([("A", "C")], "sku string, category string")
    rows = kpis.allocation_view(master, places, places, products, plan, dt.date(2024, 2, 29)).collect()
    assert len(rows) == 1 and (rows[0].distribution_center, rows[0].cd_state, rows[0].rupture_percentage) == (22, "T", 0.0)
    assert (rows[0].forecast_stock_value, rows[0].forecast_coverage_days) == (0.0, 0.0)


def test_running_share_and_quantiles_on_millions_without_exchange_reuse(spark):
    """Range partitionings are sampled: both uses must see the same one, with more columns, a hot
    group and no exchange reuse."""
    from stocklens.operators import quality

    n = 2_000_000
    df = spark.range(n).select(
        F.col("id").cast("string").alias("sku"), ((F.xxhash64("id") % 5000 + 5000) / 4).cast("double").alias("revenue"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), F.md5(F.col("id").cast("string")).alias("more"),
    )
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = kpis.abc_class(df)
        r = out.agg(F.count("*").alias("n"), F.max("cumulative_share").alias("top"), F.countDistinct("more").alias("more")).first()
        assert (r.n, r.top, r.more) == (n, 1.0, n)
        step = out.groupBy("revenue").agg(F.max("cumulative_share").alias("share"), F.sum("revenue").alias("v")).orderBy(F.desc("revenue")).collect()
        total, run = sum(s.v for s in step), 0.0
        for s in step:
            run += s.v
            assert abs(s.share - run / total) < 1e-9
        got = {r.g: (r.q0, r.q1, r.q2) for r in quality.group_quantiles(df, "revenue", ("g",), (0.25, 0.5, 0.9)).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert got == {r.g: tuple(r.p) for r in df.groupBy("g").agg(F.percentile("revenue", [0.25, 0.5, 0.9]).alias("p")).collect()}


def test_project_stock_never_negative(spark):
    m = spark.createDataFrame([(1, "A", 10.0, 4.0)], "branch int, sku string, current_stock_qty double, qty_mm7d double")
    rows = kpis.project_stock(m, 7).orderBy("day").collect()
    assert [r.projected_stock for r in rows][:4] == [6.0, 2.0, 0.0, 0.0]
    assert rows[0].coverage_days == 2.5


def test_group_quantiles_exact_and_skew_split(spark):
    import random

    from stocklens.operators import quality

    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 1000))) for _ in range(3000)] + [
        (f"g{i % 7}", float(rnd.randint(0, 50))) for i in range(300)
    ] + [("single", 5.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q0, r.q1, r.q2) for r in quality.group_quantiles(df, "v", ("g",), (0.25, 0.5, 0.9), partitions=6).collect()}
    want = {
        r.g: tuple(r.p)
        for r in df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.9]).alias("p")).collect()
        if r.p is not None
    }
    assert set(got) == set(want)
    for g, vals in want.items():
        assert got[g] == vals, g
