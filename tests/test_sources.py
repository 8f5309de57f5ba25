import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stocklens.operators import quality
from stocklens.params import RunParams
from stocklens.sources import contracts, loaders
from stocklens.sources.contracts import ContractError

from conftest import SF_SMALL


def test_conform_casts_and_rejects_missing(spark):
    df = spark.createDataFrame([("k", "2.50", "2024-01-01")], "fact_key string, quantity string, invoice_date string")
    out = contracts.conform(df, contracts.QUANTITY_SALES)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "decimal(18,2)", "date"]
    with pytest.raises(ContractError):
        contracts.conform(df.drop("quantity"), contracts.QUANTITY_SALES)
    with pytest.raises(ContractError):
        contracts.require_columns(df, ["nope"])


def test_load_save_and_describe(spark, scratch):
    nation = loaders.load(spark, "nation", root=SF_SMALL)
    loaders.save_table(nation, "nation_copy", path=f"{scratch}/nation")
    back = spark.read.parquet(f"{scratch}/nation")
    assert back.count() == nation.count() == 25
    desc = quality.describe_table(back).collect()
    assert [r.column_name for r in desc] == nation.columns
    assert loaders.load_sql(spark, f"SELECT * FROM parquet.`{SF_SMALL}/region.parquet`").count() == 5


def test_run_frame_and_params():
    p = RunParams.for_mode("TEST", as_of=dt.date(2024, 3, 10))
    assert p.lookback_days == 1 and p.start == dt.date(2024, 3, 9) and p.sampled
    assert RunParams.for_mode("RUN").lookback_days == 90
    assert RunParams(env="PROD").table("vendas_90d_on_off") == "supply_prod_vendas_90d_on_off"
    with pytest.raises(ValueError):
        RunParams(month_mode="weekly")


def test_dev_sample_keeps_whole_keys_on_both_sides(spark):
    p = RunParams(mode="TEST", sample_buckets=4)
    df = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("fact_key"), "id")
    kept = quality.dev_sample(df.repartition(5), ("fact_key",), p)
    keys = {r.fact_key for r in kept.select("fact_key").distinct().collect()}
    assert 150 < len(keys) < 350 and kept.count() == 4 * len(keys)
    other = quality.dev_sample(df.select("fact_key").distinct(), ("fact_key",), p)
    assert {r.fact_key for r in other.collect()} == keys
    assert quality.dev_sample(df, ("fact_key",), RunParams()).count() == 4000  # RUN never samples


def original_layout(spark, folder):
    """Tables in the source system's layout, written as parquet."""
    from stocklens.sources import original

    def write(name, rows, names, schema):
        path = f"{folder}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(path)
        df = spark.read.parquet(path)
        assert df.columns == list(names.values())
        return df

    rated = write("rated", [
        ("a", 20240229, "2 - NOVO", "LOJA FISICA", "10.50", "1.25", "S1", 1, 9), ("b", 20240301, "2 - NOVO", "SITE", "3.00", "1.00", "S1", 1, 22),
        ("c", 20231231, "2 - NOVO", "SITE", "3.00", "1.00", "S1", 1, 22), ("d", 20240301, "1 - SALDO", "SITE", "3.00", "1.00", "S1", 1, 22),
    ], original.RATED_SALES, "ChaveFatos string, DtAprovacao int, NmEstadoMercadoria string, NmTipoNegocio string, VrOperacao string, "
       "VrCustoContabilFilialSku string, CdSkuLoja string, CdFilialVenda int, CdFilialEmissao int")
    quantity = write("quantity", [("a", "2.00", 20240229), ("b", "1.00", 20240301), ("c", "1.00", 20231231)], original.QUANTITY_SALES,
                     "ChaveFatos string, QtMercadoria string, DtEmissaoFaturamento int")
    day = dt.datetime(2024, 3, 1, 12)  # the same day in the session's time zone
    stock = write("stock", [
        ("2024-03-01", "S1", 1, "L", "ATIVA", "5.00", "50.00", "25.00", day), ("2024-03-01", "S1", 22, "D", "ATIVA", "8.00", "80.00", "0.00", day),
        ("2024-02-01", "S1", 1, "L", "ATIVA", "1.00", "1.00", "1.00", day),
    ], original.STOCK, "DtAtual string, CdSku string, CdFilial int, DsEstoqueLojaDeposito string, StLoja string, QtEstoque string, VrTotalVv string, "
       "VrVndCmv string, data_ingestao timestamp")
    gef = write("gef", [("2024-03-01", 1, "S1", *range(1, 21)), ("2024-03-01", 1, "S1", *range(1, 21))], original.GEF,
                "DATA_ANALISE string, FILIAL_AJ int, CODIGO_ITEM string, " + ", ".join(f"{o} int" for n, o in original.GEF.items() if n not in ("stock_date", "branch", "sku")))
    plan = write("plan", [("0022", "0022", "0001"), ("0030", "0022", "0001"), ("x", "0030", None)], original.SUPPLY_PLAN,
                 "CdFilialAtende string, CdFilialEntrega string, CdLoja string")
    return rated, quantity, stock, gef, plan


def test_bronze_starts_from_the_source_layout(spark, scratch):
    from stocklens.plans.run import run_bronze, run_network
    from stocklens.sources import original

    params = RunParams(as_of=dt.date(2024, 3, 1), lookback_days=30)
    tables = original_layout(spark, scratch)
    src = original.adapted(*tables, params)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # the whole plan
    scan = src.rated_sales._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(DtAprovacao,20240131)" in scan and "LessThanOrEqual(DtAprovacao,20240301)" in scan
    seen = run_bronze(src, params, f"{scratch}/out")
    assert seen["sales"] == 2 * 31 and (seen["stock_stores"], seen["stock_cds"]) == (1, 1)
    assert (seen["stores_matched"], seen["cds_matched"], seen["gef_duplicate_keys"], seen["gef_rows_in_duplicates"]) == (1, 1, 1, 2)
    sold = spark.read.parquet(f"{scratch}/out/sales").where("sold > 0").select("branch", "sku", "revenue", "qty").collect()
    assert sorted(map(tuple, sold)) == [(1, "S1", 10.5, 2.0), (22, "S1", 3.0, 1.0)]
    net = run_network(src.supply_plan, f"{scratch}/out")
    assert {r.node for r in net.cd_nodes.collect()} == {"0022", "0030", "x"}
    with pytest.raises(ContractError):
        original.rated_sales(tables[0].drop("VrOperacao"), params.start, params.as_of)
    none = original.adapted(tables[0].where("DtAprovacao < 0"), *tables[1:], params)
    with pytest.raises(ValueError):
        run_bronze(none, params, f"{scratch}/none")


def test_scaled_is_exact_for_decimals_and_doubles(spark):
    from stocklens.functions.columns import scaled

    rows = spark.sql("SELECT CAST('9007199254740993.07' AS DECIMAL(18,2)) AS a, CAST('-12.34' AS DECIMAL(18,2)) AS b, 1234.56D AS c, CAST('987654321098.7654' AS DECIMAL(24,4)) AS e")
    r = rows.select(scaled("a"), scaled("b"), scaled("c"), scaled("e", 4)).first()
    assert tuple(r) == (900719925474099307, -1234, 123456, 9876543210987654)


def test_ingest_append_partitions(spark, scratch):
    region = loaders.load(spark, "region", root=SF_SMALL)
    at = dt.datetime(2024, 5, 6, 7, 0)
    loaders.ingest_append(region, f"{scratch}/landing", "tpch", at=at)
    loaders.ingest_append(region, f"{scratch}/landing", "tpch", at=at)
    back = spark.read.parquet(f"{scratch}/landing")
    assert back.count() == 10
    assert os.path.isdir(f"{scratch}/landing/year=2024/month=5/day=6")
    assert back.select("source_system").distinct().first()[0] == "tpch"


def test_a_batch_lands_once_however_often_it_runs(spark, scratch):
    region = loaders.load(spark, "region", root=SF_SMALL)
    at, path = dt.datetime(2024, 5, 6, 7, 0), f"{scratch}/landing"
    for _ in range(2):
        loaders.ingest_batch(region, path, "tpch", "2024-05-06", at=at)
    loaders.ingest_batch(region.limit(2), path, "tpch", "2024-05-07", at=dt.datetime(2024, 5, 7))
    landed = loaders.read_landing(spark, path, region.schema)
    assert sorted((r.batch, r.day, r["count"]) for r in landed.groupBy("batch", "day").count().collect()) == [("2024-05-06", 6, 5), ("2024-05-07", 7, 2)]
    failing = region.withColumn("r_name", F.when(F.col("r_regionkey") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("r_name")))
    with pytest.raises(Exception, match="lost"):
        loaders.ingest_batch(failing, path, "tpch", "2024-05-07", at=dt.datetime(2024, 5, 7))
    assert landed.where("batch = '2024-05-06'").count() == 5  # other batches are not touched
    loaders.ingest_batch(region, path, "tpch", "2024-05-07", at=dt.datetime(2024, 5, 7))  # the rerun repairs its own
    assert loaders.read_landing(spark, path, region.schema).where("day = 7").count() == 5
    with pytest.raises(ValueError):
        loaders.ingest_batch(region, path, "tpch", "a/b")


def test_published_table_is_whole_at_any_time(spark, scratch):
    import uuid

    name = f"published_{uuid.uuid4().hex}"
    region = loaders.load(spark, "region", root=SF_SMALL).select("r_regionkey", "r_name")
    first = loaders.publish_table(region, name, scratch)
    assert spark.table(name).count() == 5
    failing = region.withColumn("r_name", F.when(F.col("r_regionkey") == 3, F.raise_error(F.lit("killed"))).otherwise(F.col("r_name")))
    with pytest.raises(Exception, match="killed"):
        loaders.publish_table(failing, name, scratch)
    assert spark.table(name).count() == 5 and loaders.published_location(spark, name).endswith(first.rpartition("/")[2])
    before = spark.table(name)
    second = loaders.publish_table(region.where("r_regionkey < 2"), name, scratch)
    assert spark.table(name).count() == 2 and second != first
    assert before.count() == 5 or before.count() == 2  # a reader that has begun has a whole version
    assert spark.read.parquet(first).count() == 5  # the earlier version's files stay
    loaders.publish_table(region.withColumn("more", F.lit(1)), name, scratch)  # another schema
    assert spark.table(name).columns == ["r_regionkey", "r_name", "more"] and spark.table(name).count() == 5


def test_invalid_integer_dates_are_null(spark):
    from stocklens.functions.dates import date_from_int

    rows = spark.createDataFrame([(20240229,), (20230229,), (0,), (None,), (99999999,)], "d int")
    assert [r[0] for r in rows.select(date_from_int("d")).collect()] == [dt.date(2024, 2, 29), None, None, None, None]


def test_observed_write_equals_the_operators(spark, scratch):
    from stocklens.plans.fixtures import Inputs
    from stocklens.operators import sales, stock

    i = Inputs(spark, SF_SMALL)
    dense = sales.dense_daily_sales(i.rated_sales, i.quantity_sales, i.params.start, i.params.as_of)
    out, summary = quality.observed_run(dense, i.params)
    loaders.save_table(out, "sales", path=f"{scratch}/sales")
    seen, plain = summary.row(), quality.run_summary(dense, i.params).first()
    assert (seen["rows"], seen["distinct_branches"], seen["distinct_days"], seen["first_day"]) == (plain.rows, plain.distinct_branches, plain.distinct_days, plain.first_day)
    assert seen["keys"] == dense.select("branch", "sku").distinct().count()
    out, small = quality.observed_run(dense.withColumn("branch", F.col("branch") + 40000), i.params)
    loaders.save_table(out, "sales", path=f"{scratch}/beyond")
    assert small.row()["distinct_branches"] is None and small.row()["rows"] == plain.rows  # beyond the bitmap: not counted
    out, wide = quality.observed_run(dense.withColumn("branch", F.col("branch") + 40000), i.params, branch_limit=1 << 20)
    loaders.save_table(out, "sales", path=f"{scratch}/within")
    assert wide.row()["distinct_branches"] == plain.distinct_branches
    left = stock.prepare_stock(i.stock, "LOJA", i.params.as_of)
    joined, audit = quality.observed_join(left, lambda rows: stock.enrich_stock(rows, stock.clean_gef(i.gef)), "safety_stock")
    loaders.save_table(joined, "stock", path=f"{scratch}/stock")
    expect = quality.audit_join(left, stock.enrich_stock(left, stock.clean_gef(i.gef)), "safety_stock").first()
    assert audit.row() == expect.asDict()


def test_statistics_read_the_table_once(spark, scratch):
    from stocklens.operators import sales
    from stocklens.plans.fixtures import Inputs

    i = Inputs(spark, SF_SMALL)
    dense = sales.dense_daily_sales(i.rated_sales, i.quantity_sales, i.params.start, i.params.as_of)
    dense.write.parquet(f"{scratch}/dense")
    table = spark.read.parquet(f"{scratch}/dense")
    for made in (sales.sales_stats(table), quality.run_summary(table, i.params), quality.distinct_count(table, ("branch", "sku", "date"))):
        assert made._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    assert quality.distinct_count(table, ("branch", "sku")).first()[0] == table.select("branch").distinct().count()
    none = table.where("branch < 0")
    assert quality.run_summary(none, i.params).first().rows == sales.sales_stats(none).first().total_rows == 0


def test_job_arguments_and_modes():
    from stocklens import job

    names = [x for n in ("rated-sales", "quantity-sales", "stock", "gef", "supply-plan") for x in (f"--{n}", f"db.{n}")]
    args = job.arguments(["--mode", "TEST", "--env", "PROD", "--as-of", "2024-03-01", "--root", "/x", *names])
    assert (args.mode, args.env, args.as_of, args.rated_sales) == ("TEST", "PROD", dt.date(2024, 3, 1), "db.rated-sales")
    with pytest.raises(SystemExit):
        job.arguments(["--root", "/x"])


def test_job_runs_from_catalog_to_catalog(spark, scratch):
    import uuid

    from stocklens import job

    token = uuid.uuid4().hex
    tables = {}
    for name, df in zip(("rated_sales", "quantity_sales", "stock", "gef", "supply_plan"), original_layout(spark, scratch), strict=True):
        tables[name] = f"source_{name}_{token}"
        loaders.publish_table(df, tables[name], f"{scratch}/source")
    params = RunParams(as_of=dt.date(2024, 3, 1), lookback_days=30, source_prefix=f"p{token}")
    for _ in range(2):  # a second run replaces the first one's tables
        counts = job.run_job(spark, params, tables, f"{scratch}/out", network=False)
    assert (counts["sales"], counts["sales_keys"], counts["sales_days"], counts["sales_branches"]) == (62, 2, 31, 2)
    sold = spark.table(params.table("vendas_90d_on_off")).where("sold > 0").select("branch", "revenue").collect()
    assert sorted(map(tuple, sold)) == [(1, 10.5), (22, 3.0)]
    assert spark.table(params.table("master_vendas_estoque_lojas")).count() == 1
    kept = spark.table(params.table("vendas_90d_on_off")).count()
    with pytest.raises(ValueError):
        job.run_job(spark, RunParams(as_of=dt.date(1990, 1, 1), source_prefix=f"p{token}"), tables, f"{scratch}/out", network=False)
    assert spark.table(params.table("vendas_90d_on_off")).count() == kept  # nothing was published


def test_document_is_bounded_and_read_back(spark, scratch):
    from stocklens.operators import graph as G
    from stocklens.plans import network as N
    from stocklens.sources import report

    plan = spark.createDataFrame([("0022", "0030", "1"), ("0030", "0031", "2"), ("0031", "0022", None)], "supplying_cd string, delivering_cd string, store string")
    net = N.build_network(plan)
    row = N.network_report(net, dt.datetime(2024, 1, 1))
    report.write_report_document(row, net.nodes, net.edges, f"{scratch}/document")
    back = report.read_network_report(spark, f"{scratch}/document")
    assert back.count() == 1
    assert report.report_edges(back).count() == net.edges.count() and report.report_nodes(back).count() == net.nodes.count()
    cds = {r.id: (r.scc_size, r.em_ciclo) for r in report.report_nodes(back).where(F.col("grafo") == G.CD_CD).collect()}
    assert cds == {"0022": (3, True), "0030": (3, True), "0031": (3, True)}
    assert back.first().metadata.data_processamento == "2024-01-01 00:00:00"
    with pytest.raises(ValueError):
        report.write_report_document(row, net.nodes, net.edges, f"{scratch}/more", rows=3)


def test_streaming_ingest_available_now(spark, scratch):
    from stocklens.streaming.ingest import source_stream, start_ingest

    src = f"{scratch}/incoming"
    loaders.load(spark, "nation", root=SF_SMALL).write.parquet(f"{src}/batch1")
    schema = spark.read.parquet(f"{src}/batch1").schema
    stream = source_stream(spark, f"{src}/*", schema)
    q = start_ingest(stream, f"{scratch}/landed", f"{scratch}/stream-ckpt", "tpch")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{scratch}/landed").count() == 25
    # a second run with no new files writes nothing more (exactly once)
    q = start_ingest(source_stream(spark, f"{src}/*", schema), f"{scratch}/landed", f"{scratch}/stream-ckpt", "tpch")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{scratch}/landed").count() == 25


def test_original_names(spark):
    from stocklens.functions.names import original_name, with_original_names

    df = spark.createDataFrame([(1, "A", 2.0, 3.0)], "branch int, sku string, revenue_off double, qty_mm7d double")
    assert with_original_names(df).columns == ["CdFilial", "CdSku", "Receita_OFF", "QtMercadoria_MM7d"]
    assert original_name("revenue_last30d") == "Receita_Last30d"
    assert original_name("unknown_col") == "unknown_col"
