"""End-to-end runs: bronze (sales, stock), silver (master tables, network), each output
written once. Bronze sales are read back from storage by the silver step, as in the
reference's layering, so each layer can run (and be retried) on its own."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stocklens.operators import quality, stock
from stocklens.params import RunParams
from stocklens.plans import master as master_plan
from stocklens.plans import network as network_plan
from stocklens.plans import sales as sales_plan
from stocklens.plans import stock as stock_plan
from stocklens.sources import loaders, report
from stocklens.sources.original import Sources


def _store(df: DataFrame, params: RunParams, stem: str, path: str, catalog: bool) -> None:
    """An output as files at ``path``, or with ``catalog`` as the published table of its name."""
    if catalog:
        loaders.publish_table(df, params.table(stem), path.rpartition("/")[0], params.table_format)
    else:
        loaders.save_table(df, params.table(stem), params.table_format, path)


def _stored(spark: SparkSession, params: RunParams, stem: str, path: str, catalog: bool) -> DataFrame:
    return spark.table(params.table(stem)) if catalog else spark.read.format(params.table_format).load(path)


def run_bronze(src: Sources, params: RunParams, out: str, at: dt.datetime | None = None, catalog: bool = False) -> dict[str, int]:
    """Sales and stock bronze tables; returns what was observed while they were written: row
    counts, the run summary of the sales (V5), duplicate keys of the feed (V2), and matched
    rows of the store join (V3). Stops before anything is written when there are no sales or
    no stock at all (V1)."""
    quality.require_rows(src.rated_sales, what="sales of the window")
    quality.require_rows(src.stock, what="stock rows")
    sales = sales_plan.sales_bronze(src.rated_sales, src.quantity_sales, params, at)
    sales, summary = quality.observed_run(sales, params, "sales_rows")
    _store(sales, params, "vendas_90d_on_off", f"{out}/sales", catalog)
    stores, cds = stock_plan.stock_bronze(src.stock, src.gef, src.supply_plan_stock, params, at)
    stores, o_st = quality.observed(stores, "store_rows", "safety_stock")
    cds, o_cd = quality.observed(cds, "cd_rows", "safety_stock")
    _store(stores, params, "estoque_lojas", f"{out}/stock_stores", catalog)
    _store(cds, params, "estoque_cds", f"{out}/stock_cds", catalog)
    duplicates = quality.audit_keys(stock.gef_feed(src.gef), stock.KEYS).first()
    seen = summary.row()
    return {
        "sales": seen["rows"], "sales_keys": seen["keys"], "sales_branches": seen["distinct_branches"], "sales_days": seen["distinct_days"],
        "stock_stores": o_st.get["rows"], "stock_cds": o_cd.get["rows"],
        "stores_matched": o_st.get["matched"], "cds_matched": o_cd.get["matched"],
        "gef_duplicate_keys": duplicates.duplicate_keys, "gef_rows_in_duplicates": duplicates.rows_in_duplicates,
    }


def run_master(spark: SparkSession, params: RunParams, out: str, catalog: bool = False) -> dict[str, int]:
    """Master tables from the written bronze tables."""
    sales = _stored(spark, params, "vendas_90d_on_off", f"{out}/sales", catalog)
    stores = _stored(spark, params, "estoque_lojas", f"{out}/stock_stores", catalog)
    cds = _stored(spark, params, "estoque_cds", f"{out}/stock_cds", catalog)
    summary = master_plan.summary(sales, params).persist()  # two consumers
    try:
        m_st, m_cd = master_plan.master_tables(sales, stores, cds, params, summary_df=summary)
        m_st, o1 = quality.observed(m_st, "master_store_rows")
        m_cd, o2 = quality.observed(m_cd, "master_cd_rows")
        _store(m_st, params, "master_vendas_estoque_lojas", f"{out}/master_stores", catalog)
        _store(m_cd, params, "master_vendas_estoque_cds", f"{out}/master_cds", catalog)
    finally:
        summary.unpersist()
    return {"master_stores": o1.get["rows"], "master_cds": o2.get["rows"]}


def run_network(plan: DataFrame, out: str, at: dt.datetime | None = None) -> network_plan.Network:
    """Network node / edge tables and the report."""
    net = network_plan.build_network(plan)
    report.write_network_report(network_plan.network_report(net, at), net.nodes, net.edges, f"{out}/network")
    return net


def run_all(spark: SparkSession, src: Sources, params: RunParams, out: str, catalog: bool = False) -> dict[str, int]:
    counts = run_bronze(src, params, out, catalog=catalog)
    counts.update(run_master(spark, params, out, catalog))
    run_network(src.supply_plan, out)
    return counts
