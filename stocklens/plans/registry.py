"""Registered queries: one per operator of the inventory, each over the whole test tables.

Every callable takes (spark, sf_dir) and returns a DataFrame whose columns carry the same
names as the matching SQL in ``oracle/queries.py``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import reduce as _reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.operators import quality, sales
from stocklens.params import RunParams
from stocklens.session import ensure_checkpoint_dir
from stocklens.sources import report, testdata
from stocklens.streaming import ingest
from stocklens.plans.fixtures import DEFAULT_PARAMS as P
from stocklens.plans.fixtures import Inputs

LINEAGE_AT = _dt.datetime(2001, 6, 30, 12, 0)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return deco


# =========================================================================== sales (M1, M2)

def _dense(i: Inputs) -> DataFrame:
    return sales.dense_daily_sales(i.rated_sales, i.quantity_sales, P.start, P.as_of)


@register("p1_filter_sales")
def _p1(i: Inputs) -> DataFrame:
    """Offline value lines of the window, projected."""
    return sales.filter_sales(i.rated_sales, sales.OFF, P.start, P.as_of).select(
        "fact_key", "approval_date", "sku", "selling_branch", F.col("sale_value").cast("double").alias("sale_value")
    )


@register("p2_filter_quantity")
def _p2(i: Inputs) -> DataFrame:
    return sales.filter_quantity(i.quantity_sales, P.start, P.as_of).select(
        "fact_key", F.col("quantity").cast("double").alias("quantity")
    )


@register("j1_join_value_quantity")
def _j1(i: Inputs) -> DataFrame:
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    return lines.select(
        "date", "sku", "branch", "channel",
        F.col("sale_value").cast("double").alias("sale_value"),
        F.col("quantity").cast("double").alias("quantity"),
    )


@register("a1_daily_sales")
def _a1(i: Inputs) -> DataFrame:
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    return sales.daily_sales(lines)


@register("j2_date_key_grid")
def _j2(i: Inputs) -> DataFrame:
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, sales.OFF)
    keys = quality.distinct_keys(lines, ("branch", "sku"))
    return sales.date_key_grid(keys, P.start, P.as_of)


@register("j3_densify")
def _j3(i: Inputs) -> DataFrame:
    return sales.dense_channel_sales(i.rated_sales, i.quantity_sales, sales.ON, P.start, P.as_of)


@register("j4_merge_channels")
def _j4(i: Inputs) -> DataFrame:
    off = sales.dense_channel_sales(i.rated_sales, i.quantity_sales, sales.OFF, P.start, P.as_of)
    on = sales.dense_channel_sales(i.rated_sales, i.quantity_sales, sales.ON, P.start, P.as_of)
    return sales.merge_channels(off, on)


@register("dense_daily_sales")
def _dense_q(i: Inputs) -> DataFrame:
    """Flagship: fused plan, same rows as j4_merge_channels."""
    return _dense(i)


@register("a2_sales_stats")
def _a2(i: Inputs) -> DataFrame:
    return sales.sales_stats(_dense(i))


@register("a3_branch_totals")
def _a3(i: Inputs) -> DataFrame:
    return sales.branch_totals(_dense(i))


@register("t1_top_branches")
def _t1(i: Inputs) -> DataFrame:
    return sales.top_branches(_dense(i), 10)


# =========================================================================== stock (M3) + audits (M2)

from stocklens.functions.columns import to_double  # noqa: E402
from stocklens.operators import filters, stock  # noqa: E402
from stocklens.sources.contracts import GEF_METRICS  # noqa: E402

STOCK_VALUES = ("stock_qty", "stock_value", "cmv_sales_value")


def _stock_out(df: DataFrame) -> DataFrame:
    """Published stock columns; decimals as double, the ingestion timestamp left out."""
    cols = [c for c in df.columns if c != "ingested_at"]
    return df.select(*[to_double(c).alias(c) if c in STOCK_VALUES else F.col(c) for c in cols])


def _stores(i: Inputs) -> DataFrame:
    return stock.enrich_stock(stock.prepare_stock(i.stock, "LOJA", P.as_of), stock.clean_gef(i.gef))


def _cds(i: Inputs) -> DataFrame:
    rollup = stock.rollup_gef_to_cd(stock.map_store_to_cd(stock.clean_gef(i.gef), i.supply_plan_stock))
    return stock.enrich_cd_stock(stock.prepare_stock(i.stock, "CD", P.as_of), rollup)


@register("p3_filter_stock")
def _p3(i: Inputs) -> DataFrame:
    rows = filters.filter_stock(i.stock, "LOJA", P.as_of).unionByName(filters.filter_stock(i.stock, "CD", P.as_of))
    return _stock_out(rows)


@register("d1_days_of_stock")
def _d1(i: Inputs) -> DataFrame:
    rows = stock.prepare_stock(i.stock, "LOJA", P.as_of).unionByName(stock.prepare_stock(i.stock, "CD", P.as_of))
    return rows.select("date", "branch", "sku", "stock_kind", "dde")


@register("p5_select_rename")
def _p5(i: Inputs) -> DataFrame:
    return stock.gef_feed(i.gef)


@register("a5_duplicate_keys")
def _a5(i: Inputs) -> DataFrame:
    return quality.duplicate_keys(stock.gef_feed(i.gef), stock.KEYS)


@register("v2_audit_keys")
def _v2(i: Inputs) -> DataFrame:
    return quality.audit_keys(stock.gef_feed(i.gef), stock.KEYS)


@register("a8_dedupe")
def _a8(i: Inputs) -> DataFrame:
    return stock.clean_gef(i.gef)


@register("j5_enrich_stock")
def _j5(i: Inputs) -> DataFrame:
    return _stock_out(_stores(i))


@register("p8_matched")
def _p8(i: Inputs) -> DataFrame:
    return filters.matched(_stock_out(_stores(i)), "safety_stock").select("date", "branch", "sku", "safety_stock")


@register("v3_audit_join")
def _v3(i: Inputs) -> DataFrame:
    left = stock.prepare_stock(i.stock, "LOJA", P.as_of)
    return quality.audit_join(left, _stores(i), "safety_stock")


@register("j6_map_store_to_cd")
def _j6(i: Inputs) -> DataFrame:
    return stock.map_store_to_cd(stock.clean_gef(i.gef), i.supply_plan_stock).select(
        "date", "branch", "sku", "delivering_cd", "safety_stock", "lead_time"
    )


@register("a4_rollup_gef_to_cd")
def _a4(i: Inputs) -> DataFrame:
    return stock.rollup_gef_to_cd(stock.map_store_to_cd(stock.clean_gef(i.gef), i.supply_plan_stock))


@register("j7_enrich_cd_stock")
def _j7(i: Inputs) -> DataFrame:
    return _stock_out(_cds(i))


@register("a7_distinct_keys")
def _a7(i: Inputs) -> DataFrame:
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    return quality.distinct_keys(lines, ("branch", "sku"))


@register("t2_ordered_dates")
def _t2(i: Inputs) -> DataFrame:
    return quality.distinct_keys(i.all_quantity_sales, ("invoice_date",)).orderBy("invoice_date").limit(10)


# =========================================================================== master (M4)

from stocklens.operators import master  # noqa: E402

MM_COLS = [f"{m}_mm{n}d" for n in master.MA_DAYS for m in master.MEASURES]


@register("w1_with_row_number")
def _w1(i: Inputs) -> DataFrame:
    return master.with_row_number(_dense(i))


@register("w2_period_totals")
def _w2(i: Inputs) -> DataFrame:
    return master.period_totals(_dense(i), P.as_of, "first_day")


@register("w2_period_totals_full_month")
def _w2f(i: Inputs) -> DataFrame:
    return master.period_totals(_dense(i), P.as_of, "full_month")


@register("w3_moving_averages")
def _w3(i: Inputs) -> DataFrame:
    return master.moving_averages(_dense(i))


@register("w4_period_bounds")
def _w4(i: Inputs) -> DataFrame:
    """Bounds of the periods for the latest day present in the sales table."""
    latest = _dense(i).agg(F.max("date").alias("as_of"))
    return latest.select("as_of", *[c.alias(n) for n, c in master.period_bounds_columns(F.col("as_of")).items()])


@register("w5_latest_per_key")
def _w5(i: Inputs) -> DataFrame:
    return master.latest_per_key(master.moving_averages(_dense(i)), master.KEY, "date", MM_COLS)


@register("a6_sales_summary")
def _a6(i: Inputs) -> DataFrame:
    return master.sales_summary(_dense(i), P.as_of, "first_day")


@register("a6_sales_summary_full_month")
def _a6f(i: Inputs) -> DataFrame:
    return master.sales_summary(_dense(i), P.as_of, "full_month")


@register("p4_snapshot")
def _p4(i: Inputs) -> DataFrame:
    return _stock_out(master.current_stock(_stores(i), P.as_of))


def _master(i: Inputs, stock_df: DataFrame) -> DataFrame:
    s = master.sales_summary(_dense(i), P.as_of, P.month_mode)
    return _stock_out(master.build_master(master.current_stock(stock_df, P.as_of), s, P.as_of))


@register("j8_build_master")
def _j8(i: Inputs) -> DataFrame:
    """Master table of stores (without the processing-time column)."""
    return _master(i, _stores(i))


@register("j8_build_master_cds")
def _j8c(i: Inputs) -> DataFrame:
    return _master(i, _cds(i))


@register("p7_fill_zero")
def _p7(i: Inputs) -> DataFrame:
    """Sales columns of the CD master: zero where a CD key had no sale."""
    m = _master(i, _cds(i))
    return m.select("branch", "sku", *[c for c in m.columns if c.startswith(("revenue_", "qty_"))])


# =========================================================================== network (M5)

from stocklens.operators import graph as G  # noqa: E402
from stocklens.plans import network as N  # noqa: E402

NODE_COLS = ("node", "node_type", "graph", "degree", "in_degree", "out_degree", "level", "scc_size", "in_cycle")


def _cd_edges(i: Inputs) -> DataFrame:
    return G.cd_cd_edges(i.supply_plan)


def _st_edges(i: Inputs) -> DataFrame:
    return G.cd_store_edges(i.supply_plan)


def _nodes(edges: tuple[DataFrame, DataFrame]) -> DataFrame:
    return G.node_metrics(*edges).select(*NODE_COLS)


def _both(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """CD->CD and CD->store edges for queries that read them more than once."""
    return G.plan_edges(i.supply_plan)[:2]


@register("p9_where_pair")
def _p9(i: Inputs) -> DataFrame:
    """Plan lines where a CD supplies itself and a store is set."""
    return filters.where_pair(i.supply_plan, "supplying_cd", "=", "delivering_cd", not_null=("store",))


@register("g1_cd_cd_edges")
def _g1(i: Inputs) -> DataFrame:
    return _cd_edges(i)


@register("g2_cd_store_edges")
def _g2(i: Inputs) -> DataFrame:
    return _st_edges(i)


@register("g3_plan_profile")
def _g3(i: Inputs) -> DataFrame:
    return G.plan_profile(i.supply_plan)


@register("g4_graph_nodes")
def _g4(i: Inputs) -> DataFrame:
    return G.graph_nodes(_cd_edges(i))


@register("g5_density")
def _g5(i: Inputs) -> DataFrame:
    return G.density(_cd_edges(i))


@register("g6_degrees")
def _g6(i: Inputs) -> DataFrame:
    return G.degrees(_cd_edges(i))


@register("g7_scc")
def _g7(i: Inputs) -> DataFrame:
    return G.scc(_cd_edges(i))


@register("g8_scc_summary")
def _g8(i: Inputs) -> DataFrame:
    return G.scc_summary(G.scc(_cd_edges(i)))


@register("g9_cd_levels")
def _g9(i: Inputs) -> DataFrame:
    return G.cd_levels(_cd_edges(i))


@register("g10_store_levels")
def _g10(i: Inputs) -> DataFrame:
    return G.store_levels(_st_edges(i))


@register("g11_node_metrics")
def _g11(i: Inputs) -> DataFrame:
    return _nodes(_both(i))


@register("g12_edge_table")
def _g12(i: Inputs) -> DataFrame:
    return G.edge_table(_cd_edges(i), _st_edges(i))


@register("g13_hierarchy_summary")
def _g13(i: Inputs) -> DataFrame:
    e = _cd_edges(i)
    return G.hierarchy_summary(G.cd_levels(e), G.sources(e).agg(F.count(F.lit(1))).scalar())


@register("a10_level_distribution")
def _a10(i: Inputs) -> DataFrame:
    return G.level_distribution(G.cd_levels(_cd_edges(i)))


@register("a11_network_totals")
def _a11(i: Inputs) -> DataFrame:
    edges = _both(i)
    return G.network_totals(_nodes(edges), G.edge_table(*edges))


@register("a9_value_counts")
def _a9(i: Inputs) -> DataFrame:
    """Plan lines per delivering CD."""
    return quality.value_counts(i.supply_plan, "delivering_cd")


@register("a9_distinct_count")
def _a9d(i: Inputs) -> DataFrame:
    return quality.distinct_count(i.supply_plan, ("supplying_cd", "delivering_cd", "store"))


@register("t3_top_out_degree")
def _t3o(i: Inputs) -> DataFrame:
    return G.top_degree(_cd_edges(i), "src", 10)


@register("t3_top_in_degree")
def _t3i(i: Inputs) -> DataFrame:
    return G.top_degree(_cd_edges(i), "dst", 10)


@register("t3_top_stores_served")
def _t3s(i: Inputs) -> DataFrame:
    return G.top_degree(_st_edges(i), "src", 10)


@register("t3_top_nodes")
def _t3n(i: Inputs) -> DataFrame:
    return G.top_nodes(_nodes(_both(i)), 10)


@register("g15_network_layout")
def _g15(i: Inputs) -> DataFrame:
    return G.network_layout(_nodes(_both(i)))


@register("j9_edge_coordinates")
def _j9(i: Inputs) -> DataFrame:
    edges = _both(i)
    return G.edge_coordinates(G.edge_table(*edges), G.network_layout(_nodes(edges)))


@register("g14_network_report")
def _g14(i: Inputs) -> DataFrame:
    """The report row at a pinned time, its structs as columns and its maps as sorted text."""
    report = N.network_report(N.build_network(i.supply_plan), processed_at=LINEAGE_AT)
    out = []
    for group in report.schema.fields:
        for f in group.dataType.fields:
            c = F.col(f"{group.name}.{f.name}")
            if f.dataType.typeName() == "map":
                c = F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), ",")
            out.append(c.alias(f"{group.name}_{f.name}"))
    return report.select(*out)


def _scratch(i: Inputs, name: str) -> str:
    """A new folder on the storage that the session names for checkpoints."""
    return f"{ensure_checkpoint_dir(i.spark)}/{name}-{uuid.uuid4().hex}"


@register("s5_read_network_report")
def _s5(i: Inputs) -> DataFrame:
    """S6 then S5: the edges of a written report, read back."""
    net, path = N.build_network(i.supply_plan), _scratch(i, "report")
    report.write_network_report(N.network_report(net, LINEAGE_AT), net.nodes, net.edges, path)
    return report.read_written_report(i.spark, path)[1]


# =========================================================================== KPIs, checks, sources (M6)

from stocklens.operators import kpis  # noqa: E402
from stocklens.sources import loaders  # noqa: E402


def _m_stores(i: Inputs) -> DataFrame:
    return _master(i, _stores(i))


def _m_cds(i: Inputs) -> DataFrame:
    return _master(i, _cds(i))


@register("k1_inventory_value")
def _k1(i: Inputs) -> DataFrame:
    return kpis.inventory_value(_m_stores(i))


@register("k2_coverage_days")
def _k2(i: Inputs) -> DataFrame:
    return kpis.coverage_days(_m_stores(i))


@register("k3_aging_value")
def _k3(i: Inputs) -> DataFrame:
    return kpis.aging_value(_m_stores(i), P.as_of, 30)


@register("k4_rupture_pct")
def _k4(i: Inputs) -> DataFrame:
    return kpis.rupture_pct(_m_stores(i))


@register("k5_stock_by_location")
def _k5(i: Inputs) -> DataFrame:
    return kpis.stock_by_location(_m_stores(i), _m_cds(i))


@register("k6_stock_by_type")
def _k6(i: Inputs) -> DataFrame:
    return kpis.stock_by_type(_m_stores(i))


@register("k7_inventory_health")
def _k7(i: Inputs) -> DataFrame:
    return kpis.inventory_health(_m_stores(i), P.as_of)


@register("k8_time_dimension")
def _k8t(i: Inputs) -> DataFrame:
    return kpis.time_dimension(_dense(i))


@register("k8_product_dimension")
def _k8p(i: Inputs) -> DataFrame:
    return kpis.product_dimension(_dense(i))


@register("k8_branch_dimension")
def _k8b(i: Inputs) -> DataFrame:
    return kpis.branch_dimension(i.stock)


@register("k9_abc_class")
def _k9(i: Inputs) -> DataFrame:
    by_sku = _dense(i).groupBy("sku").agg(F.sum(F.col("revenue").cast("decimal(28,2)")).cast("double").alias("revenue"))
    return kpis.abc_class(by_sku)


@register("k10_turnover")
def _k10(i: Inputs) -> DataFrame:
    return kpis.turnover(_m_stores(i))


@register("k11_project_stock")
def _k11(i: Inputs) -> DataFrame:
    return kpis.project_stock(_m_stores(i), 7)


@register("k12_rupture_alerts")
def _k12(i: Inputs) -> DataFrame:
    return kpis.rupture_alerts(_m_stores(i))


@register("k13_channel_trend")
def _k13(i: Inputs) -> DataFrame:
    return kpis.channel_trend(_dense(i))


PREVIOUS = P.as_of - _dt.timedelta(days=30)


def _health(i: Inputs) -> DataFrame:
    """Store health with the period 30 days earlier."""
    earlier = Inputs(i.spark, i.sf_dir, P.with_(as_of=PREVIOUS))
    stores = stock.enrich_stock(stock.prepare_stock(earlier.stock, "LOJA", PREVIOUS), stock.clean_gef(earlier.gef))
    return kpis.inventory_health(_m_stores(i), P.as_of, previous=kpis.previous_health(stores))


@register("k7_with_previous")
def _k7p(i: Inputs) -> DataFrame:
    return _health(i)


@register("a12_company_kpis")
def _a12(i: Inputs) -> DataFrame:
    """Stock value and coverage, now against 30 days ago."""
    return kpis.company_kpis(_health(i), P.as_of)


@register("u2_stack_kpis")
def _u2(i: Inputs) -> DataFrame:
    """Stock value of stores and of CDs by branch, stacked with UNION ALL."""
    return kpis.stack_kpis(*[
        kpis.inventory_value(m).select(F.lit(kind).alias("stock_kind"), "branch", "inventory_value")
        for kind, m in (("LOJA", _m_stores(i)), ("CD", _m_cds(i)))
    ])


@register("a13_kpi_rollup")
def _a13(i: Inputs) -> DataFrame:
    return kpis.kpi_rollup(_dense(i), "month", ("branch",))


def _sales_by_place(i: Inputs) -> DataFrame:
    return _dense(i).join(i.products, "sku", "left").join(i.branches, "branch", "left")


@register("a13_kpi_rollup_category_week")
def _a13c(i: Inputs) -> DataFrame:
    return kpis.kpi_rollup(_sales_by_place(i), "week", ("category",))


@register("a13_kpi_rollup_region_quarter")
def _a13r(i: Inputs) -> DataFrame:
    return kpis.kpi_rollup(_sales_by_place(i), "quarter", ("region", "state"))


@register("a13_kpi_rollup_region_category_day")
def _a13d(i: Inputs) -> DataFrame:
    return kpis.kpi_rollup(_sales_by_place(i), "day", ("region", "category"))


@register("k8_store_dimension")
def _k8s(i: Inputs) -> DataFrame:
    return kpis.store_dimension(i.stock, i.branches)


@register("k8_cd_dimension")
def _k8d(i: Inputs) -> DataFrame:
    return kpis.cd_dimension(i.stock, i.branches)


@register("k8_category_dimension")
def _k8c(i: Inputs) -> DataFrame:
    return kpis.category_dimension(i.products)


@register("k8_region_dimension")
def _k8r(i: Inputs) -> DataFrame:
    return kpis.region_dimension(i.branches)


@register("k8_sales_fact")
def _k8sf(i: Inputs) -> DataFrame:
    return kpis.sales_fact(_dense(i))


@register("k8_inventory_fact")
def _k8if(i: Inputs) -> DataFrame:
    return kpis.inventory_fact(_m_stores(i), _m_cds(i))


@register("j10_allocation_view")
def _j10(i: Inputs) -> DataFrame:
    return kpis.allocation_view(
        _m_stores(i), kpis.store_dimension(i.stock, i.branches), kpis.cd_dimension(i.stock, i.branches), i.products, i.supply_plan_stock, P.as_of
    )


@register("v6_check_ref")
def _v6(i: Inputs) -> DataFrame:
    """GEF keys without a stock row."""
    return quality.check_ref(stock.gef_feed(i.gef), i.stock, ("branch", "sku"))


@register("v7_check_range")
def _v7(i: Inputs) -> DataFrame:
    return quality.check_range(i.stock, "stock_value", 0, 100000)


@register("v8_check_outliers")
def _v8(i: Inputs) -> DataFrame:
    """Daily revenue outliers per branch among days with a sale."""
    days = _dense(i).where(F.col("qty") > 0).select("date", "branch", "sku", "revenue")
    return quality.check_outliers(days, "revenue", ("branch",))


@register("v9_check_dates")
def _v9(i: Inputs) -> DataFrame:
    """Gaps between sale days of each (branch, sku, channel) series."""
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    return quality.check_dates(sales.daily_sales(lines), ("branch", "sku", "channel"))


@register("v5_run_summary")
def _v5(i: Inputs) -> DataFrame:
    return quality.run_summary(_dense(i), P)


@register("s1_load")
def _s1(i: Inputs) -> DataFrame:
    return loaders.load(i.spark, "orders", root=i.sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")


@register("s2_load_sql")
def _s2(i: Inputs) -> DataFrame:
    return loaders.load_sql(i.spark, f"SELECT * FROM parquet.`{i.sf_dir}/region.parquet`")


# =========================================================================== remaining single operators

from stocklens.functions.columns import sale_flag  # noqa: E402
from stocklens.functions.lineage import with_lineage  # noqa: E402

@register("p6_rename_drop")
def _p6(i: Inputs) -> DataFrame:
    out = filters.rename_drop(i.stock, {"stock_qty": "current_stock_qty", "stock_value": "current_stock_value"}, ("ingested_at",))
    return out.select(*[to_double(c).alias(c) if c.startswith("current_") or c == "cmv_sales_value" else F.col(c) for c in out.columns])


@register("d2_sale_flag")
def _d2(i: Inputs) -> DataFrame:
    """Sale flag of each channel-day of the daily aggregate."""
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    return sales.daily_sales(lines).select("date", "branch", "sku", "channel", sale_flag("qty").alias("sold"))


@register("p10_dev_sample")
def _p10(i: Inputs) -> DataFrame:
    """TEST-mode sample of the window's value lines: whole keys, by a hash."""
    lines = sales.filter_sales(i.rated_sales, None, P.start, P.as_of)
    return quality.dev_sample(lines, ("fact_key",), P.with_(mode="TEST")).select("fact_key", "approval_date", "sku", to_double("sale_value").alias("sale_value"))


@register("d4_with_lineage")
def _d4(i: Inputs) -> DataFrame:
    """Dense sales with processing columns at a pinned time (as text, whatever the time zone)."""
    out = with_lineage(_dense(i), "rated sales + quantity sales", at=LINEAGE_AT)
    return out.withColumn("processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss"))


@register("s3_run_frame")
def _s3(i: Inputs) -> DataFrame:
    """The run window, joined with the days of the sales that lie in it."""
    frame = loaders.run_frame(i.spark, P)
    days = i.rated_sales.select("approval_date").distinct()
    inside = days.join(frame, F.col("approval_date").between(F.col("start_date"), F.col("as_of")))
    return inside.select("approval_date", "start_date", "start_date_int", "lookback_days", "as_of", "mode")


@register("s4_save_table")
def _s4(i: Inputs) -> DataFrame:
    """Daily sales written and read back."""
    path = _scratch(i, "daily")
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    loaders.save_table(sales.daily_sales(lines), "daily", path=path)
    return i.spark.read.parquet(path)


@register("s7_describe_table")
def _s7(i: Inputs) -> DataFrame:
    return quality.describe_table(i.table("nation"))


@register("s8_ingest_append")
def _s8(i: Inputs) -> DataFrame:
    """Two batches landed and read back: rows per batch and day."""
    path = _scratch(i, "landing")
    loaders.ingest_append(i.table("nation"), path, "nations", at=LINEAGE_AT)
    loaders.ingest_append(i.table("nation"), path, "again", at=LINEAGE_AT)
    landed = i.spark.read.parquet(path)
    return landed.groupBy("n_name", "source_system", "year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))


# =========================================================================== series, totals, published tables

from stocklens.operators import series  # noqa: E402

#: The months of trend and season: whole years and the run's half year.
HISTORY_START = _dt.date(1996, 1, 1)
SNAPSHOTS = tuple(P.as_of - _dt.timedelta(days=15 * k) for k in range(4, -1, -1))


def _monthly(i: Inputs) -> DataFrame:
    long = Inputs(i.spark, i.sf_dir, P.with_(lookback_days=(P.as_of - HISTORY_START).days))
    lines = sales.sales_lines(long.rated_sales, long.quantity_sales, HISTORY_START, P.as_of, None)
    return series.monthly_sales(lines, P.as_of)


@register("k13_sales_trend")
def _k13t(i: Inputs) -> DataFrame:
    """Slope of the monthly revenue of every branch and channel since 1996."""
    return series.sales_trend(_monthly(i))


@register("k13_season_index")
def _k13s(i: Inputs) -> DataFrame:
    return series.season_index(_monthly(i))


@register("k13_season_adjusted")
def _k13a(i: Inputs) -> DataFrame:
    return series.season_adjusted(_monthly(i))


def _places(i: Inputs) -> DataFrame:
    """Dense sales with region and category, one of the categories unknown."""
    known = i.products.withColumn("category", F.nullif("category", F.lit(testdata.CATEGORIES[0])))
    return _dense(i).join(known, "sku", "left").join(i.branches, "branch", "left")


@register("a13_kpi_cube")
def _a13cube(i: Inputs) -> DataFrame:
    """Every subset of region and category by month; SKUs without category beside the totals."""
    return kpis.kpi_cube(_places(i), "month", ("region", "category"))


@register("a13_kpi_grouping_sets")
def _a13sets(i: Inputs) -> DataFrame:
    """Chosen totals only: by state and category, by region, and all, by quarter."""
    sets = [("region", "state", "category"), ("region",), ()]
    return kpis.kpi_cube(_places(i), "quarter", ("region", "state", "category"), sets)


def _snapshot(i: Inputs, day: _dt.date) -> DataFrame:
    at = Inputs(i.spark, i.sf_dir, P.with_(as_of=day))
    stores = stock.enrich_stock(stock.prepare_stock(at.stock, "LOJA", day), stock.clean_gef(at.gef))
    return kpis.previous_health(stores).select(F.lit(day).alias("date"), "branch", "sku", "stock_value", "coverage_days", "health_level")


def _snapshots(i: Inputs) -> DataFrame:
    """Store stock of five days, each written as a partition (the last one twice), read from
    the second day on."""
    path = _scratch(i, "snapshots")
    for day in (*SNAPSHOTS, SNAPSHOTS[-1]):
        loaders.overwrite_partitions(_snapshot(i, day), path, ("date",))
    return series.between_days(i.spark.read.parquet(path), SNAPSHOTS[1], SNAPSHOTS[-1])


@register("k7_health_series")
def _k7s(i: Inputs) -> DataFrame:
    """Each snapshot against the one before it, and the 30 days up to it."""
    return series.health_series(_snapshots(i), 30)


@register("k7_health_totals")
def _k7t(i: Inputs) -> DataFrame:
    return series.health_totals(_snapshots(i))


@register("s4_publish_table")
def _s4p(i: Inputs) -> DataFrame:
    """Daily sales published as a catalog table: first without a column, then whole, then again."""
    lines = sales.sales_lines(i.rated_sales, i.quantity_sales, P.start, P.as_of, None)
    daily, name, root = sales.daily_sales(lines), f"daily_{uuid.uuid4().hex}", _scratch(i, "published")
    loaders.publish_table(daily.drop("cost"), name, root)
    loaders.publish_table(daily.where(F.col("channel") == sales.OFF), name, root)
    loaders.publish_table(daily, name, root)
    return i.spark.table(name)


def _customers(i: Inputs) -> DataFrame:
    return i.table("customer").select("c_custkey", "c_mktsegment")


@register("s8_ingest_batch")
def _s8b(i: Inputs) -> DataFrame:
    """Two batches, the first landed in part, whole, and whole again: its rows are there once."""
    path, rows = _scratch(i, "batches"), _customers(i)
    first, rest = rows.where("c_mktsegment = 'BUILDING'"), rows.where("c_mktsegment <> 'BUILDING'")
    for part in (first.where("c_custkey < 100"), first, first):
        loaders.ingest_batch(part, path, "customers", "building", at=LINEAGE_AT)
    loaders.ingest_batch(rest, path, "customers", "others", at=LINEAGE_AT)
    landed = loaders.read_landing(i.spark, path, rows.schema)
    return landed.groupBy("batch", "c_mktsegment", "source_system", "year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))


@register("s8_stream_ingest")
def _s8s(i: Inputs) -> DataFrame:
    """The landing as a stream: two arrivals, three runs on one checkpoint, every row once."""
    incoming, out, state, rows = (*(_scratch(i, f"stream-{x}") for x in ("in", "out", "state")), _customers(i))
    for arrival in (rows.where("c_mktsegment = 'BUILDING'"), rows.where("c_mktsegment <> 'BUILDING'"), None):
        if arrival is not None:
            arrival.write.mode("append").parquet(incoming)
        run = ingest.start_ingest(ingest.source_stream(i.spark, incoming, rows.schema), out, state, "customers")
        run.awaitTermination()
    landed = i.spark.read.parquet(out)
    return landed.groupBy("c_mktsegment", "source_system").agg(F.count(F.lit(1)).alias("rows"))


@register("v5_observed_run")
def _v5o(i: Inputs) -> DataFrame:
    """The run summary as the write of the dense sales has counted it."""
    out, summary = quality.observed_run(_dense(i), P)
    loaders.save_table(out, "sales", path=_scratch(i, "observed"))
    return summary.frame(i.spark)


@register("v3_observed_join")
def _v3o(i: Inputs) -> DataFrame:
    """The join audit as the write of the enriched stock has counted it."""
    left = stock.prepare_stock(i.stock, "LOJA", P.as_of)
    out, audit = quality.observed_join(left, lambda rows: stock.enrich_stock(rows, stock.clean_gef(i.gef)), "safety_stock")
    loaders.save_table(out, "stock", path=_scratch(i, "observed"))
    schema = "rows_before long, rows_after long, row_growth long, matched_rows long, match_pct double"
    return i.spark.createDataFrame([tuple(audit.row().values())], schema)


# =========================================================================== source layout, documents, views, the job

from stocklens import job  # noqa: E402
from stocklens.plans import views  # noqa: E402
from stocklens.sources import contracts, original  # noqa: E402


@register("s1_source_layout")
def _s1l(i: Inputs) -> DataFrame:
    """Value lines laid out as the source system keeps them (integer days, original names),
    read back through the adapter."""
    path = _scratch(i, "source")
    original.source_layout(i.rated_sales, original.RATED_SALES).write.parquet(path)
    rows = original.rated_sales(i.spark.read.parquet(path), P.start, P.as_of)
    return rows.select("fact_key", "approval_date", "sku", "selling_branch", "issuing_branch", to_double("sale_value").alias("sale_value"), to_double("cost_value").alias("cost_value"))


@register("p11_require_columns")
def _p11(i: Inputs) -> DataFrame:
    """Needed columns of customer, one of which it lacks."""
    return contracts.column_report(i.table("customer"), ("c_custkey", "c_name", "c_segment"))


@register("v1_require_rows")
def _v1(i: Inputs) -> DataFrame:
    window = F.col("approval_date").between(F.lit(P.start), F.lit(P.as_of))
    inputs = {"sales of the window": i.rated_sales.where(window), "stock rows": i.stock}
    quality.require_rows(*inputs.values())
    return quality.row_presence(**inputs, **{"sales of another century": i.rated_sales.where(F.col("approval_date") < F.lit(_dt.date(1900, 1, 1)))})


@register("v4_run_params")
def _v4(i: Inputs) -> DataFrame:
    """What each mode reads: its window and its lines."""
    rows = []
    for mode in ("RUN", "TEST"):
        p = RunParams.for_mode(mode, P.as_of)
        lines = quality.dev_sample(i.rated_sales.where(F.col("approval_date").between(F.lit(p.start), F.lit(p.as_of))), ("fact_key",), p)
        frame = loaders.run_frame(i.spark, p).select("mode", "start_date", "as_of", "lookback_days", F.lit(p.table("vendas")).alias("table_name"))
        rows.append(frame.withColumn("lines", lines.agg(F.count(F.lit(1))).scalar()))
    return rows[0].unionAll(rows[1])


@register("s5_report_document")
def _s5d(i: Inputs) -> DataFrame:
    """The CD network as one nested document, read back: each edge with its origin's node."""
    net, path = N.build_network(i.supply_plan), _scratch(i, "document")
    arcs = net.edges.where(F.col("edge_type") == G.CD_CD)
    report.write_report_document(N.network_report(net, LINEAGE_AT), net.nodes.where(F.col("graph") == G.CD_CD), arcs, path)
    document = report.read_network_report(i.spark, path)
    nodes = report.report_nodes(document).select(F.col("id").alias("origem"), "grau_saida", "nivel_hierarquico", "em_ciclo", "scc_size")
    return report.report_edges(document).join(nodes, "origem").select("origem", "destino", "tipo", "grau_saida", "nivel_hierarquico", "em_ciclo", "scc_size")


def _views(i: Inputs) -> dict[str, str]:
    own = P.with_(source_prefix=f"views_{uuid.uuid4().hex}")
    return views.publish_views(
        i.spark, _m_stores(i), _health(i), kpis.store_dimension(i.stock, i.branches), kpis.cd_dimension(i.stock, i.branches),
        i.products, i.supply_plan_stock, own, _scratch(i, "gold"),
    )


@register("views_allocation_dashboard")
def _vad(i: Inputs) -> DataFrame:
    return i.spark.table(_views(i)["allocation_dashboard"])


@register("views_company_kpis")
def _vck(i: Inputs) -> DataFrame:
    return i.spark.table(_views(i)["company_kpis"])


@register("job_catalog_run")
def _job(i: Inputs) -> DataFrame:
    """The whole job over catalog tables in the source layout: rows of each table it publishes."""
    token, frames = uuid.uuid4().hex, {
        "rated_sales": (i.rated_sales, original.RATED_SALES), "quantity_sales": (i.quantity_sales, original.QUANTITY_SALES),
        "stock": (i.stock, original.STOCK), "gef": (i.gef, original.GEF), "supply_plan": (i.supply_plan_stock, original.SUPPLY_PLAN),
    }
    root, tables = _scratch(i, "job"), {}
    for name, (df, names) in frames.items():
        tables[name] = f"source_{name}_{token}"
        loaders.publish_table(original.source_layout(df, names), tables[name], root)
    own = P.with_(source_prefix=f"job_{token}")
    job.run_job(i.spark, own, tables, root, network=False)
    rows = [
        i.spark.table(own.table(stem)).agg(F.lit(P.table(stem)).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for stem in ("vendas_90d_on_off", "estoque_lojas", "estoque_cds", "master_vendas_estoque_lojas", "master_vendas_estoque_cds")
    ]
    return _reduce(DataFrame.unionAll, rows)
