"""Stock bronze: enriched stock for stores and CDs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stocklens.functions.lineage import with_lineage
from stocklens.operators import quality, stock
from stocklens.params import RunParams

STORE_SOURCE = "stock quality + GEF"
CD_SOURCE = "stock quality + GEF + supply plan"


def store_stock(stock_df: DataFrame, gef_df: DataFrame, params: RunParams) -> DataFrame:
    if params.sampled:
        stock_df = quality.dev_sample(stock_df, ("branch", "sku"), params)
        gef_df = quality.dev_sample(gef_df, ("branch", "sku"), params)
    return stock.enrich_stock(stock.prepare_stock(stock_df, "LOJA", params.as_of), stock.clean_gef(gef_df))


def cd_stock(stock_df: DataFrame, gef_df: DataFrame, plan: DataFrame, params: RunParams) -> DataFrame:
    if params.sampled:
        stock_df = quality.dev_sample(stock_df, ("branch", "sku"), params)
    rollup = stock.rollup_gef_to_cd(stock.map_store_to_cd(stock.clean_gef(gef_df), plan))
    return stock.enrich_cd_stock(stock.prepare_stock(stock_df, "CD", params.as_of), rollup)


def stock_bronze(stock_df: DataFrame, gef_df: DataFrame, plan: DataFrame, params: RunParams, lineage_at=None):
    """Both published stock tables, with D4 processing columns."""
    stores = with_lineage(store_stock(stock_df, gef_df, params), STORE_SOURCE, at=lineage_at)
    cds = with_lineage(cd_stock(stock_df, gef_df, plan, params), CD_SOURCE, at=lineage_at)
    return stores, cds
