"""Silver master tables: current stock of stores / CDs with the per-key sales summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F  # noqa: F401

from stocklens.operators import master
from stocklens.params import RunParams


def summary(sales: DataFrame, params: RunParams) -> DataFrame:
    """A6 over the sales table restricted to the run window."""
    return master.sales_summary(sales, params.as_of, params.month_mode, params.start)


def master_tables(sales: DataFrame, stores: DataFrame, cds: DataFrame, params: RunParams, with_clock: bool = True, summary_df: DataFrame | None = None):
    """Both master tables from one per-key summary. Pass ``summary_df`` (e.g. a persisted
    ``summary(...)``) to compute the summary once for the two outputs."""
    s = summary_df if summary_df is not None else summary(sales, params)
    clock = F.current_timestamp() if with_clock else None
    m_stores = master.build_master(master.current_stock(stores, params.as_of), s, params.as_of, clock)
    m_cds = master.build_master(master.current_stock(cds, params.as_of), s, params.as_of, clock)
    return m_stores, m_cds
