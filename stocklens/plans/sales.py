"""Sales bronze: dense daily sales per branch x SKU x channel (the flagship output)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stocklens.functions.lineage import with_lineage
from stocklens.operators import quality, sales
from stocklens.params import RunParams

SALES_SOURCE = "rated sales + quantity sales"


def dense_sales(rated: DataFrame, qty: DataFrame, params: RunParams) -> DataFrame:
    """P10 (TEST mode) + the fused P1 P2 J1 A1 J2 J3 J4 D2 plan over the run window."""
    if params.sampled:
        # Same keys on both sides of the join, so the sample keeps matching pairs (Q16).
        rated = quality.dev_sample(rated, ("fact_key",), params)
        qty = quality.dev_sample(qty, ("fact_key",), params)
    return sales.dense_daily_sales(rated, qty, params.start, params.as_of)


def sales_bronze(rated: DataFrame, qty: DataFrame, params: RunParams, lineage_at=None) -> DataFrame:
    """The published table: dense sales + D4 processing columns."""
    return with_lineage(dense_sales(rated, qty, params), SALES_SOURCE, at=lineage_at)
