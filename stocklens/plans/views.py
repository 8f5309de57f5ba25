"""The documented reporting views (J10, A12) as catalog views over published gold tables.

The gold tables are published whole (``loaders.publish_table``), and the views are SQL over
their names, so a reader of a view sees the last complete run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stocklens.operators import kpis
from stocklens.params import RunParams
from stocklens.sources import loaders

# The columns of the documented allocation view.
ALLOCATION = (
    "region", "state", "distribution_center", "store", "category", "sku", "current_stock_value", "coverage_days", "aging_value",
    "rupture_percentage", "health_level", "forecast_stock_value", "forecast_coverage_days",
)


def publish_views(
    spark: SparkSession, master: DataFrame, health: DataFrame, stores: DataFrame, cds: DataFrame, products: DataFrame, plan: DataFrame,
    params: RunParams, root: str,
) -> dict[str, str]:
    """Publishes the gold tables of the run's day and (re)creates both views over them; returns
    the views' names by their documented ones. ``health`` is K7's table with ``previous``."""
    as_of: dt.date = params.as_of
    allocation, daily = params.table("gold_allocation"), params.table("gold_inventory_health")
    loaders.publish_table(kpis.allocation_view(master, stores, cds, products, plan, as_of), allocation, root, params.table_format)
    loaders.publish_table(health, daily, root, params.table_format)
    names = {"allocation_dashboard": params.table("allocation_dashboard"), "company_kpis": params.table("company_kpis")}
    spark.sql(f"CREATE OR REPLACE VIEW {names['allocation_dashboard']} AS SELECT {', '.join(ALLOCATION)} FROM {allocation}")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {names['company_kpis']} AS
        WITH day AS (
            SELECT CAST(SUM(CAST(stock_value AS DECIMAL(28,2))) AS DOUBLE) AS v, CAST(SUM(CAST(prev_stock_value AS DECIMAL(28,2))) AS DOUBLE) AS pv,
                   try_divide(CAST(SUM(CAST(coverage_days AS DECIMAL(20,6))) AS DOUBLE), CAST(COUNT(coverage_days) AS DOUBLE)) AS c,
                   try_divide(CAST(SUM(CAST(prev_coverage_days AS DECIMAL(20,6))) AS DOUBLE), CAST(COUNT(prev_coverage_days) AS DOUBLE)) AS pc
            FROM {daily} WHERE date = (SELECT MAX(date) FROM {daily})
        )
        SELECT metric_name, current_value, previous_value, try_divide(current_value - previous_value, previous_value) * 100 AS change_percentage
        FROM (SELECT stack(2, 'Total Inventory', v, pv, 'Coverage Days', c, pc) AS (metric_name, current_value, previous_value) FROM day)
    """)
    return names
