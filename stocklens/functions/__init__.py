"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side, codegen)."""

from stocklens.functions.columns import (
    days_of_stock,
    safe_div,
    sale_flag,
    stock_kind,
    to_double,
)
from stocklens.functions.dates import date_from_int, period_bounds, year_month
from stocklens.functions.lineage import with_lineage
from stocklens.functions.names import ORIGINAL_NAMES, with_original_names

__all__ = [
    "ORIGINAL_NAMES",
    "date_from_int",
    "days_of_stock",
    "period_bounds",
    "safe_div",
    "sale_flag",
    "stock_kind",
    "to_double",
    "with_lineage",
    "with_original_names",
    "year_month",
]
