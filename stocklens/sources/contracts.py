"""Input contracts: explicit schemas for every source (the reference infers them).

``conform`` checks a DataFrame against a contract, casts columns whose type differs but can
be cast, and fails on missing columns, so every operator sees one type per column. Branch
ids are INT in sales and stock tables; the plan's ids are text and meet them in one place
(``operators.stock.store_cd_pairs``), by their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
COST = T.DecimalType(24, 4)

RATED_SALES = T.StructType(
    [
        T.StructField("fact_key", T.StringType()),
        T.StructField("approval_date", T.DateType()),
        T.StructField("goods_state", T.StringType()),
        T.StructField("business_type", T.StringType()),
        T.StructField("sale_value", MONEY),
        T.StructField("cost_value", COST),
        T.StructField("sku", T.StringType()),
        T.StructField("selling_branch", T.IntegerType()),
        T.StructField("issuing_branch", T.IntegerType()),
    ]
)

QUANTITY_SALES = T.StructType(
    [
        T.StructField("fact_key", T.StringType()),
        T.StructField("quantity", MONEY),
        T.StructField("invoice_date", T.DateType()),
    ]
)

STOCK = T.StructType(
    [
        T.StructField("stock_date", T.DateType()),
        T.StructField("sku", T.StringType()),
        T.StructField("branch", T.IntegerType()),
        T.StructField("stock_place", T.StringType()),
        T.StructField("store_status", T.StringType()),
        T.StructField("stock_qty", MONEY),
        T.StructField("stock_value", MONEY),
        T.StructField("cmv_sales_value", MONEY),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# GEF metrics. The roll-up to CDs averages the first group and sums the second (A4).
GEF_AVERAGED = ("lead_time", "safety_cover_days", "current_cover", "target_cover")
GEF_SUMMED = (
    "safety_stock", "target_stock", "ddv_clean", "ddv_future", "grade", "in_transit",
    "projected_stock", "cover_with_transit_days", "mean_3", "mean_6", "mean_9", "mean_12",
    "ddv_so", "ddv_co", "cluster_obg", "cluster_sug",
)
# Column order of the GEF feed (as projected by P5).
GEF_METRICS = (
    "safety_stock", "lead_time", "safety_cover_days", "target_stock", "current_cover",
    "target_cover", "ddv_clean", "ddv_future", "grade", "in_transit", "projected_stock",
    "cover_with_transit_days", "mean_3", "mean_6", "mean_9", "mean_12", "ddv_so", "ddv_co",
    "cluster_obg", "cluster_sug",
)

GEF = T.StructType(
    [
        T.StructField("stock_date", T.DateType()),
        T.StructField("branch", T.IntegerType()),
        T.StructField("sku", T.StringType()),
    ]
    + [T.StructField(m, T.IntegerType()) for m in GEF_METRICS]
)

# Ids of the plan stay text: they name graph nodes, and have leading zeros ("0022").
SUPPLY_PLAN = T.StructType(
    [
        T.StructField("supplying_cd", T.StringType()),
        T.StructField("delivering_cd", T.StringType()),
        T.StructField("store", T.StringType()),
    ]
)

CONTRACTS: dict[str, T.StructType] = {
    "rated_sales": RATED_SALES,
    "quantity_sales": QUANTITY_SALES,
    "stock": STOCK,
    "gef": GEF,
    "supply_plan": SUPPLY_PLAN,
}


class ContractError(ValueError):
    pass


def conform(df: DataFrame, contract: T.StructType, extra: str = "keep") -> DataFrame:
    """Check ``df`` against ``contract``; cast differing types; keep or drop extra columns."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in have]
    if missing:
        raise ContractError(f"missing columns {missing}; have {sorted(have)}")
    cols = [
        F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in contract.fields
    ]
    if extra == "keep":
        names = {f.name for f in contract.fields}
        cols += [F.col(c) for c in df.columns if c not in names]
    elif extra != "drop":
        raise ValueError("extra must be 'keep' or 'drop'")
    return df.select(*cols)


def require_columns(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Fail when needed columns are missing (the reference only prints)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns {missing}; have {df.columns}")
    return df


def column_report(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """P11 as a table: each needed column, whether it is there, and its type; reads no data."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.sparkSession.createDataFrame([(c, c in have, have.get(c)) for c in cols], "column_name string, present boolean, data_type string")
