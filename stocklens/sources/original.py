"""Adapter from the source system's tables to the input contracts.

Original column names and integer or text dates become the contracts' columns. The window
predicate stays on the raw date column, so it reaches the scan (and its partitions).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions.dates import date_from_int
from stocklens.params import RunParams
from stocklens.sources import contracts
from stocklens.sources.contracts import conform, require_columns

# Original names of the columns that the pipelines read, by contract.
RATED_SALES = {
    "fact_key": "ChaveFatos", "approval_date": "DtAprovacao", "goods_state": "NmEstadoMercadoria", "business_type": "NmTipoNegocio",
    "sale_value": "VrOperacao", "cost_value": "VrCustoContabilFilialSku", "sku": "CdSkuLoja", "selling_branch": "CdFilialVenda",
    "issuing_branch": "CdFilialEmissao",
}
QUANTITY_SALES = {"fact_key": "ChaveFatos", "quantity": "QtMercadoria", "invoice_date": "DtEmissaoFaturamento"}
STOCK = {
    "stock_date": "DtAtual", "sku": "CdSku", "branch": "CdFilial", "stock_place": "DsEstoqueLojaDeposito", "store_status": "StLoja",
    "stock_qty": "QtEstoque", "stock_value": "VrTotalVv", "cmv_sales_value": "VrVndCmv", "ingested_at": "data_ingestao",
}
GEF = {
    "stock_date": "DATA_ANALISE", "branch": "FILIAL_AJ", "sku": "CODIGO_ITEM", "safety_stock": "ESTOQUE_SEGURANCA", "lead_time": "LEADTIME_MEDIO",
    "safety_cover_days": "COBERTURA_ES_DIAS", "target_stock": "ESTOQUE_ALVO", "current_cover": "COBERTURA_ATUAL", "target_cover": "COBERTURA_ALVO",
    "ddv_clean": "DDV_SEM_OUTLIER", "ddv_future": "DDV_FUTURO", "grade": "GRADE", "in_transit": "TRANSITO", "projected_stock": "ESTOQUE_PROJETADO",
    "cover_with_transit_days": "COBERTURA_ATUAL_C_TRANSITO_DIAS", "mean_3": "MEDIA_3", "mean_6": "MEDIA_6", "mean_9": "MEDIA_9", "mean_12": "MEDIA_12",
    "ddv_so": "DDV_SO", "ddv_co": "DDV_CO", "cluster_obg": "CLUSTER_OBG", "cluster_sug": "CLUSTER_SUG",
}
SUPPLY_PLAN = {"supplying_cd": "CdFilialAtende", "delivering_cd": "CdFilialEntrega", "store": "CdLoja"}

@dataclass
class Sources:
    """The inputs of a run, by contract."""

    rated_sales: DataFrame
    quantity_sales: DataFrame
    stock: DataFrame
    gef: DataFrame
    supply_plan_stock: DataFrame
    supply_plan: DataFrame


def int_day(day: dt.date) -> int:
    return int(day.strftime("%Y%m%d"))


def int_between(column: str, start: dt.date, end: dt.date) -> Column:
    """A window on a raw yyyyMMdd column."""
    return F.col(column).between(F.lit(int_day(start)), F.lit(int_day(end)))


def _adapted(df: DataFrame, names: dict[str, str], contract, **converted: Column) -> DataFrame:
    require_columns(df, list(names.values()))
    return conform(df.select(*[converted.get(new, F.col(old)).alias(new) for new, old in names.items()]), contract)


def rated_sales(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Value lines approved in the window (integer ``DtAprovacao``)."""
    inside = df.where(int_between("DtAprovacao", start, end))
    return _adapted(inside, RATED_SALES, contracts.RATED_SALES, approval_date=date_from_int("DtAprovacao"))


def quantity_sales(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Quantity lines invoiced in the window (integer ``DtEmissaoFaturamento``)."""
    inside = df.where(int_between("DtEmissaoFaturamento", start, end))
    return _adapted(inside, QUANTITY_SALES, contracts.QUANTITY_SALES, invoice_date=date_from_int("DtEmissaoFaturamento"))


def stock(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Stock positions from ``as_of`` on (text ``DtAtual``, yyyy-MM-dd)."""
    inside = df.where(F.col("DtAtual") >= F.lit(as_of.isoformat()))
    return _adapted(inside, STOCK, contracts.STOCK)


def gef(df: DataFrame) -> DataFrame:
    """The stock-planning feed; a source without ``MEDIA_9`` has it as NULL."""
    if "MEDIA_9" not in df.columns:
        df = df.withColumn("MEDIA_9", F.lit(None).cast("int"))
    return _adapted(df, GEF, contracts.GEF)


def supply_plan(df: DataFrame) -> DataFrame:
    """Supply-plan lines, ids as text."""
    return _adapted(df, SUPPLY_PLAN, contracts.SUPPLY_PLAN)


def adapted(rated: DataFrame, quantity: DataFrame, stock_df: DataFrame, gef_df: DataFrame, plan: DataFrame, params: RunParams) -> Sources:
    """All inputs of a run from frames in the source layout."""
    lines = supply_plan(plan)
    return Sources(
        rated_sales(rated, params.start, params.as_of), quantity_sales(quantity, params.start, params.as_of),
        stock(stock_df, params.as_of), gef(gef_df), lines, lines,
    )


def source_layout(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """A contract's frame in the source system's layout: original names, days as the integers
    (``approval_date``, ``invoice_date``) or texts (``stock_date``) that the source keeps."""
    out = []
    for new, old in names.items():
        col = F.col(new)
        if new in ("approval_date", "invoice_date"):
            col = F.date_format(col, "yyyyMMdd").cast("int")
        elif new == "stock_date":
            col = F.date_format(col, "yyyy-MM-dd")
        elif names is SUPPLY_PLAN:
            col = col.cast("string")
        out.append(col.alias(old))
    return df.select(*out)


def from_catalog(spark: SparkSession, params: RunParams, tables: dict[str, str]) -> Sources:
    """``adapted`` over catalog tables; ``tables`` names one for each of ``INPUTS``."""
    return adapted(*[spark.table(tables[name]) for name in INPUTS], params)


INPUTS = ("rated_sales", "quantity_sales", "stock", "gef", "supply_plan")
