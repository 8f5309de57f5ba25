"""English column names used inside stocklens and the original names of the source system.

Fixed values: the original column names must equal those of the reference's tables so that
``with_original_names`` produces the same layout. English name -> original name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ORIGINAL_NAMES: dict[str, str] = {
    # sales lines
    "fact_key": "ChaveFatos",
    "approval_date": "DtAprovacao",
    "goods_state": "NmEstadoMercadoria",
    "business_type": "NmTipoNegocio",
    "sale_value": "VrOperacao",
    "cost_value": "VrCustoContabilFilialSku",
    "selling_branch": "CdFilialVenda",
    "issuing_branch": "CdFilialEmissao",
    "quantity": "QtMercadoria",
    "invoice_date": "DtEmissaoFaturamento",
    # keys
    "date": "DtAtual",
    "year_month": "year_month",
    "branch": "CdFilial",
    "sku": "CdSku",
    # dense sales
    "revenue_off": "Receita_OFF",
    "qty_off": "QtMercadoria_OFF",
    "sold_off": "TeveVenda_OFF",
    "revenue_on": "Receita_ON",
    "qty_on": "QtMercadoria_ON",
    "sold_on": "TeveVenda_ON",
    "revenue": "Receita",
    "qty": "QtMercadoria",
    "sold": "TeveVenda",
    "cost": "Custo",
    # stock
    "stock_date": "DtAtual",
    "store_status": "StLoja",
    "stock_place": "DsEstoqueLojaDeposito",
    "stock_qty": "QtEstoque",
    "stock_value": "VrTotalVv",
    "cmv_sales_value": "VrVndCmv",
    "ingested_at": "data_ingestao",
    "stock_kind": "TipoEstoque",
    "dde": "DDE",
    # gef metrics
    "safety_stock": "ESTOQUE_SEGURANCA",
    "lead_time": "LEADTIME_MEDIO",
    "safety_cover_days": "COBERTURA_ES_DIAS",
    "target_stock": "ESTOQUE_ALVO",
    "current_cover": "COBERTURA_ATUAL",
    "target_cover": "COBERTURA_ALVO",
    "ddv_clean": "DDV_SEM_OUTLIER",
    "ddv_future": "DDV_FUTURO",
    "grade": "GRADE",
    "in_transit": "TRANSITO",
    "projected_stock": "ESTOQUE_PROJETADO",
    "cover_with_transit_days": "COBERTURA_ATUAL_C_TRANSITO_DIAS",
    "mean_3": "MEDIA_3",
    "mean_6": "MEDIA_6",
    "mean_9": "MEDIA_9",
    "mean_12": "MEDIA_12",
    "ddv_so": "DDV_SO",
    "ddv_co": "DDV_CO",
    "cluster_obg": "CLUSTER_OBG",
    "cluster_sug": "CLUSTER_SUG",
    # supply plan
    "supplying_cd": "CdFilialAtende",
    "delivering_cd": "CdFilialEntrega",
    "store": "CdLoja",
    # master
    "current_stock_qty": "QtEstoqueAtual",
    "current_stock_value": "VrEstoqueAtual",
    "current_dde": "DDE_Atual",
    "sale_days": "DiasComVenda",
    "grid_days": "DiasDistintos",
    "grid_first": "PrimeiraVenda",
    "grid_last": "UltimaVenda",
    # lineage
    "processed_at": "DataHoraProcessamento",
    "processed_date": "DataProcessamento",
    "data_source": "FonteDados",
    "process_version": "VersaoProcessamento",
}

_PERIODS = {
    "total": "Total", "off_total": "OFF_Total", "on_total": "ON_Total", "mtd": "MTD", "ytd": "YTD",
    "last7d": "Last7d", "last30d": "Last30d", "last90d": "Last90d", "last4w": "Last4w",
    "m1": "M1", "m2": "M2", "m3": "M3", "mm7d": "MM7d", "mm14d": "MM14d", "mm30d": "MM30d",
    "mm60d": "MM60d", "mm90d": "MM90d",
}


def original_name(name: str) -> str:
    if name in ORIGINAL_NAMES:
        return ORIGINAL_NAMES[name]
    for measure, orig in (("revenue_", "Receita_"), ("qty_", "QtMercadoria_")):
        if name.startswith(measure) and name[len(measure):] in _PERIODS:
            return orig + _PERIODS[name[len(measure):]]
    return name


def with_original_names(df: DataFrame) -> DataFrame:
    """Rename every known English column to the source system's name."""
    return df.withColumnsRenamed({c: original_name(c) for c in df.columns if original_name(c) != c})
