"""Projections, filters and predicates (P3-P9) shared by the pipelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the source system.
STORE_PLACE, CD_PLACE = "L", "D"   # DsEstoqueLojaDeposito
ACTIVE_STORE = "ATIVA"             # StLoja


def filter_stock(stock: DataFrame, kind: str, as_of: dt.date) -> DataFrame:
    """Stock rows from ``as_of`` on; stores must be active, CDs have no status test."""
    cond = F.col("stock_date") >= F.lit(as_of)
    if kind == "LOJA":
        cond &= (F.col("store_status") == ACTIVE_STORE) & (F.col("stock_place") == STORE_PLACE)
    elif kind == "CD":
        cond &= F.col("stock_place") == CD_PLACE
    else:
        raise ValueError("kind must be 'LOJA' or 'CD'")
    return stock.where(cond)


def snapshot(df: DataFrame, as_of: dt.date, date_col: str = "date") -> DataFrame:
    """Keep one day."""
    return df.where(F.col(date_col) == F.lit(as_of))


def select_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P5: keep ``mapping``'s source columns, renamed (source -> target), in mapping order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def rename_drop(df: DataFrame, mapping: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Rename some columns, drop others."""
    out = df.withColumnsRenamed(mapping) if mapping else df
    return out.drop(*drop) if drop else out


def fill_zero(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """NULL -> 0 on the named numeric columns (strings untouched)."""
    return df.fillna(0, subset=list(cols)) if cols else df


def fill_zero_prefix(df: DataFrame, prefixes: tuple[str, ...] = ("revenue_", "qty_")) -> DataFrame:
    """NULL -> 0 on every column whose name starts with one of ``prefixes``."""
    return fill_zero(df, [c for c in df.columns if c.startswith(prefixes)])


def matched(df: DataFrame, probe: str) -> DataFrame:
    """Rows where the probe column of a left join found a partner."""
    return df.where(F.col(probe).isNotNull())


def pair_predicate(a: str, op: str, b: str) -> Column:
    """P9 predicate: ``a op b`` with both sides non-NULL (NULL never matches either way)."""
    left, right = F.col(a), F.col(b)
    both = left.isNotNull() & right.isNotNull()
    if op == "=":
        return both & (left == right)
    if op in ("!=", "<>"):
        return both & (left != right)
    raise ValueError("op must be '=' or '!='")


def where_pair(df: DataFrame, a: str, op: str, b: str, not_null: tuple[str, ...] = ()) -> DataFrame:
    """Compare two columns (and require further columns to be set)."""
    cond = pair_predicate(a, op, b)
    for c in not_null:
        cond &= F.col(c).isNotNull()
    return df.where(cond)
