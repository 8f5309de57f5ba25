"""Stock operators: store / CD stock preparation, GEF enrichment, GEF roll-up to CDs.

Scale notes
-----------
* De-duplication is an aggregate (``quality.dedupe``), so a key with many copies is reduced
  map-side. After it every join key is unique on both sides: the enrichment joins cannot
  multiply rows and cannot be skewed by one key.
* The store -> CD plan is tiny (pairs of branches); AQE broadcasts it after measuring it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions.columns import days_of_stock, stock_kind
from stocklens.operators import filters, quality
from stocklens.sources.contracts import GEF_AVERAGED, GEF_METRICS, GEF_SUMMED

KEYS = ("branch", "sku", "date")


def prepare_stock(stock: DataFrame, kind: str, as_of: dt.date) -> DataFrame:
    """P3 + D3 + D1 + date from the ingestion time (Q15) + A8 on (date, sku, branch).

    The survivor of duplicate keys is the latest ingestion, then the largest stock value.
    """
    rows = filters.filter_stock(stock, kind, as_of)
    shaped = rows.select(
        F.to_date("ingested_at").alias("date"),
        "sku",
        "branch",
        "stock_place",
        "store_status",
        "stock_qty",
        "stock_value",
        "cmv_sales_value",
        "ingested_at",
        stock_kind(kind).alias("stock_kind"),
        days_of_stock("stock_value", "cmv_sales_value").alias("dde"),
    )
    return quality.dedupe(shaped, ("date", "sku", "branch"), (F.col("ingested_at"), F.col("stock_value")))


def gef_feed(gef: DataFrame) -> DataFrame:
    """P5: the GEF projection used downstream (date + keys + 20 metrics)."""
    mapping = {"sku": "sku", "branch": "branch", "stock_date": "date", **{m: m for m in GEF_METRICS}}
    return filters.select_rename(gef, mapping)


def clean_gef(gef: DataFrame) -> DataFrame:
    """A8 on the GEF keys (the reference repairs the feed only; copies are exact)."""
    return quality.dedupe(gef_feed(gef), KEYS)


def enrich_stock(stock: DataFrame, gef: DataFrame) -> DataFrame:
    """Store stock LEFT JOIN GEF on (branch, sku, date)."""
    return stock.join(gef, on=list(KEYS), how="left").withColumn("stock_kind", stock_kind("LOJA"))


def store_cd_pairs(plan: DataFrame) -> DataFrame:
    """Distinct (delivering CD, store) pairs of the supply plan, as branch numbers; ids that
    are no numbers name no branch and are left out."""
    pairs = plan.select(F.col("delivering_cd").try_cast("int").alias("delivering_cd"), F.col("store").try_cast("int").alias("store"))
    return pairs.where("delivering_cd IS NOT NULL AND store IS NOT NULL").distinct()


def map_store_to_cd(gef: DataFrame, plan: DataFrame) -> DataFrame:
    """GEF rows of each store, tagged with the CD that delivers to it (inner, on
    gef.branch = plan.store; a store served by two CDs counts for both)."""
    pairs = store_cd_pairs(plan)
    return gef.join(pairs, gef["branch"] == pairs["store"], "inner").drop("store")


def rollup_gef_to_cd(gef_with_cd: DataFrame) -> DataFrame:
    """A4: GEF per (CD, sku, date): lead time and three coverages averaged, the rest summed.

    Sums of the integer metrics are BIGINT; averages DOUBLE.
    """
    aggs = []
    for m in GEF_METRICS:
        if m in GEF_AVERAGED:
            aggs.append(F.avg(m).alias(m))
        elif m in GEF_SUMMED:
            aggs.append(F.sum(m).cast("long").alias(m))
    grouped = gef_with_cd.groupBy(F.col("delivering_cd").cast("int").alias("branch"), "sku", "date")
    return grouped.agg(*aggs)


def enrich_cd_stock(stock: DataFrame, gef_cd: DataFrame) -> DataFrame:
    """CD stock LEFT JOIN the CD roll-up on (branch, sku, date)."""
    return stock.join(gef_cd, on=list(KEYS), how="left").withColumn("stock_kind", stock_kind("CD"))
