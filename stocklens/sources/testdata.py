"""Adapters from the TPC-H-like test tables to the retail input contracts.

The source system's tables (rated and unrated sales, stock quality, GEF feed, supply plan)
are not public, so each is derived from ``/root/testdata/sf*/`` by a fixed rule. Every
adapter is linear in its inputs: scans, filters, key joins and aggregates only (no cross
joins, no all-pairs joins). The same rules are written as SQL in ``oracle/fixtures.py``.

Assignment rules (fixed values of the fixture, not of the reference):
* branch = l_suppkey % 25; branches 0-19 are stores ('L'), 20-24 CDs ('D');
  stores 9 and 19 are inactive
* a sale is "returned balance" ('1 - SALDO') when l_returnflag = 'R'; offline ('LOJA FISICA')
  when l_linestatus = 'F', else online ('SITE')
* invoice date = ship date + (l_linenumber % 3) days
* SKU = brand (25 values, dense daily series) or part key (bench scale)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.sources.contracts import GEF_METRICS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

N_BRANCHES = 25
FIRST_CD = 20
INACTIVE_STORES = (9, 19)
STOCK_WINDOW_DAYS = 30
STORE_ID_OFFSET = 100000

# Fixed values: (multiplier of branch, multiplier of SKU number, modulus, offset) of each GEF
# metric of the fixture: metric = (branch * a + sku_num * b) % m + k.
GEF_RULES: dict[str, tuple[int, int, int, int]] = {
    "safety_stock": (31, 17, 50, 1),
    "lead_time": (7, 3, 20, 1),
    "safety_cover_days": (5, 11, 15, 1),
    "target_stock": (13, 7, 90, 10),
    "current_cover": (3, 19, 40, 1),
    "target_cover": (17, 5, 30, 5),
    "ddv_clean": (11, 13, 25, 0),
    "ddv_future": (19, 23, 27, 1),
    "grade": (2, 29, 12, 1),
    "in_transit": (23, 31, 60, 0),
    "projected_stock": (29, 37, 120, 5),
    "cover_with_transit_days": (37, 41, 45, 1),
    "mean_3": (41, 43, 33, 0),
    "mean_6": (43, 47, 36, 0),
    "mean_9": (47, 53, 39, 0),
    "mean_12": (53, 59, 42, 0),
    "ddv_so": (59, 61, 21, 0),
    "ddv_co": (61, 67, 24, 0),
    "cluster_obg": (67, 71, 2, 0),
    "cluster_sug": (71, 73, 3, 0),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_date_between(start: dt.date, end: dt.date, column: str = "l_shipdate") -> Column:
    """``CAST(column AS DATE) BETWEEN start AND end`` written on the raw timestamp, so the
    predicate reaches the Parquet scan (no cast on the scanned side)."""
    lo = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(end + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    c = F.col(column)
    return (c >= lo) & (c < hi)


def _fact_key() -> Column:
    return F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
    )


def _branch() -> Column:
    return F.pmod(F.col("l_suppkey"), F.lit(N_BRANCHES)).cast("int")


def _with_sku(spark: SparkSession, sf_dir: str, lines: DataFrame, sku: str) -> DataFrame:
    """Attach ``sku`` (string) and ``sku_num`` (int) to lineitem rows."""
    if sku == "part":
        return lines.withColumns({"sku": F.col("l_partkey").cast("string"), "sku_num": F.col("l_partkey")})
    if sku != "brand":
        raise ValueError("sku must be 'brand' or 'part'")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey"), F.col("p_brand").alias("sku"), F.substring("p_brand", 7, 10).cast("int").alias("sku_num")
    )
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


def rated_sales(spark: SparkSession, sf_dir: str, sku: str = "brand", approved: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Value lines: one per lineitem (contract RATED_SALES). ``approved`` is the window that
    the caller will filter; the scan skips what was approved (shipped) outside it."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    if approved is not None:
        li = li.where(ship_date_between(*approved))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("int").alias("issuing_branch"))
    lines = _with_sku(spark, sf_dir, li, sku).join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    value = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        _fact_key().alias("fact_key"),
        F.to_date("l_shipdate").alias("approval_date"),
        F.when(F.col("l_returnflag") == "R", "1 - SALDO").otherwise("2 - NOVO").alias("goods_state"),
        F.when(F.col("l_linestatus") == "F", "LOJA FISICA").otherwise("SITE").alias("business_type"),
        value.alias("sale_value"),
        (value * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(24,4)").alias("cost_value"),
        F.col("sku"),
        _branch().alias("selling_branch"),
        F.col("issuing_branch"),
    )


def quantity_sales(spark: SparkSession, sf_dir: str, invoiced: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Quantity lines (contract QUANTITY_SALES); invoiced 0 to 2 days after approval.

    ``invoiced`` is the window that the caller will filter: lines shipped outside
    [start - 2 days, end] can't be invoiced in it and are skipped by the scan."""
    li = table(spark, sf_dir, "lineitem")
    if invoiced is not None:
        li = li.where(ship_date_between(invoiced[0] - dt.timedelta(days=2), invoiced[1]))
    return li.select(
        _fact_key().alias("fact_key"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        F.date_add(F.to_date("l_shipdate"), F.pmod(F.col("l_linenumber"), F.lit(3))).alias("invoice_date"),
    )


def stock(spark: SparkSession, sf_dir: str, as_of: dt.date, sku: str = "brand") -> DataFrame:
    """Stock quality snapshot at ``as_of``: one row per (sku, branch) sold in the last 30 days.

    Open lines are stock, finished lines the cost-of-sales divisor (0 where a key had no
    finished line, exercising the zero-divisor rule).
    """
    start = as_of - dt.timedelta(days=STOCK_WINDOW_DAYS)
    li = table(spark, sf_dir, "lineitem").where(ship_date_between(start, as_of)).select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus"
    )
    lines = _with_sku(spark, sf_dir, li, sku).withColumn("branch", _branch())
    is_open = F.col("l_linestatus") == "O"
    zero = F.lit(0).cast("decimal(18,2)")
    agg = lines.groupBy("sku", "branch").agg(
        F.sum(F.when(is_open, F.col("l_quantity").cast("decimal(18,2)")).otherwise(zero)).alias("stock_qty"),
        F.sum(F.when(is_open, F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(zero)).alias("stock_value"),
        F.sum(F.when(~is_open, F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(zero)).alias("cmv_sales_value"),
    )
    return agg.select(
        F.lit(as_of).alias("stock_date"),
        "sku",
        "branch",
        F.when(F.col("branch") < FIRST_CD, "L").otherwise("D").alias("stock_place"),
        F.when(F.col("branch").isin(*INACTIVE_STORES), "INATIVA").otherwise("ATIVA").alias("store_status"),
        F.col("stock_qty").cast("decimal(18,2)").alias("stock_qty"),
        F.col("stock_value").cast("decimal(18,2)").alias("stock_value"),
        F.col("cmv_sales_value").cast("decimal(18,2)").alias("cmv_sales_value"),
        F.lit(f"{as_of.isoformat()} 00:00:00").cast("timestamp").alias("ingested_at"),
    )


def gef(spark: SparkSession, sf_dir: str, as_of: dt.date, sku: str = "brand") -> DataFrame:
    """GEF feed for stores: the (store, sku) keys sold in the 30 days before the stock
    window, one row per line status of those sales. Keys without earlier sales have no row
    (the enrichment's unmatched keys); keys sold with both statuses appear twice, as exact
    copies, since every metric is a function of the key (the duplicate audit's case)."""
    end = as_of - dt.timedelta(days=STOCK_WINDOW_DAYS + 1)
    start = end - dt.timedelta(days=STOCK_WINDOW_DAYS - 1)
    li = table(spark, sf_dir, "lineitem").where(ship_date_between(start, end)).select("l_partkey", "l_suppkey", "l_linestatus")
    rows = (
        _with_sku(spark, sf_dir, li, sku)
        .select(_branch().alias("branch"), "sku", "sku_num", "l_linestatus")
        .where(F.col("branch") < FIRST_CD)
        .distinct()
    )
    metrics = [
        (F.pmod(F.col("branch") * a + F.col("sku_num") * b, F.lit(m)) + k).cast("int").alias(name)
        for name, (a, b, m, k) in ((n, GEF_RULES[n]) for n in GEF_METRICS)
    ]
    return rows.select(F.lit(as_of).alias("stock_date"), "branch", "sku", *metrics)


# The four categories that the documentation names; a SKU's is its brand number modulo 4.
CATEGORIES = ("Telefonia Celular", "Eletrodomésticos", "Informática", "Móveis")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU (brand) and its category."""
    brand = table(spark, sf_dir, "part").select(F.col("p_brand").alias("sku")).distinct()
    at = F.pmod(F.substring("sku", 7, 10).cast("int"), F.lit(len(CATEGORIES))) + 1
    return brand.select("sku", F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), at).alias("category"))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branch b stands in nation b: its state is the nation, its region the nation's."""
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    nation = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return nation.select(F.col("n_nationkey").cast("int").alias("branch"), F.col("n_name").alias("state"), "region")


def supply_plan_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store -> CD plan for the GEF roll-up: store b is delivered by CD 20 + b % 5.

    One line per supplier of the store's branch, so every pair repeats (tests the distinct).
    """
    sup = table(spark, sf_dir, "supplier").select(F.pmod(F.col("s_suppkey"), F.lit(N_BRANCHES)).alias("b"))
    return sup.where(F.col("b") < FIRST_CD).select(
        F.lit(FIRST_CD).cast("long").alias("supplying_cd"),
        (F.lit(FIRST_CD) + F.pmod(F.col("b"), F.lit(5))).cast("long").alias("delivering_cd"),
        F.col("b").cast("long").alias("store"),
    )


def supply_plan_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supply plan for the network: one line per order line.

    Nation hubs (ids 0-24) supply suppliers (ids from 1), which deliver to the customers
    that ordered from them (ids 100000 + custkey). Nation and supplier ids overlap on
    purpose: it creates cycles, several sources and CDs that supply themselves.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.select(
        F.col("s_nationkey").cast("long").alias("supplying_cd"),
        F.col("l_suppkey").cast("long").alias("delivering_cd"),
        (F.lit(STORE_ID_OFFSET) + F.col("o_custkey")).cast("long").alias("store"),
    )


def adapters(spark: SparkSession, sf_dir: str, as_of: dt.date, sku: str = "brand") -> dict[str, DataFrame]:
    """All inputs of the pipelines, lazily."""
    return {
        "rated_sales": rated_sales(spark, sf_dir, sku),
        "quantity_sales": quantity_sales(spark, sf_dir),
        "stock": stock(spark, sf_dir, as_of, sku),
        "gef": gef(spark, sf_dir, as_of, sku),
        "supply_plan_stock": supply_plan_stock(spark, sf_dir),
        "supply_plan": supply_plan_network(spark, sf_dir),
    }
