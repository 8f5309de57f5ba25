"""The fixture adapters of ``stocklens.sources.testdata`` as SQL over the test views.

Each function returns the body of a CTE. ``with_fixtures(sql, names)`` prefixes a query with
the CTEs it needs (and those they depend on).
"""

from __future__ import annotations

import datetime as dt

from stocklens.sources.contracts import GEF_METRICS
from stocklens.sources.testdata import (
    CATEGORIES,
    FIRST_CD,
    GEF_RULES,
    INACTIVE_STORES,
    N_BRANCHES,
    STOCK_WINDOW_DAYS,
    STORE_ID_OFFSET,
)

AS_OF = dt.date(2001, 6, 30)


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


FACT_KEY = (
    "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))"
)


def rated_sales() -> str:
    return f"""
SELECT {FACT_KEY} AS fact_key,
       CAST(l_shipdate AS DATE) AS approval_date,
       CASE WHEN l_returnflag = 'R' THEN '1 - SALDO' ELSE '2 - NOVO' END AS goods_state,
       CASE WHEN l_linestatus = 'F' THEN 'LOJA FISICA' ELSE 'SITE' END AS business_type,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sale_value,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,4)) AS cost_value,
       p_brand AS sku,
       CAST(l_suppkey % {N_BRANCHES} AS INTEGER) AS selling_branch,
       CAST(s_nationkey AS INTEGER) AS issuing_branch
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


def quantity_sales() -> str:
    return f"""
SELECT {FACT_KEY} AS fact_key,
       CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
       CAST(l_shipdate AS DATE) + CAST(l_linenumber % 3 AS INTEGER) AS invoice_date
FROM lineitem"""


def stock(as_of: dt.date = AS_OF) -> str:
    start = as_of - dt.timedelta(days=STOCK_WINDOW_DAYS)
    inactive = ", ".join(str(b) for b in INACTIVE_STORES)
    return f"""
SELECT {d(as_of)} AS stock_date, p_brand AS sku, CAST(l_suppkey % {N_BRANCHES} AS INTEGER) AS branch,
       CASE WHEN l_suppkey % {N_BRANCHES} < {FIRST_CD} THEN 'L' ELSE 'D' END AS stock_place,
       CASE WHEN l_suppkey % {N_BRANCHES} IN ({inactive}) THEN 'INATIVA' ELSE 'ATIVA' END AS store_status,
       CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS stock_qty,
       CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS stock_value,
       CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS cmv_sales_value,
       CAST({d(as_of)} AS TIMESTAMP) AS ingested_at
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE CAST(l_shipdate AS DATE) BETWEEN {d(start)} AND {d(as_of)}
GROUP BY p_brand, l_suppkey % {N_BRANCHES}"""


def gef(as_of: dt.date = AS_OF) -> str:
    metrics = ",\n       ".join(
        f"CAST((branch * {a} + sku_num * {b}) % {m} + {k} AS INTEGER) AS {name}"
        for name, (a, b, m, k) in ((n, GEF_RULES[n]) for n in GEF_METRICS)
    )
    end = as_of - dt.timedelta(days=STOCK_WINDOW_DAYS + 1)
    start = end - dt.timedelta(days=STOCK_WINDOW_DAYS - 1)
    return f"""
WITH k AS (
  SELECT DISTINCT CAST(l_suppkey % {N_BRANCHES} AS INTEGER) AS branch, p_brand AS sku,
         CAST(substr(p_brand, 7) AS INTEGER) AS sku_num, l_linestatus
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE CAST(l_shipdate AS DATE) BETWEEN {d(start)} AND {d(end)} AND l_suppkey % {N_BRANCHES} < {FIRST_CD}
)
SELECT {d(as_of)} AS stock_date, branch, sku,
       {metrics}
FROM k"""


def supply_plan_stock() -> str:
    return f"""
SELECT CAST({FIRST_CD} AS BIGINT) AS supplying_cd,
       CAST({FIRST_CD} + (s_suppkey % {N_BRANCHES}) % 5 AS BIGINT) AS delivering_cd,
       CAST(s_suppkey % {N_BRANCHES} AS BIGINT) AS store
FROM supplier WHERE s_suppkey % {N_BRANCHES} < {FIRST_CD}"""


def supply_plan() -> str:
    return f"""
SELECT CAST(s_nationkey AS BIGINT) AS supplying_cd,
       CAST(l_suppkey AS BIGINT) AS delivering_cd,
       CAST({STORE_ID_OFFSET} + o_custkey AS BIGINT) AS store
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey"""


def products() -> str:
    names = ", ".join(f"'{c}'" for c in CATEGORIES)
    return f"""
SELECT DISTINCT p_brand AS sku, ([{names}])[CAST(substr(p_brand, 7) AS INTEGER) % {len(CATEGORIES)} + 1] AS category FROM part"""


def branches() -> str:
    return """
SELECT CAST(n_nationkey AS INTEGER) AS branch, n_name AS state, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey"""


PREVIOUS = AS_OF - dt.timedelta(days=30)

FIXTURES = {
    "products_dim": products,
    "branches_dim": branches,
    "stock_prev": lambda: stock(PREVIOUS),
    "gef_prev": lambda: gef(PREVIOUS),
    "rated_sales": rated_sales,
    "quantity_sales": quantity_sales,
    "stock": stock,
    "gef": gef,
    "supply_plan_stock": supply_plan_stock,
    "supply_plan": supply_plan,
}


def with_fixtures(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``WITH <fixtures>, <extra> <body>``: fixtures first, then query-specific CTEs in order."""
    ctes = [f"{n} AS ({FIXTURES[n]()})" for n in names]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(ctes) + "\n" if ctes else "") + body
