"""DuckDB SQL for each registered query, written independently of the Spark operators:
it follows the reference's own structure (calendar x keys grid, left joins, window functions)
where the Spark side uses cheaper equivalents."""

from __future__ import annotations

import datetime as dt

from oracle.fixtures import AS_OF, PREVIOUS, d, gef, stock, with_fixtures
from stocklens.sources.testdata import CATEGORIES

START = AS_OF - dt.timedelta(days=90)
W = f"{d(START)} AND {d(AS_OF)}"

ORACLE: dict[str, str] = {}


def q(name: str, sql: str) -> None:
    ORACLE[name] = sql


# =========================================================================== sales

LINES_CTES = {
    "q_ok": f"SELECT fact_key, quantity FROM quantity_sales WHERE quantity >= 0 AND invoice_date BETWEEN {W}",
    "lines": f"""
SELECT r.approval_date AS date, r.sku,
       CASE WHEN r.business_type = 'LOJA FISICA' THEN r.selling_branch ELSE r.issuing_branch END AS branch,
       CASE WHEN r.business_type = 'LOJA FISICA' THEN 'OFF' ELSE 'ON' END AS channel,
       r.sale_value, q.quantity, r.cost_value
FROM rated_sales r JOIN q_ok q ON r.fact_key = q.fact_key
WHERE r.goods_state <> '1 - SALDO' AND r.business_type IS NOT NULL
  AND r.approval_date BETWEEN {W} AND r.sale_value >= 0 AND r.cost_value >= 0""",
}

DENSE_CTES = {
    **LINES_CTES,
    "daily": "SELECT channel, branch, sku, date, SUM(sale_value) AS revenue, SUM(quantity) AS qty FROM lines GROUP BY channel, branch, sku, date",
    "keys_": "SELECT DISTINCT channel, branch, sku FROM lines",
    "grid": f"""
SELECT channel, branch, sku, CAST(unnest(generate_series({d(START)}, {d(AS_OF)}, INTERVAL 1 DAY)) AS DATE) AS date
FROM keys_""",
    "dense": """
SELECT g.channel, g.date, CAST(year(g.date) * 100 + month(g.date) AS INTEGER) AS year_month, g.branch, g.sku,
       COALESCE(dl.revenue, 0) AS revenue, COALESCE(dl.qty, 0) AS qty,
       CAST(CASE WHEN COALESCE(dl.qty, 0) > 0 THEN 1 ELSE 0 END AS INTEGER) AS sold
FROM grid g LEFT JOIN daily dl ON g.channel = dl.channel AND g.branch = dl.branch AND g.sku = dl.sku AND g.date = dl.date""",
    "off_": "SELECT * FROM dense WHERE channel = 'OFF'",
    "on_": "SELECT * FROM dense WHERE channel = 'ON'",
    # Both channels of a key and day side by side: keys of either channel x days, each channel's
    # sum where it has one, else zero.
    "wide": """
SELECT branch, sku, date,
       SUM(CASE WHEN channel = 'OFF' THEN revenue END) AS revenue_off, SUM(CASE WHEN channel = 'OFF' THEN qty END) AS qty_off,
       SUM(CASE WHEN channel = 'ON' THEN revenue END) AS revenue_on, SUM(CASE WHEN channel = 'ON' THEN qty END) AS qty_on
FROM daily GROUP BY branch, sku, date""",
    "cells": f"""
SELECT branch, sku, CAST(unnest(generate_series({d(START)}, {d(AS_OF)}, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT DISTINCT branch, sku FROM keys_)""",
    "sales": """
SELECT date, CAST(year(date) * 100 + month(date) AS INTEGER) AS year_month, branch, sku,
       CAST(ro AS DOUBLE) AS revenue_off, CAST(qo AS DOUBLE) AS qty_off, CAST(CASE WHEN qo > 0 THEN 1 ELSE 0 END AS INTEGER) AS sold_off,
       CAST(rn AS DOUBLE) AS revenue_on, CAST(qn AS DOUBLE) AS qty_on, CAST(CASE WHEN qn > 0 THEN 1 ELSE 0 END AS INTEGER) AS sold_on,
       CAST(ro + rn AS DOUBLE) AS revenue, CAST(qo + qn AS DOUBLE) AS qty,
       CAST((CASE WHEN qo > 0 THEN 1 ELSE 0 END) + (CASE WHEN qn > 0 THEN 1 ELSE 0 END) AS INTEGER) AS sold
FROM (SELECT c.date, c.branch, c.sku, COALESCE(w.revenue_off, 0) AS ro, COALESCE(w.qty_off, 0) AS qo,
             COALESCE(w.revenue_on, 0) AS rn, COALESCE(w.qty_on, 0) AS qn
      FROM cells c LEFT JOIN wide w ON c.branch = w.branch AND c.sku = w.sku AND c.date = w.date)""",
}

SALES_FIX = ("rated_sales", "quantity_sales")


def sales_sql(body: str, extra: dict[str, str] | None = None) -> str:
    return with_fixtures(body, *SALES_FIX, extra={**DENSE_CTES, **(extra or {})})


q("p1_filter_sales", with_fixtures(f"""
SELECT fact_key, approval_date, sku, selling_branch, CAST(sale_value AS DOUBLE) AS sale_value
FROM rated_sales
WHERE goods_state <> '1 - SALDO' AND business_type = 'LOJA FISICA'
  AND approval_date BETWEEN {W} AND sale_value >= 0 AND cost_value >= 0""", "rated_sales"))

q("p2_filter_quantity", with_fixtures(f"""
SELECT fact_key, CAST(quantity AS DOUBLE) AS quantity FROM quantity_sales
WHERE quantity >= 0 AND invoice_date BETWEEN {W}""", "quantity_sales"))

q("j1_join_value_quantity", with_fixtures(
    "SELECT date, sku, branch, channel, CAST(sale_value AS DOUBLE) AS sale_value, CAST(quantity AS DOUBLE) AS quantity FROM lines",
    *SALES_FIX, extra=LINES_CTES))

q("a1_daily_sales", with_fixtures("""
SELECT date, sku, branch, channel,
       CAST(SUM(sale_value) AS DOUBLE) AS revenue, CAST(SUM(quantity) AS DOUBLE) AS qty,
       CAST(SUM(cost_value) AS DOUBLE) AS cost,
       CAST(year(date) * 100 + month(date) AS INTEGER) AS year_month
FROM lines GROUP BY date, sku, branch, channel""", *SALES_FIX, extra=LINES_CTES))

q("j2_date_key_grid", sales_sql("SELECT branch, sku, date FROM grid WHERE channel = 'OFF'"))

q("j3_densify", sales_sql("""
SELECT date, year_month, branch, sku, CAST(revenue AS DOUBLE) AS revenue, CAST(qty AS DOUBLE) AS qty, sold
FROM on_"""))

q("j4_merge_channels", sales_sql("SELECT * FROM sales"))
q("dense_daily_sales", sales_sql("SELECT * FROM sales"))

q("a2_sales_stats", sales_sql("""
SELECT COUNT(*) AS total_rows,
       CAST(SUM(CAST(revenue AS DECIMAL(28,2))) AS DOUBLE) AS revenue_total,
       CAST(SUM(CAST(qty AS DECIMAL(28,2))) AS DOUBLE) AS qty_total,
       CAST(SUM(sold) AS BIGINT) AS sale_days,
       COUNT(DISTINCT branch) AS distinct_branches, COUNT(DISTINCT sku) AS distinct_skus,
       CAST(SUM(CAST(revenue_off AS DECIMAL(28,2))) AS DOUBLE) AS revenue_off,
       CAST(SUM(CAST(revenue_on AS DECIMAL(28,2))) AS DOUBLE) AS revenue_on,
       CAST(SUM(CAST(qty_off AS DECIMAL(28,2))) AS DOUBLE) AS qty_off,
       CAST(SUM(CAST(qty_on AS DECIMAL(28,2))) AS DOUBLE) AS qty_on
FROM sales"""))

BRANCH_TOTALS = """
SELECT branch,
       CAST(SUM(CAST(revenue AS DECIMAL(28,2))) AS DOUBLE) AS revenue_total,
       CAST(SUM(CAST(revenue_off AS DECIMAL(28,2))) AS DOUBLE) AS revenue_off,
       CAST(SUM(CAST(revenue_on AS DECIMAL(28,2))) AS DOUBLE) AS revenue_on,
       CAST(SUM(CAST(qty AS DECIMAL(28,2))) AS DOUBLE) AS qty_total,
       CAST(SUM(sold) AS BIGINT) AS sale_days
FROM sales GROUP BY branch"""

q("a3_branch_totals", sales_sql(BRANCH_TOTALS))
q("t1_top_branches", sales_sql(
    "SELECT * FROM bt ORDER BY revenue_total DESC, branch ASC LIMIT 10", extra={"bt": BRANCH_TOTALS}))


# =========================================================================== stock + audits

AS = d(AS_OF)
METRICS = ", ".join(__import__("stocklens.sources.contracts", fromlist=["GEF_METRICS"]).GEF_METRICS)


def prepared(kind: str, table: str = "stock", day: str | None = None) -> str:
    cond = "store_status = 'ATIVA' AND stock_place = 'L'" if kind == "LOJA" else "stock_place = 'D'"
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date, sku, branch ORDER BY ingested_at DESC, stock_value DESC) AS rn
  FROM (SELECT CAST(ingested_at AS DATE) AS date, sku, branch, stock_place, store_status,
               stock_qty, stock_value, cmv_sales_value, ingested_at, '{kind}' AS stock_kind,
               CAST(stock_value AS DOUBLE) / NULLIF(CAST(cmv_sales_value AS DOUBLE), 0) AS dde
        FROM {table} WHERE stock_date >= {day or AS} AND {cond}))
WHERE rn = 1"""


STOCK_CTES = {
    "st_l": prepared("LOJA"),
    "st_d": prepared("CD"),
    "gef_feed": f"SELECT sku, branch, stock_date AS date, {METRICS} FROM gef",
    "gef_clean": "SELECT DISTINCT * FROM gef_feed",
    "pairs": "SELECT DISTINCT CAST(delivering_cd AS INTEGER) AS delivering_cd, CAST(store AS INTEGER) AS store FROM supply_plan_stock",
    "gef_cd": "SELECT g.*, p.delivering_cd FROM gef_clean g JOIN pairs p ON g.branch = p.store",
    "rollup": """
SELECT CAST(delivering_cd AS INTEGER) AS branch, sku, date,
       CAST(SUM(safety_stock) AS BIGINT) AS safety_stock, AVG(lead_time) AS lead_time,
       AVG(safety_cover_days) AS safety_cover_days, CAST(SUM(target_stock) AS BIGINT) AS target_stock,
       AVG(current_cover) AS current_cover, AVG(target_cover) AS target_cover,
       CAST(SUM(ddv_clean) AS BIGINT) AS ddv_clean, CAST(SUM(ddv_future) AS BIGINT) AS ddv_future,
       CAST(SUM(grade) AS BIGINT) AS grade, CAST(SUM(in_transit) AS BIGINT) AS in_transit,
       CAST(SUM(projected_stock) AS BIGINT) AS projected_stock,
       CAST(SUM(cover_with_transit_days) AS BIGINT) AS cover_with_transit_days,
       CAST(SUM(mean_3) AS BIGINT) AS mean_3, CAST(SUM(mean_6) AS BIGINT) AS mean_6,
       CAST(SUM(mean_9) AS BIGINT) AS mean_9, CAST(SUM(mean_12) AS BIGINT) AS mean_12,
       CAST(SUM(ddv_so) AS BIGINT) AS ddv_so, CAST(SUM(ddv_co) AS BIGINT) AS ddv_co,
       CAST(SUM(cluster_obg) AS BIGINT) AS cluster_obg, CAST(SUM(cluster_sug) AS BIGINT) AS cluster_sug
FROM gef_cd GROUP BY delivering_cd, sku, date""",
    "stores": "SELECT s.*, g.* EXCLUDE (branch, sku, date) FROM st_l s LEFT JOIN gef_clean g USING (branch, sku, date)",
    "cds": "SELECT s.*, r.* EXCLUDE (branch, sku, date) FROM st_d s LEFT JOIN rollup r USING (branch, sku, date)",
}
STOCK_FIX = ("stock", "gef", "supply_plan_stock")
STOCK_OUT = """* EXCLUDE (ingested_at, stock_qty, stock_value, cmv_sales_value),
       CAST(stock_qty AS DOUBLE) AS stock_qty, CAST(stock_value AS DOUBLE) AS stock_value,
       CAST(cmv_sales_value AS DOUBLE) AS cmv_sales_value"""


def stock_sql(body: str, extra: dict[str, str] | None = None) -> str:
    return with_fixtures(body, *STOCK_FIX, extra={**STOCK_CTES, **(extra or {})})


q("p3_filter_stock", stock_sql(f"""
SELECT {STOCK_OUT} FROM stock
WHERE stock_date >= {AS} AND ((store_status = 'ATIVA' AND stock_place = 'L') OR stock_place = 'D')"""))
q("d1_days_of_stock", stock_sql(
    "SELECT date, branch, sku, stock_kind, dde FROM st_l UNION ALL SELECT date, branch, sku, stock_kind, dde FROM st_d"))
q("p5_select_rename", stock_sql("SELECT * FROM gef_feed"))
q("a5_duplicate_keys", stock_sql(
    "SELECT branch, sku, date, COUNT(*) AS count FROM gef_feed GROUP BY branch, sku, date HAVING COUNT(*) > 1"))
q("v2_audit_keys", stock_sql("""
SELECT COUNT(*) AS duplicate_keys, CAST(COALESCE(SUM(c), 0) AS BIGINT) AS rows_in_duplicates
FROM (SELECT COUNT(*) AS c FROM gef_feed GROUP BY branch, sku, date HAVING COUNT(*) > 1)"""))
q("a8_dedupe", stock_sql("SELECT * FROM gef_clean"))
q("j5_enrich_stock", stock_sql(f"SELECT {STOCK_OUT} FROM stores"))
q("p8_matched", stock_sql("SELECT date, branch, sku, safety_stock FROM stores WHERE safety_stock IS NOT NULL"))
q("v3_audit_join", stock_sql("""
SELECT b.n AS rows_before, a.n AS rows_after, a.n - b.n AS row_growth, a.m AS matched_rows,
       ROUND(a.m * 100.0 / NULLIF(a.n, 0), 2) AS match_pct
FROM (SELECT COUNT(*) AS n FROM st_l) b,
     (SELECT COUNT(*) AS n, COUNT(safety_stock) AS m FROM stores) a"""))
q("j6_map_store_to_cd", stock_sql("SELECT date, branch, sku, delivering_cd, safety_stock, lead_time FROM gef_cd"))
q("a4_rollup_gef_to_cd", stock_sql("SELECT * FROM rollup"))
q("j7_enrich_cd_stock", stock_sql(f"SELECT {STOCK_OUT} FROM cds"))
q("a7_distinct_keys", with_fixtures("SELECT DISTINCT branch, sku FROM lines", *SALES_FIX, extra=LINES_CTES))
q("t2_ordered_dates", with_fixtures(
    "SELECT DISTINCT invoice_date FROM quantity_sales ORDER BY invoice_date LIMIT 10", "quantity_sales"))


# =========================================================================== master

from stocklens.functions.dates import month_end, period_bounds  # noqa: E402

B = period_bounds(AS_OF)
MA = (7, 14, 30, 60, 90)
MEAS = ("revenue", "qty")


def cents(c: str) -> str:
    return f"CAST({c} AS DECIMAL(28,2))"


def period_sql(month_mode: str) -> list[str]:
    conds = {p: f"date >= {d(B[p])}" for p in ("mtd", "ytd", "last7d", "last30d", "last90d", "last4w")}
    for p in ("m1", "m2", "m3"):
        conds[p] = f"date = {d(B[p])}" if month_mode == "first_day" else f"date BETWEEN {d(B[p])} AND {d(month_end(B[p]))}"
    return [
        f"CAST(SUM(CASE WHEN {c} THEN {cents(m)} ELSE 0 END) AS DOUBLE) AS {m}_{p}"
        for p, c in conds.items() for m in MEAS
    ]


MM_WINDOW = ",\n       ".join(
    f"CAST(SUM({cents(m)}) OVER (PARTITION BY branch, sku ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) / {n}.0 AS {m}_mm{n}d"
    for n in MA for m in MEAS
)
MM_NAMES = [f"{m}_mm{n}d" for n in MA for m in MEAS]


def summary_sql(month_mode: str) -> str:
    cols = [
        f"CAST(SUM({cents('revenue')}) AS DOUBLE) AS revenue_total",
        f"CAST(SUM({cents('qty')}) AS DOUBLE) AS qty_total",
        "CAST(SUM(sold) AS BIGINT) AS sale_days",
        f"CAST(SUM({cents('revenue_off')}) AS DOUBLE) AS revenue_off_total",
        f"CAST(SUM({cents('qty_off')}) AS DOUBLE) AS qty_off_total",
        f"CAST(SUM({cents('revenue_on')}) AS DOUBLE) AS revenue_on_total",
        f"CAST(SUM({cents('qty_on')}) AS DOUBLE) AS qty_on_total",
        *period_sql(month_mode),
        *[f"arg_max({c}, date) AS {c}" for c in MM_NAMES],
        "COUNT(DISTINCT date) AS grid_days", "MIN(date) AS grid_first", "MAX(date) AS grid_last",
        "COUNT(DISTINCT CASE WHEN qty > 0 THEN date END) AS active_days",
        "MIN(CASE WHEN qty > 0 THEN date END) AS first_sale",
        "MAX(CASE WHEN qty > 0 THEN date END) AS last_sale",
    ]
    return "SELECT branch, sku,\n       " + ",\n       ".join(cols) + "\nFROM sales_mm GROUP BY branch, sku"


MASTER_CTES = {
    **DENSE_CTES,
    **STOCK_CTES,
    "sales_mm": f"SELECT *, {MM_WINDOW} FROM sales",
    "summary": summary_sql("first_day"),
    "summary_full": summary_sql("full_month"),
}
MASTER_FIX = SALES_FIX + STOCK_FIX
CURRENT = """* EXCLUDE (stock_qty, stock_value, dde, ingested_at, cmv_sales_value),
       CAST(stock_qty AS DOUBLE) AS current_stock_qty, CAST(stock_value AS DOUBLE) AS current_stock_value,
       dde AS current_dde, CAST(cmv_sales_value AS DOUBLE) AS cmv_sales_value"""


def master_sql(body: str, extra: dict[str, str] | None = None) -> str:
    return with_fixtures(body, *MASTER_FIX, extra={**MASTER_CTES, **(extra or {})})


def master_of(stock_cte: str) -> str:
    return f"""
SELECT c.* EXCLUDE (date), {AS} AS date, s.* EXCLUDE (branch, sku)
FROM (SELECT {CURRENT} FROM {stock_cte} WHERE date = {AS}) c
LEFT JOIN summary s ON c.branch = s.branch AND c.sku = s.sku"""


def zero_filled(cte: str) -> str:
    fill = [f"COALESCE({c}, 0) AS {c}" for c in SUMMARY_FILL]
    return f"SELECT * REPLACE ({', '.join(fill)}) FROM {cte}"


SUMMARY_FILL = (
    ["revenue_total", "qty_total", "revenue_off_total", "qty_off_total", "revenue_on_total", "qty_on_total"]
    + [f"{m}_{p}" for p in ("mtd", "ytd", "last7d", "last30d", "last90d", "last4w", "m1", "m2", "m3") for m in MEAS]
    + MM_NAMES
)

q("w1_with_row_number", sales_sql(
    "SELECT *, CAST(row_number() OVER (PARTITION BY branch, sku ORDER BY date) AS INTEGER) AS row_number FROM sales"))
q("w2_period_totals", sales_sql(
    "SELECT branch, sku, " + ", ".join(period_sql("first_day")) + " FROM sales GROUP BY branch, sku"))
q("w2_period_totals_full_month", sales_sql(
    "SELECT branch, sku, " + ", ".join(period_sql("full_month")) + " FROM sales GROUP BY branch, sku"))
q("w3_moving_averages", master_sql("SELECT * FROM sales_mm"))
q("w4_period_bounds", sales_sql("""
SELECT as_of,
       CAST(date_trunc('month', as_of) AS DATE) AS mtd_start, CAST(date_trunc('year', as_of) AS DATE) AS ytd_start,
       CAST(as_of - INTERVAL 7 DAY AS DATE) AS last7d_start, CAST(as_of - INTERVAL 14 DAY AS DATE) AS last14d_start,
       CAST(as_of - INTERVAL 30 DAY AS DATE) AS last30d_start, CAST(as_of - INTERVAL 60 DAY AS DATE) AS last60d_start,
       CAST(as_of - INTERVAL 90 DAY AS DATE) AS last90d_start, CAST(as_of - INTERVAL 28 DAY AS DATE) AS last4w_start,
       CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) AS m1_start,
       CAST(date_trunc('month', as_of) - INTERVAL 2 MONTH AS DATE) AS m2_start,
       CAST(date_trunc('month', as_of) - INTERVAL 3 MONTH AS DATE) AS m3_start
FROM (SELECT MAX(date) AS as_of FROM sales)"""))
q("w5_latest_per_key", master_sql(
    "SELECT branch, sku, " + ", ".join(f"arg_max({c}, date) AS {c}" for c in MM_NAMES) + " FROM sales_mm GROUP BY branch, sku"))
q("a6_sales_summary", master_sql("SELECT * FROM summary"))
q("a6_sales_summary_full_month", master_sql("SELECT * FROM summary_full"))
q("p4_snapshot", master_sql(f"SELECT {CURRENT} FROM stores WHERE date = {AS}"))
q("j8_build_master", master_sql(zero_filled("m"), extra={"m": master_of("stores")}))
q("j8_build_master_cds", master_sql(zero_filled("m"), extra={"m": master_of("cds")}))
q("p7_fill_zero", master_sql(
    "SELECT branch, sku, " + ", ".join(SUMMARY_FILL) + " FROM z", extra={"m": master_of("cds"), "z": zero_filled("m")}))


# =========================================================================== network


def graph_ctes(p: str, edges_sql: str) -> dict[str, str]:
    """Degrees, components (mutual reachability by a recursive closure) and BFS levels of
    one edge set, as CTEs prefixed ``p``."""
    return {
        f"{p}_e": edges_sql,
        f"{p}_n": f"SELECT src AS node FROM {p}_e UNION SELECT dst FROM {p}_e",
        f"{p}_deg": f"""
SELECT n.node, CAST(COALESCE(i.c, 0) + COALESCE(o.c, 0) AS BIGINT) AS degree,
       CAST(COALESCE(i.c, 0) AS BIGINT) AS in_degree, CAST(COALESCE(o.c, 0) AS BIGINT) AS out_degree
FROM {p}_n n
LEFT JOIN (SELECT dst AS node, COUNT(*) AS c FROM {p}_e GROUP BY dst) i ON n.node = i.node
LEFT JOIN (SELECT src AS node, COUNT(*) AS c FROM {p}_e GROUP BY src) o ON n.node = o.node""",
        f"{p}_reach": f"""
SELECT src AS a, dst AS b FROM {p}_e WHERE src <> dst
UNION
SELECT r.a, e.dst FROM {p}_reach r JOIN {p}_e e ON r.b = e.src WHERE e.src <> e.dst""",
        f"{p}_mut": f"""
SELECT r1.a AS node, r1.b AS other FROM {p}_reach r1 JOIN {p}_reach r2 ON r1.a = r2.b AND r1.b = r2.a
WHERE r1.a <> r1.b""",
        f"{p}_scc": f"""
SELECT n.node, GREATEST(n.node, COALESCE(MAX(m.other), n.node)) AS scc_id, CAST(1 + COUNT(m.other) AS BIGINT) AS scc_size
FROM {p}_n n LEFT JOIN {p}_mut m ON n.node = m.node GROUP BY n.node""",
    }


CD_EDGES = """
SELECT DISTINCT supplying_cd AS src, delivering_cd AS dst FROM supply_plan
WHERE supplying_cd IS NOT NULL AND delivering_cd IS NOT NULL AND supplying_cd <> delivering_cd"""
ST_EDGES = """
SELECT DISTINCT delivering_cd AS src, store AS dst FROM supply_plan
WHERE delivering_cd IS NOT NULL AND store IS NOT NULL"""

NET_CTES = {
    **graph_ctes("cd", CD_EDGES),
    **graph_ctes("st", ST_EDGES),
    "cd_src": "SELECT node FROM cd_n WHERE node NOT IN (SELECT dst FROM cd_e)",
    "cd_bfs": """
SELECT node AS source, node, 0 AS dist FROM cd_src
UNION
SELECT b.source, e.dst, b.dist + 1 FROM cd_bfs b JOIN cd_e e ON b.node = e.src
WHERE b.dist < (SELECT COUNT(*) FROM cd_n)""",
    "cd_lvl": """
SELECT node, CAST(MAX(d) AS BIGINT) AS level FROM (SELECT source, node, MIN(dist) AS d FROM cd_bfs GROUP BY source, node) GROUP BY node
UNION ALL
SELECT node, CAST(0 AS BIGINT) FROM cd_n WHERE NOT EXISTS (SELECT 1 FROM cd_src)""",
    "st_lvl": "SELECT node, CAST(CASE WHEN out_degree > 0 THEN 0 ELSE 1 END AS BIGINT) AS level FROM st_deg",
    "nodes_cd": """
SELECT d.node, 'CD' AS node_type, 'CD→CD' AS graph, d.degree, d.in_degree, d.out_degree,
       COALESCE(l.level, 0) AS level, s.scc_size, s.scc_size > 1 AS in_cycle
FROM cd_deg d JOIN cd_scc s ON d.node = s.node LEFT JOIN cd_lvl l ON d.node = l.node""",
    "nodes_st": """
SELECT d.node, CASE WHEN d.out_degree > 0 THEN 'CD' ELSE 'Loja' END AS node_type, 'CD→Loja' AS graph,
       d.degree, d.in_degree, d.out_degree, COALESCE(l.level, 0) AS level, s.scc_size, s.scc_size > 1 AS in_cycle
FROM st_deg d JOIN st_scc s ON d.node = s.node LEFT JOIN st_lvl l ON d.node = l.node""",
    "nodes_all": "SELECT * FROM nodes_cd UNION ALL SELECT * FROM nodes_st",
    "edges_all": """
SELECT src AS origin, dst AS destination, 'CD→CD' AS edge_type, 'CD' AS origin_type, 'CD' AS destination_type FROM cd_e
UNION ALL
SELECT src, dst, 'CD→Loja', 'CD', 'Loja' FROM st_e""",
    "layout": """
SELECT node, graph, CAST(degree % 10 AS DOUBLE) * CAST(0.2 AS DOUBLE) - CAST(1 AS DOUBLE) AS x,
       (SELECT MAX(level) FROM nodes_all) - level AS y,
       CASE WHEN in_cycle THEN 'red' WHEN node_type = 'CD' THEN 'blue' ELSE 'green' END AS colour,
       CAST(GREATEST(10, LEAST(50, degree * 2)) AS BIGINT) AS size,
       '<b>' || CAST(node AS VARCHAR) || '</b><br>Tipo: ' || node_type || '<br>Grafo: ' || graph
       || '<br>Grau Total: ' || CAST(degree AS VARCHAR) || '<br>Grau Entrada: ' || CAST(in_degree AS VARCHAR)
       || '<br>Grau Saída: ' || CAST(out_degree AS VARCHAR) || '<br>Nível Hierárquico: ' || CAST(level AS VARCHAR)
       || '<br>SCC Size: ' || CAST(scc_size AS VARCHAR) || '<br>Em Ciclo: ' || CASE WHEN in_cycle THEN 'Sim' ELSE 'Não' END AS label
FROM nodes_all""",
}


def net_sql(body: str, extra: dict[str, str] | None = None) -> str:
    return with_fixtures(body, "supply_plan", extra={**NET_CTES, **(extra or {})}, recursive=True)


def top_sql(col: str, edges: str) -> str:
    return f"SELECT {col} AS node, COUNT(*) AS edges FROM {edges} GROUP BY {col} ORDER BY edges DESC, node ASC LIMIT 10"


q("p9_where_pair", with_fixtures(
    "SELECT * FROM supply_plan WHERE supplying_cd = delivering_cd AND store IS NOT NULL", "supply_plan"))
q("g1_cd_cd_edges", net_sql("SELECT * FROM cd_e"))
q("g2_cd_store_edges", net_sql("SELECT * FROM st_e"))
q("g3_plan_profile", with_fixtures("""
SELECT COUNT(*) AS total_lines,
       COUNT(*) FILTER (WHERE supplying_cd IS NOT NULL AND delivering_cd IS NOT NULL AND supplying_cd <> delivering_cd) AS cd_cd_lines,
       COUNT(DISTINCT supplying_cd) FILTER (WHERE delivering_cd IS NOT NULL AND supplying_cd <> delivering_cd) AS cd_cd_suppliers,
       COUNT(DISTINCT delivering_cd) FILTER (WHERE supplying_cd IS NOT NULL AND supplying_cd <> delivering_cd) AS cd_cd_receivers,
       COUNT(*) FILTER (WHERE delivering_cd IS NOT NULL AND store IS NOT NULL) AS cd_store_lines,
       COUNT(DISTINCT delivering_cd) FILTER (WHERE store IS NOT NULL) AS cd_store_cds,
       COUNT(DISTINCT store) FILTER (WHERE delivering_cd IS NOT NULL) AS cd_store_stores,
       COUNT(*) FILTER (WHERE supplying_cd = delivering_cd AND store IS NOT NULL) AS own_store_lines,
       COUNT(*) FILTER (WHERE supplying_cd <> delivering_cd AND store IS NOT NULL) AS other_cd_lines,
       COUNT(DISTINCT supplying_cd) AS distinct_supplying_cds
FROM supply_plan""", "supply_plan"))
q("g4_graph_nodes", net_sql("SELECT * FROM cd_n"))
q("g5_density", net_sql("""
SELECT n AS nodes, m AS edges, CASE WHEN n > 1 THEN m / CAST(n * (n - 1) AS DOUBLE) ELSE 0.0 END AS density
FROM (SELECT (SELECT COUNT(*) FROM cd_n) AS n, (SELECT COUNT(*) FROM cd_e) AS m)"""))
q("g6_degrees", net_sql("SELECT * FROM cd_deg"))
q("g7_scc", net_sql("SELECT * FROM cd_scc"))
q("g8_scc_summary", net_sql("""
SELECT COUNT(*) AS total_sccs, COUNT(*) FILTER (WHERE scc_size > 1) AS sccs_with_cycles,
       COUNT(*) FILTER (WHERE scc_size = 1) AS isolated_sccs,
       CAST(COALESCE(SUM(scc_size) FILTER (WHERE scc_size > 1), 0) AS BIGINT) AS nodes_in_cycles,
       CAST(COALESCE(MAX(scc_size) FILTER (WHERE scc_size > 1), 0) AS BIGINT) AS largest_cycle
FROM (SELECT DISTINCT scc_id, scc_size FROM cd_scc)"""))
q("g9_cd_levels", net_sql("SELECT * FROM cd_lvl"))
q("g10_store_levels", net_sql("SELECT * FROM st_lvl"))
q("g11_node_metrics", net_sql("SELECT * FROM nodes_all"))
q("g12_edge_table", net_sql("SELECT * FROM edges_all"))
q("g13_hierarchy_summary", net_sql("""
SELECT (SELECT COUNT(*) FROM cd_src) AS sources, CAST(COALESCE(MAX(level), 0) AS BIGINT) AS max_depth,
       COUNT(DISTINCT level) AS distinct_levels
FROM cd_lvl"""))
q("a10_level_distribution", net_sql("SELECT level, COUNT(*) AS nodes FROM cd_lvl GROUP BY level"))
q("a11_network_totals", net_sql("""
SELECT COUNT(*) AS total_nodes, (SELECT COUNT(*) FROM edges_all) AS total_edges,
       COUNT(*) FILTER (WHERE node_type = 'CD') AS cd_rows, COUNT(*) FILTER (WHERE node_type = 'Loja') AS store_rows,
       COUNT(*) FILTER (WHERE in_cycle) AS nodes_in_cycles,
       COUNT(DISTINCT node) FILTER (WHERE node_type = 'CD') AS cd_distinct
FROM nodes_all"""))
q("a9_value_counts", with_fixtures(
    "SELECT delivering_cd, COUNT(*) AS count FROM supply_plan GROUP BY delivering_cd", "supply_plan"))
q("a9_distinct_count", with_fixtures("""
SELECT COUNT(DISTINCT supplying_cd) AS distinct_supplying_cd, COUNT(DISTINCT delivering_cd) AS distinct_delivering_cd,
       COUNT(DISTINCT store) AS distinct_store FROM supply_plan""", "supply_plan"))
q("t3_top_out_degree", net_sql(top_sql("src", "cd_e")))
q("t3_top_in_degree", net_sql(top_sql("dst", "cd_e")))
q("t3_top_stores_served", net_sql(top_sql("src", "st_e")))
q("t3_top_nodes", net_sql("SELECT * FROM nodes_all ORDER BY degree DESC, graph ASC, node ASC LIMIT 10"))
q("g15_network_layout", net_sql("SELECT * FROM layout"))
q("j9_edge_coordinates", net_sql("""
SELECT e.origin, e.destination, o.x AS x0, o.y AS y0, t.x AS x1, t.y AS y1
FROM edges_all e JOIN first_pos o ON e.origin = o.node JOIN first_pos t ON e.destination = t.node""",
    extra={"first_pos": """
SELECT node, x, y FROM (
  SELECT node, x, y, row_number() OVER (PARTITION BY node ORDER BY CASE WHEN graph = 'CD→CD' THEN 0 ELSE 1 END, x, y) AS rn
  FROM layout) WHERE rn = 1"""}))


# =========================================================================== KPIs, checks, sources

KPI_CTES = {
    **MASTER_CTES,
    "m_st_raw": master_of("stores"),
    "m_st": zero_filled("m_st_raw"),
    "m_cd_raw": master_of("cds"),
    "m_cd": zero_filled("m_cd_raw"),
}


def kpi_sql(body: str, extra: dict[str, str] | None = None) -> str:
    return with_fixtures(body, *MASTER_FIX, extra={**KPI_CTES, **(extra or {})})


AGE_LIMIT = d(AS_OF - dt.timedelta(days=30))


def level(cover: str, target: str) -> str:
    ratio = f"CAST({cover} AS DOUBLE) / NULLIF(CAST({target} AS DOUBLE), 0)"
    return f"""CASE WHEN {ratio} IS NULL THEN 'unknown' WHEN {ratio} < 0.5 THEN 'critical' WHEN {ratio} < 1.0 THEN 'low'
            WHEN {ratio} <= 1.5 THEN 'ok' ELSE 'excess' END"""


HEALTH = f"""
SELECT branch, sku, {AS} AS date, current_stock_value AS stock_value, current_cover AS coverage_days,
       target_cover AS target_coverage_days,
       CAST(current_cover AS DOUBLE) / NULLIF(CAST(target_cover AS DOUBLE), 0) AS coverage_ratio,
       (last_sale IS NULL OR last_sale < {AGE_LIMIT}) AS aged,
       COALESCE(current_stock_qty, 0) <= 0 AS in_rupture,
       {level('current_cover', 'target_cover')} AS health_level
FROM m_st"""
PRODUCTS = """
SELECT sku, COUNT(DISTINCT branch) AS branches, MIN(CASE WHEN qty > 0 THEN date END) AS first_sale,
       MAX(CASE WHEN qty > 0 THEN date END) AS last_sale
FROM sales GROUP BY sku"""

q("k1_inventory_value", kpi_sql(
    f"SELECT branch, CAST(SUM({cents('current_stock_value')}) AS DOUBLE) AS inventory_value FROM m_st GROUP BY branch"))
q("k2_coverage_days", kpi_sql(f"""
SELECT branch, CAST(SUM(CASE WHEN current_cover IS NOT NULL THEN {cents('current_stock_value')} END * CAST(current_cover AS DECIMAL(20,6))) AS DOUBLE)
       / NULLIF(CAST(SUM(CASE WHEN current_cover IS NOT NULL THEN {cents('current_stock_value')} END) AS DOUBLE), 0) AS coverage_days
FROM m_st GROUP BY branch"""))
q("k3_aging_value", kpi_sql(f"""
SELECT branch, aged_value, stock_value, aged_value * 100.0 / NULLIF(stock_value, 0) AS aged_pct FROM (
  SELECT branch,
         CAST(SUM(CASE WHEN last_sale IS NULL OR last_sale < {AGE_LIMIT} THEN {cents('current_stock_value')} ELSE 0 END) AS DOUBLE) AS aged_value,
         CAST(SUM({cents('current_stock_value')}) AS DOUBLE) AS stock_value
  FROM m_st GROUP BY branch)"""))
q("k4_rupture_pct", kpi_sql(f"""
SELECT branch, rupture_revenue, revenue_last30d, rupture_revenue * 100.0 / NULLIF(revenue_last30d, 0) AS rupture_pct FROM (
  SELECT branch,
         CAST(SUM(CASE WHEN COALESCE(current_stock_qty, 0) <= 0 THEN {cents('revenue_last30d')} ELSE 0 END) AS DOUBLE) AS rupture_revenue,
         CAST(SUM({cents('revenue_last30d')}) AS DOUBLE) AS revenue_last30d
  FROM m_st GROUP BY branch)"""))
q("k5_stock_by_location", kpi_sql(f"""
SELECT sku, CAST(COALESCE(SUM(in_transit), 0) AS BIGINT) AS in_transit_qty,
       CAST(SUM(CASE WHEN stock_kind = 'LOJA' THEN {cents('current_stock_qty')} ELSE 0 END) AS DOUBLE) AS store_qty,
       CAST(SUM(CASE WHEN stock_kind = 'CD' THEN {cents('current_stock_qty')} ELSE 0 END) AS DOUBLE) AS cd_qty
FROM (SELECT sku, stock_kind, current_stock_qty, in_transit FROM m_st
      UNION ALL SELECT sku, stock_kind, current_stock_qty, in_transit FROM m_cd)
GROUP BY sku"""))
q("k6_stock_by_type", kpi_sql("""
SELECT branch, CAST(COALESCE(SUM(safety_stock), 0) AS BIGINT) AS safety_stock,
       CAST(COALESCE(SUM(target_stock - safety_stock), 0) AS BIGINT) AS cycle_stock
FROM m_st GROUP BY branch"""))
q("k7_inventory_health", kpi_sql(HEALTH))
q("k8_time_dimension", sales_sql("""
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, CAST(weekofyear(date) AS INTEGER) AS week,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(year(date) * 100 + month(date) AS INTEGER) AS year_month
FROM (SELECT DISTINCT date FROM sales)"""))
q("k8_product_dimension", sales_sql(PRODUCTS))
q("k8_branch_dimension", with_fixtures("SELECT DISTINCT branch, stock_place, store_status FROM stock", "stock"))
q("k9_abc_class", sales_sql("""
SELECT sku, revenue, CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) AS cumulative_share,
       CASE WHEN cum * 100 <= total * 80 THEN 'A' WHEN cum * 100 <= total * 95 THEN 'B' ELSE 'C' END AS abc_class
FROM (SELECT sku, revenue,
             SUM(CAST(revenue AS DECIMAL(28,2))) OVER (ORDER BY revenue DESC, sku ASC ROWS UNBOUNDED PRECEDING) AS cum,
             SUM(CAST(revenue AS DECIMAL(28,2))) OVER () AS total
      FROM (SELECT sku, CAST(SUM(CAST(revenue AS DECIMAL(28,2))) AS DOUBLE) AS revenue FROM sales GROUP BY sku))"""))
q("k10_turnover", kpi_sql(f"""
SELECT branch, CAST(SUM({cents('cmv_sales_value')}) AS DOUBLE) / NULLIF(CAST(SUM({cents('current_stock_value')}) AS DOUBLE), 0) AS turnover
FROM m_st GROUP BY branch"""))
q("k11_project_stock", kpi_sql("""
SELECT branch, sku, CAST(day AS INTEGER) AS day,
       GREATEST(0.0, current_stock_qty - day * qty_mm7d) AS projected_stock,
       current_stock_qty / NULLIF(qty_mm7d, 0) AS coverage_days
FROM (SELECT branch, sku, current_stock_qty, qty_mm7d, unnest(range(1, 8)) AS day FROM m_st)"""))
q("k12_rupture_alerts", kpi_sql("""
SELECT branch, sku, current_stock_qty AS stock, lead_time * qty_mm30d + safety_stock AS required_stock
FROM m_st WHERE current_stock_qty < lead_time * qty_mm30d + safety_stock"""))
q("k13_channel_trend", sales_sql("""
SELECT branch, year_month, CAST(off AS DOUBLE) AS revenue_off, CAST(on_ AS DOUBLE) AS revenue_on,
       CAST(on_ AS DOUBLE) / NULLIF(CAST(off + on_ AS DOUBLE), 0) AS online_share,
       CAST((off + on_) - LAG(off + on_) OVER w AS DOUBLE) / NULLIF(CAST(LAG(off + on_) OVER w AS DOUBLE), 0) AS revenue_change
FROM (SELECT branch, year_month, SUM(CAST(revenue_off AS DECIMAL(28,2))) AS off, SUM(CAST(revenue_on AS DECIMAL(28,2))) AS on_
      FROM sales GROUP BY branch, year_month)
WINDOW w AS (PARTITION BY branch ORDER BY year_month)"""))
PREV_CTES = {
    "st_prev": prepared("LOJA", "stock_prev", d(PREVIOUS)),
    "previous": f"""
SELECT s.branch, s.sku, CAST(s.stock_value AS DOUBLE) AS prev_stock_value, g.current_cover AS prev_coverage_days,
       {level('g.current_cover', 'g.target_cover')} AS prev_health_level
FROM st_prev s LEFT JOIN (SELECT DISTINCT branch, sku, stock_date, current_cover, target_cover FROM gef_prev) g
  ON s.branch = g.branch AND s.sku = g.sku AND s.date = g.stock_date""",
    "health": HEALTH,
    "health_prev": "SELECT h.*, p.* EXCLUDE (branch, sku) FROM health h LEFT JOIN previous p ON h.branch = p.branch AND h.sku = p.sku",
}


def prev_sql(body: str) -> str:
    return with_fixtures(body, *MASTER_FIX, "stock_prev", "gef_prev", extra={**KPI_CTES, **PREV_CTES})


def mean_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(20,6))) AS DOUBLE) / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0)"


q("k7_with_previous", prev_sql("SELECT * FROM health_prev"))
q("a12_company_kpis", prev_sql(f"""
SELECT metric_name, c AS current_value, p AS previous_value, (c - p) / NULLIF(p, 0) * 100 AS change_percentage FROM (
  SELECT 'Total Inventory' AS metric_name, CAST(SUM({cents('stock_value')}) AS DOUBLE) AS c, CAST(SUM({cents('prev_stock_value')}) AS DOUBLE) AS p
  FROM health_prev WHERE date = {AS}
  UNION ALL
  SELECT 'Coverage Days', {mean_sql('coverage_days')}, {mean_sql('prev_coverage_days')} FROM health_prev WHERE date = {AS})"""))
q("u2_stack_kpis", kpi_sql(f"""
SELECT 'LOJA' AS stock_kind, branch, CAST(SUM({cents('current_stock_value')}) AS DOUBLE) AS inventory_value FROM m_st GROUP BY branch
UNION ALL
SELECT 'CD', branch, CAST(SUM({cents('current_stock_value')}) AS DOUBLE) FROM m_cd GROUP BY branch"""))


def rollup_sql(grain: str, *by: str) -> str:
    period = f"CAST(date_trunc('{grain}', date) AS DATE)"
    return with_fixtures(f"""
SELECT {period} AS period, {', '.join(by)},
       CAST(SUM({cents('revenue')}) AS DOUBLE) AS revenue, CAST(SUM({cents('qty')}) AS DOUBLE) AS qty, CAST(SUM(sold) AS BIGINT) AS sale_days
FROM sales LEFT JOIN products_dim USING (sku) LEFT JOIN branches_dim USING (branch)
GROUP BY ROLLUP ({period}, {', '.join(by)}) HAVING {period} IS NOT NULL""", *SALES_FIX, "products_dim", "branches_dim", extra=DENSE_CTES)


q("a13_kpi_rollup_category_week", rollup_sql("week", "category"))
q("a13_kpi_rollup_region_quarter", rollup_sql("quarter", "region", "state"))
q("a13_kpi_rollup_region_category_day", rollup_sql("day", "region", "category"))
STORE_DIM = """
SELECT s.branch, s.store_status, b.state, b.region
FROM (SELECT DISTINCT branch, store_status FROM stock WHERE stock_place = 'L') s LEFT JOIN branches_dim b ON s.branch = b.branch"""
CD_DIM = """
SELECT s.branch, b.state, b.region
FROM (SELECT DISTINCT branch FROM stock WHERE stock_place = 'D') s LEFT JOIN branches_dim b ON s.branch = b.branch"""
q("k8_store_dimension", with_fixtures(STORE_DIM, "stock", "branches_dim"))
q("k8_cd_dimension", with_fixtures(CD_DIM, "stock", "branches_dim"))
q("k8_category_dimension", with_fixtures("SELECT category, COUNT(*) AS skus FROM products_dim GROUP BY category", "products_dim"))
q("k8_region_dimension", with_fixtures(
    "SELECT region, COUNT(DISTINCT state) AS states, CAST(COUNT(*) AS BIGINT) AS branches FROM branches_dim GROUP BY region", "branches_dim"))
q("k8_sales_fact", sales_sql(
    "SELECT date, branch, sku, revenue_off, qty_off, revenue_on, qty_on, revenue, qty FROM sales WHERE sold > 0"))
FACT = """SELECT date, branch, sku, stock_kind, current_stock_qty, current_stock_value, CAST(in_transit AS BIGINT) AS in_transit,
       CAST(safety_stock AS BIGINT) AS safety_stock, CAST(target_stock AS BIGINT) AS target_stock, current_dde FROM """
q("k8_inventory_fact", kpi_sql(FACT + "m_st UNION ALL " + FACT + "m_cd"))
q("a13_kpi_rollup", sales_sql(f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS period, branch,
       CAST(SUM({cents('revenue')}) AS DOUBLE) AS revenue, CAST(SUM({cents('qty')}) AS DOUBLE) AS qty,
       CAST(SUM(sold) AS BIGINT) AS sale_days
FROM sales GROUP BY ROLLUP (CAST(date_trunc('month', date) AS DATE), branch)
HAVING CAST(date_trunc('month', date) AS DATE) IS NOT NULL"""))
q("j10_allocation_view", with_fixtures(f"""
SELECT s.region, s.state, c.cd AS distribution_center, cd.state AS cd_state, h.branch AS store, p.category, h.sku,
       h.stock_value AS current_stock_value, h.coverage_days,
       CASE WHEN h.aged THEN h.stock_value ELSE 0.0 END AS aging_value,
       (CASE WHEN COALESCE(m.current_stock_qty, 0) <= 0 THEN m.revenue_last30d ELSE 0.0 END) * 100.0 / NULLIF(m.revenue_last30d, 0) AS rupture_percentage,
       h.health_level,
       GREATEST(0.0, m.current_stock_qty - 7 * m.qty_mm7d) * (h.stock_value / NULLIF(m.current_stock_qty, 0)) AS forecast_stock_value,
       GREATEST(0.0, m.current_stock_qty - 7 * m.qty_mm7d) / NULLIF(m.qty_mm7d, 0) AS forecast_coverage_days
FROM health h JOIN m_st m ON h.branch = m.branch AND h.sku = m.sku
JOIN store_dim s ON h.branch = s.branch
LEFT JOIN (SELECT CAST(store AS INTEGER) AS branch, CAST(delivering_cd AS INTEGER) AS cd FROM (
             SELECT store, delivering_cd, row_number() OVER (PARTITION BY store ORDER BY COUNT(*) DESC, delivering_cd) AS rn
             FROM supply_plan_stock GROUP BY store, delivering_cd) WHERE rn = 1) c ON h.branch = c.branch
LEFT JOIN cd_dim cd ON c.cd = cd.branch
JOIN products_dim p ON h.sku = p.sku
WHERE h.date = {AS}""", *MASTER_FIX, "products_dim", "branches_dim", extra={**KPI_CTES, "health": HEALTH, "store_dim": STORE_DIM, "cd_dim": CD_DIM}))
q("v6_check_ref", stock_sql("""
SELECT branch, sku, COUNT(*) AS orphan_rows FROM gef_feed g
WHERE NOT EXISTS (SELECT 1 FROM stock s WHERE s.branch = g.branch AND s.sku = g.sku)
GROUP BY branch, sku"""))
q("v7_check_range", with_fixtures("""
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE stock_value < 0) AS below_min,
       COUNT(*) FILTER (WHERE stock_value > 100000) AS above_max, COUNT(*) FILTER (WHERE stock_value IS NULL) AS null_rows
FROM stock""", "stock"))
q("v8_check_outliers", sales_sql("""
SELECT s.date, s.branch, s.sku, s.revenue, b.lower_fence, b.upper_fence
FROM days s JOIN bounds b ON s.branch = b.branch
WHERE s.revenue < b.lower_fence OR s.revenue > b.upper_fence""", extra={
    "days": "SELECT date, branch, sku, revenue FROM sales WHERE qty > 0",
    "q": "SELECT branch, quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.75) AS q3 FROM days GROUP BY branch",
    "bounds": "SELECT branch, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q"}))
q("v9_check_dates", with_fixtures("""
SELECT branch, sku, channel, CAST(prev + 1 AS DATE) AS gap_start, CAST(date - 1 AS DATE) AS gap_end,
       CAST(date - prev - 1 AS INTEGER) AS missing_days
FROM (SELECT branch, sku, channel, date, LAG(date) OVER (PARTITION BY branch, sku, channel ORDER BY date) AS prev
      FROM (SELECT DISTINCT branch, sku, channel, date FROM lines))
WHERE date - prev > 1""", *SALES_FIX, extra=LINES_CTES))
q("v5_run_summary", sales_sql(f"""
SELECT COUNT(*) AS rows, COUNT(DISTINCT branch) AS distinct_branches, COUNT(DISTINCT sku) AS distinct_skus,
       COUNT(DISTINCT date) AS distinct_days, MIN(date) AS first_day, MAX(date) AS last_day,
       {d(START)} AS window_start, {AS} AS window_end
FROM sales"""))
q("s1_load", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
q("s2_load_sql", "SELECT * FROM region")

q("p6_rename_drop", with_fixtures("""
SELECT stock_date, sku, branch, stock_place, store_status, CAST(stock_qty AS DOUBLE) AS current_stock_qty,
       CAST(stock_value AS DOUBLE) AS current_stock_value, CAST(cmv_sales_value AS DOUBLE) AS cmv_sales_value
FROM stock""", "stock"))
q("d2_sale_flag", with_fixtures("""
SELECT date, branch, sku, channel, CAST(CASE WHEN SUM(quantity) > 0 THEN 1 ELSE 0 END AS INTEGER) AS sold
FROM lines GROUP BY date, branch, sku, channel""", *SALES_FIX, extra=LINES_CTES))

q("p10_dev_sample", with_fixtures(f"""
SELECT fact_key, approval_date, sku, CAST(sale_value AS DOUBLE) AS sale_value FROM rated_sales
WHERE goods_state <> '1 - SALDO' AND business_type IS NOT NULL AND approval_date BETWEEN {W} AND sale_value >= 0 AND cost_value >= 0
  AND CAST('0x' || substr(md5(fact_key), 1, 8) AS BIGINT) % 10 = 0""", "rated_sales"))
q("d4_with_lineage", sales_sql("""
SELECT *, '2001-06-30 12:00:00' AS processed_at, DATE '2001-06-30' AS processed_date,
       'rated sales + quantity sales' AS data_source, '1.0' AS process_version FROM sales"""))
q("s3_run_frame", with_fixtures(f"""
SELECT DISTINCT approval_date, {d(START)} AS start_date, CAST({START:%Y%m%d} AS INTEGER) AS start_date_int,
       CAST(90 AS INTEGER) AS lookback_days, {AS} AS as_of, 'RUN' AS mode
FROM rated_sales WHERE approval_date BETWEEN {W}""", "rated_sales"))
q("s4_save_table", ORACLE["a1_daily_sales"])
q("s7_describe_table", """
SELECT CAST(row_number() OVER (ORDER BY column_index) - 1 AS INTEGER) AS position, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS data_type,
       true AS nullable, (SELECT COUNT(*) FROM nation) AS row_count
FROM duckdb_columns() WHERE table_name = 'nation'""")
q("s8_ingest_append", """
SELECT n_name, s AS source_system, CAST(2001 AS INTEGER) AS year, CAST(6 AS INTEGER) AS month, CAST(30 AS INTEGER) AS day, COUNT(*) AS rows
FROM nation, (VALUES ('nations'), ('again')) AS t(s) GROUP BY n_name, s""")
q("s5_read_network_report", net_sql("""
SELECT CAST(origin AS VARCHAR) AS origem, CAST(destination AS VARCHAR) AS destino, edge_type AS tipo,
       origin_type AS origem_tipo, destination_type AS destino_tipo FROM edges_all"""))


def joined(sub: str, key: str, value: str) -> str:
    pair = f"CAST({key} AS VARCHAR) || '=' || CAST({value} AS VARCHAR)"
    return f"(SELECT string_agg({pair}, ',' ORDER BY {pair}) FROM ({sub}))"


def scc_sql(group: str, comps: str, in_cycles: str) -> str:
    per = f"(SELECT DISTINCT scc_id, scc_size FROM {comps})"
    return f"""(SELECT COUNT(*) FROM {per}) AS {group}_total_sccs,
       (SELECT COUNT(*) FROM {per} WHERE scc_size > 1) AS {group}_sccs_com_ciclos,
       (SELECT COUNT(*) FROM {per} WHERE scc_size = 1) AS {group}_sccs_isoladas,
       (SELECT CAST(COALESCE(SUM(scc_size), 0) AS BIGINT) FROM {per} WHERE scc_size > 1) AS {group}_{in_cycles},
       (SELECT CAST(COALESCE(MAX(scc_size), 0) AS BIGINT) FROM {per} WHERE scc_size > 1) AS {group}_maior_ciclo"""


def levels_sql(group: str, levels: str, sources: str, name: str) -> str:
    return f"""{sources} AS {group}_{name},
       (SELECT CAST(COALESCE(MAX(level), 0) AS BIGINT) FROM {levels}) AS {group}_profundidade_maxima,
       (SELECT COUNT(DISTINCT level) FROM {levels}) AS {group}_niveis_unicos,
       {joined(f"SELECT level, COUNT(*) AS n FROM {levels} GROUP BY level", "level", "n")} AS {group}_distribuicao_niveis"""


q("g14_network_report", net_sql(f"""
SELECT 'CD→CD + CD→Loja' AS metadata_tipo_analise, '2001-06-30 12:00:00' AS metadata_data_processamento,
       'supply plan' AS metadata_tabela_origem, (SELECT COUNT(*) FROM supply_plan) AS metadata_total_registros_processados,
       (SELECT COUNT(*) FROM nodes_all) AS estatisticas_gerais_total_nos,
       (SELECT COUNT(*) FROM edges_all) AS estatisticas_gerais_total_conexoes,
       (SELECT COUNT(*) FROM nodes_all WHERE node_type = 'CD') AS estatisticas_gerais_cds_unicos,
       (SELECT COUNT(*) FROM nodes_all WHERE node_type = 'Loja') AS estatisticas_gerais_lojas_unicas,
       (SELECT COUNT(*) FROM nodes_all WHERE in_cycle) AS estatisticas_gerais_nos_em_ciclos,
       (SELECT COUNT(DISTINCT src) FROM cd_e) AS analise_cd_cd_cds_unicos_atendem,
       (SELECT COUNT(DISTINCT dst) FROM cd_e) AS analise_cd_cd_cds_unicos_atendidos,
       (SELECT COUNT(*) FROM cd_e) AS analise_cd_cd_total_conexoes,
       {joined(top_sql("src", "cd_e"), "node", "edges")} AS analise_cd_cd_top_cds_por_grau_saida,
       {joined(top_sql("dst", "cd_e"), "node", "edges")} AS analise_cd_cd_top_cds_por_grau_entrada,
       {scc_sql("complexidade_cd_cd", "cd_scc", "cds_em_ciclos")},
       {levels_sql("hierarquia_cd_cd", "cd_lvl", "(SELECT COUNT(*) FROM cd_src)", "cds_fonte")},
       (SELECT COUNT(DISTINCT src) FROM st_e) AS analise_cd_loja_cds_unicos_entregam,
       (SELECT COUNT(DISTINCT dst) FROM st_e) AS analise_cd_loja_lojas_unicas_atendidas,
       (SELECT COUNT(*) FROM st_e) AS analise_cd_loja_total_conexoes,
       {joined(top_sql("src", "st_e"), "node", "edges")} AS analise_cd_loja_top_cds_por_lojas_atendidas,
       {scc_sql("complexidade_cd_loja", "st_scc", "filiais_em_ciclos")},
       {levels_sql("hierarquia_cd_loja", "st_lvl", "(SELECT COUNT(*) FROM st_deg WHERE out_degree > 0)", "cds_no_grafo")}"""))


# =========================================================================== series, totals, published tables

HISTORY_START = dt.date(1996, 1, 1)
MONTH_CTES = {k: v.replace(W, f"{d(HISTORY_START)} AND {d(AS_OF)}") for k, v in LINES_CTES.items()} | {
    "month_sales": "SELECT branch, channel, CAST(date_trunc('month', date) AS DATE) AS month, SUM(sale_value) AS value FROM lines GROUP BY ALL",
    "month_keys": "SELECT branch, channel, MIN(month) AS first FROM month_sales GROUP BY ALL",
    "month_grid": f"""
SELECT branch, channel, first, CAST(unnest(generate_series(first, {d(AS_OF.replace(day=1))}, INTERVAL 1 MONTH)) AS DATE) AS month FROM month_keys""",
    "months": """
SELECT g.branch, g.channel, g.month, CAST(date_diff('month', g.first, g.month) AS HUGEINT) AS x, CAST(COALESCE(m.value, 0) * 100 AS HUGEINT) AS y
FROM month_grid g LEFT JOIN month_sales m ON g.branch = m.branch AND g.channel = m.channel AND g.month = m.month""",
    "years_": """
SELECT branch, channel, year(month) AS y, SUM(y) AS total FROM months GROUP BY ALL HAVING COUNT(*) = 12 AND SUM(months.y) > 0""",
    "season": """
SELECT m.branch, m.channel, CAST(month(m.month) AS INTEGER) AS calendar_month, COUNT(t.total) AS years,
       CASE WHEN COUNT(t.total) >= 2 THEN CAST(SUM(m.y * 12000000 // t.total) AS DOUBLE) / (CAST(COUNT(t.total) AS DOUBLE) * 1000000.0) END AS season_index
FROM months m LEFT JOIN years_ t ON m.branch = t.branch AND m.channel = t.channel AND year(m.month) = t.y
GROUP BY m.branch, m.channel, month(m.month)""",
}


def month_sql(body: str) -> str:
    return with_fixtures(body, *SALES_FIX, extra=MONTH_CTES)


q("k13_sales_trend", month_sql("""
SELECT branch, channel, n AS months, first_month, last_month, CAST(sy AS DOUBLE) / 100.0 AS revenue, trend,
       trend / NULLIF(CAST(sy AS DOUBLE) / (CAST(n AS DOUBLE) * 100.0), 0) AS trend_share
FROM (SELECT *, CASE WHEN n >= 6 THEN CAST(n * sxy - sx * sy AS DOUBLE) / NULLIF(CAST(n * sxx - sx * sx AS DOUBLE) * 100.0, 0) END AS trend
      FROM (SELECT branch, channel, COUNT(*) AS n, MIN(month) AS first_month, MAX(month) AS last_month,
                   SUM(x) AS sx, SUM(y) AS sy, SUM(x * x) AS sxx, SUM(x * y) AS sxy FROM months GROUP BY branch, channel))"""))
q("k13_season_index", month_sql("SELECT * FROM season"))
q("k13_season_adjusted", month_sql("""
SELECT branch, channel, month, CAST(y AS DOUBLE) / 100.0 AS revenue, CAST(before AS DOUBLE) / 100.0 AS revenue_year_before,
       CAST(y - before AS DOUBLE) / NULLIF(CAST(before AS DOUBLE), 0) AS change_on_year, season_index,
       (CAST(y AS DOUBLE) / 100.0) / NULLIF(season_index, 0) AS adjusted_revenue
FROM (SELECT m.*, LAG(m.y, 12) OVER (PARTITION BY m.branch, m.channel ORDER BY m.month) AS before FROM months m) m
JOIN season s USING (branch, channel) WHERE s.calendar_month = month(m.month)"""))


def cube_sql(grain: str, by: tuple[str, ...], sets: list[tuple[str, ...]]) -> str:
    period = f"CAST(date_trunc('{grain}', date) AS DATE)"
    groups = ", ".join("(" + ", ".join(["period", *x]) + ")" for x in sets)
    named = ", ".join(f"CASE WHEN GROUPING({c}) = 0 THEN '{c}' END" for c in by)
    return with_fixtures(f"""
SELECT period, {', '.join(by)}, GROUPING({', '.join(by)}) AS grouping_id,
       CASE WHEN concat_ws(',', {named}) = '' THEN 'all' ELSE concat_ws(',', {named}) END AS level,
       CAST(SUM({cents('revenue')}) AS DOUBLE) AS revenue, CAST(SUM({cents('qty')}) AS DOUBLE) AS qty, CAST(SUM(sold) AS BIGINT) AS sale_days
FROM (SELECT {period} AS period, region, state, NULLIF(category, '{CATEGORIES[0]}') AS category, revenue, qty, sold
      FROM sales LEFT JOIN products_dim USING (sku) LEFT JOIN branches_dim USING (branch))
GROUP BY GROUPING SETS ({groups})""", *SALES_FIX, "products_dim", "branches_dim", extra=DENSE_CTES)


q("a13_kpi_cube", cube_sql("month", ("region", "category"), [("region", "category"), ("region",), ("category",), ()]))
q("a13_kpi_grouping_sets", cube_sql("quarter", ("region", "state", "category"), [("region", "state", "category"), ("region",), ()]))

SNAPSHOTS = [AS_OF - dt.timedelta(days=15 * k) for k in range(3, -1, -1)]
SNAPSHOT_CTES: dict[str, str] = {}
for _k, _day in enumerate(SNAPSHOTS):
    SNAPSHOT_CTES |= {
        f"stock_{_k}": stock(_day), f"gef_{_k}": gef(_day), f"prepared_{_k}": prepared("LOJA", f"stock_{_k}", d(_day)),
        f"snapshot_{_k}": f"""
SELECT {d(_day)} AS date, s.branch, s.sku, CAST(s.stock_value AS DOUBLE) AS stock_value, g.current_cover AS coverage_days,
       {level('g.current_cover', 'g.target_cover')} AS health_level
FROM prepared_{_k} s LEFT JOIN (SELECT DISTINCT branch, sku, stock_date, current_cover, target_cover FROM gef_{_k}) g
  ON s.branch = g.branch AND s.sku = g.sku AND s.date = g.stock_date""",
    }
SNAPSHOT_CTES["snapshots"] = " UNION ALL ".join(f"SELECT * FROM snapshot_{k}" for k in range(len(SNAPSHOTS)))

q("k7_health_series", with_fixtures(f"""
SELECT date, branch, sku, stock_value, coverage_days, health_level, LAG(date) OVER k AS prev_date,
       CAST(date - LAG(date) OVER k AS INTEGER) AS days_since_prev, LAG(stock_value) OVER k AS prev_stock_value,
       LAG(coverage_days) OVER k AS prev_coverage_days, LAG(health_level) OVER k AS prev_health_level,
       (stock_value - LAG(stock_value) OVER k) / NULLIF(LAG(stock_value) OVER k, 0) AS value_change,
       CAST(SUM({cents('stock_value')}) OVER m AS DOUBLE) / CAST(COUNT(stock_value) OVER m AS DOUBLE) AS mean_stock_value,
       COUNT(*) OVER m AS snapshots_in_window, COUNT(*) FILTER (health_level = 'critical') OVER m AS critical_days
FROM snapshots
WINDOW k AS (PARTITION BY branch, sku ORDER BY date),
       m AS (PARTITION BY branch, sku ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""", extra=SNAPSHOT_CTES))
q("k7_health_totals", with_fixtures(f"""
SELECT *, LAG(date) OVER (ORDER BY date) AS prev_date, LAG(stock_value) OVER (ORDER BY date) AS prev_stock_value,
       (stock_value - LAG(stock_value) OVER (ORDER BY date)) / NULLIF(LAG(stock_value) OVER (ORDER BY date), 0) AS value_change
FROM (SELECT date, CAST(SUM({cents('stock_value')}) AS DOUBLE) AS stock_value, {mean_sql('coverage_days')} AS coverage_days,
             {', '.join(f"COUNT(*) FILTER (health_level = '{x}') AS {x}_keys" for x in ('critical', 'low', 'ok', 'excess', 'unknown'))}
      FROM snapshots GROUP BY date)""", extra=SNAPSHOT_CTES))

q("s4_publish_table", ORACLE["a1_daily_sales"])
q("s8_ingest_batch", """
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'building' ELSE 'others' END AS batch, c_mktsegment, 'customers' AS source_system,
       2001 AS year, 6 AS month, 30 AS day, COUNT(*) AS rows FROM customer GROUP BY c_mktsegment""")
q("s8_stream_ingest", "SELECT c_mktsegment, 'customers' AS source_system, COUNT(*) AS rows FROM customer GROUP BY c_mktsegment")
q("v5_observed_run", sales_sql(f"""
SELECT COUNT(*) AS rows, COUNT(DISTINCT (branch, sku)) AS keys, CAST(SUM(sold) AS BIGINT) AS sale_days, COUNT(DISTINCT branch) AS distinct_branches,
       COUNT(DISTINCT date) AS distinct_days, CAST(SUM({cents('revenue')}) AS DOUBLE) AS revenue, CAST(SUM({cents('qty')}) AS DOUBLE) AS qty,
       MIN(date) AS first_day, MAX(date) AS last_day, {d(START)} AS window_start, {d(AS_OF)} AS window_end FROM sales"""))
q("v3_observed_join", ORACLE["v3_audit_join"])

q("s1_source_layout", with_fixtures(f"""
SELECT fact_key, approval_date, sku, selling_branch, issuing_branch, CAST(sale_value AS DOUBLE) AS sale_value, CAST(cost_value AS DOUBLE) AS cost_value
FROM rated_sales WHERE approval_date BETWEEN {W}""", "rated_sales"))
q("p11_require_columns", """
SELECT * FROM (VALUES ('c_custkey', true, 'bigint'), ('c_name', true, 'string'), ('c_segment', false, NULL)) t(column_name, present, data_type)
WHERE (SELECT COUNT(*) FROM customer) >= 0""")
q("v1_require_rows", with_fixtures(f"""
SELECT 'sales of the window' AS input, EXISTS (SELECT 1 FROM rated_sales WHERE approval_date BETWEEN {W}) AS has_rows
UNION ALL SELECT 'stock rows', EXISTS (SELECT 1 FROM stock)
UNION ALL SELECT 'sales of another century', EXISTS (SELECT 1 FROM rated_sales WHERE approval_date < DATE '1900-01-01')""", "rated_sales", "stock"))
_BUCKET = "CAST('0x' || substr(md5(fact_key), 1, 8) AS BIGINT) % 10 = 0"
q("v4_run_params", with_fixtures(f"""
SELECT 'RUN' AS mode, {d(START)} AS start_date, {d(AS_OF)} AS as_of, 90 AS lookback_days, 'supply_dev_vendas' AS table_name, COUNT(*) AS lines
FROM rated_sales WHERE approval_date BETWEEN {W}
UNION ALL
SELECT 'TEST', {d(AS_OF - dt.timedelta(days=1))}, {d(AS_OF)}, 1, 'supply_dev_vendas', COUNT(*)
FROM rated_sales WHERE approval_date BETWEEN {d(AS_OF - dt.timedelta(days=1))} AND {d(AS_OF)} AND {_BUCKET}""", "rated_sales"))
q("s5_report_document", net_sql("""
SELECT CAST(e.origin AS VARCHAR) AS origem, CAST(e.destination AS VARCHAR) AS destino, e.edge_type AS tipo,
       n.out_degree AS grau_saida, n.level AS nivel_hierarquico, n.in_cycle AS em_ciclo, n.scc_size
FROM edges_all e JOIN nodes_cd n ON e.origin = n.node WHERE e.edge_type = 'CD→CD'"""))
q("views_allocation_dashboard", f"SELECT * EXCLUDE (cd_state) FROM ({ORACLE['j10_allocation_view']})")
q("views_company_kpis", ORACLE["a12_company_kpis"])
q("job_catalog_run", with_fixtures("""
SELECT 'supply_dev_vendas_90d_on_off' AS table_name, COUNT(*) AS rows FROM sales
UNION ALL SELECT 'supply_dev_estoque_lojas', COUNT(*) FROM stores
UNION ALL SELECT 'supply_dev_estoque_cds', COUNT(*) FROM cds
UNION ALL SELECT 'supply_dev_master_vendas_estoque_lojas', COUNT(*) FROM m_st
UNION ALL SELECT 'supply_dev_master_vendas_estoque_cds', COUNT(*) FROM m_cd""", *MASTER_FIX, extra=KPI_CTES))
