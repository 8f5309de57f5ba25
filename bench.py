"""

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each pipeline runs warm (one untimed warm-up), three timed repetitions, median reported.
Every output is fully computed by one action into Spark's ``noop`` sink (no write cost);
the master step reads the bronze tables from parquet written once, untimed, into a fresh
scratch folder, as the silver layer reads bronze tables. SKU = part key, 90 days to
2001-06-30. Prints ONE JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stocklens.params import RunParams  # noqa: E402
from stocklens.plans import master as master_plan  # noqa: E402
from stocklens.plans import network as network_plan  # noqa: E402
from stocklens.plans import sales as sales_plan  # noqa: E402
from stocklens.plans import stock as stock_plan  # noqa: E402
from stocklens.plans.fixtures import Inputs  # noqa: E402
from stocklens.session import local_session  # noqa: E402
from stocklens.sources import loaders  # noqa: E402

AS_OF = dt.date(2001, 6, 30)
REPS = int(os.environ.get("BENCH_REPS", "3"))


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    fn()  # warm-up
    runs = []
    for _ in range(REPS):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="stocklens-bench")
    spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    params = RunParams(as_of=AS_OF, lookback_days=90)
    src = Inputs(spark, sf_dir, params, sku="part")

    def sales():
        noop(sales_plan.dense_sales(src.rated_sales, src.quantity_sales, params))

    def stock():
        noop(stock_plan.store_stock(src.stock, src.gef, params))
        noop(stock_plan.cd_stock(src.stock, src.gef, src.supply_plan_stock, params))

    # Bronze tables for the silver step, written once (untimed).
    loaders.save_table(sales_plan.dense_sales(src.rated_sales, src.quantity_sales, params), "sales", path=f"{scratch}/sales")
    loaders.save_table(stock_plan.store_stock(src.stock, src.gef, params), "stores", path=f"{scratch}/stores")
    loaders.save_table(stock_plan.cd_stock(src.stock, src.gef, src.supply_plan_stock, params), "cds", path=f"{scratch}/cds")

    def master():
        s = spark.read.parquet(f"{scratch}/sales")
        summary = master_plan.summary(s, params).persist()  # feeds both master tables
        m_st, m_cd = master_plan.master_tables(
            s, spark.read.parquet(f"{scratch}/stores"), spark.read.parquet(f"{scratch}/cds"), params, summary_df=summary
        )
        noop(m_st)
        noop(m_cd)
        summary.unpersist()

    last = {}

    def network():
        net = network_plan.build_network(src.supply_plan)
        noop(network_plan.network_report(net))
        noop(net.nodes)
        noop(net.edges)
        last["net"] = net

    queries = {
        "dense_daily_sales": timed(sales),
        "enriched_stock": timed(stock),
        "master_tables": timed(master),
        "network_metrics": timed(network),
    }
    summary = master_plan.summary(spark.read.parquet(f"{scratch}/sales"), params)
    m_st, m_cd = master_plan.master_tables(
        None, spark.read.parquet(f"{scratch}/stores"), spark.read.parquet(f"{scratch}/cds"), params, summary_df=summary
    )
    rows = {
        "sales_rows": spark.read.parquet(f"{scratch}/sales").count(),
        "stock_store_rows": spark.read.parquet(f"{scratch}/stores").count(),
        "stock_cd_rows": spark.read.parquet(f"{scratch}/cds").count(),
        "master_store_rows": m_st.count(),
        "master_cd_rows": m_cd.count(),
        "network_nodes": last["net"].nodes.count(),
        "network_edges": last["net"].edges.count(),
        "window_lines": src.rated_sales.where(
            (src.rated_sales.approval_date >= params.start) & (src.rated_sales.approval_date <= params.as_of)
        ).count(),
    }
    out = {
        "metric": "pipeline_seconds_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "reps": REPS,
        "rows": rows,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
