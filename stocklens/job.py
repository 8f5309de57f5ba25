"""Job entry: from catalog tables in the source system's layout to published catalog tables.

    python -m stocklens.job --mode RUN --as-of 2025-10-24 --env PROD --root hdfs:///warehouse/supply \\
        --rated-sales db.value_lines --quantity-sales db.quantity_lines --stock db.stock --gef db.gef --supply-plan db.plan

Mode and environment are those of the reference's notebooks (V4): TEST takes a sample and one
day, RUN everything and 90 days; the environment is part of the output names. A step that
finds no input stops the run before it publishes anything (V1); tables published before stay.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import SparkSession

from stocklens.operators.quality import dev_sample
from stocklens.params import RunParams
from stocklens.plans import run
from stocklens.session import ensure_checkpoint_dir
from stocklens.sources import original


def run_job(spark: SparkSession, params: RunParams, tables: dict[str, str], root: str, network: bool = True) -> dict[str, int]:
    """Bronze, master and network outputs of the catalog tables ``tables`` (a name for each of
    ``original.INPUTS``), published under ``params.table`` names with their files below
    ``root``. In TEST mode the sales lines are sampled by whole keys (P10). Returns what the
    writes have counted."""
    ensure_checkpoint_dir(spark)
    src = original.from_catalog(spark, params, tables)
    if params.sampled:
        src = replace(src, rated_sales=dev_sample(src.rated_sales, ("fact_key",), params), quantity_sales=dev_sample(src.quantity_sales, ("fact_key",), params))
    counts = run.run_bronze(src, params, root, catalog=True)
    counts.update(run.run_master(spark, params, root, catalog=True))
    if network:
        run.run_network(src.supply_plan, f"{root.rstrip('/')}/{params.table('network')}")
    return counts


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Sales, stock, master tables and network of one day.")
    parser.add_argument("--mode", choices=("RUN", "TEST"), default="RUN")
    parser.add_argument("--env", choices=("DEV", "PROD"), default="DEV")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="processing day, today by default")
    parser.add_argument("--month-mode", choices=("first_day", "full_month"), default="first_day")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--root", required=True, help="folder of the tables' files, on storage that all executors share")
    parser.add_argument("--no-network", action="store_true")
    for name in original.INPUTS:
        parser.add_argument(f"--{name.replace('_', '-')}", required=True, help="catalog table in the source layout")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    params = RunParams.for_mode(args.mode, args.as_of or dt.date.today(), env=args.env, month_mode=args.month_mode, table_format=args.format)
    spark = SparkSession.builder.appName(f"stocklens-{args.env.lower()}").getOrCreate()
    counts = run_job(spark, params, {name: getattr(args, name) for name in original.INPUTS}, args.root, not args.no_network)
    print(json.dumps(counts, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
