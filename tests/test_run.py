import datetime as dt

from stocklens.params import RunParams
from stocklens.plans.fixtures import Inputs
from stocklens.plans.run import Sources, run_all
from stocklens.sources import report as R

from conftest import SF_SMALL


def test_run_all_writes_every_output(spark, scratch):
    params = RunParams(as_of=dt.date(2001, 6, 30), lookback_days=90)
    i = Inputs(spark, SF_SMALL, params)
    src = Sources(i.rated_sales, i.quantity_sales, i.stock, i.gef, i.supply_plan_stock, i.supply_plan)
    counts = run_all(spark, src, params, scratch)
    sales = spark.read.parquet(f"{scratch}/sales")
    assert counts["sales"] == sales.count() > 0
    assert {"processed_at", "data_source", "process_version"} <= set(sales.columns)
    assert counts["master_stores"] == spark.read.parquet(f"{scratch}/master_stores").count()
    assert counts["master_stores"] == spark.read.parquet(f"{scratch}/stock_stores").count()
    rep, edges, nodes = R.read_written_report(spark, f"{scratch}/network")
    row = rep.first()
    assert row.metadata.total_registros_processados == i.supply_plan.count()
    assert row.estatisticas_gerais.total_conexoes == edges.count()
    assert row.estatisticas_gerais.total_nos == nodes.count()
