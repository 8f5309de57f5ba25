"""stocklens: retail supply-chain analytics on Spark DataFrames.

Layout
------
params      run parameters (as-of date, look-back, channel rules)
session     SparkSession helpers (checkpoint folder, local test session)
sources/    input contracts, loaders, fixture adapters, report reader/writer, sinks
functions/  column-level helpers (dates, safe division, flags, lineage, names)
operators/  pure DataFrame -> DataFrame operators (sales, stock, master, graph, quality, kpis)
plans/      pipelines that compose operators into the published outputs
streaming/  incremental ingest with Structured Streaming (append-only landing)
"""

from stocklens.params import RunParams

__all__ = ["RunParams"]
__version__ = "0.1.0"
