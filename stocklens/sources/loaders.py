"""Sources and sinks (S1-S4, S7, S8): catalog / path scans with contracts, SQL scans,
the run-parameter frame, table writes."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.dates import timestamp_of
from stocklens.params import RunParams
from stocklens.sources.contracts import conform


def load(
    spark: SparkSession,
    name: str,
    root: str | None = None,
    contract: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A catalog table by name, or ``<root>/<name>.<fmt>`` when ``root`` is given;
    checked (and cast) against ``contract`` if one is given. Lazy: the scan keeps its
    column pruning and filter pushdown."""
    if root is None:
        df = spark.table(name)
    else:
        df = spark.read.format(fmt).load(f"{root}/{name}.{fmt}" if fmt == "parquet" else f"{root}/{name}")
    return conform(df, contract) if contract is not None else df


def load_sql(spark: SparkSession, text: str) -> DataFrame:
    """A SQL scan (e.g. ``SELECT * FROM catalog.schema.table``)."""
    return spark.sql(text)


def run_frame(spark: SparkSession, params: RunParams) -> DataFrame:
    """S3: the run parameters as a one-row frame (start date, its int key, window days)."""
    start = params.start
    return spark.range(1).select(
        F.lit(start).alias("start_date"),
        F.lit(int(start.strftime("%Y%m%d"))).alias("start_date_int"),
        F.lit(params.lookback_days).alias("lookback_days"),
        F.lit(params.as_of).alias("as_of"),
        F.lit(params.mode).alias("mode"),
    )


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite a table (schema replaced too). ``path`` writes files instead of a
    catalog table. Errors propagate to the caller (the reference logs and re-raises)."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer.save(path)
    else:
        writer.saveAsTable(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...], fmt: str = "parquet") -> None:
    """S4 for a table in partitions: replaces the partitions that ``df`` has rows of and leaves
    the others. Files are staged and moved at commit, so a failed run changes nothing."""
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)


def publish_table(df: DataFrame, name: str, root: str, fmt: str = "parquet") -> str:
    """S4 as a catalog table that readers see whole, old or new, at any time.

    Rows go to a new folder below ``root``; only when they are all written does the catalog
    table ``name`` point there. A run that dies before leaves the table as it was, with its
    rows, and an orphan folder. Where the schema is another one the table is registered anew
    (as ``overwriteSchema`` does). Folders of earlier versions stay for readers that have
    begun, to be removed by age. Returns the new folder."""
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{name.rpartition('.')[2]}/{uuid.uuid4().hex}"
    df.write.format(fmt).save(folder)
    at = folder.replace("'", "\\'")
    if spark.catalog.tableExists(name):
        if spark.table(name).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{at}'")
            spark.catalog.refreshTable(name)
            return folder
        spark.sql(f"DROP TABLE {name}")  # external: its files stay
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{at}'")
    return folder


def published_location(spark: SparkSession, name: str) -> str:
    """The folder that a published table points to."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type


def ingest_batch(
    df: DataFrame, path: str, source: str, batch: str, at: dt.datetime | None = None, date_col: str | None = None, fmt: str = "parquet"
) -> None:
    """S8 that can be rerun: a batch has a name and a folder of its own, partitioned by year /
    month / day, which a rerun replaces. Landing the same batch again adds nothing, a batch
    that has lost rows loses them, and other batches are not touched."""
    if not batch or "/" in batch or "=" in batch:
        raise ValueError(f"not a name for a batch: {batch!r}")
    tagged = with_ingestion(df, source, at, date_col)
    tagged.write.format(fmt).mode("overwrite").partitionBy("year", "month", "day").save(f"{path.rstrip('/')}/batch={batch}")


def read_landing(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All batches below ``path``: ``schema``'s columns, those of ``with_ingestion``, and ``batch``
    as text. Filters on batch, year, month and day choose folders."""
    added = [("ingestion_timestamp", T.TimestampType()), ("source_system", T.StringType()), ("batch", T.StringType()),
             ("year", T.IntegerType()), ("month", T.IntegerType()), ("day", T.IntegerType())]
    whole = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in added]])
    return spark.read.format(fmt).schema(whole).load(path)


def ingest_append(
    df: DataFrame, path: str, source: str, at: dt.datetime | None = None, date_col: str | None = None, fmt: str = "parquet"
) -> None:
    """Land a batch: add ingestion time and source system, append partitioned by
    year / month / day (of ``date_col``, or of the ingestion time)."""
    tagged = with_ingestion(df, source, at, date_col)
    tagged.write.format(fmt).mode("append").partitionBy("year", "month", "day").save(path)


def with_ingestion(df: DataFrame, source: str, at: dt.datetime | None = None, date_col: str | None = None) -> DataFrame:
    ts = timestamp_of(at)
    base = F.col(date_col) if date_col else ts
    return df.withColumns(
        {
            "ingestion_timestamp": ts,
            "source_system": F.lit(source),
            "year": F.year(base),
            "month": F.month(base),
            "day": F.dayofmonth(base),
        }
    )
