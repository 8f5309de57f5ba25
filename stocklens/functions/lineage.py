"""D4 processing metadata columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions.dates import timestamp_of


def with_lineage(df: DataFrame, source: str, version: str = "1.0", at: dt.datetime | None = None) -> DataFrame:
    """Add processed_at, processed_date, data_source, process_version.

    ``at`` pins the processing time (tests, reruns); otherwise the session clock is used, in
    the session time zone (Q17).
    """
    ts = timestamp_of(at)
    return df.withColumns(
        {
            "processed_at": ts,
            "processed_date": ts.cast("date"),
            "data_source": F.lit(source),
            "process_version": F.lit(version),
        }
    )
