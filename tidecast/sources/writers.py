"""Writers of datasets and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidecast.functions.timekeys import month_key
from tidecast.sources.readers import MONTH_FOLDER


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", time: str | None = "time",
                  mode: str = "error") -> None:
    """Write a table; parquet with a time column is partitioned by month so that ranges prune folders.

    Rows are brought together by month beforehand; adaptive execution sizes the tasks, so a month takes as many as
    its bytes need.
    """
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif time and time in df.columns:
        keyed = df.withColumn(MONTH_FOLDER, month_key(time))
        keyed.hint("rebalance", MONTH_FOLDER).write.mode(mode).partitionBy(MONTH_FOLDER).parquet(path)
    else:
        df.write.mode(mode).format(fmt).save(path)
