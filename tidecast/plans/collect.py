"""Collect: landed files of all sources to one hourly dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.operators.align import combine
from tidecast.operators.clean import EARLIEST, LATEST, clamp_range
from tidecast.sources import readers
from tidecast.sources.writers import write_dataset


def collect_dataset(spark: SparkSession, target_path, price_path, weather_paths: Sequence[str], indicator_path, start, end,
                    names: Mapping[str, str] = readers.INDICATOR_NAMES, out: str | None = None, bounds=(EARLIEST, LATEST)
                    ) -> tuple[DataFrame, DataFrame]:
    """The hourly dataset of a period (brought inside ``bounds``) and the counts of values lost by casts.

    The period is narrowed to what the target covers before the weather is read; every source is joined
    to the rows of the target.
    """
    low, high = clamp_range(start, end, bounds)
    target = readers.read_hourly_target(spark, target_path).filter(
        F.col("time").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")))
    first, last = target.agg(F.min("time")).scalar(), target.agg(F.max("time")).scalar()
    weather = readers.read_weather(spark, weather_paths, first, last)
    data, losses = combine(target, weather, readers.read_monthly_price(spark, price_path),
                           readers.read_indicators(spark, indicator_path, names))
    if out:
        write_dataset(data, out)
    return data, losses
