"""Readers of landed files: hourly and monthly API payloads, weather files, indicator payloads, datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidecast.functions.timekeys import HOUR_TEXT, col_of, hour_of, month_key, parse_time
from tidecast.operators.align import append
from tidecast.operators.clean import clean_cells, filter_eq, first_per_key

# The labels of the landed columns.
TARGET = "Energy Demand (MWH)"
PRICE = "Energy Price (cents/KWH)"
EXTERNAL = "EIA Forecast (MWH)"
MONTH_FOLDER = "dataset_month"

# The measured columns of the weather files and the codes of the rows to keep.
WEATHER_VALUES = [
    "HourlyDewPointTemperature", "HourlyDryBulbTemperature", "HourlyPrecipitation", "HourlyRelativeHumidity",
    "HourlyStationPressure", "HourlyWetBulbTemperature", "HourlyWindSpeed",
]
WEATHER_ROWS = {"REPORT_TYPE": "FM-15", "SOURCE": "7"}

# Published series ids of the economic indicators and the names they get.
INDICATOR_NAMES = {
    "CUURS12ASA0": "CPI-U",
    "LAUCT365100000000003": "Unemployment Rate",
    "LAUCT365100000000004": "Unemployment Level",
    "LAUCT365100000000005": "Employment Level",
    "LAUCT365100000000006": "Labor Force Level",
    "LAUCT365100000000007": "Employment Population Ratio",
    "LAUCT365100000000008": "Labor Force Participation",
    "LAUCT365100000000009": "Civilian Noninstitutional Population",
    "SMU36935610000000001": "Payroll Employment",
}


def _payload_rows(spark: SparkSession, path: str | Sequence[str], value: str, multi_line: bool) -> DataFrame:
    """Rows of ``response.data[]`` in all files, with where each came from.

    Payloads stand one per line, which lets large files be split; ``multi_line`` reads one pretty-printed
    payload per file.
    """
    schema = f"response struct<data: array<struct<period: string, `{value}`: string>>>"
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
    rows = pages.select(F.struct(*place).alias("_file"), F.posexplode("response.data").alias("_at", "_row"))
    return rows.select("_file", "_at", F.col("_row.period").alias("period"), col_of("_row").getField(value).alias("value"))


def _first_by_place(rows: DataFrame, key: str) -> DataFrame:
    """First row per key in the order of files, of pages in a file and of places in a page."""
    kept = first_per_key(rows, [key], [F.col("_file"), F.col("_at"), F.col("value")])
    return kept.drop("_file", "_at")


def read_hourly_target(spark: SparkSession, path: str | Sequence[str], name: str = TARGET,
                       multi_line: bool = False) -> DataFrame:
    """Hourly target ``(time, name)``; the value stays text as landed, the first row of an hour wins."""
    rows = _payload_rows(spark, path, "value", multi_line).withColumn("time", parse_time("period", HOUR_TEXT))
    first = _first_by_place(rows.drop("period").filter("time is not null"), "time")
    return first.select("time", F.col("value").alias(name))


def read_monthly_price(spark: SparkSession, path: str | Sequence[str], name: str = PRICE,
                       multi_line: bool = False) -> DataFrame:
    """Monthly price ``(month_key, name)`` with months as ``YYYY-MM``."""
    rows = _payload_rows(spark, path, "price", multi_line).withColumnRenamed("period", "month_key")
    return _first_by_place(rows, "month_key").select("month_key", F.col("value").alias(name))


def read_weather(spark: SparkSession, paths: Sequence[str], start: Column, end: Column,
                 columns: Sequence[str] = tuple(WEATHER_VALUES)) -> DataFrame:
    """Weather observations between two times (both ends open) as cleaned text, keyed by the hour.

    Yearly files are read by header name and stacked.  When two kept observations share an hour the
    earliest one stands.
    """
    wanted = ["DATE", "REPORT_TYPE", "SOURCE", *columns]
    years = append(*[spark.read.option("header", True).csv(p).select(*[col_of(c) for c in wanted]) for p in paths])
    kept = filter_eq(years, WEATHER_ROWS).drop("REPORT_TYPE", "SOURCE")
    seen = clean_cells(kept, list(columns)).withColumn("_seen", parse_time("DATE"))
    inside = seen.filter((F.col("_seen") > start) & (F.col("_seen") < end)).drop("DATE")
    hourly = inside.withColumn("time", hour_of("_seen"))
    ties = F.coalesce(F.concat_ws("|", *[col_of(c) for c in columns]), F.lit(""))
    return first_per_key(hourly, ["time"], [F.col("_seen"), ties]).select("time", *[col_of(c) for c in columns])


def read_indicators(spark: SparkSession, path: str | Sequence[str],
                    names: Mapping[str, str] = INDICATOR_NAMES, multi_line: bool = False) -> DataFrame:
    """Monthly indicators, one column per series, from ``Results.series[].data[]``.

    One pivot stands for the outer joins of the series by month.  Of several values of a series for a month the
    first stands, in order of files and of places in them.
    """
    schema = ("Results struct<series: array<struct<seriesID: string, "
              "data: array<struct<year: string, period: string, value: string>>>>>")
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    series = pages.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("line"), F.posexplode("Results.series").alias("i", "s"))
    rows = series.select(F.struct("file", "block", "line", "i").alias("place"), F.col("s.seriesID").alias("id"), F.posexplode("s.data").alias("j", "d"))
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    named = rows.select(F.concat_ws("-", "d.year", F.regexp_replace("d.period", "M", "")).alias("month_key"),
                        F.try_element_at(label, F.col("id")).alias("name"), F.col("d.value").alias("value"),
                        F.struct("place", "j").alias("place"))
    known = named.filter(F.col("name").isNotNull())
    return known.groupBy("month_key").pivot("name", list(names.values())).agg(F.min_by("value", "place"))


def read_external_forecast(spark: SparkSession, path: str | Sequence[str], name: str = EXTERNAL,
                           multi_line: bool = False) -> DataFrame:
    """Third-party day-ahead forecast ``(time, name double)`` in time order."""
    first = read_hourly_target(spark, path, name, multi_line)
    return first.withColumn(name, col_of(name).try_cast("double")).orderBy("time")


def read_dataset(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, fmt: str = "parquet",
                 time: str = "time", start=None, end=None) -> DataFrame:
    """A saved dataset; its first column becomes the time.

    With ``start`` or ``end`` (both included) only the month folders of that period are listed.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    first, rest = df.columns[0], [c for c in df.columns[1:] if c != MONTH_FOLDER]
    kind = dict(df.dtypes)[first]
    moment = parse_time(first) if kind == "string" else col_of(first).cast("timestamp_ntz")
    for bound, keep in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            limit = F.lit(bound).cast("timestamp_ntz")
            df = df.filter(getattr(moment, keep)(limit))
            if MONTH_FOLDER in df.columns:
                df = df.filter(getattr(col_of(MONTH_FOLDER), keep)(month_key(limit)))
    return df.select(moment.alias(time), *[col_of(c) for c in rest])
