"""Projections, filters, cell cleaning and dataset checks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, TimestampNTZType, TimestampType

from tidecast.functions import cells, timekeys
from tidecast.functions.timekeys import col_of

# The period that can be asked for.
EARLIEST = datetime(2018, 1, 1)
LATEST = datetime(2025, 1, 1)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def project(df: DataFrame, keep: Sequence[str] | None = None, rename: Mapping[str, str] | None = None,
            drop: Sequence[str] = ()) -> DataFrame:
    """Keep, drop and rename columns."""
    names = [c for c in (keep or df.columns) if c not in drop]
    new = rename or {}
    return df.select(*[col_of(c).alias(new.get(c, c)) for c in names])


def filter_eq(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    for c, v in values.items():
        df = df.filter(col_of(c) == F.lit(v))
    return df


def parse_moment(value: str | date | datetime, what: str) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, str):
        try:
            return datetime.fromisoformat(value)
        except ValueError as e:
            raise ValueError(f"the {what} time is not a date: {value!r}") from e
    raise ValueError(f"the {what} time must be text or a date")


def clamp_range(start, end, bounds: tuple[datetime, datetime] = (EARLIEST, LATEST)) -> tuple[datetime, datetime]:
    """Bring a requested range inside the supported one; a start at or after the end is refused."""
    low = max(parse_moment(start, "start"), bounds[0])
    high = min(parse_moment(end, "end"), bounds[1])
    if low >= high:
        raise ValueError("the start is not before the end")
    return low, high


def time_range(df: DataFrame, time: str, start, end, bounds: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Rows strictly between two times, brought inside ``bounds`` if given; the comparison reaches the parquet scan."""
    low, high = clamp_range(start, end, bounds) if bounds else (parse_moment(start, "start"), parse_moment(end, "end"))
    if low >= high:
        raise ValueError("the start is not before the end")
    t = col_of(time)
    return df.filter((t > F.lit(low).cast("timestamp_ntz")) & (t < F.lit(high).cast("timestamp_ntz")))


def clean_cells(df: DataFrame, columns: Sequence[str], strip: str = "s",
                null_tokens: Sequence[str] = ("T", "*")) -> DataFrame:
    """Strip a character from text cells, then turn marker cells into null."""
    return df.withColumns({c: cells.clean_cell(c, strip, null_tokens) for c in columns})


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns to double, and a one-row table counting the values each cast lost."""
    cast = df.withColumns({c: cells.to_double(c) for c in columns})
    losses = df.agg(*[F.count_if(col_of(c).isNotNull() & cells.to_double(c).isNull()).alias(c) for c in columns])
    return cast, losses


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in an explicit order, as an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[col_of(c) for c in rest]), F.struct(*order)).alias("_first")
    picked = df.groupBy(*[col_of(k) for k in keys]).agg(first)
    return picked.select(*[col_of(c) if c in keys else F.col("_first").getField(c).alias(c) for c in df.columns])


def with_time_keys(df: DataFrame, time: str, fmt: str | None = None) -> DataFrame:
    """Add ``hour`` (start of the hour), ``hour_key`` and ``month_key``; text times are parsed first."""
    parsed = col_of(time) if dict(df.dtypes)[time] != "string" else timekeys.parse_time(time, fmt)
    out = df.withColumn(time, parsed)
    return out.withColumns({"hour": timekeys.hour_of(time), "hour_key": timekeys.hour_key(time),
                            "month_key": timekeys.month_key(time), "year": F.year(col_of(time))})


def normalize_names(df: DataFrame) -> DataFrame:
    """Remove spaces and bracketed units from column names."""
    return df.toDF(*[re.sub(r" |\([^)]*\)", "", c) for c in df.columns])


def fill_const(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.withColumn(column, F.coalesce(col_of(column), F.lit(value)))


def overwrite(df: DataFrame, condition: Column, column: str, value: object) -> DataFrame:
    """Set a column where a condition holds; where it is unknown the value stays."""
    return df.withColumn(column, F.when(condition, F.lit(value)).otherwise(col_of(column)))


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    for c in names:
        df = df.filter(col_of(c).isNotNull())
    return df


@dataclass(frozen=True)
class DatasetSpec:
    time: str
    columns: tuple[str, ...]
    start: datetime
    end: datetime


def validate_dataset(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Report table ``(check_name, passed)`` from the schema and one aggregate."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in df.columns if c != spec.time]
    bounds = df.agg(F.count(F.lit(1)).alias("n"), F.min(col_of(spec.time)).alias("low"),
                    F.max(col_of(spec.time)).alias("high"))
    checks = {
        "column_count": F.lit(len(names) == len(spec.columns)),
        "column_names": F.lit(set(names) == set(spec.columns)),
        "time_type": F.lit(isinstance(kinds.get(spec.time), (TimestampType, TimestampNTZType))),
        "not_empty": F.col("n") > 0,
        "start": F.col("low") >= F.lit(spec.start).cast("timestamp_ntz"),
        "end": F.col("high") <= F.lit(spec.end).cast("timestamp_ntz"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("check_name"), F.coalesce(v, F.lit(False)).alias("passed"))
                     for k, v in checks.items()])
    return bounds.select(F.inline(rows))


def inject_anomalies(df: DataFrame, ids: Sequence[str], columns: Sequence[str], share: float, seed: int,
                     deviations: float = 1000.0) -> DataFrame:
    """Spoil cells for tests: a ``share`` of each column becomes mean ± deviations·std, another share null.

    The MD5 of the seed, the column and the row's ids picks cells (by its first eight digits) and signs (by the
    ninth), so the choice does not depend on how the rows are spread over tasks.
    """
    moments = df.agg(*[F.struct(F.avg(col_of(c)).alias("m"), F.stddev_samp(col_of(c)).alias("s")).alias(c)
                       for c in columns])
    stats = df.withColumn("_stats", moments.select(F.struct("*")).scalar())
    out = {}
    for c in columns:
        digits = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(c), *[col_of(i).cast("string") for i in ids]))
        draw = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long") % 1_000_000 / 1e6
        sign = F.when(F.substring(digits, 9, 1) < "8", 1.0).otherwise(-1.0)
        m = F.col("_stats").getField(c)
        extreme = m.getField("m") + sign * deviations * m.getField("s")
        out[c] = (F.when(draw < share, extreme).when(draw < 2 * share, F.lit(None)).otherwise(col_of(c)))
    return stats.withColumns(out).drop("_stats")
