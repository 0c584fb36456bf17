"""Joins on time keys, calendars and appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidecast.functions import cells
from tidecast.functions.timekeys import col_of, month_key
from tidecast.operators.attach import join_on


#: Steps of a calendar that are one array.
SPAN_STEPS = 100_000


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = df.groupBy(*[col_of(k) for k in keys]).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"more than one row for the same {', '.join(keys)}")


def align(left: DataFrame, right: DataFrame, on: Sequence[str], check: bool = True) -> DataFrame:
    """Full outer join of two tables that each hold a key once; a repeated key is refused."""
    if check:
        require_unique(left, on)
        require_unique(right, on)
    return left.join(right, list(on), "full_outer")


def attach_monthly(hourly: DataFrame, monthly: DataFrame, time: str, month: str = "month_key",
                   how: str = "full_outer") -> DataFrame:
    """Join monthly values on the month of each row; months without rows are kept by the outer form.

    The outer form is a left join, whose monthly side may be broadcast when small and whose hot months may be split,
    and the months that no row has.
    """
    rows = hourly.withColumn(month, month_key(time))
    if how != "full_outer":
        return rows.join(monthly, [month], how)
    rest = monthly.join(rows.select(month).distinct(), [month], "left_anti")
    unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != month]
    rest = rest.select(month, *unknown, *[col_of(c) for c in monthly.columns if c != month])
    return rows.join(monthly, [month], "left").union(rest)


def combine(target: DataFrame, weather: DataFrame, price: DataFrame, indicators: DataFrame,
            time: str = "time", month: str = "month_key") -> tuple[DataFrame, DataFrame]:
    """The hourly dataset: everything joined to the rows of the target, all columns cast to double.

    Weather is keyed by ``time``, price and indicators by ``month``.  Also returns the count of values
    each cast lost.
    """
    joined = target.join(weather, [time], "left").withColumn(month, month_key(time))
    joined = joined.join(price, [month], "left").join(indicators, [month], "left").drop(month)
    values = [c for c in joined.columns if c != time]
    cast = joined.withColumns({c: cells.to_double(c) for c in values})
    losses = joined.agg(*[F.count_if(col_of(c).isNotNull() & cells.to_double(c).isNull()).alias(c) for c in values])
    return cast, losses


def reconcile(forecast: DataFrame, actual: DataFrame, on: Sequence[str] = ("time",)) -> DataFrame:
    """Forecasts with the actual values of the same times."""
    return forecast.join(actual, list(on), "inner")


def align_forecasts(forecasts: Mapping[str, DataFrame], actual: DataFrame, on: Sequence[str] = ("time",)) -> DataFrame:
    """Several forecasts and the actuals side by side, only times all of them know completely.

    Keeping complete rows of a full outer chain equals inner joins, which is what is built.
    """
    def named(name: str, df: DataFrame) -> DataFrame:
        return df.select(*[col_of(c).alias(c if c in on else f"{name}_{c}") for c in df.columns])

    parts = [named(n, d) for n, d in forecasts.items()] + [actual]
    joined = reduce(lambda a, b: a.join(b, list(on), "inner"), parts)
    for c in joined.columns:
        joined = joined.filter(col_of(c).isNotNull())
    return joined


def keep_times(df: DataFrame, times: DataFrame, on: Sequence[str] = ("time",)) -> DataFrame:
    return df.join(times.select(*on), list(on), "left_semi")


def exclude_times(df: DataFrame, times: DataFrame, on: Sequence[str] = ("time",)) -> DataFrame:
    return df.join(times.select(*on), list(on), "left_anti")


def calendar(df: DataFrame, time: str, step: str = "1 hour", keys: Sequence[str] = ()) -> DataFrame:
    """Every time from a series' first to its last; its size depends on the period only.

    Spans of ``SPAN_STEPS`` steps are laid out first, then the steps of each, so no long series is one array in one row.
    """
    ends = df.groupBy(*[col_of(k) for k in keys]).agg(F.min(col_of(time)).alias("_a"), F.max(col_of(time)).alias("_b"))
    own = [col_of(k) for k in keys]
    spans = ends.select(*own, "_b", F.explode(F.expr(f"sequence(_a, _b, (interval {step}) * {SPAN_STEPS})")).alias("_s"))
    last = f"least(_b, _s + (interval {step}) * {SPAN_STEPS - 1})"
    return spans.select(*own, F.explode(F.expr(f"sequence(_s, {last}, interval {step})")).alias(time))


def fill_calendar(df: DataFrame, time: str, step: str = "1 hour", keys: Sequence[str] = ()) -> DataFrame:
    """The rows of a series on its complete calendar, missing times as rows of nulls."""
    joined = join_on(calendar(df, time, step, keys), df, [*keys, time], "left")
    return joined.select(*[col_of(c) for c in df.columns])


def gaps(df: DataFrame, time: str, step: str = "1 hour", keys: Sequence[str] = ()) -> DataFrame:
    """Times of the calendar that have no row."""
    return join_on(calendar(df, time, step, keys), df.select(*keys, time), [*keys, time], "left_anti")


def append(*parts: DataFrame) -> DataFrame:
    """Stack tables by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)
