"""Expressions on single cells: cleaning, clipping, binning, scaling, bounds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.timekeys import col_of

# Fixed values of the rain bins: right-closed edges, their labels, and the order of the levels.
RAIN_EDGES = [0.0001, 0.05, 0.33]
RAIN_LABELS = ["None", "Light Rain", "Medium Rain", "Heavy Rain"]
RAIN_LEVELS = ["Heavy Rain", "Light Rain", "Medium Rain", "None"]


def clean_cell(c: str | Column, strip: str = "s", null_tokens: Sequence[str] = ("T", "*")) -> Column:
    """Drop ``strip`` anywhere in the text, then turn the tokens into null, in that order."""
    kept = F.regexp_replace(col_of(c), strip, "")
    return F.when(~kept.isin(*null_tokens), kept)


def to_double(c: str | Column) -> Column:
    return col_of(c).try_cast("double")


def bin_label(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval a value falls in; null stays null."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    x = col_of(c)
    out = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(x <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def level_rank(c: str | Column, levels: Sequence[str]) -> Column:
    """Place of a value among the ordered levels, from 0; null for null or unknown."""
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), col_of(c))
    return F.when(place > 0, (place - 1).cast("int"))


def dummies(c: str, levels: Sequence[str], drop_first: bool = True) -> list[Column]:
    """One 0/1 column per level, named ``column_level``; null gives zeros throughout."""
    used = list(levels)[1:] if drop_first else list(levels)
    return [F.when(col_of(c) == v, 1).otherwise(0).cast("int").alias(f"{c}_{v}") for v in used]


def minmax_fit(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``low_column`` and ``high_column`` of every column, one row per key."""
    return df.groupBy(*[col_of(k) for k in keys]).agg(
        *[f(col_of(c)).alias(f"{side}_{c}") for c in columns for side, f in (("low", F.min), ("high", F.max))])


def scale_unit(c: str | Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low), null when the range is empty."""
    return F.try_divide(col_of(c) - low, high - low)


def unscale_unit(c: str | Column, low: Column, high: Column) -> Column:
    return col_of(c) * (high - low) + low


def clip(c: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on either side; null stays null."""
    x = col_of(c)
    out = x
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(x.isNotNull(), out)


def lower_bound(point: str | Column, variance: str | Column, z: float = 1.96) -> Column:
    return col_of(point) - F.lit(z) * F.sqrt(col_of(variance))


def upper_bound(point: str | Column, variance: str | Column, z: float = 1.96) -> Column:
    return col_of(point) + F.lit(z) * F.sqrt(col_of(variance))


def error_multiple(fitted: str | Column, actual: str | Column) -> Column:
    """Fitted over actual squared error; null where the actual one is zero."""
    return F.try_divide(col_of(fitted), col_of(actual))


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
