"""Summary statistics, correlations, distributions and simple fits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.cells import total
from tidecast.functions.timekeys import col_of
from tidecast.operators.attach import attach
from tidecast.operators.clean import numeric_columns
from tidecast.operators.position import running_counts


def quantiles(df: DataFrame, value: str, fractions: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key and columns ``q0``, ``q1``, …; NaN is unknown, as null is.

    Distinct values are counted first, so heavy ties shrink before the shuffle, and the values at the
    two ranks next to each quantile are then picked from running counts; no group is held in memory.
    """
    known = df.filter(col_of(value).isNotNull() & ~F.isnan(col_of(value).cast("double")))
    counted = known.groupBy(*[col_of(k) for k in keys], col_of(value).alias("_value")).agg(
        F.count(F.lit(1)).alias("_count"))
    ranked = running_counts(counted, keys, "_value", "_count")
    sizes = known.groupBy(*[col_of(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = attach(ranked, sizes, keys)
    picks = []
    for i, q in enumerate(fractions):
        place = F.lit(float(q)) * (F.col("_rows") - 1)
        for side, rank in (("a", F.floor(place)), ("b", F.ceil(place))):
            holds = (F.col("before") <= rank) & (rank < F.col("before") + F.col("_count"))
            picks.append(F.max(F.when(holds, F.col("_value"))).alias(f"_{side}{i}"))
    picked = ranked.groupBy(*keys).agg(F.first("_rows").alias("_rows"), *picks)
    out = []
    for i, q in enumerate(fractions):
        place = F.lit(float(q)) * (F.col("_rows") - 1)
        low, high = F.col(f"_a{i}"), F.col(f"_b{i}")
        out.append((low + (high - low) * (place - F.floor(place))).alias(f"q{i}"))
    return picked.select(*keys, *out)


def describe(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of every numeric column, rounded."""
    names = list(columns or numeric_columns(df))
    long = df.select(*[col_of(c).cast("double").alias(c) for c in names]).unpivot([], names, "variable", "value")
    moments = long.groupBy("variable").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = quantiles(long, "value", (0.25, 0.5, 0.75), ("variable",)).select(
        "variable", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    joined = moments.join(quartiles, ["variable"], "left")
    rounded = [F.round(c, digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return joined.select("variable", "count", *rounded)


def _pair_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are known."""
    return F.corr(col_of(a).cast("double"), col_of(b).cast("double"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long table ``(variable_a, variable_b, r)`` of all ordered pairs, from one aggregate."""
    names = list(columns or numeric_columns(df))
    pairs = list(combinations(names, 2))
    both = [F.struct(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"), F.col(f"_r{i}").alias("r"))
            for i, p in enumerate(pairs) for a, b in (p, p[::-1])]
    same = [F.struct(F.lit(c).alias("variable_a"), F.lit(c).alias("variable_b"), F.col(f"_s{i}").alias("r"))
            for i, c in enumerate(names)]
    sums = df.agg(*[_pair_corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)],
                  *[_pair_corr(c, c).alias(f"_s{i}") for i, c in enumerate(names)])
    return sums.select(F.inline(F.array(*same, *both)))


def target_correlations(df: DataFrame, target: str, predictors: Sequence[str] | None = None) -> DataFrame:
    names = [c for c in (predictors or numeric_columns(df)) if c != target]
    sums = df.agg(*[_pair_corr(c, target).alias(f"_r{i}") for i, c in enumerate(names)])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"_r{i}").alias("r"))
                                          for i, c in enumerate(names)])))


def category_means(df: DataFrame, category: str, y: str, levels: Sequence[str]) -> DataFrame:
    """Mean target per level; levels without rows are kept with a null mean."""
    known = df.sparkSession.createDataFrame([(v,) for v in levels], f"`{category}` string")
    means = df.groupBy(col_of(category)).agg(F.avg(col_of(y)).alias("mean"))
    return known.join(means, [category], "left")


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """Rows per category, null included."""
    return df.groupBy(col_of(category)).agg(F.count(F.lit(1)).alias("n"))


def mode_of(df: DataFrame, category: str, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent known category; ties go to the smallest."""
    counts = (df.filter(col_of(category).isNotNull())
              .groupBy(*[col_of(k) for k in keys], col_of(category)).agg(F.count(F.lit(1)).alias("n")))
    best = F.min_by(F.struct(col_of(category), "n"), F.struct(-F.col("n"), col_of(category))).alias("_best")
    return counts.groupBy(*[col_of(k) for k in keys]).agg(best).select(*keys, "_best.*")


def distribution(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Histogram of equal bins over the value range; empty bins are kept.

    Every row also carries the mean, the sample deviation and the edges of the one and three deviation bands.
    """
    x = col_of(column).cast("double")
    stats = df.agg(F.min(x).alias("low"), F.max(x).alias("high"), F.avg(x).alias("mean"),
                   F.stddev_samp(x).alias("std"))
    width = (F.col("_s.high") - F.col("_s.low")) / bins
    placed = (df.filter(x.isNotNull()).select(x.alias("_x"))
              .withColumn("_s", stats.select(F.struct("*")).scalar())
              .withColumn("bin", F.coalesce(F.least(F.floor(F.try_divide(F.col("_x") - F.col("_s.low"), width)),
                                                    F.lit(bins - 1)), F.lit(0)).cast("int")))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    grid = stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.struct("*").alias("_s"))
    m, s = F.col("_s.mean"), F.col("_s.std")
    return grid.join(counts, ["bin"], "left").select(
        "bin", (F.col("_s.low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_s.low") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"), m.alias("mean"), s.alias("std"),
        (m - s).alias("band1_low"), (m + s).alias("band1_high"),
        (m - 3 * s).alias("band3_low"), (m + 3 * s).alias("band3_high"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    sums = df.agg(*[F.count_if(col_of(c).isNull()).alias(f"_n{i}") for i, c in enumerate(names)])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"_n{i}").alias("missing"))
                                          for i, c in enumerate(names)])))


def time_bounds(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[col_of(k) for k in keys]).agg(
        F.min(col_of(time)).alias("first_time"), F.max(col_of(time)).alias("last_time"))


def poly_fit(df: DataFrame, x: str, y: str, degree: int = 3) -> DataFrame:
    """Least-squares polynomial, ``(power, coefficient)``: the sums come from Spark, the small solve is local.

    x is standardised before its powers are summed, which keeps the system well conditioned.
    """
    known = df.filter(col_of(x).isNotNull() & col_of(y).isNotNull()).select(
        col_of(x).cast("double").alias("x"), col_of(y).cast("double").alias("y"))
    spread = known.agg(F.struct(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).alias("_s"))
    z = F.try_divide(F.col("x") - F.col("_s.m"), F.col("_s.s"))
    scaled = known.withColumn("_s", spread.scalar()).withColumn("z", z)
    powers = [F.sum(F.pow("z", F.lit(i))).alias(f"p{i}") for i in range(2 * degree + 1)]
    cross = [F.sum(F.col("y") * F.pow("z", F.lit(i))).alias(f"c{i}") for i in range(degree + 1)]
    row = scaled.agg(F.first("_s").alias("_s"), *powers, *cross).first()
    gram = np.array([[row[f"p{i + j}"] for j in range(degree + 1)] for i in range(degree + 1)], dtype=float)
    beta = np.linalg.solve(gram, np.array([row[f"c{i}"] for i in range(degree + 1)], dtype=float))
    shift = np.poly1d([1 / row["_s"]["s"], -row["_s"]["m"] / row["_s"]["s"]])
    fitted = sum((b * shift ** i for i, b in enumerate(beta)), np.poly1d([0.0]))
    coefs = [float(fitted.coef[::-1][i]) if i <= fitted.order else 0.0 for i in range(degree + 1)]
    return df.sparkSession.createDataFrame(list(enumerate(coefs)), "power int, coefficient double")


def scale_coefficient(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Σxy/Σx² over rows that know both."""
    known = df.filter(col_of(x).isNotNull() & col_of(y).isNotNull())
    return known.groupBy(*[col_of(k) for k in keys]).agg(
        F.try_divide(F.sum(col_of(x) * col_of(y)), F.sum(col_of(x) * col_of(x))).alias("coefficient"))


def component_contributions(df: DataFrame, y: str = "y", components: Sequence[str] = (
        "trend", "yearly", "weekly", "daily", "residual"), keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of the series with each component, divided by the sum of those correlations."""
    rs = df.groupBy(*[col_of(k) for k in keys]).agg(*[F.corr(col_of(y), col_of(c)).alias(c) for c in components])
    whole = total([col_of(c) for c in components])
    return rs.select(*keys, *[F.try_divide(col_of(c), whole).alias(c) for c in components])
