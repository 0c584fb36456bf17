"""Error metrics, paired tests, reports, cross-validation and parameter sweeps."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.timekeys import col_of
from tidecast.operators.attach import attach
from tidecast.operators.decompose import Penalties
from tidecast.operators.forecast import SET, fit_long, forecast_long
from tidecast.operators.position import Order, running_counts, with_position
from tidecast.operators.shortterm import fit_short, forecast_short
from tidecast.session import write_scratch

EXACT_ROWS = 50


def _metric_columns(actual: Column, point: Column, variance: Column | None, power: float) -> list[Column]:
    error = point - actual
    n = F.count(error)
    out = [n.alias("n"), F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
           F.try_divide(F.sum(F.abs(F.try_divide(error, actual))), n).alias("mape")]
    if variance is not None:
        w = F.try_divide(F.lit(1.0), F.pow(variance, F.lit(power)))
        out.append(F.try_divide(F.sum(w * error * error), F.sum(F.when(error.isNotNull(), w))).alias("wmse"))
    return out


def metrics(df: DataFrame, actual: str, point: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, mean squared error, mean absolute error and mean absolute ratio of error to actual value."""
    return df.groupBy(*[col_of(k) for k in keys]).agg(*_metric_columns(col_of(actual), col_of(point), None, 0.5))


def weighted_mse(df: DataFrame, actual: str, point: str, variance: str, power: float = 0.5,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Squared error weighted by 1/variance^power with weights of mean one, as Σwe²/Σw."""
    return df.groupBy(*[col_of(k) for k in keys]).agg(
        _metric_columns(col_of(actual), col_of(point), col_of(variance), power)[-1])


def all_metrics(df: DataFrame, actual: str, point: str, variance: str, power: float = 0.5,
                keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[col_of(k) for k in keys]).agg(
        *_metric_columns(col_of(actual), col_of(point), col_of(variance), power))


def exact_p(statistic: float, n: int) -> float:
    """Two-sided p of the signed-rank statistic without ties, by counting sign patterns."""
    ways = [1] + [0] * (n * (n + 1) // 2)
    for r in range(1, n + 1):
        for s in range(len(ways) - 1, r - 1, -1):
            ways[s] += ways[s - r]
    return min(1.0, 2 * sum(ways[:int(statistic) + 1]) / 2 ** n)


def _p_values(z: pd.Series, statistic: pd.Series, n: pd.Series, ties: pd.Series, zeros: pd.Series) -> pd.Series:
    out = []
    for zi, s, k, t, o in zip(z, statistic, n, ties, zeros):
        if k <= EXACT_ROWS and t == 0 and o == 0:
            out.append(exact_p(s, int(k)))
        else:
            out.append(math.erfc(abs(zi) / math.sqrt(2)) if zi == zi else float("nan"))
    return pd.Series(out, dtype=float)


def wilcoxon(df: DataFrame, a: str, b: str, keys: Sequence[str] = (), digits: int = 9) -> DataFrame:
    """Signed-rank test of paired values: ``(keys, n, statistic, z, p_value, reject)``.

    Unknown differences, null or NaN, and zero ones are dropped, and tied ones share their average rank.  Differences are rounded so that
    float noise does not break ties.  Equal differences are counted first, so only distinct ones are
    ranked, by running counts.  Small samples without ties or zeros get the exact p, others the normal one.
    """
    d = F.round(col_of(a) - col_of(b), digits)
    rows = df.select(*[col_of(k) for k in keys], d.alias("_d")).filter(F.col("_d").isNotNull() & ~F.isnan(F.col("_d").cast("double")))
    sizes = rows.groupBy(*keys, F.abs("_d").alias("_abs")).agg(
        F.count(F.lit(1)).alias("_t"), F.count_if(F.col("_d") > 0).alias("_plus"))
    zeros = sizes.filter(F.col("_abs") == 0).select(*keys, F.col("_t").alias("_zeros"))
    zeros = zeros if keys else zeros.agg(F.coalesce(F.sum("_zeros"), F.lit(0)).alias("_zeros"))
    ranked = running_counts(sizes.filter(F.col("_abs") > 0), keys, "_abs", "_t")
    rank = F.col("before") + (F.col("_t") + 1) / F.lit(2.0)
    t = F.col("_t").cast("double")
    sums = ranked.groupBy(*keys).agg(
        F.sum("_t").alias("n"), F.sum(rank * F.col("_plus")).alias("_up"),
        F.sum(rank * (F.col("_t") - F.col("_plus"))).alias("_down"),
        F.sum(t * t * t - t).alias("_ties"))
    sums = attach(sums, zeros, keys)
    n = F.col("n").cast("double")
    deviation = F.sqrt((n * (n + 1) * (2 * n + 1) - F.col("_ties") / 2) / 24)
    out = sums.withColumn("statistic", F.least("_up", "_down")).withColumn(
        "z", F.try_divide(F.col("statistic") - n * (n + 1) / 4, deviation))
    p = F.pandas_udf(_p_values, "double")
    return (out.withColumn("p_value", p(F.coalesce("z", F.lit(float("nan"))), "statistic", "n", "_ties", F.coalesce("_zeros", F.lit(0))))
            .withColumn("reject", F.col("p_value") < 0.05)
            .select(*keys, "n", "statistic", "z", "p_value", "reject"))


def round_report(df: DataFrame, digits: int = 2) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[F.round(col_of(c), digits).alias(c) if kinds[c] == "double" else col_of(c) for c in df.columns])


def performance_report(df: DataFrame, actual: str, models: Mapping[str, tuple[str, str | None]], reference: str,
                       power: float = 0.5, digits: int = 2) -> DataFrame:
    """One row per model: errors, weighted error and the p of its errors differing from the reference's.

    ``models`` maps a name to its point and variance columns.  A model without variance has equal weights.
    """
    main = col_of(models[reference][0])
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), col_of(actual).cast("double").alias("actual"),
                 col_of(p).cast("double").alias("point"),
                 (col_of(v).cast("double") if v else F.lit(1.0)).alias("variance"),
                 (col_of(actual) - col_of(p)).alias("error"), (col_of(actual) - main).alias("reference_error"))
        for name, (p, v) in models.items()])))
    scores = all_metrics(long, "actual", "point", "variance", power, ("model",))
    tests = wilcoxon(long.filter(F.col("model") != reference), "error", "reference_error", ("model",))
    joined = scores.join(tests.select("model", "p_value"), ["model"], "left")
    return round_report(joined.select("model", "mse", F.col("wmse").alias("weighted_mse"), "mae", "mape",
                                      F.col("p_value").alias("wilcoxon_p_value")), digits)


def tag_folds(df: DataFrame, order: Order, k: int) -> DataFrame:
    """Add ``_segment`` (the fold a row tests, 0 for none), ``_step`` in it, the fold size ``_size`` and the
    row's distance ``_behind`` from the start of the first test block.
    """
    placed = with_position(df, order, "_pos", "_total")
    placed = placed.withColumn("_size", F.floor(F.col("_total") / (k + 1)).cast("int"))
    start = F.col("_total") - F.col("_size") * k
    behind = F.col("_pos") - start
    segment = F.when(behind < 0, 0).otherwise(F.coalesce(F.floor(F.try_divide(behind, F.col("_size"))), F.lit(0)) + 1)
    placed = placed.withColumn("_segment", segment.cast("int"))
    step = F.when(behind >= 0, F.pmod(behind, F.col("_size")) + 1).otherwise(0)
    return placed.withColumn("_step", step.cast("int")).withColumn("_behind", behind).drop("_pos", "_total")


def training_rows(tagged: DataFrame, k: int) -> DataFrame:
    """Each row once per fold that trains on it: the folds after its own segment."""
    later = F.when(F.col("_segment") < k, F.sequence(F.col("_segment") + 1, F.lit(k)))
    return tagged.withColumn("fold", F.explode(later))


def fold_forecasts(df: DataFrame, order: Order, target: str, k: int, penalties: Sequence[Penalties], step_seconds: int,
                   **fit_options) -> DataFrame:
    """Forecasts of every fold and penalty set beside the actual values, all folds fitted in the same jobs."""
    tagged = write_scratch(tag_folds(df, order, k), "folds")
    inner = replace(order, keys=(*order.keys, "fold"))
    model = fit_long(training_rows(tagged, k), inner, target, penalties=penalties, **fit_options)
    tests = tagged.filter("_segment > 0").select(
        *order.key_columns(), F.col("_segment").alias("fold"), F.col("_step").alias("step"),
        col_of(target).cast("double").alias("actual"), F.col("_size"))
    steps = tests.groupBy(*order.keys, "fold").agg(F.max("_size").alias("steps"))
    forecasts = forecast_long(model, steps, step_seconds)
    return forecasts.join(tests.drop("_size"), [*order.keys, "fold", "step"])


def cross_validate(df: DataFrame, order: Order, target: str, k: int = 5, penalties: Penalties = Penalties(),
                   return_predictions: bool = False, step_seconds: int = 3_600, **fit_options) -> DataFrame:
    """Expanding-window validation of the long-horizon model: mean errors over folds, or all predictions."""
    out = fold_forecasts(df, order, target, k, [penalties], step_seconds, **fit_options).drop(SET)
    if return_predictions:
        return out
    scores = all_metrics(out, "actual", "point_forecast", "variance_forecast", keys=[*order.keys, "fold"])
    return scores.groupBy(*order.keys).agg(F.avg("mse").alias("mse"), F.avg("wmse").alias("wmse"))


def sweep(df: DataFrame, order: Order, target: str, grid: DataFrame, k: int = 5, step_seconds: int = 3_600,
          **fit_options) -> DataFrame:
    """Fill ``mse`` and ``wmse`` for every row of a parameter table by cross-validation.

    The table has the columns of the penalties, ``minimum_error_prediction`` (null: the median) and
    ``error_trend``.  Rows that share penalties share the fit; floor and trend only enter at scoring.
    """
    names = ["changepoint_prior_scale", "seasonality_prior_scale"]
    pairs = [tuple(r) for r in grid.select(*names).distinct().orderBy(*names).collect()]
    sets = df.sparkSession.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pairs)],
                                           f"{SET} int, " + ", ".join(f"{n} double" for n in names))
    out = fold_forecasts(df, order, target, k, [Penalties(*map(float, p)) for p in pairs], step_seconds,
                         error_trend=0.0, **fit_options)
    rows = grid.join(sets, names).withColumn("set_row", F.struct(*[col_of(c) for c in grid.columns]))
    scored = out.join(rows, [SET])
    floor = F.coalesce(F.col("minimum_error_prediction").cast("double"), F.col("floor"))
    variance = F.greatest(floor, F.col("raw_variance")) + F.col("error_trend") * F.col("step")
    scored = scored.withColumn("variance_forecast", variance)
    folds = all_metrics(scored, "actual", "point_forecast", "variance_forecast",
                        keys=[*order.keys, "set_row", "fold"])
    means = folds.groupBy(*order.keys, "set_row").agg(F.avg("mse").alias("mse"), F.avg("wmse").alias("wmse"))
    return means.select(*order.keys, "set_row.*", "mse", "wmse")


def cross_validate_short(df: DataFrame, order: Order, target: str, predictors: Sequence[str], length: int,
                         horizon: int = 24, k: int = 5, return_predictions: bool = False, **fit_options) -> DataFrame:
    """Expanding-window validation of the day-ahead model.

    The rows before a test block that its first window needs are taken from the training part, so every
    test row gets one forecast.
    """
    columns = [target, *predictors]
    tagged = write_scratch(tag_folds(df.select(*order.key_columns(), *order.columns(), *[col_of(c) for c in columns]),
                                     order, k), "folds")
    inner = replace(order, keys=(*order.keys, "fold"))
    model = fit_short(training_rows(tagged, k), inner, target, predictors, length, horizon, **fit_options)
    lead_in = length + horizon - 1
    from_start = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda f: F.struct(
        f.alias("fold"), (F.col("_behind") - F.col("_size") * (f - 1)).alias("at")))
    reads = F.filter(from_start, lambda s: (s.getField("at") >= -lead_in) & (s.getField("at") < F.col("_size")))
    rows = tagged.withColumn("fold", F.explode(F.transform(reads, lambda s: s.getField("fold"))))
    tests = rows.select(*inner.key_columns(), *order.columns(), *[col_of(c) for c in columns], "_segment")
    forecasts = forecast_short(tests.drop("_segment"), model, inner)
    actual = tests.filter(F.col("fold") == F.col("_segment")).select(
        *inner.keys, *order.columns(), col_of(target).cast("double").alias("actual"))
    out = forecasts.join(actual, [*inner.keys, order.time])
    if return_predictions:
        return out
    scores = all_metrics(out, "actual", "point_forecast", "variance_forecast", keys=inner.keys)
    return scores.groupBy(*order.keys).agg(F.avg("mse").alias("mse"), F.avg("wmse").alias("wmse"))
