"""Evaluate: score the fitted models and their baselines on held-out rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidecast.functions.timekeys import col_of, micros
from tidecast.operators.align import append, align_forecasts
from tidecast.operators.attach import attach
from tidecast.operators.evaluate import performance_report
from tidecast.operators.forecast import (
    SET, baseline_external, baseline_short, confidence_bounds, fit_long, forecast_long)
from tidecast.operators.position import Order
from tidecast.operators.shortterm import fit_short, forecast_short
from tidecast.operators.windows import constant_baseline, tail

PIPELINE = "forecast"


def _actuals(df: DataFrame, order: Order, target: str) -> DataFrame:
    return df.select(*order.key_columns(), *order.columns(), col_of(target).cast("double").alias("actual"))


def long_forecast_on_holdout(train: DataFrame, holdout: DataFrame, order: Order, target: str, baseline_rows: int = 8_760,
                             step_seconds: int = 3_600, **fit_options) -> DataFrame:
    """Forecast the whole period of the holdout, with bounds, beside the actuals and the constant baseline."""
    model = fit_long(train, order, target, **fit_options)
    t = col_of(order.time)
    span = micros(F.max(t)) - micros(F.min(t))
    steps = holdout.groupBy(*order.key_columns()).agg((span / (step_seconds * 1_000_000) + 1).cast("int").alias("steps"))
    forecasts = forecast_long(model, steps, step_seconds).drop(SET, "step", "raw_variance", "floor")
    if order.time != "time":
        forecasts = forecasts.withColumnRenamed("time", order.time)
    both = confidence_bounds(forecasts).join(_actuals(holdout, order, target), [*order.keys, order.time])
    flat = constant_baseline(train, target, order, baseline_rows).select(
        *order.keys, F.col("point_forecast").alias("baseline_point"), F.col("variance_forecast").alias("baseline_variance"))
    return attach(both, flat, order.keys)


def long_report(results: DataFrame) -> DataFrame:
    return performance_report(results, "actual", {
        PIPELINE: ("point_forecast", "variance_forecast"), "constant mean": ("baseline_point", None)}, PIPELINE)


def short_forecast_on_holdout(train: DataFrame, holdout: DataFrame, order: Order, target: str, predictors: Sequence[str],
                              length: int, horizon: int = 24, external: DataFrame | None = None, external_value: str = "y",
                              baseline_lag: int = 0, **fit_options) -> DataFrame:
    """Day-ahead forecasts of every holdout row beside the moving average, the scaled external forecast and the actuals."""
    ids = [*order.keys, order.time, *order.ties]
    columns = [target, *predictors]
    wanted = [*ids, *columns]
    train, holdout = train.select(*wanted), holdout.select(*wanted)
    model = fit_short(train, order, target, predictors, length, horizon, **fit_options)
    lead_in = append(tail(train, length + horizon - 1, order), holdout)
    average = baseline_short(append(tail(train, 2 * horizon, order), holdout), target, order, horizon, baseline_lag)
    parts = {"pipeline": forecast_short(lead_in, model, order), "average": average}
    if external is not None:
        parts["external"] = baseline_external(external, train, holdout, external_value, target, [*order.keys, order.time])
    return align_forecasts(parts, _actuals(holdout, order, target), ids)


def short_report(results: DataFrame) -> DataFrame:
    """Report whose weights are 1/variance, as for day-ahead forecasts."""
    models = {PIPELINE: ("pipeline_point_forecast", "pipeline_variance_forecast"),
              "moving average": ("average_point_forecast", None)}
    if "external_point_forecast" in results.columns:
        models["external"] = ("external_point_forecast", None)
    return performance_report(results, "actual", models, PIPELINE, power=1.0)
