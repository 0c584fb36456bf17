"""Long-horizon probabilistic forecasts, ensembles and baselines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.functions import cells
from tidecast.functions.timekeys import col_of
from tidecast.operators.attach import attach
from tidecast.operators.decompose import (
    Penalties, fit_decomposition, fitted_array, predict_decomposition, residuals)
from tidecast.operators.describe import quantiles, scale_coefficient
from tidecast.operators.position import Order, with_layout, without_layout
from tidecast.operators.var import fit_components, fit_var, forecast_var, reduce_features, squared_errors
from tidecast.operators.windows import trailing_mse, with_lags
from tidecast.session import write_scratch
from tidecast.sources import store

SET = "penalty_set"


@dataclass(frozen=True)
class LongModel:
    """Fitted tables of the long-horizon model, one row per series and penalty set in each."""

    order: Order
    target: str
    point: DataFrame
    var: DataFrame
    errors: DataFrame
    error_var: DataFrame | None
    floor: DataFrame
    slope: float
    components: DataFrame | None = None
    penalties: tuple[Penalties, ...] = field(default=(Penalties(),))

    @property
    def keys(self) -> list[str]:
        return [*self.order.keys, SET]

    def tables(self) -> dict[str, DataFrame]:
        named = {"point": self.point, "var": self.var, "errors": self.errors, "error_var": self.error_var,
                 "floor": self.floor, "components": self.components}
        return {k: v for k, v in named.items() if v is not None}

    def save(self, path: str) -> int:
        """Publish the model in a store; returns the version, see ``store.publish``."""
        settings = {"order": order_settings(self.order), "target": self.target, "slope": self.slope,
                    "penalties": [asdict(p) for p in self.penalties]}
        return store.publish("long", self.tables(), settings, path, self.point.sparkSession)

    def load(self, spark: SparkSession, path: str) -> "LongModel":
        """The model stored in a folder, see ``load_long``."""
        return load_long(spark, path)


def order_settings(order: Order) -> dict:
    return {"time": order.time, "keys": order.keys, "ties": order.ties, "bucket_seconds": order.bucket_seconds}


def load_long(spark: SparkSession, path: str, version: int | None = None) -> LongModel:
    """A stored model, from its folder alone; by default the newest version."""
    tables, known = store.fetch("long", path, spark, version)
    order = {k: tuple(v) if isinstance(v, list) else v for k, v in known["order"].items()}
    return LongModel(Order(**order), known["target"], slope=known["slope"],
                     penalties=tuple(Penalties(**p) for p in known["penalties"]), **{"error_var": None, "components": None, **tables})


def fit_error_model(e2: DataFrame, order: Order, use_var: bool = True, p: int = 1
                    ) -> tuple[DataFrame, DataFrame | None]:
    """Decomposition of every squared-error column, and the autoregression of what its floor at zero leaves."""
    errors = write_scratch(fit_decomposition(e2, order, "e2"), "errors")
    if not use_var:
        return errors, None
    left = fitted_array(e2, errors, order).withColumn(
        "e2", F.zip_with("e2", "_fit", lambda e, f: e - F.greatest(f, F.lit(0.0))))
    return errors, write_scratch(fit_var(left, "e2", order, p), "error_var")


def error_floor(e2: DataFrame, keys: Sequence[str], minimum: float | None) -> DataFrame:
    """Smallest variance a forecast may have: the given value or the median squared error."""
    first = e2.select(*keys, F.col("e2")[0].alias("_e"))
    if minimum is not None:
        return first.groupBy(*keys).agg(F.lit(float(minimum)).alias("floor"))
    return quantiles(first, "_e", (0.5,), keys).select(*keys, F.col("q0").alias("floor"))


def fit_long(df: DataFrame, order: Order, target: str, predictors: Sequence[str] = (), strong: Sequence[str] = (),
             encoded: Sequence[str] = (), penalties: Sequence[Penalties] = (Penalties(),), p: int = 1,
             minimum_error: float | None = None, error_trend: float = 1e-4, min_eig: float = 0.1,
             use_error_var: bool = True) -> LongModel:
    """Fit the long-horizon model for every series and penalty set.

    Numeric variables are decomposed; the target's and strong predictors' residuals stay as they are, the
    other residuals and the ``encoded`` dummies are reduced to components; an autoregression follows, and
    its squared errors get the same treatment.  Each fit is a pass that leaves a model-sized table.
    """
    numeric = [target, *predictors]
    order = with_layout(df, order)
    point = write_scratch(fit_decomposition(df, order, numeric, penalties), "point")
    left = residuals(df.select(*order.key_columns(), *order.columns(), *[col_of(c) for c in (*numeric, *encoded)]),
                     point, numeric, order, params=True).withColumnRenamed("params_id", SET)
    inner = replace(order, keys=(*order.keys, SET))
    others = [c for c in predictors if c not in strong] + list(encoded)
    components = write_scratch(fit_components(left, others, inner, min_eig), "components") if others else None
    z = reduce_features(left, [target, *strong], others, components, inner)
    var = write_scratch(fit_var(z, "z", inner, p), "var")
    e2 = write_scratch(squared_errors(z, "z", var, inner, p), "e2")
    errors, error_var = fit_error_model(e2, inner, use_error_var)
    floor = write_scratch(error_floor(e2, inner.keys, minimum_error), "floor")
    own = point.filter(F.col("variable") == target).withColumnRenamed("params_id", SET)
    return LongModel(without_layout(order), target, own, var, errors.filter("out = 0"), error_var, floor, float(error_trend), components,
                     tuple(penalties))


def forecast_long(model: LongModel, hours_ahead: int | DataFrame, step_seconds: int = 3_600) -> DataFrame:
    """``(keys, penalty_set, time, step, point_forecast, variance_forecast)`` for the steps after the training data.

    ``hours_ahead`` is a positive whole number, or a table giving ``steps`` per key.  ``raw_variance`` is
    the variance before the floor and the trend.
    """
    keys = model.keys
    if isinstance(hours_ahead, DataFrame):
        var = attach(model.var, hours_ahead, [c for c in hours_ahead.columns if c != "steps"], "inner")
    else:
        if isinstance(hours_ahead, bool) or hours_ahead != int(hours_ahead) or hours_ahead <= 0:
            raise ValueError("hours_ahead must be a positive whole number")
        var = model.var.withColumn("steps", F.lit(int(hours_ahead)))
    ends = var.select(*keys, "last_time", F.col("steps").cast("int").alias("steps"))
    grid = ends.filter("steps > 0").select(*keys, "last_time", F.explode(F.sequence(F.lit(1), F.col("steps"))).alias("step"))
    grid = grid.select(*keys, "step", F.timestamp_add("SECOND", F.col("step") * step_seconds, F.col("last_time")).alias("time"))
    point = predict_decomposition(grid, model.point.withColumn("params_id", F.lit(0)), "time", keys).select(
        *keys, "step", "time", F.col("yhat").alias("_point"))
    noise = predict_decomposition(grid, model.errors, "time", keys).select(*keys, "step", F.col("yhat").alias("_error"))
    out = (point.join(forecast_var(var, keys, "steps").withColumnRenamed("value", "_point_var"), [*keys, "step"])
           .join(noise, [*keys, "step"]))
    raw = F.col("_error")
    if model.error_var is not None:
        steps = model.error_var.join(ends.select(*keys, "steps"), keys)
        out = out.join(forecast_var(steps, keys, "steps").withColumnRenamed("value", "_error_var"), [*keys, "step"])
        raw = raw + F.col("_error_var")
    out = out.join(model.floor, keys).withColumn("raw_variance", raw)
    variance = F.greatest(F.col("floor"), F.col("raw_variance")) + F.lit(model.slope) * F.col("step")
    return out.select(*keys, "time", "step", (F.col("_point") + F.col("_point_var")).alias("point_forecast"),
                      variance.alias("variance_forecast"), "raw_variance", "floor")


def confidence_bounds(df: DataFrame, point: str = "point_forecast", variance: str = "variance_forecast",
                      z: float = 1.96) -> DataFrame:
    return df.withColumns({"lower": cells.lower_bound(point, variance, z), "upper": cells.upper_bound(point, variance, z)})


def publish_future(df: DataFrame, order: Order, target: str, hours: int = 17_520, step_seconds: int = 3_600,
                   **fit_options) -> DataFrame:
    """Refit on all rows and forecast the coming period with its bounds."""
    model = fit_long(df, order, target, **fit_options)
    out = forecast_long(model, hours, step_seconds).drop(SET, "raw_variance", "floor")
    return confidence_bounds(out)


def ensemble(forecasts: Mapping[str, tuple[DataFrame, float]], on: Sequence[str] = ("time",),
             point: str = "point_forecast", variance: str = "variance_forecast") -> DataFrame:
    """Weighted mean of several forecasts; a member of weight zero is not read."""
    used = {n: (d, w) for n, (d, w) in forecasts.items() if w > 0}
    if not used:
        raise ValueError("at least one forecast needs a positive weight")
    whole = float(sum(w for _, w in used.values()))
    joined = None
    for i, (d, _) in enumerate(used.values()):
        part = d.select(*on, col_of(point).alias(f"_p{i}"), col_of(variance).alias(f"_v{i}"))
        joined = part if joined is None else joined.join(part, list(on), "inner")
    weights = [w for _, w in used.values()]
    return joined.select(
        *on, (cells.total([F.col(f"_p{i}") * w for i, w in enumerate(weights)]) / whole).alias(point),
        (cells.total([F.col(f"_v{i}") * w for i, w in enumerate(weights)]) / whole).alias(variance))


def baseline_short(df: DataFrame, y: str, order: Order, w: int = 24, lag: int = 0) -> DataFrame:
    """Trailing mean as the forecast and its trailing squared error as the variance.

    With ``lag`` 0 the mean includes the hour it forecasts; a lag of a day makes it an honest day-ahead one.
    """
    out = trailing_mse(df, y, w, order)
    cols = ["trailing_mean", "trailing_mse"]
    if lag:
        shifted = with_lags(out, cols, lag, order)
        out = shifted.select(*[col_of(c) for c in df.columns], *[F.col(f"{c}_lag{lag}").alias(c) for c in cols])
    return out.filter(F.col("trailing_mse").isNotNull()).select(
        *order.key_columns(), *order.columns(), F.col("trailing_mean").alias("point_forecast"),
        F.col("trailing_mse").alias("variance_forecast"))


def baseline_external(external: DataFrame, training: DataFrame, evaluation: DataFrame, x: str, y: str,
                      on: Sequence[str] = ("time",)) -> DataFrame:
    """External forecast of the evaluation times, scaled by the coefficient found on the training times."""
    both = training.join(external, list(on), "inner")
    wanted = external.join(evaluation.select(*on), list(on), "left_semi")
    keys = [c for c in on if c != "time"]
    scaled = attach(wanted, scale_coefficient(both, x, y, keys), keys)
    return scaled.select(*on, (col_of(x) * F.col("coefficient")).alias("point_forecast"))
