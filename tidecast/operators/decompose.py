"""Additive decomposition: piecewise-linear trend with yearly, weekly and daily seasonality.

The basis is fixed (see the constants), so a fit needs only cross-product sums per series and variable, and a
prediction is a dot product of expressions with the stored coefficients.  Trend changes and seasonal terms
are shrunk by ridge penalties whose strength follows the estimated noise; with ``Penalties(sparse=True)`` the trend
changes have a Laplace prior instead, which leaves most of them at zero and so tells where the trend turns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.timekeys import col_of, epoch_days
from tidecast.operators.attach import attach, join_on
from tidecast.operators.gram import blocked_sums, by_key, key_schema, lasso, ridge, stack
from tidecast.operators.position import Order

# Period in days and number of sine/cosine pairs of each season, and the trend changes.
SEASONS = [("yearly", 365.25, 10), ("weekly", 7.0, 3), ("daily", 1.0, 4)]
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8

TREND_TERMS = 2 + CHANGEPOINTS
TERMS = TREND_TERMS + sum(2 * pairs for _, _, pairs in SEASONS)
COMPONENTS = ["trend"] + [name for name, _, _ in SEASONS]


@dataclass(frozen=True)
class Penalties:
    changepoint_prior_scale: float = 0.001
    seasonality_prior_scale: float = 0.01
    sparse: bool = False


def changepoints() -> np.ndarray:
    return np.linspace(0, CHANGEPOINT_RANGE, CHANGEPOINTS + 1)[1:]


def design(days: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """The basis as a matrix, for the sums inside tasks."""
    columns = [np.ones_like(scaled), scaled]
    columns += [np.maximum(0.0, scaled - c) for c in changepoints()]
    for _, period, pairs in SEASONS:
        for i in range(1, pairs + 1):
            angle = 2 * np.pi * i / period * days
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def basis(days: str, scaled: str) -> Column:
    """The same basis as an array expression over two columns."""
    bends = ", ".join(f"{float(c)!r}D" for c in changepoints())
    turns = ", ".join(f"{float(2 * np.pi * i / period)!r}D" for _, period, pairs in SEASONS for i in range(1, pairs + 1))
    return F.expr(f"concat(array(1D, `{scaled}`), transform(array({bends}), c -> greatest(0D, `{scaled}` - c)), "
                  f"flatten(transform(array({turns}), w -> array(sin(w * `{days}`), cos(w * `{days}`)))))")


def with_basis(df: DataFrame, time: str, t0: str, span: str) -> DataFrame:
    """Add the basis of every row as ``_x``."""
    df = df.withColumn("_days", epoch_days(time))
    df = df.withColumn("_scaled", F.coalesce(F.try_divide(F.col("_days") - col_of(t0), col_of(span)), F.lit(0.0)))
    return df.withColumn("_x", basis("_days", "_scaled")).drop("_days", "_scaled")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def component_slices() -> dict[str, tuple[int, int]]:
    """First term (1-based) and number of terms of every component."""
    out, at = {"trend": (1, TREND_TERMS)}, TREND_TERMS + 1
    for name, _, pairs in SEASONS:
        out[name] = (at, 2 * pairs)
        at += 2 * pairs
    return out


def _partial_sums(cols: dict[str, np.ndarray], home: dict) -> list[dict]:
    x, ys, rows = design(cols["_days"], cols["_scaled"]), cols["_ys"], []
    for i in range(ys.shape[1]):
        known = np.isfinite(ys[:, i])  # one infinite value would spoil every sum
        xi, yi = x[known], ys[known, i]
        rows.append({"out": i, "t0": cols["_t0"][0], "span": cols["_span"][0], "n": int(known.sum()),
                     "yy": float(yi @ yi), "xy": xi.T @ yi, "xx": (xi.T @ xi).ravel(),
                     "peak": float(np.abs(yi).max()) if len(yi) else 0.0})
    return rows


def sparse_bends(xx: np.ndarray, xy: np.ndarray, ridges: np.ndarray, weight: float, start: np.ndarray) -> np.ndarray:
    """Coefficients with an absolute penalty on the trend changes; the other terms are solved out of the sums first."""
    bend = np.zeros(TERMS, bool)
    bend[2:TREND_TERMS] = True
    rest = ~bend
    across = xx[np.ix_(rest, bend)]
    solved = np.column_stack([ridge(xx[np.ix_(rest, rest)], c, ridges[rest]) for c in (*across.T, xy[rest])])
    inner = xx[np.ix_(bend, bend)] - across.T @ solved[:, :-1]
    beta = np.zeros(TERMS)
    beta[bend] = lasso((inner + inner.T) / 2, xy[bend] - across.T @ solved[:, -1], np.full(CHANGEPOINTS, weight), start[bend])
    beta[rest] = solved[:, -1] - solved[:, :-1] @ beta[bend]
    return beta


def _solve(keys: Sequence[str], names: Sequence[str] | None, penalties: Sequence[Penalties]):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        n, yy, scale = int(pdf["n"].sum()), float(pdf["yy"].sum()), float(pdf["peak"].max()) or 1.0
        xy = stack(pdf["xy"]).sum(axis=0) / scale
        xx = stack(pdf["xx"]).sum(axis=0).reshape(TERMS, TERMS)
        yy /= scale ** 2
        rows = []
        for i, p in enumerate(penalties):
            shape = np.zeros(TERMS)
            shape[2:TREND_TERMS] = p.changepoint_prior_scale ** -2
            shape[TREND_TERMS:] = p.seasonality_prior_scale ** -2
            # an absolute penalty at too high a noise would hold all bends at zero, and so the noise high
            noise, beta = 1e-6 if p.sparse else 0.01, np.zeros(TERMS)
            for _ in range(20 if n else 0):
                beta = (sparse_bends(xx, xy, noise * shape, noise / p.changepoint_prior_scale, beta) if p.sparse
                        else ridge(xx, xy, noise * shape))
                found = max((yy - 2 * beta @ xy + beta @ xx @ beta) / n, 1e-10)
                if abs(found - noise) <= 1e-6 * noise:
                    break
                noise = found
            rows.append({**{k: first[k] for k in keys}, "params_id": i, "out": int(first["out"]),
                         "variable": names[int(first["out"])] if names else str(int(first["out"])),
                         "t0": first["t0"], "span": first["span"], "n": n, "noise": noise * scale ** 2,
                         "beta": beta * scale})
        return pd.DataFrame(rows)
    return solve


def fit_decomposition(df: DataFrame, order: Order, values: Sequence[str] | str,
                      penalties: Sequence[Penalties] = (Penalties(),), block_rows: int | None = None) -> DataFrame:
    """Fit every variable of every series in one pass; one model row per key, penalty set and variable.

    ``values`` names numeric columns, or one array column.  Null, NaN and infinite values are left out of the fit.  Time is
    scaled by the first and last time of the series.
    """
    names = None if isinstance(values, str) else list(values)
    ys = (F.transform(col_of(values), lambda v: F.coalesce(v, F.lit(float("nan")))) if names is None else
          F.array(*[F.coalesce(col_of(c).cast("double"), F.lit(float("nan"))) for c in names]))
    rows = df.select(*order.key_columns(), *order.columns(), epoch_days(order.time).alias("_days"), ys.alias("_ys"))
    scaled = F.coalesce(F.try_divide(F.col("_days") - F.col("_t0"), F.col("_span")), F.lit(0.0))
    keys = [*order.keys, "out"]
    summed = blocked_sums(rows, order, 0, _partial_sums,
                          "out int, t0 double, span double, n long, yy double, xy array<double>, xx array<double>, "
                          "peak double", keys, ("n", "yy", "xy", "xx"), peaks=("peak",), block_rows=block_rows,
                          prepare=lambda r: r.withColumn("_scaled", scaled))
    schema = key_schema(df, order.keys) + ("params_id int, out int, variable string, t0 double, span double, n long, "
                                           "noise double, beta array<double>")
    return by_key(summed, keys, _solve(order.keys, names, penalties), schema)


def trend_changes(models: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, params_id, variable, time, change)``: when the trend turns and by how much a day, without zero changes."""
    bends = F.slice("beta", 3, CHANGEPOINTS)
    places = ", ".join(f"{float(c)!r}D" for c in changepoints())
    rows = models.select(*keys, "params_id", "variable", "t0", "span", F.posexplode(bends).alias("_i", "_change"))
    days = F.col("t0") + F.expr(f"array({places})")[F.col("_i")] * F.col("span")
    time = F.timestamp_add("SECOND", F.round(days * 86_400).cast("long"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return rows.filter("_change <> 0").select(
        *keys, "params_id", "variable", time.alias("time"), F.try_divide("_change", "span").alias("change"))


def packed(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (penalty sets included): the coefficient arrays of its variables in order."""
    ordered = F.array_sort(F.collect_list(F.struct("out", "beta")))
    return models.groupBy(*keys, "params_id").agg(
        F.first("t0").alias("_t0"), F.first("span").alias("_span"),
        F.transform(ordered, lambda m: m.getField("beta")).alias("_betas"))


def predict_decomposition(times: DataFrame, models: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """``yhat`` and its components at any times, one row per time and variable of the key."""
    slices = component_slices()
    rows = join_on(times, models.select(*keys, "params_id", "variable", "t0", "span", "beta"), keys) \
        if keys else _each_model(times, models)
    x = with_basis(rows, time, "t0", "span")
    parts = {c: dot(F.slice("_x", a, n), F.slice("beta", a, n)) for c, (a, n) in slices.items()}
    out = x.withColumns(parts).withColumn("yhat", F.col("trend") + F.col("yearly") + F.col("weekly") + F.col("daily"))
    return out.select(*[col_of(c) for c in times.columns], "params_id", "variable", "yhat", *COMPONENTS)


def _each_model(times: DataFrame, models: DataFrame) -> DataFrame:
    """Repeat every time for the few models of a single series."""
    fields = F.struct("params_id", "variable", "t0", "span", "beta")
    every = models.agg(F.array_sort(F.collect_list(fields)).alias("m"))
    return times.withColumn("_m", F.explode(every.scalar())).select(*[col_of(c) for c in times.columns], "_m.*")


def fitted_array(df: DataFrame, models: DataFrame, order: Order, name: str = "_fit", params: bool = False) -> DataFrame:
    """Add the fitted value of every variable of the row's series as one array.

    With ``params`` each row is repeated per penalty set and keeps ``params_id``.
    """
    models_row = packed(models, order.keys)
    if not params:
        models_row = models_row.filter("params_id = 0").drop("params_id")
        rows = attach(df, models_row, order.keys)
    elif order.keys:
        rows = join_on(df, models_row, order.keys)
    else:
        sets = models_row.agg(F.collect_list(F.struct("*")).alias("m"))
        rows = df.withColumn("_m", F.explode(sets.scalar())).select(*[col_of(c) for c in df.columns], "_m.*")
    rows = with_basis(rows, order.time, "_t0", "_span")
    rows = rows.withColumn(name, F.transform("_betas", lambda b: dot(F.col("_x"), b)))
    return rows.drop("_x", "_t0", "_span", "_betas")


def impute(df: DataFrame, models: DataFrame, values: Sequence[str], order: Order) -> DataFrame:
    """Replace nulls of the modelled columns by the fitted value; ``values`` in the order of the fit."""
    fit = fitted_array(df, models, order)
    place = {c: i for i, c in enumerate(values)}
    return fit.select(*[F.coalesce(col_of(c).cast("double"), F.col("_fit")[place[c]]).alias(c) if c in place
                        else col_of(c) for c in df.columns])


def impute_category(df: DataFrame, column: str, levels: DataFrame) -> DataFrame:
    """Replace nulls of a category by the level in a one-row table, see ``mode_of``."""
    return df.withColumn(column, F.coalesce(col_of(column), levels.select(col_of(column)).scalar()))


def residuals(df: DataFrame, models: DataFrame, values: Sequence[str], order: Order, params: bool = False) -> DataFrame:
    """Every modelled column minus its fit."""
    fit = fitted_array(df, models, order, params=params)
    place = {c: i for i, c in enumerate(values)}
    extra = ["params_id"] if params else []
    return fit.select(*[(col_of(c) - F.col("_fit")[place[c]]).alias(c) if c in place else col_of(c)
                        for c in df.columns], *extra)


def decompose(df: DataFrame, models: DataFrame, y: str, order: Order) -> DataFrame:
    """``(keys, time, y, trend, yearly, weekly, daily, residual)`` of one variable."""
    own = models.filter((F.col("variable") == y) & (F.col("params_id") == 0))
    out = predict_decomposition(df.select(*order.key_columns(), *order.columns(), col_of(y).alias("y")), own,
                                order.time, order.keys)
    return out.select(*order.keys, order.time, "y", *COMPONENTS, (F.col("y") - F.col("yhat")).alias("residual"))
