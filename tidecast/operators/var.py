"""Multivariate models: principal components and vector autoregression, both from cross-product sums."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.timekeys import col_of
from tidecast.operators.attach import attach
from tidecast.operators.decompose import dot
from tidecast.operators.gram import blocked_sums, by_key, key_schema, stack
from tidecast.operators.position import Order, framed


#: Models that are advanced together.
TOGETHER = 256


def _moment_sums(cols: dict[str, np.ndarray], home: dict) -> list[dict]:
    x, shift = cols["_x"], cols["_c"][0]
    d = x[np.isfinite(x).all(axis=1)] - shift
    return [{"n": len(d), "centre": shift, "s": d.sum(axis=0), "ss": (d.T @ d).ravel()}]


def _components(keys: Sequence[str], min_eig: float):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].sum())
        s, ss = stack(pdf["s"]).sum(axis=0), stack(pdf["ss"]).sum(axis=0)
        k = len(s)
        shift = np.asarray(pdf["centre"].iloc[0], dtype=float)
        mean = s / max(n, 1)
        cov = ss.reshape(k, k) / max(n, 1) - np.outer(mean, mean)
        std = np.sqrt(np.maximum(np.diag(cov), 0.0))
        std = np.where(std > 1e-12 * (1 + np.abs(shift)), std, 1.0)
        eig, vec = np.linalg.eigh(cov / np.outer(std, std))
        eig, vec = eig[::-1] * n / max(n - 1, 1), vec[:, ::-1]
        kept = int((eig >= min_eig).sum())
        lead = np.abs(vec).argmax(axis=0)
        vec = vec * np.sign(vec[lead, range(k)])
        return pd.DataFrame([{**{c: pdf[c].iloc[0] for c in keys}, "n": n, "mean": mean + shift, "std": std,
                              "eigenvalues": eig, "loadings": [list(vec[:, i]) for i in range(kept)]}])
    return solve


def fit_components(df: DataFrame, columns: Sequence[str], order: Order, min_eig: float = 0.1,
                   block_rows: int | None = None) -> DataFrame:
    """Principal components of the standardised columns, one model row per key.

    Components with an eigenvalue of at least ``min_eig`` are kept; the largest loading of each is positive.
    """
    x = F.array(*[F.coalesce(col_of(c).cast("double"), F.lit(float("nan"))) for c in columns])
    centre = df.groupBy(*order.key_columns()).agg(F.array(*[F.avg(col_of(c)) for c in columns]).alias("_c"))
    rows = attach(df.select(*order.key_columns(), *order.columns(), x.alias("_x")), centre, order.keys)
    summed = blocked_sums(rows, order, 0, _moment_sums,
                          "n long, centre array<double>, s array<double>, ss array<double>", order.keys,
                          ("n", "s", "ss"), block_rows=block_rows)
    schema = key_schema(df, order.keys) + ("n long, mean array<double>, std array<double>, eigenvalues array<double>, "
                                           "loadings array<array<double>>")
    return by_key(summed, order.keys, _components(order.keys, min_eig), schema)


def reduce_features(df: DataFrame, keep: Sequence[str], others: Sequence[str], components: DataFrame | None,
                    order: Order, name: str = "z") -> DataFrame:
    """One array per row: the kept columns, then the components of the others."""
    kept = F.array(*[col_of(c).cast("double") for c in keep])
    base = [*order.key_columns(), *order.columns()]
    if components is None or not others:
        return df.select(*base, kept.alias(name))
    rows = attach(df, components.select(*order.keys, F.col("mean").alias("_mean"), F.col("std").alias("_std"),
                                        F.col("loadings").alias("_loadings")), order.keys)
    x = F.array(*[col_of(c).cast("double") for c in others])
    centred = F.zip_with(x, "_mean", lambda a, b: a - b)
    rows = rows.withColumn("_z", F.zip_with(centred, F.col("_std"), lambda a, b: a / b))
    return rows.select(*base, F.concat(kept, F.transform("_loadings", lambda v: dot(v, F.col("_z")))).alias(name))


def _lag_sums(sort: Sequence[str], p: int):
    def partial(cols: dict[str, np.ndarray], home: dict) -> list[dict]:
        at = pd.DataFrame({c: cols[c] for c in sort}).sort_values(list(sort)).index.to_numpy()
        z, owned = cols["_z"][at], cols["_home"][at].astype(bool)
        n, k = z.shape
        x, y = np.zeros((0, 1 + k * p)), np.zeros((0, k))
        if n > p:
            x = np.hstack([np.ones((n - p, 1))] + [z[p - i:n - i] for i in range(1, p + 1)])[owned[p:]]
            y = z[p:][owned[p:]]
            whole = np.isfinite(x).all(1) & np.isfinite(y).all(1)  # rows with a gap in their lags are left out
            x, y = x[whole], y[whole]
        z = pd.DataFrame(z).ffill().fillna(0.0).to_numpy()  # a forecast starts from the last known values
        return [{"n_vars": k, "n": len(x), "xx": (x.T @ x).ravel(), "xy": (x.T @ y).ravel(),
                 "last_time": pd.Timestamp(cols[sort[0]][at[-1]]).to_pydatetime(), "context": [list(v) for v in z[::-1][:p]]}]
    return partial


def companion_radius(coefs: np.ndarray, k: int, p: int) -> float:
    """Largest root modulus; forecasts diverge when it is above one."""
    a = np.zeros((k * p, k * p))
    a[:k] = coefs[:, 1:]
    if p > 1:
        a[k:, :-k] = np.eye(k * (p - 1))
    return float(np.abs(np.linalg.eigvals(a)).max()) if k else 0.0


def _solve_var(keys: Sequence[str], p: int):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        k, newest = int(pdf["n_vars"].iloc[0]), pdf["last_time"].argmax()
        m = 1 + k * p
        xx, xy = stack(pdf["xx"]).sum(axis=0).reshape(m, m), stack(pdf["xy"]).sum(axis=0).reshape(m, k)
        size = np.sqrt(np.maximum(np.diag(xx), 1e-300))
        coefs = (np.linalg.lstsq(xx / np.outer(size, size), xy / size[:, None], rcond=1e-13)[0] / size[:, None]).T
        return pd.DataFrame([{**{c: pdf[c].iloc[0] for c in keys}, "n_vars": k, "n_lags": p, "n": int(pdf["n"].sum()),
                              "coefs": [list(r) for r in coefs], "radius": companion_radius(coefs, k, p),
                              "context": pdf["context"].iloc[newest], "last_time": pdf["last_time"].iloc[newest]}])
    return solve


def fit_var(df: DataFrame, z: str, order: Order, p: int = 1, block_rows: int | None = None) -> DataFrame:
    """Vector autoregression of order p with intercept by least squares, one model row per key.

    ``coefs[i]`` holds the intercept and the weights on all variables at lag 1, then lag 2, … for variable i;
    ``context`` the last p rows, newest first.
    """
    rows = df.select(*order.key_columns(), *order.columns(), col_of(z).alias("_z"))
    sort = [order.time, *order.ties]
    moment = dict(df.dtypes)[order.time]
    summed = blocked_sums(rows, order, p, _lag_sums(sort, p),
                          f"n_vars int, n long, xx array<double>, xy array<double>, last_time {moment}, "
                          "context array<array<double>>", order.keys, ("n", "xx", "xy"), ("last_time", "context"),
                          block_rows=block_rows)
    schema = key_schema(df, order.keys) + ("n_vars int, n_lags int, n long, coefs array<array<double>>, radius double, "
                                           f"context array<array<double>>, last_time {moment}")
    return by_key(summed, order.keys, _solve_var(order.keys, p), schema)


def forecast_var(models: DataFrame, keys: Sequence[str], steps: int | str) -> DataFrame:
    """Run the recursion; ``(keys, step, value)`` of the first variable for steps 1, 2, …

    ``steps`` is a number or a column of the model table.  Works on model rows alone, without a shuffle; models of equal
    shape are advanced together.
    """
    rows = models.select(*keys, "n_lags", "coefs", "context",
                         (F.lit(steps) if isinstance(steps, int) else col_of(steps)).cast("int").alias("_steps"))

    def run(batches):
        for pdf in batches:
            shapes = pdf.groupby([pdf["coefs"].map(len), "n_lags"], sort=False).indices
            for (k, p), places in shapes.items():
                for at in np.array_split(places, max(1, len(places) // TOGETHER)):
                    yield from together(pdf.iloc[at], int(k), int(p))

    def together(models: pd.DataFrame, k: int, p: int):
        """Models of one shape: one product per step for all of them; longer forecasts go on alone."""
        models = models.sort_values("_steps", ascending=False, kind="stable")
        steps = models["_steps"].to_numpy()
        coefs = np.array([[np.asarray(r, dtype=float) for r in c] for c in models["coefs"]]).reshape(len(models), k, 1 + k * p)
        state = np.array([np.concatenate([np.asarray(v, dtype=float) for v in c][:p]) for c in models["context"]]).reshape(len(models), k * p)
        out = np.empty((max(int(steps[0]), 0), len(models)))
        for t in range(len(out)):
            live = int(np.searchsorted(-steps, -t, side="left"))  # models that go further than step t
            new = coefs[:live, :, 0] + np.matmul(coefs[:live, :, 1:], state[:live, :, None])[:, :, 0]
            state[:live] = np.concatenate([new, state[:live, :k * (p - 1)]], axis=1)
            out[t, :live] = new[:, 0]
        for i in range(len(models)):
            n = max(int(steps[i]), 0)
            yield pd.DataFrame({**{c: [models[c].iloc[i]] * n for c in keys}, "step": np.arange(1, n + 1, dtype="int32"), "value": out[:n, i]})

    return rows.mapInPandas(run, key_schema(models, keys) + "step int, value double")


def one_step(lags: Sequence[str], coefs: Column) -> Column:
    """Predicted vector from the columns holding the vectors at lag 1, 2, …"""
    x = F.concat(F.array(F.lit(1.0)), *[F.col(c) for c in lags])
    return F.transform(coefs, lambda row: dot(row, x))


def squared_errors(df: DataFrame, z: str, var_models: DataFrame, order: Order, p: int = 1, name: str = "e2",
                   block_rows: int | None = None) -> DataFrame:
    """Squared one-step errors of every variable; the first p rows have none and are left out."""
    lags = [f"_lag{i}" for i in range(1, p + 1)]

    def build(rows: DataFrame, window, block) -> DataFrame:
        return rows.withColumns({c: F.lag(col_of(z), i + 1).over(window) for i, c in enumerate(lags)})

    rows = framed(df.select(*order.key_columns(), *order.columns(), col_of(z)), order, p, 0, build, block_rows)
    rows = attach(rows.filter(F.col(lags[-1]).isNotNull()), var_models.select(*order.keys, F.col("coefs").alias("_coefs")),
                  order.keys)
    rows = rows.withColumn("_pred", one_step(lags, F.col("_coefs")))
    error = F.zip_with(col_of(z), F.col("_pred"), lambda a, b: (a - b) * (a - b))
    return rows.select(*order.key_columns(), *order.columns(), error.alias(name))
