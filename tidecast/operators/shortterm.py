"""Day-ahead forecasts: at every row the last S rows of all variables predict the target H rows later.

A direct linear regression on lagged values, trailing means and calendar terms, fitted for a set of
bootstrap weights at once; the spread of the members gives the variance.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.timekeys import col_of
from tidecast.operators.attach import attach, join_on
from tidecast.operators.decompose import dot
from tidecast.operators.gram import blocked_sums, by_key, key_schema, ridge, stack
from tidecast.operators.position import Order, framed, order_index, partner, with_position
from tidecast.operators.windows import trailing_columns
from tidecast.session import write_scratch
from tidecast.sources import store

DAY_ROWS = 24
OFFSETS = (0, 1, 2, 24, 144)


@dataclass(frozen=True)
class ShortModel:
    """``members`` holds per key the coefficients of all members and the training ranges."""

    members: DataFrame
    target: str
    predictors: tuple[str, ...]
    length: int
    horizon: int
    day_rows: int = DAY_ROWS

    @property
    def columns(self) -> list[str]:
        return [self.target, *self.predictors]

    def offsets(self) -> list[int]:
        return [o for o in OFFSETS if o < self.length]

    def widths(self) -> list[int]:
        return sorted({min(self.day_rows, self.length), self.length})

    def terms(self) -> int:
        """Terms a variable contributes."""
        return len(self.offsets()) + len(self.widths())

    def save(self, path: str) -> int:
        """Publish the model in a store; returns the version, see ``store.publish``."""
        settings = {n: getattr(self, n) for n in ("target", "predictors", "length", "horizon", "day_rows")}
        return store.publish("short", {"members": self.members}, settings, path, self.members.sparkSession)


def load_short(spark: SparkSession, path: str, version: int | None = None) -> ShortModel:
    """A stored model, from its folder alone; by default the newest version."""
    tables, known = store.fetch("short", path, spark, version)
    return ShortModel(tables["members"], **{**known, "predictors": tuple(known["predictors"])})


def calendar_terms(time: str) -> str:
    """Sine and cosine pairs of the hour, the weekday and the day of the year, as SQL."""
    turns = [(f"hour(`{time}`) / 24D", 2), (f"weekday(`{time}`) / 7D", 3), (f"dayofyear(`{time}`) / 365.25D", 2)]
    return ", ".join(f"{fn}(2 * pi() * {i} * {turn})" for turn, pairs in turns for i in range(1, pairs + 1)
                     for fn in ("sin", "cos"))


def samples(df: DataFrame, spec: ShortModel, order: Order, sets: Sequence[Sequence[str]],
            block_rows: int | None = None) -> DataFrame:
    """One row per sample: its time, target time and actual value, and per column set ``x0``, ``x1``, …
    the terms of the set's columns.  A series of N rows gives N-(S+H-1) samples.
    """
    names = list(dict.fromkeys(c for s in sets for c in s))

    def build(rows: DataFrame, window, block) -> DataFrame:
        rows = trailing_columns(rows, order, {f"_m{w}_{c}": (c, w) for c in names for w in spec.widths()}, 32)
        now = F.expr("array(" + ", ".join(f"cast(`{c}` AS double)" for c in names) + ")")
        return rows.withColumn("_now", now).withColumns({
            **{f"_lag{o}": F.lag("_now", o).over(window) for o in spec.offsets()},
            "_ahead": F.lead(col_of(order.time), spec.horizon).over(window),
            "_actual": F.lead(col_of(spec.target), spec.horizon).over(window),
            "_seen": F.count(F.lit(1)).over(window.rowsBetween(-(spec.length - 1), 0))})

    rows = framed(df, order, spec.length, spec.horizon, build, block_rows)
    rows = rows.filter((F.col("_seen") == spec.length) & F.col("_ahead").isNotNull())

    def terms(columns: Sequence[str]) -> Column:
        return F.expr("array(" + ", ".join(t for c in columns for t in (
            *[f"_lag{o}[{names.index(c)}]" for o in spec.offsets()], *[f"`_m{w}_{c}`" for w in spec.widths()])) + ")")

    bucket = ["_bucket"] if "_bucket" in df.columns else []
    return rows.select(*order.key_columns(), *order.columns(), *bucket, F.col("_ahead").alias("target_time"),
                       F.col("_actual").cast("double").alias("actual"),
                       *[terms(s).alias(f"x{i}") for i, s in enumerate(sets)])


def _scaled_terms(spec: ShortModel, x: str) -> Column:
    """Terms brought to the training range of their variable."""
    repeat = spec.terms()
    low = F.flatten(F.transform("lows", lambda v: F.array_repeat(v, repeat)))
    span = F.flatten(F.transform("spans", lambda v: F.array_repeat(v, repeat)))
    return F.zip_with(F.zip_with(F.col(x), low, lambda a, b: a - b), span, lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0)))


def _design(spec: ShortModel, x: str) -> Column:
    return F.concat(_scaled_terms(spec, x), F.expr(f"array(1D, {calendar_terms('target_time')})"))


def poisson_weights(hashes: np.ndarray, member: int) -> np.ndarray:
    """Poisson(1) draws fixed by a row's hash and the member, so a re-run task draws the same."""
    with np.errstate(over="ignore"):
        x = hashes.astype(np.uint64) + np.uint64(member + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    u = (x >> np.uint64(11)).astype(float) / float(1 << 53)
    steps = np.exp(-1.0) * np.cumsum(1 / np.cumprod([1.0, 1, 2, 3, 4, 5, 6, 7, 8]))
    return np.searchsorted(steps, u, side="right").astype(float)


def _member_sums(members: int):
    def partial(cols: dict[str, np.ndarray], home: dict) -> list[dict]:
        x, y = cols["_x"], cols["_y"]
        known = ~(np.isnan(x).any(axis=1) | np.isnan(y))
        x, y, h, rows = x[known], y[known], cols["_h"][known], []
        for m in range(members):
            w = poisson_weights(h, m) if members > 1 else np.ones(len(y))
            xw = x * w[:, None]
            rows.append({"member": m, "n": float(w.sum()), "xx": (xw.T @ x).ravel(), "xy": xw.T @ y})
        return rows
    return partial


def _solve_member(keys: Sequence[str], penalty: float):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        xy = stack(pdf["xy"]).sum(axis=0)
        xx = stack(pdf["xx"]).sum(axis=0).reshape(len(xy), len(xy))
        beta = ridge(xx, xy, np.full(len(xy), penalty * max(float(pdf["n"].sum()), 1.0)))
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "member": int(pdf["member"].iloc[0]), "beta": beta}])
    return solve


def fit_short(df: DataFrame, order: Order, target: str, predictors: Sequence[str], length: int, horizon: int = 24,
              n_models: int = 20, penalty: float = 1e-4, seed: int = 7, day_rows: int = DAY_ROWS,
              block_rows: int | None = None) -> ShortModel:
    """Fit all members in one pass over the samples."""
    spec = ShortModel(df, target, tuple(predictors), length, horizon, day_rows)
    ranges = df.groupBy(*order.key_columns()).agg(
        F.array(*[F.min(col_of(c)).cast("double") for c in spec.columns]).alias("lows"),
        F.array(*[(F.max(col_of(c)) - F.min(col_of(c))).cast("double") for c in spec.columns]).alias("spans"))
    base = df.select(*order.key_columns(), *order.columns(), *[col_of(c) for c in spec.columns])
    base, order = order_index(base, order)
    rows = attach(samples(base, spec, order, [spec.columns], block_rows), ranges, order.keys)
    y = F.coalesce(F.try_divide(F.col("actual") - F.col("lows")[0], F.col("spans")[0]), F.lit(0.0))
    nan = F.lit(float("nan"))
    rows = rows.select(*order.key_columns(), *order.columns(), "_bucket",
                       F.transform(_design(spec, "x0"), lambda v: F.coalesce(v, nan)).alias("_x"),
                       F.coalesce(F.when(F.col("actual").isNotNull(), y), nan).alias("_y"),
                       F.xxhash64(F.lit(seed), *order.columns()).alias("_h"))
    keys = [*order.keys, "member"]
    summed = blocked_sums(rows, order, 0, _member_sums(n_models),
                          "member int, n double, xx array<double>, xy array<double>", keys, ("n", "xx", "xy"),
                          block_rows=block_rows)
    solved = by_key(summed, keys, _solve_member(order.keys, penalty),
                    key_schema(df, order.keys) + "member int, beta array<double>")
    ordered = F.array_sort(F.collect_list(F.struct("member", "beta")))
    betas = solved.groupBy(*order.keys).agg(F.transform(ordered, lambda m: m.getField("beta")).alias("betas"))
    members = write_scratch(attach(betas, ranges, order.keys), "members")
    return ShortModel(members, target, tuple(predictors), length, horizon, day_rows)


def check_columns(df: DataFrame, model: ShortModel, order: Order) -> None:
    given = [c for c in df.columns if c not in (*order.keys, order.time, *order.ties)]
    if given != model.columns:
        raise ValueError(f"the columns {given} are not those of the fit, {model.columns}")


def check_size(df: DataFrame, model: ShortModel, order: Order, expected_rows: int) -> None:
    lost = model.length + model.horizon - 1
    sizes = df.groupBy(*order.key_columns()).count()
    n = sizes.agg(F.sum(F.greatest(F.col("count") - lost, F.lit(0)))).first()[0] or 0
    if n != expected_rows:
        raise ValueError(f"{n} forecasts would be made, {expected_rows} were expected")


def forecast_short(df: DataFrame, model: ShortModel, order: Order, expected_rows: int | None = None,
                   block_rows: int | None = None) -> DataFrame:
    """``(keys, time, point_forecast, variance_forecast)`` of the row H rows after each full window."""
    check_columns(df, model, order)
    if expected_rows is not None:
        check_size(df, model, order, expected_rows)
    rows = attach(samples(df, model, order, [model.columns], block_rows), model.members, order.keys)
    rows = rows.withColumn("_x", _design(model, "x0"))
    rows = rows.withColumn("_p", F.transform("betas", lambda b: dot(F.col("_x"), b)))
    n = F.size("_p")
    rows = rows.withColumn("_mean", F.aggregate("_p", F.lit(0.0), lambda s, v: s + v) / n)
    spread = F.aggregate("_p", F.lit(0.0), lambda s, v: s + (v - F.col("_mean")) * (v - F.col("_mean")))
    span = F.col("spans")[0]
    return rows.select(*order.key_columns(), F.col("target_time").alias(order.time),
                       (F.col("_mean") * span + F.col("lows")[0]).alias("point_forecast"),
                       (F.coalesce(F.try_divide(spread, n - 1), F.lit(0.0)) * span * span).alias("variance_forecast"))


def permuted(df: DataFrame, columns: Sequence[str], order: Order, seed: int) -> DataFrame:
    """Add ``perm_column``: the values of another row of the series, whose position is computed (``position.partner``)."""
    placed = with_position(df, order, "_pos", "_rows")
    placed = placed.withColumn("_other", partner(F.col("_pos"), F.col("_rows"), seed))
    drawn = placed.select(*order.key_columns(), F.col("_pos").alias("_other"), *[col_of(c).alias(f"perm_{c}") for c in columns])
    return join_on(placed, drawn, [*order.keys, "_other"]).drop("_pos", "_rows", "_other")


def permutation_importance(df: DataFrame, model: ShortModel, order: Order, seed: int = 11,
                           block_rows: int | None = None) -> DataFrame:
    """``(variable, mse, delta, importance)``: how much the error grows when one variable is shuffled.

    The forecast is linear in the terms, so exchanging a variable changes it by the exchanged terms only:
    one pass gives the error for every variable.
    """
    check_columns(df, model, order)
    rows, order = order_index(df, order)  # sorted and stored once, for the positions and the windows
    both = permuted(rows, model.columns, order, seed)
    shuffled = [f"perm_{c}" for c in model.columns]
    rows = attach(samples(both, model, order, [model.columns, shuffled], block_rows), model.members, order.keys)
    rows = rows.withColumn("_x", _design(model, "x0")).withColumn("_y", _design(model, "x1"))
    summed = F.aggregate("betas", F.transform(F.col("betas")[0], lambda v: v * 0.0),
                         lambda s, b: F.zip_with(s, b, lambda u, v: u + v))
    rows = rows.withColumn("_beta", F.transform(summed, lambda v: v / F.size("betas")))
    span, low, k = F.col("spans")[0], F.col("lows")[0], model.terms()
    rows = rows.withColumn("_full", dot(F.col("_x"), F.col("_beta")))

    def moved(i: int) -> Column:
        part = [F.slice(c, i * k + 1, k) for c in ("_x", "_y", "_beta")]
        return dot(F.zip_with(part[1], part[0], lambda a, b: a - b), part[2])

    def mse(scaled: Column) -> Column:
        return F.avg(F.pow(F.col("actual") - (scaled * span + low), F.lit(2)))

    sums = rows.agg(mse(F.col("_full")).alias("_base"),
                    *[mse(F.col("_full") + moved(i)).alias(f"_mse{i}") for i in range(len(model.columns))])
    long = sums.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"_mse{i}").alias("mse"),
                 (F.col(f"_mse{i}") - F.col("_base")).alias("delta")) for i, c in enumerate(model.columns)])))
    return importance_shares(long)


def importance_shares(deltas: DataFrame, digits: int = 2) -> DataFrame:
    """Error growths minus their smallest, divided by their sum, rounded."""
    low = deltas.agg(F.min("delta").alias("low"), F.sum("delta").alias("sum"), F.count(F.lit(1)).alias("n"))
    out = attach(deltas, low)
    share = F.try_divide(F.col("delta") - F.col("low"), F.col("sum") - F.col("n") * F.col("low"))
    return out.select(*[col_of(c) for c in deltas.columns], F.round(share, digits).alias("importance"))
