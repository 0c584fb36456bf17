"""Least-squares fits from sums of cross products.

The data is read once and only matrices of model size move on.  Sums that need no neighbouring rows of few
series are taken where the rows are, partition by partition, without a shuffle.  For many series, or when
earlier rows are needed, rows are grouped into blocks of bounded size.  The sums of a series are then added up
in two levels, so that no task holds more than a few hundred of them for any realistic size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidecast.functions.timekeys import epoch_days
from tidecast.operators.attach import attach
from tidecast.operators.position import Order, halo_blocks, with_layout

BLOCK_ROWS = 16_384
FAN_IN = 256
FEW_SERIES = 64


def key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return "".join(f"`{k}` {kinds[k]}, " for k in keys)


def stack(cells: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(c, dtype=float) for c in cells])


def by_key(df: DataFrame, keys: Sequence[str], run: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Apply a function to every group of a model-sized table.

    Its rows are few bytes but costly to handle, so the number of tasks is fixed: adaptive execution, which
    goes by bytes, would put them all into one.
    """
    if keys:
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return df.groupBy(*keys).applyInPandas(run, schema)


def _merge(a: dict, b: dict, sums: Sequence[str], latest: Sequence[str], peaks: Sequence[str]) -> dict:
    """Add the ``sums``, take the larger ``peaks``, keep the ``latest`` columns of the later row."""
    out = dict(a)
    out.update({c: np.asarray(a[c]) + np.asarray(b[c]) for c in sums})
    out.update({c: max(a[c], b[c]) for c in peaks})
    if latest and b[latest[0]] > a[latest[0]]:
        out.update({c: b[c] for c in latest})
    return out


def add_up(parts: DataFrame, keys: Sequence[str], sums: Sequence[str], latest: Sequence[str] = (),
           peaks: Sequence[str] = ()) -> DataFrame:
    """First level: one row per key and run of ``FAN_IN`` blocks; columns that are not added are alike."""
    names = parts.columns

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        row = reduce(lambda a, b: _merge(a, b, sums, latest, peaks), pdf.to_dict("records"))
        row["_block"] = int(row["_block"]) // FAN_IN
        return pd.DataFrame([row])[names]

    runs = parts.withColumn("_run", F.floor(F.col("_block") / FAN_IN))
    return by_key(runs, [*keys, "_run"], lambda pdf: add(pdf[names]), parts.schema)


Partial = Callable[[dict[str, np.ndarray], dict[str, object]], list[dict]]


def as_arrays(table: pa.Table) -> dict[str, np.ndarray]:
    """Columns as numpy arrays, list columns as matrices, without an object per row."""
    out = {}
    for name in table.column_names:
        column = table.column(name).combine_chunks()
        if pa.types.is_list(column.type):
            there = column.is_valid().to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False).reshape(int(there.sum()), -1)
            out[name] = flat
            if not there.all():  # an array that is null as a whole is unknown in every place
                out[name] = np.full((len(column), flat.shape[1]), np.nan)
                out[name][there] = flat
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return out


def _sum_table(table: pa.Table, keys: Sequence[str], partial: Partial) -> list[dict]:
    home = {k: table.column(k)[0].as_py() for k in keys}
    return [{**home, **row} for row in partial(as_arrays(table), home)]


def _where_rows_are(keys: Sequence[str], partial: Partial, group: Sequence[str], sums: Sequence[str],
                    peaks: Sequence[str], size: int, schema: pa.Schema):
    """Running totals per key over the batches of a partition."""
    def run(batches):
        from pyspark import TaskContext

        waiting, held, totals = [], 0, {}

        def take():
            rows = pa.Table.from_batches(waiting)
            pieces = [rows]
            if keys:
                places = rows.select(list(keys)).to_pandas().groupby(list(keys), dropna=False, sort=False).indices
                pieces = [rows.take(pa.array(i)) for i in places.values()]
            for piece in pieces:
                for row in _sum_table(piece, keys, partial):
                    at = tuple(row[k] for k in group)
                    totals[at] = _merge(totals[at], row, sums, (), peaks) if at in totals else row

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                held += batch.num_rows
            if held >= size:
                take()
                waiting, held = [], 0
        if waiting:
            take()
        if totals:
            place = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([{**row, "_block": place} for row in totals.values()], schema)

    return run


def _per_block(keys: Sequence[str], partial: Partial, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        place = table.column("_block")[0].as_py()
        return pa.Table.from_pylist([{**row, "_block": place} for row in _sum_table(table, keys, partial)], schema)
    return run


def blocked_sums(df: DataFrame, order: Order, before: int, partial: Partial, schema: str, keys: Sequence[str],
                 sums: Sequence[str], latest: Sequence[str] = (), peaks: Sequence[str] = (),
                 block_rows: int | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run ``partial`` over the rows of every series and return few rows of sums per key.

    ``partial`` gets at most about ``block_rows`` rows of a series at once as arrays, with ``before`` earlier
    ones (``_home`` tells them apart), and returns rows of sums without the key columns.  ``prepare`` may use
    the first time ``_t0`` and the length ``_span`` of the row's series.
    """
    size = block_rows or BLOCK_ROWS
    full = StructType.fromDDL(key_schema(df, order.keys) + "_block long, " + schema)
    shape = to_arrow_schema(full)
    if before == 0 and order.keys and order.layout is None:
        order = with_layout(df, order)
    if before == 0 and (not order.keys or order.series <= FEW_SERIES):
        rows = prepare(_with_ends(df, order)) if prepare else df
        run = _where_rows_are(order.keys, partial, keys, sums, peaks, size, shape)
        return add_up(rows.mapInArrow(run, full), keys, sums, latest, peaks)
    blocked, parts = halo_blocks(df, order, before, 0, size, ends=prepare is not None)
    if prepare:
        blocked = prepare(blocked)
    out = blocked.groupBy(*parts).applyInArrow(_per_block(order.keys, partial, shape), full)
    few = order.longest is not None and order.longest <= size * FAN_IN
    return out if few else add_up(out, keys, sums, latest, peaks)


def _with_ends(df: DataFrame, order: Order) -> DataFrame:
    if order.layout is not None:
        ends = order.layout.filter("_start = 0").select(*order.layout_keys, "_t0", "_span")
        return attach(df, ends, order.layout_keys)
    days = epoch_days(order.time)
    ends = df.agg(F.min(days).alias("_t0"), (F.max(days) - F.min(days)).alias("_span"))
    return attach(df, ends)


def ridge(xx: np.ndarray, xy: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    own = np.diag(xx)  # the jitter follows each term's own size, not the penalties
    a = xx + np.diag(penalty + 1e-12 * np.maximum(own, 1e-12))
    size = np.sqrt(np.diag(a))
    try:
        beta = np.linalg.solve(a / np.outer(size, size), xy / size) / size
        if np.isfinite(beta).all():
            return beta
    except np.linalg.LinAlgError:
        pass
    return np.linalg.lstsq(a, xy, rcond=None)[0]


def lasso(xx: np.ndarray, xy: np.ndarray, weight: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Minimiser of ½ b'(xx)b - b'(xy) + Σ weight·|b|, exact up to rounding.

    Works on the set of non-zero terms and their signs: the term whose gradient exceeds its weight most joins, the
    quadratic of the set is solved, and the step ends where the objective is least among its end and the places where a
    sign would change.  Every step lowers the objective, so no set comes twice.
    """
    terms = len(xy)
    a = xx + np.diag(1e-10 * np.maximum(np.diag(xx), 1e-10))
    b = np.zeros(terms) if start is None else start.copy()
    slack = 1e-7 * max(np.abs(xy).max(initial=0.0), 1e-12) + 1e-7 * weight

    def cost(v: np.ndarray) -> float:
        return float(0.5 * v @ a @ v - v @ xy + weight @ np.abs(v))

    best = cost(b)
    while True:
        slope = a @ b - xy
        settled = np.abs(slope + weight * np.sign(b))[b != 0] <= slack[b != 0]
        signs = np.sign(b)
        if settled.all():
            excess = np.where(b == 0, np.abs(slope) - weight - slack, -np.inf)
            joins = int(excess.argmax())
            if excess[joins] <= 0:
                return b
            signs[joins] = -np.sign(slope[joins])
        held = np.flatnonzero(signs)
        goal = np.zeros(terms)
        part = a[np.ix_(held, held)]
        size = np.sqrt(np.diag(part))
        goal[held] = np.linalg.lstsq(part / np.outer(size, size), (xy - weight * signs)[held] / size, rcond=1e-13)[0] / size
        crossed = held[(b[held] != 0) & (goal[held] * b[held] < 0)]
        stops = [goal]
        for i in crossed:
            at = b + (goal - b) * (b[i] / (b[i] - goal[i]))
            at[i] = 0.0
            stops.append(at)
        costs = [cost(v) for v in stops]
        found = int(np.argmin(costs))
        if not costs[found] < best:
            return b
        b, best = stops[found], costs[found]
