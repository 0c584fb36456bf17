"""Rows with null keys or times stay; spikes, NaN and gaps only reach the frames they are in."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series_tables import frame, hours

from tidecast.operators import evaluate, windows
from tidecast.operators.position import Order, with_position
from tidecast.operators.var import fit_var


def plain_flags(y, n, p=0.001):
    from statistics import NormalDist

    limit, half, out = NormalDist().inv_cdf(1 - p / 2), n // 2, np.zeros(len(y), bool)
    known = np.flatnonzero(~np.isnan(y))
    v = y[known]
    for i in range(half, len(v) - half):
        part = v[i - half:i + half + 1]
        sd = np.sqrt(np.mean((part - part.mean()) ** 2))
        out[known[i]] = sd > 0 and abs(v[i] - part.mean()) / sd >= limit
    return out


@pytest.mark.parametrize("spike", [1e6, 1e12])
def test_spikes_and_nan_stay_in_their_frames(spark, spike):
    y = np.random.default_rng(4).normal(0, 1, 900)
    y[150], y[600] = spike, 9.0
    pdf = pd.DataFrame({"time": hours(900), "y": y})
    df = frame(spark, pdf).withColumn("y", F.when(F.col("time") == pdf.time[300], float("nan")).otherwise(F.col("y")))
    y[300] = np.nan
    order = Order("time")
    got = windows.detect_outliers(df, "y", order, n=200, block_rows=300).orderBy("time").toPandas()
    assert len(got) == 900 and (got.is_outlier.to_numpy() == plain_flags(y, 200)).all() and got.is_outlier[600]
    for w in (20, 300):
        means = windows.trailing_mean(df, "y", w, order, block_rows=320).orderBy("time").toPandas().trailing_mean.to_numpy()
        want = pd.Series(y).rolling(w, min_periods=w).apply(np.mean, raw=True).to_numpy()
        assert (np.isnan(means) == np.isnan(want)).all() and np.allclose(means, want, rtol=1e-9, atol=1e-9, equal_nan=True)


def test_null_keys_and_times_keep_their_rows(spark):
    pdf = pd.DataFrame({"time": [*hours(40), *hours(40), *hours(40)], "k": ["a"] * 40 + [None] * 40 + ["b"] * 40, "y": np.arange(120.0)})
    df = frame(spark, pdf).withColumn("time", F.when(F.col("y") == 5, None).otherwise(F.col("time")))
    order = Order("time", ("k",), ("y",))
    for out in (with_position(df, order), windows.trailing_mean(df, "y", 3, order), windows.split_holdout(df, order, 0.25),
                windows.with_lags(df, ["y"], 2, order), windows.detect_outliers(df, "y", order, n=4), windows.remove_outliers(df, ["y"], order, n=4),
                windows.expanding_folds(df, order, 3), windows.backfill(df, ["y"], order)):
        assert out.count() == 120
    placed = with_position(df, order).filter("k IS NULL").orderBy("time").toPandas()
    assert placed.pos.tolist() == list(range(40))


def test_signed_rank_with_zeros_is_normal(spark):
    d = [0.0] * 5 + [1.0, -2.0, 3.0, 4.0, 5.0, 6.0]
    got = evaluate.wilcoxon(spark.createDataFrame([(x, 0.0) for x in d], "a double, b double"), "a", "b").first()
    assert got.n == 6 and got.p_value == pytest.approx(0.0747355, abs=1e-6)


def test_autoregression_leaves_gaps_out(spark):
    z = np.zeros(300)
    r = np.random.default_rng(2)
    for i in range(1, 300):
        z[i] = 0.6 * z[i - 1] + r.normal()
    z[100] = np.nan
    pdf = pd.DataFrame({"time": hours(300), "y": z})
    df = frame(spark, pdf).select("time", F.array(F.col("y")).alias("z"))
    model = fit_var(df, "z", Order("time"), 1).first().asDict()
    x, y = z[:-1], z[1:]
    ok = ~np.isnan(x) & ~np.isnan(y)
    want = np.linalg.lstsq(np.c_[np.ones(ok.sum()), x[ok]], y[ok], rcond=None)[0]
    assert np.allclose(np.ravel(model.get("coefs") or model.get("beta")), want, atol=1e-6)


@pytest.mark.parametrize("w", [20, 250, 256, 257, 300])
def test_infinite_values_enter_no_frame(spark, w):
    y = np.random.default_rng(8).normal(0, 1, 1500)
    y[400], y[900], y[901] = np.inf, -np.inf, np.nan
    known = np.where(np.isfinite(y), y, np.nan)
    df = spark.createDataFrame([(t.to_pydatetime(), float(v)) for t, v in zip(hours(1500), y)], "time timestamp_ntz, y double").repartition(4)
    order = Order("time")
    means = windows.trailing_mean(df, "y", w, order, block_rows=400).orderBy("time").toPandas().trailing_mean.to_numpy()
    want = pd.Series(known).rolling(w, min_periods=w).apply(np.mean, raw=True).to_numpy()
    assert np.allclose(means, want, rtol=1e-9, atol=1e-9, equal_nan=True)
    for side, infinite in (("both", [400, 900]), ("low", [900])):
        flags = windows.detect_outliers(df, "y", order, n=200, side=side, block_rows=400).orderBy("time").toPandas().is_outlier.to_numpy()
        assert flags[infinite].all() and not flags[901]
        if side == "both":
            rest = np.delete(np.arange(1500), [400, 900])
            assert (flags[rest] == plain_flags(known, 200)[rest]).all()
    kept = windows.remove_outliers(df, ["y"], order, n=200, block_rows=400).filter("y IS NULL").count()
    assert kept == (plain_flags(known, 200).sum() + 2)


def test_one_infinite_value_does_not_spoil_a_fit(spark):
    from tidecast.operators import decompose

    y = [10 + 0.01 * i for i in range(600)]
    rows = [(t.to_pydatetime(), v, float("inf") if i == 300 else v) for i, (t, v) in enumerate(zip(hours(600), y))]
    df = spark.createDataFrame(rows, "time timestamp_ntz, y double, z double")
    fits = {r.variable: r for r in decompose.fit_decomposition(df, Order("time"), ["y", "z"]).collect()}
    assert fits["z"].n == 599 and np.allclose(fits["y"].beta, fits["z"].beta, atol=1e-3)


def test_quantiles_and_signed_ranks_leave_nan_out(spark):
    from tidecast.operators import describe

    v = np.random.default_rng(3).normal(0, 1, 40_001)
    df = spark.createDataFrame(pd.DataFrame({"v": [*v, np.nan, np.nan]})).union(spark.createDataFrame([(None,)], "v double"))
    assert describe.quantiles(df, "v", (0.5, 0.9)).first()[:] == pytest.approx(tuple(np.quantile(v, [0.5, 0.9])))
    pairs = spark.createDataFrame([(float(i), 0.5) for i in range(20)] + [(float("nan"), 1.0), (None, 1.0)], "a double, b double")
    assert evaluate.wilcoxon(pairs, "a", "b").first().n == 20
