from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series_tables import frame, hours, seasonal

from tidecast.operators import decompose, describe, evaluate, forecast, gram, shortterm, var
from tidecast.operators.decompose import Penalties
from tidecast.operators.position import Order
from tidecast.plans import prepare
from tidecast.sources import store

ORDER = Order("time", ("k",))


def two_series(n=1200):
    a = pd.DataFrame({"k": "a", "time": hours(n), "y": seasonal(n, 1), "x": seasonal(n, 2, -0.02)})
    b = pd.DataFrame({"k": "b", "time": hours(n // 2), "y": 3 * seasonal(n // 2, 3), "x": seasonal(n // 2, 4)})
    return pd.concat([a, b], ignore_index=True)


def direct_fit(g, y, p=Penalties()):
    days = g.time.astype("int64").to_numpy() / 8.64e13
    x = decompose.design(days, (days - days.min()) / (days.max() - days.min()))
    scale = np.nanmax(np.abs(y))
    known = ~np.isnan(y)
    xk, yk = x[known], y[known] / scale
    shape = np.zeros(decompose.TERMS)
    shape[2:decompose.TREND_TERMS] = p.changepoint_prior_scale ** -2
    shape[decompose.TREND_TERMS:] = p.seasonality_prior_scale ** -2
    noise = 0.01
    for _ in range(20):
        beta = np.linalg.lstsq(xk.T @ xk + noise * np.diag(shape), xk.T @ yk, rcond=None)[0]
        noise = max(np.mean((yk - xk @ beta) ** 2), 1e-10)
    return x @ beta * scale


@pytest.mark.parametrize("partitions,block,few", [(1, 100_000, 64), (37, 90, 64), (5, 300, 0), (37, 3, 0)])
def test_decomposition_matches_a_direct_solve(spark, monkeypatch, partitions, block, few):
    monkeypatch.setattr(gram, "FEW_SERIES", few)
    monkeypatch.setattr(gram, "FAN_IN", 4)
    pdf = two_series()
    pdf.loc[30:60, "y"] = np.nan
    df = frame(spark, pdf, partitions)
    models = decompose.fit_decomposition(df, ORDER, ["y", "x"], block_rows=block)
    out = decompose.predict_decomposition(df.select("k", "time"), models, "time", ("k",)).toPandas()
    assert len(out) == 2 * len(pdf)
    for name, g in pdf.groupby("k"):
        for v in ("y", "x"):
            got = out[(out.k == name) & (out.variable == v)].sort_values("time")
            want = direct_fit(g, g[v].to_numpy())
            np.testing.assert_allclose(got.yhat, want, rtol=1e-5)
            np.testing.assert_allclose(got[decompose.COMPONENTS].sum(axis=1), got.yhat, rtol=1e-9)


def plain_lasso(xx, xy, weight, sweeps=20_000):
    b = np.zeros(len(xy))
    for _ in range(sweeps):
        for i in range(len(b)):
            r = xy[i] - xx[i] @ b + xx[i, i] * b[i]
            b[i] = np.sign(r) * max(abs(r) - weight[i], 0) / xx[i, i]
    return b


@pytest.mark.parametrize("seed,terms,weight", [(0, 5, 3.0), (1, 8, 20.0), (2, 8, 0.01), (3, 6, 1e9)])
def test_lasso_matches_coordinate_descent(seed, terms, weight):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, terms)) + rng.normal(size=(60, 1))
    y = x[:, 0] * 2 - x[:, 1] + rng.normal(size=60)
    weights = weight * rng.uniform(0.5, 1.5, terms)
    want = plain_lasso(x.T @ x, x.T @ y, weights, 2_000)
    for start in (None, rng.normal(size=terms)):
        got = gram.lasso(x.T @ x, x.T @ y, weights, start)
        np.testing.assert_allclose(got, want, atol=1e-6)
        assert ((got == 0) == (want == 0)).all()


def test_lasso_of_repeated_and_empty_terms():
    x = np.random.default_rng(4).normal(size=(30, 1)) @ np.ones((1, 3))
    b = gram.lasso(x.T @ x, x.T @ x[:, 0], np.full(3, 0.5))
    slope = x.T @ x @ b - x.T @ x[:, 0]
    assert np.all(np.abs(slope) <= 0.5 + 1e-4) and b.sum() == pytest.approx(1 - 0.5 / (x[:, 0] @ x[:, 0]), abs=1e-4)
    assert (gram.lasso(np.zeros((3, 3)), np.zeros(3), np.ones(3)) == 0).all()


def test_sparse_trend_turns_where_the_series_does(spark):
    n = 24 * 300
    t = np.arange(n)
    season = 5 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(6).normal(0, 1, n)
    broken = pd.DataFrame({"k": "a", "time": hours(n), "y": 100 + 0.05 * np.maximum(0, t - 0.4 * n) + season})
    level = pd.DataFrame({"k": "b", "time": hours(n), "y": 100 + season})
    unknown = pd.DataFrame({"k": "c", "time": hours(50), "y": np.nan})
    df = frame(spark, pd.concat([broken, level, unknown], ignore_index=True))
    models = decompose.fit_decomposition(df, ORDER, ["y"], [Penalties(), Penalties(sparse=True)])
    changes = decompose.trend_changes(models, ["k"]).toPandas()
    sparse = changes[changes.params_id == 1]
    assert set(sparse.k) == {"a"} and 1 <= len(sparse) <= 3
    assert len(changes[(changes.params_id == 0) & (changes.k == "a")]) == decompose.CHANGEPOINTS
    assert sparse.change.sum() == pytest.approx(0.05 * 24, rel=0.1)
    off = (sparse.time - hours(n)[int(0.4 * n)]).abs() / pd.Timedelta(days=1)
    assert (off < 30).all()
    out = decompose.decompose(df, models.filter("params_id = 1").withColumn("params_id", F.lit(0)), "y", ORDER).toPandas()
    assert out[out.k == "a"].residual.std() < 1.2


def test_decomposition_recovers_daily_shape(spark):
    n = 24 * 90
    pdf = pd.DataFrame({"time": hours(n), "y": seasonal(n, 5)})
    order = Order("time")
    df = frame(spark, pdf)
    models = decompose.fit_decomposition(df, order, ["y"], [Penalties(0.05, 1.0)])
    out = decompose.decompose(df, models, "y", order).toPandas().sort_values("time")
    t = np.arange(n)
    assert np.abs(out.daily - 10 * np.sin(2 * np.pi * t / 24)).max() < 0.5
    assert np.abs(out.weekly - 5 * np.cos(2 * np.pi * (t % 168) / 168)).max() < 0.6
    assert out.residual.std() < 1.1
    shares = describe.component_contributions(spark.createDataFrame(out)).toPandas()
    assert shares.sum(axis=1)[0] == pytest.approx(1)


def test_impute_fills_only_nulls(spark):
    pdf = two_series()
    pdf.loc[100:120, "y"] = np.nan
    df = frame(spark, pdf)
    models = decompose.fit_decomposition(df, ORDER, ["y", "x"])
    out = decompose.impute(df, models, ["y", "x"], ORDER).toPandas().sort_values(["k", "time"]).reset_index(drop=True)
    assert out[["y", "x"]].notna().all().all()
    known = pdf.y.notna()
    np.testing.assert_array_equal(out.y[known], pdf.y[known])
    assert np.abs(out.y[~known] - (100 + 0.01 * np.arange(100, 121))).max() < 25


def test_poly_fit(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(1000, 1100, 400)
    y = 3 - 2 * x + 0.5 * x ** 2 - 0.001 * x ** 3
    out = describe.poly_fit(frame(spark, pd.DataFrame({"x": x, "y": y})), "x", "y", 3).orderBy("power").toPandas()
    np.testing.assert_allclose(np.polyval(out.coefficient[::-1], x), y, rtol=1e-6)


@pytest.mark.parametrize("p,block", [(1, 100_000), (2, 200), (3, 77)])
def test_var_recovers_coefficients(spark, p, block):
    rng = np.random.default_rng(4)
    n, k = 4000, 3
    a = [rng.uniform(-0.3, 0.3, (k, k)) / (i + 1) for i in range(p)]
    c = np.array([1.0, -2.0, 0.5])
    z = np.zeros((n, k))
    for t in range(p, n):
        z[t] = c + sum(a[i] @ z[t - 1 - i] for i in range(p)) + rng.normal(0, 0.1, k)
    pdf = pd.DataFrame({"time": hours(n), **{f"z{i}": z[:, i] for i in range(k)}})
    order = Order("time")
    df = frame(spark, pdf).select("time", F.array("z0", "z1", "z2").alias("z"))
    model = var.fit_var(df, "z", order, p, block)
    row = model.first()
    lagged = np.hstack([np.ones((n - p, 1))] + [z[p - i:n - i] for i in range(1, p + 1)])
    want = np.linalg.lstsq(lagged, z[p:], rcond=None)[0].T
    np.testing.assert_allclose(np.array(row.coefs), want, rtol=1e-6, atol=1e-8)
    assert row.radius < 1 and row.n == n - p
    np.testing.assert_allclose(np.array(row.context), z[::-1][:p])
    e2 = var.squared_errors(df, "z", model, order, p, block_rows=block).orderBy("time").toPandas()
    np.testing.assert_allclose(np.stack(e2.e2), (z[p:] - lagged @ want.T) ** 2, rtol=1e-5, atol=1e-9)
    got = var.forecast_var(model, (), 5).orderBy("step").toPandas().value
    state = [z[-1 - i] for i in range(p)]
    for v in got:
        new = want[:, 0] + want[:, 1:] @ np.concatenate(state[:p])
        assert v == pytest.approx(new[0], rel=1e-6)
        state = [new, *state]


def test_components_span_the_same_space(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(500, 2))
    x = np.column_stack([base[:, 0], base[:, 0] * 2 + 1e-3 * rng.normal(size=500), base[:, 1], np.ones(500)])
    pdf = pd.DataFrame({"time": hours(500), **{f"x{i}": x[:, i] for i in range(4)}})
    order = Order("time")
    df = frame(spark, pdf)
    cols = [f"x{i}" for i in range(4)]
    model = var.fit_components(df, cols, order, block_rows=90)
    row = model.first()
    std = np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    want = np.sort(np.linalg.eigvalsh(np.cov((x - x.mean(axis=0)) / std, rowvar=False)))[::-1]
    np.testing.assert_allclose(row.eigenvalues, want, atol=1e-8)
    assert len(row.loadings) == 2
    z = np.stack(var.reduce_features(df, ["x0"], cols, model, order).orderBy("time").toPandas().z)
    np.testing.assert_allclose(z[:, 1:].var(axis=0, ddof=1), want[:2], rtol=1e-6)


def test_long_forecast_shape_and_errors(spark):
    pdf = two_series(2400)
    df = frame(spark, pdf)
    model = forecast.fit_long(df, ORDER, "y", ["x"], penalties=[Penalties(0.05, 1.0)], error_trend=0.1)
    out = forecast.forecast_long(model, 100).toPandas().sort_values(["k", "step"])
    assert len(out) == 200 and (out.variance_forecast > 0).all()
    a = out[out.k == "a"]
    t = np.arange(2400, 2500)
    truth = 100 + 0.01 * t + 10 * np.sin(2 * np.pi * t / 24) + 5 * np.cos(2 * np.pi * t / 168)
    assert np.abs(a.point_forecast - truth).max() < 3
    assert a.time.tolist() == list(pd.date_range(pdf.time[2399], periods=101, freq="h")[1:])
    for bad in (7.5, -1, 0):
        with pytest.raises(ValueError):
            forecast.forecast_long(model, bad)


def test_models_survive_saving(spark, tmp_path):
    pdf = two_series(600)
    model = forecast.fit_long(frame(spark, pdf), ORDER, "y", ["x"])
    model.save(str(tmp_path / "m"))
    again = model.load(spark, str(tmp_path / "m"))
    a = forecast.forecast_long(model, 5).orderBy("k", "step").toPandas()
    b = forecast.forecast_long(again, 5).orderBy("k", "step").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_store_publishes_whole_versions(spark, tmp_path):
    from pathlib import Path

    path = str(tmp_path / "store")
    first, second = (spark.createDataFrame([(i, [float(i), None])], "k long, beta array<double>") for i in (1, 2))
    assert store.publish("a", {"t": first, "u": second}, {"x": [1, "b"]}, path, spark) == 1
    assert store.publish("a", {"t": second}, {"x": 2}, path, spark) == 2
    tables, settings = store.fetch("a", path, spark)
    assert settings == {"x": 2} and list(tables) == ["t"] and tables["t"].first().k == 2
    tables, settings = store.fetch("a", path, spark, version=1)
    assert settings == {"x": [1, "b"]} and tables["t"].first().k == 1 and tables["u"].count() == 1
    first.write.parquet(f"{path}/tables/000003-half/t")  # a version whose manifest line was never written
    assert store.fetch("a", path, spark)[1] == {"x": 2}
    for kind, version in (("b", None), ("a", 9)):
        with pytest.raises(ValueError):
            store.fetch(kind, path, spark, version)
    folder = next(p for p in Path(path, "tables").iterdir() if p.name.startswith("000002"))
    second.write.mode("append").parquet(str(folder / "t"))
    with pytest.raises(ValueError, match="not as it was published"):
        store.fetch("a", path, spark)


def test_short_models_and_preparation_survive_saving(spark, tmp_path):
    pdf = pd.DataFrame({"time": hours(500), "y": seasonal(500, 1), "x": seasonal(500, 2)})
    order, df = Order("time"), frame(spark, pdf)
    model = shortterm.fit_short(df, order, "y", ["x"], 48, 24, n_models=3)
    model.save(str(tmp_path / "short"))
    again = shortterm.load_short(spark, str(tmp_path / "short"))
    a, b = (shortterm.forecast_short(df, m, order).orderBy("time").toPandas() for m in (model, again))
    pd.testing.assert_frame_equal(a, b)

    def with_levels(common: str):
        return df.withColumn("level", F.when(F.hour("time") == 0, None).when(F.hour("time") < 20, common).otherwise("b"))

    trained = prepare.process_dataset(with_levels("a"), order, split=True, n=50)
    trained.save(str(tmp_path / "prepared"))
    trained.write(str(tmp_path / "tables"))
    known = prepare.load_prepared(spark, str(tmp_path / "prepared"))
    assert known.clean is None and known.columns == trained.columns
    unseen = prepare.process_dataset(with_levels("c"), order, train=False, trained=known, n=50).clean
    assert {r.level for r in unseen.filter(F.hour("time") == 0).collect()} == {"a"}  # the training data's, not the unseen data's
    assert spark.read.parquet(str(tmp_path / "tables" / "holdout")).count() == 50
    from_path = prepare.process_dataset(str(tmp_path / "tables" / "clean"), order, n=50)
    assert from_path.clean.count() == 450


def test_recursions_of_one_shape_together(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for i in range(700):
        k, p, steps = [(1, 1), (2, 1), (2, 3)][i % 3] + (int(rng.integers(0, 30)),)
        coefs, context = rng.normal(0, 0.3, (k, 1 + k * p)), rng.normal(0, 1, (p, k))
        rows.append((i, p, coefs.tolist(), context.tolist(), steps))
        state = list(context)
        for t in range(1, steps + 1):
            new = coefs[:, 0] + coefs[:, 1:] @ np.concatenate(state[:p])
            state = [new, *state[:p - 1]]
            want[i, t] = new[0]
    models = spark.createDataFrame(rows, "k long, n_lags int, coefs array<array<double>>, context array<array<double>>, steps int").coalesce(1)
    got = {(r.k, r.step): r.value for r in var.forecast_var(models, ["k"], "steps").collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_cross_validation_equals_fitting_each_fold(spark):
    n, k = 610, 3
    pdf = pd.DataFrame({"time": hours(n), "y": seasonal(n, 8), "x": seasonal(n, 9)})
    order = Order("time")
    out = evaluate.cross_validate(frame(spark, pdf), order, "y", k, return_predictions=True, predictors=["x"]).toPandas()
    size = n // (k + 1)
    assert len(out) == k * size
    fold = 2
    cut = n - size * (k - fold + 1)
    alone = forecast.fit_long(frame(spark, pdf[:cut]), order, "y", ["x"])
    want = forecast.forecast_long(alone, size).orderBy("step").toPandas()
    got = out[out.fold == fold].sort_values("step")
    np.testing.assert_allclose(got.point_forecast, want.point_forecast, rtol=1e-7)
    np.testing.assert_allclose(got.variance_forecast, want.variance_forecast, rtol=1e-5)
    np.testing.assert_array_equal(got.actual, pdf.y[cut:cut + size])


def test_sweep_fills_the_grid(spark):
    n = 500
    pdf = pd.DataFrame({"time": hours(n), "y": seasonal(n, 10)})
    order = Order("time")
    grid = spark.createDataFrame(
        [(0.001, 0.01, 1.0, 0.0), (0.001, 0.01, 1.0, 0.5), (0.05, 1.0, None, 0.0)],
        "changepoint_prior_scale double, seasonality_prior_scale double, minimum_error_prediction double, error_trend double")
    out = evaluate.sweep(frame(spark, pdf), order, "y", grid, 3).toPandas()
    assert len(out) == 3 and out[["mse", "wmse"]].notna().all().all()
    one = evaluate.cross_validate(frame(spark, pdf), order, "y", 3, Penalties(0.001, 0.01), minimum_error=1.0,
                                  error_trend=0.5).first()
    row = out[out.error_trend == 0.5].iloc[0]
    assert row.mse == pytest.approx(one.mse) and row.wmse == pytest.approx(one.wmse)
    same = out[out.changepoint_prior_scale == 0.001].mse
    assert same.iloc[0] == pytest.approx(same.iloc[1])


def short_data(n=900):
    return pd.DataFrame({"time": hours(n), "y": seasonal(n, 11), "x": seasonal(n, 12), "noise": np.random.default_rng(0).normal(size=n)})


@pytest.mark.parametrize("block", [150, 100_000])
def test_short_forecast(spark, block):
    pdf = short_data()
    order = Order("time", bucket_seconds=86_400)
    df = frame(spark, pdf)
    length, horizon = 48, 24
    model = shortterm.fit_short(df, order, "y", ["x", "noise"], length, horizon, n_models=5, block_rows=block)
    want = len(pdf) - (length + horizon - 1)
    out = shortterm.forecast_short(df, model, order, want, block_rows=block).toPandas().sort_values("time")
    assert len(out) == want
    assert out.time.tolist() == pdf.time[length + horizon - 1:].tolist()
    error = out.point_forecast.to_numpy() - pdf.y[length + horizon - 1:].to_numpy()
    assert np.sqrt(np.mean(error ** 2)) < 1.6 and (out.variance_forecast > 0).all()
    with pytest.raises(ValueError):
        shortterm.forecast_short(df, model, order, want + 1)
    with pytest.raises(ValueError):
        shortterm.forecast_short(df.select("time", "x", "y", "noise"), model, order)


def test_short_forecast_does_not_depend_on_blocks(spark):
    pdf = short_data(500)
    order = Order("time", bucket_seconds=86_400)
    outs = []
    for parts, block in ((1, 100_000), (13, 120)):
        df = frame(spark, pdf, parts)
        m = shortterm.fit_short(df, order, "y", ["x", "noise"], 30, 6, n_models=3, block_rows=block)
        outs.append(shortterm.forecast_short(df, m, order, block_rows=block).orderBy("time").toPandas())
    np.testing.assert_allclose(outs[0].point_forecast, outs[1].point_forecast, rtol=1e-8)
    np.testing.assert_allclose(outs[0].variance_forecast, outs[1].variance_forecast, rtol=1e-5)


def test_poisson_weights_have_mean_and_variance_one():
    h = np.random.default_rng(0).integers(-2 ** 63, 2 ** 63 - 1, 100_000)
    w = shortterm.poisson_weights(h, 3)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03


def test_permutation_importance(spark):
    pdf = short_data()
    order = Order("time", bucket_seconds=86_400)
    df = frame(spark, pdf)
    model = shortterm.fit_short(df, order, "y", ["x", "noise"], 30, 6, n_models=4)
    out = shortterm.permutation_importance(df, model, order).toPandas().set_index("variable")
    # y and x follow the same cycles, so they share the importance.
    assert min(out.importance["y"], out.importance["x"]) > 0.3 and out.importance["noise"] < 0.05
    assert out.importance.sum() == pytest.approx(1, abs=0.02)
    both = shortterm.permuted(df, ["y", "x", "noise"], order, 11)
    swapped = both.select("time", F.col("perm_y").alias("y"), "x", "noise")
    redone = shortterm.forecast_short(swapped, model, order).join(df.select("time", F.col("y").alias("actual")), "time")
    want = evaluate.metrics(redone, "actual", "point_forecast").first().mse
    assert out.mse["y"] == pytest.approx(want, rel=1e-9)


def test_unused_variable_has_no_importance(spark):
    pdf = short_data(400).assign(noise=1.0)
    order = Order("time")
    df = frame(spark, pdf)
    model = shortterm.fit_short(df, order, "y", ["x", "noise"], 30, 6, n_models=2)
    out = shortterm.permutation_importance(df, model, order).toPandas().set_index("variable")
    assert out.delta["noise"] == pytest.approx(0, abs=1e-9)


def test_short_cross_validation_covers_every_test_row(spark):
    n, k = 400, 3
    pdf = short_data(n)[["time", "y", "x"]]
    out = evaluate.cross_validate_short(frame(spark, pdf), Order("time"), "y", ["x"], 30, 6, k, True, n_models=2).toPandas()
    size = n // (k + 1)
    assert len(out) == k * size
    assert sorted(out.time) == pdf.time[n - k * size:].tolist()


def wilcoxon_by_hand(d):
    d = d[d != 0]
    ranks = pd.Series(np.abs(d)).rank().to_numpy()
    up, down = ranks[d > 0].sum(), ranks[d < 0].sum()
    n = len(d)
    ties = pd.Series(np.abs(d)).value_counts().to_numpy().astype(float)
    se = np.sqrt((n * (n + 1) * (2 * n + 1) - (ties ** 3 - ties).sum() / 2) / 24)
    return n, min(up, down), (min(up, down) - n * (n + 1) / 4) / se


@pytest.mark.parametrize("bucket_rows", [20, 1_000_000])
def test_wilcoxon_matches_by_hand(spark, bucket_rows):
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(0.1, 1, 500), 1)
    b = np.round(rng.normal(0, 1, 500), 1)
    got = evaluate.wilcoxon(frame(spark, pd.DataFrame({"a": a, "b": b})), "a", "b", bucket_rows=bucket_rows).first()
    n, stat, z = wilcoxon_by_hand(np.round(a - b, 9))
    assert (got.n, got.statistic) == (n, stat) and got.z == pytest.approx(z)
    assert 0 < got.p_value < 1 and got.reject == (got.p_value < 0.05)


def test_exact_p_small_sample():
    # Six differences all of one sign: two of the 64 sign patterns are as extreme.
    assert evaluate.exact_p(0, 6) == pytest.approx(2 / 64)


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"k": np.repeat(["a", "b"], [333, 50]), "v": np.round(rng.lognormal(0, 2, 383), 2)})
    for rows in (25, 1_000_000):
        out = describe.quantiles(frame(spark, pdf), "v", (0.25, 0.5, 0.9), ("k",), rows).toPandas().set_index("k")
        for k, g in pdf.groupby("k"):
            np.testing.assert_allclose(out.loc[k], g.v.quantile([0.25, 0.5, 0.9]))


def test_equal_weights_make_wmse_the_mse(spark):
    pdf = pd.DataFrame({"a": np.arange(20.0), "p": np.arange(20.0) ** 1.1, "v": np.full(20, 4.0)})
    row = evaluate.all_metrics(frame(spark, pdf), "a", "p", "v").first()
    assert row.wmse == pytest.approx(row.mse)


def test_hyper_zero_actual_does_not_break_mape(spark):
    pdf = pd.DataFrame({"a": [0.0, 2.0], "p": [1.0, 1.0]})
    row = evaluate.metrics(frame(spark, pdf), "a", "p").first()
    assert row.mse == 1 and row.mape == 0.25
