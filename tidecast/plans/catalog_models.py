"""Queries over fitted models, forecasts and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.operators import decompose, evaluate, forecast, shortterm, var, windows
from tidecast.operators.align import align_forecasts
from tidecast.operators.clean import complete_rows
from tidecast.operators.decompose import Penalties
from tidecast.operators.describe import mode_of, poly_fit
from tidecast.operators.position import Order
from tidecast.plans import evaluate as reports, prepare
from tidecast.plans.registry import (
    HOURLY_SQL, KEYED_SQL, TYPES, daily, hourly, keyed, query, rounded, table, wide)
from tidecast.session import scratch_path, write_scratch
from tidecast.sources import store

HOUR = Order("time")
TYPED = Order("time", ("event_type",))
DAYS = Order("time", bucket_seconds=400 * 86_400)
DAY_SECONDS = 86_400
LOOSE = Penalties(0.05, 1.0)
REST = TYPES[1:]


def filled(spark, folder) -> DataFrame:
    """The wide hourly table with its nulls imputed, kept as a table because several steps read it."""
    df = wide(spark, folder)
    models = decompose.fit_decomposition(df, HOUR, TYPES)
    return write_scratch(decompose.impute(df, models, TYPES, HOUR), "filled")


def stored(df: DataFrame) -> DataFrame:
    """The hourly or daily table as a stored dataset, so that the passes of a fit do not rebuild it."""
    return write_scratch(df, "series")


@query("decomposition_fit")
def decomposition_fit(spark, folder):
    models = decompose.fit_decomposition(keyed(spark, folder), TYPED, ["y"])
    return models.select("event_type", "variable", "n", "t0", "span", "noise", "beta")


#: Penalties so strong that only level and slope are left, which SQL's regression functions give as well.
STRAIGHT = Penalties(1e-9, 1e-9)
LINE_SQL = f"""{KEYED_SQL}, hg AS (SELECT event_type, time, CASE WHEN hour(time) % 5 <> 0 THEN y END AS y FROM hk),
ends AS (SELECT event_type, min(epoch(time)) AS t0, max(epoch(time)) - min(epoch(time)) AS span FROM hk GROUP BY 1),
hx AS (SELECT event_type, time, y, (epoch(time) - t0) / span AS x FROM hg JOIN ends USING (event_type)),
line AS (SELECT event_type, count(y) AS n, regr_intercept(y, x) AS a, regr_slope(y, x) AS b,
  (regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / count(y) AS noise FROM hx GROUP BY 1)"""


def gapped(spark, folder) -> DataFrame:
    """The hourly series per event type, unknown in every fifth hour of a day."""
    return keyed(spark, folder).withColumn("y", F.when(F.hour("time") % 5 != 0, F.col("y")))


def straight_lines(df: DataFrame) -> DataFrame:
    return decompose.fit_decomposition(df, TYPED, ["y"], [STRAIGHT])


@query("straight_line_fit", f"WITH {LINE_SQL} SELECT event_type, n, round(a, 4) AS level, round(b, 4) AS slope, round(noise, 2) AS noise FROM line")
def straight_line_fit(spark, folder):
    models = straight_lines(gapped(spark, folder))
    return models.select("event_type", "n", F.round(F.col("beta")[0], 4).alias("level"), F.round(F.col("beta")[1], 4).alias("slope"),
                         F.round("noise", 2).alias("noise"))


@query("straight_line_prediction", f"WITH {LINE_SQL} SELECT event_type, time + INTERVAL 720 HOUR AS time, "
       "round(a + b * (epoch(time) + 2592000 - t0) / span, 4) AS yhat FROM hk JOIN line USING (event_type) JOIN ends USING (event_type)")
def straight_line_prediction(spark, folder):
    df = gapped(spark, folder)
    later = df.select("event_type", F.timestamp_add("HOUR", F.lit(720), F.col("time")).alias("time"))
    out = decompose.predict_decomposition(later, straight_lines(df), "time", ["event_type"])
    return rounded(out.select("event_type", "time", "yhat"), 4)


@query("straight_line_imputed", f"WITH {LINE_SQL} SELECT event_type, time, round(coalesce(y, a + b * x), 4) AS y FROM hx JOIN line USING (event_type)")
def straight_line_imputed(spark, folder):
    df = gapped(spark, folder)
    return rounded(decompose.impute(df, straight_lines(df), ["y"], TYPED), 4)


@query("straight_line_residuals", f"WITH {LINE_SQL} SELECT event_type, time, round(y - (a + b * x), 4) AS y FROM hx JOIN line USING (event_type)")
def straight_line_residuals(spark, folder):
    df = gapped(spark, folder)
    return rounded(decompose.residuals(df, straight_lines(df), ["y"], TYPED), 4)


@query("straight_line_table", f"WITH {LINE_SQL} SELECT event_type, time, y, round(a + b * x, 4) AS trend, round(y - (a + b * x), 4) AS residual "
       "FROM hx JOIN line USING (event_type)")
def straight_line_table(spark, folder):
    df = gapped(spark, folder)
    return rounded(decompose.decompose(df, straight_lines(df), "y", TYPED).select("event_type", "time", "y", "trend", "residual"), 4)


@query("decomposition_prediction")
def decomposition_prediction(spark, folder):
    d = daily(spark, folder)
    models = decompose.fit_decomposition(d, DAYS, ["y"], [LOOSE])
    return decompose.predict_decomposition(d.select("time"), models, "time")


@query("imputed_values")
def imputed_values(spark, folder):
    df = wide(spark, folder)
    return decompose.impute(df, decompose.fit_decomposition(df, HOUR, TYPES), TYPES, HOUR)


@query("imputed_category", """WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type FROM events),
m AS (SELECT event_type FROM e WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT event_id, coalesce(event_type, (SELECT event_type FROM m)) AS event_type FROM e""")
def imputed_category(spark, folder):
    e = table(spark, folder, "events").select(
        "event_id", F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("event_type")).alias("event_type"))
    return decompose.impute_category(e, "event_type", mode_of(e, "event_type"))


@query("residuals")
def residuals(spark, folder):
    df = wide(spark, folder)
    return decompose.residuals(df, decompose.fit_decomposition(df, HOUR, TYPES), TYPES, HOUR)


@query("decomposition_table")
def decomposition_table(spark, folder):
    df = keyed(spark, folder)
    return decompose.decompose(df, decompose.fit_decomposition(df, TYPED, ["y"], [LOOSE]), "y", TYPED)


def _vectors(spark, folder) -> DataFrame:
    df = filled(spark, folder)
    left = decompose.residuals(df, decompose.fit_decomposition(df, HOUR, TYPES), TYPES, HOUR)
    others = [c for c in REST if c != "view"]
    return var.reduce_features(left, ["click", "view"], others, var.fit_components(left, others, HOUR), HOUR)


@query("reduced_features")
def reduced_features(spark, folder):
    return _vectors(spark, folder)


@query("autoregression_fit")
def autoregression_fit(spark, folder):
    return var.fit_var(_vectors(spark, folder), "z", HOUR, 2).select("n_vars", "n_lags", "n", "radius", "coefs")


@query("autoregression_forecast")
def autoregression_forecast(spark, folder):
    return var.forecast_var(var.fit_var(_vectors(spark, folder), "z", HOUR), (), 48)


@query("squared_one_step_errors")
def squared_one_step_errors(spark, folder):
    z = write_scratch(_vectors(spark, folder), "z")
    return var.squared_errors(z, "z", var.fit_var(z, "z", HOUR), HOUR)


@query("error_model_fit")
def error_model_fit(spark, folder):
    z = write_scratch(_vectors(spark, folder), "z")
    e2 = write_scratch(var.squared_errors(z, "z", var.fit_var(z, "z", HOUR), HOUR), "e2")
    errors, error_var = forecast.fit_error_model(e2, HOUR)
    floor = forecast.error_floor(e2, (), None)
    return errors.filter("out = 0").select("variable", "n", "noise", error_var.select("radius").scalar().alias("radius"),
                                           floor.select("floor").scalar().alias("floor"))


@query("long_forecast")
def long_forecast(spark, folder):
    model = forecast.fit_long(stored(keyed(spark, folder)), TYPED, "y", penalties=[LOOSE])
    return forecast.confidence_bounds(forecast.forecast_long(model, 336))


@query("stored_models")
def stored_models(spark, folder):
    model = forecast.fit_long(stored(daily(spark, folder)), DAYS, "y", penalties=[LOOSE])
    path = scratch_path(spark, "models")
    model.save(path)
    return forecast.forecast_long(forecast.load_long(spark, path), 365, DAY_SECONDS)


@query("stored_line_models", f"WITH {LINE_SQL} SELECT event_type, time + INTERVAL 720 HOUR AS time, "
       "round(a + b * (epoch(time) + 2592000 - t0) / span, 4) AS yhat FROM hk JOIN line USING (event_type) JOIN ends USING (event_type)")
def stored_line_models(spark, folder):
    """Published, replaced by a newer version, and fetched by number from the path alone."""
    df, path = gapped(spark, folder), scratch_path(spark, "store")
    version = store.publish("decomposition", {"models": straight_lines(df)}, {}, path, spark)
    store.publish("decomposition", {"models": straight_lines(df.withColumn("y", F.col("y") + 1))}, {}, path, spark)
    models = store.fetch("decomposition", path, spark, version)[0]["models"]
    later = df.select("event_type", F.timestamp_add("HOUR", F.lit(720), F.col("time")).alias("time"))
    return rounded(decompose.predict_decomposition(later, models, "time", ["event_type"]).select("event_type", "time", "yhat"), 4)


LONG_SQL = f"""{KEYED_SQL}, ends AS (SELECT event_type, min(epoch(time)) AS t0, max(epoch(time)) - min(epoch(time)) AS span, max(time) AS last FROM hk GROUP BY 1),
line AS (SELECT event_type, regr_intercept(y, (epoch(time) - t0) / span) AS a, regr_slope(y, (epoch(time) - t0) / span) AS b
  FROM hk JOIN ends USING (event_type) GROUP BY 1),
res AS (SELECT event_type, time, y - (a + b * (epoch(time) - t0) / span) AS r FROM hk JOIN ends USING (event_type) JOIN line USING (event_type)),
lagged AS (SELECT event_type, time, r, lag(r) OVER (PARTITION BY event_type ORDER BY time) AS l FROM res),
ar AS (SELECT event_type, regr_intercept(r, l) AS c, regr_slope(r, l) AS w, arg_max(r, time) AS r FROM lagged GROUP BY 1),
long AS (SELECT event_type, last + to_hours(h) AS time, h::INTEGER AS step,
  a + b * (epoch(last) + 3600 * h - t0) / span + pow(w, h) * r + c * (1 - pow(w, h)) / (1 - w) AS p
  FROM ends JOIN line USING (event_type) JOIN ar USING (event_type), range(1, 337) AS steps(h))"""


@query("straight_long_forecast", f"WITH {LONG_SQL} SELECT event_type, time, step, round(p, 2) AS point_forecast FROM long")
def straight_long_forecast(spark, folder):
    """A line and an autoregression of what it leaves, for two weeks."""
    model = forecast.fit_long(stored(keyed(spark, folder)), TYPED, "y", penalties=[STRAIGHT], minimum_error=1.0)
    return rounded(forecast.forecast_long(model, 336).select("event_type", "time", "step", "point_forecast"), 2)


@query("short_forecast")
def short_forecast(spark, folder):
    df = filled(spark, folder)
    model = shortterm.fit_short(df, HOUR, "click", REST, 168, 24)
    return shortterm.forecast_short(df, model, HOUR)


def _baseline_sql(name: str, w: int) -> str:
    return (f"{name}0 AS (SELECT event_type, time, y, CASE WHEN count(y) OVER w = {w} THEN avg(y) OVER w END AS p FROM hk WINDOW w AS "
            f"(PARTITION BY event_type ORDER BY time ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)), "
            f"{name} AS (SELECT * FROM (SELECT event_type, time, p, CASE WHEN count(*) OVER w = {w} THEN avg(pow(p - y, 2)) OVER w END AS v "
            f"FROM {name}0 WHERE p IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY time ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)) "
            f"WHERE v IS NOT NULL)")


@query("moving_average_baseline", f"WITH {KEYED_SQL}, {_baseline_sql('b', 24)} SELECT event_type, time, round(p, 6) AS point_forecast, "
       "round(v, 4) AS variance_forecast FROM b")
def moving_average_baseline(spark, folder):
    out = forecast.baseline_short(keyed(spark, folder), "y", TYPED, 24)
    return rounded(out.withColumn("variance_forecast", F.round("variance_forecast", 4)))


@query("day_ahead_average_baseline", f"WITH {KEYED_SQL}, {_baseline_sql('b', 24)}, "
       "a AS (SELECT hk.event_type, hk.time, lag(p, 24) OVER w AS p, lag(v, 24) OVER w AS v FROM hk LEFT JOIN "
       "b ON hk.event_type = b.event_type AND hk.time = b.time WHERE b.v IS NOT NULL "
       "WINDOW w AS (PARTITION BY hk.event_type ORDER BY hk.time)) "
       "SELECT event_type, time, round(p, 6) AS point_forecast, round(v, 4) AS variance_forecast FROM a WHERE v IS NOT NULL")
def day_ahead_average_baseline(spark, folder):
    out = forecast.baseline_short(keyed(spark, folder), "y", TYPED, 24, lag=24)
    return rounded(out.withColumn("variance_forecast", F.round("variance_forecast", 4)))


@query("external_baseline", f"""WITH {HOURLY_SQL}, x AS (SELECT time + INTERVAL 24 HOUR AS time, y AS x FROM h),
c AS (SELECT sum(x.x * h.y) / sum(x.x * x.x) AS c FROM h JOIN x ON h.time = x.time WHERE h.time < TIMESTAMP '2024-01-21')
SELECT x.time, round(x.x * (SELECT c FROM c), 6) AS point_forecast FROM x JOIN h ON h.time = x.time WHERE h.time >= TIMESTAMP '2024-01-21'""")
def external_baseline(spark, folder):
    h = hourly(spark, folder)
    external = h.select(F.timestamp_add("HOUR", F.lit(24), F.col("time")).alias("time"), F.col("y").alias("x"))
    split = windows.split_at(h, "time", "2024-01-21")
    out = forecast.baseline_external(external, split.filter("not is_holdout"), split.filter("is_holdout"), "x", "y")
    return rounded(out)


@query("ensemble_forecast", f"WITH {KEYED_SQL}, {_baseline_sql('a', 24)}, {_baseline_sql('b', 36)} SELECT a.event_type, a.time, "
       "round((a.p * 1.0 + b.p * 2.0) / 3.0, 6) AS point_forecast, round((a.v * 1.0 + b.v * 2.0) / 3.0, 4) AS variance_forecast "
       "FROM a JOIN b ON a.event_type = b.event_type AND a.time = b.time")
def ensemble_forecast(spark, folder):
    rows = keyed(spark, folder)
    out = forecast.ensemble({"day": (forecast.baseline_short(rows, "y", TYPED, 24), 1.0),
                             "day and a half": (forecast.baseline_short(rows, "y", TYPED, 36), 2.0),
                             "unused": (rows, 0.0)}, ["event_type", "time"])
    return rounded(out.withColumn("variance_forecast", F.round("variance_forecast", 4)))


@query("cross_validated_errors")
def cross_validated_errors(spark, folder):
    return evaluate.cross_validate(keyed(spark, folder), TYPED, "y", 3, LOOSE)


@query("cross_validated_predictions")
def cross_validated_predictions(spark, folder):
    return evaluate.cross_validate(daily(spark, folder), DAYS, "y", 4, LOOSE, True, DAY_SECONDS)


@query("parameter_sweep")
def parameter_sweep(spark, folder):
    grid = spark.createDataFrame(
        [(0.5, 0.5, 100.0, 0.01), (0.5, 0.5, 100.0, 0.1), (0.001, 0.01, None, 0.0001), (0.05, 1.0, None, 0.01)],
        "changepoint_prior_scale double, seasonality_prior_scale double, minimum_error_prediction double, error_trend double")
    return evaluate.sweep(hourly(spark, folder), HOUR, "y", grid, 3)


@query("short_cross_validation")
def short_cross_validation(spark, folder):
    return evaluate.cross_validate_short(filled(spark, folder), HOUR, "click", REST, 72, 24, 3, n_models=5)


@query("error_metrics", f"""WITH {KEYED_SQL}, {_baseline_sql('b', 24)}, r AS (SELECT b.event_type, hk.y, b.p - hk.y AS e FROM b
JOIN hk ON b.event_type = hk.event_type AND b.time = hk.time)
SELECT event_type, count(*) AS n, round(avg(e * e), 4) AS mse, round(avg(abs(e)), 6) AS mae,
round(sum(abs(CASE WHEN y = 0 THEN NULL ELSE e / y END)) / count(*), 4) AS mape FROM r GROUP BY 1""")
def error_metrics(spark, folder):
    rows = keyed(spark, folder)
    both = forecast.baseline_short(rows, "y", TYPED, 24).join(rows, ["event_type", "time"])
    out = evaluate.metrics(both, "y", "point_forecast", ["event_type"])
    return rounded(out.withColumn("mse", F.round("mse", 4)).withColumn("mape", F.round("mape", 4)))


@query("weighted_errors", f"""WITH {KEYED_SQL}, {_baseline_sql('b', 24)}, r AS (SELECT b.event_type, b.v, pow(b.p - hk.y, 2) AS e2 FROM b
JOIN hk ON b.event_type = hk.event_type AND b.time = hk.time)
SELECT a.event_type, a.wmse, b.wmse AS wmse_inverse_variance FROM
(SELECT event_type, round(sum(e2 / sqrt(v)) / sum(1 / sqrt(v)), 4) AS wmse FROM r GROUP BY 1) a JOIN
(SELECT event_type, round(sum(e2 / v) / sum(1 / v), 4) AS wmse FROM r GROUP BY 1) b ON a.event_type = b.event_type""")
def weighted_errors(spark, folder):
    rows = keyed(spark, folder)
    both = forecast.baseline_short(rows, "y", TYPED, 24).join(rows, ["event_type", "time"])
    a = evaluate.weighted_mse(both, "y", "point_forecast", "variance_forecast", 0.5, ["event_type"])
    b = evaluate.weighted_mse(both, "y", "point_forecast", "variance_forecast", 1.0, ["event_type"])
    return rounded(a.join(b.withColumnRenamed("wmse", "wmse_inverse_variance"), ["event_type"]), 4)


@query("paired_signed_rank_test", """WITH d AS (SELECT l_returnflag, round(l_extendedprice / 1000 - l_quantity, 6) AS d FROM lineitem),
r AS (SELECT l_returnflag, d, rank() OVER (PARTITION BY l_returnflag ORDER BY abs(d)) + (count(*) OVER (PARTITION BY l_returnflag, abs(d)) - 1) / 2.0 AS rk,
count(*) OVER (PARTITION BY l_returnflag, abs(d)) AS t FROM d WHERE d <> 0),
s AS (SELECT l_returnflag, count(*) AS n, CAST(least(sum(rk) FILTER (d > 0), sum(rk) FILTER (d < 0)) AS DOUBLE) AS statistic,
CAST(sum(CAST(t AS DOUBLE) * t - 1) AS DOUBLE) AS ties FROM r GROUP BY 1)
SELECT l_returnflag, n, statistic, round((statistic - n * (n + 1.0) / 4) / sqrt((CAST(n AS DOUBLE) * (n + 1) * (2 * n + 1) - ties / 2) / 24), 6) AS z FROM s""")
def paired_signed_rank_test(spark, folder):
    items = table(spark, folder, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 1000).alias("a"), F.col("l_quantity").alias("b"))
    return rounded(evaluate.wilcoxon(items, "a", "b", ["l_returnflag"], 6).select("l_returnflag", "n", "statistic", "z"))


@query("paired_test_outcome")
def paired_test_outcome(spark, folder):
    rows = complete_rows(wide(spark, folder)).withColumn("season", F.hour("time") > 11)
    return evaluate.wilcoxon(rows, "click", "view", ["season"])


@query("variable_importance")
def variable_importance(spark, folder):
    df = filled(spark, folder)
    model = shortterm.fit_short(df, HOUR, "click", REST, 168, 24, n_models=5)
    return shortterm.permutation_importance(df, model, HOUR)


REPORT_SQL = f"""WITH {KEYED_SQL}, {_baseline_sql('a', 24)}, {_baseline_sql('b', 48)},
r AS (SELECT hk.y, a.p AS ap, a.v AS av, b.p AS bp FROM hk JOIN a ON hk.event_type = a.event_type AND hk.time = a.time
JOIN b ON hk.event_type = b.event_type AND hk.time = b.time),
l AS (SELECT 'day' AS model, y, ap AS p, av AS v FROM r UNION ALL SELECT 'two days', y, bp, 1.0 FROM r)
SELECT model, round(avg(pow(p - y, 2)), 4) AS mse, round(sum(pow(p - y, 2) / sqrt(v)) / sum(1 / sqrt(v)), 4) AS weighted_mse,
round(avg(abs(p - y)), 4) AS mae, round(sum(abs(CASE WHEN y = 0 THEN NULL ELSE (p - y) / y END)) / count(*), 4) AS mape FROM l GROUP BY 1"""


@query("performance_report", REPORT_SQL)
def performance_report(spark, folder):
    rows = keyed(spark, folder)
    both = align_forecasts({"day": forecast.baseline_short(rows, "y", TYPED, 24), "two": forecast.baseline_short(rows, "y", TYPED, 48)},
                           rows, ["event_type", "time"])
    models = {"day": ("day_point_forecast", "day_variance_forecast"), "two days": ("two_point_forecast", None)}
    return evaluate.performance_report(both, "y", models, "day", digits=4).drop("wilcoxon_p_value")


def _prepared(spark, folder, n: int = 100) -> prepare.Prepared:
    df = wide(spark, folder).withColumn("rain", F.col("view") / 900)
    return prepare.process_dataset(df, HOUR, split=True, rain="rain", n=n)


@query("prepared_dataset")
def prepared_dataset(spark, folder):
    return _prepared(spark, folder).clean


@query("prepared_holdout")
def prepared_holdout(spark, folder):
    first = _prepared(spark, folder)
    return prepare.process_dataset(first.holdout, HOUR, train=False, trained=first, rain="rain", n=100).clean


@query("long_evaluation_report")
def long_evaluation_report(spark, folder):
    split = stored(windows.split_holdout(daily(spark, folder), DAYS))
    results = reports.long_forecast_on_holdout(split.filter("not is_holdout"), split.filter("is_holdout"), DAYS, "y", 365,
                                               DAY_SECONDS, penalties=[LOOSE])
    return reports.long_report(write_scratch(results, "results"))


@query("short_evaluation_report")
def short_evaluation_report(spark, folder):
    df = filled(spark, folder)
    split = stored(windows.split_holdout(df, HOUR))
    external = df.select(F.timestamp_add("HOUR", F.lit(24), F.col("time")).alias("time"), F.col("click").alias("x"))
    results = reports.short_forecast_on_holdout(split.filter("not is_holdout"), split.filter("is_holdout"), HOUR, "click", REST, 72,
                                                external=external, external_value="x")
    return reports.short_report(write_scratch(results, "results"))


@query("published_future")
def published_future(spark, folder):
    d = stored(daily(spark, folder))
    return forecast.publish_future(d, DAYS, "y", 730, DAY_SECONDS, penalties=[LOOSE])


# One-variable cases of the multivariate models, which SQL can state in closed form.
AR_SQL = f"""{KEYED_SQL}, l AS (SELECT event_type, time, y, lag(y) OVER (PARTITION BY event_type ORDER BY time) AS x FROM hk),
c AS (SELECT event_type, regr_intercept(y, x) AS c, regr_slope(y, x) AS a, regr_count(y, x) AS n FROM l GROUP BY 1)"""


def _single(spark, folder) -> DataFrame:
    return write_scratch(keyed(spark, folder).select("event_type", "time", F.array("y").alias("z")), "z")


@query("autoregression_per_type", f"WITH {AR_SQL} SELECT event_type, n, round(c, 6) AS intercept, round(a, 8) AS weight, "
       "round(abs(a), 8) AS radius FROM c")
def autoregression_per_type(spark, folder):
    model = var.fit_var(_single(spark, folder), "z", TYPED)
    row = F.col("coefs")[0]
    return model.select("event_type", "n", F.round(row[0], 6).alias("intercept"), F.round(row[1], 8).alias("weight"),
                        F.round("radius", 8).alias("radius"))


@query("autoregression_steps_per_type", f"WITH {AR_SQL}, e AS (SELECT event_type, arg_max(y, time) AS y FROM hk GROUP BY 1), "
       "s AS (SELECT e.event_type, c + a * y AS v1, c + a * (c + a * y) AS v2, c + a * (c + a * (c + a * y)) AS v3 FROM e JOIN c ON e.event_type = c.event_type) "
       "SELECT event_type, CAST(1 AS INTEGER) AS step, round(v1, 5) AS value FROM s UNION ALL SELECT event_type, 2, round(v2, 5) FROM s "
       "UNION ALL SELECT event_type, 3, round(v3, 5) FROM s")
def autoregression_steps_per_type(spark, folder):
    return rounded(var.forecast_var(var.fit_var(_single(spark, folder), "z", TYPED), ["event_type"], 3), 5)


@query("one_step_errors_per_type", f"WITH {AR_SQL} SELECT l.event_type, l.time, round(pow(l.y - (c.c + c.a * l.x), 2), 3) AS e2 "
       "FROM l JOIN c ON l.event_type = c.event_type WHERE l.x IS NOT NULL")
def one_step_errors_per_type(spark, folder):
    z = _single(spark, folder)
    e2 = var.squared_errors(z, "z", var.fit_var(z, "z", TYPED), TYPED)
    return e2.select("event_type", "time", F.round(F.col("e2")[0], 3).alias("e2"))


@query("variance_floor_per_type", f"WITH {AR_SQL} SELECT l.event_type, round(median(pow(l.y - (c.c + c.a * l.x), 2)), 3) AS floor "
       "FROM l JOIN c ON l.event_type = c.event_type WHERE l.x IS NOT NULL GROUP BY 1")
def variance_floor_per_type(spark, folder):
    z = _single(spark, folder)
    e2 = var.squared_errors(z, "z", var.fit_var(z, "z", TYPED), TYPED)
    return rounded(forecast.error_floor(e2, ["event_type"], None), 3)


@query("components_of_a_pair", """WITH r AS (SELECT l_returnflag, count(*) AS n, abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, round((1 + r) * n / (n - 1.0), 8) AS larger, round((1 - r) * n / (n - 1.0), 8) AS smaller,
CAST(CASE WHEN (1 - r) * n / (n - 1.0) >= 0.1 THEN 2 ELSE 1 END AS INTEGER) AS kept FROM r""")
def components_of_a_pair(spark, folder):
    items = table(spark, folder, "lineitem")
    order = Order("l_shipdate", ("l_returnflag",), ("l_orderkey", "l_linenumber"))
    model = var.fit_components(items, ["l_quantity", "l_extendedprice"], order)
    eig = F.col("eigenvalues")
    return model.select("l_returnflag", "n", F.round(eig[0], 8).alias("larger"), F.round(eig[1], 8).alias("smaller"),
                        F.size("loadings").alias("kept"))


@query("linear_fit", "SELECT CAST(0 AS INTEGER) AS power, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem "
       "UNION ALL SELECT 1, round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem")
def linear_fit(spark, folder):
    return rounded(poly_fit(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 1), 4)


@query("importance_shares", f"WITH {KEYED_SQL}, d AS (SELECT event_type AS variable, round(avg(y), 6) AS delta FROM hk GROUP BY 1), "
       "s AS (SELECT min(delta) AS low, sum(delta) AS total, count(*) AS n FROM d) "
       "SELECT variable, delta, round((delta - low) / (total - n * low), 2) AS importance FROM d, s")
def importance_shares(spark, folder):
    deltas = keyed(spark, folder).groupBy(F.col("event_type").alias("variable")).agg(F.round(F.avg("y"), 6).alias("delta"))
    return shortterm.importance_shares(deltas)
