"""Queries over statistics, ordered operators and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.functions import cells, timekeys
from tidecast.operators import align, describe, windows
from tidecast.operators.attach import attach
from tidecast.operators.evaluate import metrics
from tidecast.operators.position import SHUFFLE_PRIME, Order, fit_bucket, order_index, shuffle_keys, with_position
from tidecast.operators.shortterm import permuted
from tidecast.plans.prepare import one_hot
from tidecast.plans.registry import (
    DAILY_SQL, HOURLY_SQL, KEYED_SQL, TYPES, WIDE_SQL, daily, hourly, keyed, query, rounded, table, wide)

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
HOUR = Order("time")
TYPED = Order("time", ("event_type",))
RAW = Order("ts", ("event_type",), ("event_id",))


@query("trailing_day_errors", f"""WITH {HOURLY_SQL},
c AS (SELECT unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time FROM h),
f AS (SELECT c.time, h.y FROM c LEFT JOIN h ON c.time = h.time),
s AS (SELECT time, CASE WHEN count(y) OVER w = 24 THEN avg(y) OVER w END AS point FROM f
WINDOW w AS (ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
r AS (SELECT s.point - h.y AS e, h.y FROM s JOIN h ON s.time = h.time WHERE s.point IS NOT NULL)
SELECT count(e) AS n, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae,
round(sum(abs(CASE WHEN y = 0 THEN NULL ELSE e / y END)) / count(e), 6) AS mape FROM r""")
def trailing_day_errors(spark, folder):
    h = hourly(spark, folder)
    forecast = windows.trailing_mean(align.fill_calendar(h, "time"), "y", 24, HOUR, "point").filter("point is not null")
    both = align.reconcile(forecast.select("time", "point"), h)
    return rounded(metrics(both, "y", "point"))


def _describe_sql() -> str:
    parts = [f"""SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem""" for c in MEASURES]
    return " UNION ALL ".join(parts)


@query("described_columns", _describe_sql())
def described_columns(spark, folder):
    return describe.describe(table(spark, folder, "lineitem"), MEASURES, 6)


def _corr_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
                              for a in MEASURES for b in MEASURES)


@query("correlation_matrix", _corr_sql())
def correlation_matrix(spark, folder):
    return rounded(describe.correlation_matrix(table(spark, folder, "lineitem"), MEASURES))


@query("pairwise_correlations_with_nulls", f"WITH {WIDE_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, round(corr({a}, {b}), 6) AS r FROM hw" for a in TYPES for b in TYPES))
def pairwise_correlations_with_nulls(spark, folder):
    return rounded(describe.correlation_matrix(wide(spark, folder), TYPES))


@query("target_correlations", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(corr({c}, l_extendedprice), 6) AS r FROM lineitem" for c in MEASURES if c != "l_extendedprice"))
def target_correlations(spark, folder):
    return rounded(describe.target_correlations(table(spark, folder, "lineitem"), "l_extendedprice", MEASURES))


@query("category_means", "SELECT l.event_type, round(avg(e.value), 6) AS mean FROM (SELECT unnest(["
       + ", ".join(f"'{t}'" for t in [*TYPES, "refund"]) + "]) AS event_type) l LEFT JOIN events e ON l.event_type = e.event_type GROUP BY 1")
def category_means(spark, folder):
    return rounded(describe.category_means(table(spark, folder, "events"), "event_type", "value", [*TYPES, "refund"]))


@query("category_counts", "SELECT nullif(event_type, 'error') AS event_type, count(*) AS n FROM events GROUP BY 1")
def category_counts(spark, folder):
    e = table(spark, folder, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return describe.category_counts(e, "event_type")


@query("value_distribution", """WITH s AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high, avg(l_extendedprice) AS m,
stddev_samp(l_extendedprice) AS s FROM lineitem), g AS (SELECT unnest(range(20)) AS bin),
b AS (SELECT CAST(least(floor((l_extendedprice - low) / ((high - low) / 20)), 19) AS BIGINT) AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(low + g.bin * ((high - low) / 20), 6) AS bin_start,
round(low + (g.bin + 1) * ((high - low) / 20), 6) AS bin_end, coalesce(n, 0) AS n, round(m, 6) AS mean, round(s, 6) AS std,
round(m - s, 6) AS band1_low, round(m + s, 6) AS band1_high, round(m - 3 * s, 6) AS band3_low, round(m + 3 * s, 6) AS band3_high
FROM g LEFT JOIN b ON g.bin = b.bin, s""")
def value_distribution(spark, folder):
    return rounded(describe.distribution(table(spark, folder, "lineitem"), "l_extendedprice", 20))


@query("most_frequent_category", "SELECT l_returnflag, event_mode AS l_linestatus, n FROM (SELECT l_returnflag, l_linestatus AS event_mode, "
       "count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, event_mode) = 1")
def most_frequent_category(spark, folder):
    return describe.mode_of(table(spark, folder, "lineitem"), "l_linestatus", ("l_returnflag",))


@query("median_squared_error", "SELECT l_returnflag, round(median(pow(l_extendedprice - 1000 * l_quantity, 2)), 4) AS median FROM lineitem GROUP BY 1")
def median_squared_error(spark, folder):
    e = table(spark, folder, "lineitem").select("l_returnflag", F.pow(F.col("l_extendedprice") - 1000 * F.col("l_quantity"), F.lit(2)).alias("e2"))
    return rounded(describe.quantiles(e, "e2", (0.5,), ("l_returnflag",)).withColumnRenamed("q0", "median"), 4)


@query("missing_counts", f"WITH {WIDE_SQL} " + " UNION ALL ".join(
    f"SELECT '{t}' AS variable, count(*) FILTER ({t} IS NULL) AS missing FROM hw" for t in TYPES))
def missing_counts(spark, folder):
    return describe.missing_counts(wide(spark, folder), TYPES)


@query("time_bounds", "SELECT event_type, min(ts) AS first_time, max(ts) AS last_time FROM events GROUP BY 1")
def time_bounds(spark, folder):
    return describe.time_bounds(table(spark, folder, "events"), "ts", ["event_type"])


@query("polynomial_fit")
def polynomial_fit(spark, folder):
    return describe.poly_fit(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 3)


@query("scale_coefficient", f"WITH {HOURLY_SQL} SELECT round(sum(a.y * b.y) / sum(b.y * b.y), 9) AS coefficient FROM h a JOIN h b ON a.time = b.time + INTERVAL 24 HOUR")
def scale_coefficient(spark, folder):
    h = hourly(spark, folder)
    ahead = h.select(F.timestamp_add("HOUR", F.lit(24), F.col("time")).alias("time"), F.col("y").alias("x"))
    return rounded(describe.scale_coefficient(h.join(ahead, "time"), "x", "y"), 9)


@query("component_contributions", f"""WITH {WIDE_SQL}, f AS (SELECT {", ".join(f"coalesce({t}, 0) AS {t}" for t in TYPES)} FROM hw),
r AS (SELECT {", ".join(f"corr({' + '.join(TYPES)}, {t}) AS {t}" for t in TYPES)} FROM f)
SELECT {", ".join(f"round({t} / ({' + '.join(TYPES)}), 6) AS {t}" for t in TYPES)} FROM r""")
def component_contributions(spark, folder):
    parts = wide(spark, folder).fillna(0.0).withColumn("y", cells.total([F.col(t) for t in TYPES]))
    return rounded(describe.component_contributions(parts, "y", TYPES))


def raw_order(e: DataFrame) -> Order:
    return fit_bucket(e, RAW)


OUTLIER_SQL = """SELECT event_id, CASE WHEN count(*) OVER w = 201 AND stddev_pop(value) OVER w > 0
THEN abs((value - avg(value) OVER w) / stddev_pop(value) OVER w) >= 3.2905267314919255 ELSE false END AS is_outlier FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 100 PRECEDING AND 100 FOLLOWING)"""


@query("outlier_flags", OUTLIER_SQL)
def outlier_flags(spark, folder):
    e = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    return windows.detect_outliers(e, "value", raw_order(e), n=200).select("event_id", "is_outlier")


@query("low_outlier_flags", OUTLIER_SQL.replace("abs((value - avg(value) OVER w) / stddev_pop(value) OVER w) >= 3.2905267314919255",
                                                "(value - avg(value) OVER w) / stddev_pop(value) OVER w <= -0.8416212335729143"))
def low_outlier_flags(spark, folder):
    e = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    return windows.detect_outliers(e, "value", raw_order(e), n=200, p=0.2, side="low").select("event_id", "is_outlier")


@query("outliers_removed", f"WITH {WIDE_SQL}, " + ", ".join(
    f"o_{t} AS (SELECT time, CASE WHEN count(*) OVER w = 101 AND stddev_pop({t}) OVER w > 0 AND "
    f"abs(({t} - avg({t}) OVER w) / stddev_pop({t}) OVER w) >= 3.2905267314919255 THEN NULL ELSE {t} END AS {t} FROM hw "
    f"WHERE {t} IS NOT NULL WINDOW w AS (ORDER BY time ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING))" for t in TYPES)
    + " SELECT hw.time, " + ", ".join(f"o_{t}.{t}" for t in TYPES) + " FROM hw "
    + " ".join(f"LEFT JOIN o_{t} ON hw.time = o_{t}.time" for t in TYPES))
def outliers_removed(spark, folder):
    return windows.remove_outliers(wide(spark, folder), TYPES, HOUR, n=100)


def _trailing_sql(source: str, part: str, w: int) -> str:
    frame = f"({part} ORDER BY time ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return (f"s AS (SELECT *, CASE WHEN count(y) OVER w = {w} THEN avg(y) OVER w END AS trailing_mean FROM {source} WINDOW w AS {frame}), "
            f"q AS (SELECT *, CASE WHEN count(*) OVER w = {w} THEN avg(pow(trailing_mean - y, 2)) OVER w END AS trailing_mse "
            f"FROM s WHERE trailing_mean IS NOT NULL WINDOW w AS {frame})")


@query("trailing_means", f"WITH {KEYED_SQL}, {_trailing_sql('hk', 'PARTITION BY event_type', 24)} SELECT event_type, time, y, round(trailing_mean, 6) AS trailing_mean FROM s")
def trailing_means(spark, folder):
    return rounded(windows.trailing_mean(keyed(spark, folder), "y", 24, TYPED))


@query("trailing_squared_errors", f"WITH {KEYED_SQL}, {_trailing_sql('hk', 'PARTITION BY event_type', 24)} "
       "SELECT event_type, time, y, round(trailing_mean, 6) AS trailing_mean, round(trailing_mse, 4) AS trailing_mse FROM q")
def trailing_squared_errors(spark, folder):
    out = windows.trailing_mse(keyed(spark, folder), "y", 24, TYPED)
    return rounded(out.withColumn("trailing_mse", F.round("trailing_mse", 4)))


@query("constant_baseline", f"WITH {DAILY_SQL}, {_trailing_sql('d', '', 365)} SELECT time AS last_time, round(trailing_mean, 2) AS point_forecast, "
       "round(trailing_mse / 1e6, 2) AS variance_forecast FROM q QUALIFY row_number() OVER (ORDER BY time DESC) = 1")
def constant_baseline(spark, folder):
    out = windows.constant_baseline(daily(spark, folder), "y", HOUR, 365)
    return rounded(out.withColumn("variance_forecast", F.col("variance_forecast") / 1e6), 2)


@query("holdout_split", f"WITH {KEYED_SQL} SELECT event_type, time, y, row_number() OVER (PARTITION BY event_type ORDER BY time) > "
       "count(*) OVER (PARTITION BY event_type) - ceil(count(*) OVER (PARTITION BY event_type) * 0.1) AS is_holdout FROM hk")
def holdout_split(spark, folder):
    return windows.split_holdout(keyed(spark, folder), TYPED)


@query("cutoff_split", f"WITH {DAILY_SQL} SELECT time, y, time >= TIMESTAMP '1999-06-01' AS is_holdout FROM d")
def cutoff_split(spark, folder):
    return windows.split_at(daily(spark, folder), "time", "1999-06-01")


@query("lookback_tail", f"WITH {KEYED_SQL} SELECT * FROM hk QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY time DESC) <= 48")
def lookback_tail(spark, folder):
    return windows.tail(keyed(spark, folder), 48, TYPED)


@query("lag_vectors", f"WITH {KEYED_SQL} SELECT *, " + ", ".join(f"lag(y, {i}) OVER w AS y_lag{i}" for i in (1, 2, 3))
       + " FROM hk WINDOW w AS (PARTITION BY event_type ORDER BY time)")
def lag_vectors(spark, folder):
    return windows.with_lags(keyed(spark, folder), ["y"], 3, TYPED)


@query("forecast_context", f"WITH {KEYED_SQL} SELECT event_type, time, y FROM hk QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY time DESC) <= 10")
def forecast_context(spark, folder):
    return windows.lag_context(keyed(spark, folder), ["y"], 10, TYPED)


SAMPLE_SQL = f"""{KEYED_SQL}, s AS (SELECT event_type, time, count(*) OVER w AS n, first_value(y) OVER w AS oldest, y AS newest,
round(sum(y) OVER w, 4) AS total, lead(time, 24) OVER o AS target_time, lead(y, 24) OVER o AS target FROM hk
WINDOW w AS (PARTITION BY event_type ORDER BY time ROWS BETWEEN 47 PRECEDING AND CURRENT ROW), o AS (PARTITION BY event_type ORDER BY time)),
sm AS (SELECT * EXCLUDE (n) FROM s WHERE n = 48 AND target_time IS NOT NULL)"""


def _samples(spark, folder) -> DataFrame:
    return windows.sequence_windows(keyed(spark, folder), ["y"], "y", 48, 24, TYPED)


@query("sequence_samples", f"WITH {SAMPLE_SQL} SELECT * FROM sm")
def sequence_samples(spark, folder):
    values = F.transform("inputs", lambda v: v[0])
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return _samples(spark, folder).select("event_type", "time", values[0].alias("oldest"), values[47].alias("newest"),
                                          F.round(total, 4).alias("total"), "target_time", "target")


@query("validation_samples", f"WITH {SAMPLE_SQL} SELECT event_type, time, target_time, row_number() OVER (PARTITION BY event_type ORDER BY time) > "
       "count(*) OVER (PARTITION BY event_type) - floor(count(*) OVER (PARTITION BY event_type) * 0.1) AS is_validation FROM sm")
def validation_samples(spark, folder):
    samples = _samples(spark, folder).select("event_type", "time", "target_time")
    return windows.split_tail_samples(samples, TYPED, 0.1)


@query("expanding_folds", f"""WITH {KEYED_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY time) - 1 AS pos,
count(*) OVER (PARTITION BY event_type) AS total FROM hk)
SELECT event_type, time, y, CAST(greatest(0, CAST(floor((pos - (total - 5 * (total // 6))) / (total // 6)) AS BIGINT) + 1) AS INTEGER) AS segment FROM n""")
def expanding_folds(spark, folder):
    return windows.expanding_folds(keyed(spark, folder), TYPED, 5)


@query("row_positions", f"WITH {KEYED_SQL} SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY time) - 1 AS pos, "
       "count(*) OVER (PARTITION BY event_type) AS n FROM hk")
def row_positions(spark, folder):
    return with_position(keyed(spark, folder), TYPED, "pos", "n")


@query("variance_trend", f"WITH {KEYED_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY time) AS step FROM hk) "
       "SELECT event_type, time, step, round(y + 0.5 * step, 6) AS y FROM s")
def variance_trend(spark, folder):
    steps = with_position(keyed(spark, folder), TYPED, "step").withColumn("step", F.col("step") + 1)
    return rounded(windows.add_variance_trend(steps, "y", "step", 0.5))


@query("backfilled", f"WITH {WIDE_SQL} SELECT time, " + ", ".join(
    f"first_value({t} IGNORE NULLS) OVER w AS {t}" for t in TYPES)
    + " FROM hw WINDOW w AS (ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
def backfilled(spark, folder):
    return windows.backfill(wide(spark, folder), TYPES, Order("time", bucket_seconds=86_400))


@query("sorted_by_time", "SELECT event_id, ts FROM events ORDER BY ts, event_id")
def sorted_by_time(spark, folder):
    return windows.sort_time(table(spark, folder, "events").select("event_id", "ts"), Order("ts", ties=("event_id",)))


@query("first_and_last_rows", f"WITH {HOURLY_SQL} (SELECT * FROM h ORDER BY time LIMIT 4) UNION ALL (SELECT * FROM h ORDER BY time DESC LIMIT 4)")
def first_and_last_rows(spark, folder):
    h = hourly(spark, folder)
    return align.append(windows.head(h, 4, HOUR), windows.tail(h, 4, HOUR))


@query("horizon_slice", f"WITH {HOURLY_SQL}, s AS (SELECT *, row_number() OVER (ORDER BY time) AS step FROM h) SELECT * FROM s WHERE step <= 7 * 24 + 1")
def horizon_slice(spark, folder):
    steps = with_position(hourly(spark, folder), HOUR, "step").withColumn("step", F.col("step") + 1)
    return windows.horizon_slice(steps, 7)


RAIN_SQL = ("CASE WHEN value / 300 <= 0.0001 THEN 'None' WHEN value / 300 <= 0.05 THEN 'Light Rain' "
            "WHEN value / 300 <= 0.33 THEN 'Medium Rain' ELSE 'Heavy Rain' END")


def _rain(spark, folder) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", (F.col("value") / 300).alias("rain"))
    return e.select("event_id", cells.bin_label("rain", cells.RAIN_EDGES, cells.RAIN_LABELS).alias("rain"))


@query("binned_values", f"SELECT event_id, {RAIN_SQL} AS rain FROM events")
def binned_values(spark, folder):
    return _rain(spark, folder)


@query("ordinal_levels", f"SELECT event_id, CAST(list_position(['Heavy Rain', 'Light Rain', 'Medium Rain', 'None'], {RAIN_SQL}) - 1 AS INTEGER) AS level FROM events")
def ordinal_levels(spark, folder):
    return _rain(spark, folder).select("event_id", cells.level_rank("rain", cells.RAIN_LEVELS).alias("level"))


@query("one_hot_levels", f"WITH r AS (SELECT event_id, {RAIN_SQL} AS rain FROM events) SELECT event_id, " + ", ".join(
    f"CAST(rain = '{v}' AS INTEGER) AS \"rain_{v}\"" for v in cells.RAIN_LEVELS[1:]) + " FROM r")
def one_hot_levels(spark, folder):
    return one_hot(_rain(spark, folder), "rain", cells.RAIN_LEVELS)


@query("time_features", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, "
       "CAST(dayofyear(ts) AS INTEGER) AS day_of_year FROM events")
def time_features(spark, folder):
    e = table(spark, folder, "events")
    return e.select("event_id", timekeys.hour_of_day("ts").alias("hour_of_day"), timekeys.day_of_week("ts").alias("day_of_week"),
                    timekeys.day_of_year("ts").alias("day_of_year"))


SCALED_SQL = """r AS (SELECT l_returnflag, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1),
m AS (SELECT l_orderkey, l_linenumber, l_returnflag, low, high, (l_extendedprice - low) / (high - low) AS scaled FROM lineitem JOIN r USING (l_returnflag))"""


def _scaled(spark, folder) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    ranges = cells.minmax_fit(items, ["l_extendedprice"], ["l_returnflag"])
    low, high = F.col("low_l_extendedprice"), F.col("high_l_extendedprice")
    return attach(items, ranges, ["l_returnflag"]).withColumn("scaled", cells.scale_unit("l_extendedprice", low, high))


@query("minmax_scaled", f"WITH {SCALED_SQL} SELECT l_orderkey, l_linenumber, round(scaled, 9) AS scaled FROM m")
def minmax_scaled(spark, folder):
    return rounded(_scaled(spark, folder).select("l_orderkey", "l_linenumber", "scaled"), 9)


@query("minmax_inverted", f"WITH {SCALED_SQL} SELECT l_orderkey, l_linenumber, round(scaled * (high - low) + low, 4) AS price FROM m")
def minmax_inverted(spark, folder):
    back = cells.unscale_unit("scaled", F.col("low_l_extendedprice"), F.col("high_l_extendedprice"))
    return rounded(_scaled(spark, folder).select("l_orderkey", "l_linenumber", back.alias("price")), 4)


@query("clipped_values", "SELECT event_id, least(greatest(value - 20, 0.0), 100.0) AS value FROM events")
def clipped_values(spark, folder):
    return table(spark, folder, "events").select("event_id", cells.clip(F.col("value") - 20, 0, 100).alias("value"))


@query("confidence_bounds", "SELECT l_orderkey, l_linenumber, round(l_extendedprice - 1.96 * sqrt(l_quantity), 6) AS lower, "
       "round(l_extendedprice + 1.96 * sqrt(l_quantity), 6) AS upper FROM lineitem")
def confidence_bounds(spark, folder):
    items = table(spark, folder, "lineitem")
    return rounded(items.select("l_orderkey", "l_linenumber", cells.lower_bound("l_extendedprice", "l_quantity").alias("lower"),
                                cells.upper_bound("l_extendedprice", "l_quantity").alias("upper")))


@query("error_multiples", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE round(l_tax / l_discount, 6) END AS multiple FROM lineitem")
def error_multiples(spark, folder):
    items = table(spark, folder, "lineitem")
    return rounded(items.select("l_orderkey", "l_linenumber", cells.error_multiple("l_tax", "l_discount").alias("multiple")))


@query("time_texts", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%Y-%m-%dT%H') AS hour_text, "
       "strftime(o_orderdate, '%Y-%m') AS month_text FROM orders")
def time_texts(spark, folder):
    o = table(spark, folder, "orders")
    return o.select("o_orderkey", F.year("o_orderdate").alias("year"), timekeys.hour_key("o_orderdate").alias("hour_text"),
                    timekeys.month_key("o_orderdate").alias("month_text"))


@query("ordered_chain", f"""WITH {KEYED_SQL}, p AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY event_type) AS n,
  lag(y) OVER w AS y_lag1, lag(y, 2) OVER w AS y_lag2, CASE WHEN count(y) OVER m = 24 THEN avg(y) OVER m END AS mean
  FROM hk WINDOW w AS (PARTITION BY event_type ORDER BY time), m AS (PARTITION BY event_type ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
SELECT event_type, time, y, pos, round(y_lag1, 6) AS y_lag1, round(y_lag2, 6) AS y_lag2, round(mean, 6) AS mean, pos >= n - ceil(n * 0.1) AS is_holdout FROM p""")
def ordered_chain(spark, folder):
    rows, order = order_index(keyed(spark, folder), TYPED)  # sorted and stored once for all four operators
    rows = with_position(rows, order)
    rows = windows.with_lags(rows, ["y"], 2, order)
    rows = windows.trailing_mean(rows, "y", 24, order, "mean")
    return rounded(windows.split_holdout(rows, order, 0.1).drop("_bucket"))


@query("permuted_values", f"""WITH {KEYED_SQL}, p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY time) - 1 AS pos,
  count(*) OVER (PARTITION BY event_type) AS n FROM hk),
s AS (SELECT *, list_reduce(list_prepend({{'x': pos, 'n': n, 'k': 0::BIGINT, 'm': 0::BIGINT, 's': 0::BIGINT}}, list_transform({[list(k) for k in shuffle_keys(11)]},
    lambda k: {{'x': 0::BIGINT, 'n': n, 'k': k[1]::BIGINT, 'm': k[2]::BIGINT, 's': k[3]::BIGINT}})),
  lambda a, b: {{'x': CASE WHEN ((greatest(a.x, (b.k - a.x) % a.n + CASE WHEN (b.k - a.x) % a.n < 0 THEN a.n ELSE 0 END) % {SHUFFLE_PRIME} * b.m + b.s) % {SHUFFLE_PRIME})
      * ((greatest(a.x, (b.k - a.x) % a.n + CASE WHEN (b.k - a.x) % a.n < 0 THEN a.n ELSE 0 END) % {SHUFFLE_PRIME} * b.m + b.s) % {SHUFFLE_PRIME}) % {SHUFFLE_PRIME} % 2 = 1
    THEN (b.k - a.x) % a.n + CASE WHEN (b.k - a.x) % a.n < 0 THEN a.n ELSE 0 END ELSE a.x END, 'n': a.n, 'k': b.k, 'm': b.m, 's': b.s}}).x AS other FROM p)
SELECT s.event_type, s.time, s.y, q.y AS perm_y FROM s JOIN p q ON q.event_type = s.event_type AND q.pos = s.other""")
def permuted_values(spark, folder):
    return permuted(keyed(spark, folder), ["y"], TYPED, 11)


_ODD_SQL = "o AS (SELECT event_type, time, CASE WHEN hour(time) = 3 AND day(time) = 5 THEN 'Infinity'::DOUBLE WHEN hour(time) = 7 AND day(time) = 9 THEN 'NaN'::DOUBLE ELSE y END AS y FROM hk)"


def _with_odd_values(spark, folder) -> DataFrame:
    odd = F.when((F.hour("time") == 3) & (F.dayofmonth("time") == 5), float("inf")).when((F.hour("time") == 7) & (F.dayofmonth("time") == 9), float("nan"))
    return keyed(spark, folder).withColumn("y", odd.otherwise(F.col("y")))


def _means_sql(w: int) -> str:
    frame = f"OVER (PARTITION BY event_type ORDER BY time ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(v) {frame} = {w} THEN round(avg(v) {frame}, 5) END AS mean{w}"


@query("means_with_odd_values", f"WITH {KEYED_SQL}, {_ODD_SQL}, f AS (SELECT event_type, time, CASE WHEN isfinite(y) THEN y END AS v FROM o) "
       f"SELECT event_type, time, {_means_sql(24)}, {_means_sql(255)}, {_means_sql(257)} FROM f")
def means_with_odd_values(spark, folder):
    rows, order = order_index(_with_odd_values(spark, folder), TYPED)
    for w in (24, 255, 257):
        rows = windows.trailing_mean(rows, "y", w, order, f"mean{w}")
    return rounded(rows.drop("_bucket", "y"), 5)


@query("quartiles_with_odd_values", f"WITH {KEYED_SQL}, {_ODD_SQL} SELECT event_type, round(quantile_cont(y, 0.25), 6) AS q0, round(quantile_cont(y, 0.5), 6) AS q1, "
       "round(quantile_cont(y, 0.75), 6) AS q2 FROM o WHERE NOT isnan(y) GROUP BY 1")
def quartiles_with_odd_values(spark, folder):
    return rounded(describe.quantiles(_with_odd_values(spark, folder), "y", (0.25, 0.5, 0.75), ["event_type"]))
