"""Queries over sources and sinks, cleaning, joins and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.functions import cells, timekeys
from tidecast.operators import align, clean, windows
from tidecast.operators.position import Order
from tidecast.plans.collect import collect_dataset
from tidecast.plans.registry import (
    DAILY_SQL, HOURLY_SQL, KEYED_SQL, TYPES, WIDE_SQL, daily, hourly, keyed, query, rounded, table, wide)
from tidecast.session import scratch_path
from tidecast.sources import readers
from tidecast.sources.writers import write_dataset

# Order priorities stand for the series of the indicator payload.
SERIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
DAY_STEP = "1 day"


def land_payloads(rows: DataFrame, page, value: str) -> str:
    """Write ``(period, value)`` rows as payload pages, each page with a later second row for its periods."""
    spark = rows.sparkSession
    again = rows.withColumn(value, F.lit("-1"))
    both = rows.withColumn("_copy", F.lit(0)).unionByName(again.withColumn("_copy", F.lit(1)))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_copy", "period", value))),
                         lambda r: F.struct(r.getField("period").alias("period"), r.getField(value).alias(value)))
    pages = both.groupBy(page.alias("_page")).agg(F.struct(listed.alias("data")).alias("response"))
    path = scratch_path(spark, "payload")
    pages.select("response").write.json(path)
    return path


def land_target(df: DataFrame) -> str:
    rows = df.select(timekeys.hour_key("time").alias("period"), F.col("y").cast("decimal(20,2)").cast("string").alias("value"))
    return land_payloads(rows, F.substring("period", 1, 10), "value")


def land_price(orders: DataFrame) -> str:
    rows = orders.groupBy(timekeys.month_key("o_orderdate").alias("period")).agg(
        F.max("o_totalprice").cast("decimal(20,2)").cast("string").alias("price"))
    return land_payloads(rows, F.substring("period", 1, 4), "price")


def weather_rows(orders: DataFrame) -> DataFrame:
    """Observations with dirty cells made of orders."""
    key, out = F.col("o_orderkey"), []
    for i, name in enumerate(readers.WEATHER_VALUES):
        v = (F.col("o_custkey") + i).cast("string")
        mark = F.pmod(key + i, F.lit(10))
        out.append(F.when(mark == 0, "T").when(mark == 1, "*").when(mark == 2, F.concat(v, F.lit("s"))).otherwise(v).alias(name))
    seen = F.timestamp_add("MINUTE", F.pmod(key * 7, F.lit(1440)).cast("int"), F.col("o_orderdate"))
    return orders.select(
        F.date_format(seen, "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.when(F.pmod(key, F.lit(5)) == 0, "FM-12").otherwise("FM-15").alias("REPORT_TYPE"),
        F.when(F.pmod(key, F.lit(7)) == 0, "6").otherwise("7").alias("SOURCE"), *out,
        F.year("o_orderdate").alias("year"))


def land_weather(orders: DataFrame) -> list[str]:
    path = scratch_path(orders.sparkSession, "weather")
    rows = weather_rows(orders)
    rows.write.partitionBy("year").option("header", True).csv(path)
    years = [r["year"] for r in rows.select("year").distinct().orderBy("year").collect()]
    return [f"{path}/year={y}" for y in years]


def land_indicators(orders: DataFrame) -> str:
    monthly = orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    point = F.struct(F.col("y").cast("string").alias("year"),
                     F.concat(F.lit("M"), F.lpad(F.col("m").cast("string"), 2, "0")).alias("period"),
                     F.col("n").cast("string").alias("value"))
    series = monthly.groupBy(F.col("o_orderpriority").alias("seriesID")).agg(F.collect_list(point).alias("data"))
    payload = series.agg(F.struct(F.collect_list(F.struct("seriesID", "data")).alias("series")).alias("Results"))
    path = scratch_path(orders.sparkSession, "indicators")
    payload.write.json(path)
    return path


@query("hourly_target_ingest", f"WITH {HOURLY_SQL} SELECT time, y AS value FROM h")
def hourly_target_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = land_target(hourly(spark, folder))
    return readers.read_hourly_target(spark, path, "value").select("time", cells.to_double("value").alias("value"))


@query("monthly_price_ingest",
       "SELECT strftime(o_orderdate, '%Y-%m') AS month_key, max(o_totalprice) AS price FROM orders GROUP BY 1")
def monthly_price_ingest(spark, folder):
    path = land_price(table(spark, folder, "orders"))
    return readers.read_monthly_price(spark, path, "price").select("month_key", cells.to_double("price").alias("price"))


def _weather_sql() -> str:
    raw, cleaned, out = [], [], []
    for i, c in enumerate(readers.WEATHER_VALUES):
        raw.append(f"CASE (o_orderkey + {i}) % 10 WHEN 0 THEN 'T' WHEN 1 THEN '*' WHEN 2 THEN CAST(o_custkey + {i} AS VARCHAR) || 's' "
                   f"ELSE CAST(o_custkey + {i} AS VARCHAR) END AS {c}")
        cleaned.append(f"CASE WHEN replace({c}, 's', '') IN ('T', '*') THEN NULL ELSE replace({c}, 's', '') END AS {c}")
        out.append(c)
    return (
        "w0 AS (SELECT o_orderdate + to_minutes((o_orderkey * 7) % 1440) AS seen, o_orderkey, "
        + ", ".join(raw) + " FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0), "
        "w1 AS (SELECT seen, " + ", ".join(cleaned) + " FROM w0), "
        "w AS (SELECT date_trunc('hour', seen) AS time, " + ", ".join(out) +
        " FROM w1 {where} QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', seen) ORDER BY seen, "
        "concat_ws('|', " + ", ".join(out) + ")) = 1)")


@query("weather_ingest", "WITH " + _weather_sql().format(
    where="WHERE seen > TIMESTAMP '1996-01-01' AND seen < TIMESTAMP '2000-01-01'") + " SELECT * FROM w")
def weather_ingest(spark, folder):
    paths = land_weather(table(spark, folder, "orders"))
    low, high = (F.lit(t).cast("timestamp_ntz") for t in ("1996-01-01 00:00:00", "2000-01-01 00:00:00"))
    return readers.read_weather(spark, paths, low, high)


INDICATOR_SQL = ("SELECT strftime(o_orderdate, '%Y-%m') AS month_key, " + ", ".join(
    f"CAST(nullif(count(*) FILTER (o_orderpriority = '{k}'), 0) AS DOUBLE) AS {v}" for k, v in SERIES.items())
    + " FROM orders GROUP BY 1")


@query("indicator_ingest", INDICATOR_SQL)
def indicator_ingest(spark, folder):
    path = land_indicators(table(spark, folder, "orders"))
    out = readers.read_indicators(spark, path, SERIES)
    return out.select("month_key", *[cells.to_double(c).alias(c) for c in SERIES.values()])


@query("external_forecast_ingest", f"WITH {HOURLY_SQL} SELECT time + INTERVAL 24 HOUR AS time, y AS forecast FROM h")
def external_forecast_ingest(spark, folder):
    ahead = hourly(spark, folder).withColumn("time", F.timestamp_add("HOUR", F.lit(24), F.col("time")))
    return readers.read_external_forecast(spark, land_target(ahead), "forecast")


@query("dataset_round_trip", f"WITH {WIDE_SQL} SELECT * FROM hw")
def dataset_round_trip(spark, folder):
    path = scratch_path(spark, "dataset")
    write_dataset(wide(spark, folder), path)
    return readers.read_dataset(spark, path, "time timestamp_ntz, " + ", ".join(f"{t} double" for t in TYPES))


@query("report_round_trip", f"WITH {KEYED_SQL} SELECT time, event_type, y FROM hk")
def report_round_trip(spark, folder):
    path = scratch_path(spark, "report")
    write_dataset(keyed(spark, folder).select("time", "event_type", "y"), path, "csv")
    return readers.read_dataset(spark, path, "time timestamp_ntz, event_type string, y double", "csv")


@query("project_columns", "SELECT l_orderkey AS order_key, l_quantity AS quantity, l_shipdate AS time FROM lineitem")
def project_columns(spark, folder):
    return clean.project(table(spark, folder, "lineitem"), ["l_orderkey", "l_quantity", "l_shipdate", "l_tax"],
                         {"l_orderkey": "order_key", "l_quantity": "quantity", "l_shipdate": "time"}, drop=["l_tax"])


@query("filter_by_equality", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
       "WHERE l_returnflag = 'R' AND l_linestatus = 'F'")
def filter_by_equality(spark, folder):
    kept = clean.filter_eq(table(spark, folder, "lineitem"), {"l_returnflag": "R", "l_linestatus": "F"})
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("time_range_filter", "SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2025-01-01'")
def time_range_filter(spark, folder):
    return clean.time_range(table(spark, folder, "events"), "ts", "2024-01-05", "2030-01-01",
                            (clean.EARLIEST, clean.LATEST)).select("event_id", "ts", "value")


DIRTY_SQL = ("e AS (SELECT event_id, ts, CASE event_id % 10 WHEN 0 THEN 'T' WHEN 1 THEN '*' "
             "WHEN 2 THEN json_extract_string(props, '$.k') || 's' WHEN 3 THEN 'Ts' "
             "ELSE json_extract_string(props, '$.k') END AS cell FROM events)")


def dirty(spark, folder) -> DataFrame:
    e = table(spark, folder, "events")
    k = F.from_json("props", "k int").getField("k").cast("string")
    mark = F.pmod("event_id", F.lit(10))
    cell = F.when(mark == 0, "T").when(mark == 1, "*").when(mark == 2, F.concat(k, F.lit("s"))).when(mark == 3, "Ts").otherwise(k)
    return e.select("event_id", "ts", cell.alias("cell"))


@query("clean_text_cells", f"WITH {DIRTY_SQL} SELECT event_id, CASE WHEN replace(cell, 's', '') IN ('T', '*') THEN NULL "
       "ELSE replace(cell, 's', '') END AS cell FROM e")
def clean_text_cells(spark, folder):
    return clean.clean_cells(dirty(spark, folder), ["cell"]).select("event_id", "cell")


@query("cast_to_double", f"WITH {DIRTY_SQL} SELECT event_id, TRY_CAST(cell AS DOUBLE) AS cell FROM e")
def cast_to_double(spark, folder):
    return clean.cast_numeric(dirty(spark, folder), ["cell"])[0].select("event_id", "cell")


@query("cast_losses", f"WITH {DIRTY_SQL} SELECT count(*) FILTER (cell IS NOT NULL AND TRY_CAST(cell AS DOUBLE) IS NULL) AS cell FROM e")
def cast_losses(spark, folder):
    return clean.cast_numeric(dirty(spark, folder), ["cell"])[1]


@query("first_row_per_key", "SELECT user_id, event_id, ts, value FROM events "
       "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def first_row_per_key(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    return clean.first_per_key(e, ["user_id"], [F.col("ts"), F.col("event_id")])


@query("time_keys", "SELECT event_id, date_trunc('hour', ts) AS hour, strftime(ts, '%Y-%m-%dT%H') AS hour_key, "
       "strftime(ts, '%Y-%m') AS month_key, CAST(year(ts) AS INTEGER) AS year FROM events")
def time_keys(spark, folder):
    e = table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"))
    return clean.with_time_keys(e, "seen").select("event_id", "hour", "hour_key", "month_key", "year")


@query("normalized_names", "SELECT l_orderkey AS OrderKey, l_extendedprice AS EnergyPrice, l_quantity AS EnergyDemand FROM lineitem")
def normalized_names(spark, folder):
    named = clean.project(table(spark, folder, "lineitem"), ["l_orderkey", "l_extendedprice", "l_quantity"], {
        "l_orderkey": "Order Key", "l_extendedprice": "Energy Price (cents/KWH)", "l_quantity": "Energy Demand (MWH)"})
    return clean.normalize_names(named)


@query("fill_constant", f"WITH {DIRTY_SQL} SELECT event_id, coalesce(nullif(cell, 'T'), 'None') AS cell FROM e")
def fill_constant(spark, folder):
    cells_ = dirty(spark, folder).withColumn("cell", F.nullif("cell", F.lit("T")))
    return clean.fill_const(cells_, "cell", "None").select("event_id", "cell")


@query("conditional_overwrite", "SELECT event_id, CASE WHEN value > 100 THEN 0.0 ELSE value END AS value FROM events")
def conditional_overwrite(spark, folder):
    e = table(spark, folder, "events")
    return clean.overwrite(e, F.col("value") > 100, "value", 0.0).select("event_id", "value")


@query("complete_rows_only", f"WITH {WIDE_SQL} SELECT * FROM hw WHERE " + " AND ".join(f"{t} IS NOT NULL" for t in TYPES))
def complete_rows_only(spark, folder):
    return clean.complete_rows(wide(spark, folder))


@query("validated_dataset", f"""WITH {WIDE_SQL}, b AS (SELECT count(*) AS n, min(time) AS low, max(time) AS high FROM hw)
SELECT unnest(['column_count', 'column_names', 'time_type', 'not_empty', 'start', 'end']) AS check_name,
       unnest([true, true, true, n > 0, low >= TIMESTAMP '2018-01-01', high <= TIMESTAMP '2024-01-15']) AS passed FROM b""")
def validated_dataset(spark, folder):
    from datetime import datetime
    spec = clean.DatasetSpec("time", tuple(TYPES), clean.EARLIEST, datetime(2024, 1, 15))
    return clean.validate_dataset(wide(spark, folder), spec)


def _injected_sql(c: str) -> str:
    digits = f"md5('5|{c}|' || time::VARCHAR)"
    draw = f"(('0x' || substr({digits}, 1, 8))::BIGINT % 1000000) / 1000000.0"
    extreme = f"avg({c}) OVER () + CASE WHEN substr({digits}, 9, 1) < '8' THEN 1000.0 ELSE -1000.0 END * stddev_samp({c}) OVER ()"
    return f"CASE WHEN {draw} < 0.02 THEN round({extreme}, 4) WHEN {draw} >= 0.04 THEN {c} END AS {c}"


@query("injected_anomalies", f"WITH {WIDE_SQL} SELECT time, {', '.join(map(_injected_sql, TYPES))} FROM hw")
def injected_anomalies(spark, folder):
    return rounded(clean.inject_anomalies(wide(spark, folder), ["time"], TYPES, 0.02, 5), 4)


@query("aligned_sources", f"""WITH {KEYED_SQL} SELECT coalesce(a.time, b.time) AS time, a.y AS demand, b.y AS weather
FROM (SELECT * FROM hk WHERE event_type = 'view') a FULL OUTER JOIN (SELECT * FROM hk WHERE event_type = 'error') b ON a.time = b.time""")
def aligned_sources(spark, folder):
    rows = keyed(spark, folder)
    a = rows.filter("event_type = 'view'").select("time", F.col("y").alias("demand"))
    b = rows.filter("event_type = 'error'").select("time", F.col("y").alias("weather"))
    return align.align(a, b, ["time"])


@query("monthly_attached", f"""WITH {DAILY_SQL},
m AS (SELECT strftime(l_shipdate, '%Y-%m') AS month_key, max(l_extendedprice) AS price FROM lineitem GROUP BY 1)
SELECT coalesce(k.month_key, m.month_key) AS month_key, k.time, k.y, m.price
FROM (SELECT *, strftime(time, '%Y-%m') AS month_key FROM d) k FULL OUTER JOIN m ON k.month_key = m.month_key""")
def monthly_attached(spark, folder):
    monthly = table(spark, folder, "lineitem").groupBy(timekeys.month_key("l_shipdate").alias("month_key")).agg(
        F.max("l_extendedprice").alias("price"))
    return align.attach_monthly(daily(spark, folder), monthly, "time")


COMBINED_SQL = f"""WITH {DAILY_SQL}, p AS (SELECT strftime(o_orderdate, '%Y-%m') AS month_key, max(o_totalprice) AS price
FROM orders WHERE month(o_orderdate) <> 7 GROUP BY 1), i AS ({INDICATOR_SQL}),
w AS (SELECT l_shipdate AS time, sum(l_quantity) AS shipped, CASE WHEN count(*) % 9 = 0 THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS lines
FROM lineitem GROUP BY 1)
SELECT d.time, d.y, w.shipped, w.lines, p.price, i.urgent, i.high, i.medium, i.unspecified, i.low
FROM d LEFT JOIN w ON d.time = w.time LEFT JOIN p ON strftime(d.time, '%Y-%m') = p.month_key
LEFT JOIN i ON strftime(d.time, '%Y-%m') = i.month_key"""


def combined(spark, folder) -> tuple[DataFrame, DataFrame]:
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    price = orders.filter(F.month("o_orderdate") != 7).groupBy(timekeys.month_key("o_orderdate").alias("month_key")).agg(
        F.max("o_totalprice").alias("price"))
    monthly = orders.withColumn("month_key", timekeys.month_key("o_orderdate")).groupBy("month_key").pivot(
        "o_orderpriority", list(SERIES)).agg(F.count(F.lit(1)))
    monthly = monthly.select("month_key", *[F.col(f"`{k}`").alias(v) for k, v in SERIES.items()])
    n = F.count(F.lit(1))
    weather = items.groupBy(F.col("l_shipdate").alias("time")).agg(
        F.sum("l_quantity").alias("shipped"), F.when(n % 9 == 0, "x").otherwise(n.cast("string")).alias("lines"))
    return align.combine(daily(spark, folder), weather, price, monthly)


@query("combined_dataset", COMBINED_SQL)
def combined_dataset(spark, folder):
    return combined(spark, folder)[0]


@query("combined_losses", f"""WITH {DAILY_SQL}, w AS (SELECT l_shipdate AS time, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(0 AS BIGINT) AS y, CAST(0 AS BIGINT) AS shipped, count(*) FILTER (w.n % 9 = 0) AS lines, CAST(0 AS BIGINT) AS price,
CAST(0 AS BIGINT) AS urgent, CAST(0 AS BIGINT) AS high, CAST(0 AS BIGINT) AS medium, CAST(0 AS BIGINT) AS unspecified,
CAST(0 AS BIGINT) AS low FROM d LEFT JOIN w ON d.time = w.time""")
def combined_losses(spark, folder):
    return combined(spark, folder)[1]


def _shifted(orders: DataFrame) -> DataFrame:
    """Orders moved into the supported period."""
    return orders.withColumn("o_orderdate", F.timestamp_add("DAY", F.lit(24 * 365), F.col("o_orderdate")))


@query("collected_dataset")
def collected_dataset(spark, folder):
    orders = _shifted(table(spark, folder, "orders"))
    totals = orders.groupBy(F.col("o_orderdate").alias("time")).agg(F.round(F.sum("o_totalprice"), 2).alias("y"))
    data, _ = collect_dataset(spark, land_target(totals), land_price(orders), land_weather(orders), land_indicators(orders),
                              "1970-01-01", "2030-01-01", SERIES)
    return clean.normalize_names(data)


TRAILED_SQL = f"""{HOURLY_SQL}, s AS (SELECT time, y, CASE WHEN count(y) OVER w = 24 THEN avg(y) OVER w END AS trailing_mean
FROM h WINDOW w AS (ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))"""
HOUR_ORDER = Order("time")


@query("reconciled_forecast", f"WITH {TRAILED_SQL} SELECT s.time, round(s.trailing_mean, 6) AS point, h.y AS actual "
       "FROM s JOIN h ON s.time = h.time WHERE s.trailing_mean IS NOT NULL")
def reconciled_forecast(spark, folder):
    h = hourly(spark, folder)
    forecast = windows.trailing_mean(h, "y", 24, HOUR_ORDER, "point").filter("point is not null").select("time", "point")
    return rounded(align.reconcile(forecast, h.select("time", F.col("y").alias("actual"))))


@query("aligned_forecasts", f"""WITH {KEYED_SQL}, t AS (SELECT time, max(y) FILTER (event_type = 'click') AS click_y,
max(y) FILTER (event_type = 'view') AS view_y, max(y) FILTER (event_type = 'signup') AS actual FROM hk GROUP BY 1)
SELECT * FROM t WHERE click_y IS NOT NULL AND view_y IS NOT NULL AND actual IS NOT NULL""")
def aligned_forecasts(spark, folder):
    rows = keyed(spark, folder)
    part = {t: rows.filter(F.col("event_type") == t).select("time", "y") for t in ("click", "view")}
    actual = rows.filter("event_type = 'signup'").select("time", F.col("y").alias("actual"))
    return align.align_forecasts(part, actual)


@query("kept_times", f"WITH {HOURLY_SQL}, {KEYED_SQL} SELECT * FROM h WHERE time IN (SELECT time FROM hk WHERE event_type = 'error' AND y > 100)")
def kept_times(spark, folder):
    return align.keep_times(hourly(spark, folder), keyed(spark, folder).filter("event_type = 'error' and y > 100"))


@query("excluded_times", f"WITH {HOURLY_SQL}, {KEYED_SQL} SELECT * FROM h WHERE time NOT IN (SELECT time FROM hk WHERE event_type = 'error' AND y > 100)")
def excluded_times(spark, folder):
    return align.exclude_times(hourly(spark, folder), keyed(spark, folder).filter("event_type = 'error' and y > 100"))


CALENDAR_SQL = f"""{KEYED_SQL}, c AS (SELECT event_type, unnest(generate_series(min(time), max(time), INTERVAL 1 HOUR)) AS time
FROM hk GROUP BY 1)"""


@query("filled_calendar", f"WITH {CALENDAR_SQL} SELECT c.event_type, c.time, hk.y FROM c LEFT JOIN hk ON c.event_type = hk.event_type AND c.time = hk.time")
def filled_calendar(spark, folder):
    return align.fill_calendar(keyed(spark, folder), "time", keys=["event_type"])


@query("calendar_gaps", f"WITH {CALENDAR_SQL} SELECT event_type, time FROM c EXCEPT SELECT event_type, time FROM hk")
def calendar_gaps(spark, folder):
    return align.gaps(keyed(spark, folder), "time", keys=["event_type"])


@query("appended_rows", "SELECT o_orderkey AS k, o_orderdate AS time, o_totalprice AS v FROM orders "
       "UNION ALL SELECT l_orderkey, l_shipdate, l_extendedprice FROM lineitem")
def appended_rows(spark, folder):
    a = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("v"))
    b = table(spark, folder, "lineitem").select(F.col("l_extendedprice").alias("v"), F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("time"))
    return align.append(a, b)
