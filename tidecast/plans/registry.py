"""The registered queries: what each computes on the test tables, and the same in plain SQL where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.functions.timekeys import hour_of
from tidecast.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = lambda spark, folder: run(configure(spark), folder)
        if sql:
            ORACLES[name] = sql
        return run
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


TYPES = ["click", "error", "purchase", "signup", "view"]

# The series the queries work on, each as a table expression of Spark and of SQL.
HOURLY_SQL = "h AS (SELECT date_trunc('hour', ts) AS time, round(sum(value), 2) AS y FROM events GROUP BY 1)"
KEYED_SQL = ("hk AS (SELECT event_type, date_trunc('hour', ts) AS time, round(sum(value), 2) AS y "
             "FROM events GROUP BY 1, 2)")
WIDE_SQL = ("hw AS (SELECT date_trunc('hour', ts) AS time, " + ", ".join(
    f"round(sum(value) FILTER (event_type = '{t}'), 2) AS {t}" for t in TYPES) + " FROM events GROUP BY 1)")
DAILY_SQL = "d AS (SELECT o_orderdate AS time, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1)"


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Sum of event values per hour."""
    e = table(spark, folder, "events")
    return e.groupBy(hour_of("ts").alias("time")).agg(F.round(F.sum("value"), 2).alias("y"))


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """The same per event type."""
    e = table(spark, folder, "events")
    return e.groupBy("event_type", hour_of("ts").alias("time")).agg(F.round(F.sum("value"), 2).alias("y"))


def wide(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly sums, one column per event type, null where a type has no event."""
    e = table(spark, folder, "events")
    return e.groupBy(hour_of("ts").alias("time")).agg(
        *[F.round(F.sum(F.when(F.col("event_type") == t, F.col("value"))), 2).alias(t) for t in TYPES])


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals per day."""
    o = table(spark, folder, "orders")
    return o.groupBy(F.col("o_orderdate").alias("time")).agg(F.round(F.sum("o_totalprice"), 2).alias("y"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if kinds[c] == "double" else F.col(f"`{c}`")
                       for c in df.columns])
