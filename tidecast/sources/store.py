"""The store of fitted models: versions of their tables, published by a manifest that is written last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "version long, folder string, kind string, settings string, tables array<struct<name: string, rows: long, checksum: string>>"


def _fingerprint(df: DataFrame) -> tuple[int, str]:
    """Rows and a checksum that does not depend on their order."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))).first()
    return row[0], str(row[1])


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The published versions of a store, none if there is no store yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def publish(kind: str, tables: Mapping[str, DataFrame], settings: Mapping, path: str, spark: SparkSession) -> int:
    """Write the tables of a model as a new version; returns its number.

    Each version has a folder of its own.  Its line in the manifest, with rows and checksums as they were read back, is
    written when all tables are complete, so a reader sees a whole version or none, and earlier ones stay.
    """
    number = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    folder = f"{number:06d}-{uuid.uuid4().hex}"
    written = []
    for name, df in tables.items():
        place = f"{path.rstrip('/')}/tables/{folder}/{name}"
        df.write.parquet(place)
        written.append((name, *_fingerprint(spark.read.schema(df.schema).parquet(place))))
    line = spark.createDataFrame([(number, folder, kind, json.dumps(settings), written)], MANIFEST)
    line.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/manifest")
    return number


def fetch(kind: str, path: str, spark: SparkSession, version: int | None = None) -> tuple[dict[str, DataFrame], dict]:
    """Tables and settings of a version, by default the newest; tables that are not as published are refused."""
    known = versions(spark, path)
    known = known.filter(F.col("version") == version) if version is not None else known
    line = known.orderBy(F.desc("version"), F.desc("folder")).first()
    if line is None:
        raise ValueError(f"no published model in {path}")
    if line["kind"] != kind:
        raise ValueError(f"{path} holds a model of kind {line['kind']}, not {kind}")
    tables = {}
    for table in line["tables"]:
        df = spark.read.parquet(f"{path.rstrip('/')}/tables/{line['folder']}/{table['name']}")
        if _fingerprint(df) != (table["rows"], table["checksum"]):
            raise ValueError(f"table {table['name']} of version {line['version']} is not as it was published")
        tables[table["name"]] = df
    return tables, json.loads(line["settings"])
