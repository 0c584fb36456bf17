"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options the engine relies on; safe to call more than once.

    Functions that run inside tasks travel with the job, so executors need no copy of the package.
    """
    import tidecast

    cloudpickle.register_pickle_by_value(tidecast)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")  # long texts: a batch is held on both sides
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: what ``spark.checkpoint.dir`` names, shared by all executors.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidecast-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark).rstrip('/')}/tidecast/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    Meant for model tables (one row per series): the copy survives the loss of executors, and the
    file sizes let the planner choose join sides by what was measured.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
