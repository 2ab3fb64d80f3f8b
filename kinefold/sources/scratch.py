"""A shared folder for datasets written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in spark.checkpoint.dir; where that is unset, which only a local session may leave so, in one temporary folder per application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
        base = _own[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def published(df: DataFrame, label: str) -> DataFrame:
    """Write rows once and read them back: for those that cost much and are read several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
