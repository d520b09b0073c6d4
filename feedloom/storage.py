"""Shared-folder writes: cut lineage with tables that survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get(_KEY, None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_KEY} to a folder that all executors can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="feedloom-")
    return _own[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/feedloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: what lies before is never computed a second time."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
