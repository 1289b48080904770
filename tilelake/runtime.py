"""Shared folder and lineage cuts for jobs that must survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="tilelake-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder, never used before."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
