"""The folder that driver and executors share, for what a query writes down on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or its checkpoint folder.

    Where neither is set, a session on one machine gets a temporary folder; on a cluster that would
    lose data, and ValueError is raised.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/tessera/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut through checkpoint() in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
