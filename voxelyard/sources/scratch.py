"""A folder that driver and executors share, for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path in spark.checkpoint.dir. Where that is unset, and all runs on one machine, a temporary folder
    takes its place; on a cluster a missing setting is an error."""
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not top:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="voxelyard-"))
        top = context.getCheckpointDir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The table, written to such a folder and read again: no lineage, and no loss with an executor."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
