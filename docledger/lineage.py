"""Cutting lineage in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset and all runs in one process (tests) a temporary one is set first."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found:
        if not current.isDefined():
            spark.sparkContext.setCheckpointDir(found)
        return found
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is unset: a folder that the driver and all executors share is needed on a cluster")
    made = tempfile.mkdtemp(prefix="docledger-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder: later reads survive lost executors and do not compute df again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same rows, as Parquet in the shared folder: smaller than a checkpoint, and read by column."""
    at = f"{shared_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
