"""Cutting a plan: a checkpoint on the cluster's shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; local sessions may go without that setting."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp())
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, in the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(rows: DataFrame) -> DataFrame:
    """rows, computed once and read from the shared folder from here on."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()
