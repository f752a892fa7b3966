"""Folders and reliable checkpoints on storage all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; a temporary one only where nothing is set."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        # local-cluster has executors of its own, which share no folder by themselves.
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="packwright-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the checkpoint folder; it is deleted when Spark ends."""
    context = spark.sparkContext
    root = f"{checkpoint_folder(spark).rstrip('/')}/scratch-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(path):
        store.mkdirs(path)
        store.deleteOnExit(path)
    return f"{root}/run-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder; lineage ends there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
