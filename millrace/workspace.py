"""Shared scratch space: stream checkpoints, drained outputs and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a temporary folder.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(SETTING, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder, so a lost executor costs a re-read at most."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
