"""Where intermediate results go: the shared folder the session names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local test session gets one of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="dimload-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def is_local_folder(path: str) -> bool:
    return path.startswith(("file:", "/"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them from there.

    What depends on where a row sits (its task, its place in the task) is stable
    from here on, also when executors are lost.
    """
    sc = df.sparkSession.sparkContext
    folder = scratch_dir(df.sparkSession)
    known = sc.getCheckpointDir()
    if not known:
        sc.setCheckpointDir(folder)
    elif is_local_folder(known) and not sc.master.startswith("local") and not is_local_folder(folder):
        raise ValueError(f"the context's checkpoint folder {known} is not {folder}, which all executors share")
    return df.checkpoint(eager=True)
