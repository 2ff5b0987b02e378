"""Session settings and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from rangeloom.sources import store

# What a failed job raises on the driver.
JOB_ERRORS = (PySparkException, Py4JJavaError)

# Settings for large loads: let the runtime re-plan, split skewed joins, merge
# small shuffle partitions, and move rows to Python and the driver as Arrow.
LOAD_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def load_session(app_name: str = "rangeloom", **settings: str) -> SparkSession:
    """Get or create a session with :data:`LOAD_SETTINGS`; ``settings`` win over them.

    Keys are given with ``__`` for ``.``, for example ``spark__sql__shuffle__partitions="400"``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in LOAD_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data: the cluster's ``spark.checkpoint.dir``.

    Without that setting, only a session within one process may fall back on a temporary
    folder: files on one machine would be lost with it, and other machines do not see them.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="rangeloom-checkpoint-")
        store.delete_at_end(spark, folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, deleted with all that is there when the driver ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    store.delete_at_end(spark, path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a small ``df`` to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def set_aside(df: DataFrame) -> DataFrame:
    """Write a large ``df`` to the shared folder as Parquet and go on from there.

    Smaller than a checkpoint, and later steps read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "aside")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cause_of(error: Exception) -> str:
    """The innermost cause of a failed job, in one line."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    causes = [line.removeprefix("Caused by: ") for line in lines if line.startswith("Caused by: ")]
    return (causes or lines or [type(error).__name__])[-1 if causes else 0]
