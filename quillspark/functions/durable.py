"""Intermediate results that are used more than once, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of checkpoints that are known; each belongs to one application alone.
_own: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Without one, a temporary folder on a local master; on a cluster executors could not reach that, so it is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quillspark-"))
    folder = context.getCheckpointDir()
    if folder not in _own:
        _own.add(folder)
        gone_at_end(spark, folder)
    return folder


def gone_at_end(spark: SparkSession, path: str) -> None:
    """Have a path deleted when the driver's file system is closed."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which is deleted when the driver ends."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_path(spark: SparkSession, kind: str = "table") -> str:
    """A path of its own in the shared folder; what is written there is deleted when the driver's file system is closed."""
    path = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    gone_at_end(spark, path)
    return path


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table: smaller than a checkpoint, and read by column."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system exists."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
