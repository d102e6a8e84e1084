"""Cutting lineage with tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; a folder of this machine only in local mode where none is set."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir", "")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="inkfall-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def _root(df: DataFrame) -> str:
    ensure_checkpoint_dir(df.sparkSession)
    return df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept as a table in the shared checkpoint folder.

    Written by columns and compressed it takes a small part of a checkpoint's disk, what follows reads only the columns it needs, and
    its size is known to the planner. A lost executor loses nothing of it.
    """
    path = f"{_root(df)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Remove the table of a ``cut`` whose rows are no longer needed, as what followed was cut itself; other frames are left alone."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    root = _root(df).removeprefix("file:").lstrip("/")
    if len(folders) == 1 and (folder := folders.pop()).removeprefix("file:").lstrip("/").startswith(root + "/"):
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
