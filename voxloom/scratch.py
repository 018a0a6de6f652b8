"""Intermediate results, in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Where each materialized frame lies, for ``discard``.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, below it one of this application.

    Where that is unset, a local session (as in tests) uses a temporary folder of this machine; on a
    cluster that would lose rows, as executors see only their own disks, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir isn't set; intermediate results need a folder that driver and executors share")
        named = f"file://{os.path.join(tempfile.gettempdir(), f'voxloom-{os.getpid()}')}"
    return f"{named}/voxloom-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: an executor that is lost later costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _paths[back] = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for this frame; nothing may be read from it any more."""
    if path := _paths.pop(df, None):
        _delete(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate results of this application, once its results are written."""
    _delete(spark, shared_folder(spark))
