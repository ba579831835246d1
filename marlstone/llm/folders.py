"""Tables that are kept between the steps of an operator, in the folder that the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Where `kept` notes its folders, within a block of `released`.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`. Only a session on one machine may do without."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top is None:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/marlstone-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows of `df`, written once to the shared folder and read back: later steps start there."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    folders = _FOLDERS.get()
    if folders is not None:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


def emptied(spark: SparkSession, path: str) -> None:
    """Replace the table in a folder by one without rows."""
    spark.createDataFrame([], "none int").write.mode("overwrite").parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables that are kept within the block are emptied at its end.

    What is computed from them must be written by then.
    """
    token = _FOLDERS.set([])
    try:
        yield
    finally:
        folders = _FOLDERS.get() or []
        _FOLDERS.reset(token)
        for path in folders:
            emptied(spark, path)


def freed(df: DataFrame) -> DataFrame:
    """`df` as it is. Spark deletes shuffles that nothing refers to when the driver collects garbage.

    The last job's are still referred to until another has run.
    """
    df.isEmpty()
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df
