"""Where jobs keep intermediate data: the shared folder that the session names."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made for local sessions without a setting.
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, as a whole URI. Only a local master may go without: then a temporary folder is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="agentlake-")
        _own[spark.sparkContext.applicationId] = folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1).replace("file://///", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


#: Folders of the calls inside ``cleaned``, innermost last.
_open: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    folder = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    if _open:
        _open[-1].append(folder)
    return folder


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, at the end, the intermediate folders that operators make inside. They read from these as long as their
    results are lazy, so write a result before the end. Without this, folders stay for whoever owns the shared folder.
    For one thread at a time."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.remove(made)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder as Parquet and read back: lineage ends there, and a lost executor costs no earlier step."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
