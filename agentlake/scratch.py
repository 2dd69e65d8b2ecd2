"""Tables between two steps of a job, in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession) -> str:
    """A new path below the cluster's shared checkpoint folder, or in a temporary folder where Spark runs locally."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        shared = tempfile.mkdtemp(prefix="agentlake-")
    return os.path.join(shared, f"agentlake-{uuid.uuid4().hex}")


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write as Parquet and read back: what comes after reads the same rows however often it is run, and a lost executor
    costs no earlier step."""
    place = path or scratch_path(df.sparkSession)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
