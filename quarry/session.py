"""What sources and operators ask of the session."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def importable(spark: SparkSession) -> None:
    """In local mode, lets Python workers find this package wherever the driver was started.  (On a cluster it is deployed with
    the job, as any package.)"""
    context, root = spark.sparkContext, str(Path(__file__).resolve().parents[1])
    paths = context.environment.get("PYTHONPATH", "")
    if context.master.startswith("local") and root not in paths.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for what is written and read again, in the folder that the session names as shared (in local mode without
    one, a temporary folder); it is deleted when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quarry-")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{path.toString()}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
