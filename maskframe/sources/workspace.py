"""The folder that driver and executors share for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; a temporary folder in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="maskframe-")
    spark.sparkContext.setCheckpointDir(found)
    return found


def folder(spark: SparkSession) -> str:
    """A new folder's name in the shared one; it goes when the driver ends."""
    out = f"{shared_dir(spark)}/maskframe-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    return out


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: what several steps read is worked out once, and lineage ends there."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
