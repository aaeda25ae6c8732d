"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local folder only where it is unset and Spark runs in a single process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="cohortix-"))
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The table, written and read back: a lost executor costs nothing that came before."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return df.sparkSession.read.schema(df.schema).parquet(path)
