"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition: a word is a run of any other characters.
WORD_BREAKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); one is made only where it is unset and Spark runs in a single process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="cohortix-"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found


#: Rows of an Arrow batch where rows hold whole texts; small batches keep the buffers of both sides small.
TEXT_ROWS = 1000


def materialize(df: DataFrame, name: str, codec: str | None = None, arrow_rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut and a lost executor costs nothing.

    arrow_rows: rows that Spark hands to Python at a time in this job. The table is removed by ``discard`` or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cohortix/{name}-{uuid.uuid4().hex}"
    with arrow_batches(spark, arrow_rows):
        df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._cx_path = path
    system, place = located(spark, path)
    system.deleteOnExit(place)
    return out


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs that run meanwhile hand so many rows to Python at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows is not None:
        spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def located(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the JVM."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def discard(*written: DataFrame) -> None:
    """Deletes tables that materialize has written, once nothing reads them any more."""
    for table in written:
        system, place = located(table.sparkSession, table._cx_path)
        system.delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def id_as_text(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """The id as text, for the way through pandas, which would turn numbers beside nulls into floats."""
    return df.withColumn(name, F.col(name).cast("string"))


def id_restored(df: DataFrame, like: DataFrame, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast(like.schema[name].dataType))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


#: Bits of the filter that may_contain broadcasts: 8 MB, whatever the number of ids.
FILTER_BITS = 1 << 26
BUCKET_BITS = 1 << 15


def may_contain(ids: DataFrame, column: Column) -> Column:
    """A condition that holds for every value of column among the ids (of one column) and for few others while there are few of them.

    It spares a shuffle of rows that a join would drop; the join stays. The filter has a fixed size.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    slots = ids.select(slot(F.col(ids.columns[0])).alias("slot"))
    maps = slots.groupBy(F.floor(F.col("slot") / BUCKET_BITS).alias("bucket")).agg(F.bitmap_construct_agg((F.col("slot") % BUCKET_BITS)).alias("bits"))
    bits = np.zeros((FILTER_BITS // BUCKET_BITS, BUCKET_BITS // 8), np.uint8)
    for row in maps.collect():  # as large as the filter, and one job, while an iterator is a job for each partition
        bits[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(bits.reshape(-1))

    def holds(slots: pd.Series) -> pd.Series:
        s = slots.to_numpy()
        return pd.Series((shared.value[s >> 3] >> (s & 7).astype(np.uint8)) & 1).astype(bool)

    return F.pandas_udf(holds, "boolean")(slot(column))
