"""Reader and writer of two-dimensional float arrays in the npy format."""

from __future__ import annotations

import ast
import io

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_header(data: bytes) -> tuple[np.dtype, tuple[int, int], int]:
    """(type, shape, start of the values); only plain C-ordered float matrices are taken, and nothing is unpickled."""
    if data[:6] != b"\x93NUMPY":
        raise ValueError("not an npy file")
    wide = data[6] >= 2
    size = int.from_bytes(data[8 : 12 if wide else 10], "little")
    start = (12 if wide else 10) + size
    head = ast.literal_eval(data[start - size : start].decode("latin1"))
    kind = np.dtype(head["descr"])
    if kind.kind != "f" or len(head["shape"]) != 2 or head["fortran_order"]:
        raise ValueError("two-dimensional float array expected")
    return kind, tuple(head["shape"]), start


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, row, embedding array<float>) of all npy files at a path, read by Spark and parsed where they are read."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                kind, shape, start = parse_header(content)
                matrix = np.frombuffer(content, kind, shape[0] * shape[1], start).reshape(shape).astype(np.float32)
                for low in range(0, len(matrix), 4096):
                    part = matrix[low : low + 4096]
                    yield pd.DataFrame({"file": name, "row": np.arange(low, low + len(part)), "embedding": list(part)})

    return files.mapInPandas(rows, "file string, row long, embedding array<float>")


def dump(vectors: DataFrame, row: str = "row") -> bytes:
    """The npy file of vectors in the order of a dense row number; for exports that fit the driver."""
    matrix = [r["embedding"] for r in vectors.orderBy(row).select(F.col("embedding").cast("array<float>").alias("embedding")).toLocalIterator()]
    out = io.BytesIO()
    np.save(out, np.asarray(matrix, np.float32) if matrix else np.zeros((0, 0), np.float32), allow_pickle=False)
    return out.getvalue()


def joined(index: DataFrame, vectors: DataFrame, row: str = "embedding_row") -> DataFrame:
    """Index records with their vectors by row; a record without a vector ends the job."""
    v = vectors.select(F.col("row").alias(row), "embedding")
    out = index.join(v, row, "left")
    return out.withColumn("embedding", F.when(F.col("embedding").isNull(), F.raise_error(F.lit("record without a vector"))).otherwise(F.col("embedding")))
