"""Discovery of input files and readers of saved documents."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import content_name


def scan(spark: SparkSession, folder: str, extensions: list[str], limit: int | None = None, content: bool = False) -> DataFrame:
    """(path, length, modificationTime[, content]) of the files below a folder with one of the extensions, in lower case or not, ordered by the lower-cased path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    names = [e.lower() if e.startswith(".") else "." + e.lower() for e in extensions]
    extension = F.lower(F.regexp_extract("path", r"(\.[^./\\]+)$", 1))
    found = files.filter(extension.isin(*names)).select("path", "length", "modificationTime", *(["content"] if content else []))
    found = found.orderBy(F.lower("path"), "path")
    return found.limit(limit) if limit is not None else found


def with_digests(files: DataFrame, content: str = "content") -> DataFrame:
    return files.withColumn("sha256", F.sha2(content, 256)).withColumn("sha1", F.sha1(F.col(content)))


def discover(incoming: DataFrame, registered: DataFrame, limit: int | None = None) -> DataFrame:
    """New files: contents that are not registered, the first path of each content; the limit counts after that.

    incoming (path, sha256); registered (video_id, sha256, active).
    """
    first = Window.partitionBy("sha256").orderBy(F.lower("path"), "path")
    new = incoming.join(registered.select("sha256"), "sha256", "left_anti").withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    return new.orderBy(F.lower("path"), "path").limit(limit) if limit is not None else new


def duplicates(incoming: DataFrame, registered: DataFrame) -> DataFrame:
    """(path, video_id, active) of incoming files whose content is registered."""
    return incoming.join(registered.select("sha256", "video_id", "active"), "sha256").select("path", "video_id", "active")


def named(files: DataFrame) -> DataFrame:
    """Adds video_id: V_ and 6, 8, 10 or 12 digits of the content's SHA-1, the shortest that no earlier content has; then a number."""
    contents = files.groupBy("sha1").agg(F.min(F.lower("path")).alias("_first"))
    out = contents
    length: Column = F.lit(None).cast("int")
    for size in (6, 8, 10, 12):
        earlier = F.row_number().over(Window.partitionBy(F.substring("sha1", 1, size)).orderBy("_first", "sha1"))
        out = out.withColumn(f"_r{size}", earlier)
    for size in (12, 10, 8, 6):
        length = F.when(F.col(f"_r{size}") == 1, size).otherwise(length)
    short = F.coalesce(*[F.when(length == s, content_name(F.col("sha1"), s)) for s in (6, 8, 10, 12)])
    rest = F.concat(content_name(F.col("sha1"), 10), F.lit("_"), (F.col("_r10") - 1).cast("string"))
    return files.join(out.select("sha1", F.coalesce(short, rest).alias("video_id")), "sha1")


def read_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A JSON document per file: unknown keys are ignored, missing ones null."""
    return spark.read.option("multiLine", "true").schema(schema).json(path)


def typed(rows: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Declared columns only, missing optional ones by default; a missing or null required one ends the job."""
    defaults = defaults or {}
    out = []
    for field in schema.fields:
        have = F.col(field.name).cast(field.dataType) if field.name in rows.columns else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            have = F.coalesce(have, F.lit(defaults[field.name]).cast(field.dataType))
        elif not field.nullable:
            if field.name not in rows.columns:
                raise TypeError(f"missing required column {field.name}")
            have = F.when(have.isNull(), F.raise_error(F.lit(f"null in required column {field.name}"))).otherwise(have)
        out.append(have.alias(field.name))
    return rows.select(*out)


def overlay(staged: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Staged rows, and the base's rows for keys that are not staged."""
    return staged.unionByName(base.join(staged.select(key), key, "left_anti"))


def safe_relative(path: str) -> str:
    """A relative path without drive or '..', as posix; anything else is refused."""
    plain = path.replace("\\", "/")
    parts = PurePosixPath(plain).parts
    if not plain or plain.startswith("/") or (len(plain) > 1 and plain[1] == ":") or ".." in parts:
        raise ValueError(f"relative path expected: {path}")
    return str(PurePosixPath(plain))
