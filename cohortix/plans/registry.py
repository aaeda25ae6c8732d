"""The registry of a run: its tables with the digests of its files, written once and compared on reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, catalog
from .collection import Collection

SCHEMA_VERSION = 1


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of all files below a folder, read and hashed by the executors; paths are relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"
    # schemes may be written with or without slashes for the host
    plain = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")
    return files.select(F.substr(plain(F.col("path")), F.length(plain(F.lit(full))) + 1).alias("path"), F.sha2("content", 256).alias("sha256"))


def tables(c: Collection, artifacts: DataFrame) -> dict[str, DataFrame]:
    """The registry's tables: project, videos (membership), tracks (with both rows) and artifacts."""
    spark = c.videos.sparkSession
    rows = c.records.select("track_id", "cache_row").join(c.active().select("track_id", F.col("active_row").alias("embedding_row")), "track_id", "left")
    return {
        "project": spark.createDataFrame([(SCHEMA_VERSION,)], "schema_version int"),
        "videos": c.membership(),
        "tracks": c.tracks.select("track_id", "video_id").join(rows, "track_id", "left").select("track_id", "video_id", "embedding_row", "cache_row"),
        "artifacts": artifacts.select("path", "sha256"),
    }


def write(c: Collection, artifacts: DataFrame, path: str) -> None:
    """Writes the registry; an existing one is refused."""
    for name, table in tables(c, artifacts).items():
        table.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{name}")


def scan(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in ("project", "videos", "tracks", "artifacts")}


def check(found: dict[str, DataFrame], c: Collection, artifacts: DataFrame) -> None:
    """Ends with RuleBroken if the registry is not that of the collection and its files."""
    wanted = tables(c, artifacts)
    audit.check_all({
        "registry of another version": catalog.set_difference(found["project"], wanted["project"]),
        "registered videos": catalog.set_difference(found["videos"], wanted["videos"]),
        "registered tracks": catalog.set_difference(found["tracks"], wanted["tracks"]),
        "registered files": audit.changed_artifacts(found["artifacts"], wanted["artifacts"]),
    })


def copied(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copies a folder to a new place through the file systems that Spark knows, and gives the digests after comparing them."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    must_be_new(spark, target)
    before = digests(spark, source)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)
    after = digests(spark, target)
    catalog.must_be_empty(audit.changed_artifacts(before, after), "files differ after the copy")
    return after


def must_be_new(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        raise FileExistsError(path)


def must_be_apart(first: str, second: str) -> None:
    """Two folders of which neither lies in the other."""
    a, b = (p.rstrip("/") + "/" for p in (first, second))
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"{first} and {second} overlap")
