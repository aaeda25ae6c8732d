"""Rules between the tables of a run, each a query that must be empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import catalog, ranges


def check_all(rules: dict[str, DataFrame]) -> None:
    for message, found in rules.items():
        catalog.must_be_empty(found, message)


def widths(records: DataFrame) -> int:
    """How many different dimensions the vectors have."""
    return records.agg(F.countDistinct(F.size("embedding")).alias("n")).first()["n"]


def folder_mismatch(documents: DataFrame) -> DataFrame:
    """Documents (folder, video_id, error) whose folder is not named like their video, or whose analysis failed."""
    wrong = F.when(~F.col("folder").eqNullSafe(F.col("video_id")), "folder").when(F.coalesce("error", F.lit("")) != "", "failed")
    return documents.withColumn("problem", wrong).filter("problem IS NOT NULL").select("video_id", "problem")


def stored_range_mismatch(tracks: DataFrame, frames: DataFrame) -> DataFrame:
    """Tracks whose stored ranges (null: none stored) are not those of their frames."""
    found = ranges.compact(frames, ["track_id"], "frame_index").groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")))).alias("_seen"))
    kind = "array<struct<start:bigint,end:bigint>>"
    stored = F.array_sort(F.col("ranges").cast(kind))
    rows = tracks.filter("ranges IS NOT NULL").select("track_id", stored.alias("_stored")).join(found, "track_id", "left")
    return rows.filter(F.col("_stored") != F.coalesce("_seen", F.array().cast(kind))).select("track_id")


def active_mismatch(active: DataFrame, view: DataFrame) -> DataFrame:
    """Tracks whose stored active row or vector is not that of the cache's active view, or that only one of them has; both (track_id, active_row, embedding)."""
    a = active.select("track_id", F.col("active_row").alias("_r1"), F.col("embedding").cast("array<float>").alias("_e1"))
    b = view.select("track_id", F.col("active_row").alias("_r2"), F.col("embedding").cast("array<float>").alias("_e2"))
    return a.join(b, "track_id", "full").filter(~(F.col("_r1").eqNullSafe(F.col("_r2")) & F.col("_e1").eqNullSafe(F.col("_e2")))).select("track_id")


def counter_mismatch(logged: DataFrame, counted: DataFrame) -> DataFrame:
    """(name, logged, counted) of the counters that a log has and that differ; both (name, n)."""
    a, b = logged.filter("n IS NOT NULL").select("name", F.col("n").cast("long").alias("logged")), counted.select("name", F.col("n").cast("long").alias("counted"))
    return a.join(b, "name", "left").filter(~F.col("logged").eqNullSafe(F.col("counted")))


def album_mismatch(groups: DataFrame, albums: DataFrame) -> DataFrame:
    """(person_id, problem): accepted groups without album metadata, and metadata whose status or tracks differ; both (person_id, export_status, local_tracks)."""
    a = groups.select("person_id", F.col("export_status").alias("_s1"), F.array_sort("local_tracks").alias("_t1"), F.lit(True).alias("_g"))
    b = albums.select("person_id", F.col("export_status").alias("_s2"), F.array_sort("local_tracks").alias("_t2"), F.lit(True).alias("_a"))
    rows = a.join(b, "person_id", "full")
    lost, alone = F.col("_a").isNull() & (F.col("_s1") == "accepted"), F.col("_g").isNull()
    other = F.col("_a") & F.col("_g") & ~(F.col("_s1").eqNullSafe(F.col("_s2")) & F.col("_t1").eqNullSafe(F.col("_t2")))
    problem = F.when(alone, "no_group").when(lost, "no_metadata").when(other, "differs")
    return rows.withColumn("problem", problem).filter("problem IS NOT NULL").select("person_id", "problem")


def index_mismatch(index: DataFrame, documents: DataFrame, columns: list[str]) -> DataFrame:
    """Videos whose index entry differs from their own document in a column (null equals null), or that only one side has."""
    both = catalog.differing(index, documents, "video_id", columns)
    one = catalog.set_difference(index.select("video_id"), documents.select("video_id")).select("video_id")
    return both.unionByName(one)


def missing_embeddings(tracks: DataFrame, records: DataFrame) -> DataFrame:
    """Tracks that have crops but no record."""
    return tracks.filter("crop_count > 0").join(records.select("track_id"), "track_id", "left_anti").select("track_id")


def changed_artifacts(registered: DataFrame, present: DataFrame) -> DataFrame:
    """(path, problem) of files that are new, gone or of other content; both (path, sha256)."""
    rows = registered.select("path", F.col("sha256").alias("_old")).join(present.select("path", F.col("sha256").alias("_new")), "path", "full")
    problem = F.when(F.col("_new").isNull(), "gone").when(F.col("_old").isNull(), "new").when(F.col("_old") != F.col("_new"), "changed")
    return rows.withColumn("problem", problem).filter("problem IS NOT NULL").select("path", "problem")


def state_mismatch(states: DataFrame, tracks: DataFrame, records: DataFrame, active: DataFrame) -> DataFrame:
    """Tracks whose state contradicts the cached record or, by its embedding_row, the active view."""
    cached = catalog.invalid_states(states.drop("embedding_row").withColumnRenamed("cache_row", "embedding_row"), tracks, records.withColumnRenamed("cache_row", "embedding_row"))
    rows = states.select("track_id", "embedding_row").join(active.select("track_id", "active_row"), "track_id", "left")
    return cached.unionByName(rows.filter(~F.col("embedding_row").eqNullSafe(F.col("active_row"))).select("track_id"))
