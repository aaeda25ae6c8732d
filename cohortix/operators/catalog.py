"""State of a collection: active view, job states and the rules that its tables must hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import as_double, is_valid
from .similarity import dense_rows

# States of a track's embedding job.
STATES = ("complete", "pending", "retryable_error", "no_usable_crops", "blocked_error")


class RuleBroken(ValueError):
    """A table does not hold one of the collection's rules."""


def must_be_empty(found: DataFrame, message: str) -> None:
    """Ends with an error that shows one offending row, if there is any."""
    row = found.limit(1).collect()
    if row:
        raise RuleBroken(f"{message}: {row[0].asDict()}")


def active_view(records: DataFrame, membership: DataFrame) -> DataFrame:
    """Records of active videos with ``active_row`` 0, 1, 2... in the order of cache_row; membership (video_id, active)."""
    active = records.join(membership.filter("active").select("video_id"), "video_id", "left_semi")
    return dense_rows(active, "cache_row").withColumnRenamed("row", "active_row")


def appended(existing: DataFrame, new: DataFrame, order: str, row: str = "cache_row") -> DataFrame:
    """Existing rows and new ones, numbered on from the last."""
    last = existing.agg(F.coalesce(F.max(row), F.lit(-1)).alias("m")).first()["m"]
    numbered = dense_rows(new, order).withColumn("row", F.col("row") + F.lit(int(last) + 1)).withColumnRenamed("row", row)
    return existing.unionByName(numbered, allowMissingColumns=True)


def track_states(tracks: DataFrame, records: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(track_id, status, attempt_count, failed_stage, last_error, embedding_row) of every track.

    tracks (track_id, crop_count); records (track_id, embedding_row); previous: the last states. An embedded track is
    complete and clears its errors, one without crops has no_usable_crops, others keep their state or are pending.
    """
    rows = tracks.select("track_id", "crop_count").join(records.select("track_id", F.col("embedding_row").alias("_row")), "track_id", "left")
    if previous is None:
        for name, kind in (("status", "string"), ("attempt_count", "int"), ("failed_stage", "string"), ("last_error", "string")):
            rows = rows.withColumn("_" + name, F.lit(None).cast(kind))
    else:
        rows = rows.join(previous.select("track_id", *[F.col(c).alias("_" + c) for c in ("status", "attempt_count", "failed_stage", "last_error")]), "track_id", "left")
    done = F.col("_row").isNotNull()
    status = F.when(done, "complete").when(F.coalesce("crop_count", F.lit(0)) == 0, "no_usable_crops").otherwise(F.coalesce("_status", F.lit("pending")))
    return rows.select(
        "track_id", status.alias("status"), F.coalesce("_attempt_count", F.lit(0)).alias("attempt_count"), F.when(~done, F.col("_failed_stage")).alias("failed_stage"),
        F.when(~done, F.col("_last_error")).alias("last_error"), F.col("_row").alias("embedding_row"),
    )


def cache_states(states: DataFrame, records: DataFrame, active: DataFrame) -> DataFrame:
    """States with cache_row (all records) and embedding_row (the active view's)."""
    a = active.select("track_id", F.col("active_row").alias("_active"))
    c = records.select("track_id", "cache_row")
    return states.drop("embedding_row").join(c, "track_id", "left").join(a, "track_id", "left").withColumnRenamed("_active", "embedding_row")


def retry_queue(states: DataFrame, tracks: DataFrame, membership: DataFrame) -> DataFrame:
    """Tracks of active videos that are pending or may be tried again, with the number of their next attempt."""
    open_states = states.filter(F.col("status").isin("pending", "retryable_error"))
    active = tracks.join(membership.filter("active").select("video_id"), "video_id", "left_semi").select("track_id")
    return open_states.join(active, "track_id", "left_semi").withColumn("next_attempt", F.col("attempt_count") + 1)


def outcome(crops: DataFrame) -> DataFrame:
    """(track_id, status) of embedding attempts per crop (track_id, error null|'blocked'|'retryable'): one good crop completes a track; it is blocked only if every crop is."""
    return crops.groupBy("track_id").agg(F.when(F.bool_or(F.col("error").isNull()), "complete").when(F.bool_and(F.col("error") == "blocked"), "blocked_error").otherwise("retryable_error").alias("status"))


def unique(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def not_a_permutation(table: DataFrame, row: str) -> DataFrame:
    """One row if the numbers are not 0..n-1, each once; else none."""
    c = F.col(row)
    return table.agg(F.count("*").alias("n"), F.countDistinct(c).alias("distinct"), F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("filled")).filter("n > 0 AND (filled <> n OR distinct <> n OR low <> 0 OR high <> n - 1)")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side."""
    return left.subtract(right).withColumn("side", F.lit("left")).unionByName(right.subtract(left).withColumn("side", F.lit("right")))


def differing(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys of both sides whose columns differ (null equals null)."""
    other = right.select(F.col(key).alias("_key"), *[F.col(c).alias("_" + c) for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col("_" + c))
    return left.join(other, F.col(key) == F.col("_key")).filter(~same).select(key)


def invalid_vectors(records: DataFrame, dimension: int | None) -> DataFrame:
    return records.filter(~is_valid(as_double(F.col("embedding")), dimension))


def invalid_frames(tracks: DataFrame, frames: DataFrame) -> DataFrame:
    """Tracks whose frames are negative, repeated, or do not match their count, start and end."""
    seen = frames.groupBy("track_id").agg(F.count("*").alias("_n"), F.countDistinct("frame_index").alias("_d"), F.min("frame_index").alias("_low"), F.max("frame_index").alias("_high"))
    joined = tracks.join(seen, "track_id", "left")
    fine = (F.coalesce("_n", F.lit(0)) == F.col("frame_count")) & ((F.col("frame_count") == 0) | ((F.col("_d") == F.col("_n")) & (F.col("_low") >= 0) & (F.col("_low") == F.col("start_frame")) & (F.col("_high") == F.col("end_frame"))))
    return joined.filter(~F.coalesce(fine, F.lit(False))).select("track_id")


def invalid_states(states: DataFrame, tracks: DataFrame, records: DataFrame) -> DataFrame:
    """Track ids whose state contradicts the tables, or that only one side knows."""
    rows = states.select("track_id", "status", "attempt_count", "embedding_row", F.lit(True).alias("_state"))
    rows = rows.join(tracks.select("track_id", "crop_count", F.lit(True).alias("_track")), "track_id", "full").join(records.select("track_id", F.col("embedding_row").alias("_row")), "track_id", "left")
    crops = F.coalesce("crop_count", F.lit(0)) > 0
    fine = (
        F.col("_state") & F.col("_track") & F.col("status").isin(*STATES) & (F.col("attempt_count") >= 0)
        & ((F.col("status") == "complete") == F.col("_row").isNotNull()) & F.col("embedding_row").eqNullSafe(F.col("_row"))
        & ~((F.col("status") == "no_usable_crops") & crops) & ~(F.col("status").isin("pending", "retryable_error") & ~crops)
    )
    return rows.filter(~F.coalesce(fine, F.lit(False))).select("track_id")


def shared_members(groups: DataFrame) -> DataFrame:
    """Tracks in more than one group; groups (person_id, track_id)."""
    return groups.groupBy("track_id").agg(F.count("*").alias("n")).filter("n > 1").select("track_id")


def affected_groups(groups: DataFrame, tracks: DataFrame) -> DataFrame:
    return groups.join(tracks.select("track_id"), "track_id", "left_semi").select("person_id").distinct()


def unknown_ids(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return requested.select(key).distinct().join(known.select(key), key, "left_anti")


def excluded(membership: DataFrame, requested: DataFrame) -> DataFrame:
    """Membership with the requested videos inactive; an unknown id refuses the whole request, and repeating one changes nothing."""
    must_be_empty(unknown_ids(requested, membership, "video_id"), "unknown video")
    hit = requested.select("video_id").distinct().withColumn("_hit", F.lit(True))
    return membership.join(hit, "video_id", "left").select("video_id", (F.col("active") & F.col("_hit").isNull()).alias("active"))


def validate(videos: DataFrame, tracks: DataFrame, records: DataFrame, states: DataFrame, groups: DataFrame, dimension: int) -> None:
    """All rules of a collection; the first broken one ends with RuleBroken."""
    must_be_empty(unique(videos, "video_id"), "duplicate video")
    must_be_empty(unique(tracks, "track_id"), "duplicate track")
    must_be_empty(unique(records, "track_id"), "duplicate embedding record")
    must_be_empty(unknown_ids(tracks, videos, "video_id"), "track of an unknown video")
    must_be_empty(unknown_ids(records, tracks, "track_id"), "record of an unknown track")
    # fixed values, which callers match: "permutation", "invalid embedding", "mapping mismatch"
    must_be_empty(not_a_permutation(records, "embedding_row"), "row numbers are no permutation of 0 to n - 1")
    must_be_empty(invalid_vectors(records, dimension).select("track_id"), "invalid embedding, empty, zero or not finite")
    must_be_empty(differing(records, tracks, "track_id", ["video_id"]), "mapping mismatch, record and track name different videos")
    must_be_empty(invalid_states(states, tracks, records), "state against the tables")
    must_be_empty(shared_members(groups), "track in two groups")
    must_be_empty(set_difference(groups.select("track_id"), records.select("track_id")), "groups do not partition the embedded tracks")
    must_be_empty(groups.filter(~F.col("person_id").rlike("^P[0-9]+$")), "invalid identity id")
