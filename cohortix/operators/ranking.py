"""Ranking of the sources in which an identity appears, by exact coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ranges


def observations(tracks: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """(track_id, ranges, problem): each track's merged ranges, or why they cannot be used.

    tracks: (track_id, frame_count, ranges array<struct<start, end>> or null). A track without stored ranges gets them from
    frames (track_id, frame_index) if there are any.
    """
    if frames is not None:
        found = ranges.compact(frames, ["track_id"], "frame_index").groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("seen"))
        tracks = tracks.join(found, "track_id", "left").withColumn("ranges", F.coalesce("ranges", "seen")).drop("seen")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    held = F.when(F.col("ranges").isNotNull(), F.col("ranges").cast("array<struct<start:bigint,end:bigint>>")).when(F.col("frame_count") == 0, none)
    sound = F.forall(held, lambda r: F.coalesce((r["start"] >= 0) & (r["end"] >= r["start"]), F.lit(False)))
    tracks = tracks.withColumn("_held", F.when(F.coalesce(sound, F.lit(False)), held))
    problem = F.when(held.isNull(), "missing_frame_observations").when(~sound, "invalid_frame_observations")
    base = tracks.withColumn("_problem", problem)
    joined = F.aggregate(
        F.array_sort("_held"), F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, r: F.when((F.size(acc) > 0) & (r["start"] <= F.try_element_at(acc, F.lit(-1))["end"] + 1),
                              F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], r["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(r))),
    )
    merged = base.withColumn("_merged", joined)
    count = F.aggregate("_merged", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"] + 1)
    wrong = F.when(F.col("_problem").isNull() & (count != F.col("frame_count")), "inconsistent_frame_observations")
    return merged.select("track_id", F.col("_merged").alias("ranges"), F.coalesce("_problem", wrong).alias("problem"))


def rank_sources(members: DataFrame, tracks: DataFrame, videos: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """Ranked sources per identity.

    members (person_id, track_id); tracks (track_id, video_id, frame_count, ranges); videos (video_id, frame_count,
    processed_frame_count, analysis_complete). A member without a track ends the job. Valid sources come first, by exact
    share, visible frames and id; the others follow by id.
    """
    seen = observations(tracks, frames).join(tracks.select("track_id", "video_id"), "track_id")
    joined = members.distinct().join(seen, "track_id", "left")
    known_track = F.when(F.col("video_id").isNull(), F.raise_error(F.concat(F.lit("missing track: "), F.col("track_id")))).otherwise(F.col("video_id"))
    joined = joined.withColumn("video_id", known_track)
    # the first flawed track of a source, in the order of ids, names its problem
    per_source = joined.groupBy("person_id", "video_id").agg(F.min_by("problem", F.when(F.col("problem").isNotNull(), F.col("track_id"))).alias("problem"), F.array_sort(F.collect_list("track_id")).alias("local_tracks"))
    spans = joined.select("person_id", "video_id", F.inline("ranges"))
    visible = ranges.coverage(ranges.merge(spans, ["person_id", "video_id"]), ["person_id", "video_id"])
    info = videos.select("video_id", F.lit(True).alias("_known"), F.col("frame_count").alias("_reported"), F.col("processed_frame_count").alias("_processed"), F.col("analysis_complete").alias("_complete"))
    rows = per_source.join(visible, ["person_id", "video_id"], "left").join(info, "video_id", "left")
    total, origin, status = ranges.total_frames(F.coalesce("_known", F.lit(False)), F.col("_reported"), F.col("_processed"), F.col("_complete"))
    rows = rows.withColumn("total_frames", total).withColumn("frame_count_source", origin)
    rows = rows.withColumn("coverage_status", F.coalesce("problem", status))
    rows = rows.withColumn("visible_frames", F.when(F.col("problem").isNull(), F.coalesce("visible", F.lit(0))))
    beyond = (F.col("coverage_status") == "valid") & (F.col("last") >= F.col("total_frames"))
    rows = rows.withColumn("coverage_status", F.when(F.coalesce(beyond, F.lit(False)), "out_of_range_frames").otherwise(F.col("coverage_status")))
    valid = F.col("coverage_status") == "valid"
    rows = rows.withColumn("appearance_percentage", F.when(valid, 100.0 * F.col("visible_frames") / F.col("total_frames")))
    share = F.when(valid, F.col("visible_frames") / F.col("total_frames"))
    order = Window.partitionBy("person_id").orderBy(valid.desc(), share.desc_nulls_last(), F.when(valid, F.col("visible_frames")).desc_nulls_last(), "video_id")
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows.select("person_id", "rank", "video_id", "visible_frames", "total_frames", "appearance_percentage", "frame_count_source", "coverage_status", "local_tracks")


def ranking_columns(ranked: DataFrame) -> DataFrame:
    """(person_id, video_ids, rankings): the ranks of an identity as arrays in order."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "video_id", "visible_frames", "total_frames", "appearance_percentage", "coverage_status")))
    return ranked.groupBy("person_id").agg(entries.alias("rankings")).withColumn("video_ids", F.col("rankings.video_id"))


def unavailable(ranked: DataFrame) -> DataFrame:
    return ranked.filter("coverage_status <> 'valid'").select("person_id", "video_id", F.col("coverage_status").alias("reason"))


def video_index(videos: DataFrame, members: DataFrame, tracks: DataFrame) -> DataFrame:
    """(video_id, person_ids): the identities of every source, an empty array where there are none."""
    seen = members.join(tracks.select("track_id", "video_id"), "track_id").groupBy("video_id").agg(F.array_sort(F.collect_set("person_id")).alias("person_ids"))
    return videos.select("video_id").join(seen, "video_id", "left").withColumn("person_ids", F.coalesce("person_ids", F.array().cast("array<string>")))
