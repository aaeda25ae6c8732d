"""Quality and tier of identity groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp
from ..functions.scores import consistency, tier, track_quality
from .identity import Limits

# Weights of the album score.
AVERAGE, BEST, CONSISTENCY, MOTION, ACTIVITY = 0.45, 0.18, 0.17, 0.12, 0.08
SINGLE_CONSISTENCY = 0.70


def scored_tracks(members: DataFrame, tracks: DataFrame) -> DataFrame:
    """(person_id, track_id, track_found, quality, motion, activity, reasons): members without a track are found false and score 0.

    tracks: track_id, crop_quality_score, crop_person_shape_score, crop_edge_score, raw_movement_score, movement_score,
    duration_sec, average_bbox_size_score, activity_zone_score, embedding_consistency_score, crop_count.
    """
    rows = members.join(tracks.withColumn("_found", F.lit(True)), "track_id", "left")
    quality, motion, reasons = track_quality(
        F.col("crop_quality_score"), F.col("crop_person_shape_score"), F.col("crop_edge_score"), F.col("raw_movement_score"), F.col("movement_score"), F.col("duration_sec"),
        F.col("average_bbox_size_score"), F.col("activity_zone_score"), F.col("embedding_consistency_score"), F.col("crop_count"),
    )
    found = F.coalesce("_found", F.lit(False))
    return rows.select(
        "person_id", "track_id", found.alias("track_found"), F.when(found, quality).otherwise(0.0).alias("quality"), F.when(found, motion).alias("motion"),
        F.when(found, clamp(F.col("activity_zone_score"), 0, 1)).alias("activity"), F.when(found, reasons).otherwise(F.array(F.lit("missing_track"))).alias("reasons"),
    )


def share(condition: Column) -> Column:
    return F.coalesce(F.avg(condition.cast("double")), F.lit(0.0))


def album_quality(members: DataFrame, tracks: DataFrame, similarity: DataFrame, conflicts: DataFrame | None = None, identity: DataFrame | None = None, limits: Limits = Limits(), accept: float = 0.78, review: float = 0.55, filtered: bool = True) -> DataFrame:
    """(person_id, size, album_quality_score, export_status, quality_reasons, partial scores).

    members (person_id, track_id); similarity (person_id, mean_sim) mean pair similarity; conflicts (person_id, ...);
    identity: statistics with identity_consistency_score, color_mean and reasons, or None if they were not made.
    """
    rows = scored_tracks(members, tracks)
    has = lambda reason: F.array_contains("reasons", reason)
    found = rows.filter("track_found").groupBy("person_id").agg(
        F.avg("quality").alias("average_track_quality"), F.max("quality").alias("best_track_quality"), F.avg("motion").alias("average_motion_score"), F.avg("activity").alias("average_activity_zone_score"),
        share(has("static_track")).alias("static_track_fraction"), share(has("partial_or_edge_crop")).alias("partial_crop_fraction"), share(has("low_crop_count")).alias("low_crop_count_fraction"),
    )
    out = members.groupBy("person_id").agg(F.count("*").alias("size")).join(found, "person_id", "left").join(similarity.select("person_id", "mean_sim"), "person_id", "left")
    close = F.when((F.col("size") > 1) & F.col("mean_sim").isNotNull(), consistency(F.col("mean_sim"), 0.76, 0.20)).otherwise(SINGLE_CONSISTENCY)
    out = out.withColumn("cluster_consistency_score", close)
    if identity is not None:
        info = identity.select("person_id", F.col("identity_consistency_score").alias("_score"), F.col("color_mean").alias("_colour"), F.col("reasons").alias("_reasons"))
        out = out.join(info, "person_id", "left")
    else:
        out = out.withColumn("_score", F.lit(None).cast("double")).withColumn("_colour", F.lit(None).cast("double")).withColumn("_reasons", F.lit(None).cast("array<string>"))
    clash = F.lit(False)
    if conflicts is not None:
        out = out.join(conflicts.select("person_id").distinct().withColumn("_clash", F.lit(True)), "person_id", "left")
        clash = F.coalesce("_clash", F.lit(False))
    own = F.coalesce("_score", "cluster_consistency_score")
    out = out.withColumn("identity_consistency_score", own)
    both = clamp(0.60 * F.col("cluster_consistency_score") + 0.40 * F.col("identity_consistency_score"), 0, 1)
    score = AVERAGE * F.col("average_track_quality") + BEST * F.col("best_track_quality") + CONSISTENCY * both + MOTION * F.col("average_motion_score") + ACTIVITY * F.col("average_activity_zone_score")
    size, ident, flawed = F.col("size"), F.col("identity_consistency_score"), lambda r: F.coalesce(F.array_contains("_reasons", r), F.lit(False))
    small_weak = (size >= 8) & (ident < limits.album_consistency)
    # fixed values: penalties; several may share a reason, and all of them count
    flaws = [
        ("same_video_conflict", clash, 0.22),
        ("static_tracks", F.col("static_track_fraction") >= 0.45, 0.18),
        ("partial_or_edge_crops", F.col("partial_crop_fraction") >= 0.35, 0.10),
        ("low_crop_count", F.col("low_crop_count_fraction") >= 0.50, 0.06),
        ("large_low_motion_cluster", (size >= 35) & (F.col("average_motion_score") < 0.42), 0.18),
        ("weak_cluster_consistency", F.col("cluster_consistency_score") < 0.45, 0.10),
        ("weak_identity_consistency", small_weak, 0.16),
        ("weak_identity_consistency", ~small_weak & (size >= 16) & (ident < limits.album_large_consistency), 0.10),
        ("weak_identity_consistency", flawed("weak_identity_consistency"), 0.12),
        ("outfit_color_diversity", flawed("outfit_color_diversity"), 0.10),
        ("low_min_pair_similarity", flawed("low_min_pair_similarity"), 0.08),
        ("outfit_color_diversity", (size >= 4) & (F.coalesce("_colour", F.lit(1.0)) < limits.album_colour), 0.08),
        ("low_track_quality", F.col("average_track_quality") < 0.52, 0.0),
        ("low_motion", F.col("average_motion_score") < 0.30, 0.0),
    ]
    penalty = sum((F.when(c, F.lit(p)).otherwise(F.lit(0.0)) for _, c, p in flaws if p), F.lit(0.0))
    reasons = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c, _ in flaws]))))
    nothing = F.col("average_track_quality").isNull()
    final = F.when(nothing, 0.0).otherwise(clamp(score - penalty, 0, 1))
    out = out.withColumn("album_quality_score", final)
    out = out.withColumn("export_status", F.when(nothing, "rejected").otherwise(tier(F.col("album_quality_score"), accept, review, filtered)))
    out = out.withColumn("quality_reasons", F.when(nothing, F.array(F.lit("no_valid_tracks"))).otherwise(reasons))
    return out.drop("_score", "_colour", "_reasons", "_clash", "mean_sim")


def status_counts(albums: DataFrame) -> DataFrame:
    names = ("accepted", "review", "rejected")
    return albums.agg(*[F.count_if(F.col("export_status") == n).alias(n) for n in names], F.count("*").alias("total"))


def exported(albums: DataFrame, everything: bool = False) -> DataFrame:
    return albums if everything else albums.filter("export_status = 'accepted'")
