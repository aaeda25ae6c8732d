"""Tracks from detections: statistics, activity and the filter with its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import box_area, box_center, box_height, clamp, falloff

# Weights of the activity score.
DURATION, MOVEMENT, SIZE, CENTRE = 0.35, 0.30, 0.20, 0.15


def detections(results: DataFrame) -> DataFrame:
    """Rows of detections from results with parallel arrays (ids, boxes, confidences, classes); short arrays are filled with 1.0 and 0, results without ids give no row."""
    n = F.least(F.size("ids"), F.size("boxes"))
    at = F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    rows = results.withColumn("_i", F.explode(at))
    pick = lambda c, default: F.coalesce(F.try_element_at(F.col(c), F.col("_i")), F.lit(default))
    return rows.select("video_id", "frame_index", F.element_at("ids", F.col("_i")).alias("raw_track_id"), F.element_at("boxes", F.col("_i")).alias("bbox"), pick("confidences", 1.0).alias("confidence"), pick("classes", 0).alias("class_id"))


def track_stats(frames: DataFrame, videos: DataFrame) -> DataFrame:
    """Statistics per (video_id, track_id).

    frames (video_id, track_id, frame_index, bbox, confidence); videos (video_id, width, height, fps).
    """
    joined = frames.join(videos.select("video_id", "width", "height", "fps"), "video_id")
    centre = box_center(F.col("bbox"))
    order = Window.partitionBy("video_id", "track_id").orderBy("frame_index")
    rows = joined.withColumn("_x", centre["x"]).withColumn("_y", centre["y"])
    rows = rows.withColumn("_step", F.hypot(F.col("_x") - F.lag("_x").over(order), F.col("_y") - F.lag("_y").over(order)))
    diagonal = F.greatest(F.lit(1.0), F.hypot(F.col("width").cast("double"), F.col("height").cast("double")))
    area = F.greatest(F.lit(1.0), (F.col("width") * F.col("height")).cast("double"))
    size = clamp(F.sqrt(box_area(F.col("bbox")) / area) * 4.0, 0, 1)
    off = F.hypot(F.col("_x") - F.col("width") * 0.5, F.col("_y") - F.col("height") * 0.5)
    centred = clamp(1.0 - off / F.greatest(F.lit(1.0), diagonal * 0.5), 0, 1)
    out = rows.groupBy("video_id", "track_id").agg(
        F.count("*").alias("frame_count"), F.min("frame_index").alias("start_frame"), F.max("frame_index").alias("end_frame"), F.avg("confidence").alias("average_confidence"),
        F.avg(box_height(F.col("bbox"))).alias("average_bbox_height"), F.avg(size).alias("average_bbox_size_score"), F.avg(centred).alias("center_position_score"),
        (F.coalesce(F.sum("_step"), F.lit(0.0)) / F.first(diagonal)).alias("raw_movement_score"), F.first("fps").alias("_fps"),
    )
    duration = F.when(F.col("_fps") > 0, (F.col("end_frame") - F.col("start_frame") + 1) / F.col("_fps")).otherwise(0.0)
    return out.withColumn("duration_sec", duration).drop("_fps")


def active_scores(stats: DataFrame) -> DataFrame:
    """Adds movement_score and active_score: durations and movements over the greatest of their video."""
    video = Window.partitionBy("video_id")
    share = lambda c: F.when(F.max(c).over(video) > 0, F.col(c) / F.max(c).over(video)).otherwise(0.0)
    out = stats.withColumn("movement_score", clamp(share("raw_movement_score"), 0, 1)).withColumn("_duration", clamp(share("duration_sec"), 0, 1))
    score = DURATION * F.col("_duration") + MOVEMENT * F.col("movement_score") + SIZE * F.col("average_bbox_size_score") + CENTRE * F.col("center_position_score")
    return out.withColumn("active_score", score).drop("_duration")


def activity_zones(frames: DataFrame, stats: DataFrame, videos: DataFrame) -> DataFrame:
    """Adds activity_zone_score: nearness of a track's centres to where the moving tracks of its video are.

    With fewer than two moving tracks the centre score stands in.
    """
    moving = stats.filter((F.col("raw_movement_score") >= 0.035) & (F.col("average_bbox_size_score") >= 0.08) & (F.col("frame_count") > 0))
    moving = moving.select("video_id", "track_id", (F.greatest(F.lit(0.01), F.col("raw_movement_score")) * F.greatest(F.lit(0.05), F.col("average_bbox_size_score"))).alias("_weight"), F.greatest(F.lit(1), F.floor(F.col("frame_count") / 20)).alias("_stride"))
    order = Window.partitionBy("video_id", "track_id").orderBy("frame_index")
    centre = box_center(F.col("bbox"))
    points = frames.select("video_id", "track_id", "frame_index", centre["x"].alias("_x"), centre["y"].alias("_y"))
    sampled = points.withColumn("_n", F.row_number().over(order) - 1).join(moving, ["video_id", "track_id"]).filter(F.pmod("_n", "_stride") == 0)
    # one pass of weighted sums: centre and variance follow from the first two moments
    w = F.col("_weight")
    sums = sampled.groupBy("video_id").agg(
        F.countDistinct("track_id").alias("_moving"), F.sum(w).alias("_w"), F.sum(w * F.col("_x")).alias("_wx"), F.sum(w * F.col("_y")).alias("_wy"),
        F.sum(w * F.col("_x") * F.col("_x")).alias("_wxx"), F.sum(w * F.col("_y") * F.col("_y")).alias("_wyy"),
    )
    mx, my = F.col("_wx") / F.col("_w"), F.col("_wy") / F.col("_w")
    variance = F.greatest(F.lit(0.0), F.col("_wxx") / F.col("_w") - mx * mx) + F.greatest(F.lit(0.0), F.col("_wyy") / F.col("_w") - my * my)
    diagonal = F.hypot(F.col("width").cast("double"), F.col("height").cast("double"))
    zones = sums.filter("_moving >= 2").join(videos.select("video_id", "width", "height"), "video_id")
    spread = F.greatest(F.sqrt(variance), diagonal * 0.18)
    zones = zones.select("video_id", mx.alias("_mx"), my.alias("_my"), F.greatest(spread * 1.65, diagonal * 0.16).alias("_scale"))
    away = points.join(zones, "video_id").groupBy("video_id", "track_id").agg(F.avg(F.hypot(F.col("_x") - F.col("_mx"), F.col("_y") - F.col("_my"))).alias("_away"), F.first("_scale").alias("_scale"))
    out = stats.join(away, ["video_id", "track_id"], "left")
    zone = clamp(0.75 * falloff(F.col("_away"), F.col("_scale")) + 0.25 * F.col("center_position_score"), 0, 1)
    return out.withColumn("activity_zone_score", F.when(F.col("_away").isNotNull(), zone).otherwise(F.col("center_position_score"))).drop("_away", "_scale")


def filter_reasons(least_frames: int = 25, active: bool = True, least_seconds: float = 0.8, least_movement: float = 0.04, least_height: float = 150) -> Column:
    """Why a track is ignored, joined by commas; null if it is active. The frame rule holds even without the active filter."""
    rules = [F.when(F.col("frame_count") < least_frames, "too_short")]
    if active:
        if least_seconds > 0:
            rules.append(F.when(F.col("duration_sec") < least_seconds, "too_short_duration"))
        rules += [F.when(F.col("movement_score") < least_movement, "low_movement"), F.when(F.col("average_bbox_height") < least_height, "too_small"), F.when(F.col("active_score") < 0.20, "low_active_score")]
    return F.nullif(F.concat_ws(",", *rules), F.lit(""))
