"""Choice of the best crops of a track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import box_iou

NEAR_FRAMES = 3
NEAR_OVERLAP = 0.92


def best(candidates: DataFrame, limit: int = 16) -> DataFrame:
    """(track_id, frame_index, score, position): at most ``limit`` crops per track, in frame order.

    By score; crops close in time and place to a chosen one are passed over, and come back only to fill up to the limit.
    candidates (track_id, frame_index, bbox struct, score). The greedy choice is a fold over a track's sorted candidates,
    and only tracks with more candidates than the limit need it.
    """
    entry = F.struct((-F.col("score")).alias("rank"), "frame_index", F.struct(*[F.col("bbox")[s].alias(s) for s in ("x1", "y1", "x2", "y2")]).alias("box"), "score")
    sorted_rows = candidates.groupBy("track_id").agg(F.array_sort(F.collect_list(entry)).alias("rows"))

    def near(x: Column, y: Column) -> Column:
        return (F.abs(x["frame_index"] - y["frame_index"]) <= NEAR_FRAMES) & (box_iou(x["box"], y["box"]) >= NEAR_OVERLAP)

    def step(acc: Column, x: Column) -> Column:
        full = F.size(acc["chosen"]) >= limit
        passed = F.struct(acc["chosen"].alias("chosen"), F.concat(acc["passed"], F.array(x)).alias("passed"))
        taken = F.struct(F.concat(acc["chosen"], F.array(x)).alias("chosen"), acc["passed"].alias("passed"))
        return F.when(full, acc).when(F.exists(acc["chosen"], lambda y: near(x, y)), passed).otherwise(taken)

    none = F.slice("rows", 1, 0)
    greedy = F.aggregate("rows", F.struct(none.alias("chosen"), none.alias("passed")), step, lambda acc: F.slice(F.concat(acc["chosen"], acc["passed"]), 1, limit))
    chosen = F.when(F.size("rows") <= limit, F.col("rows")).otherwise(greedy)
    in_order = F.array_sort(F.transform(chosen, lambda r: F.struct(r["frame_index"].alias("frame_index"), r["rank"].alias("rank"), r["score"].alias("score"))))
    out = sorted_rows.select("track_id", F.posexplode(in_order).alias("position", "r"))
    return out.select("track_id", "r.frame_index", "r.score", (F.col("position") + 1).alias("position"))


def top(candidates: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` best crops per track by score and frame, without regard to duplicates."""
    order = Window.partitionBy("track_id").orderBy(F.col("score").desc(), "frame_index")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def summary(crops: DataFrame) -> DataFrame:
    """Means of the chosen crops' scores and their number, per track."""
    return crops.groupBy("track_id").agg(F.avg("score").alias("crop_quality_score"), F.avg("person_shape").alias("crop_person_shape_score"), F.avg("edge").alias("crop_edge_score"), F.count("*").alias("crop_count"))


def representative(members: DataFrame) -> DataFrame:
    """(person_id, crop): the first member's crop that there is, in the order of ``position``."""
    return members.groupBy("person_id").agg(F.min_by("crop", F.when(F.col("crop").isNotNull(), F.col("position"))).alias("crop"))


def sampled_paths(paths, representative_path, most: int = 4):
    """Up to ``most`` evenly spread crops of an array, the representative one first, without repeats."""
    n = F.size(paths)
    at = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.try_element_at(paths, (F.rint(k * (n - 1) / (most - 1)) + 1).cast("int")))
    picked = F.when(n <= most, paths).otherwise(at)
    first = F.when(representative_path.isNotNull(), F.array(representative_path)).otherwise(F.array().cast("array<string>"))
    return F.slice(F.array_distinct(F.concat(first, F.array_compact(picked))), 1, most)


def candidates(frames: DataFrame, detections: DataFrame, tracks: DataFrame) -> DataFrame:
    """Detections of active tracks with the frame that they lie in; frames (video_id, frame_index, ...), detections (video_id, frame_index, track_id, ...), tracks (track_id, is_active)."""
    active = detections.join(tracks.filter("is_active").select("track_id"), "track_id", "left_semi")
    return active.join(frames, ["video_id", "frame_index"])


def after_crops(tracks: DataFrame, chosen: DataFrame) -> DataFrame:
    """Tracks (track_id, is_active, ignored_reason) after the choice of crops (track_id, ...): active ones without any are ignored for that; with their number of crops."""
    counts = chosen.groupBy("track_id").agg(F.count("*").alias("crop_count"))
    rows = tracks.join(counts, "track_id", "left").withColumn("crop_count", F.coalesce("crop_count", F.lit(0)))
    lost = F.col("is_active") & (F.col("crop_count") == 0)
    reason = F.when(lost, F.coalesce("ignored_reason", F.lit("no_valid_crops"))).otherwise(F.col("ignored_reason"))
    return rows.withColumn("ignored_reason", reason).withColumn("is_active", F.col("is_active") & ~lost)
