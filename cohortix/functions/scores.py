"""Scores of crops, tracks and pairs as Columns. Weights and thresholds are fixed values of the format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import clamp

# Weights of the crop scores.
SHAPE_WEIGHTS = {"full_body": 0.42, "edge": 0.24, "size": 0.22, "mask": 0.12}
CROP_WEIGHTS = {"size": 0.30, "sharpness": 0.25, "person_shape": 0.20, "edge": 0.15, "confidence": 0.10}
# Weights of a track's quality.
TRACK_WEIGHTS = {"crop_quality": 0.25, "shape": 0.18, "motion": 0.17, "duration": 0.12, "size": 0.10, "activity": 0.08, "embedding": 0.06, "crop_count": 0.04}


def weighted(weights: dict[str, float], terms: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + terms[name] * weight
    return total


def aspect_score(aspect: Column) -> Column:
    return F.when(aspect.between(1.4, 4.2), 1.0).when(aspect.between(1.0, 5.2), 0.7).when(aspect.between(0.75, 6.5), 0.4).otherwise(0.15)


def crop_scores(height: Column, width: Column, box: Column, frame_width: Column, frame_height: Column, confidence: Column, mask: Column, blur: Column) -> dict[str, Column]:
    """All partial scores of a crop and its overall ``score``; a null mask ratio counts as a full mask."""
    margin_x, margin_y = F.greatest(F.lit(2.0), frame_width * 0.015), F.greatest(F.lit(2.0), frame_height * 0.015)
    touches = [box["x1"] <= margin_x, box["y1"] <= margin_y, box["x2"] >= frame_width - margin_x, box["y2"] >= frame_height - margin_y]
    hits = sum((t.cast("int") for t in touches), F.lit(0))
    aspect = height / F.greatest(F.lit(1.0), width)
    out = {
        "size": clamp(height / F.greatest(F.lit(1.0), frame_height * 0.35), 0, 1),
        "sharpness": clamp(blur / 250.0, 0, 1),
        "aspect_ratio": aspect,
        "full_body": aspect_score(aspect),
        "edge": clamp(1.0 - hits * 0.22, 0, 1),
        "edge_touch_ratio": hits / 4.0,
        "confidence": clamp(confidence, 0, 1),
        "mask": F.when(mask.isNull(), 1.0).otherwise(clamp(mask / 0.35, 0.25, 1)),
    }
    out["person_shape"] = clamp(weighted(SHAPE_WEIGHTS, out), 0, 1)
    out["score"] = weighted(CROP_WEIGHTS, out) * out["mask"]
    return out


def crop_is_valid(height: Column, area: Column, blur: Column, shape: Column, edge_touch: Column, least_height: int = 150, least_blur: float = 110.0, least_shape: float = 0.35, most_edge: float = 0.75) -> Column:
    ok = (height > 0) & (height >= least_height) & (area > 0) & (shape >= least_shape) & (edge_touch <= most_edge)
    return ok & (blur >= least_blur) if least_blur > 0 else ok


def mask_passes(ratio: Column, least: float) -> Column:
    return ratio.isNull() | (ratio >= least)


def track_quality(crop_quality: Column, shape: Column, edge: Column, raw_movement: Column, movement: Column, duration: Column, size: Column, activity: Column, embedding: Column, crop_count: Column) -> tuple[Column, Column, Column]:
    """(quality, motion score, reasons) of a track."""
    shape_score = clamp(shape, 0, 1)
    motion = clamp(0.65 * clamp(raw_movement / 0.18, 0, 1) + 0.35 * movement, 0, 1)
    terms = {
        "crop_quality": clamp(crop_quality, 0, 1), "shape": shape_score, "motion": motion, "duration": clamp(duration / 2.0, 0, 1), "size": clamp(size, 0, 1),
        "activity": clamp(activity, 0, 1), "embedding": clamp(embedding, 0, 1), "crop_count": clamp(crop_count / 6.0, 0, 1),
    }
    flaws = [
        ("static_track", (raw_movement < 0.025) & (duration >= 1.0), 0.16),
        ("partial_or_edge_crop", (shape_score < 0.45) | (edge < 0.55), 0.10),
        ("low_crop_count", crop_count < 2, 0.04),
        ("inconsistent_track_embedding", embedding < 0.45, 0.08),
    ]
    penalty = sum((F.when(c, F.lit(p)).otherwise(F.lit(0.0)) for _, c, p in flaws), F.lit(0.0))
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c, _ in flaws]))
    return clamp(weighted(TRACK_WEIGHTS, terms) - penalty, 0, 1), motion, reasons


def colour_similarity(raw: Column) -> Column:
    """Scaled dot product of colour fingerprints; 0.5 where one is missing."""
    return F.coalesce(clamp((raw - 0.45) / 0.45, 0, 1), F.lit(0.5))


def blended_similarity(vector: Column, colour: Column, weight: float) -> Column:
    return clamp((1.0 - weight) * vector + weight * colour, -1, 1)


def tier(score: Column, accept: float = 0.78, review: float = 0.55, filtered: bool = True) -> Column:
    """accepted, review or rejected; everything is accepted without the filter."""
    if not filtered:
        return F.lit("accepted")
    return F.when(score >= accept, "accepted").when(score >= review, "review").otherwise("rejected")


def consistency(mean_similarity: Column, low: float, width: float) -> Column:
    return clamp((mean_similarity - low) / width, 0, 1)
