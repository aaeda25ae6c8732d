"""Numbers, boxes and polygons as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def clamp(value: Column, low, high) -> Column:
    """The value within [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(number(low), F.least(number(high), value)))


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.cast("double").alias("x1"), y1.cast("double").alias("y1"), x2.cast("double").alias("x2"), y2.cast("double").alias("y2"))


def box_width(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x2"] - b["x1"])


def box_height(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y2"] - b["y1"])


def box_area(b: Column) -> Column:
    return box_width(b) * box_height(b)


def box_center(b: Column) -> Column:
    return F.struct(((b["x1"] + b["x2"]) * 0.5).alias("x"), ((b["y1"] + b["y2"]) * 0.5).alias("y"))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 if the union is empty."""
    wide = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    high = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    union = box_area(a) + box_area(b) - wide * high
    return F.when(union > 0, wide * high / union).otherwise(F.lit(0.0))


def clamp_box(b: Column, width: Column, height: Column) -> Column:
    """Whole pixels inside the frame: floors and ceilings, at least one pixel wide and high."""
    x1 = F.greatest(F.lit(0), F.least(width - 1, F.floor(b["x1"]))).cast("long")
    y1 = F.greatest(F.lit(0), F.least(height - 1, F.floor(b["y1"]))).cast("long")
    x2 = F.greatest(x1 + 1, F.least(width, F.ceil(b["x2"]))).cast("long")
    y2 = F.greatest(y1 + 1, F.least(height, F.ceil(b["y2"]))).cast("long")
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def pad_box(b: Column, ratio: float, width: Column, height: Column) -> Column:
    """A box grown on each side by a share of its side (of 1 at least), then clamped."""
    dx = F.greatest(F.lit(1.0), b["x2"] - b["x1"]) * ratio
    dy = F.greatest(F.lit(1.0), b["y2"] - b["y1"]) * ratio
    return clamp_box(box(b["x1"] - dx, b["y1"] - dy, b["x2"] + dx, b["y2"] + dy), width, height)


def polygon_area(points: Column) -> Column:
    """Shoelace area of array<struct<x, y>>; null below three points."""
    turned = F.concat(F.slice(points, 2, F.greatest(F.size(points), F.lit(1))), F.slice(points, 1, 1))
    parts = F.zip_with(points, turned, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.when(F.size(points) >= 3, F.abs(F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)) / 2)


def mask_ratio(points: Column, b: Column) -> Column:
    return polygon_area(points) / F.greatest(F.lit(1.0), box_area(b))


def spans_overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Closed intervals share a point."""
    return F.greatest(start_a, start_b) <= F.least(end_a, end_b)


def falloff(distance: Column, scale: Column) -> Column:
    return F.exp(-F.pow(distance / scale, F.lit(2.0)))


def every(values: Column, stride: Column) -> Column:
    """The elements of an array at positions 0, stride, 2 * stride..."""
    return F.filter(values, lambda _, i: F.pmod(i, stride) == 0)
