"""Inclusive integer ranges: gaps and islands, unions, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compact(points: DataFrame, keys: Sequence[str], index: str) -> DataFrame:
    """(keys, start, end): runs of consecutive indices. Negative or null indices end the job."""
    checked = F.when(F.col(index) >= 0, F.col(index)).otherwise(F.raise_error(F.lit("indices must be nonnegative integers")))
    distinct = points.select(*keys, checked.cast("long").alias(index)).distinct()
    run = F.col(index) - F.row_number().over(Window.partitionBy(*keys).orderBy(index))
    return distinct.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(index).alias("start"), F.max(index).alias("end")).drop("_run")


def merge(ranges: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(keys, start, end): unions of ranges that overlap or adjoin. A range that is null, negative or reversed ends the job."""
    fine = F.coalesce((F.col(start) >= 0) & (F.col(end) >= F.col(start)), F.lit(False))
    rows = ranges.select(*keys, F.when(fine, F.col(start)).otherwise(F.raise_error(F.lit("invalid inclusive range"))).cast("long").alias("_s"), F.col(end).cast("long").alias("_e"))
    order = Window.partitionBy(*keys).orderBy("_s", "_e")
    reached = F.max("_e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reached.isNull() | (F.col("_s") > reached + 1)).cast("int")
    marked = rows.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(order))
    return marked.groupBy(*keys, "_island").agg(F.min("_s").alias("start"), F.max("_e").alias("end")).drop("_island")


def coverage(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, visible, last): points covered by disjoint ranges, and the last one."""
    return ranges.groupBy(*keys).agg(F.sum(F.col("end") - F.col("start") + 1).alias("visible"), F.max("end").alias("last"))


def total_frames(known: Column, reported: Column, processed: Column, complete: Column) -> tuple[Column, Column, Column]:
    """(total, where it is from, status) of a source: processed counts win if the analysis is complete."""
    has_metadata = reported > 0
    total = (
        F.when(~known, F.lit(None))
        .when(processed.isNotNull(), F.when((processed > 0) & F.coalesce(complete, F.lit(False)), processed))
        .when(F.coalesce(~complete, F.lit(False)), F.lit(None))
        .when(has_metadata, reported)
    )
    origin = F.when(known & processed.isNotNull(), "processed").otherwise("metadata")
    status = (
        F.when(~known, "missing_video_metadata")
        .when(processed.isNotNull() & ((processed <= 0) | ~F.coalesce(complete, F.lit(False))), "incomplete_analysis")
        .when(processed.isNotNull() & F.coalesce(has_metadata, F.lit(False)) & (reported != processed), "frame_count_mismatch")
        .when(processed.isNotNull(), "valid")
        .when(F.coalesce(~complete, F.lit(False)), "incomplete_analysis")
        .when(~F.coalesce(has_metadata, F.lit(False)), "invalid_total_frames")
        .otherwise("valid")
    )
    return total.cast("long"), origin, status
