"""Relations of the identity model, derived from the analytic tables (events, orders, lineitem, embeddings, documents).

A user is a video of 720 hourly frames, a (user, event type) a track, an order a record with a span of days in the
source of its customer, and an embedding a record of its label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import box

TOTAL = 720


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, event_type, track_id, frame_index): distinct hours of a user's events of a type since 2024."""
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))").cast("long")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), "event_type", hour.alias("frame_index")).distinct()
    return rows.withColumn("track_id", F.concat_ws("_", F.col("video_id").cast("string"), "event_type"))


def boxed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with a made-up box and confidence."""
    h, u = F.col("frame_index"), F.col("video_id")
    x1, y1 = (h * 37 + u * 11) % 1500, (h * 53 + u * 7) % 700
    made = box(x1, y1, x1 + 60 + (h * 17 + u) % 200, y1 + 100 + (h * 29 + u * 3) % 380)
    return frames(spark, sf_dir).withColumn("bbox", made).withColumn("confidence", ((h * 13) % 60 + 40) / F.lit(100.0))


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, width, height, fps) of every user."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id")).distinct().select("video_id", F.lit(1920).alias("width"), F.lit(1080).alias("height"), F.lit(25.0).alias("fps"))


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, video_id, start_frame, end_frame, frame_count): orders with the days from their first to their last shipment."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    spans = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(day).alias("start_frame"), F.max(day).alias("end_frame"), F.count("*").alias("frame_count"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("video_id"))
    return orders.join(spans, F.col("id") == F.col("l_orderkey")).drop("l_orderkey")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def item_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes (l_orderkey, l_linenumber, bbox, confidence, mask)."""
    x1, y1 = (F.col("l_partkey") % 1900).cast("double"), (F.col("l_suppkey") * 13 % 1000).cast("double")
    made = box(x1 + 0.25, y1 + 0.5, x1 + F.col("l_quantity") * 4, y1 + F.col("l_quantity") * 7)
    mask = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount") * 5)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", made.alias("bbox"), (1 - F.col("l_tax")).alias("confidence"), mask.alias("mask"), (F.col("l_quantity") * 9).alias("blur"))
