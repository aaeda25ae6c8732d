"""Incremental ingest and live coverage on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import discover


def ingest(stream: DataFrame, registered: Callable[[], DataFrame], publish: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands the new contents of every micro-batch to ``publish``; what is registered by then, or repeated in the batch, is left out.

    A batch that is run again after a failure finds its contents registered, so nothing is published twice.
    """

    def batch(rows: DataFrame, number: int) -> None:
        new = discover(rows, registered())
        if not new.isEmpty():
            publish(new, number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()


def hourly_activity(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """(user_id, event_type, hour, n): events per hour; an hour is final once the watermark has passed it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy("user_id", "event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")).select("user_id", "event_type", F.col("w.start").alias("hour"), "n")


def sessions(events: DataFrame, gap: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n): runs of events less than a gap apart."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def retries(states: Callable[[], DataFrame], stream: DataFrame, attempt: Callable[[DataFrame, DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands every micro-batch to ``attempt`` with the tracks that are then open (pending or to be tried again), so a track that failed is tried with the next batch."""

    def batch(rows: DataFrame, number: int) -> None:
        waiting = states().filter(F.col("status").isin("pending", "retryable_error"))
        if not (rows.isEmpty() and waiting.isEmpty()):
            attempt(rows, waiting, number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()


def live_tracks(detections: DataFrame, late: str = "1 minute") -> DataFrame:
    """(video_id, track_id, frame_count, start_frame, end_frame, analysis_complete) kept per track while detections (video_id, track_id, frame_index, last, ts) arrive; last marks the end of the video.

    A track is updated with every micro-batch that has frames of it. Its analysis is complete only once the mark has been seen in a batch of the track.
    """
    timed = detections.withWatermark("ts", late)
    sums = timed.groupBy("video_id", "track_id").agg(F.count("frame_index").alias("frame_count"), F.min("frame_index").alias("start_frame"), F.max("frame_index").alias("end_frame"), F.bool_or("last").alias("analysis_complete"))
    return sums.withColumn("analysis_complete", F.coalesce("analysis_complete", F.lit(False)))


# Columns of Spark's binary file source.
FILES = "path string, modificationTime timestamp, length long, content binary"


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").load(folder).select("path", F.sha2("content", 256).alias("sha256"))
