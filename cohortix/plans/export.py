"""Exports: documents, matrices, galleries and the timings of a run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_escaped, seconds


def track_documents(tracks: DataFrame, frames: DataFrame) -> DataFrame:
    """(video_id, document): one JSON text per video with its tracks and their frames, tracks by id and frames by index."""
    inner = frames.groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", *[c for c in frames.columns if c not in ("track_id", "frame_index", "video_id")]))).alias("frames"))
    rows = tracks.join(inner, "track_id", "left")
    entry = F.struct("track_id", *[c for c in rows.columns if c not in ("track_id", "video_id")])
    return rows.groupBy("video_id").agg(F.to_json(F.struct(F.col("video_id"), F.array_sort(F.collect_list(entry)).alias("tracks"))).alias("document"))


def group_documents(albums: DataFrame, members: DataFrame, everything: bool = False) -> DataFrame:
    """(person_id, document) in the order of ids as text; accepted groups only unless everything is asked for."""
    lists = members.groupBy("person_id").agg(F.array_sort(F.collect_list("track_id")).alias("local_tracks"))
    rows = albums.join(lists, "person_id")
    rows = rows if everything else rows.filter("export_status = 'accepted'")
    return rows.select("person_id", F.to_json(F.struct(*rows.columns)).alias("document")).orderBy("person_id")


def write_documents(documents: DataFrame, path: str, key: str) -> None:
    documents.select(key, F.col("document").alias("value")).write.partitionBy(key).text(path)


def gallery(albums: DataFrame, crops: DataFrame, everything: bool = False, most_crops: int = 8) -> DataFrame:
    """(person_id, html): a section per identity with its scores and the first crops of each track; texts are escaped.

    crops (person_id, track_id, paths array).
    """
    image: Column = F.transform(F.slice("paths", 1, most_crops), lambda p: F.concat(F.lit('<img src="'), html_escaped(p), F.lit('">')))
    track = F.concat(F.lit("<h3>"), html_escaped(F.col("track_id")), F.lit("</h3>"), F.array_join(image, ""))
    lists = crops.select("person_id", "track_id", track.alias("t")).groupBy("person_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("track_id", "t"))), lambda x: x["t"]), "").alias("body"))
    rows = albums if everything else albums.filter("export_status = 'accepted'")
    head = F.concat(F.lit("<h2>"), html_escaped(F.col("person_id")), F.lit("</h2><p>"), F.col("export_status"), F.lit(" "), F.format_string("%.3f", "album_quality_score"), F.lit("</p>"))
    return rows.join(lists, "person_id", "left").select("person_id", F.concat(F.lit("<section>"), head, F.coalesce("body", F.lit("")), F.lit("</section>")).alias("html"))


def standalone(sections: DataFrame, images: DataFrame) -> DataFrame:
    """The sections with every known image source replaced by its bytes in base64; images (path, content)."""
    found = sections.select("person_id", "html", F.explode_outer(F.array_distinct(F.regexp_extract_all("html", F.lit(r'<img src="([^"]*)"'), F.lit(1)))).alias("path"))
    data = images.select("path", F.concat(F.lit("data:image/jpeg;base64,"), F.base64("content")).alias("data"))
    pairs = found.join(data, "path", "left").groupBy("person_id", "html").agg(F.collect_list(F.when(F.col("data").isNotNull(), F.struct("path", "data"))).alias("pairs"))
    step = lambda acc, p: F.replace(acc, F.concat(F.lit('src="'), p["path"], F.lit('"')), F.concat(F.lit('src="'), p["data"], F.lit('"')))
    return pairs.select("person_id", F.aggregate("pairs", F.col("html"), step).alias("html"))


# The statistics of an identity that exports name.
SUMMARY = ("reid_mean", "reid_min", "combined_mean", "combined_min", "combined_p10", "combined_std", "color_mean")


def identity_summary(stats: DataFrame, key: str) -> DataFrame:
    """(key, identity_...) of an identity's statistics."""
    return stats.select(key, *[F.col(name).alias("identity_" + name) for name in SUMMARY])


def run_report(videos: DataFrame, tracks: DataFrame, records: DataFrame, albums: DataFrame) -> DataFrame:
    """(name, n): the counts of a run."""
    out = None
    for name, rows in (("videos", videos), ("tracks", tracks), ("embeddings", records), ("groups", albums), ("accepted", albums.filter("export_status = 'accepted'"))):
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


class Timings:
    """Seconds of named steps: every event, and the total of each name."""

    def __init__(self) -> None:
        self.events: list[tuple[str, float]] = []

    @contextmanager
    def timed(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.events.append((name, time.perf_counter() - began))

    def table(self, spark) -> DataFrame:
        rows = spark.createDataFrame(self.events or [("", 0.0)], "name string, sec double").filter("name <> ''")
        return rows.groupBy("name").agg(F.round(F.sum("sec"), 4).alias("total"), F.count("*").alias("events")).withColumn("text", seconds(F.col("total")))
