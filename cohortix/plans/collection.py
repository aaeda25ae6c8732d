"""A collection of analysed videos as one bundle of tables, and the operations on it: start, add, exclude, rank again, group again, save and load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import person_number
from ..operators import audit, catalog, clusters, conflicts, continuity, identity, ranking
from . import publish
from .config import ClusterOptions
from .store import materialize

#: active (id, embedding, and what else the records have) -> (id, label)
Clusterer = Callable[[DataFrame], DataFrame]

VIDEOS = "video_id string, sha256 string, active boolean, frame_count long, processed_frame_count long, analysis_complete boolean"
TABLES = ("videos", "tracks", "records", "states", "groups")


@dataclass(frozen=True)
class Collection:
    """videos (video_id, active, ...), tracks (track_id, video_id, crop_count, ...), records (track_id, video_id, cache_row, embedding, ...),
    states (track_id, status, attempt_count, failed_stage, last_error), groups (person_id, track_id)."""

    videos: DataFrame
    tracks: DataFrame
    records: DataFrame
    states: DataFrame
    groups: DataFrame
    next_number: int = 1

    def membership(self) -> DataFrame:
        return self.videos.select("video_id", "active")

    def active(self) -> DataFrame:
        """The records of active videos, numbered anew by ``active_row``."""
        return catalog.active_view(self.records, self.membership())

    def active_tracks(self) -> DataFrame:
        return self.tracks.join(self.videos.filter("active").select("video_id"), "video_id", "left_semi")


def grouping(options: ClusterOptions, spans: DataFrame) -> Clusterer:
    """Average linkage, then clusters without overlapping spans, then the split of inconsistent ones; spans (id, video_id, start_frame, end_frame, frame_count)."""

    def cluster(active: DataFrame) -> DataFrame:
        vectors = active.select("id", "embedding")
        labels = materialize(clusters.average_link(vectors, options.distance), "group-labels")
        own = spans.join(active.select("id"), "id", "left_semi")
        labels = materialize(conflicts.split(own, labels, vectors), "group-labels")
        return identity.split(vectors.join(labels, "id"), options.limits) if options.identity_split else labels

    return cluster


def start(videos: DataFrame, tracks: DataFrame, embedded: DataFrame, failed: DataFrame | None, cluster: Clusterer) -> Collection:
    """The collection of a first batch; arguments as for ``add``."""
    key, video = tracks.schema["track_id"].dataType.simpleString(), videos.schema["video_id"].dataType.simpleString()
    empty = videos.sparkSession.createDataFrame
    states = empty([], f"track_id {key}, status string, attempt_count int, failed_stage string, last_error string")
    records = embedded.withColumn("cache_row", F.lit(0).cast("long")).limit(0)
    none = Collection(videos.limit(0).withColumn("active", F.lit(True)), tracks.limit(0), records, states, empty([], f"person_id string, track_id {key}"))
    assert video == tracks.schema["video_id"].dataType.simpleString()
    return add(none, videos, tracks, embedded, failed, cluster)


def add(c: Collection, videos: DataFrame, tracks: DataFrame, embedded: DataFrame, failed: DataFrame | None, cluster: Clusterer) -> Collection:
    """The collection with new videos (video_id, ...), their tracks, and the outcome of embedding new tracks and those of the retry queue.

    embedded (track_id, video_id, embedding, ...) are appended after the last row, failed (track_id, status, failed_stage, last_error) keep their error;
    whoever has crops has used up one more attempt. All active records are clustered again, and identities keep their ids where they can.
    """
    catalog.must_be_empty(videos.join(c.videos.select("video_id"), "video_id", "left_semi"), "video is known already")
    widths = audit.widths(c.records.unionByName(embedded, allowMissingColumns=True))
    if widths > 1:
        raise catalog.RuleBroken("vectors of several dimensions")
    all_videos = c.videos.unionByName(videos.withColumn("active", F.lit(True)), allowMissingColumns=True)
    all_tracks = c.tracks.unionByName(tracks, allowMissingColumns=True)
    records = materialize(catalog.appended(c.records, embedded, "track_id"), "records")
    states = attempted(c.states, all_tracks, embedded, failed)
    return regrouped(replace(c, videos=all_videos, tracks=all_tracks, records=records, states=states), cluster)


def attempted(states: DataFrame, tracks: DataFrame, embedded: DataFrame, failed: DataFrame | None) -> DataFrame:
    """States in which every track that was tried and has crops counts one more attempt, with its new error or none."""
    names = ("status", "failed_stage", "last_error")
    tried = embedded.select("track_id", *[F.lit(None).cast("string").alias("_" + n) for n in names])
    if failed is not None:
        tried = tried.unionByName(failed.select("track_id", *[F.col(n).alias("_" + n) for n in names]))
    tried = tried.withColumn("_tried", F.lit(1))
    rows = tracks.select("track_id", "crop_count").join(states.select("track_id", "attempt_count", *names), "track_id", "left").join(tried, "track_id", "left")
    now = F.col("_tried").isNotNull()
    count = F.coalesce("attempt_count", F.lit(0)) + F.when(now & (F.col("crop_count") > 0), 1).otherwise(0)
    return rows.select("track_id", count.alias("attempt_count"), *[F.when(now, F.col("_" + n)).otherwise(F.col(n)).alias(n) for n in names])


def regrouped(c: Collection, cluster: Clusterer) -> Collection:
    """The collection with the groups of its active records, and the states that follow."""
    active = materialize(c.active(), "active")
    labels = materialize(cluster(active.withColumnRenamed("track_id", "id")).select(F.col("id").alias("track_id"), "label"), "labels")
    named = materialize(continuity.reconcile(labels, c.groups, c.next_number), "named")
    groups = materialize(labels.join(named, "label").select("person_id", "track_id"), "groups")
    top = named.select("person_id").unionByName(c.groups.select("person_id")).agg(F.max(person_number(F.col("person_id"))).alias("n")).first()["n"]
    plain = catalog.track_states(c.tracks, c.records.select("track_id", F.col("cache_row").alias("embedding_row")), c.states)
    states = materialize(catalog.cache_states(plain, c.records, active), "states")
    return replace(c, groups=groups, states=states, next_number=max(c.next_number, (top or 0) + 1))


def exclude(c: Collection, requested: DataFrame, cluster: Clusterer) -> Collection:
    """The collection with the requested videos (video_id) inactive: their records stay cached, groups are formed again without them.

    An unknown id refuses the whole request; a request for nothing but excluded videos changes nothing.
    """
    after = materialize(catalog.excluded(c.membership(), requested), "membership")
    if after.join(c.videos.filter("active").select("video_id"), "video_id", "left_semi").filter("NOT active").isEmpty():
        return c
    return regrouped(replace(c, videos=c.videos.drop("active").join(after, "video_id")), cluster)


def rankings(c: Collection, frames: DataFrame | None = None) -> DataFrame:
    """(person_id, video_id, rank, ...) of the groups as they are; nothing but the ranking is made anew."""
    return ranking.rank_sources(c.groups, c.tracks, c.videos, frames)


def grouped_anew(c: Collection, cluster: Clusterer) -> Collection:
    """The same records in new groups, numbered from P0001; the old collection stays as it is."""
    return regrouped(replace(c, groups=c.groups.limit(0), next_number=1), cluster)


def retries(c: Collection) -> DataFrame:
    """Tracks of active videos whose embedding is to be tried again."""
    return catalog.retry_queue(c.states, c.tracks, c.membership())


def report(c: Collection) -> DataFrame:
    """(name, n): the counters that a log keeps."""
    active = c.active_tracks()
    counts = {
        "videos": c.videos.filter("active"), "registered_videos": c.videos, "excluded_videos": c.videos.filter("NOT active"), "tracks": active,
        "cached_embeddings": c.records, "active_embeddings": c.active(), "groups": c.groups.select("person_id").distinct(),
        "missing_embeddings": audit.missing_embeddings(active, c.records),
    }
    out = None
    for name, rows in counts.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def check(c: Collection) -> None:
    """All rules between the tables; the first broken one ends with RuleBroken."""
    view = c.active()
    audit.check_all({
        "video twice": catalog.unique(c.videos, "video_id"),
        "track twice": catalog.unique(c.tracks, "track_id"),
        "record twice": catalog.unique(c.records, "track_id"),
        "track of a video that is not there": catalog.unknown_ids(c.tracks, c.videos, "video_id"),
        "record of a track that is not there": catalog.unknown_ids(c.records, c.tracks, "track_id"),
        "cache rows are not 0 to n - 1": catalog.not_a_permutation(c.records, "cache_row"),
        "vector that is empty, zero or not finite": catalog.invalid_vectors(c.records, None).select("track_id"),
        "record and track name different videos": catalog.differing(c.records, c.tracks, "track_id", ["video_id"]),
        "state against the tables": audit.state_mismatch(c.states, c.tracks, c.records, view),
        "track in two groups": catalog.shared_members(c.groups),
        "groups and active records differ": catalog.set_difference(c.groups.select("track_id"), view.select("track_id")),
        "group id that is not P and digits": c.groups.filter(~F.col("person_id").rlike("^P[0-9]+$")),
    })


def save(c: Collection, root: str) -> str:
    """Checks the collection and publishes all of its tables as one version, with the next free number."""
    check(c)
    number = c.videos.sparkSession.createDataFrame([(c.next_number,)], "next_number long")
    return publish.publish(root, {name: getattr(c, name) for name in TABLES} | {"numbers": number})


def load(spark: SparkSession, root: str) -> Collection:
    """The published version, after all rules have been checked."""
    tables = {name: publish.load(spark, root, name) for name in TABLES}
    c = Collection(**tables, next_number=int(publish.load(spark, root, "numbers").first()["next_number"]))
    check(c)
    return c
