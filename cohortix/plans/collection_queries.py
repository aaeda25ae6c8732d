"""Registered queries of whole collections and of the rules between their tables, each with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, catalog, crops, identity
from . import collection, export
from . import standins as D
from .queries import BOXED, FRAMES, IDENTITY, LOOSE, ODD, odd_videos, query, r6


# Collections: an embedding is a track of the video vec_id % 40, and is clustered by its label


def by_label(active: DataFrame) -> DataFrame:
    return active.select("id", "label")


def parts(spark: SparkSession, sf_dir: str, rows: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(videos, tracks, vectors) of some embeddings."""
    v = D.vectors(spark, sf_dir).filter(rows).select(F.col("id").alias("track_id"), (F.col("id") % 40).alias("video_id"), "embedding", "label")
    videos = v.select("video_id").distinct().select("video_id", F.lit(100).cast("long").alias("frame_count"), F.lit(None).cast("long").alias("processed_frame_count"), F.lit(None).cast("boolean").alias("analysis_complete"))
    return videos, v.select("track_id", "video_id", F.lit(2).alias("crop_count")), v


@query("""WITH e AS (SELECT vec_id, label, vec_id % 4 = 3 AS is_new, vec_id % 28 = 3 AS bad FROM embeddings), o AS (SELECT label, row_number() OVER (ORDER BY min(vec_id)) AS n FROM e WHERE NOT is_new GROUP BY label),
f AS (SELECT label, (SELECT count(*) FROM o) + row_number() OVER (ORDER BY min(vec_id)) AS n FROM e WHERE NOT bad AND label NOT IN (SELECT label FROM o) GROUP BY label), p AS (SELECT * FROM o UNION ALL SELECT * FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY bad ORDER BY is_new, vec_id) - 1 AS k FROM e)
SELECT vec_id AS track_id, CASE WHEN bad THEN 'retryable_error' ELSE 'complete' END AS status, 1 AS attempt_count, CASE WHEN bad THEN 'reid' END AS failed_stage, CASE WHEN NOT bad THEN k END AS cache_row, CASE WHEN NOT bad THEN printf('P%04d', n) END AS person_id
FROM r LEFT JOIN p USING (label)""")
def add_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_new, bad = F.col("id") % 4 == 3, F.col("track_id") % 28 == 3
    videos, tracks, vectors = parts(spark, sf_dir, ~is_new)
    first = collection.start(videos, tracks, vectors, None, by_label)
    videos, tracks, vectors = parts(spark, sf_dir, is_new)
    failed = vectors.filter(bad).select("track_id", F.lit("retryable_error").alias("status"), F.lit("reid").alias("failed_stage"), F.lit("e").alias("last_error"))
    c = collection.add(first, videos, tracks, vectors.filter(~bad), failed, by_label)
    return c.states.join(c.groups, "track_id", "left").select("track_id", "status", "attempt_count", "failed_stage", "cache_row", "person_id")


def after_exclusion(spark: SparkSession, sf_dir: str) -> collection.Collection:
    c = collection.start(*parts(spark, sf_dir, F.lit(True)), None, by_label)
    return collection.exclude(c, c.videos.filter("video_id % 5 = 0").select("video_id"), by_label)


@query("""WITH e AS (SELECT vec_id, label, vec_id % 5 <> 0 AS active, row_number() OVER (ORDER BY vec_id) - 1 AS cache_row FROM embeddings), p AS (SELECT label, row_number() OVER (ORDER BY min(vec_id)) AS n FROM e GROUP BY label)
SELECT vec_id AS track_id, 'complete' AS status, cache_row, CASE WHEN active THEN row_number() OVER (PARTITION BY active ORDER BY vec_id) - 1 END AS embedding_row, CASE WHEN active THEN printf('P%04d', n) END AS person_id FROM e JOIN p USING (label)""")
def delete_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = after_exclusion(spark, sf_dir)
    return c.states.join(c.groups, "track_id", "left").select("track_id", "status", "cache_row", "embedding_row", "person_id")


@query("""WITH e AS (SELECT vec_id, label, vec_id % 40 AS v, vec_id % 5 <> 0 AS active FROM embeddings)
SELECT 'videos' AS name, count(DISTINCT v) AS n FROM e WHERE active UNION ALL SELECT 'registered_videos', count(DISTINCT v) FROM e UNION ALL SELECT 'excluded_videos', count(DISTINCT v) FROM e WHERE NOT active UNION ALL SELECT 'tracks', count(*) FROM e WHERE active
UNION ALL SELECT 'cached_embeddings', count(*) FROM e UNION ALL SELECT 'active_embeddings', count(*) FROM e WHERE active UNION ALL SELECT 'groups', count(DISTINCT label) FROM e WHERE active UNION ALL SELECT 'missing_embeddings', 0""")
def collection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.report(after_exclusion(spark, sf_dir))


@query(f"""{ODD} SELECT 'G' || (video_id % 7) AS person_id, row_number() OVER (PARTITION BY video_id % 7 ORDER BY (status = 'valid') DESC,
  CASE WHEN status = 'valid' THEN CAST(visible AS DOUBLE) / total END DESC NULLS LAST, CASE WHEN status = 'valid' THEN visible END DESC NULLS LAST, video_id) AS rank, video_id, status AS coverage_status FROM final""")
def sort_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = D.frames(spark, sf_dir)
    tracks = frames.groupBy("track_id", "video_id").agg(F.count("*").alias("frame_count")).withColumn("ranges", F.lit(None).cast("array<struct<start:bigint,end:bigint>>"))
    groups = tracks.select(F.concat(F.lit("G"), (F.col("video_id") % 7).cast("string")).alias("person_id"), "track_id")
    c = collection.Collection(odd_videos(spark, sf_dir), tracks, tracks.limit(0), tracks.limit(0), groups)
    return collection.rankings(c, frames).select("person_id", "rank", "video_id", "coverage_status")


# Rules, on tables in which some rows break them


@query("""SELECT CASE WHEN doc_id % 50 = 0 THEN 'v' ELSE '' END || doc_id AS video_id, CASE WHEN doc_id % 50 = 0 THEN 'folder' ELSE 'failed' END AS problem FROM documents WHERE doc_id % 50 = 0 OR doc_id % 70 = 0""")
def folder_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, name = F.col("doc_id"), F.col("doc_id").cast("string")
    made = D.table(spark, sf_dir, "documents").select(name.alias("folder"), F.when(i % 50 == 0, F.concat(F.lit("v"), name)).otherwise(name).alias("video_id"), F.when(i % 70 == 0, "e").alias("error"))
    return audit.folder_mismatch(made)


@query(f"""WITH {FRAMES} SELECT track_id FROM frames WHERE video_id % 5 <> 0 GROUP BY 1 HAVING count(*) <> max(frame_index) - min(frame_index) + 1""")
def range_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = D.frames(spark, sf_dir)
    whole = F.array(F.struct(F.min("frame_index").alias("start"), F.max("frame_index").alias("end")))
    tracks = frames.groupBy("track_id", "video_id").agg(whole.alias("ranges")).withColumn("ranges", F.when(F.col("video_id") % 5 != 0, F.col("ranges")))
    return audit.stored_range_mismatch(tracks, frames)


@query(f"""WITH {FRAMES} SELECT track_id FROM frames GROUP BY 1 HAVING count(*) % 3 = 0 OR max(frame_index) % 4 = 0""")
def frame_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = D.frames(spark, sf_dir)
    tracks = frames.groupBy("track_id").agg((F.count("*") + F.when(F.count("*") % 3 == 0, 1).otherwise(0)).alias("frame_count"), F.min("frame_index").alias("start_frame"), (F.max("frame_index") + F.when(F.max("frame_index") % 4 == 0, 1).otherwise(0)).alias("end_frame"))
    return catalog.invalid_frames(tracks, frames)


@query("""SELECT vec_id AS track_id FROM embeddings WHERE label % 3 <> 0 AND (vec_id % 13 = 0 OR vec_id % 17 = 0 OR vec_id % 19 = 0)""")
def cache_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("track_id")
    v = D.vectors(spark, sf_dir).select(F.col("id").alias("track_id"), F.col("label").alias("video_id"), F.col("id").alias("cache_row"), "embedding")
    view = catalog.active_view(v, v.select("video_id").distinct().withColumn("active", F.col("video_id") % 3 != 0))
    stored = view.filter(i % 19 != 0).withColumn("active_row", F.col("active_row") + F.when(i % 13 == 0, 1).otherwise(0))
    return audit.active_mismatch(stored.withColumn("embedding", F.when(i % 17 == 0, F.transform("embedding", lambda x: x + 1)).otherwise(F.col("embedding"))), view)


@query("""SELECT event_type AS name, count(*) + 1 AS logged, count(*) AS counted FROM events WHERE length(event_type) % 2 = 0 GROUP BY 1 UNION ALL SELECT 'none', 5, NULL""")
def counter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = D.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n"))
    logged = counted.select("name", (F.col("n") + F.when(F.length("name") % 2 == 0, 1).otherwise(0)).alias("n"))
    other = spark.createDataFrame([("none", 5), ("old", None)], "name string, n long")
    return audit.counter_mismatch(logged.unionByName(other), counted)


@query("""WITH g AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT 'P' || k AS person_id, CASE WHEN k % 7 = 0 OR k % 13 = 0 THEN 'no_metadata' ELSE 'differs' END AS problem FROM g WHERE ((k % 7 = 0 OR k % 13 = 0) AND k % 2 = 0) OR (k % 7 <> 0 AND k % 13 <> 0 AND (k % 11 = 0 OR k % 17 = 0))
UNION ALL SELECT 'X' || k, 'no_group' FROM g WHERE k % 13 = 0 AND k % 7 <> 0""")
def album_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    lists = D.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list("o_orderkey").alias("local_tracks"))
    status = F.when(k % 2 == 0, "accepted").otherwise("review")
    groups = lists.select(F.concat(F.lit("P"), k.cast("string")).alias("person_id"), status.alias("export_status"), "local_tracks")
    changed = F.when(k % 17 == 0, F.concat("local_tracks", F.array(F.lit(-1).cast("long")))).otherwise(F.col("local_tracks"))
    albums = lists.filter(k % 7 != 0).select(F.concat(F.when(k % 13 == 0, "X").otherwise("P"), k.cast("string")).alias("person_id"), F.when(k % 11 == 0, "rejected").otherwise(status).alias("export_status"), F.reverse(changed).alias("local_tracks"))
    return audit.album_mismatch(groups, albums)


@query("""WITH d AS (SELECT doc_id AS i FROM documents WHERE text IS NOT NULL)
SELECT 'f' || i AS path, CASE WHEN i % 11 = 0 THEN 'gone' WHEN i % 9 = 0 THEN 'new' ELSE 'changed' END AS problem FROM d WHERE (i % 9 = 0) <> (i % 11 = 0) OR (i % 9 <> 0 AND i % 11 <> 0 AND i % 17 = 0)""")
def artifact_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, path = F.col("doc_id"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path")
    docs = D.table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    digest = lambda c: F.sha2(c.cast("binary"), 256).alias("sha256")
    return audit.changed_artifacts(docs.filter(i % 9 != 0).select(path, digest(F.col("text"))), docs.filter(i % 11 != 0).select(path, digest(F.when(i % 17 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")))))


@query("""SELECT c_custkey AS video_id FROM customer WHERE (c_custkey % 10 = 0) <> (c_custkey % 15 = 0) OR (c_custkey % 10 <> 0 AND c_custkey % 15 <> 0 AND c_custkey % 12 = 0)""")
def index_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("video_id")
    rows = D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("video_id"), F.col("c_name").alias("filename"), F.col("c_nationkey").alias("width"))
    return audit.index_mismatch(rows.filter(k % 10 != 0).withColumn("filename", F.when(k % 12 != 0, F.col("filename"))), rows.filter(k % 15 != 0), ["filename", "width"])


@query("""SELECT vec_id AS track_id FROM embeddings WHERE vec_id % 4 > 0 AND vec_id % 3 <> 0""")
def missing_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = D.vectors(spark, sf_dir).select(F.col("id").alias("track_id"), (F.col("id") % 4).alias("crop_count"))
    return audit.missing_embeddings(v, v.filter("track_id % 3 = 0"))


@query(f"""WITH {BOXED}, t AS (SELECT track_id, any_value(video_id) % 3 <> 0 AS active, count(*) FILTER (WHERE frame_index % 2 = 0 AND confidence >= 0.9) AS n FROM boxed GROUP BY 1)
SELECT track_id, active AND n > 0 AS is_active, CASE WHEN NOT active THEN 'too_short' WHEN n = 0 THEN 'no_valid_crops' END AS ignored_reason, CASE WHEN active THEN n ELSE 0 END AS crop_count FROM t""")
def crop_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = D.boxed_frames(spark, sf_dir)
    frames = detections.select("video_id", "frame_index").distinct().filter("frame_index % 2 = 0")
    tracks = detections.groupBy("track_id").agg((F.max("video_id") % 3 != 0).alias("is_active")).withColumn("ignored_reason", F.when(~F.col("is_active"), "too_short"))
    chosen = crops.candidates(frames, detections, tracks).filter("confidence >= 0.9")
    return crops.after_crops(tracks, chosen).select("track_id", "is_active", "ignored_reason", "crop_count")


@query(f"""{IDENTITY} SELECT label, round(reid_mean, 6) AS identity_reid_mean, round(reid_min, 6) AS identity_reid_min, round(combined_mean, 6) AS identity_combined_mean, round(combined_min, 6) AS identity_combined_min,
round(combined_p10, 6) AS identity_combined_p10, round(combined_std, 6) AS identity_combined_std, CAST(0.5 AS DOUBLE) AS identity_color_mean FROM joint""")
def identity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = export.identity_summary(identity.stats(D.vectors(spark, sf_dir), LOOSE), "label")
    return out.select("label", *[r6(c).alias(c) for c in out.columns if c != "label"])
