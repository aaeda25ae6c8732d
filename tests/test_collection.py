"""Whole collections, their registry, plug-ins and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.operators import similarity
from cohortix.operators.catalog import RuleBroken
from cohortix.plans import collection, plugins, registry
from cohortix.streaming import ingest

KIND = "track_id string, video_id string, embedding array<float>"


def nearest(active):
    """Vectors with the greatest element in the same place are one cluster."""
    place = F.array_position("embedding", F.array_max("embedding")).cast("int")
    return active.select("id", place.alias("label"))


def rows(spark, items):
    vectors = spark.createDataFrame(items, KIND)
    videos = vectors.select("video_id").distinct().withColumn("frame_count", F.lit(10).cast("long"))
    return videos, vectors.select("track_id", "video_id", F.lit(1).alias("crop_count")), vectors


def groups_of(c):
    return {(r["person_id"], r["track_id"]) for r in c.groups.collect()}


def test_life_of_a_collection(spark, tmp_path):
    """Start, exclude (the rest keeps its id), ask again, an unknown id, add (ids are not used twice), save, load, damage."""
    c = collection.start(*rows(spark, [("a", "A", [1.0, 0.0]), ("b", "B", [0.0, 1.0])]), None, nearest)
    assert groups_of(c) == {("P0001", "a"), ("P0002", "b")} and c.next_number == 3
    only = collection.exclude(c, spark.createDataFrame([("A",)], "video_id string"), nearest)
    assert groups_of(only) == {("P0002", "b")}
    assert {(r["track_id"], r["status"], r["embedding_row"], r["cache_row"]) for r in only.states.collect()} == {("a", "complete", None, 0), ("b", "complete", 0, 1)}
    assert collection.exclude(only, spark.createDataFrame([("A",)], "video_id string"), nearest) is only
    with pytest.raises(RuleBroken, match="unknown"):
        collection.exclude(only, spark.createDataFrame([("B",), ("Z",)], "video_id string"), nearest)
    with pytest.raises(RuleBroken, match="known already"):
        collection.add(only, *rows(spark, [("x", "B", [1.0, 0.0])]), None, nearest)
    with pytest.raises(RuleBroken, match="dimensions"):
        collection.add(only, *rows(spark, [("x", "C", [1.0, 0.0, 0.0])]), None, nearest)
    failed = spark.createDataFrame([("d", "retryable_error", "reid", "no memory")], "track_id string, status string, failed_stage string, last_error string")
    videos, tracks, vectors = rows(spark, [("c", "C", [1.0, 0.0]), ("d", "C", [1.0, 0.0])])
    more = collection.add(only, videos, tracks, vectors.filter("track_id = 'c'"), failed, nearest)
    assert groups_of(more) == {("P0002", "b"), ("P0003", "c")} and more.next_number == 4
    assert [(r["track_id"], r["next_attempt"]) for r in collection.retries(more).collect()] == [("d", 2)]
    root = str(tmp_path / "c")
    collection.save(more, root)
    back = collection.load(spark, root)
    assert groups_of(back) == groups_of(more) and back.next_number == 4
    again = collection.add(back, videos.limit(0), tracks.limit(0), vectors.filter("track_id = 'd'"), None, nearest)
    assert groups_of(again) == {("P0002", "b"), ("P0003", "c"), ("P0003", "d")}
    assert {(r["track_id"], r["attempt_count"]) for r in again.states.collect()} == {("a", 1), ("b", 1), ("c", 1), ("d", 2)}
    with pytest.raises(RuleBroken, match="state"):
        collection.save(collection.replace(again, states=back.states), root)


def test_registry(spark, tmp_path):
    c = collection.start(*rows(spark, [("a", "A", [1.0, 0.0]), ("b", "B", [0.0, 1.0])]), None, nearest)
    folder, path = tmp_path / "files", str(tmp_path / "registry")
    (folder / "s").mkdir(parents=True)
    (folder / "a.json").write_text("{}")
    (folder / "s" / "b.json").write_text("[]")
    files = registry.digests(spark, str(folder))
    assert sorted(r["path"] for r in files.collect()) == ["a.json", "s/b.json"]
    registry.write(c, files, path)
    registry.check(registry.scan(spark, path), c, registry.digests(spark, str(folder)))
    with pytest.raises(Exception, match="(?i)exist"):
        registry.write(c, files, path)
    assert registry.copied(spark, str(folder), str(tmp_path / "copy")).count() == 2
    with pytest.raises(FileExistsError):
        registry.copied(spark, str(folder), str(tmp_path / "copy"))
    (folder / "a.json").write_text("{1}")
    with pytest.raises(RuleBroken, match="registered files"):
        registry.check(registry.scan(spark, path), c, registry.digests(spark, str(folder)))
    registry.must_be_apart("/a/b", "/a/bc")
    with pytest.raises(ValueError):
        registry.must_be_apart("/a/b/c", "/a/b")


def test_plugins(spark):
    def embed_bytes(images):
        if images[0] == b"bad":
            raise RuntimeError
        return [[float(len(b)), 1.0] if b else None for b in images]

    plugins.register_embedder("length", embed_bytes)
    plugins.register_clusterer("nearest", nearest)
    crops = spark.createDataFrame([("t", "1", b"abc"), ("t", "2", None), ("u", "3", b"bad"), ("v", "4", b"")], "track_id string, crop string, content binary")
    out = {r["crop"]: (r["embedding"], r["error"]) for r in plugins.embed("length", crops).collect()}
    assert out == {"1": ([3.0, 1.0], None), "2": (None, "blocked"), "3": (None, "retryable"), "4": (None, "retryable")}

    def boxes(batches):
        for batch in batches:
            yield batch.assign(video_id=batch["path"], frame_index=0, raw_track_id=1, x1=0.0, y1=0.0, x2=1.0, y2=2.0, confidence=0.5, class_id=0)[[c.split()[0] for c in plugins.DETECTIONS.split(", ")]]

    plugins.register_detector("one", boxes)
    assert plugins.detect("one", spark.createDataFrame([("p", b"")], "path string, content binary")).first()["video_id"] == "p"
    assert plugins.clusterer("nearest") is nearest
    now = plugins.signature({"reid": "1f"}, "mean", embed_bytes)
    assert plugins.same_signature(now, dict(now)) and not plugins.same_signature(None, now)
    with pytest.raises(RuleBroken, match="reid"):
        plugins.same_signature({**now, "reid": "2f"}, now)


def test_fingerprints(spark):
    red, blue = np.zeros((20, 10, 3), np.uint8), np.full((20, 10, 3), 120, np.uint8)
    one = similarity.colour_histogram(red)
    assert len(one) == 216 and np.isclose(np.linalg.norm(one), 1) and np.count_nonzero(one) == 6
    df = spark.createDataFrame([("t", 20, 10, red.tobytes()), ("t", 20, 10, blue.tobytes()), ("u", 0, 0, None)], "track_id string, height int, width int, hsv binary")
    (row,) = similarity.track_fingerprints(df).collect()
    mean = one + similarity.colour_histogram(blue)
    assert row["crops_used"] == 2 and np.allclose(row["embedding"], mean / np.linalg.norm(mean))


def test_stream_of_tracks_and_retries(spark, tmp_path):
    kind = "video_id string, track_id string, frame_index long, last boolean, ts timestamp"
    source = str(tmp_path / "in")
    states = [("t", "retryable_error")]
    seen, tries = [], []
    for n, last in ((0, False), (1, True)):
        spark.createDataFrame([("V", "t", n, last)], "video_id string, track_id string, frame_index long, last boolean").withColumn("ts", F.current_timestamp()).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        query = ingest.live_tracks(stream).writeStream.outputMode("update").foreachBatch(lambda rows, i: seen.extend(map(tuple, rows.collect()))).option("checkpointLocation", str(tmp_path / "c1")).start()
        query.processAllAvailable()
        query.stop()
        again = ingest.retries(lambda: spark.createDataFrame(states, "track_id string, status string"), stream, lambda rows, waiting, i: tries.append([r["track_id"] for r in waiting.collect()]), str(tmp_path / "c2"))
        again.processAllAvailable()
        again.stop()
        states[:] = [("t", "complete")]
    assert [r for r in seen if r[2]] == [("V", "t", 1, 0, 0, False), ("V", "t", 2, 0, 1, True)]
    assert tries == [["t"], []]
