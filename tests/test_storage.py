"""Files, publication, exports and streams."""

import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.plans import export, publish
from cohortix.sources import files, npy
from cohortix.streaming import ingest


def test_publish_and_recover(spark, tmp_path):
    root = str(tmp_path / "c")
    first = publish.publish(root, {"videos": spark.range(3)})
    assert publish.current(root) == first and publish.load(spark, root, "videos").count() == 3

    class Broken:
        @property
        def write(self):
            raise RuntimeError("disk")

    with pytest.raises(RuntimeError, match="disk"):
        publish.publish(root, {"videos": spark.range(5), "tracks": Broken()})
    assert publish.current(root) == first and publish.load(spark, root, "videos").count() == 3
    assert publish.recover(root) == "clean" == publish.recover(root)
    second = publish.publish(root, {"videos": spark.range(4)})
    assert publish.load(spark, root, "videos").count() == 4
    assert publish.prune(root, 1) == [first] and publish.current(root) == second
    (tmp_path / "c" / publish.JOURNAL).write_text('{"version": "v-lost", "previous": null}')
    with pytest.raises(publish.Pending):
        publish.current(root)
    assert publish.recover(root) == "rolled_back" and publish.current(root) == second
    with publish.single_writer(root), pytest.raises(publish.Pending), publish.single_writer(root):
        pass


def test_npy(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(6, dtype=np.float32).reshape(3, 2))
    df = npy.read(spark, str(tmp_path / "a.npy"))
    assert [r["embedding"] for r in df.orderBy("row").collect()] == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]]
    assert np.load(io.BytesIO(npy.dump(df))).tolist() == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]]
    np.save(tmp_path / "b.npy", np.arange(3))
    with pytest.raises(Exception, match="float"):
        npy.read(spark, str(tmp_path / "b.npy")).collect()


def test_scan(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for name in ("b.MP4", "a.mov", "s/c.mp4", "x.txt"):
        (tmp_path / name).write_bytes(b"1")
    names = [r["path"].rsplit("/", 1)[1] for r in files.scan(spark, str(tmp_path), ["mp4", ".mov"]).collect()]
    assert names == ["a.mov", "b.MP4", "c.mp4"]
    assert files.scan(spark, str(tmp_path), ["mp4"], limit=1).count() == 1


def test_gallery(spark):
    albums = spark.createDataFrame([("P0001", "accepted", 0.81), ("P0002", "review", 0.6)], "person_id string, export_status string, album_quality_score double")
    crops = spark.createDataFrame([("P0001", "<t>", ["a.jpg", "b.jpg"])], "person_id string, track_id string, paths array<string>")
    sections = export.gallery(albums, crops, most_crops=1)
    (row,) = sections.collect()
    assert "&lt;t&gt;" in row["html"] and "0.810" in row["html"] and "b.jpg" not in row["html"]
    images = spark.createDataFrame([("a.jpg", b"x")], "path string, content binary")
    assert 'src="data:image/jpeg;base64,eA=="' in export.standalone(sections, images).first()["html"]
    assert export.gallery(albums, crops, everything=True).count() == 2


def test_documents(spark):
    t = spark.createDataFrame([("t2", "V", 1), ("t1", "V", 2)], "track_id string, video_id string, frame_count long")
    f = spark.createDataFrame([("t1", 3, 0.5), ("t1", 1, 0.5)], "track_id string, frame_index long, confidence double")
    (row,) = export.track_documents(t, f).collect()
    assert row["document"].index('"t1"') < row["document"].index('"t2"') and row["document"].index('"frame_index":1') < row["document"].index('"frame_index":3')


def test_stream_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    seen = []
    kind = "video_id string, sha256 string, active boolean"

    def registered():
        return spark.createDataFrame([(p, h, True) for p, h in seen], kind)

    def publish_batch(rows, number):
        seen.extend((r["path"], r["sha256"]) for r in rows.collect())

    for step in (("a.mp4", b"1"), ("b.mp4", b"1"), ("c.mp4", b"2")):
        (source / step[0]).write_bytes(step[1])
        stream = ingest.read_files(spark, str(source))
        query = ingest.ingest(stream, registered, publish_batch, str(tmp_path / "ck"))
        query.processAllAvailable()
        query.stop()
    assert len(seen) == 2


def test_sessions_in_batch(spark):
    events = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"), (1, "2024-01-01 05:00:00")], "user_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted(r["n"] for r in ingest.sessions(events).collect()) == [1, 2]
