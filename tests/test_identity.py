"""Operators of the identity model against hand-made cases and brute force."""

import itertools

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortix.functions import scalars, scores, text, vectors
from cohortix.operators import albums, catalog, clusters, conflicts, continuity, crops, identity, ranges, ranking, similarity, tracks
from cohortix.plans import collection_queries, config, queries
from cohortix.sources import files


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_compact(spark):
    df = spark.createDataFrame([(1, i) for i in (3, 1, 2, 2, 8)], "k int, i long")
    assert rows(ranges.compact(df, ["k"], "i"), "start", "end") == [(1, 3), (8, 8)]
    with pytest.raises(Exception, match="nonnegative"):
        ranges.compact(spark.createDataFrame([(1, -1)], "k int, i long"), ["k"], "i").collect()


def test_merge(spark):
    df = spark.createDataFrame([(1, 10, 20), (1, 0, 12), (1, 21, 22), (1, 30, 30)], "k int, start long, end long")
    assert rows(ranges.merge(df, ["k"]), "start", "end") == [(0, 22), (30, 30)]
    with pytest.raises(Exception, match="invalid"):
        ranges.merge(spark.createDataFrame([(1, 2, 1)], "k int, start long, end long"), ["k"]).collect()


def ranked(spark, tracks_in, videos_in, members=None):
    kind = "track_id string, video_id string, frame_count long, ranges array<struct<start:long,end:long>>"
    t = spark.createDataFrame(tracks_in, kind)
    v = spark.createDataFrame(videos_in, "video_id string, frame_count long, processed_frame_count long, analysis_complete boolean")
    m = spark.createDataFrame(members or [("P1", r[0]) for r in tracks_in], "person_id string, track_id string")
    out = ranking.rank_sources(m, t, v).orderBy("person_id", "rank").collect()
    return [(r["video_id"], r["visible_frames"], r["appearance_percentage"], r["coverage_status"]) for r in out]


@pytest.mark.parametrize(
    ("tracks_in", "videos_in", "expected"),
    [
        ([("a", "V", 100, [(0, 99)]), ("b", "V", 100, [(80, 179)])], [("V", 300, None, None)], [("V", 180, 60.0, "valid")]),
        ([("a", "V", 20, [(0, 9), (20, 29)])], [("V", 100, None, None)], [("V", 20, 20.0, "valid")]),
        ([("a", "A", 300, [(0, 299)]), ("b", "B", 6, [(0, 5)])], [("A", 1000, None, None), ("B", 10, None, None)], [("B", 6, 60.0, "valid"), ("A", 300, 30.0, "valid")]),
        ([("a", "A", 2, [(0, 1)]), ("b", "B", 3, [(0, 2)]), ("c", "C", 2, [(0, 1)])], [("A", 4, None, None), ("B", 6, None, None), ("C", 4, None, None)], [("B", 3, 50.0, "valid"), ("A", 2, 50.0, "valid"), ("C", 2, 50.0, "valid")]),
        ([("a", "A", 1, [(0, 0)]), ("b", "B", 0, None)], [("A", 0, None, None), ("B", 100, None, None)], [("B", 0, 0.0, "valid"), ("A", 1, None, "invalid_total_frames")]),
        ([("a", "V", 101, [(0, 100)])], [("V", 100, None, None)], [("V", 101, None, "out_of_range_frames")]),
        ([("a", "V", 10, [(0, 9)])], [("V", 100, 100, True)], [("V", 10, 10.0, "valid")]),
        ([("a", "V", 10, [(0, 9)])], [("V", 100, 90, True)], [("V", 10, None, "frame_count_mismatch")]),
        ([("a", "V", 10, [(0, 9)])], [("V", 0, 100, True)], [("V", 10, 10.0, "valid")]),
        ([("a", "V", 10, [(0, 9)])], [("V", 100, None, False)], [("V", 10, None, "incomplete_analysis")]),
        ([("a", "V", 20, None)], [("V", 100, None, None)], [("V", None, None, "missing_frame_observations")]),
        ([("a", "V", 2, [(2, 1)])], [("V", 100, None, None)], [("V", None, None, "invalid_frame_observations")]),
        ([("a", "V", 2, [(-1, 2)])], [("V", 100, None, None)], [("V", None, None, "invalid_frame_observations")]),
        ([("a", "V", 1, [(0, 9)])], [("V", 100, None, None)], [("V", None, None, "inconsistent_frame_observations")]),
        ([("a", "V", 1, [(0, 0)])], [("W", 100, None, None)], [("V", 1, None, "missing_video_metadata")]),
    ],
)
def test_coverage(spark, tracks_in, videos_in, expected):
    assert ranked(spark, tracks_in, videos_in) == expected


def test_ranking_close_ratios_and_missing_track(spark):
    out = ranked(spark, [("a", "A", 4999, [(0, 4998)]), ("z", "Z", 5000, [(0, 4999)])], [("A", 10000, None, None), ("Z", 10001, None, None)])
    assert [r[0] for r in out] == ["Z", "A"]
    with pytest.raises(Exception, match="missing track"):
        ranked(spark, [("a", "A", 1, [(0, 0)])], [("A", 1, None, None)], [("P1", "b")])


def test_mean_vectors(spark):
    df = spark.createDataFrame([("t", [1.0, 0.0]), ("t", [0.0, 1.0]), ("t", [float("nan"), 0.0]), ("u", [1.0, 0.0]), ("u", [-1.0, 0.0]), ("w", [0.0, 0.0])], "track_id string, embedding array<double>")
    (only,) = similarity.mean_vectors(df).collect()
    assert only["track_id"] == "t" and only["crops_used"] == 2 and np.allclose(only["embedding"], [0.5**0.5] * 2)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.floats(0.05, 1.2))
def test_linkage_against_plain_merging(seed, threshold):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((12, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    d = np.clip(1 - v @ v.T, 0, 2)
    groups = [[i] for i in range(len(d))]
    while len(groups) > 1:
        best = min(((np.mean([d[x, y] for x in a for y in b]), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(groups), 2)), key=lambda t: t[0])
        if best[0] >= threshold:
            break
        groups[best[1]] = groups[best[1]] + groups.pop(best[2])
    want = {frozenset(g) for g in groups}
    label = clusters.linkage(d, threshold)
    assert {frozenset(np.flatnonzero(label == x)) for x in set(label)} == want


def test_average_link_equals_whole_set(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 8))
    v = np.repeat(centres, 10, axis=0) + 0.35 * rng.standard_normal((60, 8))
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "id long, embedding array<float>")
    got = {r["id"]: r["label"] for r in clusters.average_link(df, 0.2).collect()}
    u = np.asarray(v, np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    label = clusters.linkage(np.clip(1 - u @ u.T, 0, 2), 0.2)
    assert {frozenset(i for i in got if got[i] == x) for x in got.values()} == {frozenset(np.flatnonzero(label == x)) for x in set(label)}


def test_conflicts_and_split(spark):
    records = spark.createDataFrame([(0, "V", 0, 10, 11), (1, "V", 5, 20, 16), (2, "V", 30, 40, 11), (3, "W", 0, 50, 51), (4, "V", 8, 9, 2)], "id long, video_id string, start_frame long, end_frame long, frame_count long")
    assert rows(conflicts.cannot_link(records), "left_id", "right_id") == [(0, 1), (0, 4), (1, 4)]
    labels = spark.createDataFrame([(i, 7) for i in range(5)], "id long, label long")
    parts = {}
    for r in conflicts.split(records, labels).collect():
        parts.setdefault(r["label"], set()).add(r["id"])
    # in the order 3, 1, 0, 2, 4: each joins the first part without an enemy
    assert {frozenset(p) for p in parts.values()} == {frozenset({3, 1, 2}), frozenset({0}), frozenset({4})}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60), st.integers(0, 30)), min_size=1, max_size=25))
def test_cannot_link_against_all_pairs(spark, spans):
    df = spark.createDataFrame([(i, v, s, s + n) for i, (v, s, n) in enumerate(spans)], "id long, video_id int, start_frame long, end_frame long")
    want = [(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(spans), 2) if a[0] == b[0] and max(a[1], b[1]) <= min(a[1] + a[2], b[1] + b[2])]
    assert rows(conflicts.cannot_link(df), "left_id", "right_id") == want


def test_identity_statistics(spark):
    members = spark.createDataFrame([(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [0.0, 1.0]), (3, 2, [1.0, 1.0])], "id long, label long, embedding array<double>")
    by = {r["label"]: r for r in identity.stats(members).collect()}
    assert by[2]["combined_mean"] == by[2]["identity_consistency_score"] == 1.0 and by[2]["reasons"] == []
    combined = np.array([0.75 + 0.125, 0.125, 0.125])
    assert np.isclose(by[1]["combined_p10"], np.percentile(combined, 10)) and np.isclose(by[1]["combined_std"], combined.std()) and np.isclose(by[1]["color_mean"], 0.5)
    assert set(by[1]["reasons"]) == {"weak_identity_consistency", "low_min_pair_similarity"}


def test_identity_split(spark):
    rng = np.random.default_rng(0)
    v = np.r_[np.tile([1.0, 0, 0], (6, 1)), np.tile([0, 1.0, 0], (6, 1))] + 0.01 * rng.standard_normal((12, 3))
    members = spark.createDataFrame([(i, 5, [float(y) for y in x]) for i, x in enumerate(v)], "id long, label long, embedding array<double>")
    out = {r["id"]: r["label"] for r in identity.split(members, identity.Limits(split_distance=0.3)).collect()}
    assert {out[i] for i in range(6)} == {5} and {out[i] for i in range(6, 12)} == {6}


def test_best_crops(spark):
    box = lambda x: (float(x), 0.0, x + 100.0, 100.0)
    data = [("t", 0, box(0), 0.9), ("t", 1, box(1), 0.8), ("t", 2, box(500), 0.7), ("t", 9, box(0), 0.6)]
    df = spark.createDataFrame(data, "track_id string, frame_index long, bbox struct<x1:double,y1:double,x2:double,y2:double>, score double")
    assert [r[0] for r in rows(crops.best(df, 3), "frame_index")] == [0, 2, 9]
    assert [r[0] for r in rows(crops.best(df, 4), "frame_index")] == [0, 1, 2, 9]  # filled up with the one passed over


def test_continuity(spark):
    labels = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "track_id string, label long")
    old = spark.createDataFrame([("P0007", "a"), ("P0007", "b")], "person_id string, track_id string")
    assert rows(continuity.reconcile(labels, old, 20), "label", "person_id") == [(0, "P0007"), (1, "P0020"), (2, "P0021")]
    merged = spark.createDataFrame([("a", 0), ("b", 0)], "track_id string, label long")
    two = spark.createDataFrame([("P0001", "a"), ("P0002", "b")], "person_id string, track_id string")
    assert rows(continuity.reconcile(merged, two), "label", "person_id") == [(0, "P0001")]
    assert continuity.lineage(merged, two).first()["previous_ids"] == ["P0001", "P0002"]
    with pytest.raises(ValueError, match="P-prefixed"):
        continuity.reconcile(merged, two.withColumn("person_id", F.lit("X1")))


def test_album_penalties_add_up(spark):
    n = 8
    members = spark.createDataFrame([("P0001", f"t{i}") for i in range(n)], "person_id string, track_id string")
    tracks_in = members.select("track_id", *[F.lit(v).alias(k) for k, v in dict(crop_quality_score=1.0, crop_person_shape_score=1.0, crop_edge_score=1.0, raw_movement_score=0.18, movement_score=1.0, duration_sec=2.0, average_bbox_size_score=1.0, activity_zone_score=1.0, embedding_consistency_score=1.0, crop_count=6).items()])
    mean = spark.createDataFrame([("P0001", 0.96)], "person_id string, mean_sim double")
    perfect = albums.album_quality(members, tracks_in, mean).first()
    assert np.isclose(perfect["album_quality_score"], 1.0) and perfect["export_status"] == "accepted" and perfect["quality_reasons"] == []
    weak = spark.createDataFrame([("P0001", 0.5, 0.4, ["weak_identity_consistency", "outfit_color_diversity"])], "person_id string, identity_consistency_score double, color_mean double, reasons array<string>")
    out = albums.album_quality(members, tracks_in, mean, identity=weak).first()
    assert np.isclose(out["album_quality_score"], 0.63 + 0.17 * 0.8 + 0.2 - 0.16 - 0.12 - 0.10 - 0.08) and out["quality_reasons"] == ["outfit_color_diversity", "weak_identity_consistency"]
    nobody = albums.album_quality(members, tracks_in.limit(0), mean).first()
    assert nobody["export_status"] == "rejected" and nobody["quality_reasons"] == ["no_valid_tracks"]


def test_tier_and_track_filter(spark):
    df = spark.createDataFrame([(0.78,), (0.55,), (0.5499,)], "s double")
    assert [r[0] for r in df.select(scores.tier(F.col("s"))).collect()] == ["accepted", "review", "rejected"]
    row = spark.createDataFrame([(3, 0.1, 0.5, 200.0, 0.1)], "frame_count long, duration_sec double, movement_score double, average_bbox_height double, active_score double")
    assert row.select(tracks.filter_reasons()).first()[0] == "too_short,too_short_duration,low_active_score"
    assert row.select(tracks.filter_reasons(active=False)).first()[0] == "too_short"


def test_activity_without_moving_tracks(spark):
    frames = spark.createDataFrame([("V", "t", i, (0.0, 0.0, 10.0, 10.0), 0.5) for i in range(3)], "video_id string, track_id string, frame_index long, bbox struct<x1:double,y1:double,x2:double,y2:double>, confidence double")
    videos = spark.createDataFrame([("V", 100, 100, 0.0)], "video_id string, width int, height int, fps double")
    stats = tracks.active_scores(tracks.track_stats(frames, videos))
    out = tracks.activity_zones(frames, stats, videos).first()
    assert out["duration_sec"] == 0.0 and out["raw_movement_score"] == 0.0 and out["activity_zone_score"] == out["center_position_score"]


def test_states_and_rules(spark):
    t = spark.createDataFrame([("a", "V", 2), ("b", "V", 0), ("c", "V", 1)], "track_id string, video_id string, crop_count long")
    r = spark.createDataFrame([("a", "V", 0, [1.0, 0.0])], "track_id string, video_id string, embedding_row long, embedding array<float>")
    states = catalog.track_states(t, r)
    assert rows(states, "track_id", "status") == [("a", "complete"), ("b", "no_usable_crops"), ("c", "pending")]
    videos = spark.createDataFrame([("V",)], "video_id string")
    groups = spark.createDataFrame([("P0001", "a")], "person_id string, track_id string")
    catalog.validate(videos, t, r, states, groups, 2)
    for bad, message in ((r.withColumn("embedding_row", F.lit(1).cast("long")), "permutation"), (r.withColumn("embedding", F.array(F.lit(0.0), F.lit(0.0))), "invalid embedding"), (r.withColumn("video_id", F.lit("W")), "mapping mismatch")):
        with pytest.raises(catalog.RuleBroken, match=message):
            catalog.validate(videos, t, bad, catalog.track_states(t, bad), groups, 2)
    with pytest.raises(catalog.RuleBroken, match="two groups"):
        catalog.validate(videos, t, r, states, groups.unionByName(groups.withColumn("person_id", F.lit("P0002"))), 2)


def test_exclusion_and_rows(spark):
    m = spark.createDataFrame([("A", True), ("B", True)], "video_id string, active boolean")
    ask = spark.createDataFrame([("A",)], "video_id string")
    once = catalog.excluded(m, ask)
    assert rows(once, "video_id", "active") == [("A", False), ("B", True)] == rows(catalog.excluded(once, ask), "video_id", "active")
    with pytest.raises(catalog.RuleBroken):
        catalog.excluded(m, ask.unionByName(spark.createDataFrame([("X",)], "video_id string")))
    records = spark.createDataFrame([("a", "A", 0), ("b", "B", 1), ("c", "B", 2)], "track_id string, video_id string, cache_row long")
    assert rows(catalog.active_view(records, once), "track_id", "active_row") == [("b", 0), ("c", 1)]
    grown = catalog.appended(records, spark.createDataFrame([("d", "C")], "track_id string, video_id string"), "track_id")
    assert ("d", 3) in rows(grown, "track_id", "cache_row")


def test_discover_and_names(spark):
    incoming = spark.createDataFrame([("b.mp4", "h1"), ("a.mp4", "h1"), ("c.mp4", "h2"), ("d.mp4", "h3")], "path string, sha256 string")
    known = spark.createDataFrame([("V", "h2", False)], "video_id string, sha256 string, active boolean")
    assert rows(files.discover(incoming, known), "path") == [("a.mp4",), ("d.mp4",)]
    assert rows(files.discover(incoming, known, 1), "path") == [("a.mp4",)]
    assert rows(files.duplicates(incoming, known), "path", "active") == [("c.mp4", False)]
    same = spark.createDataFrame([("a", "abcdef0011aa22"), ("b", "abcdef0011bb33"), ("c", "abcdef0999aa22")], "path string, sha1 string")
    assert rows(files.named(same), "path", "video_id") == [("a", "V_ABCDEF"), ("b", "V_ABCDEF0011BB"), ("c", "V_ABCDEF09")]
    assert files.safe_relative("a\\b.jpg") == "a/b.jpg"
    for bad in ("../x", "/x", "C:/x", ""):
        with pytest.raises(ValueError):
            files.safe_relative(bad)


def test_scalars(spark):
    df = spark.createDataFrame([(1,)], "x int")
    one = lambda c: df.select(c.alias("c")).first()["c"]
    box = lambda *v: scalars.box(*[F.lit(float(x)) for x in v])
    assert one(scalars.box_iou(box(0, 0, 2, 2), box(1, 1, 3, 3))) == pytest.approx(1 / 7)
    assert one(scalars.box_iou(box(0, 0, 0, 0), box(0, 0, 0, 0))) == 0.0
    assert tuple(one(scalars.clamp_box(box(5.5, 5.5, 5.6, 5.6), F.lit(10), F.lit(10)))) == (5, 5, 6, 6)
    assert one(scalars.clamp(F.lit(None).cast("double"), 0, 1)) is None
    assert one(scores.colour_similarity(F.lit(None).cast("double"))) == 0.5
    points = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (2, 0), (2, 2), (0, 2))])
    assert one(scalars.polygon_area(points)) == 4.0 and one(scalars.polygon_area(F.slice(points, 1, 2))) is None
    assert one(text.sanitized(F.lit("..a b/c_"))) == "a_b_c" and one(text.sanitized(F.lit("__"))) == "item"
    assert one(text.track_id(F.lit("V"), F.lit("7"))) == "V_track_0007" and one(text.track_id(F.lit("V"), F.lit("x y"))) == "V_track_x_y"
    assert one(text.html_escaped(F.lit("<a&'\">"))) == "&lt;a&amp;&#x27;&quot;&gt;"
    assert one(vectors.is_valid(F.array(F.lit(float("inf"))))) is False
    with pytest.raises(Exception, match="vector of 1"):
        one(vectors.of_dimension(F.array(F.lit(1.0)), 2))


def test_options():
    assert config.extension_list("MP4, .mov,mp4") == (".mp4", ".mov")
    assert config.restored({"export": {"accept": 0.9, "odd": 1}}).export.accept == 0.9
    for bad in ({"export": {"accept": 0.1}}, {"crops": {"most_per_track": 0}}, {"clusters": {"method": "other"}}, {"limits": {"split_size": 1}}):
        with pytest.raises(ValueError):
            config.restored(bad)


def test_blocked_pairs_equal_all_pairs(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((50, 6))
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "id long, embedding array<float>")
    got = {(r[0], r[1]) for r in similarity.blocked_pairs(df, 0.3, block=16).collect()}
    u = v.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert got == {(i, j) for i, j in itertools.combinations(range(50), 2) if u[i] @ u[j] >= 0.3}
    grouped = df.withColumn("g", F.col("id") % 3)
    assert {(r["left_id"], r["right_id"]) for r in similarity.pairs(grouped, "g", 0.3).collect()} == {(i, j) for i, j in got if i % 3 == j % 3}


def partition_of(label):
    return {frozenset(np.flatnonzero(np.asarray(label) == x)) for x in set(label)}


@pytest.mark.parametrize("most", [0, 10_000])
def test_linkage_of_rows_equals_matrix(most):
    rng = np.random.default_rng(3)
    v = np.repeat(rng.standard_normal((20, 6)), 12, axis=0) + 0.4 * rng.standard_normal((240, 6))
    v = np.r_[v, np.tile(v[:5], (4, 1)), np.eye(6), np.zeros((1, 6))]
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    for threshold in (0.05, 0.3, 0.9):
        want = clusters.linkage(np.clip(1 - v @ v.T, 0, 2), threshold)
        got = clusters.linkage_of_rows(v, threshold, most=most)
        assert partition_of(got) == partition_of(want) and (got <= np.arange(len(v))).all()
        assert partition_of(clusters.linkage_of_rows(v, 1 - 0.75 * (1 - threshold) - 0.125, slope=0.75, offset=0.125, most=most)) == partition_of(want)


def test_average_link_of_large_components(spark, monkeypatch):
    """A component of any size is clustered, also where its links are too many to hold and its blocks return only what connects it."""
    rng = np.random.default_rng(9)
    v = np.r_[np.repeat(rng.standard_normal((40, 5)), 10, axis=0) + 0.3 * rng.standard_normal((400, 5)), np.tile(rng.standard_normal(5), (30, 1))]
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "id long, embedding array<double>").cache()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = partition_of(clusters.linkage(np.clip(1 - u @ u.T, 0, 2), 0.25))
    whole, blocks = clusters.MOST_LINKS, similarity.blocked_links
    for most, room in ((1, 1000), (whole, 1)):
        monkeypatch.setattr(clusters, "MOST_LINKS", most)
        monkeypatch.setattr(similarity, "blocked_links", lambda vectors, least, _, room=room: blocks(vectors, least, room, 220))
        got = {r["id"]: r["label"] for r in clusters.average_link(df, 0.25).collect()}
        assert partition_of([got[i] for i in range(len(v))]) == want
    monkeypatch.setattr(similarity, "blocked_links", blocks)
    assert not blocks(df, 0.75, 1, 220).filter("NOT whole").isEmpty() and blocks(df, 0.75, 10**6, 220).filter("NOT whole").isEmpty()


def test_statistics_by_blocks_equal_all_pairs(spark, monkeypatch):
    """Labels of one and of several blocks, also of copies and of broken vectors and colours: the figures of all pairs."""
    rng = np.random.default_rng(1)
    data = [(i, int(rng.choice([1, 1, 1, 2, 3, 4])), [float(y) for y in np.r_[rng.standard_normal(3), 1]], [float(y) for y in rng.random(2)] if i % 3 else None) for i in range(150)]
    data += [(200 + i, 5, [1.0, 2.0, 3.0, 4.0 + (i == 7) * 1e-7], [1.0, 0.5]) for i in range(60)]
    data += [(300, 1, None, [0.6, 0.8]), (301, 1, [1.0, float("nan"), 0.0, 1.0], [1.0, None]), (302, 2, [0.0] * 4, [1.0, float("nan")]), (303, 2, [1.0, 2.0], [1.0]), (304, 6, [1.0] * 4, None), (305, None, [1.0] * 4, None)]
    full = spark.createDataFrame(data, "id long, label long, embedding array<double>, colour array<double>").cache()
    limits = identity.Limits()
    monkeypatch.setattr(identity, "MOST_VALUES", 20)
    for members in (full, full.drop("colour")):
        own = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("combined") - 0.75 * F.col("reid")) / 0.25))
        want = identity.member_pairs(members, limits).groupBy("label").agg(F.avg("reid"), F.min("reid"), F.avg("combined"), F.min("combined"), F.percentile("combined", F.lit(0.1)), F.stddev_pop("combined"), F.avg(own))
        want = {r[0]: tuple(r)[1:] for r in want.collect()}
        got = {r[0]: tuple(r)[1:] for r in identity.pair_stats(members, limits, block=25).collect()}
        assert got.keys() == want.keys() == {1, 2, 3, 4, 5}
        for k in want:
            assert np.allclose(got[k], want[k], rtol=0, atol=1e-9), (k, got[k], want[k])


def test_plain_blocks_are_not_multiplied_pair_by_pair(spark, monkeypatch):
    """Vectors without colours take the way by sums and single precision, and near copies, whose deviation sums cannot tell, do not."""
    rng = np.random.default_rng(3)
    v = np.r_[rng.standard_normal((300, 8)), np.ones((80, 8)) + 1e-7 * rng.standard_normal((80, 8))]
    data = [(i, int(i >= 300), [float(y) for y in x]) for i, x in enumerate(v)]
    df = spark.createDataFrame(data, "id long, label long, embedding array<double>").cache()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    limits = identity.Limits()
    got = {r["label"]: r for r in identity.pair_stats(df, limits, block=40).collect()}
    for k, part in enumerate((u[:300], u[300:])):
        sims = np.clip((part @ part.T)[np.triu_indices(len(part), 1)], -1, 1)
        x = 0.75 * sims + 0.125
        want = [sims.mean(), sims.min(), x.mean(), x.min(), np.percentile(x, 10), x.std(), 0.5]
        assert np.allclose(tuple(got[k])[1:], want, rtol=0, atol=1e-9)
    monkeypatch.setattr(identity, "pair_strips", None)
    assert np.allclose(tuple(identity.pair_stats(df.filter("label = 0"), limits, block=40).first()), tuple(got[0]), rtol=0, atol=1e-9)


def test_pairs_where_blocks_stay_empty(spark):
    v = np.random.default_rng(2).standard_normal((9, 3))
    df = spark.createDataFrame([(i, 1, [float(y) for y in x]) for i, x in enumerate(v)], "id long, label long, embedding array<float>").coalesce(1).cache()
    assert rows(similarity.blocked_pairs(df.select("id", "embedding"), -1.0, block=1), "left_id", "right_id") == list(itertools.combinations(range(9), 2))
    got, want = identity.pair_stats(df, identity.Limits(), block=1).first(), identity.pair_stats(df, identity.Limits()).first()
    assert np.allclose(tuple(got), tuple(want), rtol=0, atol=1e-9)


def labelled(spark, folder):
    v = np.random.default_rng(4).standard_normal((90, 4))
    data = [(i, [float(y) for y in x], i % 2) for i, x in enumerate(v)]
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    u = v.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return [0.75 * (u[k::2] @ u[k::2].T)[np.triu_indices(45, 1)] + 0.125 for k in (0, 1)]


def test_summary_makes_no_rows_of_pairs(spark, tmp_path, monkeypatch):
    combined = labelled(spark, tmp_path)
    monkeypatch.setattr(identity, "member_pairs", None)
    out = {r["label"]: r for r in collection_queries.identity_summary(spark, str(tmp_path)).collect()}
    for k in (0, 1):
        got = [out[k]["identity_combined_" + x] for x in ("mean", "min", "p10", "std")]
        assert np.allclose(got, [combined[k].mean(), combined[k].min(), np.percentile(combined[k], 10), combined[k].std()], rtol=0, atol=1e-6)


def test_should_split_makes_no_rows_of_pairs(spark, tmp_path, monkeypatch):
    combined = labelled(spark, tmp_path)
    monkeypatch.setattr(identity, "member_pairs", None)
    want = {k: c.mean() < 0.12505 or c.min() < -0.3 or (np.percentile(c, 10) < 0.05 and c.std() > 0.09) for k, c in enumerate(combined)}
    assert {r["label"]: r["should_split"] for r in queries.should_split(spark, str(tmp_path)).collect()} == want


def test_should_split_of_plain_vectors_needs_no_strips(spark, tmp_path, monkeypatch):
    combined = labelled(spark, tmp_path)
    monkeypatch.setattr(identity, "pair_strips", None)
    monkeypatch.setattr(identity.pair_stats, "__defaults__", (20,))
    want = {k: c.mean() < 0.12505 or c.min() < -0.3 or (np.percentile(c, 10) < 0.05 and c.std() > 0.09) for k, c in enumerate(combined)}
    assert {r["label"]: r["should_split"] for r in queries.should_split(spark, str(tmp_path)).collect()} == want


def test_should_split_needs_no_percentile(spark, tmp_path, monkeypatch):
    """Values below the limit are counted; the percentile is searched for only where the limit lies between its two neighbours."""
    combined = labelled(spark, tmp_path)
    monkeypatch.setattr(identity, "pair_stats", None)
    want = {k: c.mean() < 0.12505 or c.min() < -0.3 or (np.percentile(c, 10) < 0.05 and c.std() > 0.09) for k, c in enumerate(combined)}
    assert {r["label"]: r["should_split"] for r in queries.should_split(spark, str(tmp_path)).collect()} == want


def test_flags_where_the_limit_lies_between_the_neighbours_of_p10(spark):
    v = np.random.default_rng(8).standard_normal((60, 3)) + 1
    members = spark.createDataFrame([(i, 1, [float(y) for y in x]) for i, x in enumerate(v)], "id long, label long, embedding array<double>").cache()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    x = np.sort(0.75 * (u @ u.T)[np.triu_indices(60, 1)] + 0.125)
    rank = int((len(x) - 1) * 0.1)
    gap = x[rank + 1] - x[rank]
    share = (len(x) - 1) * 0.1 - rank
    assert 0.1 < share < 0.95 and gap > 1e-9
    for at in (x[rank - 1], x[rank] + gap * (share - 0.05), x[rank] + gap * (share + 0.04), x[rank + 2]):
        limits = identity.Limits(split_mean=-1, split_colour=-1, split_p10=float(at), split_std=0.01, split_large_min=-2)
        assert identity.split_flags(members, limits, 25).first()["should_split"] == (np.percentile(x, 10) < at)


def test_flags_equal_those_of_statistics(spark):
    """Also with colours, broken vectors, copies, labels of one member, and least values at the limit."""
    rng = np.random.default_rng(1)
    data = [(i, int(rng.choice([1, 1, 1, 2, 3, 4])), [float(y) for y in np.r_[rng.standard_normal(3), 1]], [float(y) for y in rng.random(2)] if i % 3 else None) for i in range(250)]
    data += [(300 + i, 5, [1.0, 2.0, 3.0, 4.0 + (i == 7) * 1e-7], [1.0, 0.5]) for i in range(60)]
    data += [(400, 1, None, [0.6, 0.8]), (401, 2, [1.0, float("nan"), 0.0, 1.0], None), (402, 2, [0.0] * 4, [1.0, 0.0]), (403, 6, [1.0] * 4, None), (404, None, [1.0] * 4, None), (None, 6, [1.0] * 4, None)]
    full = spark.createDataFrame(data, "id long, label long, embedding array<double>, colour array<double>").cache()
    off = {"split_mean": -1, "split_colour": -1, "split_p10": -2, "split_large_min": -2}
    for members in (full, full.drop("colour")):
        known = {r["label"]: r for r in identity.stats(members, identity.Limits()).collect()}
        least, p10 = known[3]["combined_min"], known[4]["combined_p10"]
        for own, block in (({"split_large_min": least + 1e-9}, 20), ({"split_large_min": least - 1e-9, "split_colour": 0.52}, 20), ({"split_p10": p10 + 0.05, "split_std": 0.01}, 20), ({"split_p10": p10 + 0.05, "split_std": 0.01}, 8192)):
            limits = identity.Limits(**off | own)
            want = {k: r["size"] >= 8 and (r["combined_mean"] < limits.split_mean or r["color_mean"] < limits.split_colour or r["combined_p10"] < limits.split_p10 and r["combined_std"] > limits.split_std or r["size"] >= 24 and r["combined_min"] < limits.split_large_min) for k, r in known.items()}
            assert {r["label"]: r["should_split"] for r in identity.split_flags(members, limits, block).collect()} == want


def test_split_without_colours_makes_no_matrix(spark, monkeypatch):
    v = np.random.default_rng(6).standard_normal((60, 3))
    members = spark.createDataFrame([(i, 5, [float(y) for y in x]) for i, x in enumerate(v)], "id long, label long, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    label = clusters.linkage(1 - (0.75 * u @ u.T + 0.125), 0.4)
    monkeypatch.setattr(identity, "linkage", None)
    got = {r["id"]: r["label"] for r in identity.split(members, identity.Limits(split_distance=0.4)).collect()}
    assert got == {i: 5 if x == label[0] else x for i, x in enumerate(label)}
