"""Registered queries of the identity operators, each with the SQL it is held against (or none, where SQL cannot say it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import scores, text
from ..functions import vectors as V
from ..operators import albums, catalog, clusters, conflicts, continuity, crops, identity, ranges, ranking, similarity, tracks
from ..operators.identity import Limits
from ..sources import files
from . import export
from . import standins as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

SIMILAR = 0.4
DISTANCE = 0.6
#: Limits under which the test vectors, which are nearly unrelated, fall on both sides of the rules.
LOOSE = Limits(split_mean=0.2, split_colour=0.4, split_p10=0.05, split_std=0.09, split_large_min=-0.3, least_consistency=0.2, least_colour=0.6, split_distance=0.72)


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


HOUR = "CAST((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 3600000000 AS BIGINT)"
FRAMES = f"frames AS (SELECT DISTINCT user_id AS video_id, event_type, {HOUR} AS frame_index, user_id || '_' || event_type AS track_id FROM events)"
BOXED = f"""{FRAMES}, corners AS (SELECT *, (frame_index * 37 + video_id * 11) % 1500 AS x1, (frame_index * 53 + video_id * 7) % 700 AS y1 FROM frames),
boxed AS (SELECT video_id, event_type, track_id, frame_index, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
  CAST(x1 + 60 + (frame_index * 17 + video_id) % 200 AS DOUBLE) AS x2, CAST(y1 + 100 + (frame_index * 29 + video_id * 3) % 380 AS DOUBLE) AS y2,
  ((frame_index * 13) % 60 + 40) / CAST(100 AS DOUBLE) AS confidence FROM corners)"""
SPANS = """spans AS (SELECT o_orderkey AS id, o_custkey AS video_id, s AS start_frame, e AS end_frame, n AS frame_count FROM orders JOIN
  (SELECT l_orderkey, min(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))) AS s, max(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))) AS e, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""
UNIT = """v0 AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS v FROM v0)"""
ALL_PAIRS = f"""{UNIT}, pairs AS (SELECT a.id AS left_id, b.id AS right_id, greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE), list_dot_product(a.v, b.v))) AS sim FROM v a JOIN v b ON a.id < b.id)"""
LABEL_PAIRS = f"""{UNIT}, pairs AS (SELECT a.label, a.id AS left_id, b.id AS right_id, greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE), list_dot_product(a.v, b.v))) AS sim FROM v a JOIN v b ON a.label = b.label AND a.id < b.id)"""


# Ranges and ranking


@query(f"""WITH {FRAMES}, runs AS (SELECT track_id, frame_index, frame_index - row_number() OVER (PARTITION BY track_id ORDER BY frame_index) AS g FROM frames)
SELECT track_id, min(frame_index) AS range_start, max(frame_index) AS range_end FROM runs GROUP BY track_id, g""")
def frame_range_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranges.compact(D.frames(spark, sf_dir), ["track_id"], "frame_index")
    return out.select("track_id", F.col("start").alias("range_start"), F.col("end").alias("range_end"))


@query(f"""WITH {SPANS}, days AS (SELECT DISTINCT video_id, unnest(generate_series(start_frame, end_frame)) AS d FROM spans),
runs AS (SELECT video_id, d, d - row_number() OVER (PARTITION BY video_id ORDER BY d) AS g FROM days)
SELECT video_id, min(d) AS range_start, max(d) AS range_end FROM runs GROUP BY video_id, g""")
def interval_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranges.merge(D.order_spans(spark, sf_dir), ["video_id"], "start_frame", "end_frame")
    return out.select("video_id", F.col("start").alias("range_start"), F.col("end").alias("range_end"))


def ranked(spark: SparkSession, sf_dir: str, videos: DataFrame) -> DataFrame:
    frames = D.frames(spark, sf_dir)
    per_track = frames.groupBy("track_id", "video_id").agg(F.count("*").alias("frame_count"))
    stored = ranges.compact(frames, ["track_id"], "frame_index").groupBy("track_id").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    members = per_track.select(F.concat(F.lit("G"), (F.col("video_id") % 7).cast("string")).alias("person_id"), "track_id")
    return ranking.rank_sources(members, per_track.join(stored, "track_id"), videos)


def user_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = D.table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id")).distinct()
    return users.select("video_id", F.lit(D.TOTAL).cast("long").alias("frame_count"), F.lit(None).cast("long").alias("processed_frame_count"), F.lit(None).cast("boolean").alias("analysis_complete"))


@query(f"""WITH {FRAMES}, seen AS (SELECT video_id, count(DISTINCT frame_index) AS visible_frames FROM frames GROUP BY 1)
SELECT 'G' || (video_id % 7) AS person_id, row_number() OVER (PARTITION BY video_id % 7 ORDER BY visible_frames DESC, video_id) AS rank, video_id, visible_frames,
  CAST(720 AS BIGINT) AS total_frames, round(100.0 * CAST(visible_frames AS DOUBLE) / 720, 6) AS appearance_percentage, 'valid' AS coverage_status FROM seen""")
def coverage_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranked(spark, sf_dir, user_videos(spark, sf_dir))
    return out.select("person_id", "rank", "video_id", "visible_frames", "total_frames", r6("appearance_percentage").alias("appearance_percentage"), "coverage_status")


def odd_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("video_id")
    base = user_videos(spark, sf_dir).filter(u % 10 != 9)
    return base.select(
        "video_id", F.when(u % 10 == 3, 0).when(u % 10 == 4, 10).otherwise(720 + u).cast("long").alias("frame_count"),
        F.when(u % 10 == 5, 720 + u).when(u % 10 == 6, 700).when(u % 10 == 7, 720).cast("long").alias("processed_frame_count"),
        F.when(u % 10 == 8, False).when((u % 10).isin(5, 6), True).alias("analysis_complete"),
    )


ODD = f"""WITH {FRAMES}, seen AS (SELECT video_id, count(DISTINCT frame_index) AS visible, max(frame_index) AS last FROM frames GROUP BY 1),
meta AS (SELECT *, video_id % 10 AS k FROM seen), totals AS (SELECT *,
  CASE WHEN k = 9 OR k IN (3, 7, 8) THEN NULL WHEN k = 4 THEN 10 WHEN k = 5 THEN 720 + video_id WHEN k = 6 THEN 700 ELSE 720 + video_id END AS total,
  CASE WHEN k = 9 THEN 'missing_video_metadata' WHEN k IN (7, 8) THEN 'incomplete_analysis' WHEN k = 3 THEN 'invalid_total_frames' WHEN k = 6 THEN 'frame_count_mismatch' ELSE 'valid' END AS s FROM meta),
final AS (SELECT *, CASE WHEN s = 'valid' AND last >= total THEN 'out_of_range_frames' ELSE s END AS status FROM totals)"""


@query(f"""{ODD} SELECT 'G' || (video_id % 7) AS person_id, row_number() OVER (PARTITION BY video_id % 7 ORDER BY (status = 'valid') DESC,
  CASE WHEN status = 'valid' THEN CAST(visible AS DOUBLE) / total END DESC NULLS LAST, CASE WHEN status = 'valid' THEN visible END DESC NULLS LAST, video_id) AS rank, video_id,
  visible AS visible_frames, CAST(total AS BIGINT) AS total_frames, CASE WHEN status = 'valid' THEN round(100.0 * CAST(visible AS DOUBLE) / total, 6) END AS appearance_percentage, status AS coverage_status FROM final""")
def coverage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranked(spark, sf_dir, odd_videos(spark, sf_dir))
    return out.select("person_id", "rank", "video_id", "visible_frames", "total_frames", r6("appearance_percentage").alias("appearance_percentage"), "coverage_status")


@query(f"""{ODD} SELECT 'G' || (video_id % 7) AS person_id, video_id, status AS reason FROM final WHERE status <> 'valid'""")
def unavailable_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.unavailable(ranked(spark, sf_dir, odd_videos(spark, sf_dir)))


@query(f"""WITH {FRAMES}, seen AS (SELECT video_id, count(DISTINCT frame_index) AS n FROM frames GROUP BY 1)
SELECT 'G' || (video_id % 7) AS person_id, string_agg(CAST(video_id AS VARCHAR), ',' ORDER BY n DESC, video_id) AS video_ids FROM seen GROUP BY video_id % 7""")
def ranking_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranking.ranking_columns(ranked(spark, sf_dir, user_videos(spark, sf_dir)))
    return out.select("person_id", F.array_join(F.col("video_ids").cast("array<string>"), ",").alias("video_ids"))


@query("""SELECT c_custkey AS video_id, coalesce(string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority), '') AS person_ids FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def video_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.table(spark, sf_dir, "orders")
    videos = D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("video_id"))
    members = orders.select(F.col("o_orderpriority").alias("person_id"), F.col("o_orderkey").alias("track_id"))
    out = ranking.video_index(videos, members, orders.select(F.col("o_orderkey").alias("track_id"), F.col("o_custkey").alias("video_id")))
    return out.select("video_id", F.array_join("person_ids", ",").alias("person_ids"))


# Tracks

STATS = f"""WITH {BOXED}, steps AS (SELECT *, (x1 + x2) * CAST(0.5 AS DOUBLE) AS cx, (y1 + y2) * CAST(0.5 AS DOUBLE) AS cy FROM boxed),
moves AS (SELECT *, cx - lag(cx) OVER w AS dx, cy - lag(cy) OVER w AS dy FROM steps WINDOW w AS (PARTITION BY track_id ORDER BY frame_index)),
stats AS (SELECT video_id, track_id, count(*) AS frame_count, min(frame_index) AS start_frame, max(frame_index) AS end_frame, avg(confidence) AS average_confidence, avg(y2 - y1) AS average_bbox_height,
  avg(least(CAST(1 AS DOUBLE), sqrt((x2 - x1) * (y2 - y1) / CAST(2073600 AS DOUBLE)) * 4)) AS average_bbox_size_score,
  avg(greatest(CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) - sqrt((cx - 960) ** 2 + (cy - 540) ** 2) / (sqrt(CAST(1920 * 1920 + 1080 * 1080 AS DOUBLE)) / 2))) AS center_position_score,
  coalesce(sum(sqrt(dx * dx + dy * dy)), CAST(0 AS DOUBLE)) / sqrt(CAST(1920 * 1920 + 1080 * 1080 AS DOUBLE)) AS raw_movement_score, (max(frame_index) - min(frame_index) + 1) / CAST(25 AS DOUBLE) AS duration_sec FROM moves GROUP BY 1, 2)"""
ACTIVE = f"""{STATS}, shares AS (SELECT *, raw_movement_score / nullif(max(raw_movement_score) OVER (PARTITION BY video_id), 0) AS m, duration_sec / max(duration_sec) OVER (PARTITION BY video_id) AS d FROM stats),
active AS (SELECT * EXCLUDE (m, d), coalesce(m, CAST(0 AS DOUBLE)) AS movement_score,
  CAST(0.35 AS DOUBLE) * d + CAST(0.3 AS DOUBLE) * coalesce(m, CAST(0 AS DOUBLE)) + CAST(0.2 AS DOUBLE) * average_bbox_size_score + CAST(0.15 AS DOUBLE) * center_position_score AS active_score FROM shares)"""


def made_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.track_stats(D.boxed_frames(spark, sf_dir), D.sizes(spark, sf_dir))


@query(f"""{STATS} SELECT track_id, frame_count, start_frame, end_frame, round(average_confidence, 6) AS average_confidence, round(average_bbox_height, 6) AS average_bbox_height,
round(average_bbox_size_score, 6) AS average_bbox_size_score, round(center_position_score, 6) AS center_position_score, round(raw_movement_score, 6) AS raw_movement_score, round(duration_sec, 6) AS duration_sec FROM stats""")
def track_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["average_confidence", "average_bbox_height", "average_bbox_size_score", "center_position_score", "raw_movement_score", "duration_sec"]
    return made_stats(spark, sf_dir).select("track_id", "frame_count", "start_frame", "end_frame", *[r6(n).alias(n) for n in names])


@query(f"{ACTIVE} SELECT track_id, round(movement_score, 6) AS movement_score, round(active_score, 6) AS active_score FROM active")
def active_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tracks.active_scores(made_stats(spark, sf_dir))
    return out.select("track_id", r6("movement_score").alias("movement_score"), r6("active_score").alias("active_score"))


ZONES = f"""{STATS}, moving AS (SELECT video_id, track_id, greatest(CAST(0.01 AS DOUBLE), raw_movement_score) * greatest(CAST(0.05 AS DOUBLE), average_bbox_size_score) AS w, greatest(1, frame_count // 20) AS stride
  FROM stats WHERE raw_movement_score >= 0.035 AND average_bbox_size_score >= 0.08),
pts AS (SELECT m.*, row_number() OVER (PARTITION BY track_id ORDER BY frame_index) - 1 AS n FROM steps m),
chosen AS (SELECT p.video_id, p.track_id, p.cx, p.cy, g.w FROM pts p JOIN moving g ON p.track_id = g.track_id WHERE p.n % g.stride = 0),
centres AS (SELECT video_id, sum(w * cx) / sum(w) AS mx, sum(w * cy) / sum(w) AS my, count(DISTINCT track_id) AS k FROM chosen GROUP BY 1 HAVING count(DISTINCT track_id) >= 2),
spreads AS (SELECT c.video_id, c.mx, c.my, greatest(greatest(sqrt(sum(w * (cx - mx) ** 2) / sum(w) + sum(w * (cy - my) ** 2) / sum(w)), sqrt(CAST(4852800 - 0 AS DOUBLE)) * CAST(0.18 AS DOUBLE)) * CAST(1.65 AS DOUBLE), sqrt(CAST(4852800 AS DOUBLE)) * CAST(0.16 AS DOUBLE)) AS scale
  FROM centres c JOIN chosen USING (video_id) GROUP BY 1, 2, 3),
away AS (SELECT p.track_id, avg(sqrt((cx - mx) ** 2 + (cy - my) ** 2)) AS a, any_value(scale) AS scale FROM steps p JOIN spreads USING (video_id) GROUP BY 1),
zones AS (SELECT s.*, CASE WHEN a IS NULL THEN center_position_score ELSE CAST(0.75 AS DOUBLE) * exp(-((a / scale) ** 2)) + CAST(0.25 AS DOUBLE) * center_position_score END AS activity_zone_score FROM stats s LEFT JOIN away USING (track_id))""".replace("4852800 - 0", "4852800")


@query(f"{ZONES} SELECT track_id, round(activity_zone_score, 6) AS activity_zone_score FROM zones")
def activity_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tracks.activity_zones(D.boxed_frames(spark, sf_dir), made_stats(spark, sf_dir), D.sizes(spark, sf_dir))
    return out.select("track_id", r6("activity_zone_score").alias("activity_zone_score"))


@query(f"""{ACTIVE}, reasons AS (SELECT track_id, concat_ws(',', CASE WHEN frame_count < 12 THEN 'too_short' END, CASE WHEN duration_sec < 25 THEN 'too_short_duration' END,
  CASE WHEN movement_score < 0.6 THEN 'low_movement' END, CASE WHEN average_bbox_height < 270 THEN 'too_small' END, CASE WHEN active_score < 0.2 THEN 'low_active_score' END) AS r FROM active)
SELECT track_id, nullif(r, '') AS ignored_reason, r = '' AS is_active FROM reasons""")
def track_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = tracks.filter_reasons(12, True, 25, 0.6, 270)
    return tracks.active_scores(made_stats(spark, sf_dir)).select("track_id", reason.alias("ignored_reason"), reason.isNull().alias("is_active"))


@query(f"""WITH {BOXED}, d AS (SELECT video_id, frame_index, row_number() OVER (PARTITION BY video_id, frame_index ORDER BY event_type) AS i, count(*) OVER (PARTITION BY video_id, frame_index) AS n, event_type, x1, confidence FROM boxed)
SELECT video_id, frame_index, event_type AS raw_track_id, x1, CASE WHEN i < n OR n = 1 THEN confidence ELSE CAST(1 AS DOUBLE) END AS confidence, 0 AS class_id FROM d""")
def detection_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("event_type", "bbox", "confidence")))
    made = D.boxed_frames(spark, sf_dir).groupBy("video_id", "frame_index").agg(rows.alias("r"))
    short = F.slice(F.col("r.confidence"), 1, F.greatest(F.lit(1), F.size("r") - 1))
    results = made.select("video_id", "frame_index", F.col("r.event_type").alias("ids"), F.col("r.bbox").alias("boxes"), short.alias("confidences"), F.array().cast("array<int>").alias("classes"))
    return tracks.detections(results).select("video_id", "frame_index", "raw_track_id", F.col("bbox.x1").alias("x1"), "confidence", "class_id")


# Boxes, polygons, crops

ITEMS = """items AS (SELECT l_orderkey, l_linenumber, (l_partkey % 1900) + CAST(0.25 AS DOUBLE) AS x1, (l_suppkey * 13 % 1000) + CAST(0.5 AS DOUBLE) AS y1, CAST(l_partkey % 1900 AS DOUBLE) + l_quantity * 4 AS x2,
  CAST(l_suppkey * 13 % 1000 AS DOUBLE) + l_quantity * 7 AS y2, 1 - l_tax AS confidence, CASE WHEN l_linenumber % 3 <> 0 THEN l_discount * 5 END AS mask, l_quantity * 9 AS blur FROM lineitem)"""
CLAMP = """greatest(0, least(1919, CAST(floor({x1}) AS BIGINT))) AS {p}x1, greatest(0, least(1079, CAST(floor({y1}) AS BIGINT))) AS {p}y1"""


@query(f"""WITH {ITEMS}, a AS (SELECT l_orderkey, l_linenumber, (x2 - x1) * (y2 - y1) AS area, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, {CLAMP.format(x1="x1", y1="y1", p="c")}, x2, y2,
  {CLAMP.format(x1="x1 - greatest(CAST(1 AS DOUBLE), x2 - x1) * CAST(0.08 AS DOUBLE)", y1="y1 - greatest(CAST(1 AS DOUBLE), y2 - y1) * CAST(0.08 AS DOUBLE)", p="p")},
  x2 + greatest(CAST(1 AS DOUBLE), x2 - x1) * CAST(0.08 AS DOUBLE) AS qx2, y2 + greatest(CAST(1 AS DOUBLE), y2 - y1) * CAST(0.08 AS DOUBLE) AS qy2 FROM items)
SELECT l_orderkey, l_linenumber, round(area, 6) AS area, round(cx, 6) AS cx, round(cy, 6) AS cy, CAST(cx1 AS BIGINT) AS cx1, CAST(cy1 AS BIGINT) AS cy1, CAST(greatest(cx1 + 1, least(1920, ceil(x2))) AS BIGINT) AS cx2, CAST(greatest(cy1 + 1, least(1080, ceil(y2))) AS BIGINT) AS cy2,
  CAST(px1 AS BIGINT) AS px1, CAST(py1 AS BIGINT) AS py1, CAST(greatest(px1 + 1, least(1920, ceil(qx2))) AS BIGINT) AS px2, CAST(greatest(py1 + 1, least(1080, ceil(qy2))) AS BIGINT) AS py2 FROM a""")
def bbox_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, w, h = F.col("bbox"), F.lit(1920).cast("long"), F.lit(1080).cast("long")
    centre, kept, padded = S.box_center(b), S.clamp_box(b, w, h), S.pad_box(b, 0.08, w, h)
    sides = [c[s].alias(p + s) for c, p in ((kept, "c"), (padded, "p")) for s in ("x1", "y1", "x2", "y2")]
    return D.item_boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", r6(S.box_area(b)).alias("area"), r6(centre["x"]).alias("cx"), r6(centre["y"]).alias("cy"), *sides)


@query(f"""WITH {ITEMS}, p AS (SELECT a.l_orderkey, a.l_linenumber, greatest(CAST(0 AS DOUBLE), least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(CAST(0 AS DOUBLE), least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i,
  (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS s FROM items a JOIN items b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber)
SELECT l_orderkey, l_linenumber, round(i / (s - i), 6) AS iou FROM p WHERE i > 0""")
def bbox_iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.item_boxes(spark, sf_dir)
    other = rows.select(F.col("l_orderkey").alias("_o"), F.col("l_linenumber").alias("_l"), F.col("bbox").alias("_b"))
    both = rows.join(other, (F.col("l_orderkey") == F.col("_o")) & (F.col("l_linenumber") < F.col("_l")))
    return both.select("l_orderkey", "l_linenumber", S.box_iou(F.col("bbox"), F.col("_b")).alias("iou")).filter("iou > 0").withColumn("iou", r6("iou"))


CROPS = f"""WITH {ITEMS}, a AS (SELECT *, x2 - x1 AS w, y2 - y1 AS h, CAST(x1 <= 28.8 AS INT) + CAST(y1 <= 16.2 AS INT) + CAST(x2 >= 1920 - 28.8 AS INT) + CAST(y2 >= 1080 - 16.2 AS INT) AS hits FROM items),
b AS (SELECT *, least(CAST(1 AS DOUBLE), h / (CAST(1080 AS DOUBLE) * CAST(0.35 AS DOUBLE))) AS size, least(CAST(1 AS DOUBLE), blur / CAST(250 AS DOUBLE)) AS sharp, h / greatest(CAST(1 AS DOUBLE), w) AS aspect,
  greatest(CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) - hits * CAST(0.22 AS DOUBLE)) AS edge, CASE WHEN mask IS NULL THEN CAST(1 AS DOUBLE) ELSE greatest(CAST(0.25 AS DOUBLE), least(CAST(1 AS DOUBLE), mask / CAST(0.35 AS DOUBLE))) END AS m FROM a),
c AS (SELECT *, CAST(CASE WHEN aspect BETWEEN 1.4 AND 4.2 THEN 1 WHEN aspect BETWEEN 1 AND 5.2 THEN 0.7 WHEN aspect BETWEEN 0.75 AND 6.5 THEN 0.4 ELSE 0.15 END AS DOUBLE) AS body FROM b),
d AS (SELECT *, CAST(0.42 AS DOUBLE) * body + CAST(0.24 AS DOUBLE) * edge + CAST(0.22 AS DOUBLE) * size + CAST(0.12 AS DOUBLE) * m AS shape FROM c),
scored AS (SELECT *, (CAST(0.3 AS DOUBLE) * size + CAST(0.25 AS DOUBLE) * sharp + CAST(0.2 AS DOUBLE) * shape + CAST(0.15 AS DOUBLE) * edge + CAST(0.1 AS DOUBLE) * confidence) * m AS score FROM d)"""


def scored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bbox")
    s = scores.crop_scores(S.box_height(b), S.box_width(b), b, F.lit(1920.0), F.lit(1080.0), F.col("confidence"), F.col("mask"), F.col("blur"))
    return D.item_boxes(spark, sf_dir).withColumns({k: v for k, v in s.items() if k not in ("confidence", "mask")} | {"area": S.box_area(b), "height": S.box_height(b)})


@query(f"""{CROPS} SELECT l_orderkey, l_linenumber, round(score, 6) AS score, round(shape, 6) AS person_shape, round(aspect, 6) AS aspect_ratio, hits / CAST(4 AS DOUBLE) AS edge_touch_ratio,
(mask IS NULL OR mask >= 0.12) AND h >= 100 AND w * h > 0 AND blur >= 110 AND shape >= 0.35 AND hits / 4.0 <= 0.75 AS valid FROM scored""")
def crop_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_items(spark, sf_dir)
    ok = scores.mask_passes(F.col("mask"), 0.12) & scores.crop_is_valid(F.col("height"), F.col("area"), F.col("blur"), F.col("person_shape"), F.col("edge_touch_ratio"), 100)
    return rows.select("l_orderkey", "l_linenumber", r6("score").alias("score"), r6("person_shape").alias("person_shape"), r6("aspect_ratio").alias("aspect_ratio"), "edge_touch_ratio", ok.alias("valid"))


@query(f"""{CROPS}, r AS (SELECT l_orderkey AS track_id, l_linenumber AS frame_index, round(score, 6) AS score, row_number() OVER (PARTITION BY l_orderkey ORDER BY round(score, 6) DESC, l_linenumber) AS rank FROM scored) SELECT * FROM r WHERE rank <= 3""")
def topk_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_items(spark, sf_dir).select(F.col("l_orderkey").alias("track_id"), F.col("l_linenumber").alias("frame_index"), r6("score").alias("score"))
    return crops.top(rows, 3)


@query()
def topk_near_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_items(spark, sf_dir).select(F.col("l_orderkey").alias("track_id"), F.col("l_linenumber").cast("long").alias("frame_index"), "score", "bbox")
    return crops.best(rows, 3).withColumn("score", r6("score"))


@query(f"""{CROPS} SELECT l_orderkey AS track_id, round(avg(score), 6) AS crop_quality_score, round(avg(shape), 6) AS crop_person_shape_score, round(avg(edge), 6) AS crop_edge_score, count(*) AS crop_count FROM scored GROUP BY 1""")
def crop_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = crops.summary(scored_items(spark, sf_dir).withColumnRenamed("l_orderkey", "track_id"))
    return out.select("track_id", *[r6(c).alias(c) for c in ("crop_quality_score", "crop_person_shape_score", "crop_edge_score")], "crop_count")


@query("""WITH p AS (SELECT l_orderkey, l_linenumber AS i, count(*) OVER (PARTITION BY l_orderkey) AS n, l_quantity AS x, CAST(l_suppkey % 97 AS DOUBLE) AS y, first_value(l_quantity) OVER w AS fx, first_value(CAST(l_suppkey % 97 AS DOUBLE)) OVER w AS fy,
  lead(l_quantity) OVER w AS nx, lead(CAST(l_suppkey % 97 AS DOUBLE)) OVER w AS ny FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_suppkey % 97))
SELECT l_orderkey, round(CASE WHEN any_value(n) >= 3 THEN abs(sum(x * coalesce(ny, fy) - coalesce(nx, fx) * y)) / 2 END, 4) AS area FROM p GROUP BY 1""")
def polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").alias("x"), (F.col("l_suppkey") % 97).cast("double").alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    rows = D.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(points.alias("points"))
    return rows.select("l_orderkey", F.round(S.polygon_area(F.col("points")), 4).alias("area"))


@query("""SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS kept FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS n FROM lineitem) WHERE n % 3 = 0 GROUP BY 1""")
def strided_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("a"))
    return rows.select("l_orderkey", F.array_join(S.every(F.col("a"), F.lit(3)).cast("array<string>"), ",").alias("kept"))


# Vectors and clusters


@query(f"WITH {LABEL_PAIRS} SELECT label, left_id, right_id, round(sim, 6) AS sim FROM pairs WHERE sim >= 0.25")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.pairs(D.vectors(spark, sf_dir), "label", 0.25).withColumn("sim", r6("sim"))


@query(f"WITH {ALL_PAIRS} SELECT left_id, right_id, round(sim, 6) AS sim FROM pairs WHERE sim >= {SIMILAR}")
def similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.blocked_pairs(D.vectors(spark, sf_dir), SIMILAR).withColumn("sim", r6("sim"))


@query(f"""WITH {UNIT}, c AS (SELECT *, id % 7 <> 0 AND id % 11 <> 0 AND id % 13 <> 0 AS valid FROM v)
SELECT id, valid, CASE WHEN valid THEN round(v[1], 6) END AS first, CASE WHEN valid THEN round(v[64], 6) END AS last FROM c""")
def vector_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some vectors are made zero, too short or not finite."""
    i, e = F.col("id"), F.col("embedding").cast("array<double>")
    broken = F.when(i % 7 == 0, F.transform(e, lambda x: x * 0)).when(i % 11 == 0, F.slice(e, 1, 63)).when(i % 13 == 0, F.transform(e, lambda x, n: F.when(n == 5, F.lit(float("nan"))).otherwise(x))).otherwise(e)
    out = similarity.checked(D.vectors(spark, sf_dir).withColumn("embedding", broken), 64)
    return out.select("id", "valid", r6(F.col("unit_embedding")[0]).alias("first"), r6(F.col("unit_embedding")[63]).alias("last"))


@query(f"""WITH {UNIT}, x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v), m AS (SELECT label, i, avg(x) AS x FROM x GROUP BY 1, 2)
SELECT label, i - 1 AS i, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) AS x FROM m""")
def mean_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similarity.mean_vectors(D.vectors(spark, sf_dir), "label")
    return out.select("label", F.posexplode("embedding").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), r6("x").alias("x"))


@query(f"""WITH {LABEL_PAIRS} SELECT label, round(avg(sim), 6) AS mean_sim, round(greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (avg(sim) - CAST(0.55 AS DOUBLE)) / CAST(0.4 AS DOUBLE))), 6) AS consistency FROM pairs GROUP BY 1""")
def embedding_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = D.vectors(spark, sf_dir)
    means = similarity.mean_pair_similarity(v, "label").select("label", r6("mean_sim").alias("mean_sim"))
    return means.join(similarity.embedding_consistency(v, "label").select("label", r6("consistency").alias("consistency")), "label")


@query(f"""WITH RECURSIVE {ALL_PAIRS}, near AS (SELECT left_id AS a, right_id AS b FROM pairs WHERE sim >= {SIMILAR} UNION SELECT right_id, left_id FROM pairs WHERE sim >= {SIMILAR}),
walk AS (SELECT id, id AS seen FROM v UNION SELECT w.id, n.b FROM walk w JOIN near n ON n.a = w.seen) SELECT id, min(seen) AS component FROM walk GROUP BY 1""")
def similarity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = D.vectors(spark, sf_dir)
    return clusters.components(similarity.blocked_pairs(v, SIMILAR), v.select("id"))


@query()
def average_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.average_link(D.vectors(spark, sf_dir), DISTANCE)


@query("""SELECT label, printf('P%04d', row_number() OVER (ORDER BY min(vec_id))) AS person_id FROM embeddings GROUP BY label""")
def player_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.numbered(D.vectors(spark, sf_dir).select("id", "label"))


@query("""SELECT label, min(vec_id) AS least, count(*) AS size, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY vec_id) AS members FROM embeddings GROUP BY label""")
def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = F.array_sort(F.collect_list("id"))
    out = D.vectors(spark, sf_dir).groupBy("label").agg(F.min("id").alias("least"), F.count("*").alias("size"), members.alias("m"))
    return out.select("label", "least", "size", F.array_join(F.col("m").cast("array<string>"), ",").alias("members"))


# Conflicts and identity


@query(f"""WITH {SPANS} SELECT a.id AS left_id, b.id AS right_id, a.video_id FROM spans a JOIN spans b ON a.video_id = b.video_id AND a.id < b.id AND greatest(a.start_frame, b.start_frame) <= least(a.end_frame, b.end_frame)""")
def cannot_link_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflicts.cannot_link(D.order_spans(spark, sf_dir))


@query(f"""WITH {SPANS} SELECT a.video_id * 3 + a.id % 3 AS label, count(*) AS n_conflicts, min(a.id) AS first_left, max(b.id) AS last_right FROM spans a JOIN spans b ON a.video_id = b.video_id AND a.id < b.id
AND a.id % 3 = b.id % 3 AND greatest(a.start_frame, b.start_frame) <= least(a.end_frame, b.end_frame) GROUP BY 1""")
def cluster_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = D.order_spans(spark, sf_dir)
    labels = spans.select("id", (F.col("video_id") * 3 + F.col("id") % 3).alias("label"))
    return conflicts.cluster_conflicts(spans, labels).groupBy("label").agg(F.count("*").alias("n_conflicts"), F.min("left_id").alias("first_left"), F.max("right_id").alias("last_right"))


@query()
def conflict_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = D.order_spans(spark, sf_dir)
    return conflicts.split(spans, spans.select("id", F.col("video_id").alias("label")))


IDENTITY = f"""WITH {LABEL_PAIRS}, c AS (SELECT *, CAST(0.75 AS DOUBLE) * sim + CAST(0.25 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS combined FROM pairs),
stats AS (SELECT label, avg(sim) AS reid_mean, min(sim) AS reid_min, avg(combined) AS combined_mean, min(combined) AS combined_min, quantile_cont(combined, 0.1) AS combined_p10, stddev_pop(combined) AS combined_std FROM c GROUP BY 1),
sized AS (SELECT label, count(*) AS size FROM v GROUP BY 1), joint AS (SELECT * FROM sized JOIN stats USING (label))"""


@query(f"""{IDENTITY} SELECT label, size, round(reid_mean, 6) AS reid_mean, round(reid_min, 6) AS reid_min, round(combined_mean, 6) AS combined_mean, round(combined_min, 6) AS combined_min, round(combined_p10, 6) AS combined_p10,
round(combined_std, 6) AS combined_std, CAST(0.5 AS DOUBLE) AS color_mean, round(greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (combined_mean - CAST(0.68 AS DOUBLE)) / CAST(0.22 AS DOUBLE))), 6) AS identity_consistency_score,
concat_ws(',', CASE WHEN combined_mean < 0.2 THEN 'weak_identity_consistency' END, 'outfit_color_diversity', CASE WHEN combined_min < -0.3 AND size >= 3 THEN 'low_min_pair_similarity' END) AS reasons FROM joint""")
def identity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["reid_mean", "reid_min", "combined_mean", "combined_min", "combined_p10", "combined_std", "color_mean", "identity_consistency_score"]
    return identity.stats(D.vectors(spark, sf_dir), LOOSE).select("label", "size", *[r6(n).alias(n) for n in names], F.array_join("reasons", ",").alias("reasons"))


@query(f"""{IDENTITY} SELECT label, size >= 8 AND (combined_mean < 0.12505 OR 0.5 < 0.4 OR (combined_p10 < 0.05 AND combined_std > 0.09) OR (size >= 24 AND combined_min < -0.3)) AS should_split FROM joint""")
def should_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dataclasses import replace

    limits = replace(LOOSE, split_mean=0.12505)
    return identity.split_flags(D.vectors(spark, sf_dir), limits)


@query()
def identity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.split(D.vectors(spark, sf_dir), LOOSE)


# Quality


def quality_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("video_id")
    stats = tracks.activity_zones(D.boxed_frames(spark, sf_dir), tracks.active_scores(made_stats(spark, sf_dir)), D.sizes(spark, sf_dir))
    made = {"crop_quality_score": (u * 7 % 100) / 100.0, "crop_person_shape_score": (u * 13 % 100) / 100.0, "crop_edge_score": (u * 29 % 100) / 100.0, "embedding_consistency_score": (u * 31 % 100) / 100.0, "crop_count": (u % 9).cast("long")}
    return stats.withColumns(made).withColumn("raw_movement_score", F.col("raw_movement_score") / 100)


TRACKS = f"""{ZONES}, moved AS (SELECT *, coalesce(raw_movement_score / nullif(max(raw_movement_score) OVER (PARTITION BY video_id), 0), CAST(0 AS DOUBLE)) AS movement_score FROM zones),
made AS (SELECT * REPLACE (raw_movement_score / 100 AS raw_movement_score), (video_id * 7 % 100) / CAST(100 AS DOUBLE) AS cq, (video_id * 13 % 100) / CAST(100 AS DOUBLE) AS sh, (video_id * 29 % 100) / CAST(100 AS DOUBLE) AS ed,
  (video_id * 31 % 100) / CAST(100 AS DOUBLE) AS em, video_id % 9 AS cc FROM moved),
terms AS (SELECT *, least(CAST(1 AS DOUBLE), CAST(0.65 AS DOUBLE) * least(CAST(1 AS DOUBLE), raw_movement_score / CAST(0.18 AS DOUBLE)) + CAST(0.35 AS DOUBLE) * movement_score) AS motion,
  raw_movement_score < 0.025 AND duration_sec >= 1 AS f1, sh < 0.45 OR ed < 0.55 AS f2, cc < 2 AS f3, em < 0.45 AS f4 FROM made),
quality AS (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), CAST(0.25 AS DOUBLE) * cq + CAST(0.18 AS DOUBLE) * sh + CAST(0.17 AS DOUBLE) * motion + CAST(0.12 AS DOUBLE) * least(CAST(1 AS DOUBLE), duration_sec / 2)
  + CAST(0.1 AS DOUBLE) * average_bbox_size_score + CAST(0.08 AS DOUBLE) * activity_zone_score + CAST(0.06 AS DOUBLE) * em + CAST(0.04 AS DOUBLE) * least(CAST(1 AS DOUBLE), cc / CAST(6 AS DOUBLE))
  - CASE WHEN f1 THEN CAST(0.16 AS DOUBLE) ELSE 0 END - CASE WHEN f2 THEN CAST(0.1 AS DOUBLE) ELSE 0 END - CASE WHEN f3 THEN CAST(0.04 AS DOUBLE) ELSE 0 END - CASE WHEN f4 THEN CAST(0.08 AS DOUBLE) ELSE 0 END)) AS quality,
  concat_ws(',', CASE WHEN f1 THEN 'static_track' END, CASE WHEN f2 THEN 'partial_or_edge_crop' END, CASE WHEN f3 THEN 'low_crop_count' END, CASE WHEN f4 THEN 'inconsistent_track_embedding' END) AS reasons FROM terms)"""


def album_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.frames(spark, sf_dir).select("track_id", (F.col("video_id") % 20).alias("n")).distinct().select(F.format_string("P%04d", F.col("n") + 1).alias("person_id"), "track_id")


@query(f"{TRACKS} SELECT track_id, round(quality, 6) AS quality, round(motion, 6) AS motion, reasons FROM quality")
def track_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = albums.scored_tracks(album_members(spark, sf_dir), quality_tracks(spark, sf_dir))
    return out.select("track_id", r6("quality").alias("quality"), r6("motion").alias("motion"), F.array_join("reasons", ",").alias("reasons"))


ALBUMS = f"""{TRACKS}, g AS (SELECT video_id % 20 AS k, count(*) AS size, avg(quality) AS aq, max(quality) AS bq, avg(motion) AS am, avg(activity_zone_score) AS aa, avg(CAST(f1 AS INT)) AS s1, avg(CAST(f2 AS INT)) AS s2, avg(CAST(f3 AS INT)) AS s3 FROM quality GROUP BY 1),
h AS (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (CAST(0.7 AS DOUBLE) + k / CAST(50 AS DOUBLE) - CAST(0.76 AS DOUBLE)) / CAST(0.2 AS DOUBLE))) AS cc FROM g),
p AS (SELECT *, k % 5 = 0 AS clash, size >= 8 AND cc < 0.7 AS w1 FROM h),
s AS (SELECT *, CAST(0.45 AS DOUBLE) * aq + CAST(0.18 AS DOUBLE) * bq + CAST(0.17 AS DOUBLE) * cc + CAST(0.12 AS DOUBLE) * am + CAST(0.08 AS DOUBLE) * aa
  - CASE WHEN clash THEN CAST(0.22 AS DOUBLE) ELSE 0 END - CASE WHEN s1 >= 0.45 THEN CAST(0.18 AS DOUBLE) ELSE 0 END - CASE WHEN s2 >= 0.35 THEN CAST(0.1 AS DOUBLE) ELSE 0 END - CASE WHEN s3 >= 0.5 THEN CAST(0.06 AS DOUBLE) ELSE 0 END
  - CASE WHEN size >= 35 AND am < 0.42 THEN CAST(0.18 AS DOUBLE) ELSE 0 END - CASE WHEN cc < 0.45 THEN CAST(0.1 AS DOUBLE) ELSE 0 END
  - CASE WHEN w1 THEN CAST(0.16 AS DOUBLE) WHEN size >= 16 AND cc < 0.78 THEN CAST(0.1 AS DOUBLE) ELSE 0 END AS raw FROM p),
albums AS (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), raw)) AS score FROM s)"""


def made_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = album_members(spark, sf_dir)
    number = F.substring("person_id", 2, 9).cast("long") - 1
    people = members.select("person_id").distinct()
    mean = people.select("person_id", (F.lit(0.7) + number / 50.0).alias("mean_sim"))
    return albums.album_quality(members, quality_tracks(spark, sf_dir), mean, people.filter(number % 5 == 0), accept=0.5, review=0.3)


@query(f"""{ALBUMS} SELECT printf('P%04d', k + 1) AS person_id, size, round(score, 6) AS album_quality_score, CASE WHEN score >= 0.5 THEN 'accepted' WHEN score >= 0.3 THEN 'review' ELSE 'rejected' END AS export_status,
concat_ws(',', CASE WHEN size >= 35 AND am < 0.42 THEN 'large_low_motion_cluster' END, CASE WHEN s3 >= 0.5 THEN 'low_crop_count' END, CASE WHEN am < 0.3 THEN 'low_motion' END, CASE WHEN aq < 0.52 THEN 'low_track_quality' END,
  CASE WHEN s2 >= 0.35 THEN 'partial_or_edge_crops' END, CASE WHEN clash THEN 'same_video_conflict' END, CASE WHEN s1 >= 0.45 THEN 'static_tracks' END, CASE WHEN cc < 0.45 THEN 'weak_cluster_consistency' END,
  CASE WHEN w1 OR (size >= 16 AND cc < 0.78) THEN 'weak_identity_consistency' END) AS quality_reasons FROM albums""")
def album_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made_albums(spark, sf_dir).select("person_id", "size", r6("album_quality_score").alias("album_quality_score"), "export_status", F.array_join("quality_reasons", ",").alias("quality_reasons"))


@query(f"""{ALBUMS} SELECT count(*) FILTER (WHERE score >= 0.5) AS accepted, count(*) FILTER (WHERE score >= 0.3 AND score < 0.5) AS review, count(*) FILTER (WHERE score < 0.3) AS rejected, count(*) AS total FROM albums""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return albums.status_counts(made_albums(spark, sf_dir))


@query(f"""{ALBUMS}, m AS (SELECT DISTINCT video_id % 20 AS k, track_id FROM frames), l AS (SELECT k, string_agg('<h3>' || track_id || '</h3><img src="' || track_id || '/1.jpg">', '' ORDER BY track_id) AS body FROM m GROUP BY 1)
SELECT printf('P%04d', k + 1) AS person_id, '<section><h2>' || printf('P%04d', k + 1) || '</h2><p>' || CASE WHEN score >= 0.5 THEN 'accepted' WHEN score >= 0.3 THEN 'review' ELSE 'rejected' END || ' ' || printf('%.3f', score) || '</p>' || body || '</section>' AS html FROM albums JOIN l USING (k)""")
def gallery_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = album_members(spark, sf_dir).withColumn("paths", F.array(F.concat("track_id", F.lit("/1.jpg"))))
    return export.gallery(made_albums(spark, sf_dir), paths, everything=True)


# Continuity


def previous_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of an earlier revision: by id modulo 12, of the ids not divisible by 5."""
    return D.vectors(spark, sf_dir).filter(F.col("id") % 5 != 0).select(F.format_string("P%04d", F.col("id") % 12 + 1).alias("person_id"), F.col("id").alias("track_id"))


@query("""SELECT label, string_agg(DISTINCT printf('P%04d', vec_id % 12 + 1), ',' ORDER BY printf('P%04d', vec_id % 12 + 1)) AS previous_ids FROM embeddings WHERE vec_id % 5 <> 0 GROUP BY 1""")
def id_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = D.vectors(spark, sf_dir).select(F.col("id").alias("track_id"), "label")
    return continuity.lineage(labels, previous_groups(spark, sf_dir)).select("label", F.array_join("previous_ids", ",").alias("previous_ids"))


@query("""SELECT label, printf('P%04d', vec_id % 12 + 1) AS person_id, count(*) AS shared FROM embeddings WHERE vec_id % 5 <> 0 GROUP BY 1, 2""")
def id_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = D.vectors(spark, sf_dir).select(F.col("id").alias("track_id"), "label")
    return continuity.overlaps(labels, previous_groups(spark, sf_dir)).select("label", "person_id", "shared")


@query()
def id_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = D.vectors(spark, sf_dir).select(F.col("id").alias("track_id"), "label")
    return continuity.reconcile(labels, previous_groups(spark, sf_dir), 20)


@query("""SELECT DISTINCT 'P' || o_custkey AS person_id FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 1)""")
def retired_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = D.table(spark, sf_dir, "orders").select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("person_id"), (F.col("o_orderkey") % 2).alias("k"))
    return continuity.retired(people.filter("k = 0"), people.filter("k = 1"))


# Collection


@query("""SELECT sha256, min_by(doc_id, printf('%012d', doc_id)) AS doc_id FROM (SELECT doc_id, sha256(text) AS sha256, source FROM documents) WHERE source NOT IN ('src1', 'src2') AND sha256 NOT IN (SELECT sha256(text) FROM documents WHERE source IN ('src1', 'src2') AND text IS NOT NULL) GROUP BY 1""")
def discover_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = hashed_documents(spark, sf_dir)
    new = files.discover(docs.filter(~F.col("source").isin("src1", "src2")), docs.filter(F.col("source").isin("src1", "src2")).withColumnRenamed("path", "video_id"))
    return new.select("sha256", "doc_id")


def hashed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = D.table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", "source", F.format_string("%012d", "doc_id").alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.sha1(F.col("text").cast("binary")).alias("sha1"))


@query("""SELECT a.doc_id, b.doc_id AS video_id, b.doc_id % 2 = 0 AS active FROM documents a JOIN documents b ON sha256(a.text) = sha256(b.text) WHERE a.source NOT IN ('src1', 'src2') AND b.source IN ('src1', 'src2')""")
def registered_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = hashed_documents(spark, sf_dir)
    known = docs.filter(F.col("source").isin("src1", "src2")).select("sha256", F.col("doc_id").alias("video_id"), (F.col("doc_id") % 2 == 0).alias("active"))
    incoming = docs.filter(~F.col("source").isin("src1", "src2")).select(F.col("doc_id").alias("path"), "sha256")
    return files.duplicates(incoming, known).withColumnRenamed("path", "doc_id")


@query("""WITH h AS (SELECT doc_id, upper(sha1(text)) AS d, printf('%012d', doc_id) AS p FROM documents WHERE text IS NOT NULL), f AS (SELECT d, min(p) AS p FROM h GROUP BY 1),
r AS (SELECT d, row_number() OVER (PARTITION BY left(d, 6) ORDER BY p, d) AS r6, row_number() OVER (PARTITION BY left(d, 8) ORDER BY p, d) AS r8 FROM f)
SELECT doc_id, 'V_' || CASE WHEN r6 = 1 THEN left(d, 6) WHEN r8 = 1 THEN left(d, 8) ELSE left(d, 10) END AS video_id FROM h JOIN r USING (d)""")
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.named(hashed_documents(spark, sf_dir)).select("doc_id", "video_id")


def vector_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.vectors(spark, sf_dir).select(F.col("id").alias("track_id"), F.col("label").alias("video_id"), F.col("id").alias("cache_row"))


@query("""SELECT vec_id AS track_id, vec_id AS cache_row, row_number() OVER (ORDER BY vec_id) - 1 AS active_row FROM embeddings WHERE label % 3 <> 0""")
def active_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = vector_records(spark, sf_dir)
    membership = records.select("video_id").distinct().withColumn("active", F.col("video_id") % 3 != 0)
    return catalog.active_view(records, membership).select("track_id", "cache_row", "active_row")


@query("""SELECT vec_id AS track_id, CASE WHEN label < 5 THEN vec_id ELSE (SELECT max(vec_id) FROM embeddings WHERE label < 5) + row_number() OVER (PARTITION BY label < 5 ORDER BY vec_id) END AS cache_row FROM embeddings""")
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = vector_records(spark, sf_dir)
    old, new = records.filter("video_id < 5"), records.filter("video_id >= 5").drop("cache_row")
    return catalog.appended(old, new, "track_id").select("track_id", "cache_row")


STATE = """t AS (SELECT vec_id AS id, label, vec_id % 4 AS crops, CASE WHEN vec_id % 3 = 0 THEN vec_id END AS r, CASE vec_id % 6 WHEN 1 THEN 'retryable_error' WHEN 2 THEN 'blocked_error' END AS old FROM embeddings)"""


def made_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    v = D.vectors(spark, sf_dir)
    i = F.col("id")
    t = v.select(i.alias("track_id"), F.col("label").alias("video_id"), (i % 4).alias("crop_count"))
    records = v.filter(i % 3 == 0).select(i.alias("track_id"), i.alias("embedding_row"))
    old = v.filter((i % 6).isin(1, 2)).select(i.alias("track_id"), F.when(i % 6 == 1, "retryable_error").otherwise("blocked_error").alias("status"), F.lit(2).alias("attempt_count"), F.lit("reid").alias("failed_stage"), F.lit("e").alias("last_error"))
    return t, records, catalog.track_states(t, records, old)


@query(f"""WITH {STATE} SELECT id AS track_id, CASE WHEN r IS NOT NULL THEN 'complete' WHEN crops = 0 THEN 'no_usable_crops' ELSE coalesce(old, 'pending') END AS status, CASE WHEN old IS NULL THEN 0 ELSE 2 END AS attempt_count,
CASE WHEN r IS NULL AND old IS NOT NULL THEN 'e' END AS last_error, r AS embedding_row FROM t""")
def track_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made_states(spark, sf_dir)[2].select("track_id", "status", "attempt_count", "last_error", "embedding_row")


@query(f"""WITH {STATE} SELECT id AS track_id, CASE WHEN old IS NULL THEN 1 ELSE 3 END AS next_attempt FROM t WHERE r IS NULL AND crops > 0 AND coalesce(old, 'pending') IN ('pending', 'retryable_error') AND label % 2 = 0""")
def retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, _, states = made_states(spark, sf_dir)
    membership = t.select("video_id").distinct().withColumn("active", F.col("video_id") % 2 == 0)
    return catalog.retry_queue(states, t, membership).select("track_id", "next_attempt")


@query(f"""WITH {STATE} SELECT id AS track_id FROM t WHERE (id % 7 = 0) <> (r IS NOT NULL) OR (id % 7 <> 0 AND crops = 0)""")
def state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, records, states = made_states(spark, sf_dir)
    claimed = states.withColumn("status", F.when(F.col("track_id") % 7 == 0, "complete").otherwise("pending"))
    return catalog.invalid_states(claimed, t, records)


@query("""SELECT l_orderkey AS track_id, CASE WHEN count(*) FILTER (WHERE l_linestatus = 'O') > 0 THEN 'complete' WHEN bool_and(l_returnflag = 'A') THEN 'blocked_error' ELSE 'retryable_error' END AS status FROM lineitem GROUP BY 1""")
def embedding_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("l_linestatus") != "O", F.when(F.col("l_returnflag") == "A", "blocked").otherwise("retryable"))
    return catalog.outcome(D.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("track_id"), error.alias("error")))


@query("""SELECT o_custkey AS key, 'left' AS side FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') UNION ALL
SELECT o_custkey, 'right' FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def membership_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.table(spark, sf_dir, "orders")
    side = lambda s: orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("key"))
    return catalog.set_difference(side("F"), side("O"))


@query("""SELECT label, count(*) AS n, count(DISTINCT vec_id // 10) AS distinct_rows, min(vec_id // 10) AS low, max(vec_id // 10) AS high FROM embeddings GROUP BY 1 HAVING count(DISTINCT vec_id // 10) <> count(*) OR min(vec_id // 10) <> 0 OR max(vec_id // 10) <> count(*) - 1""")
def permutation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.vectors(spark, sf_dir).withColumn("row", F.floor(F.col("id") / 10))
    out = rows.groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("row").alias("distinct_rows"), F.min("row").alias("low"), F.max("row").alias("high"))
    return out.filter("distinct_rows <> n OR low <> 0 OR high <> n - 1")


@query("""SELECT a.o_orderkey AS key FROM orders a JOIN (SELECT l_orderkey, min(l_linestatus) AS s FROM lineitem GROUP BY 1) b ON a.o_orderkey = b.l_orderkey WHERE a.o_orderstatus IS DISTINCT FROM b.s""")
def attribute_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = D.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("s"))
    right = D.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.min("l_linestatus").alias("s"))
    return catalog.differing(left, right, "key", ["s"])


@query("""SELECT DISTINCT 'P' || o_custkey AS person_id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""")
def affected_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = D.table(spark, sf_dir, "orders").select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("person_id"), F.col("o_orderkey").alias("track_id"))
    hit = D.table(spark, sf_dir, "lineitem").filter("l_quantity >= 49").select(F.col("l_orderkey").alias("track_id"))
    return catalog.affected_groups(groups, hit)


@query("""SELECT l_partkey AS track_id FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) GROUP BY 1 HAVING count(*) > 1""")
def shared_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.shared_members(D.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("track_id"), F.col("l_suppkey").alias("person_id")).distinct())


@query("""SELECT l_suppkey AS video_id, l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) AS active FROM (SELECT DISTINCT l_suppkey FROM lineitem)""")
def exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    membership = D.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("video_id")).distinct().withColumn("active", F.lit(True))
    asked = D.table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("video_id")).join(membership, "video_id", "left_semi")
    return catalog.excluded(membership, asked)


# Identifiers and text


@query("""SELECT c_custkey, 'V' || c_nationkey || '_track_' || printf('%04d', c_custkey) AS track_id, 'V' || c_nationkey || '_track_' || c_mktsegment AS named_id, printf('P%04d', c_custkey) AS person_id, CAST(c_custkey AS BIGINT) AS number FROM customer""")
def id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    video = F.concat(F.lit("V"), F.col("c_nationkey").cast("string"))
    person = text.person_id(F.col("c_custkey"))
    return D.table(spark, sf_dir, "customer").select("c_custkey", text.track_id(video, F.col("c_custkey")).alias("track_id"), text.track_id(video, F.col("c_mktsegment")).alias("named_id"), person.alias("person_id"), text.person_number(person).alias("number"))


@query("""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'item') AS name,
replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped FROM pages""")
def sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "pages").select("page_id", text.sanitized(F.col("url")).alias("name"), text.html_escaped(F.col("url")).alias("escaped"))


@query("""SELECT event_type, printf('%.1fs', sum(value)) AS total, count(*) AS events FROM events GROUP BY 1""")
def timing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "events").groupBy("event_type").agg(text.seconds(F.sum("value")).alias("total"), F.count("*").alias("events"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS flag FROM orders""")
def truth_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("o_orderstatus") == "F", " Yes").when(F.col("o_orderstatus") == "O", "OFF").otherwise("maybe")
    return D.table(spark, sf_dir, "orders").select("o_orderkey", text.truth(word).alias("flag"))


@query("""SELECT o_custkey AS person_id, min_by(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS crop FROM orders GROUP BY 1""")
def representative_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("position"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("crop"))
    return crops.representative(rows)


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row per key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).filter("_n = 1").drop("_n")


def unit_length(v: Column) -> Column:
    return V.norm(V.unit(v))
