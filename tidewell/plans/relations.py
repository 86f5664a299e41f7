"""Queries of joins, counts, runs and sets of names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import counts, measures, runs, sampling, similarity, stats, tasks, tracks
from tidewell.plans.adapters import view
from tidewell.plans.base import query, rounded
from tidewell.streaming import streams


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- paths and metadata ---------------------------------------------------------------------------------------------------

_PATHS = "SELECT o_custkey AS stem, concat(CASE o_orderkey % 3 WHEN 0 THEN 'MotionDet/' ELSE 'raw/' END, CAST(o_orderkey AS VARCHAR), '.mp4') AS path FROM orders"


@query(f"WITH p AS ({_PATHS}), r AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY contains(path, 'MotionDet') DESC, path) AS r FROM p) SELECT stem, path FROM r WHERE r = 1")
def preferred_paths(spark: SparkSession, d: str) -> DataFrame:
    folder = F.when(F.col("o_orderkey") % 3 == 0, "MotionDet/").otherwise("raw/")
    paths = _table(spark, d, "orders").select(F.col("o_custkey").alias("stem"), F.concat(folder, F.col("o_orderkey").cast("string"), F.lit(".mp4")).alias("path"))
    return tasks.prefer_path(paths, F.col("stem"), "path")


@query("""WITH a AS (SELECT stem, CAST(n_frames AS BIGINT) AS n_frames, 0 AS src FROM @videos v UNION ALL SELECT l_orderkey, CAST(l_linenumber + 100 AS BIGINT), 1 FROM lineitem WHERE l_returnflag = 'R'),
r AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY src DESC, n_frames DESC) AS r FROM a) SELECT stem, n_frames FROM r WHERE r = 1""")
def merged_metadata(spark: SparkSession, d: str) -> DataFrame:
    first = view(spark, d, "videos").select("stem", F.col("n_frames").cast("long").alias("n_frames"))
    later = _table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("stem"), (F.col("l_linenumber") + 100).cast("long").alias("n_frames"))
    return tasks.merge_metadata([first, later], "stem")


_TASKS = "t AS (SELECT stem, CAST(CASE WHEN stem % 7 = 0 THEN NULL WHEN stem % 11 = 0 THEN 0 ELSE n_frames END AS BIGINT) AS total_frames FROM @videos v)"


@query(f"""WITH {_TASKS} SELECT p_partkey AS stem, brand, total_frames, CASE WHEN t.stem IS NULL THEN 'missing' WHEN coalesce(total_frames, 0) <= 0 THEN 'total_frames_unavailable' END AS reason
FROM @conditions c LEFT JOIN t ON t.stem = p_partkey""")
def attached_tasks(spark: SparkSession, d: str) -> DataFrame:
    frames = F.when(F.col("stem") % 7 == 0, None).when(F.col("stem") % 11 == 0, 0).otherwise(F.col("n_frames")).cast("long")
    found = view(spark, d, "videos").select("stem", frames.alias("total_frames"))
    return tasks.attach_tasks(view(spark, d, "conditions").select(F.col("p_partkey").alias("stem"), "brand"), found, "stem")


@query("""WITH f AS (SELECT stem, n_frames FROM @videos v WHERE stem % 3 <> 0), a AS (SELECT l_orderkey AS stem, count(*) AS n_boxes FROM lineitem WHERE l_linenumber > 3 GROUP BY 1)
SELECT coalesce(f.stem, a.stem) AS stem, CAST(n_frames AS BIGINT) AS n_frames, n_boxes, CASE WHEN f.stem IS NULL THEN 'annotation' WHEN a.stem IS NULL THEN 'frame' ELSE 'both' END AS side FROM f FULL JOIN a ON f.stem = a.stem""")
def merged_items(spark: SparkSession, d: str) -> DataFrame:
    frames = view(spark, d, "videos").where("stem % 3 <> 0").select("stem", F.col("n_frames").cast("long").alias("n_frames"))
    notes = _table(spark, d, "lineitem").where("l_linenumber > 3").groupBy(F.col("l_orderkey").alias("stem")).agg(F.count("*").alias("n_boxes"))
    return tasks.merge_items(frames, notes, "stem")


@query("""SELECT relpath, max(doc_id % 3 = 0) AND max(doc_id % 2 = 0) AS conflict, CASE WHEN max(doc_id % 3 = 0) THEN 'positive' ELSE 'negative' END AS kind
FROM @manifest m WHERE doc_id % 3 = 0 OR doc_id % 2 = 0 GROUP BY relpath""")
def combined_labels(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest")
    side = lambda n, kind: m.where(F.col("doc_id") % n == 0).select("relpath").distinct().withColumn("kind", F.lit(kind))
    return tasks.combine_labels(side(3, "positive"), side(2, "negative"), "relpath")


_VIDEO = "regexp_extract(relpath, '^([^/]+)/', 1)"


@query(f"SELECT {_VIDEO} AS video, relpath FROM @manifest m WHERE {_VIDEO} IN (SELECT {_VIDEO} FROM @manifest m WHERE split = 'test' AND doc_id % 20 = 0)")
def selected_paths(spark: SparkSession, d: str) -> DataFrame:
    paths = view(spark, d, "manifest").withColumn("video", F.regexp_extract("relpath", "^([^/]+)/", 1))
    return counts.select_paths(paths, paths.where("split = 'test' AND doc_id % 20 = 0"), "video").select("video", "relpath")


@query("""WITH p(policy) AS (VALUES ('skip'), ('overwrite'), ('error')), x AS (SELECT stem, policy, stem IN (SELECT stem FROM @boxes b WHERE class_id = 1) AS there FROM @videos v, p)
SELECT stem, policy, CASE WHEN there AND policy = 'error' THEN 'exists' END AS error FROM x WHERE NOT (there AND policy = 'skip')""")
def collisions(spark: SparkSession, d: str) -> DataFrame:
    plan, there = view(spark, d, "videos").select("stem"), view(spark, d, "boxes").where("class_id = 1")
    skip, over, error = (runs.resolve_collisions(plan, there, "stem", p).withColumn("policy", F.lit(p)) for p in ("skip", "overwrite", "error"))
    return skip.unionByName(over).unionByName(error)


# --- tracks and frames ------------------------------------------------------------------------------------------------------


@query("WITH d AS (SELECT * FROM @detections d) SELECT a.clip, a.frame, a.cls, b.track FROM d a LEFT JOIN d b ON a.clip = b.clip AND a.frame = b.frame AND b.conf < 0.05")
def transcribed_tracks(spark: SparkSession, d: str) -> DataFrame:
    found = view(spark, d, "detections")
    return tracks.transcribe_track_ids(found.where("conf < 0.05"), found.select("clip", "frame", "cls"), "clip", "frame", "track")


_RUNS = "SELECT clip, track, dense_rank() OVER (PARTITION BY clip, track ORDER BY part) - 1 AS run FROM (SELECT DISTINCT clip, track, frame // 20 AS part FROM @detections d) t"


@query(f"""WITH r AS ({_RUNS}), m AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY CASE WHEN run > 0 THEN 0 ELSE 1 END, track, run) AS n, max(track) OVER (PARTITION BY clip) AS most FROM r)
SELECT clip, track, CAST(run AS BIGINT) AS run, CAST(CASE WHEN run > 0 THEN most + n ELSE track END AS BIGINT) AS instance_id FROM m""")
def instance_ids(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    parts = view(spark, d, "detections").select("clip", "track", F.floor(F.col("frame") / 20).alias("part")).distinct()
    run = (F.dense_rank().over(Window.partitionBy("clip", "track").orderBy("part")) - 1).cast("long")
    return tracks.unique_instance_ids(parts.select("clip", "track", run.alias("run")), "clip", "track", "run")


@query("""SELECT l_orderkey AS id, 'v' || CAST(l_orderkey AS VARCHAR) AS video, CAST(l_linenumber AS INT) AS frame, CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END AS class_id, round((l_quantity + 2.0) / 100, 6) AS xc,
round(5.0 / 50, 6) AS yc, round(4.0 / 100, 6) AS w, round(6.0 / 50, 6) AS h, 1.0::DOUBLE AS conf FROM lineitem WHERE l_returnflag IN ('A', 'N')""")
def keyframe_lines(spark: SparkSession, d: str) -> DataFrame:
    frame = F.struct(F.col("l_linenumber").cast("double").alias("frame"), F.col("l_quantity").cast("double").alias("x"), F.lit(2.0).alias("y"), F.lit(4.0).alias("width"), F.lit(6.0).alias("height"))
    boxes = _table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(frame).alias("sequence"))
    box = F.struct("sequence", F.array("l_returnflag").alias("labels"))
    flat = boxes.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(box).alias("box")).withColumn("video", F.concat(F.lit("v"), F.col("id").cast("string")))
    return rounded(tracks.keyframe_labels(flat, {"A": 0, "N": 1}, 100, 50), "xc", "yc", "w", "h", digits=6)


@query("SELECT class_id, count(DISTINCT (stem, frame)) AS n_frames FROM @boxes b GROUP BY 1")
def frames_per_label(spark: SparkSession, d: str) -> DataFrame:
    return tracks.frames_per_label(view(spark, d, "boxes"), "class_id", ["stem", "frame"])


@query("WITH c AS (SELECT DISTINCT event_type AS cls FROM events UNION ALL SELECT 'none') SELECT c.cls, count(DISTINCT (clip, track)) FILTER (clip IS NOT NULL) AS n FROM c LEFT JOIN (SELECT * FROM @detections d WHERE conf < 0.02) d ON d.cls = c.cls GROUP BY 1")
def tracks_per_class(spark: SparkSession, d: str) -> DataFrame:
    classes = _table(spark, d, "events").select(F.col("event_type").alias("cls")).distinct().union(spark.range(1).select(F.lit("none")))
    return counts.tracks_per_class(view(spark, d, "detections").where("conf < 0.02"), "cls", ["clip", "track"], classes)


@query("SELECT stem, class_id, count(*) AS n FROM @boxes b GROUP BY 1, 2")
def sequence_species(spark: SparkSession, d: str) -> DataFrame:
    return counts.seq_species_counts(view(spark, d, "boxes"), "stem", "class_id")


@query("SELECT user_id % 50 AS frame, event_id % 16 AS row_no, max(value) AS peak FROM events GROUP BY 1, 2")
def echogram(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select((F.col("user_id") % 50).alias("frame"), (F.col("event_id") % 16).alias("row_no"), "value")
    return stats.echogram(e, "frame", "row_no", "value")


@query("SELECT user_id AS camera, event_id % 20 AS frame, max(value) > 80 AS has_motion FROM events GROUP BY 1, 2")
def frame_motion(spark: SparkSession, d: str) -> DataFrame:
    contours = _table(spark, d, "events").select(F.col("user_id").alias("camera"), (F.col("event_id") % 20).alias("frame"), "value")
    return runs.frame_motion(contours, "camera", "frame", "value", 80)


@query('SELECT camera, CAST(frame // 10 AS INT) AS segment, CAST(min(frame) AS BIGINT) AS "start", CAST(max(frame) AS BIGINT) AS "end" FROM @motion m GROUP BY 1, 2')
def recording_segments(spark: SparkSession, d: str) -> DataFrame:
    frames = view(spark, d, "motion").withColumn("frame", F.col("frame").cast("long"))
    return runs.continuous_segments(frames, "camera", "frame", 2.0, 5)


@query("SELECT camera, CAST(frame AS BIGINT) AS frame FROM @motion m WHERE frame % 15 = 0")
def health_frames(spark: SparkSession, d: str) -> DataFrame:
    frames = view(spark, d, "motion").select("camera", F.col("frame").cast("long").alias("frame"))
    return streams.health_samples(frames, "frame", 3.0, 5)


@query("SELECT user_id AS event, count(*) AS n_parts, string_agg(event_type, ' ' ORDER BY event_id, event_type) AS clips FROM events GROUP BY 1")
def event_clips(spark: SparkSession, d: str) -> DataFrame:
    sidecars = _table(spark, d, "events").select(F.col("user_id").alias("event"), F.col("event_id").alias("part"), F.col("event_type").alias("clip"))
    return runs.event_clips(sidecars, "event", "part", "clip").withColumn("clips", F.array_join("clips", " "))


@query("""WITH o AS (SELECT DISTINCT l_orderkey AS frame, l_linenumber AS pos, CASE WHEN l_linenumber % 2 = 0 THEN 'noises' ELSE 'interested_objects' END AS kind FROM lineitem),
e AS (SELECT l_orderkey AS frame, l_linenumber AS pos, l_suppkey % 4 AS a, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC) AS r FROM lineitem WHERE l_suppkey % 4 < 3)
SELECT o.frame, CAST(o.pos AS INT) AS pos, CASE a WHEN 0 THEN 'noises' WHEN 1 THEN 'interested_objects' ELSE kind END AS kind FROM o LEFT JOIN e ON e.frame = o.frame AND e.pos = o.pos AND r = 1 WHERE coalesce(a, 9) <> 2""")
def marked_boxes(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("frame"), F.col("l_linenumber").cast("int").alias("pos"), (F.col("l_suppkey") % 4).alias("a"), F.struct("l_partkey", "l_suppkey").alias("edit_pos"))
    objects = rows.select("frame", "pos", F.when(F.col("pos") % 2 == 0, "noises").otherwise("interested_objects").alias("kind")).distinct()
    action = F.when(F.col("a") == 0, "noise").when(F.col("a") == 1, "object").otherwise("delete")
    return sampling.mark_boxes(objects, rows.where("a < 3").withColumn("action", action), "frame", "pos")


# --- counts and sets --------------------------------------------------------------------------------------------------------


@query("""WITH w AS (SELECT stem, CASE stem % 3 WHEN 0 THEN 'train' ELSE 'val' END AS wanted FROM @videos v WHERE stem % 5 <> 0),
a AS (SELECT stem, CASE WHEN stem % 4 = 0 THEN 'train' ELSE 'val' END AS actual FROM @videos v WHERE stem % 7 <> 0 UNION ALL SELECT stem, 'test' FROM @videos v WHERE stem % 8 = 0),
n AS (SELECT *, count(*) OVER (PARTITION BY stem) AS n FROM a)
SELECT coalesce(w.stem, n.stem) AS stem, wanted, actual, CASE WHEN w.stem IS NULL THEN 'extra' WHEN n.stem IS NULL THEN 'missing' WHEN n > 1 THEN 'duplicate' WHEN wanted = actual THEN 'ok' ELSE 'move' END AS status
FROM w FULL JOIN n ON w.stem = n.stem""")
def conformed_splits(spark: SparkSession, d: str) -> DataFrame:
    v = view(spark, d, "videos")
    wanted = v.where("stem % 5 <> 0").select("stem", F.when(F.col("stem") % 3 == 0, "train").otherwise("val").alias("split"))
    actual = v.where("stem % 7 <> 0").select("stem", F.when(F.col("stem") % 4 == 0, "train").otherwise("val").alias("split"))
    return counts.conform_splits(wanted, actual.union(v.where("stem % 8 = 0").select("stem", F.lit("test"))), "stem")


@query("SELECT l_returnflag AS key, count(*) AS n FROM lineitem GROUP BY 1")
def summed_distributions(spark: SparkSession, d: str) -> DataFrame:
    per = _table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    maps = per.groupBy("l_suppkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "n"))).alias("labels"))
    return counts.sum_distributions(maps, "labels")


@query("""WITH f AS (SELECT filename, max(CASE WHEN direction = 'l' AND species = 'A' THEN n END) AS la, max(CASE WHEN direction = 'r' AND species = 'A' THEN n END) AS ra,
max(CASE WHEN direction = 'l' AND species = 'N' THEN n END) AS ln, max(CASE WHEN direction = 'r' AND species = 'N' THEN n END) AS rn FROM @counts_gt g GROUP BY 1)
SELECT filename, direction, species, CAST(coalesce(n, 0) AS BIGINT) AS n FROM f, LATERAL (VALUES ('l', 'A', la), ('r', 'A', ra), ('l', 'N', ln), ('r', 'N', rn)) x(direction, species, n) WHERE filename % 5 > 1""")
def reviewed_counts(spark: SparkSession, d: str) -> DataFrame:
    pair = F.struct(F.concat_ws("_", F.lit("counts"), "direction", "species"), F.col("n").cast("string"))
    data = view(spark, d, "counts_gt").groupBy("filename").agg(F.map_from_entries(F.collect_list(pair)).alias("data"))
    result = F.when(F.col("filename") % 5 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("box")))
    notes = F.when(F.col("filename") % 5 > 0, F.array(F.struct(result.alias("result"))))
    return counts.reviewed_counts(data.withColumn("annotations", notes), "filename", "data", ["A", "N"])


@query("""WITH m AS (SELECT relpath, regexp_extract(relpath, '^([^/]+)/', 1) AS video, doc_id FROM @manifest m), t AS (SELECT count(*) AS n, count(DISTINCT video) AS s FROM m),
e AS (SELECT video, count(*) AS n_empty FROM m WHERE doc_id % 4 <> 0 GROUP BY 1) SELECT video, least(n_empty, n // 19 // s + 1) AS n FROM e, t""")
def empties_per_sequence(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest").withColumn("video", F.regexp_extract("relpath", "^([^/]+)/", 1))
    take = m.agg(sampling.empties_per_sequence(F.count("*"), F.countDistinct("video")).alias("take"))  # one row
    takes = m.select("video").distinct().join(F.broadcast(take))
    return sampling.sample_empty(m, m.where("doc_id % 4 = 0"), "relpath", "video", takes).groupBy("video").agg(F.count("*").alias("n"))


@query("SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_texts(spark: SparkSession, d: str) -> DataFrame:
    return similarity.duplicates(_table(spark, d, "documents").select(F.md5("text").alias("text_md5")), "text_md5")


@query("""SELECT event_id, CASE WHEN value >= 10 AND value < 60 THEN value END AS a, CASE WHEN b >= 10 AND b < 60 THEN b END AS b FROM (SELECT event_id, value, CAST(user_id % 150 AS DOUBLE) AS b FROM events) e
WHERE (value >= 10 AND value < 60) OR (b >= 10 AND b < 60)""")
def masked_outliers(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("event_id", F.col("value").alias("a"), (F.col("user_id") % 150).cast("double").alias("b"))
    return measures.mask_outliers(e, ["a", "b"], 10, 60)
