"""The named queries of the library with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import boxes as B
from tidewell.functions import names as N
from tidewell.functions import scalars as S
from tidewell.operators import balance, counts, measures, runs, sampling, similarity, stats, tasks, tracks
from tidewell.plans import base, curation, expressions, files, relations, streaming  # noqa: F401 (they register their queries)
from tidewell.plans.adapters import view
from tidewell.plans.base import Query, query
from tidewell.plans.base import rounded as _round
from tidewell.session import materialize


def queries() -> dict[str, Query]:
    return base.QUERIES | streaming.QUERIES


def oracle_sql() -> dict[str, str]:
    return base.SQL | streaming.SQL


# --- tracks and boxes ---------------------------------------------------------------------------------------------------

_INTERPOLATE = """
WITH seg AS (
  SELECT *, lead(frame) OVER w AS f1, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(w) OVER w AS w1, lead(h) OVER w AS h1
  FROM @keyframes k WINDOW w AS (PARTITION BY stem, track ORDER BY frame, kf_pos)
), every AS (
  SELECT stem, track, frame, x, y, w, h, true AS keyframe FROM seg
  UNION ALL
  SELECT stem, track, f, x + (x1 - x) * (f - frame) / (f1 - frame), y + (y1 - y) * (f - frame) / (f1 - frame),
         w + (w1 - w) * (f - frame) / (f1 - frame), h + (h1 - h) * (f - frame) / (f1 - frame), false
  FROM (SELECT *, unnest(range(frame + 1, f1)) AS f FROM seg WHERE enabled AND f1 > frame + 1) t
)
SELECT stem, track, CAST(frame AS INT) AS frame, round(x, 4) + 0.0 AS x, round(y, 4) + 0.0 AS y, round(w, 4) + 0.0 AS w, round(h, 4) + 0.0 AS h, keyframe FROM every"""


@query(_INTERPOLATE)
def interpolate_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _round(tracks.interpolate_tracks(view(spark, d, "keyframes"), ["stem", "track"]), "x", "y", "w", "h")


@query(_INTERPOLATE + " WHERE frame % 3 = 1")
def interpolate_strided(spark: SparkSession, d: str) -> DataFrame:
    return _round(tracks.interpolate_tracks(view(spark, d, "keyframes"), ["stem", "track"], stride=3, offset=1), "x", "y", "w", "h")


@query("""
WITH k AS (SELECT *, CASE WHEN greatest(x, y, w, h) <= 1.0000001 THEN 1.0 WHEN greatest(x, y, w, h) <= 100.0000001 THEN 100.0 END AS one FROM @keyframes t),
s AS (SELECT *, coalesce(one, 1280.0) AS sx, coalesce(one, 720.0) AS sy FROM k)
SELECT stem, track, frame, kf_pos, round(least(greatest((x + w / 2) / sx, 0.0), 1.0), 4) + 0.0 AS xc, round(least(greatest((y + h / 2) / sy, 0.0), 1.0), 4) + 0.0 AS yc,
       round(least(greatest(w / sx, 0.0), 1.0), 4) + 0.0 AS w, round(least(greatest(h / sy, 0.0), 1.0), 4) + 0.0 AS h FROM s""")
def center_boxes(spark: SparkSession, d: str) -> DataFrame:
    k = view(spark, d, "keyframes").withColumn("c", B.to_center(*[F.col(c) for c in ("x", "y", "w", "h")], F.lit(1280), F.lit(720)))
    return _round(k.select("stem", "track", "frame", "kf_pos", "c.*"), "xc", "yc", "w", "h")


_CROP = """
WITH c AS (
  SELECT *, least(greatest(xc - w / 2, 0.0), 1.0) AS x1, least(greatest(xc + w / 2, 0.0), 1.0) AS x2, least(greatest(yc - h / 2, 0.0), 1.0) AS y1,
         least(greatest(yc + h / 2, 0.0), 1.0) AS y2 FROM @norm_boxes b
), v AS (
  SELECT *, greatest(x2 - x1, 0.0) * greatest(y2 - y1, 0.0) AS area, least(y2, 0.5) AS c2 FROM c
), k AS (
  SELECT *, area > 0 AND c2 > y1 AND (x2 - x1) * (c2 - y1) / CASE WHEN area > 0 THEN area END >= 0.05 AND x2 > x1 AS kept FROM v
)"""


@query(_CROP + """
SELECT stem, frame, a, b, round((x1 + x2) / 2, 4) + 0.0 AS xc, round((y1 / 0.5 + c2 / 0.5) / 2, 4) + 0.0 AS yc, round(x2 - x1, 4) + 0.0 AS w,
       round(c2 / 0.5 - y1 / 0.5, 4) + 0.0 AS h FROM k WHERE kept""")
def crop_boxes(spark: SparkSession, d: str) -> DataFrame:
    df = stats.crop_boxes(view(spark, d, "norm_boxes"), "xc", "yc", "w", "h").where("crop_xc is not null")
    return _round(df.select("stem", "frame", "a", "b", *[F.col(f"crop_{c}").alias(c) for c in ("xc", "yc", "w", "h")]), "xc", "yc", "w", "h")


@query(_CROP + """
SELECT flag, count(*) AS boxes_before, count(*) FILTER (kept) AS boxes_after, count(*) FILTER (NOT coalesce(kept, false)) AS dropped FROM k GROUP BY flag""")
def crop_summary(spark: SparkSession, d: str) -> DataFrame:
    return stats.crop_summary(view(spark, d, "norm_boxes"), "xc", "yc", "w", "h", ["flag"])


_BINS = """
CASE WHEN w <= 0 OR h <= 0 THEN 'invalid' WHEN w / h < 0.67 THEN 'tall' WHEN w / h <= 1.5 THEN 'square' ELSE 'wide' END"""
_AREA = """
CASE WHEN w * h <= 0 THEN '0' WHEN w * h < 0.0025 THEN '<0.0025' WHEN w * h < 0.01 THEN '0.0025-0.01' WHEN w * h < 0.04 THEN '0.01-0.04' WHEN w * h < 0.16 THEN '0.04-0.16' ELSE '>=0.16' END"""


@query(f"SELECT site, {_BINS} AS ar_bin, {_AREA} AS area_bin, count(*) AS n FROM @boxes b GROUP BY 1, 2, 3")
def box_bins(spark: SparkSession, d: str) -> DataFrame:
    return stats.box_bins(view(spark, d, "boxes"), "w", "h", ["site"])


# --- statistics ---------------------------------------------------------------------------------------------------------


@query("""
WITH s AS (SELECT site, class_id, count(*) AS n_boxes, count(DISTINCT (stem, frame)) AS n_frames FROM @boxes b GROUP BY 1, 2)
SELECT site, class_id, n_boxes, n_frames, round(100.0 * n_boxes / sum(n_boxes) OVER (PARTITION BY class_id), 6) AS pct_of_class,
       round(100.0 * n_boxes / sum(n_boxes) OVER (PARTITION BY site), 6) AS pct_of_site, round(100.0 * n_boxes / sum(n_boxes) OVER (), 6) AS pct_of_all FROM s""")
def site_class_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.site_class_stats(view(spark, d, "boxes"), "site", "class_id", ["stem", "frame"])


@query("""
WITH c AS (SELECT site, class_id, count(*) AS n FROM @boxes b WHERE class_id <> 3 OR site = '1-URGENT' GROUP BY 1, 2)
SELECT s.site, k.class_id, coalesce(c.n, 0) AS n_boxes FROM (SELECT DISTINCT site FROM c) s CROSS JOIN (SELECT DISTINCT class_id FROM c) k
LEFT JOIN c ON c.site = s.site AND c.class_id = k.class_id""")
def site_class_grid(spark: SparkSession, d: str) -> DataFrame:
    return stats.site_class_grid(view(spark, d, "boxes").where("class_id <> 3 OR site = '1-URGENT'"), "site", "class_id")


@query("""
SELECT site, count(DISTINCT CASE WHEN frame % 2 = 1 THEN (stem, frame) END) AS n_frames, count(*) FILTER (frame % 2 = 1) AS n_boxes,
       count(DISTINCT stem) AS n_videos FROM @boxes b GROUP BY 1""")
def site_totals(spark: SparkSession, d: str) -> DataFrame:
    return stats.site_totals(view(spark, d, "boxes"), "site", "stem", "frame", 2, 1)


@query("SELECT class_id, count(*) AS n_boxes, count(DISTINCT (stem, frame)) AS n_frames, count(DISTINCT site) AS n_sites FROM @boxes b GROUP BY 1")
def class_totals(spark: SparkSession, d: str) -> DataFrame:
    return stats.class_totals(view(spark, d, "boxes"), "class_id", "site", ["stem", "frame"])


@query("SELECT site, count(DISTINCT stem) AS n_videos, count(DISTINCT (stem, frame)) AS n_frames, count(*) AS n_boxes FROM @boxes b GROUP BY 1")
def group_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_stats(view(spark, d, "boxes"), "site", "stem", "frame")


@query(f"""
SELECT site, 'class' AS feature, CAST(class_id AS STRING) AS key, count(*) AS cnt FROM @boxes b GROUP BY 1, 3
UNION ALL SELECT site, 'area', {_AREA}, count(*) FROM @boxes b GROUP BY 1, 3
UNION ALL SELECT site, 'ar', {_BINS}, count(*) FROM @boxes b GROUP BY 1, 3
UNION ALL SELECT site, 'density', CASE WHEN n <= 2 THEN CAST(n AS STRING) WHEN n <= 4 THEN '3-4' WHEN n <= 9 THEN '5-9' ELSE '10+' END, count(*)
FROM (SELECT site, stem, frame, count(*) AS n FROM @boxes b GROUP BY 1, 2, 3) f GROUP BY 1, 3""")
def group_hist(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_hist(view(spark, d, "boxes"), "site", "stem", "frame", "class_id", "w", "h")


@query("""
WITH c AS (SELECT site, class_id, count(*) AS n FROM @boxes b GROUP BY 1, 2),
p AS (SELECT class_id, sum(n) / sum(sum(n)) OVER () AS p FROM c GROUP BY 1)
SELECT site, round(sum(n / greatest(p, 1e-6)) + 0.25 * sum(n), 4) AS rarity FROM c JOIN p USING (class_id) GROUP BY 1""")
def rarity(spark: SparkSession, d: str) -> DataFrame:
    return _round(stats.rarity(stats.group_hist(view(spark, d, "boxes"), "site", "stem", "frame", "class_id", "w", "h"), "site"), "rarity")


_LONG = """WITH l AS (
  SELECT 'brand' AS col, brand AS val FROM @conditions c UNION ALL SELECT 'size', size FROM @conditions c UNION ALL SELECT 'kind', kind FROM @conditions c
), n AS (SELECT col, val, count(*) AS n FROM l WHERE val IS NOT NULL GROUP BY 1, 2)"""


@query(_LONG + " SELECT col, val, n, min(n) OVER (PARTITION BY col) AS target FROM n")
def condition_targets(spark: SparkSession, d: str) -> DataFrame:
    return stats.condition_targets(view(spark, d, "conditions"), ["brand", "size", "kind"])


@query(_LONG + " SELECT col, count(*) AS n_values FROM n GROUP BY 1 HAVING count(*) >= 2")
def active_columns(spark: SparkSession, d: str) -> DataFrame:
    return stats.active_columns(view(spark, d, "conditions"), ["brand", "size", "kind"])


@query("""SELECT class_id, count(*) FILTER (site = '1-URGENT') AS "1-URGENT", count(*) FILTER (site = '2-HIGH') AS "2-HIGH" FROM @boxes b GROUP BY 1""")
def class_pivot(spark: SparkSession, d: str) -> DataFrame:
    n = view(spark, d, "boxes").groupBy("class_id", "site").agg(F.count("*").alias("n"))
    return stats.class_pivot(n, "class_id", "site", "n", ["1-URGENT", "2-HIGH"])


@query("""
WITH a AS (SELECT site, class_id, count(*) AS n FROM @boxes b GROUP BY 1, 2), p AS (SELECT site, class_id, n / sum(n) OVER (PARTITION BY site) AS p FROM a),
x AS (SELECT class_id, p FROM p WHERE site = '1-URGENT'), y AS (SELECT class_id, p FROM p WHERE site = '2-HIGH')
SELECT 'class' AS feature, round(sum(abs(coalesce(x.p, 0) - coalesce(y.p, 0))), 6) AS l1 FROM x FULL JOIN y USING (class_id)""")
def split_distance(spark: SparkSession, d: str) -> DataFrame:
    boxes = view(spark, d, "boxes")
    of = lambda site: stats.global_targets(boxes.where(F.col("site") == site).groupBy(F.lit("class").alias("feature"), F.col("class_id").alias("key")).agg(F.count("*").alias("cnt")))
    return _round(stats.l1_distance(of("1-URGENT"), of("2-HIGH")), "l1", digits=6)


# --- tasks and names ----------------------------------------------------------------------------------------------------


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id) AS r FROM events) t WHERE r = 1")
def latest_per_task(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("day", F.date_trunc("day", "ts"))
    return tasks.latest_annotation(e, "user_id", "day", "event_id").select("user_id", "event_id", "value")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, event_id DESC) AS r FROM events) t WHERE r = 1")
def dedupe_last(spark: SparkSession, d: str) -> DataFrame:
    return tasks.dedupe_last(spark.read.parquet(f"{d}/events.parquet"), "user_id", ["event_type", "event_id"]).select("user_id", "event_id", "event_type")


@query(r"""
WITH p AS (SELECT s_suppkey, stem, regexp_extract(stem, '^(.+?)_(\d{8})_(\d{6})_(.+)$', 1) AS pre FROM @stems s)
SELECT s_suppkey, string_split(pre, '-')[1] AS org, string_split(pre, '-')[2] AS site, array_to_string(string_split(pre, '-')[3:], '-') AS device,
       regexp_extract(stem, '^(.+?)_(\d{8})_(\d{6})_(.+)$', 2) AS date, regexp_extract(stem, '^(.+?)_(\d{8})_(\d{6})_(.+)$', 3) AS time FROM p""")
def parse_stems(spark: SparkSession, d: str) -> DataFrame:
    s = view(spark, d, "stems").withColumn("p", N.parse_stem(F.col("stem")))
    return s.select("s_suppkey", "p.org", "p.site", "p.device", "p.date", "p.time")


@query(r"""
WITH p AS (SELECT s_suppkey, stem, string_split(regexp_extract(stem, '^(.+?)_(\d{8})_(\d{6})_(.+)$', 1), '-') AS q FROM @stems s)
SELECT s_suppkey, concat(q[1], '/', q[2], '/', array_to_string(q[3:], '-'), '/motion_vids/', stem, '.mp4') AS video_key, concat(q[1], '/', q[2], '/', array_to_string(q[3:], '-'), '/labelstudio_tasks/', stem, '.json') AS task_key FROM p""")
def storage_keys(spark: SparkSession, d: str) -> DataFrame:
    p = N.parse_stem(F.col("stem"))
    return view(spark, d, "stems").select("s_suppkey", N.video_key(p["org"], p["site"], p["device"], F.col("stem")).alias("video_key"), N.task_key(p["org"], p["site"], p["device"], F.col("stem")).alias("task_key"))


@query("""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'bad' WHEN p_partkey % 4 = 1 THEN concat(p_size * 1000, '/1001') WHEN p_partkey % 4 = 2 THEN concat(p_size, '/0') ELSE concat(p_size, '.5') END AS t FROM part)
SELECT p_partkey, round(coalesce(CASE WHEN contains(t, '/') THEN try_cast(split_part(t, '/', 1) AS DOUBLE) / nullif(try_cast(split_part(t, '/', 2) AS DOUBLE), 0) ELSE try_cast(t AS DOUBLE) END, 0.0), 6) AS rate FROM r""")
def parse_rates(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    text = F.when(k == 0, "bad").when(k == 1, F.concat((size * 1000).cast("string"), F.lit("/1001"))).when(k == 2, F.concat(size.cast("string"), F.lit("/0"))).otherwise(F.concat(size.cast("string"), F.lit(".5")))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.round(S.parse_rate(text), 6).alias("rate"))


@query("""
WITH n AS (SELECT o_orderkey, o_orderkey % 3 AS k, o_orderdate AS t FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN 'dashed' WHEN 1 THEN 'motion' ELSE 'indexed' END AS family, CASE k WHEN 0 THEN 'upper-weir' END AS site,
       CASE k WHEN 0 THEN 'camera-7' END AS device, CAST(epoch(CASE k WHEN 0 THEN date_trunc('day', t) + INTERVAL 21 HOUR + INTERVAL 27 SECOND
       WHEN 1 THEN date_trunc('day', t) + INTERVAL 5 HOUR ELSE date_trunc('day', t) END) AS BIGINT) AS recorded, CASE WHEN k = 2 THEN CAST(o_orderkey % 1000 AS INT) END AS idx FROM n""")
def parse_clip_names(spark: SparkSession, d: str) -> DataFrame:
    t, k = F.col("o_orderdate"), F.col("o_orderkey") % 3
    name = (
        F.when(k == 0, F.concat(F.lit("DFO-Upper Weir-07-"), F.date_format(t, "yyyy-MM-dd"), F.lit("_21.00.27.mp4")))
        .when(k == 1, F.concat(F.date_format(t, "dd-MM-yyyy"), F.lit(" 5 M upper box.m4v")))
        .otherwise(F.concat(F.lit("SodaFL-"), F.date_format(t, "MMdd"), F.date_format(t, "yy"), F.lit("-"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"), F.lit(".avi")))
    )
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", N.parse_clip_name(name).alias("c"), F.year("o_orderdate").alias("y"))
    late = F.when((F.col("c.family") == "indexed") & (F.col("y") < 2000), F.add_months("c.recorded_at", -1200).cast("timestamp")).otherwise(F.col("c.recorded_at"))  # two-digit years are of this century
    return o.select("o_orderkey", "c.family", "c.site", "c.device", F.unix_timestamp(late).alias("recorded"), F.col("c.index").alias("idx"))


_CRC32 = """WITH RECURSIVE bits AS (
  SELECT i, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, step + 1 FROM bits WHERE step < 8
), crc AS (
  SELECT s_suppkey, stem, CAST(4294967295 AS BIGINT) AS c, 0 AS i FROM @stems s
  UNION ALL SELECT s_suppkey, stem, xor(c // 256, b.v), crc.i + 1 FROM crc JOIN bits b ON b.step = 8 AND b.i = xor(c % 256, CAST(ascii(substr(stem, crc.i + 1, 1)) AS BIGINT)) WHERE crc.i < length(stem)
)"""


@query(_CRC32 + " SELECT s_suppkey, xor(c, 4294967295) % 7 AS first_frame FROM crc WHERE i = length(stem)")
def stride_hash(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "stems").select("s_suppkey", S.stride_offset(F.col("stem"), 7, "video_hash").alias("first_frame"))


@query("SELECT split, regexp_extract(relpath, '^([^/]+)/', 1) AS video_stem, count(DISTINCT doc_id) AS n_frames, min(doc_id) AS first_frame FROM @manifest m GROUP BY 1, 2")
def split_requests(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest").withColumn("p", N.parse_manifest_relpath(F.col("relpath"))).select("split", "p.*").where("error is null")
    r = tasks.split_requests(m, "split", "video_stem", "frame_idx")
    return r.select("split", "video_stem", F.size("frames").cast("long").alias("n_frames"), F.get("frames", 0).cast("long").alias("first_frame"))


@query("""
SELECT stem, f AS frame FROM (SELECT stem, unnest(range(1, n_frames, 3)) AS f FROM @videos v) t
WHERE NOT EXISTS (SELECT 1 FROM @positives p WHERE p.stem = t.stem AND p.frame = t.f)""")
def eligible_negatives(spark: SparkSession, d: str) -> DataFrame:
    return tasks.eligible_negatives(view(spark, d, "videos"), view(spark, d, "positives"), "stem", "n_frames", "frame", 3, "fixed", 1)


@query("""
WITH r AS (SELECT split, regexp_extract(relpath, '^([^/]+)/', 1) AS v, doc_id FROM @manifest m),
b AS (SELECT *, CAST(substr(v, 4) AS INT) AS k FROM r), e AS (SELECT *, max(CASE WHEN k % 9 = 0 OR k % 7 = 0 OR doc_id % 50 = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY v) AS bad FROM b)
SELECT split, count(DISTINCT v) AS videos_seen, count(DISTINCT CASE WHEN bad = 1 THEN v END) AS videos_failed, count(*) AS frames_requested,
       count(*) FILTER (bad = 0) AS frames_planned FROM e GROUP BY 1""")
def pack_summary(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest").withColumn("p", N.parse_manifest_relpath(F.col("relpath"))).select("split", "p.video_stem", "p.frame_idx")
    k = F.substring("video_stem", 4, 9).cast("int")
    meta = m.select("video_stem").distinct().where(k % 9 != 0).select("video_stem", F.when(k % 7 == 0, 0.0).otherwise(10.0).alias("fps"), F.lit("key").alias("video_key"))
    labels = m.where("frame_idx % 50 <> 3").select("video_stem", "frame_idx", F.lit("").alias("label_text"))
    return tasks.pack_summary(tasks.pack_plan(m, meta, labels, "video_stem", "frame_idx"), "split", "video_stem")


# --- counting -----------------------------------------------------------------------------------------------------------

_VOTE = """v AS (SELECT clip, track, cls, count(*) AS n, min(frame) AS f FROM @detections d GROUP BY 1, 2, 3),
best AS (SELECT clip, track, cls, n FROM (SELECT *, row_number() OVER (PARTITION BY clip, track ORDER BY n DESC, f) AS r FROM v) t WHERE r = 1)"""
_CROSS = """c AS (SELECT clip, track, arg_min(x, frame) AS first_x, arg_max(x, frame) AS last_x FROM @detections d GROUP BY 1, 2),
x AS (SELECT *, CASE WHEN first_x < 50 AND last_x >= 50 THEN 'r' WHEN first_x > 50 AND last_x <= 50 THEN 'l' END AS direction FROM c)"""


def _crossings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    det = view(spark, d, "detections")
    return det, tracks.line_crossings(det, ["clip", "track"], ["frame"], "x", 50.0), tracks.vote_class(det, ["clip", "track"], ["frame"])


@query(f"WITH {_VOTE} SELECT clip, track, cls, CAST(n AS DOUBLE) AS weight FROM best")
def class_vote(spark: SparkSession, d: str) -> DataFrame:
    return tracks.vote_class(view(spark, d, "detections"), ["clip", "track"], ["frame"])


@query(f"WITH {_CROSS} SELECT clip, track, first_x, last_x, direction FROM x")
def line_crossings(spark: SparkSession, d: str) -> DataFrame:
    return _crossings(spark, d)[1]


@query(f"""WITH {_VOTE}, {_CROSS}, h AS (SELECT x.clip, direction, cls AS species, count(*) AS n FROM x JOIN best USING (clip, track) WHERE direction IS NOT NULL GROUP BY 1, 2, 3)
SELECT * FROM h UNION ALL SELECT DISTINCT clip, NULL, NULL, 0 FROM @detections d WHERE clip NOT IN (SELECT clip FROM h)""")
def clip_counts(spark: SparkSession, d: str) -> DataFrame:
    det, crossings, votes = _crossings(spark, d)
    return tracks.clip_counts(crossings, votes, det, "clip", "track")


@query("SELECT species, CAST(sum(CASE WHEN direction = 'l' THEN n ELSE -n END) AS BIGINT) AS net FROM @counts_gt g WHERE regexp_matches(CAST(filename AS STRING), '1') GROUP BY 1")
def net_upstream(spark: SparkSession, d: str) -> DataFrame:
    return counts.net_upstream(view(spark, d, "counts_gt"), "filename", "l", "1")


@query("""
WITH g AS (SELECT * FROM @counts_gt g WHERE filename IN (SELECT filename FROM @counts_pred p)), p AS (SELECT * FROM @counts_pred p),
a AS (SELECT coalesce(g.species, p.species) AS species, coalesce(g.n, 0) AS gt, coalesce(p.n, 0) AS pred FROM g FULL JOIN p ON g.filename = p.filename AND g.direction = p.direction AND g.species = p.species)
SELECT species, CAST(sum(abs(pred - gt)) AS BIGINT) AS abs_error, CAST(sum(gt) AS BIGINT) AS gt, round(sum(abs(pred - gt)) / sum(gt), 6) AS nmae FROM a GROUP BY 1""")
def nmae(spark: SparkSession, d: str) -> DataFrame:
    return _round(counts.nmae(view(spark, d, "counts_gt"), view(spark, d, "counts_pred"), "filename"), "nmae", digits=6)


@query("""
WITH g AS (SELECT filename, sum(n) AS v FROM @counts_gt g GROUP BY 1), p AS (SELECT filename, sum(n) AS v FROM @counts_pred p GROUP BY 1),
s AS (SELECT (SELECT count(*) FROM g) AS n1, (SELECT avg(v) FROM g) AS m1, (SELECT var_samp(v) FROM g) AS v1, (SELECT count(*) FROM p) AS n2, (SELECT avg(v) FROM p) AS m2, (SELECT var_samp(v) FROM p) AS v2),
q AS (SELECT *, sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS sd FROM s)
SELECT round(m1, 4) AS mean_gt, round(m2, 4) AS mean_pred, round(sd, 4) AS pooled_sd, round(sd * sqrt(1.0 / n1 + 1.0 / n2), 4) AS std_error,
       round((m2 - m1) / (sd * sqrt(1.0 / n1 + 1.0 / n2)), 4) AS t FROM q""")
def t_test(spark: SparkSession, d: str) -> DataFrame:
    out = counts.t_test(view(spark, d, "counts_gt"), view(spark, d, "counts_pred"), "filename")
    return _round(out, *out.columns)


@query("""SELECT filename, CAST(coalesce(sum(n) FILTER (direction = 'l' AND species = 'A'), 0) AS BIGINT) AS "l_A", CAST(coalesce(sum(n) FILTER (direction = 'r' AND species = 'A'), 0) AS BIGINT) AS "r_A",
CAST(coalesce(sum(n) FILTER (direction = 'l' AND species = 'N'), 0) AS BIGINT) AS "l_N" FROM @counts_gt g GROUP BY 1""")
def counts_wide(spark: SparkSession, d: str) -> DataFrame:
    return counts.counts_wide(view(spark, d, "counts_gt"), "filename", [("l", "A"), ("r", "A"), ("l", "N")])


@query("SELECT DISTINCT filename FROM @counts_gt g WHERE filename NOT IN (SELECT filename FROM @counts_pred p WHERE n > 30)")
def unfinished(spark: SparkSession, d: str) -> DataFrame:
    return counts.unfinished(view(spark, d, "counts_gt").select("filename").distinct(), view(spark, d, "counts_pred").where("n > 30"), "filename")


@query("""
WITH a AS (SELECT species, CAST(sum(n) AS BIGINT) AS s FROM @counts_gt g WHERE direction = 'l' GROUP BY 1), b AS (SELECT species, CAST(sum(n) AS BIGINT) AS s FROM @counts_pred p WHERE species <> 'A' GROUP BY 1)
SELECT coalesce(a.species, b.species) AS species, a.s AS score_a, b.s AS score_b FROM a FULL JOIN b ON a.species = b.species""")
def compare_scores(spark: SparkSession, d: str) -> DataFrame:
    a = counts.sum_groups(view(spark, d, "counts_gt").where("direction = 'l'"))
    b = counts.sum_groups(view(spark, d, "counts_pred").where("species <> 'A'"))
    return counts.compare_scores(a, b, "species", "n")


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY epoch DESC) AS r FROM @trials t), s AS (SELECT trial, epoch, coalesce(map50, fitness) AS score FROM l WHERE r = 1)
SELECT trial, epoch, score, row_number() OVER (ORDER BY score DESC NULLS LAST, trial) AS rank FROM s""")
def rank_trials(spark: SparkSession, d: str) -> DataFrame:
    return counts.rank_trials(view(spark, d, "trials"), "trial", "epoch", ["map50", "fitness"])


@query("WITH a AS (SELECT site, class_id, round(avg(w), 6) AS ap50 FROM @boxes b GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY site ORDER BY ap50 DESC, class_id) AS place FROM a")
def ap50_by_site(spark: SparkSession, d: str) -> DataFrame:
    a = view(spark, d, "boxes").groupBy("site", "class_id").agg(F.round(F.avg("w"), 6).alias("ap50"))
    return counts.ap50_by_site(a, "site", "class_id", "ap50")


@query("""
WITH RECURSIVE f AS (SELECT *, row_number() OVER (PARTITION BY clip, track ORDER BY frame) AS i FROM (
  SELECT DISTINCT clip, track, CAST(frame AS INT) AS frame FROM (SELECT *, max(frame) OVER (PARTITION BY clip) AS last FROM @detections d) t WHERE frame < last) u),
s AS (
  SELECT clip, track, frame, i, 0 AS run, 0 AS missed FROM f WHERE i = 1
  UNION ALL SELECT f.clip, f.track, f.frame, f.i, CASE WHEN missed + f.frame - s.frame - 1 > 10 THEN run + 1 ELSE run END, CASE WHEN missed + f.frame - s.frame - 1 > 10 THEN 0 ELSE missed + f.frame - s.frame - 1 END
  FROM s JOIN f ON f.clip = s.clip AND f.track = s.track AND f.i = s.i + 1
)
SELECT clip, track, run, min(frame) AS start, max(frame) AS "end", count(*) AS n FROM s GROUP BY 1, 2, 3""")
def track_runs(spark: SparkSession, d: str) -> DataFrame:
    det = view(spark, d, "detections").withColumn("frame", F.col("frame").cast("int"))
    length = det.groupBy("clip").agg((F.max("frame") + 1).alias("length"))
    return tracks.track_runs(det.join(length, "clip"), "clip", "track", "frame", "length")


@query()
def track_objects(spark: SparkSession, d: str) -> DataFrame:
    det = view(spark, d, "detections").withColumns({"y": F.col("x") / 2, "w": F.lit(2.0), "h": F.lit(2.0), "f": F.floor(F.col("frame") / 3)})
    return tracks.track_objects(det, "clip", "f", "frame", radius=5.0)


_MATCH = """
WITH RECURSIVE b AS (
  SELECT CAST(stem AS VARCHAR) AS image, flag AS cls, round(xc - w / 2, 6) AS x1, round(yc - h / 2, 6) AS y1, round(xc + w / 2, 6) AS x2, round(yc + h / 2, 6) AS y2, a * 1000000 + b AS pos, b FROM @norm_boxes n
), p AS (SELECT image, cls, x1 + 0.01 AS x1, y1, x2, y2, pos, (pos %% 100) / 100.0 AS conf FROM b WHERE b %% 4 <> 0),
o AS (
  SELECT p.image, p.cls, p.pos AS p, t.pos AS t, p.conf, greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0) * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0) AS cut,
         (p.x2 - p.x1) * (p.y2 - p.y1) + (t.x2 - t.x1) * (t.y2 - t.y1) AS area FROM p JOIN b t ON p.image = t.image AND p.cls = t.cls
), q AS (SELECT *, cut / nullif(area - cut, 0) AS iou FROM o), levels AS (SELECT unnest([%s]) AS level),
r AS (SELECT image, cls, level, p, t, row_number() OVER (PARTITION BY image, cls, level ORDER BY conf DESC, p, iou DESC, t) AS i FROM q JOIN levels ON iou >= level),
m AS (
  SELECT image, cls, level, i, [p] AS ps, [t] AS ts FROM r WHERE i = 1
  UNION ALL SELECT r.image, r.cls, r.level, r.i, CASE WHEN list_contains(ps, p) OR list_contains(ts, t) THEN ps ELSE list_append(ps, p) END, CASE WHEN list_contains(ps, p) OR list_contains(ts, t) THEN ts ELSE list_append(ts, t) END
  FROM m JOIN r ON r.image = m.image AND r.cls = m.cls AND r.level = m.level AND r.i = m.i + 1
), last AS (SELECT image, cls, level, arg_max(ps, i) AS ps FROM m GROUP BY 1, 2, 3), hit AS (SELECT image, cls, level, unnest(ps) AS pos FROM last),
h AS (SELECT p.image, p.cls, levels.level, p.pos, p.conf, CASE WHEN hit.pos IS NULL THEN 0 ELSE 1 END AS hit FROM p CROSS JOIN levels LEFT JOIN hit ON hit.image = p.image AND hit.cls = p.cls AND hit.pos = p.pos AND hit.level = levels.level),
k AS (SELECT *, row_number() OVER w AS k, sum(hit) OVER (w ROWS UNBOUNDED PRECEDING) AS tp FROM h WINDOW w AS (PARTITION BY cls, level ORDER BY conf DESC, image, pos)),
n AS (SELECT cls, count(*) AS n_truth FROM b GROUP BY 1),
c AS (SELECT k.*, n_truth, max(tp / k) OVER (PARTITION BY cls, level ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS best FROM k JOIN n USING (cls)),
per AS (SELECT cls, level, any_value(n_truth) AS n_truth, count(*) AS n_pred, coalesce(sum(best) FILTER (hit = 1), 0) / any_value(n_truth) AS ap, max(2 * tp / (k + n_truth)) AS f1 FROM c GROUP BY 1, 2),
top AS (SELECT c.cls, arg_min(tp / k, k) AS precision, arg_min(tp / c.n_truth, k) AS recall FROM c JOIN per ON per.cls = c.cls AND per.level = c.level AND 2 * tp / (k + c.n_truth) = f1 WHERE c.level = 0.5 GROUP BY 1),
out AS (SELECT per.cls, any_value(n_truth) AS n_truth, any_value(n_pred) AS n_pred, avg(ap) AS ap, max(ap) FILTER (level = 0.5) AS ap50, any_value(precision) AS precision, any_value(recall) AS recall FROM per JOIN top USING (cls) GROUP BY 1)
"""


def _detections(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    b = view(spark, d, "norm_boxes").select(F.col("stem").alias("image"), F.col("flag").alias("cls"), *[F.round(e, 6).alias(n) for n, e in (("x1", F.col("xc") - F.col("w") / 2), ("y1", F.col("yc") - F.col("h") / 2), ("x2", F.col("xc") + F.col("w") / 2), ("y2", F.col("yc") + F.col("h") / 2))], (F.col("a") * 1000000 + F.col("b")).alias("pos"), F.col("b"))
    return b.where("b % 4 <> 0").withColumns({"conf": (F.col("pos") % 100) / 100.0, "x1": F.col("x1") + 0.01}), b


@query(_MATCH % ", ".join(map(str, tracks.IOUS)) + "SELECT round(avg(ap50), 6) AS map50, round(avg(ap), 6) AS map50_95, round(avg(precision), 6) AS mp, round(avg(recall), 6) AS mr FROM out")
def mean_detection_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _round(tracks.mean_metrics(tracks.detection_metrics(*_detections(spark, d), tracks.IOUS)), "map50", "map50_95", "mp", "mr", digits=6)


@query(_MATCH % "0.5" + "SELECT cls, n_truth, n_pred, round(ap, 6) AS ap, round(ap50, 6) AS ap50, round(precision, 6) AS precision, round(recall, 6) AS recall FROM out")
def detection_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _round(tracks.detection_metrics(*_detections(spark, d)), "ap", "ap50", "precision", "recall", digits=6)


@query("""
WITH t AS (SELECT DISTINCT clip, track FROM @detections d), m AS (SELECT clip, max(track) + 1 AS n FROM t GROUP BY 1),
b AS (SELECT clip, coalesce(sum(n) OVER (ORDER BY clip ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM m)
SELECT clip, track, CAST(track + base AS BIGINT) AS global_id FROM t JOIN b USING (clip)""")
def offset_track_ids(spark: SparkSession, d: str) -> DataFrame:
    return tracks.offset_track_ids(view(spark, d, "detections").select("clip", "track").distinct(), "clip", "track")


@query("""
WITH c AS (SELECT *, CASE WHEN track = lag(track) OVER (PARTITION BY clip ORDER BY frame) THEN 0 ELSE 1 END AS new FROM @detections d)
SELECT clip, frame, track, CAST(sum(new) OVER (PARTITION BY clip ORDER BY frame) AS BIGINT) AS run_id FROM c""")
def change_point_ids(spark: SparkSession, d: str) -> DataFrame:
    return tracks.change_point_ids(view(spark, d, "detections").select("clip", "frame", "track"), "clip", ["frame"], "track")


@query("SELECT clip, track, frame FROM @detections d WHERE (clip, track) IN (SELECT (clip, track) FROM @detections d GROUP BY clip, track HAVING count(*) >= 50)")
def drop_short_tracks(spark: SparkSession, d: str) -> DataFrame:
    return tracks.drop_short_tracks(view(spark, d, "detections").select("clip", "track", "frame"), ["clip", "track"], 50)


# --- runs and measurements ----------------------------------------------------------------------------------------------


@query(streaming.OUTAGES)
def outages(spark: SparkSession, d: str) -> DataFrame:
    out = runs.detect_outages(view(spark, d, "logs"), "device", ["ts", "pos"], "ts", "restart", "healthy", 3600)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return out.select(F.col("device").cast("string").alias("device"), us("restart_ts").alias("restart_us"), us("last_healthy").alias("healthy_us"), us("next_restart").alias("next_us"))


@query("""
WITH c AS (SELECT *, coalesce(sum(duration) OVER (PARTITION BY day ORDER BY clip ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM @clips c)
SELECT clip, CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) + CAST(round_even(before, 0) AS BIGINT) AS start_s FROM c""")
def contiguous_times(spark: SparkSession, d: str) -> DataFrame:
    out = runs.assign_contiguous(view(spark, d, "clips"), "day", [F.col("clip").asc_nulls_last()], "duration", F.col("day").cast("timestamp"), skip_missing=False)
    return out.select("clip", F.unix_timestamp("start_ts").alias("start_s"))


@query("""
SELECT clip, CAST(part AS INT) AS part, CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) + part * 120 AS start_s, round(least(120.0, duration - part * 120), 6) AS seconds
FROM (SELECT *, unnest(range(greatest(1, CAST(floor((duration + 119) / 120) AS INT)))) AS part FROM @clips c) t""")
def segments(spark: SparkSession, d: str) -> DataFrame:
    out = runs.segment_clips(view(spark, d, "clips").withColumn("start", F.col("day").cast("timestamp")), "duration", "start")
    return out.select("clip", "part", F.unix_timestamp("part_start").alias("start_s"), F.round("part_seconds", 6).alias("seconds"))


@query("""
WITH b AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER w) < 3600 THEN 0 ELSE 1 END AS new FROM @measurements m WINDOW w AS (PARTITION BY region ORDER BY ts)),
u AS (SELECT *, sum(new) OVER (PARTITION BY region ORDER BY ts) AS burst FROM b), p AS (SELECT *, row_number() OVER (PARTITION BY region, burst ORDER BY ts) AS r FROM u)
SELECT event_id, CAST(burst AS BIGINT) AS burst, CASE WHEN r > 2 THEN bits END AS bits FROM p""")
def mask_first(spark: SparkSession, d: str) -> DataFrame:
    return measures.mask_first(view(spark, d, "measurements"), "region", "ts", "bits", 2, 3600).select("event_id", "burst", "bits")


@query("SELECT CAST(floor(epoch(ts) / 120) AS BIGINT) * 120 AS start_s, round(avg(bits), 2) AS mean FROM @measurements m GROUP BY 1")
def resample_2min(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "measurements").withColumn("ts", F.col("ts").cast("timestamp"))
    return measures.resample_mean(m, "ts", "bits", "2 minutes").select(F.unix_timestamp("start").alias("start_s"), F.round("mean", 2).alias("mean"))


@query("""
WITH q AS (SELECT region, count(bits) AS n, quantile_cont(bits, 0.25) AS q1, quantile_cont(bits, 0.5) AS median, quantile_cont(bits, 0.75) AS q3 FROM @measurements m GROUP BY 1)
SELECT region, n, round(q1, 2) AS q1, round(median, 2) AS median, round(q3, 2) AS q3, round(min(bits) FILTER (bits >= q1 - 1.5 * (q3 - q1)), 2) AS low,
       round(max(bits) FILTER (bits <= q3 + 1.5 * (q3 - q1)), 2) AS high FROM @measurements m JOIN q USING (region) GROUP BY ALL""")
def box_summary(spark: SparkSession, d: str) -> DataFrame:
    return _round(measures.box_summary(view(spark, d, "measurements"), ["region"], "bits"), "q1", "median", "q3", "low", "high", digits=2)


@query("SELECT region, round(avg(bits), 2) AS mean, round(max(bits), 2) AS peak, round(avg(bits) / max(bits), 6) AS ratio FROM @measurements m GROUP BY 1")
def throughput_summary(spark: SparkSession, d: str) -> DataFrame:
    return _round(_round(measures.throughput_summary(view(spark, d, "measurements"), ["region"], "bits"), "mean", "peak", digits=2), "ratio", digits=6)


@query("""
WITH m AS (SELECT date_trunc('day', ts) AS day, avg(bits) AS value FROM @measurements m GROUP BY 1)
SELECT DISTINCT CAST(epoch(m.day) AS BIGINT) AS day_s, round(value, 2) AS value, round(rain, 2) AS rain FROM m JOIN @weather w ON m.day = w.day""")
def bandwidth_weather(spark: SparkSession, d: str) -> DataFrame:
    out = measures.bandwidth_weather(view(spark, d, "measurements"), view(spark, d, "weather"), "ts", "bits", "day", "rain", "day")
    return out.select(F.unix_timestamp(F.col("hour").cast("timestamp")).alias("day_s"), F.round("value", 2).alias("value"), F.round("rain", 2).alias("rain"))


@query("""SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day_s, round(avg(bits) FILTER (region = 0), 2) AS "0", round(avg(bits) FILTER (region = 1), 2) AS "1",
round(avg(bits) FILTER (region = 2), 2) AS "2" FROM @measurements m WHERE region < 3 GROUP BY 1""")
def merge_series(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "measurements").where("region < 3")
    out = _round(measures.merge_series(m, F.date_trunc("day", "ts"), "region", "bits", [0, 1, 2]), "0", "1", "2", digits=2)
    return out.select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("day_s"), "0", "1", "2")


@query(streaming.MOTION.format(frame="frame", longest=20) + """
SELECT CAST(camera AS VARCHAR) AS camera, c0 AS start, c1 AS "end", reason FROM s WHERE reason IS NOT NULL
UNION ALL SELECT CAST(s.camera AS VARCHAR), s.start, s.c1, 'end' FROM s JOIN (SELECT camera, max(i) AS i FROM m GROUP BY 1) e ON e.camera = s.camera AND e.i = s.i WHERE s.start >= 0""")
def motion_clips(spark: SparkSession, d: str) -> DataFrame:
    return runs.motion_clips(view(spark, d, "motion"), "camera", "frame", "has_motion", fps=2.0, delay=1.0, longest=10.0)


@query("""
WITH m AS (SELECT site, camera, epoch_us(ts) / 1e6 AS t FROM @motion m WHERE has_motion), n AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY site ORDER BY t, camera) <= 3600 THEN 0 ELSE 1 END AS new FROM m),
e AS (SELECT *, sum(new) OVER (PARTITION BY site ORDER BY t, camera ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event FROM n)
SELECT site, CAST(event AS BIGINT) AS event, min(t) AS start_s, max(t) AS end_s, count(DISTINCT camera) AS n_cameras, CAST(floor((max(t) - min(t)) / 7200) + 1 AS BIGINT) AS n_parts FROM e GROUP BY 1, 2""")
def multi_camera_events(spark: SparkSession, d: str) -> DataFrame:
    return runs.multi_camera_events(view(spark, d, "motion"), "site", "ts", "has_motion", 3600, 7200)


@query("""
WITH v AS (SELECT vec_id, embedding FROM embeddings)
SELECT a.vec_id, round(max(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 5) AS max_sim FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY 1""")
def max_similarity(spark: SparkSession, d: str) -> DataFrame:
    return _round(similarity.max_similarity(spark.read.parquet(f"{d}/embeddings.parquet"), "vec_id", "embedding"), "max_sim", digits=5)


# --- sampling and splitting ---------------------------------------------------------------------------------------------


@query("SELECT doc_id, split, site FROM @manifest m WHERE split NOT IN ('train', 'test') OR (split = 'train' AND site IN ('src0', 'src1', 'src2')) OR (split = 'test' AND site = 'src3')")
def site_manifests(spark: SparkSession, d: str) -> DataFrame:
    return sampling.site_manifests(view(spark, d, "manifest"), "split", "site", {"train": ["src0", "src1", "src2"], "test": ["src3"]}).select("doc_id", "split", "site")


@query("SELECT site, concat('/data/', relpath) AS path FROM @manifest m WHERE split = 'test' AND site IN ('src0', 'src4')")
def eval_manifest(spark: SparkSession, d: str) -> DataFrame:
    return sampling.eval_manifest(view(spark, d, "manifest"), "split", "site", "relpath", ["src0", "src4"], "/data/")


@query("""
WITH s AS (SELECT site, count(*) AS n FROM @manifest m GROUP BY 1), t AS (SELECT CAST(greatest(1, floor(sum(n) * 0.13)) AS BIGINT) AS goal, sum(n) AS total FROM s),
x AS (SELECT site, n, goal * n / total AS exact, CAST(least(floor(goal * n / total), n) AS BIGINT) AS base, goal FROM s, t),
r AS (SELECT *, row_number() OVER (ORDER BY exact - base DESC, site DESC) AS p, goal - sum(base) OVER () AS rest FROM x)
SELECT site, n, CAST(base + CASE WHEN p <= rest AND base < n THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r""")
def stratified_sizes(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest")
    got = sampling.stratified_subset(m, "site", ["doc_id"], fraction=0.13, seed=7).groupBy("site").agg(F.count("*").alias("taken"))
    return m.groupBy("site").agg(F.count("*").alias("n")).join(got, "site", "left").select("site", "n", F.coalesce("taken", F.lit(0)).alias("taken"))


_HASH = "md5(concat_ws('|', '%s', CAST(%s AS VARCHAR)))"


@query(f"""
WITH s AS (SELECT site, count(*) AS n FROM @manifest m GROUP BY 1), t AS (SELECT CAST(greatest(1, floor(sum(n) * 0.13)) AS BIGINT) AS goal, sum(n) AS total FROM s),
x AS (SELECT site, n, goal * n / total AS exact, CAST(least(floor(goal * n / total), n) AS BIGINT) AS base, goal FROM s, t),
r AS (SELECT *, row_number() OVER (ORDER BY exact - base DESC, site DESC) AS p, goal - sum(base) OVER () AS rest FROM x),
k AS (SELECT site, CAST(base + CASE WHEN p <= rest AND base < n THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r),
m AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY {_HASH % (7, 'doc_id')}, doc_id) AS place FROM @manifest m)
SELECT doc_id, m.site, relpath, split FROM m JOIN k ON m.site = k.site WHERE place <= taken""")
def stratified_subset(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_subset(view(spark, d, "manifest"), "site", ["doc_id"], fraction=0.13, seed=7)


@query("""
WITH c AS (SELECT stem, unnest(range(n_frames)) AS frame FROM @videos v),
e AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM @positives p WHERE p.stem = c.stem AND p.frame = c.frame)),
d AS (SELECT stem, frame FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY md5(concat_ws('|', '1', CAST(stem AS VARCHAR), CAST(frame AS VARCHAR))), frame) AS r FROM e) t WHERE r <= 3),
n AS (SELECT CAST(floor(0.1 / 0.9 * count(*)) AS BIGINT) AS n FROM @positives p)
SELECT stem, frame FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '2', CAST(stem AS VARCHAR), CAST(frame AS VARCHAR))), stem, frame) AS r FROM d) t, n WHERE r <= n""")
def sample_negatives(spark: SparkSession, d: str) -> DataFrame:
    positives = view(spark, d, "positives")
    drawn = materialize(tasks.draw_negatives(view(spark, d, "videos"), positives, "stem", "n_frames", "frame", 3, seed=1), "drawn")
    return sampling.share_of_negatives(drawn, "stem", "frame", positives.count(), 0.1, seed=2)


@query("SELECT split, CAST(n AS BIGINT) AS n FROM (SELECT count(*) AS k FROM documents) t, LATERAL (SELECT 'train' AS split, floor(k * 0.7) AS n UNION ALL SELECT 'val', floor(k * 0.85) - floor(k * 0.7) UNION ALL SELECT 'test', k - floor(k * 0.85)) u")
def random_split(spark: SparkSession, d: str) -> DataFrame:
    return sampling.random_split(view(spark, d, "manifest").drop("split"), "relpath", seed=3).groupBy("split").agg(F.count("*").alias("n"))


@query()
def balance_conditions(spark: SparkSession, d: str) -> DataFrame:
    return balance.balance_conditions(view(spark, d, "conditions"), ["brand", "size"], "p_partkey")


@query()
def split_groups(spark: SparkSession, d: str) -> DataFrame:
    boxes = view(spark, d, "boxes").withColumns({"group_id": F.concat_ws("-", "site", (F.col("stem") % 20).cast("string")), "time": F.concat(F.lpad((F.col("stem") % 24).cast("string"), 2, "0"), F.lit("0000"))})
    hist = stats.group_hist(boxes, "group_id", "stem", "frame", "class_id", "w", "h", "time")
    return balance.split_groups(stats.group_stats(boxes, "group_id", "stem", "frame"), hist, "group_id", "n_frames", stats.rarity(hist, "group_id"), seed=5)


@query(f"""
WITH per AS (SELECT filename, species, sum(n) AS n FROM @counts_gt g GROUP BY 1, 2 HAVING sum(n) > 0),
o AS (SELECT species, row_number() OVER (ORDER BY sum(n), species) AS o FROM per GROUP BY 1),
own AS (SELECT filename, min(o) AS o, arg_min(n, o) AS n FROM per JOIN o USING (species) GROUP BY 1),
r AS (SELECT *, row_number() OVER w AS r, coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, count(*) OVER (PARTITION BY o) AS clips,
      sum(n) OVER (PARTITION BY o) AS total FROM own WINDOW w AS (PARTITION BY o ORDER BY {_HASH % (2, 'filename')}, filename)),
t AS (SELECT *, before < ceil(0.1 * total) AS in_test, coalesce(sum(CASE WHEN before < ceil(0.1 * total) THEN n END) OVER (PARTITION BY o), 0) AS tested FROM r)
SELECT filename, CASE WHEN clips <= 3 THEN CASE WHEN r = 1 THEN 'test' WHEN r = 2 AND clips = 3 THEN 'val' ELSE 'train' END
  WHEN in_test THEN 'test' WHEN before - tested < ceil(0.1 * total) THEN 'val' ELSE 'train' END AS split FROM t""")
def split_by_counts(spark: SparkSession, d: str) -> DataFrame:
    return balance.split_by_counts(view(spark, d, "counts_gt"), "filename", "species", "n", seed=2)


@query()
def stratified_sequences(spark: SparkSession, d: str) -> DataFrame:
    return balance.stratified_sequences(view(spark, d, "counts_gt"), "filename", "species", "n", seed=3)
