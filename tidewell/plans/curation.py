"""Queries of curation, summaries and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import names as N
from tidewell.operators import counts, measures, sampling, stats, tasks, tracks
from tidewell.plans.adapters import view
from tidewell.plans.base import query, rounded

_ANNOTATED = """v AS (SELECT stem, n_frames, CASE WHEN n_frames = 13 THEN 'unreadable' END AS error FROM @videos v),
b AS (SELECT * FROM @boxes b)"""


def _annotated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    videos = view(spark, d, "videos").withColumn("error", F.when(F.col("n_frames") == 13, "unreadable"))
    return videos, view(spark, d, "boxes")


@query(f"""
WITH {_ANNOTATED}, p AS (SELECT stem, count(*) FILTER (frame % 2 = 1) AS lines, count(DISTINCT CASE WHEN frame % 2 = 1 THEN frame END) AS files FROM b GROUP BY 1),
j AS (SELECT v.*, p.stem IS NOT NULL AS has, lines, files FROM v LEFT JOIN p ON p.stem = v.stem)
SELECT count(*) FILTER (error IS NULL AND has) AS videos_with_boxes, count(*) FILTER (error IS NULL AND NOT has) AS videos_without_boxes,
  CAST(coalesce(sum(lines) FILTER (error IS NULL), 0) AS BIGINT) AS label_lines, CAST(coalesce(sum(files) FILTER (error IS NULL), 0) AS BIGINT) AS label_files,
  CAST(coalesce(sum(n_frames // 2) FILTER (error IS NULL AND NOT has), 0) AS BIGINT) AS candidate_negative_frames, count(*) FILTER (error IS NOT NULL) AS errors,
  (SELECT count(*) FROM v WHERE stem NOT IN (SELECT stem FROM b) AND n_frames > 20) AS negative_files FROM j""")
def convert_summary(spark: SparkSession, d: str) -> DataFrame:
    videos, boxes = _annotated(spark, d)
    negatives = tasks.without_boxes(videos, boxes, ["stem"]).where("n_frames > 20")
    return tasks.convert_summary(videos, boxes, negatives, "stem", "n_frames", "frame", "error", 2, 1)


@query(f"WITH {_ANNOTATED} SELECT stem, n_frames FROM v WHERE stem IN (SELECT stem FROM b)")
def annotated_items(spark: SparkSession, d: str) -> DataFrame:
    videos, boxes = _annotated(spark, d)
    return tasks.with_boxes(videos, boxes, ["stem"]).select("stem", "n_frames")


@query(f"WITH {_ANNOTATED} SELECT stem, n_frames FROM v WHERE stem NOT IN (SELECT stem FROM b)")
def empty_items(spark: SparkSession, d: str) -> DataFrame:
    videos, boxes = _annotated(spark, d)
    return tasks.without_boxes(videos, boxes, ["stem"]).select("stem", "n_frames")


@query(f"WITH {_ANNOTATED} SELECT v.stem, frame, round(w, 4) + 0.0 AS w, round(h, 4) + 0.0 AS h FROM v LEFT JOIN b ON b.stem = v.stem AND w > h")
def wide_boxes(spark: SparkSession, d: str) -> DataFrame:
    videos, boxes = _annotated(spark, d)
    return rounded(tasks.wide_boxes(videos, boxes, ["stem"], "w", "h").select("stem", "frame", "w", "h"), "w", "h")


@query("""
WITH r AS (SELECT split, regexp_extract(relpath, '^([^/]+)/', 1) AS video_stem, doc_id FROM @manifest m), k AS (SELECT *, CAST(substr(video_stem, 4) AS INT) AS k FROM r),
o AS (SELECT *, CASE WHEN k % 9 = 0 THEN 'metadata missing' WHEN k % 7 = 0 THEN 'fps not positive' WHEN doc_id % 50 = 3 THEN 'label missing' END AS own FROM k),
e AS (SELECT *, min(own) OVER (PARTITION BY video_stem) AS error FROM o)
SELECT split, video_stem, CASE WHEN max(k) % 9 <> 0 THEN 'key' END AS video_key, CASE WHEN max(k) % 9 <> 0 AND max(k) % 7 <> 0 THEN 10.0::DOUBLE END AS fps, count(*) AS requested_frames,
  count(*) FILTER (error IS NULL) AS images_written, count(*) FILTER (error IS NULL) AS labels_written, CASE WHEN max(error) IS NULL THEN 'ok' ELSE 'error' END AS status, coalesce(max(error), '') AS error FROM e GROUP BY 1, 2""")
def pack_manifest(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest").withColumn("p", N.parse_manifest_relpath(F.col("relpath"))).select("split", "p.video_stem", "p.frame_idx")
    k = F.substring("video_stem", 4, 9).cast("int")
    meta = m.select("video_stem").distinct().where(k % 9 != 0).select("video_stem", F.when(k % 7 == 0, 0.0).otherwise(10.0).alias("fps"), F.lit("key").alias("video_key"))
    labels = m.where("frame_idx % 50 <> 3").select("video_stem", "frame_idx", F.lit("").alias("label_text"))
    return tasks.pack_manifest(tasks.pack_plan(m, meta, labels, "video_stem", "frame_idx"), "split", "video_stem")


_SAMPLED = """n AS (SELECT stem, unnest(range(1, n_frames, 3)) AS frame FROM @videos v),
s AS (SELECT stem, string_agg(CAST(frame AS VARCHAR), ' ' ORDER BY frame) AS sampled_frames FROM n GROUP BY 1),
m AS (SELECT s.stem, v.n_frames AS total_frames, sampled_frames, coalesce(brand, '') AS brand, coalesce(size, '') AS size FROM s LEFT JOIN @videos v ON v.stem = s.stem LEFT JOIN @conditions c ON c.p_partkey = s.stem)"""


def _condition_manifest(spark: SparkSession, d: str) -> DataFrame:
    videos = view(spark, d, "videos")
    frames = tasks.eligible_negatives(videos, videos.select("stem", F.lit(-1).alias("frame")).limit(0), "stem", "n_frames", "frame", 3, "fixed", 1)
    conditions = view(spark, d, "conditions").withColumnRenamed("p_partkey", "stem")
    return stats.condition_manifest(frames, "stem", "frame", videos.withColumnRenamed("n_frames", "total_frames"), conditions, ["brand", "size"])


@query(f"WITH {_SAMPLED} SELECT * FROM m")
def condition_manifest(spark: SparkSession, d: str) -> DataFrame:
    return _condition_manifest(spark, d)


@query(f"""
WITH {_SAMPLED}, i AS (SELECT 'brand' AS col, brand AS val FROM @conditions c UNION ALL SELECT 'size', size FROM @conditions c), a AS (SELECT col, val, count(*) AS input_rows FROM i GROUP BY 1, 2),
c AS (SELECT 'brand' AS col, brand AS val FROM m UNION ALL SELECT 'size', size FROM m), b AS (SELECT col, val, count(*) AS selected FROM c WHERE val <> '' GROUP BY 1, 2)
SELECT a.col, a.val, input_rows, min(input_rows) OVER (PARTITION BY a.col) AS target, coalesce(selected, 0) AS selected FROM a LEFT JOIN b ON a.col = b.col AND a.val = b.val""")
def condition_summary(spark: SparkSession, d: str) -> DataFrame:
    return stats.condition_summary(_condition_manifest(spark, d), view(spark, d, "conditions"), ["brand", "size"])


@query("""
SELECT filename, CASE direction WHEN 'l' THEN 'Left' ELSE 'Right' END AS side, species, CAST(sum(CASE direction WHEN 'l' THEN -n ELSE n END) AS BIGINT) AS plot_value FROM @counts_gt g GROUP BY 1, 2, 3""")
def signed_counts(spark: SparkSession, d: str) -> DataFrame:
    metric = F.concat_ws("_", F.lit("counts"), "direction", "species")
    c = view(spark, d, "counts_gt").select("filename", N.split_metric(metric).alias("m"), N.signed_value(metric, F.col("n")).alias("v"))
    return c.groupBy("filename", "m.side", "m.species").agg(F.sum("v").alias("plot_value"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN 1 ELSE 2 END AS n_attributes, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS n_mutable, CASE p_partkey % 3 WHEN 0 THEN p_brand || ',' || p_type WHEN 1 THEN p_brand ELSE p_type || ',x' END AS first_values FROM part""")
def label_attributes(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet")
    text = lambda mutable, values: F.to_json(F.struct(F.lit("a").alias("name"), F.lit(mutable).alias("mutable"), values.alias("values")))
    lines, more = text("True", F.concat_ws("\n", "p_brand", "p_type")), text("False", F.array("p_brand"))
    raw = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('{"attribute":['), lines, F.lit(","), more, F.lit("]}")))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("["), more, F.lit(","), more, F.lit("]")))
        .otherwise(F.concat(F.lit("["), text("odd", F.concat_ws("\n", "p_type", F.lit("x"))), F.lit("]")))
    )
    a = p.select("p_partkey", tasks.clean_label_attributes(raw).alias("a"))
    n_mutable = F.size(F.filter("a", lambda x: F.coalesce(x["mutable"], F.lit(False))))
    return a.select("p_partkey", F.size("a").alias("n_attributes"), n_mutable.alias("n_mutable"), F.array_join(F.get("a", 0)["values"], ",").alias("first_values"))


@query("""
WITH e AS (SELECT clip, track, arg_min(x, frame) FILTER (conf <= 0.06) AS first_x, arg_max(x, frame) FILTER (conf <= 0.06) AS last_x FROM @detections d GROUP BY 1, 2)
SELECT *, CASE WHEN first_x < 50 AND last_x >= 50 THEN 'r' WHEN first_x > 50 AND last_x <= 50 THEN 'l' END AS direction FROM e""")
def bounded_crossings(spark: SparkSession, d: str) -> DataFrame:
    return tracks.line_crossings(view(spark, d, "detections"), ["clip", "track"], ["frame"], "x", 50.0, "conf", 0.06)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0 OR CAST(o_orderdate AS DATE) < DATE '1995-06-17'")
def completed_files(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 10 == 0, F.lit("notes")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    files = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", N.file_date(F.concat(F.lit("/hdd/logs_"), day, F.lit(".txt"))).alias("day"))
    return tasks.completed_files(files, "day", F.lit("1995-06-17").cast("date")).select("o_orderkey")


@query("WITH m AS (SELECT max(ts) AS now FROM events) SELECT event_id FROM events, m WHERE epoch_us(now) - epoch_us(ts) >= 86400000000")
def settled_files(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    now = e.agg(F.max("ts")).first()[0]
    return tasks.settled_files(e, "ts", 86_400, F.lit(now)).select("event_id")


@query("SELECT l_orderkey, l_linenumber, concat('/v/', s_name) AS path FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber = 1 AND l_returnflag <> 'R' AND s_suppkey % 2 = 0")
def single_fish(spark: SparkSession, d: str) -> DataFrame:
    s = spark.read.parquet(f"{d}/supplier.parquet")
    rows = spark.read.parquet(f"{d}/lineitem.parquet").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", F.concat(F.lit(" "), "s_name", F.lit("  ")).alias("video"), F.when(F.col("l_returnflag") != "R", "1:00").alias("timeframe"))
    known = s.where("s_suppkey % 2 = 0").select(F.col("s_name").alias("name"), F.concat(F.lit("/v/"), "s_name").alias("path"))
    return tasks.single_fish(rows, known, "video", "l_linenumber", "timeframe").select("l_orderkey", "l_linenumber", "path")


@query("""
WITH a AS (SELECT class_id, round(avg(w), 6) AS ap50, count(*) AS n FROM @boxes b GROUP BY 1) SELECT class_id, ap50, n, round(corr(ap50, n) OVER (), 6) AS corr FROM a""")
def ap_vs_counts(spark: SparkSession, d: str) -> DataFrame:
    b = view(spark, d, "boxes").groupBy("class_id").agg(F.round(F.avg("w"), 6).alias("ap50"), F.count("*").alias("n"))
    return rounded(counts.ap_vs_counts(b.select("class_id", "ap50"), b.select("class_id", "n"), "class_id", "ap50", "n"), "corr", digits=6)


@query("SELECT split, concat('/set/', split, '/', site, '/', substr(relpath, 4)) AS path FROM @manifest m")
def combine_manifests(spark: SparkSession, d: str) -> DataFrame:
    return tasks.combine_manifests(view(spark, d, "manifest"), "site", "relpath", "/set/", "vid")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id % 3 = 0 AND doc_id % 4 <> 0")
def deletable(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "n_chars")
    status = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("n_chars"), F.when(F.col("doc_id") % 3 == 0, "done").otherwise("failed").alias("status"))
    return tasks.deletable(docs, status, "doc_id", ["n_chars"])


@query("""WITH t AS (SELECT filename, CAST(sum(CASE WHEN direction = 'l' THEN n ELSE -n END) AS BIGINT) AS n FROM @counts_gt g GROUP BY 1)
SELECT filename, n, row_number() OVER (ORDER BY n DESC, filename) AS place FROM t WHERE n <> 0""")
def nonzero_sorted(spark: SparkSession, d: str) -> DataFrame:
    t = view(spark, d, "counts_gt").groupBy("filename").agg(F.sum(F.when(F.col("direction") == "l", F.col("n")).otherwise(-F.col("n"))).alias("n"))
    return counts.nonzero_sorted(t, "n", name="filename")


@query("SELECT species, direction, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM @counts_gt g UNION ALL SELECT * FROM @counts_pred p) u GROUP BY 1, 2")
def total_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.total_counts([view(spark, d, "counts_gt"), view(spark, d, "counts_pred")], ["species", "direction"])


@query("SELECT concat(direction, '_', species) AS metric, CAST(sum(n) AS BIGINT) AS n FROM @counts_gt g WHERE species IN ('A', 'N') GROUP BY 1")
def column_sums(spark: SparkSession, d: str) -> DataFrame:
    wide = counts.counts_wide(view(spark, d, "counts_gt"), "filename", [(x, s) for x in "lr" for s in "AN"])
    return counts.column_sums(wide, "filename")


@query("SELECT site, count(*) AS n FROM @manifest m WHERE site NOT IN (SELECT source FROM documents WHERE n_chars > 20000) GROUP BY 1")
def missing_names(spark: SparkSession, d: str) -> DataFrame:
    found = spark.read.parquet(f"{d}/documents.parquet").where("n_chars > 20000").select(F.col("source").alias("site"))
    return counts.missing_names(view(spark, d, "manifest"), found, "site")


@query("""WITH r AS (SELECT p_brand AS name, p_type AS cls, round_even(avg(CAST(p_size AS DOUBLE)), 4) AS map50 FROM part GROUP BY 1, 2)
SELECT name, cls, map50, substr(name, 2) AS sort_key, row_number() OVER (ORDER BY substr(name, 2), name, cls) AS place FROM r""")
def order_results(spark: SparkSession, d: str) -> DataFrame:
    r = spark.read.parquet(f"{d}/part.parquet").groupBy(F.col("p_brand").alias("name"), F.col("p_type").alias("cls")).agg(F.avg("p_size").alias("map50"))
    return counts.order_results(r, "name", "cls", "map50")


@query("SELECT site FROM @boxes b UNION SELECT source FROM documents")
def union_sites(spark: SparkSession, d: str) -> DataFrame:
    return stats.union_names(view(spark, d, "boxes").select("site"), spark.read.parquet(f"{d}/documents.parquet").select("source"))


@query("""SELECT DISTINCT stem, frame, class_id, CASE site WHEN '1-URGENT' THEN 'URGENT' ELSE site END AS label FROM @boxes b WHERE class_id <> 4""")
def merge_datasets(spark: SparkSession, d: str) -> DataFrame:
    b = view(spark, d, "boxes").select("stem", "frame", "class_id", F.col("site").alias("label"))
    return tasks.merge_datasets(b.where("class_id < 3"), b.where("class_id between 1 and 3"), ["stem", "frame", "class_id"], {"1-URGENT": "URGENT"})


@query("SELECT stem, count(DISTINCT frame) AS n_frames, min(frame) AS first_frame FROM @boxes b GROUP BY 1")
def positive_frames(spark: SparkSession, d: str) -> DataFrame:
    return tasks.positive_frames(view(spark, d, "boxes"), "stem", "frame").select("stem", F.size("frames").cast("long").alias("n_frames"), F.get("frames", 0).alias("first_frame"))


@query("SELECT split, count(*) AS n_frames FROM @manifest m GROUP BY 1")
def manifest_counts(spark: SparkSession, d: str) -> DataFrame:
    return sampling.manifest_counts(view(spark, d, "manifest"), "split")


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY md5(concat_ws('|', '4', CAST(doc_id AS VARCHAR))), doc_id) AS r FROM @manifest m WHERE doc_id % 3 <> 0)
SELECT doc_id, site FROM e WHERE r <= 5""")
def sample_empty(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest")
    return sampling.sample_empty(m, m.where("doc_id % 3 = 0"), "doc_id", "site", 5, seed=4).select("doc_id", "site")


@query("SELECT CASE WHEN event_type = 'purchase' THEN 'up' ELSE 'down' END AS direction, round(avg(value), 4) AS jitter FROM events GROUP BY 1")
def average_jitter(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("direction", F.when(F.col("event_type") == "purchase", "up").otherwise("down"))
    return rounded(measures.average_jitter(e, "direction", "value"), "jitter")


@query("""
WITH f AS (SELECT site, stem, frame, any_value(lpad(CAST(stem % 24 AS VARCHAR), 2, '0') || '0000') AS t FROM @boxes b GROUP BY 1, 2, 3)
SELECT site, 'tod' AS feature, CASE WHEN CAST(substr(t, 1, 2) AS INT) < 6 THEN 'night' WHEN CAST(substr(t, 1, 2) AS INT) < 12 THEN 'morning' WHEN CAST(substr(t, 1, 2) AS INT) < 18 THEN 'afternoon' ELSE 'evening' END AS key, count(*) AS cnt FROM f GROUP BY 1, 3""")
def time_hist(spark: SparkSession, d: str) -> DataFrame:
    b = view(spark, d, "boxes").withColumn("time", F.concat(F.lpad((F.col("stem") % 24).cast("string"), 2, "0"), F.lit("0000")))
    return stats.group_hist(b, "site", "stem", "frame", "class_id", "w", "h", "time").where("feature = 'tod'")


_DAYS = "d AS (SELECT site, concat('cam-', CAST(stem % 4 AS VARCHAR)) AS device, lpad(CAST(stem % 28 + 1 AS VARCHAR), 2, '0') AS day, stem, frame, class_id FROM @boxes b)"


def _by_day(spark: SparkSession, d: str) -> DataFrame:
    stem = F.col("stem")
    return view(spark, d, "boxes").withColumns({"device": F.concat(F.lit("cam-"), (stem % 4).cast("string")), "day": F.lpad((stem % 28 + 1).cast("string"), 2, "0")})


@query(f"WITH {_DAYS} SELECT site, device, day, count(DISTINCT stem) AS n_videos, count(DISTINCT (stem, frame)) AS n_frames, count(*) AS n_boxes FROM d GROUP BY 1, 2, 3")
def group_day_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_stats(_by_day(spark, d), ["site", "device", "day"], "stem", "frame")


@query(f"""WITH {_DAYS}, n AS (SELECT site, device, day, stem, frame, count(*) AS n FROM d GROUP BY 1, 2, 3, 4, 5)
SELECT site, device, day, 'class' AS feature, CAST(class_id AS VARCHAR) AS key, count(*) AS cnt FROM d GROUP BY 1, 2, 3, 5
UNION ALL SELECT site, device, day, 'density', CASE WHEN n <= 2 THEN CAST(n AS VARCHAR) WHEN n <= 4 THEN '3-4' WHEN n <= 9 THEN '5-9' ELSE '10+' END, count(*) FROM n GROUP BY 1, 2, 3, 5""")
def group_day_hist(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_hist(_by_day(spark, d), ["site", "device", "day"], "stem", "frame", "class_id", "w", "h").where("feature in ('class', 'density')")
