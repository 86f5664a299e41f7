"""Queries that write tables of the test data as the files of a reader or a writer, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import boxes as B
from tidewell.operators import counts, stats
from tidewell.operators.ordered import with_running
from tidewell.plans.adapters import view
from tidewell.plans.base import query, rounded
from tidewell.session import shared_dir
from tidewell.sources import readers, writers


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


#: Items of all groups that one task puts into files.
ITEMS = 50_000


def _documents(rows: DataFrame, group: Column, key: str, item: Column, path: str, before: str = "", after: str = "") -> str:
    """Files of a JSON list of items, with something before and after it. Each group has as many as its items ask for, dealt by
    a hash of the key, so that no task holds more than about ITEMS of them."""
    parts = max(1, -(-rows.count() // ITEMS))
    dealt = rows.select(group.alias("g"), F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"), item.alias("item")).repartition(parts, "part")
    lists = dealt.groupBy("g", "part").agg(F.to_json(F.collect_list("item")).alias("j"))
    lists.select("g", "part", F.concat(F.lit(before), "j", F.lit(after)).alias("value")).write.partitionBy("g", "part").text(path)
    return path


def _csv(rows: DataFrame, path: str, header: bool = True) -> str:
    rows.write.option("header", header).csv(path)
    return path


@query("SELECT CAST(regexp_extract(relpath, '^([^/]+)/', 1) AS STRING) AS video_stem, CAST(doc_id AS INT) AS frame_idx FROM @manifest m WHERE split = 'train'")
def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_manifest(view(spark, d, "manifest").where("split = 'train'"), path)
    return readers.read_manifest(spark, path, "train").select("video_stem", "frame_idx")


@query("""WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM @manifest m)
SELECT concat('part-', lpad(CAST(n // 70 AS STRING), 6, '0')) AS shard, count(*) AS n, min(doc_id) AS first_id FROM n GROUP BY 1""")
def shard_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_shards(view(spark, d, "manifest"), path, ["doc_id"], 70, "part")
    return spark.read.schema("doc_id long, shard string").parquet(path).groupBy("shard").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("SELECT CAST(filename AS STRING) AS filename, direction, species, CAST(sum(n) AS BIGINT) AS n FROM @counts_gt g WHERE species IN ('A', 'N') GROUP BY 1, 2, 3")
def count_files(spark: SparkSession, d: str) -> DataFrame:
    g, path = view(spark, d, "counts_gt"), _folder(spark)
    a = _csv(counts.counts_wide(g, "filename", [("l", "A"), ("r", "A")]), f"{path}/a")
    b = _csv(counts.counts_wide(g, "filename", [("r", "N"), ("l", "N")]).select("r_N", "filename", "l_N"), f"{path}/b")
    return readers.read_counts(spark, [a, b]).where("n > 0")


@query("""SELECT CAST(user_id % 5 AS STRING) AS device, epoch_us(date_trunc('second', ts)) AS us, CASE WHEN value > 90 THEN 'WARNING' ELSE 'INFO' END AS level, 'run.py:' || CAST(event_id % 100 AS VARCHAR) AS module, event_type || ' - ' || CAST(event_id AS VARCHAR) AS message
FROM events WHERE event_type <> 'view'""")
def log_files(spark: SparkSession, d: str) -> DataFrame:
    e, path = spark.read.parquet(f"{d}/events.parquet"), _folder(spark)
    line = F.concat(
        F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd HH:mm:ss"), F.lit(",000 - "), F.when(F.col("value") > 90, "WARNING").otherwise("INFO"), F.lit(" [run.py:"), (F.col("event_id") % 100).cast("string"),
        F.lit("] - "), "event_type", F.lit(" - "), F.col("event_id").cast("string"),
    )
    text = F.when(F.col("event_type") == "view", F.concat(F.lit("no log line of "), "event_type")).otherwise(line)
    e.select((F.col("user_id") % 5).alias("device"), text.alias("value")).write.partitionBy("device").text(f"{path}/hdd/org/site")
    logs = readers.read_logs(spark, path, "*.txt")
    return logs.select(F.regexp_extract("device", r"=(\d+)$", 1).alias("device"), F.unix_micros("ts").alias("us"), "level", "module", "message")


@query("SELECT epoch_us(date_trunc('second', ts)) AS us, round(bits, 2) AS bits, CASE WHEN region % 2 = 0 THEN CAST(region AS DOUBLE) END AS jitter FROM @measurements m")
def measurement_files(spark: SparkSession, d: str) -> DataFrame:
    m, path = view(spark, d, "measurements").withColumn("epoch", F.unix_timestamp(F.col("ts").cast("timestamp"))), _folder(spark)
    _csv(m.where("region % 2 = 0").select("epoch", F.col("region").alias("jitter"), "bits"), f"{path}/up")
    _csv(m.where("region % 2 = 1").select(F.col("epoch").alias("time"), "bits"), f"{path}/down")
    out = readers.read_measurements(spark, path, "*.csv", ["bits", "jitter"])
    return out.select(F.unix_micros("ts").alias("us"), F.round("bits", 2).alias("bits"), "jitter")


@query("SELECT CAST(epoch(day) AS BIGINT) + 25200 AS at_s, round(rain, 6) AS rain FROM @weather w")
def weather_files(spark: SparkSession, d: str) -> DataFrame:
    """Local times of a zone seven hours behind."""
    path = _csv(view(spark, d, "weather").select(F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("time"), F.col("rain").alias("precipitation")), _folder(spark))
    return readers.read_weather(spark, path, "time", "precipitation", "America/Phoenix").select(F.unix_timestamp("ts").alias("at_s"), F.round("precip_mm", 6).alias("rain"))


@query("SELECT clip || '/' || CAST(frame AS VARCHAR) AS frame_name, CAST(track AS INT) AS track_id, round(x, 4) AS x, round(conf, 6) AS conf FROM @detections d")
def mot_files(spark: SparkSession, d: str) -> DataFrame:
    det = view(spark, d, "detections").select(F.concat_ws("/", "clip", F.col("frame").cast("string")), "track", "x", F.lit(1.5), F.lit(2), F.lit(3), "conf", F.lit(1), F.lit(1))
    return readers.read_mot(spark, _csv(det.toDF(*[f"c{i}" for i in range(9)]), _folder(spark), False)).select("frame_name", "track_id", F.round("left", 4).alias("x"), F.round("conf", 6).alias("conf"))


@query("SELECT class_id, CAST(stem AS INT) AS track_id, round(w, 6) AS w, round(h, 6) AS h FROM @boxes b")
def jde_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    view(spark, d, "boxes").select(F.concat_ws(" ", "class_id", "stem", F.lit("0.5"), F.lit("0.5"), "w", "h").alias("value")).write.text(path)
    return readers.read_jde(spark, path).select("class_id", "track_id", F.round("w", 6).alias("w"), F.round("h", 6).alias("h"))


@query("""WITH t AS (SELECT stem, track, CAST(stem AS VARCHAR) AS video_stem, frame, round(x, 4) AS x, round(w, 4) AS w, enabled FROM @keyframes k)
SELECT video_stem, concat('track', CAST(track AS VARCHAR)) AS label, frame, x, w, enabled FROM t WHERE stem % 2 = 0""")
def task_files(spark: SparkSession, d: str) -> DataFrame:
    k, path = view(spark, d, "keyframes"), _folder(spark)
    box = F.struct("frame", "x", "y", F.col("w").alias("width"), F.col("h").alias("height"), "enabled")
    tracks = k.groupBy("stem", "track").agg(F.collect_list(box).alias("sequence"))
    result = F.struct(F.lit("videorectangle").alias("type"), F.when(F.col("stem") % 2 == 0, "video").otherwise("other").alias("to_name"), F.struct(F.array(F.concat(F.lit("track"), F.col("track").cast("string"))).alias("labels"), "sequence").alias("value"))
    results = tracks.groupBy("stem").agg(F.collect_list(result).alias("result"))
    old = F.struct(F.lit("2024-01-01").alias("updated_at"), F.slice("result", 1, 0).alias("result"))
    task = F.struct(F.col("stem").alias("id"), F.create_map(F.lit("video"), F.concat(F.lit("s3://x/"), F.col("stem").cast("string"), F.lit(".mp4"))).alias("data"), F.array(old, F.struct(F.lit("2024-02-01").alias("updated_at"), "result")).alias("annotations"))
    _documents(results, F.col("stem") % 9, "stem", task, path)
    rows = readers.keyframes(readers.read_tasks(spark, path, strict=True, glob="*.txt"), to_name="video")
    return rows.select("video_stem", "label", "frame", F.round("x", 4).alias("x"), F.round("w", 4).alias("w"), "enabled")


@query("""WITH p AS (SELECT o_orderkey, o_orderkey % 6 AS g, o_custkey % 3 AS parent, row_number() OVER (PARTITION BY o_orderkey % 6 ORDER BY o_orderkey) AS i FROM orders),
n AS (SELECT *, CASE WHEN parent = lag(parent) OVER (PARTITION BY g ORDER BY i) THEN 0 ELSE 1 END AS new FROM p)
SELECT concat('p', CAST(parent AS VARCHAR), '/', CAST(o_orderkey AS VARCHAR)) AS item, CAST(sum(new) OVER (PARTITION BY g ORDER BY i) AS BIGINT) AS clip, 1.0::DOUBLE AS x1, 4.0::DOUBLE AS x2, 4.0::DOUBLE AS cy FROM n""")
def datumaro_files(spark: SparkSession, d: str) -> DataFrame:
    o, path = spark.read.parquet(f"{d}/orders.parquet"), _folder(spark)
    box = lambda track: F.struct(F.lit(1).alias("label_id"), F.array(*[F.lit(float(x)) for x in (1, 2, 3, 4)]).alias("bbox"), F.struct(track.alias("track_id")).alias("attributes"))
    item = F.struct("o_orderkey", F.concat(F.lit("p"), (F.col("o_custkey") % 3).cast("string"), F.lit("/"), F.col("o_orderkey").cast("string")).alias("id"), F.array(box(F.lit("7")), box(F.lit(None).cast("string"))).alias("annotations"))
    # a file's items are its lines, in order, so it is written without being held
    g, ends = (F.col("o_orderkey") % 6).alias("g"), [F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")]
    rows = o.select(g, "o_orderkey", "o_custkey").join(F.broadcast(o.groupBy(g).agg(*ends)), "g").repartition("g").sortWithinPartitions("g", "o_orderkey")
    line = F.concat(F.when(F.col("o_orderkey") == F.col("first"), '{"items":[').otherwise(""), F.to_json(item), F.when(F.col("o_orderkey") == F.col("last"), "]}").otherwise(","))
    rows.select("g", line.alias("value")).write.partitionBy("g").text(path)
    return readers.read_datumaro(spark, path).select("item", "clip", "x1", "x2", "cy")


@query("SELECT CAST(user_id AS VARCHAR) AS cam_name, event_type AS event_id, CAST(event_id AS INT) AS part_number, round(value, 4) AS duration FROM events")
def sidecar_files(spark: SparkSession, d: str) -> DataFrame:
    e, path = spark.read.parquet(f"{d}/events.parquet"), _folder(spark)
    item = F.struct(F.col("user_id").cast("string").alias("cam_name"), F.col("event_type").alias("event_id"), F.col("event_id").alias("part_number"), F.col("value").alias("duration"))
    return readers.read_sidecars(spark, _documents(e, F.col("user_id") % 7, "event_id", item, path)).select("cam_name", "event_id", "part_number", F.round("duration", 4).alias("duration"))


@query("SELECT v.stem AS image_id, CAST(frame AS BIGINT) AS track_id, CASE WHEN frame IS NOT NULL THEN 'Coho' END AS label, round(w, 4) AS x2 FROM @videos v LEFT JOIN @boxes b ON b.stem = v.stem")
def cvat_files(spark: SparkSession, d: str) -> DataFrame:
    b, path = view(spark, d, "videos").join(view(spark, d, "boxes"), "stem", "left"), _folder(spark)
    note = F.array(F.struct(F.lit("__instance_id").alias("_name"), F.col("frame").cast("string").alias("_VALUE")))
    box = F.struct(F.lit("Coho").alias("_label"), F.lit(0.0).alias("_xtl"), F.lit(0.0).alias("_ytl"), F.col("w").alias("_xbr"), F.col("h").alias("_ybr"), note.alias("attribute"))
    images = b.groupBy(F.col("stem").alias("_id")).agg(F.collect_list(F.when(F.col("frame").isNotNull(), box)).alias("box"))
    images.withColumn("_name", F.lit("f")).write.format("xml").option("maxRecordsPerFile", ITEMS).option("rowTag", "image").option("rootTag", "annotations").save(path)
    out = readers.read_cvat_xml(spark, path, glob="part-*")
    return out.select("image_id", "track_id", "label", F.round("x2", 4).alias("x2"))


@query("SELECT concat('v/', CAST(o_orderkey AS VARCHAR), CASE o_orderkey % 3 WHEN 0 THEN '.mp4' ELSE '.MP4' END) AS path, o_custkey AS size FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderkey % 5 <> 0")
def listing_files(spark: SparkSession, d: str) -> DataFrame:
    o, path = spark.read.parquet(f"{d}/orders.parquet"), _folder(spark)
    end = F.when(F.col("o_orderkey") % 3 == 0, ".mp4").when(F.col("o_orderkey") % 3 == 1, ".txt").otherwise(".MP4")
    item = F.struct(F.concat(F.lit("v/"), F.col("o_orderkey").cast("string"), end).alias("Path"), (F.col("o_orderkey") % 5 == 0).alias("IsDir"), F.col("o_custkey").alias("Size"))
    return readers.read_listing(spark, _documents(o, F.col("o_orderkey") % 4, "o_orderkey", item, path)).select(F.col("Path").alias("path"), F.col("Size").alias("size"))


@query("SELECT CAST(site AS VARCHAR) AS site, count(DISTINCT (stem, frame)) AS n_images, count(*) AS n_annotations, count(DISTINCT class_id) AS n_categories FROM @boxes b GROUP BY 1")
def coco_files(spark: SparkSession, d: str) -> DataFrame:
    b, path = view(spark, d, "boxes").withColumns({"image": F.concat_ws("/", "stem", "frame"), "x": F.lit(0.0), "y": F.lit(0.0)}), _folder(spark)
    parts = 1 + spark.read.parquet(f"{d}/lineitem.parquet").count() // ITEMS
    writers.to_coco(b, "image", "site", "class_id", parts=parts).select(F.col("json").alias("value"), "site").write.partitionBy("site").text(path)
    doc = F.from_json("value", "images array<struct<id: bigint>>, annotations array<struct<id: bigint, image_id: bigint>>, categories array<struct<id: bigint>>")
    out = spark.read.schema("value string, site string").text(path).select("site", doc.alias("j"))
    # an image is in one part, a category in several
    images = F.size(F.array_distinct(F.transform("j.images", lambda x: x["id"])))
    kinds = F.collect_set("j.categories.id")
    sums = out.groupBy("site").agg(F.sum(images).alias("n_images"), F.sum(F.size("j.annotations")).alias("n_annotations"), F.size(F.array_distinct(F.flatten(kinds))).cast("long").alias("n_categories"))
    return sums.select("site", "n_images", "n_annotations", "n_categories")


@query("SELECT clip, track, count(*) AS n, round(sum(x), 2) AS x FROM @detections d GROUP BY 1, 2")
def detection_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_detections(view(spark, d, "detections"), path, "clip")
    back = spark.read.option("header", True).schema("frame long, track long, x double, conf double, cls string, clip string").csv(path)
    return back.groupBy("clip", "track").agg(F.count("*").alias("n"), F.round(F.sum("x"), 2).alias("x"))


@query("SELECT site, CAST(class_id AS VARCHAR) AS class_id, count(*) AS n_boxes, count(DISTINCT (stem, frame)) AS n_frames FROM @boxes b GROUP BY 1, 2")
def stats_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_stats(view(spark, d, "boxes"), path, "site", "class_id", "stem", "frame")
    docs = spark.read.schema("site string, json string").json(f"{path}/summary")
    own = docs.select("site", F.explode(F.from_json("json", "map<string, struct<n_boxes: bigint, n_frames: bigint>>")).alias("class_id", "v"))
    frames = spark.read.option("header", True).schema("site string, class_id string, n_frames long").csv(f"{path}/site_class_frames")
    return own.join(frames, ["site", "class_id"]).select("site", "class_id", "v.n_boxes", "n_frames")


@query("SELECT CAST(site AS VARCHAR) AS site, CAST(class_id AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS n FROM @boxes b GROUP BY 1, 2")
def dataset_stats_files(spark: SparkSession, d: str) -> DataFrame:
    b, path = view(spark, d, "boxes").groupBy("site", F.col("class_id").cast("string").alias("label")).agg(F.count("*").alias("n")), _folder(spark)
    maps = b.groupBy("site").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("label", "n")))).alias("value"))
    maps.repartition("site").write.partitionBy("site").text(path)
    return readers.read_dataset_stats(spark, path).select(F.url_decode(F.regexp_extract("file", "/site=([^/]+)/", 1)).alias("site"), "label", "n")


@query("SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderstatus AS video, 1 AS n_boxes FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_orderstatus, 0 FROM orders WHERE o_orderkey % 2 = 1")
def flat_task_files(spark: SparkSession, d: str) -> DataFrame:
    o, path = spark.read.parquet(f"{d}/orders.parquet"), _folder(spark)
    box = F.array(F.struct(F.array(F.struct(F.lit(1).alias("frame"), F.lit(2.0).alias("x"))).alias("sequence"), F.array(F.lit("Coho")).alias("labels")))
    item = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("video"), F.when(F.col("o_orderkey") % 2 == 0, box).alias("box"))
    t = readers.read_tasks_min(spark, _documents(o, F.col("o_orderkey") % 5, "o_orderkey", item, path))
    return t.select("id", "video", F.coalesce(F.size("box"), F.lit(0)).alias("n_boxes"))


@query("""SELECT concat('ORG-site-', CAST(p_partkey AS VARCHAR), '_20250604_031705_M') AS video_stem, CAST(p_partkey AS VARCHAR) AS task_id, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS size,
CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS brand FROM part""")
def condition_files(spark: SparkSession, d: str) -> DataFrame:
    p, path = spark.read.parquet(f"{d}/part.parquet"), _folder(spark)
    ids = [F.lit("ORG").alias("Project"), F.lit("site").alias("Site"), F.col("p_partkey").alias("Camera"), F.col("p_partkey").alias("Filename"), F.lit("2025-06-04").alias("Date"), F.lit("3:17:05").alias("Time")]
    brand = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).otherwise("NA").alias("Brand")
    a = _csv(p.where("p_partkey % 2 = 0").select(*ids, F.col("p_size").alias("Size"), brand), f"{path}/a")
    b = _csv(p.where("p_partkey % 2 = 1").select(brand, *ids), f"{path}/b")
    c = readers.read_conditions(spark, [a, b])
    return c.select("video_stem", "task_id", F.try_element_at("conditions", F.lit("Size")).alias("size"), F.try_element_at("conditions", F.lit("Brand")).alias("brand"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS clip, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size + 3 ELSE p_size END AS BIGINT) AS n FROM part WHERE p_brand <> 'Brand#11'")
def reviewed_files(spark: SparkSession, d: str) -> DataFrame:
    p, path = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("clip"), F.col("p_brand").alias("site"), F.col("p_size").alias("a__total__annotated")), _folder(spark)
    _csv(p.where("clip % 2 = 0").select(F.lit(3).alias("b__total__annotated"), "clip", "a__total__annotated", "site", F.lit(9).alias("other")), f"{path}/a")
    _csv(p.where("clip % 2 = 1"), f"{path}/b")
    sites = [r["site"] for r in p.select("site").distinct().where("site <> 'Brand#11'").collect()]
    return readers.read_reviewed_counts(spark, [f"{path}/a", f"{path}/b"], "clip", "site", sites)


@query("SELECT concat('disk/', CAST(s_nationkey AS VARCHAR), '/', s_name) AS path FROM supplier")
def inventory_files(spark: SparkSession, d: str) -> DataFrame:
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.concat(F.lit("disk\\"), F.col("s_nationkey").cast("string")).alias("File Path"), F.col("s_name").alias("File Name"))
    return readers.read_video_inventory(spark, _csv(s, _folder(spark)))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS video_stem, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS fps, o_custkey AS nb_frames FROM orders WHERE o_orderkey % 7 <> 0")
def metadata_files(spark: SparkSession, d: str) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    stem = F.when(F.col("o_orderkey") % 7 == 0, F.lit(" ")).otherwise(F.col("o_orderkey").cast("string"))
    rows = o.select(F.when(F.col("o_orderkey") % 3 == 0, "odd").otherwise(F.round("o_totalprice", 2).cast("string")).alias("fps"), stem.alias("video_stem"), F.col("o_custkey").alias("nb_frames"))
    return rounded(readers.read_video_metadata(spark, _csv(rows, _folder(spark))).select("video_stem", "fps", "nb_frames"), "fps", digits=2)


@query("SELECT split, count(*) AS n_groups, CAST(sum(n_frames) AS BIGINT) AS n_frames, CAST(sum(n_boxes) AS BIGINT) AS n_boxes FROM (SELECT CASE WHEN site LIKE '1%' THEN 'test' ELSE 'train' END AS split, site, count(DISTINCT (stem, frame)) AS n_frames, count(*) AS n_boxes FROM @boxes b GROUP BY 1, 2) g GROUP BY 1")
def split_report_files(spark: SparkSession, d: str) -> DataFrame:
    b, path = view(spark, d, "boxes"), _folder(spark)
    groups = stats.group_stats(b, "site", "stem", "frame")
    assignment = groups.select("site", F.when(F.col("site").startswith("1"), "test").otherwise("train").alias("split"))
    writers.write_split_report(assignment, groups, stats.group_hist(b, "site", "stem", "frame", "class_id", "w", "h"), path, "site", "n_frames", "n_boxes")
    report = spark.read.schema("split string, n_groups long, n_frames long, n_boxes long, histograms map<string, map<string, bigint>>").json(f"{path}/report")
    return report.where(F.size("histograms") == 4).select("split", "n_groups", "n_frames", "n_boxes")


@query("SELECT file_name AS name, kind, CAST(x AS INT) AS x FROM (SELECT CAST(o_orderkey AS VARCHAR) AS file_name, 'interested_objects' AS kind, o_custkey AS x FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'noises', 7 FROM orders WHERE o_orderkey % 2 = 0) t")
def object_files(spark: SparkSession, d: str) -> DataFrame:
    o, path = spark.read.parquet(f"{d}/orders.parquet"), _folder(spark)
    box = lambda x: F.array(F.struct(x.cast("int").alias("x"), F.lit(1).alias("y"), F.lit(2).alias("w"), F.lit(3).alias("h")))
    boxes = F.struct(box(F.col("o_custkey")).alias("interested_objects"), F.when(F.col("o_orderkey") % 2 == 0, box(F.lit(7))).otherwise(F.slice(box(F.lit(7)), 1, 0)).alias("noises"))
    _documents(o, F.col("o_orderkey") % 5, "o_orderkey", F.struct(F.col("o_orderkey").cast("string").alias("name"), boxes.alias("bounding_boxes")), path, '{"metadata":', "}")
    return readers.read_objects(spark, path).select("name", "kind", "x")


@query("SELECT concat('n', CAST(s_suppkey AS VARCHAR)) AS name, 12.5::DOUBLE AS fps, CAST(s_suppkey % 500 AS INT) AS length, 1280::INT AS width, 720::INT AS height FROM supplier")
def seqinfo_files(spark: SparkSession, d: str) -> DataFrame:
    s, path = spark.read.parquet(f"{d}/supplier.parquet"), _folder(spark)
    seqs = s.select(F.concat(F.lit("n"), F.col("s_suppkey").cast("string")).alias("name"), F.lit(12.5).alias("fps"), (F.col("s_suppkey") % 500).alias("length"), F.lit(1280).alias("width"), F.lit(720).alias("height"))
    writers.write_seqinfo(seqs, path, "name", "fps", "length", "width", "height")
    return readers.read_seqinfo(spark, path, "*.txt")


@query("SELECT stem, track, frame, CAST(kf_pos AS BIGINT) AS kf_pos, enabled, round(x, 4) AS x, round(y, 4) AS y, round(x + w, 4) AS x2, round(y + h, 4) AS y2 FROM @keyframes k")
def cvat_track_files(spark: SparkSession, d: str) -> DataFrame:
    k, path = view(spark, d, "keyframes"), _folder(spark)
    note = F.array(F.struct(F.lit("__instance_id").alias("_name"), F.col("kf_pos").cast("string").alias("_VALUE")))
    ends = [F.col(v).cast("double").alias(n) for v, n in (("x", "_xtl"), ("y", "_ytl"))] + [(F.col(v).cast("double") + F.col(s)).alias(n) for v, s, n in (("x", "w", "_xbr"), ("y", "h", "_ybr"))]
    box = F.struct(F.col("frame").alias("_frame"), F.when(F.col("enabled"), 0).otherwise(1).alias("_outside"), F.lit(1).alias("_keyframe"), *ends, note.alias("attribute"))
    grouped = k.groupBy((F.col("stem") * 10 + F.col("track")).alias("_id")).agg(F.collect_list(box).alias("box"))
    grouped.withColumn("_label", F.lit("Coho")).write.format("xml").option("maxRecordsPerFile", ITEMS).option("rowTag", "track").option("rootTag", "annotations").save(path)
    out = readers.read_cvat_tracks(spark, path, glob="part-*", outside=True).where("label = 'Coho' and keyframe")
    return rounded(out.select(F.floor(F.col("track") / 10).alias("stem"), (F.col("track") % 10).alias("track"), F.col("frame").cast("int").alias("frame"), F.col("track_id").alias("kf_pos"), "enabled", F.col("x1").alias("x"), F.col("y1").alias("y"), "x2", "y2"), "x", "y", "x2", "y2")


_PICKED = """s AS (SELECT stem, string_agg(CAST(f AS VARCHAR), ' ' ORDER BY f) AS sampled_frames FROM (SELECT stem, unnest(range(1, n_frames, 3)) AS f FROM @videos v) t GROUP BY 1),
m AS (SELECT s.stem, CAST(v.n_frames AS BIGINT) AS total_frames, sampled_frames, coalesce(brand, '') AS brand, coalesce(size, '') AS size FROM s LEFT JOIN @videos v ON v.stem = s.stem LEFT JOIN @conditions c ON c.p_partkey = s.stem)"""


@query(f"""WITH {_PICKED} SELECT 'manifest' AS kind, concat_ws('|', stem, total_frames, sampled_frames, brand, size) AS line FROM m
UNION ALL SELECT 'metadata', concat_ws('|', stem, n_frames) FROM @videos v
UNION ALL SELECT 'summary', concat_ws('|', 'size', size, count(*), min(count(*)) OVER (), (SELECT count(*) FROM m WHERE m.size = c.size)) FROM @conditions c GROUP BY size""")
def condition_output_files(spark: SparkSession, d: str) -> DataFrame:
    videos, path = view(spark, d, "videos"), _folder(spark)
    frames = videos.select("stem", F.explode(F.sequence(F.lit(1), F.col("n_frames").cast("int") - 1, F.lit(3))).alias("frame"))
    conditions = view(spark, d, "conditions").withColumnRenamed("p_partkey", "stem")
    manifest = stats.condition_manifest(frames, "stem", "frame", videos.withColumnRenamed("n_frames", "total_frames"), conditions, ["brand", "size"])
    writers.write_condition_outputs(manifest, videos, stats.condition_summary(manifest, conditions, ["size"]), path)
    lines = lambda kind, *columns: spark.read.option("header", True).csv(f"{path}/{kind}").select(F.lit(kind).alias("kind"), F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns]).alias("line"))
    out = lines("manifest", "stem", "total_frames", "sampled_frames", "brand", "size").union(lines("metadata", "stem", "n_frames"))
    return out.union(lines("summary", "col", "val", "input_rows", "target", "selected"))


@query("SELECT CAST(stem AS VARCHAR) AS video FROM @videos v WHERE stem NOT IN (SELECT stem FROM @boxes b WHERE class_id = 2)")
def empty_video_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    writers.write_manifest(writers.empty_videos(view(spark, d, "videos"), view(spark, d, "boxes").where("class_id = 2"), "stem"), path, "stem")
    return spark.read.text(path).select(F.col("value").alias("video"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS image, concat_ws(' ', l_returnflag, l_suppkey % 100, l_linenumber, 2, l_linenumber + 10, 20) AS line FROM lineitem WHERE l_orderkey % 3 = 0")
def bbox_files(spark: SparkSession, d: str) -> DataFrame:
    rows, path = spark.read.parquet(f"{d}/lineitem.parquet"), _folder(spark)
    boxes = rows.select(F.col("l_orderkey").alias("image"), F.col("l_returnflag").alias("cls"), (F.col("l_suppkey") % 100).alias("conf"), F.col("l_linenumber").alias("x1"), F.lit(2).alias("y1"), (F.col("l_linenumber") + 10).alias("x2"), F.lit(20).alias("y2"))
    writers.write_table(writers.bbox_rows(boxes, "image", 2), path)
    return spark.read.option("header", True).schema("image string, line string").csv(path)


@query("""WITH n AS (SELECT source, CAST(ceil(count(*) / 10.0) AS BIGINT) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1)
SELECT 'site=' || source AS clip, CAST(p AS INT) AS pos, n AS n_images FROM (SELECT *, unnest(range(n)) AS p FROM n) t""")
def image_listing_files(spark: SparkSession, d: str) -> DataFrame:
    docs, path = spark.read.parquet(f"{d}/documents.parquet").where("source is not null"), _folder(spark)
    # files of ten rows: tasks get whole blocks of them, of which only a site's last may end in a smaller file
    placed = with_running(docs.select(F.col("source").alias("site"), "doc_id"), ["site"], ["doc_id"], {}, "place")
    tasks, block = max(1, -(-docs.count() // (10 * writers.FILES))), F.floor((F.col("place") - 1) / (10 * writers.FILES))
    placed.select("site", F.col("doc_id").cast("string").alias("value"), block.alias("block")).repartition(tasks, "site", "block").drop("block").write.option("maxRecordsPerFile", 10).partitionBy("site").text(path)
    return readers.read_image_listing(spark, path).where("clip like 'site=%' and path like '%.txt'").select("clip", "pos", "n_images")


@query("SELECT epoch_us(date_trunc('second', ts)) // 1000000 AS at_s, CASE user_id % 2 WHEN 0 THEN 'aws' ELSE 'gcp' END AS provider, CASE user_id % 2 WHEN 0 THEN 'west' ELSE 'east' END AS region, round(value, 4) AS latency FROM events")
def latency_files(spark: SparkSession, d: str) -> DataFrame:
    e, path = spark.read.parquet(f"{d}/events.parquet"), _folder(spark)
    at = F.unix_timestamp("ts").alias("epoch")
    _csv(e.where("user_id % 2 = 0").select(at, "event_type", F.col("value").alias("ms")), f"{path}/aws_west")
    _csv(e.where("user_id % 2 = 1").select(at, F.col("event_id").alias("n"), F.col("value").alias("avg")), f"{path}/gcp_east")
    return readers.read_latency(spark, path).select(F.unix_timestamp("ts").alias("at_s"), "provider", "region", F.round("latency", 4).alias("latency"))


@query("""WITH c AS (SELECT DISTINCT p_brand FROM part), n AS (SELECT p_brand AS label, row_number() OVER (ORDER BY p_brand) - 1 AS n FROM c)
SELECT p_partkey, p_brand AS label, CAST(n AS INT) AS class_id FROM part JOIN n ON label = p_brand""")
def class_map_files(spark: SparkSession, d: str) -> DataFrame:
    p, path = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.col("p_brand").alias("label")), _folder(spark)
    names = p.groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_set("label")), lambda x: F.concat(F.lit("  - "), x)), "\n").alias("names"))
    names.select(F.concat(F.lit("path: x\nnames:\n"), "names", F.lit("\n")).alias("value")).write.text(path)
    return B.with_class_id(p, readers.read_class_map(spark, path)).select("p_partkey", "label", "class_id")


@query("""WITH b AS (SELECT stem, frame, a, b, concat_ws(' ', b % 7, printf('%.6f', xc), printf('%.6f', yc), printf('%.6f', w), printf('%.6f', h)) AS line FROM @norm_boxes n WHERE flag <> 'R'),
t AS (SELECT stem, count(*) AS n_lines, string_agg(line || chr(10), '' ORDER BY a, b, line) AS text FROM b GROUP BY 1)
SELECT v.stem, coalesce(n_lines, 0) AS n_lines, coalesce(text, '') AS text FROM @videos v LEFT JOIN t ON t.stem = v.stem""")
def label_texts(spark: SparkSession, d: str) -> DataFrame:
    boxes = view(spark, d, "norm_boxes").where("flag <> 'R'").withColumn("class_id", F.col("b") % 7).withColumn("pos", F.struct("a", "b"))
    out = writers.render_labels(boxes, view(spark, d, "videos"), ["stem"], "pos")
    return out.select("stem", (F.size(F.split("text", "\n")) - 1).cast("long").alias("n_lines"), "text")
