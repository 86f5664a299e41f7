"""Queries of the column expressions for numbers, names, boxes and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import boxes as B
from tidewell.functions import names as N
from tidewell.functions import scalars as S
from tidewell.operators import runs, sampling
from tidewell.plans.adapters import view
from tidewell.plans.base import query, rounded

_PROBE = """p AS (SELECT o_orderkey, o_totalprice AS price, o_custkey AS n, CASE o_orderkey % 5 WHEN 0 THEN '25' WHEN 1 THEN '0' WHEN 2 THEN 'x' WHEN 4 THEN ' 12.5 ' END AS fps,
CASE WHEN o_custkey % 2 = 0 THEN '30000/1001' ELSE '7/0' END AS rate, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'none' END AS frames FROM orders),
f AS (SELECT *, coalesce(try_cast(fps AS DOUBLE), 0.0) AS plain, CASE WHEN n % 2 = 0 THEN 30000.0::DOUBLE / 1001 ELSE 0.0 END AS r, coalesce(try_cast(frames AS BIGINT), 0) AS nb, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE price / 1000 END AS seconds FROM p)"""


@query(f"""WITH {_PROBE}, g AS (SELECT *, CASE WHEN plain > 0 THEN plain WHEN r > 0 THEN r WHEN nb > 0 AND seconds > 0 THEN nb / seconds ELSE 0.0 END AS inferred FROM f)
SELECT o_orderkey, round(plain, 6) AS plain, round(inferred, 6) AS fps, CASE WHEN nb > 0 THEN nb WHEN n % 4 > 0 THEN n % 4 ELSE CAST(round_even(seconds * plain, 0) AS BIGINT) END AS total_frames,
  round(CASE WHEN seconds > 0 THEN seconds WHEN o_orderkey % 2 = 0 THEN 7.5 WHEN nb > 0 AND r > 0 THEN nb / r END, 6) AS duration, round(price / 1e6, 6) AS mbps,
  CASE WHEN inferred > 0 THEN round(n / inferred, 6) END AS at_seconds FROM g""")
def probe_numbers(spark: SparkSession, d: str) -> DataFrame:
    o, k, n = spark.read.parquet(f"{d}/orders.parquet"), F.col("o_orderkey"), F.col("o_custkey")
    fps = F.when(k % 5 == 0, "25").when(k % 5 == 1, "0").when(k % 5 == 2, "x").when(k % 5 == 4, " 12.5 ")
    rate, frames = F.when(n % 2 == 0, "30000/1001").otherwise("7/0"), F.when(k % 3 == 0, n.cast("string")).otherwise("none")
    seconds = F.when(k % 7 == 0, "0").otherwise((F.col("o_totalprice") / 1000).cast("string"))
    inferred = S.infer_fps(fps, rate, F.lit("odd"), frames, seconds)
    out = o.select(
        k, S.safe_double(fps).alias("plain"), inferred.alias("fps"), S.infer_total_frames(frames, F.array(F.lit("x"), F.lit("0"), (n % 4).cast("string")), seconds, fps).alias("total_frames"),
        S.infer_duration(seconds, F.when(k % 2 == 0, "7.5").otherwise("0"), frames, rate).alias("duration"), S.to_mbps(F.col("o_totalprice")).alias("mbps"), S.frame_seconds(n, F.nullif(inferred, F.lit(0.0))).alias("at_seconds"),
    )
    return rounded(out, "plain", "fps", "duration", "mbps", "at_seconds", digits=6)


@query("""SELECT event_id, (epoch_us(ts) // 1000) % 86400000 AS ms, CASE WHEN event_id % 3 = 0 THEN (event_id % 24) * 3600 + (event_id % 60) * 60 + 5 END AS seconds, event_id % 300 = 0 AS checked FROM events""")
def day_times(spark: SparkSession, d: str) -> DataFrame:
    e, k = spark.read.parquet(f"{d}/events.parquet"), F.col("event_id")
    hms = F.when(k % 3 == 0, F.format_string("%d:%02d:05", k % 24, k % 60)).when(k % 3 == 1, F.format_string("%d:%02d:61", k % 24, k % 60)).otherwise("noon")
    return e.select("event_id", S.time_to_ms(F.col("ts").cast("timestamp")).alias("ms"), S.parse_hms(hms).cast("long").alias("seconds"), S.is_check_frame(k, F.lit(10.0)).alias("checked"))


@query(r"""SELECT doc_id, concat('frame_', lpad(CAST(doc_id AS VARCHAR), 6, '0')) AS stem, concat('train/', relpath) AS label, concat('train/', regexp_extract(relpath, '^(.*)\.txt$', 1), '.jpg') AS image,
concat('/root/', relpath) AS path, CASE WHEN doc_id % 2 = 0 THEN 'upper' ELSE 'unknown' END AS site, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'upper' END AS split_site FROM @manifest m""")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    m, k = view(spark, d, "manifest"), F.col("doc_id")
    image = F.concat(F.lit("images/"), F.when(k % 2 == 0, "ORG-upper-cam-1_20250101_000000_M").otherwise("odd"), F.lit("/f.jpg"))
    split = F.concat(F.when(k % 3 == 0, "x/all/").otherwise("x/val/"), F.lit("ORG-upper-cam-1_20250101_000000_M/f.jpg"))
    paths = N.packed_paths("train", F.col("relpath"))
    return m.select("doc_id", N.path_stem(F.col("relpath")).alias("stem"), paths["label"].alias("label"), paths["image"].alias("image"), N.rebase(F.concat(F.lit("//"), "relpath"), "/root/").alias("path"), N.site_of_relpath(image).alias("site"), N.site_of_relpath(split, "split").alias("split_site"))


@query("""SELECT s_suppkey, concat('A-B-', CAST(s_suppkey AS VARCHAR)) AS clean, CASE WHEN s_suppkey % 4 > 0 THEN concat('ORG-weir-', CAST(s_suppkey AS VARCHAR), '_20250604_03', lpad(CAST(s_suppkey % 60 AS VARCHAR), 2, '0'), '05_M') END AS stem,
concat('ORG-a-cam-', CAST(s_suppkey AS VARCHAR), '_20250101_00', lpad(CAST((s_suppkey % 3600) // 60 AS VARCHAR), 2, '0'), lpad(CAST(s_suppkey % 60 AS VARCHAR), 2, '0'), '_M') AS moved,
concat('v_Eabcdef01_p', lpad(CAST(s_suppkey % 900 AS VARCHAR), 3, '0')) AS part, CASE WHEN s_suppkey % 2 = 0 THEN 'x' END AS value, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'missing: device' END AS error FROM supplier""")
def built_names(spark: SparkSession, d: str) -> DataFrame:
    s, k = spark.read.parquet(f"{d}/supplier.parquet"), F.col("s_suppkey")
    text = k.cast("string")
    time = F.when(k % 4 == 0, "noon").otherwise(F.concat(F.lit("3:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":05")))
    clip = F.struct(F.lit("ORG").alias("org"), F.lit("s").alias("site"), F.when(k % 2 == 0, "cam").alias("device"))
    name = F.concat(F.lit("ORG-a-cam-"), text, F.lit("_20250101_000000_M"))
    return s.select(
        k, N.sanitize(F.concat(F.lit(" _A  B!/"), text, F.lit("- "))).alias("clean"), N.construct_stem(F.lit(" ORG"), F.lit("weir "), text, F.lit("2025-06-04"), time).alias("stem"), N.shift_name_ts(name, (k % 3600) * 10 + 3, F.lit(10.0)).alias("moved"),
        N.event_clip_name(F.lit("v"), F.lit("abcdef0123"), (k % 900).cast("int")).alias("part"), S.norm_value(F.when(k % 2 == 0, " x ").otherwise(" na")).alias("value"), N.resolve_identity(clip)["error"].alias("error"),
    )


@query("""SELECT stem, frame, class_id, round(w, 6) AS w, round(h, 6) AS h, round((w + 10) / 1000, 6) AS mot_w, round((frame + (w + 10) / 2) / 1000, 6) AS mot_x, round(stem % 10 + w / 2, 6) AS cx, sqrt(w * w + h * h) <= 0.1 AS near,
CASE WHEN class_id = 1 THEN '1.0' ELSE '0.5' END AS clamped FROM @boxes b""")
def box_lines(spark: SparkSession, d: str) -> DataFrame:
    b = view(spark, d, "boxes").withColumn("line", F.concat_ws(" ", F.lit(""), F.col("class_id").cast("string"), S.fmt6(F.lit(0.5)), S.fmt6(F.lit(0.5)), F.col("w").cast("string"), F.col("h").cast("string"), F.lit("more")))
    p, m = B.parse_label_line(F.col("line")), B.mot_to_center(F.col("frame"), F.lit(0), F.col("w") + 10, F.col("h"), F.lit(1000), F.lit(1000))
    line = B.clamp_label_line(F.concat_ws(" ", F.lit("3 0.1"), F.when(F.col("class_id") == 1, "1.25").otherwise("0.5"), F.lit("0.1 0.2")))
    zero = F.lit(0.0)
    out = b.where(B.is_label_line(F.col("line"))).select(
        "stem", "frame", p["class_id"].alias("class_id"), p["w"].alias("w"), p["h"].alias("h"), m["w"].alias("mot_w"), m["xc"].alias("mot_x"), B.centroid(F.col("stem") % 10, zero, F.col("w"), zero)["cx"].alias("cx"),
        B.within_radius(zero, zero, F.col("w"), F.col("h"), 0.1).alias("near"), F.get(F.split(line, " "), 2).alias("clamped"),
    )
    return rounded(out, "w", "h", "mot_w", "mot_x", "cx", digits=6)


@query("""WITH l AS (SELECT stem, frame, CASE site WHEN '1-URGENT' THEN 'coho' WHEN '2-HIGH' THEN 'Coho' WHEN '3-MEDIUM' THEN 'Pink' ELSE 'odd' END AS label FROM @boxes b),
c AS (SELECT stem, frame, CASE label WHEN 'coho' THEN 'Coho' ELSE label END AS label FROM l) SELECT stem, frame, label, CASE label WHEN 'Pink' THEN 0 ELSE 1 END AS class_id FROM c WHERE label IN ('Pink', 'Coho')""")
def projected_labels(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("site") == "1-URGENT", "coho").when(F.col("site") == "2-HIGH", "Coho").when(F.col("site") == "3-MEDIUM", "Pink").otherwise("odd")
    rows = view(spark, d, "boxes").select("stem", "frame", B.remap_labels(label, {"coho": "Coho"}).alias("label"))
    return B.project_labels(rows, ["Pink", "Coho", "Chum"])


@query("""SELECT event_id, epoch_us(date_trunc('second', ts)) + 544000 AS us, event_type AS level, concat('run.py:', CAST(event_id % 90 AS VARCHAR)) AS module,
CASE WHEN user_id % 2 = 0 THEN concat('BGSub: ', CAST(event_id AS VARCHAR), ' - x') ELSE 'restart' END AS message, user_id % 2 = 0 AS healthy FROM events WHERE event_type <> 'view'""")
def log_lines(spark: SparkSession, d: str) -> DataFrame:
    e, k = spark.read.parquet(f"{d}/events.parquet"), F.col("event_id").cast("string")
    message = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("BGSub: "), k, F.lit(" - x"))).otherwise("restart")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",544 - "), "event_type", F.lit(" [run.py:"), (F.col("event_id") % 90).cast("string"), F.lit("] - "), message)
    rows = e.select("event_id", runs.parse_log_line(F.when(F.col("event_type") == "view", "short line").otherwise(line)).alias("p")).where("p is not null")
    return rows.select("event_id", F.unix_micros("p.ts").alias("us"), "p.level", "p.module", "p.message", runs.is_healthy(F.col("p.message")).alias("healthy"))


@query("""WITH k AS (SELECT DISTINCT left(relpath, length(relpath) - 10) AS task FROM @manifest m), n AS (SELECT count(*) AS n FROM k), r AS (SELECT task, row_number() OVER (ORDER BY md5(concat_ws('|', '8', task)), task) AS r FROM k)
SELECT task, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.85) THEN 'val' ELSE 'test' END AS split, (SELECT count(*) FROM @manifest m WHERE left(relpath, length(relpath) - 10) = task) AS n FROM r, n""")
def split_by_task(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "manifest").drop("split").withColumn("task", sampling.task_prefix(F.col("relpath")))
    return sampling.random_split(m, "task", seed=8).groupBy("task", "split").agg(F.count("*").alias("n"))
