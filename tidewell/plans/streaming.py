"""Streaming queries, run over all input there is."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.adapters import sql
from tidewell.session import shared_dir
from tidewell.sources.readers import decoded
from tidewell.streaming import streams

OUTAGES = """
WITH r AS (SELECT *, sum(CASE WHEN restart THEN 1 ELSE 0 END) OVER (PARTITION BY device ORDER BY ts, pos) AS run FROM @logs l),
g AS (SELECT device, run, epoch_us(min(ts)) AS restart_us, epoch_us(max(ts) FILTER (healthy)) AS healthy_us FROM r WHERE run > 0 GROUP BY 1, 2),
n AS (SELECT *, lead(restart_us) OVER (PARTITION BY device ORDER BY run) AS next_us FROM g)
SELECT CAST(device AS STRING) AS device, restart_us, healthy_us, next_us FROM n WHERE healthy_us IS NOT NULL AND next_us IS NOT NULL AND next_us - healthy_us >= 3600000000"""


MOTION = """
WITH RECURSIVE m AS (SELECT camera, {frame} AS frame, has_motion AS moves, row_number() OVER (PARTITION BY camera ORDER BY {frame}) AS i, max({frame}) OVER (PARTITION BY camera) AS last FROM @motion m),
s AS (
  SELECT camera, CAST(0 AS BIGINT) AS i, 0 AS quiet, CAST(-1 AS BIGINT) AS start, CAST(-1 AS BIGINT) AS c0, CAST(-1 AS BIGINT) AS c1, CAST(NULL AS VARCHAR) AS reason FROM (SELECT DISTINCT camera FROM m) c
  UNION ALL
  SELECT s.camera, m.i,
    CASE WHEN m.i <= 2 OR moves OR s.start < 0 THEN 0 WHEN s.quiet + 1 > 2 THEN 0 ELSE s.quiet + 1 END,
    CASE WHEN m.i <= 2 THEN -1 WHEN moves THEN CASE WHEN s.start < 0 THEN m.frame WHEN m.frame - s.start > {longest} THEN -1 ELSE s.start END
         WHEN s.start >= 0 AND s.quiet + 1 > 2 THEN -1 ELSE s.start END,
    s.start, m.frame,
    CASE WHEN m.i <= 2 OR s.start < 0 THEN NULL WHEN moves THEN CASE WHEN m.frame - s.start > {longest} THEN 'length' END WHEN s.quiet + 1 > 2 THEN 'quiet' END
  FROM s JOIN m ON m.camera = s.camera AND m.i = s.i + 1
)"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a file stream; the glob lets it be one file or a folder of files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


#: How late rows of the queries below come, in seconds.
LATE = 3 * 3600


def _shuffled_events(spark: SparkSession, d: str, files: int = 4) -> DataFrame:
    """The events as a file stream in which each comes up to LATE seconds after its time, by a hash of its id.

    So batches overlap in time. Each batch is written by itself, as file streams take files by their age.
    """
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    came = e.withColumn("came", F.unix_micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(LATE * 1_000_000)))
    ends = came.agg(F.min("came").alias("lo"), (F.max("came") + 1).alias("hi")).first()
    path, width, parts = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}/in", (ends["hi"] - ends["lo"]) / files, spark.sparkContext.defaultParallelism
    for i in range(files):
        lo, hi = ends["lo"] + int(i * width), ends["lo"] + int((i + 1) * width) if i + 1 < files else ends["hi"]
        came.where((F.col("came") >= lo) & (F.col("came") < hi)).drop("came").repartition(parts).write.mode("append").parquet(path)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", parts).parquet(path)


def _run(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    streams.run_available(stream, f"{base}/out", f"{base}/checkpoint", mode)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return spark.read.schema(fields if mode == "append" else f"{fields}, batch int").parquet(f"{base}/out")


def outage_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select(F.col("user_id").alias("device"), "ts", F.col("event_id").alias("pos"), (F.col("event_type") == "signup").alias("restart"), F.col("event_type").isin("click", "view").alias("healthy"))
    return _run(spark, streams.outage_stream(e, "device", "ts", "pos", "restart", "healthy", 3600))


def motion_clip_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select(F.col("user_id").alias("camera"), F.unix_micros("ts").alias("frame"), (F.col("value") > 50).alias("moves"))
    return _run(spark, streams.motion_clip_stream(e, "camera", "frame", "moves", fps=2.0, delay=1.0, longest=1e9))


def crossing_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select("ts", F.date_format("ts", "yyyy-MM-dd").alias("clip"), (F.col("user_id") % 7).alias("track"), "event_id", F.col("value").alias("x"), F.col("event_type").alias("cls"))
    return _run(spark, streams.crossing_stream(e, "clip", "track", "ts", "event_id", "x", "cls", 50.0, 3600, "10 minutes"))


def event_parts_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select("ts", (F.col("user_id") % 3).alias("site"), F.col("user_id").alias("camera"), (F.col("value") > 50).alias("moves"))
    return _run(spark, streams.event_parts(e, "site", "camera", "ts", "moves", 3600, 7200, "10 minutes"))


def event_group_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select("ts", (F.col("user_id") % 40).alias("event"))
    return _run(spark, streams.event_groups(e, "event", "ts", "30 minutes", "10 minutes")).select("event", F.unix_micros("start").alias("start_us"), "n_parts")


def stalled_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select("ts", (F.col("user_id") % 20).alias("output"), F.floor("value").alias("size"))
    return _run(spark, streams.stalled_outputs(e, "output", "ts", "size", 7200, "10 minutes"))


def late_outage_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _shuffled_events(spark, d).select(F.col("user_id").alias("device"), "ts", F.col("event_id").alias("pos"), (F.col("event_type") == "signup").alias("restart"), F.col("event_type").isin("click", "view").alias("healthy"))
    return _run(spark, streams.outage_stream(e, "device", "ts", "pos", "restart", "healthy", 3600, late=f"{LATE} seconds"))


def late_motion_clip_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _shuffled_events(spark, d).select(F.col("user_id").alias("camera"), "ts", F.unix_micros("ts").alias("frame"), (F.col("value") > 50).alias("moves"))
    return _run(spark, streams.motion_clip_stream(e, "camera", "frame", "moves", fps=2.0, ts="ts", late=f"{LATE} seconds", delay=1.0, longest=1e9))


def late_crossing_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _shuffled_events(spark, d).select("ts", F.date_format("ts", "yyyy-MM-dd").alias("clip"), (F.col("user_id") % 7).alias("track"), "event_id", F.col("value").alias("x"), F.col("event_type").alias("cls"))
    return _run(spark, streams.crossing_stream(e, "clip", "track", "ts", "event_id", "x", "cls", 50.0, 3600, f"{LATE} seconds"))


def late_event_parts_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _shuffled_events(spark, d).select("ts", (F.col("user_id") % 3).alias("site"), F.col("user_id").alias("camera"), (F.col("value") > 50).alias("moves"))
    return _run(spark, streams.event_parts(e, "site", "camera", "ts", "moves", 3600, 7200, f"{LATE} seconds"))


def late_stalled_stream(spark: SparkSession, d: str) -> DataFrame:
    """Outputs are expected from the first time that their users are seen; a fifth of them never report."""
    e = _shuffled_events(spark, d).select("ts", (F.col("user_id") % 25).alias("output"), F.floor("value").alias("size"))
    all_events = spark.read.parquet(f"{d}/events.parquet").select((F.col("user_id") % 25).alias("output"), F.col("ts").cast("timestamp").alias("ts"))
    reports = e.withWatermark("ts", f"{LATE} seconds").where(F.when(F.col("ts").isNotNull(), F.col("output") < 20))
    return _run(spark, streams.stalled_outputs(reports, "output", "ts", "size", 7200, None, all_events))


def camera_clips_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _shuffled_events(spark, d).select("ts", (F.col("user_id") % 2).alias("site"), (F.col("user_id") % 3).alias("camera"), (F.col("value") > 80).alias("moves"))
    return _run(spark, streams.camera_clips(e, "site", "camera", "ts", "moves", 6 * 3600, 8 * 3600, 1, f"{LATE} seconds"))


def watched_clips(spark: SparkSession, d: str) -> DataFrame:
    """Files of document ids by source as clips, whose lines are counted. Half of the sources fail at first, and are tried again."""
    base = f"{shared_dir(spark)}/watch-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    docs.select(F.coalesce("source", F.lit("none")).alias("source"), F.col("doc_id").cast("string").alias("value")).write.partitionBy("source").text(f"{base}/clips")

    def count(clips: DataFrame) -> DataFrame:
        lines = spark.read.option("recursiveFileLookup", True).text(f"{base}/clips").groupBy(decoded(F.col("_metadata.file_path")).alias("path")).agg(F.count("*").alias("n"))
        fails = (F.col("attempt") == 0) & (F.length(F.regexp_extract("path", "source=([^/]*)/", 1)) % 2 == 0)
        return clips.join(lines, "path").select("path", "size", "modified", F.when(fails, F.lit("not readable")).alias("error"), F.when(~fails, F.col("n")).alias("n"))

    for _ in range(2):
        streams.watch_clips(spark, f"{base}/clips", f"{base}/ledger", f"{base}/checkpoint", count, "part-*", 0).awaitTermination()
    done = streams.ledger_results(spark, f"{base}/ledger")
    return done.groupBy(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source")).agg(F.sum("n").alias("n"), F.max("failures").alias("failures"))


def numbered_outages(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select(F.col("user_id").alias("device"), "ts", F.col("event_id").alias("pos"), (F.col("event_type") == "signup").alias("restart"), F.col("event_type").isin("click", "view").alias("healthy"))
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    streams.write_outages(streams.outage_stream(e, "device", "ts", "pos", "restart", "healthy", 3600), f"{base}/out", f"{base}/checkpoint", ["next_us", "device", "restart_us"])
    return spark.read.schema("device string, restart_us long, healthy_us long, next_us long, incident long, batch int").parquet(f"{base}/out").drop("batch")


def resample_stream(spark: SparkSession, d: str) -> DataFrame:
    out = _run(spark, streams.resample_stream(_events(spark, d), "ts", "value", "1 hour", "10 minutes"))
    return out.select(F.unix_timestamp("start").alias("start_s"), F.round("mean", 4).alias("mean"), "n")


def session_stream(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).where("value > 50").withColumn("site", F.col("user_id") % 3)
    out = _run(spark, streams.event_sessions(e, "site", "ts", "user_id", "1 hour", "10 minutes"))
    return out.select("site", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n_frames")


SESSIONS = """
WITH e AS (SELECT user_id % 3 AS site, epoch_us(ts) AS us FROM events WHERE value > 50), n AS (SELECT *, CASE WHEN us - lag(us) OVER w < 3600000000 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY site ORDER BY us)),
g AS (SELECT *, sum(new) OVER (PARTITION BY site ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM n),
s AS (SELECT site, min(us) AS start_us, max(us) + 3600000000 AS end_us, count(*) AS n_frames FROM g GROUP BY site, g)
SELECT * FROM s WHERE end_us <= (SELECT max(us) - 600000000 FROM e)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (outage_stream, motion_clip_stream, crossing_stream, resample_stream, session_stream, event_parts_stream, event_group_stream, stalled_stream, numbered_outages, late_outage_stream, late_motion_clip_stream, late_crossing_stream, late_event_parts_stream, late_stalled_stream, camera_clips_stream, watched_clips)}
SQL = {
    "watched_clips": "SELECT coalesce(source, 'none') AS source, count(*) AS n, CASE WHEN length(coalesce(source, 'none')) % 2 = 0 THEN 1 ELSE 0 END AS failures FROM documents GROUP BY 1",
    "outage_stream": sql(OUTAGES),
    "session_stream": SESSIONS,
    "motion_clip_stream": sql(MOTION.format(frame="epoch_us(ts)", longest="2000000000")) + """
SELECT CAST(camera AS VARCHAR) AS camera, c0 AS start, c1 AS "end", reason FROM s WHERE reason IS NOT NULL""",
    "crossing_stream": """
WITH e AS (SELECT CAST(CAST(ts AS DATE) AS STRING) AS clip, user_id % 7 AS track, epoch_us(ts) AS us, event_id, value, event_type FROM events),
n AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 3600000000 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY clip, track ORDER BY us, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY clip, track ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS g FROM n),
v AS (SELECT clip, track, g, event_type, count(*) AS c, min(us) AS f FROM g GROUP BY 1, 2, 3, 4),
b AS (SELECT clip, track, g, event_type AS cls FROM (SELECT *, row_number() OVER (PARTITION BY clip, track, g ORDER BY c DESC, f) AS r FROM v) t WHERE r = 1),
t AS (SELECT clip, track, g, min(us) AS start_us, max(us) AS end_us, count(*) AS n, arg_min(value, (us, event_id)) AS first_x, arg_max(value, (us, event_id)) AS last_x FROM g GROUP BY 1, 2, 3),
l AS (SELECT *, lead(g) OVER (PARTITION BY clip, track ORDER BY g) IS NOT NULL AS later FROM t)
SELECT clip, track, start_us, n, first_x, last_x, cls, CASE WHEN first_x < 50 AND last_x >= 50 THEN 'r' WHEN first_x > 50 AND last_x <= 50 THEN 'l' END AS direction FROM l JOIN b USING (clip, track, g)
WHERE later OR end_us + 3600000000 < (SELECT max(us) - 600000000 FROM e)""",
    "event_parts_stream": """
WITH a AS (SELECT CAST(user_id % 3 AS STRING) AS site, CAST(user_id AS STRING) AS camera, epoch_us(ts) AS us, value FROM events), e AS (SELECT * FROM a WHERE value > 50),
n AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 3600000000 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY site ORDER BY us, camera)),
g AS (SELECT *, sum(new) OVER (PARTITION BY site ORDER BY us, camera ROWS UNBOUNDED PRECEDING) AS g FROM n), o AS (SELECT *, min(us) OVER (PARTITION BY site, g) AS opened, max(us) OVER (PARTITION BY site, g) AS ended FROM g),
p AS (SELECT site, g, opened, any_value(ended) AS ended, (us - opened) // 7200000000 AS part, min(us) AS start_us, max(us) AS end_us, count(DISTINCT camera) AS n_cameras FROM o GROUP BY site, g, opened, part),
l AS (SELECT *, max(g) OVER (PARTITION BY site) > g OR max(part) OVER (PARTITION BY site, g) > part AS later FROM p)
SELECT site, sha1(concat_ws('|', site, CAST(opened AS VARCHAR))) AS event_id, part, start_us, end_us, n_cameras FROM l WHERE later OR ended + 3600000000 < (SELECT max(us) - 600000000 FROM a)""",
    "event_group_stream": """
WITH e AS (SELECT user_id % 40 AS event, epoch_us(ts) AS us FROM events), n AS (SELECT *, CASE WHEN us - lag(us) OVER w < 1800000000 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY event ORDER BY us)),
g AS (SELECT *, sum(new) OVER (PARTITION BY event ORDER BY us ROWS UNBOUNDED PRECEDING) AS g FROM n)
SELECT event, min(us) AS start_us, count(*) AS n_parts FROM g GROUP BY event, g HAVING max(us) + 1800000000 <= (SELECT max(us) - 600000000 FROM e)""",
    "stalled_stream": """
WITH e AS (SELECT CAST(user_id % 20 AS STRING) AS key, epoch_us(ts) AS us, CAST(floor(value) AS BIGINT) AS size FROM events),
m AS (SELECT *, coalesce(max(size) OVER (PARTITION BY key ORDER BY us, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS most, lag(us) OVER (PARTITION BY key ORDER BY us, size) AS last FROM e),
g AS (SELECT *, max(CASE WHEN size > most THEN us END) OVER (PARTITION BY key ORDER BY us, size ROWS UNBOUNDED PRECEDING) AS grown FROM m)
SELECT key, 'absent' AS kind, last AS since_us FROM m WHERE us - last > 7200000000
UNION ALL SELECT DISTINCT key, 'stalled', grown FROM g WHERE size <= most AND us - grown >= 7200000000
UNION ALL SELECT key, 'absent', max(us) FROM e GROUP BY 1 HAVING max(us) + 7200000000 < (SELECT max(us) - 600000000 FROM e)""",
    "numbered_outages": sql(f"WITH o AS ({OUTAGES}) SELECT *, row_number() OVER (ORDER BY next_us, device, restart_us) AS incident FROM o"),
    "resample_stream": """
WITH w AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start_s, round(avg(value), 4) AS mean, count(value) AS n FROM events GROUP BY 1)
SELECT * FROM w WHERE start_s + 3600 <= (SELECT epoch(max(ts)) - 600 FROM events)""",
}


def _until_watermark(text: str) -> str:
    """The twin of a query over what the watermark has passed in the end: rows behind it still wait."""
    text = text.strip().removeprefix("WITH RECURSIVE ").removeprefix("WITH ").replace("FROM events", "FROM passed")
    for source in ("e", "a"):
        text = text.replace(f"(SELECT max(us) - 600000000 FROM {source})", "(SELECT w FROM mark)")
    return f"WITH RECURSIVE mark AS (SELECT max(epoch_us(ts)) // 1000 * 1000 - {LATE * 1_000_000} AS w FROM events), passed AS (SELECT * FROM events WHERE epoch_us(ts) <= (SELECT w FROM mark)), {text}"


SQL |= {f"late_{name}": _until_watermark(SQL[name]) for name in ("outage_stream", "motion_clip_stream", "crossing_stream", "event_parts_stream")}
SQL["late_stalled_stream"] = _until_watermark("""
WITH first AS (SELECT user_id % 25 AS key, min(epoch_us(ts)) AS since FROM (TABLE events) t GROUP BY 1),
e AS (SELECT user_id % 25 AS key, epoch_us(ts) AS us, CAST(floor(value) AS BIGINT) AS size FROM events WHERE user_id % 25 < 20),
m AS (SELECT *, coalesce(max(size) OVER (PARTITION BY key ORDER BY us, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS most, coalesce(lag(us) OVER (PARTITION BY key ORDER BY us, size), since) AS last FROM e JOIN first USING (key)),
g AS (SELECT *, max(CASE WHEN size > most THEN us END) OVER (PARTITION BY key ORDER BY us, size ROWS UNBOUNDED PRECEDING) AS grown FROM m),
r AS (SELECT key, 'absent' AS kind, last AS since_us FROM m WHERE us - last > 7200000000
UNION ALL SELECT DISTINCT key, 'stalled', grown FROM g WHERE size <= most AND us - grown >= 7200000000
UNION ALL SELECT key, 'absent', coalesce(max(us), any_value(since)) FROM first LEFT JOIN e USING (key) GROUP BY key HAVING coalesce(max(us), any_value(since)) + 7200000000 < (SELECT max(us) - 600000000 FROM e))
SELECT CAST(key AS VARCHAR) AS key, kind, since_us FROM r""")
