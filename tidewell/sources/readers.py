"""Readers of annotation, label, count, log and measurement files. All work is done by Spark's readers; schemas are given,
and number fields that may come as text are read as text and cast."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions import boxes as B
from tidewell.functions import names as N
from tidewell.functions.scalars import safe_double
from tidewell.operators.ordered import with_running
from tidewell.session import materialize
from tidewell.sources.json_array import SPLIT_BYTES, read_json_array
from tidewell.sources.listing import list_files

SEQUENCE = "array<struct<enabled: boolean, frame: double, x: double, y: double, width: double, height: double>>"
RESULT = f"array<struct<type: string, from_name: string, to_name: string, value: struct<labels: array<string>, framesCount: string, sequence: {SEQUENCE}>>>"
TASK = f"id long, data map<string, string>, annotations array<struct<updated_at: string, result: {RESULT}>>"
MOT = "frame_name string, track_id int, left double, top double, width double, height double, conf double, class_id int, visibility double"


def _path() -> F.Column:
    return F.col("_metadata.file_path")


def read_headed(spark: SparkSession, path: str | Sequence[str], glob: str | None = None, each: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of CSV files of differing headers, each file read by its own, all columns as text, and file_path.

    Files of equal headers are read together, so there is a read for each header there is; what ``each`` makes of one such
    read is put together by name. Columns are in the order they are first seen, by file; a byte order mark and spaces
    around names are dropped; a column that a file lacks is null. glob: names of files wanted in all folders below path.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": glob} if glob else {}
    lines = spark.read.options(**options).text(path if isinstance(path, str) else list(path)).where("_metadata.file_block_start = 0")
    first = lines.select(_path().alias("file"), F.monotonically_increasing_id().alias("i"), "value").groupBy("file").agg(F.min_by("value", "i").alias("head"))
    by_header: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():  # as many rows as the file listing, which the driver holds anyway
        by_header.setdefault(r["head"].lstrip("\ufeff"), []).append(unquote(r["file"]))
    if not by_header:
        raise ValueError(f"no file with a header: {path}")
    parts = []
    for files in by_header.values():
        raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(files).withColumn("file_path", _path())
        named = raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns])
        parts.append(each(named) if each else named)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_tasks(spark: SparkSession, path: str, strict: bool = False, glob: str = "*.json", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file_path, item_pos, id, data, annotations, error): tasks of files that hold a list of tasks, or (unless strict) one.

    A file that can't be read, or isn't such a list, gives one row with an error. Large files are read by several tasks.
    """
    rows = read_json_array(spark, path, TASK, glob, single=not strict, split_bytes=split_bytes)
    error = F.when(F.col("error") == "no list", "no list of tasks").otherwise(F.col("error"))
    return rows.select(_url("path").alias("file_path"), "item_pos", "item.*", error.alias("error"))


def _url(path: str) -> F.Column:
    """A listed path as Spark's readers give it."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def _good(rows: DataFrame) -> DataFrame:
    """Elements, without the rows of files that could not be read."""
    return rows.where("error is null")


def _fields(schema: str) -> list[str]:
    """Top-level fields of a schema string."""
    out, depth, at = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            out.append(schema[at:i].strip())
            at = i + 1
    return [*out, schema[at:].strip()]


def keyframes(tasks: DataFrame, from_name: str | None = None, to_name: str | None = None) -> DataFrame:
    """(file_path, item_pos, video_stem, track_pos, kf_pos, label, frame, x, y, w, h, enabled) of each task's latest annotation.

    from_name, to_name: only results of that control and that object.
    """
    latest = F.element_at(F.array_sort(F.transform("annotations", lambda a, i: F.struct(a["updated_at"].alias("u"), (-i).alias("i"), a["result"].alias("r")))), -1)["r"]
    video = N.path_stem(F.coalesce(F.col("data")["metadata_file_filename"], F.col("data")["video"], F.lit("unknown.mp4")))
    rows = tasks.where("annotations is not null and size(annotations) > 0").select("file_path", "item_pos", video.alias("video_stem"), F.posexplode(latest).alias("track_pos", "r"))
    for name, wanted in (("from_name", from_name), ("to_name", to_name)):
        rows = rows.where(F.col("r")[name] == wanted) if wanted is not None else rows
    rows = rows.where(F.col("r.type") == "videorectangle").select("file_path", "item_pos", "video_stem", "track_pos", F.get("r.value.labels", 0).alias("label"), F.posexplode("r.value.sequence").alias("kf_pos", "k"))
    return rows.select("file_path", "item_pos", "video_stem", "track_pos", "kf_pos", "label", F.col("k.frame").cast("int").alias("frame"), F.col("k.x").alias("x"), F.col("k.y").alias("y"), F.col("k.width").alias("w"), F.col("k.height").alias("h"), F.col("k.enabled").alias("enabled"))


CONDITION_IDS = ("Project", "Site", "Camera", "Filename", "Date", "Time", "Notes:", "Image Link:")  # fixed values: columns that are no conditions


def read_conditions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(video_stem, task_id, conditions): rows whose fixed fields and time can be read; the other columns as a map."""
    rows = read_headed(spark, paths)
    dynamic = [c for c in rows.columns if c not in (*CONDITION_IDS, "file_path")]
    value = lambda c: F.when(~F.upper(F.trim(F.col(f"`{c}`"))).isin("", "NA"), F.trim(F.col(f"`{c}`")))
    conditions = F.map_filter(F.create_map(*[x for c in dynamic for x in (F.lit(c.strip()), value(c))]) if dynamic else F.create_map().cast("map<string,string>"), lambda k, v: v.isNotNull())
    stem = N.construct_stem(*[value(c) for c in ("Project", "Site", "Camera", "Date", "Time")])
    return rows.select(stem.alias("video_stem"), value("Filename").alias("task_id"), conditions.alias("conditions")).where("video_stem is not null and task_id is not null")


def read_video_metadata(spark: SparkSession, path: str) -> DataFrame:
    rows = read_headed(spark, path).drop("file_path").where(F.trim("video_stem") != "")
    return rows.withColumns({c: F.col(c).try_cast(t) for c, t in (("fps", "double"), ("nb_frames", "long"), ("duration", "double"), ("width", "int"), ("height", "int")) if c in rows.columns})


def read_label_files(spark: SparkSession, root: str) -> DataFrame:
    """(video_stem, frame_idx, box_pos, class_id, xc, yc, w, h) of a tree ``<stem>/frame_N.txt``.

    Files are listed, and their lines read by line and joined with the listing: so files without a readable line, or of no
    bytes at all, give one row without a box, and no file is held whole. Places of boxes count readable lines only.
    """
    files = list_files(spark, root, "frame_*.txt").select("path")
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "frame_*.txt").text(root)
    # lines of one file come in order within a block, and blocks by their start
    own = lines.where(B.is_label_line(F.col("value"))).select(decoded(_path()).alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("i"), B.parse_label_line(F.col("value")).alias("b"))
    place = F.row_number().over(Window.partitionBy("path").orderBy("start", "i")) - 1
    boxes = own.select("path", place.alias("box_pos"), "b")
    parts = F.split("path", "/")
    rows = files.join(boxes, "path", "left").select(F.element_at(parts, -2).alias("video_stem"), N.parse_frame_idx(F.element_at(parts, -1)).alias("frame_idx"), "box_pos", "b")
    return rows.select("video_stem", "frame_idx", "box_pos", "b.class_id", "b.xc", "b.yc", "b.w", "b.h")


def decoded(path: F.Column) -> F.Column:
    """A reader's path as the listing has it: without escapes, and with one slash behind file:."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def read_manifest(spark: SparkSession, path: str, split: str) -> DataFrame:
    lines = spark.read.text(path).select(F.trim("value").alias("relpath")).where("length(relpath) > 0")
    return lines.select(F.lit(split).alias("split"), "relpath", N.parse_manifest_relpath(F.col("relpath")).alias("p")).select("split", "relpath", "p.*")


def read_class_map(spark: SparkSession, path: str) -> dict[str, int]:
    """label -> number from the ``names:`` list or map of a YAML file, read by Spark. ValueError where there is none."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.posexplode(F.split(F.regexp_extract("value", r"(?s)(?:^|\n)names:[ \t]*\n((?:[ \t]*(?:-|\d+:)[^\n]*\n?)+)", 1), "\n")).alias("i", "l")).where("trim(l) <> ''")
    named = rows.select("i", F.regexp_extract("l", r"^\s*(\d+):", 1).try_cast("int").alias("n"), F.trim(F.regexp_replace("l", r"^\s*(?:-|\d+:)\s*", ""), F.lit(" '\"")).alias("name")).orderBy("i").collect()
    if not named:
        raise ValueError("no names in the class map")
    return {r["name"]: (i if r["n"] is None else r["n"]) for i, r in enumerate(named)}


def read_logs(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """(org, site, device, file, file_date, line_no, ts, level, module, message) of log lines that can be read.

    Lines are read by themselves, so a log of any size is split over tasks; line_no grows with the line's place in its file.
    """
    from tidewell.operators.runs import parse_log_line

    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    # a split starts at as many bytes as there can be lines before it, and only a file's last split shares its task
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = lines.select(_path().alias("file"), (F.col("_metadata.file_block_start") + within).alias("line_no"), parse_log_line(F.col("value")).alias("p")).where("p is not null")
    who = [F.regexp_extract("file", r"/hdd/([^/]+)/([^/]+)/([^/]+)/", i).alias(n) for i, n in ((1, "org"), (2, "site"), (3, "device"))]
    return rows.select(*who, "file", N.file_date(F.col("file")).alias("file_date"), "line_no", "p.*")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(filename, direction, species, n) of wide tables l_<species>, r_<species>; a species that a file lacks has no row."""
    from tidewell.operators.counts import counts_long

    def long(wide: DataFrame) -> DataFrame:
        return counts_long(wide.withColumns({c: F.col(c).try_cast("long") for c in wide.columns if c[:2] in ("l_", "r_")}), "filename")

    return read_headed(spark, path, each=long)


def read_reviewed_counts(spark: SparkSession, path: str, key: str, site: str | None = None, sites: Sequence[str] = ()) -> DataFrame:
    """(key, n): row totals of the columns that end with __total__annotated; with a site column, only rows of the sites."""

    def total(wide: DataFrame) -> DataFrame:
        cells = [c for c in wide.columns if c.endswith("__total__annotated")]
        rows = wide.where(F.col(f"`{site}`").isin(list(sites))) if site else wide
        return rows.select(key, reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`").try_cast("long"), F.lit(0)) for c in cells], F.lit(0).cast("long")).alias("n"))

    return read_headed(spark, path, each=total)


def read_measurements(spark: SparkSession, root: str, glob: str, columns: Sequence[str]) -> DataFrame:
    """(ts, file, columns as doubles) of CSV files whose first column is epoch seconds."""

    def pick(raw: DataFrame) -> DataFrame:
        number = [(F.col(f"`{c}`").try_cast("double") if c in raw.columns else F.lit(None).cast("double")).alias(c) for c in columns]
        return raw.select(F.timestamp_seconds(F.col(f"`{raw.columns[0]}`").try_cast("double")).alias("ts"), F.col("file_path").alias("file"), *number)

    return read_headed(spark, root, glob, each=pick)


def read_weather(spark: SparkSession, path: str, time_column: str, rain_column: str, zone: str) -> DataFrame:
    raw = read_headed(spark, path)
    return raw.select(F.to_utc_timestamp(F.col(f"`{time_column}`").try_cast("timestamp"), zone).alias("ts"), F.col(f"`{rain_column}`").try_cast("double").alias("precip_mm"))


def read_latency(spark: SparkSession, path: str) -> DataFrame:
    """(ts, provider, region, latency): the third column of files in ``provider_region`` folders."""
    folder = F.element_at(F.split("file_path", "/"), -2)

    def pick(raw: DataFrame) -> DataFrame:
        return raw.select(F.timestamp_seconds(F.col(f"`{raw.columns[0]}`").try_cast("double")).alias("ts"), F.substring_index(folder, "_", 1).alias("provider"), F.substring_index(folder, "_", -1).alias("region"), F.col(f"`{raw.columns[2]}`").try_cast("double").alias("latency"))

    return read_headed(spark, path, "*.csv", each=pick)


def read_mot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MOT).csv(path)


def read_jde(spark: SparkSession, path: str) -> DataFrame:
    """(file, class_id, track_id, xc, yc, w, h)"""
    t = F.split(F.trim("value"), r"\s+")
    number = [F.get(t, i).try_cast(k).alias(n) for i, (n, k) in enumerate((("class_id", "int"), ("track_id", "int"), ("xc", "double"), ("yc", "double"), ("w", "double"), ("h", "double")))]
    return spark.read.option("recursiveFileLookup", True).text(path).where("trim(value) <> ''").select(_path().alias("file"), *number)


def read_datumaro(spark: SparkSession, path: str) -> DataFrame:
    """(file, item_pos, item, clip, label_id, track_id, x1, y1, x2, y2, cx, cy, w, h); boxes without a track are left out.

    Neighbouring items of one parent path are a clip of the file; a path that comes again later is another clip.
    """
    schema = "id string, annotations array<struct<label_id: int, bbox: array<double>, attributes: struct<track_id: string>>>"
    items = _good(read_json_array(spark, path, schema, "*", "items")).select(_url("path").alias("file"), "item_pos", F.col("item").alias("i")).withColumn("parent", F.regexp_extract("i.id", r"^(.*)/[^/]*$", 1))
    items = materialize(items, "items")
    before = items.select("file", (F.col("item_pos") + 1).alias("item_pos"), F.col("parent").alias("before"))
    marked = items.join(before, ["file", "item_pos"], "left").withColumn("new", F.coalesce((F.col("parent") != F.col("before")).cast("long"), F.lit(1)))
    items = with_running(marked, ["file"], ["item_pos"], {"clip": F.col("new")})
    rows = items.select("file", "item_pos", F.col("i.id").alias("item"), "clip", F.explode("i.annotations").alias("a"))
    x, y, w_, h = (F.get("a.bbox", i) for i in range(4))
    out = rows.select("file", "item_pos", "item", "clip", F.col("a.label_id").alias("label_id"), F.col("a.attributes.track_id").try_cast("long").alias("track_id"), x.alias("x1"), y.alias("y1"), (x + w_).alias("x2"), (y + h).alias("y2"), (x + w_ / 2).alias("cx"), (y + h / 2).alias("cy"), w_.alias("w"), h.alias("h"))
    return out.where("track_id is not null")


def read_tasks_min(spark: SparkSession, path: str) -> DataFrame:
    """(id, video, box): flat tasks; those without boxes keep a null box. Files that are no such list are left out."""
    schema = "id long, video string, box array<struct<sequence: array<struct<frame: double, x: double, y: double, width: double, height: double, enabled: boolean>>, labels: array<string>>>"
    return _good(read_json_array(spark, path, schema, "*", single=True)).select("item.*")


def read_trials(spark: SparkSession, root: str) -> DataFrame:
    """Epoch rows of ``<trial>/results.csv``, numbers as doubles."""
    raw = read_headed(spark, root, "results.csv")
    return raw.select(F.element_at(F.split("file_path", "/"), -2).alias("trial"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in raw.columns if c != "file_path"])


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    schema = "duration double, codec_name string, nb_frames long, width int, height int, start_time double, avg_frame_rate string, r_frame_rate string, event_id string, event_start_ts string, cam_name string, triggered_by string, part_number int"
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", _path())


CVAT_ATTRIBUTE = "array<struct<_name: string, _VALUE: string>>"
CVAT_IMAGE = f"_id long, _name string, box array<struct<_label: string, _xtl: double, _ytl: double, _xbr: double, _ybr: double, attribute: {CVAT_ATTRIBUTE}>>"


def read_cvat_xml(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """(file, image_id, image, box_pos, label, track_id, x1, y1, x2, y2) of the boxes of each image.

    track_id is the attribute __instance_id, or track_id. An image without boxes has one row without.
    """
    images = spark.read.format("xml").schema(CVAT_IMAGE).option("rowTag", "image").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    rows = images.select(_path().alias("file"), F.col("_id").alias("image_id"), F.col("_name").alias("image"), F.posexplode_outer("box").alias("box_pos", "b"))
    own = F.get(F.filter("b.attribute", lambda a: a["_name"].isin("__instance_id", "track_id")), 0)["_VALUE"]
    return rows.select("file", "image_id", "image", "box_pos", F.col("b._label").alias("label"), own.try_cast("long").alias("track_id"), *[F.col(f"b.{c}").alias(n) for c, n in (("_xtl", "x1"), ("_ytl", "y1"), ("_xbr", "x2"), ("_ybr", "y2"))])


CVAT_TRACK = f"_id long, _label string, box array<struct<_frame: long, _outside: int, _keyframe: int, _xtl: double, _ytl: double, _xbr: double, _ybr: double, attribute: {CVAT_ATTRIBUTE}>>"


def read_cvat_tracks(spark: SparkSession, path: str, glob: str = "*.xml", outside: bool = False) -> DataFrame:
    """(file, track, track_id, label, frame, keyframe, enabled, x1, y1, x2, y2) of the track form, where each track holds its boxes
    by frame.

    track_id is a box's attribute __instance_id, or track_id, or else its track's number. Boxes outside the picture are left out,
    unless outside is set: then they are rows that aren't enabled, as interpolate_tracks takes them.
    """
    found = spark.read.format("xml").schema(CVAT_TRACK).option("rowTag", "track").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    rows = found.select(_path().alias("file"), F.col("_id").alias("track"), F.col("_label").alias("label"), F.explode("box").alias("b"))
    own = F.get(F.filter("b.attribute", lambda a: a["_name"].isin("__instance_id", "track_id")), 0)["_VALUE"].try_cast("long")
    enabled, key = F.coalesce(F.col("b._outside") != 1, F.lit(True)), F.coalesce(F.col("b._keyframe") != 0, F.lit(True))
    ends = [F.col(f"b.{c}").alias(n) for c, n in (("_xtl", "x1"), ("_ytl", "y1"), ("_xbr", "x2"), ("_ybr", "y2"))]
    out = rows.select("file", "track", F.coalesce(own, "track").alias("track_id"), "label", F.col("b._frame").alias("frame"), key.alias("keyframe"), enabled.alias("enabled"), *ends)
    return out if outside else out.where("enabled")


def read_listing(spark: SparkSession, path: str, extensions: Sequence[str] = N.VIDEO_EXTENSIONS) -> DataFrame:
    """Paths of an object listing with a wanted extension, without folders, in order."""
    rows = spark.read.schema("Path string, Name string, IsDir boolean, Size long").option("multiLine", True).json(path)
    return rows.where(~F.coalesce("IsDir", F.lit(False)) & F.lower(F.element_at(F.split("Path", r"\."), -1)).isin(*extensions)).orderBy("Path")


def read_video_inventory(spark: SparkSession, path: str) -> DataFrame:
    rows = read_headed(spark, path)
    return rows.select(F.regexp_replace(F.concat_ws("/", "`File Path`", "`File Name`"), r"[\\/]+", "/").alias("path"))


def read_seqinfo(spark: SparkSession, path: str, glob: str = "seqinfo.ini") -> DataFrame:
    """(name, fps, length, width, height) of each sequence's information file."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    number = lambda k: F.regexp_extract("value", rf"{k}\s*=\s*([\d.]+)", 1)
    return text.select(F.trim(F.regexp_extract("value", r"name\s*=\s*([^\n]+)", 1)).alias("name"), *[number(k).try_cast(t).alias(n) for k, n, t in (("frameRate", "fps", "double"), ("seqLength", "length", "int"), ("imWidth", "width", "int"), ("imHeight", "height", "int"))])


def read_image_listing(spark: SparkSession, root: str) -> DataFrame:
    """(clip, path, pos, n_images): files only listed, not read; pos is a file's place in its clip by path, from 0."""
    files = list_files(spark, root).select("path")
    rows = files.withColumn("clip", F.element_at(F.split("path", "/"), -2))
    placed = with_running(rows, ["clip"], ["path"], {}, "place")
    sizes = placed.groupBy("clip").agg(F.max("place").alias("n_images"))
    return placed.join(sizes, "clip").select("clip", "path", (F.col("place") - 1).cast("int").alias("pos"), "n_images")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(frame_pos, name, kind, obj_pos, x, y, w, h): interesting objects and noises of each frame."""
    box = "array<struct<x: int, y: int, w: int, h: int>>"
    rows = read_json_array(spark, path, f"name string, bounding_boxes struct<interested_objects: {box}, noises: {box}>", "*", "metadata")
    frames = _good(rows).select(F.col("item_pos").alias("frame_pos"), F.col("item").alias("m"))
    parts = [frames.select("frame_pos", F.col("m.name").alias("name"), F.lit(k).alias("kind"), F.posexplode(f"m.bounding_boxes.{k}").alias("obj_pos", "b")) for k in ("interested_objects", "noises")]
    return parts[0].unionByName(parts[1]).select("frame_pos", "name", "kind", "obj_pos", "b.*")


def read_dataset_stats(spark: SparkSession, path: str) -> DataFrame:
    """(file, label, n) of JSON objects that map labels to counts."""
    text = spark.read.text(path, wholetext=True).withColumn("file", _path())
    return text.select("file", F.explode(F.from_json("value", "map<string,string>")).alias("label", "v")).select("file", "label", safe_double(F.col("v")).alias("n"))
