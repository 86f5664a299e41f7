"""Sinks: label texts, manifests, sharded sets, count tables and COCO documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import fmt6
from tidewell.operators import stats
from tidewell.operators.sampling import shard

#: Files that one task writes, about.
FILES = 500


def render_labels(boxes: DataFrame, frames: DataFrame, keys: Sequence[str], position: str = "box_pos") -> DataFrame:
    """(keys, text): label lines of every frame, in order, each ended by a newline; frames without boxes have empty text."""
    line = F.concat_ws(" ", F.col("class_id").cast("string"), *[fmt6(F.col(c)) for c in ("xc", "yc", "w", "h")])
    lines = boxes.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(position), line.alias("l")))), lambda x: F.concat(x["l"], F.lit("\n"))).alias("ls"))
    return frames.select(*keys).distinct().join(lines, list(keys), "left").select(*keys, F.coalesce(F.array_join("ls", ""), F.lit("")).alias("text"))


def write_shards(rows: DataFrame, path: str, order: Sequence[str], size: int, prefix: str = "shard") -> None:
    shard(rows, order, size, prefix).write.mode("errorifexists").partitionBy("shard").parquet(path)


def write_manifest(rows: DataFrame, path: str, column: str = "relpath") -> None:
    """Lines in order, in as many part files as the sort makes; their names keep the order."""
    rows.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("errorifexists").text(path)


def write_table(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    rows.write.mode("errorifexists").option("header", True).partitionBy(*partition_by).csv(path)


def stats_json(stats: DataFrame, site: str, cls: str) -> DataFrame:
    """(site, json): a site's class statistics as one document."""
    rest = [c for c in stats.columns if c not in (site, cls)]
    return stats.groupBy(site).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(cls).cast("string"), F.struct(*rest)))))).alias("json"))


def split_report(assignment: DataFrame, groups: DataFrame, group: str, frames: str, boxes: str) -> DataFrame:
    """(split, n_groups, n_frames, n_boxes)"""
    return assignment.join(groups, group).groupBy("split").agg(F.count("*").alias("n_groups"), F.sum(frames).alias("n_frames"), F.sum(boxes).alias("n_boxes"))


def empty_videos(videos: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    return videos.select(key).distinct().join(boxes.select(key).distinct(), key, "left_anti")


def to_coco(objects: DataFrame, frame: str, file_name: str, category: str, x: str = "x", y: str = "y", w: str = "w", h: str = "h", parts: int = 1) -> DataFrame:
    """(file_name, json): for each file its images, annotations and categories. Ids are hashes of what they name, so that
    parts made apart agree.

    parts: so many documents for each file, (file_name, part, json); images are dealt to them by a hash, each with all its
    annotations. A document is one row, so boxes of a file should be no more than a task can hold times the parts.
    """
    image = F.struct(F.xxhash64(file_name, frame).alias("id"), F.concat_ws("_", file_name, frame).alias("file_name"))
    note = F.struct(F.xxhash64(file_name, frame, x, y, w, h).alias("id"), F.xxhash64(file_name, frame).alias("image_id"), F.xxhash64(category).alias("category_id"), F.array(x, y, w, h).alias("bbox"), (F.col(w) * F.col(h)).alias("area"))
    kind = F.struct(F.xxhash64(category).alias("id"), F.col(category).alias("name"))
    doc = F.struct(F.array_sort(F.collect_set(image)).alias("images"), F.collect_list(note).alias("annotations"), F.array_sort(F.collect_set(kind)).alias("categories"))
    if parts == 1:
        return objects.groupBy(file_name).agg(F.to_json(doc).alias("json"))
    dealt = objects.withColumn("part", F.pmod(F.xxhash64(file_name, frame), F.lit(parts))).repartition(parts, file_name, "part")
    return dealt.groupBy(file_name, "part").agg(F.to_json(doc).alias("json"))


def bbox_rows(boxes: DataFrame, position: str, skip: int = 0) -> DataFrame:
    """(image, line): ``name conf x1 y1 x2 y2`` of every (skip + 1)-th image."""
    return boxes.where(F.col(position) % (skip + 1) == 0).select("image", F.concat_ws(" ", "cls", "conf", "x1", "y1", "x2", "y2").alias("line"))


def write_detections(detections: DataFrame, path: str, clip: str, columns: Sequence[str] = ("frame", "track", "x", "y", "w", "h", "conf", "cls")) -> None:
    """Detections as CSV, a folder for each clip."""
    own = [c for c in columns if c in detections.columns]
    detections.select(clip, *own).write.mode("errorifexists").option("header", True).partitionBy(clip).csv(path)


def write_stats(boxes: DataFrame, path: str, site: str, cls: str, stem: str, frame: str, stride: int = 1, offset: int = 0) -> None:
    """The statistics of boxes in folders below path: site_class_boxes, site_class_frames, site_totals and class_totals as
    CSV, and summary, a JSON document for each site."""
    by_class = stats.site_class_stats(boxes, site, cls, [stem, frame])
    tables = {
        "site_class_boxes": by_class.select(site, cls, "n_boxes", "pct_of_class", "pct_of_site", "pct_of_all"),
        "site_class_frames": by_class.select(site, cls, "n_frames"),
        "site_totals": stats.site_totals(boxes, site, stem, frame, stride, offset),
        "class_totals": stats.class_totals(boxes, cls, site, [stem, frame]),
    }
    for name, table in tables.items():
        table.write.mode("errorifexists").option("header", True).csv(f"{path}/{name}")
    stats_json(by_class, site, cls).write.mode("errorifexists").json(f"{path}/summary")


def write_split_report(assignment: DataFrame, groups: DataFrame, hist: DataFrame, path: str, group: str, frames: str, boxes: str) -> None:
    """The assignment of groups as CSV, and for each split a JSON document of its sizes and histograms."""
    assignment.join(groups, group).write.mode("errorifexists").option("header", True).csv(f"{path}/groups")
    stats.split_summary(assignment, groups, hist, group, frames, boxes).write.mode("errorifexists").json(f"{path}/report")


def write_condition_outputs(manifest: DataFrame, metadata: DataFrame, summary: DataFrame, path: str) -> None:
    """The chosen videos with their frames and conditions, their metadata, and the summary of conditions, each as CSV."""
    for name, table in (("manifest", manifest), ("metadata", metadata), ("summary", summary)):
        table.write.mode("errorifexists").option("header", True).csv(f"{path}/{name}")


def write_seqinfo(sequences: DataFrame, path: str, name: str, fps: str, length: str, width: str, height: str, ext: str = ".jpg") -> None:
    """The information file of each sequence, in a folder ``sequence=<name>`` of its own, as read_seqinfo reads it."""
    fields = (("name", name), ("frameRate", fps), ("seqLength", length), ("imWidth", width), ("imHeight", height))
    lines = [F.concat(F.lit(f"{k} = "), F.col(c).cast("string")) for k, c in fields]
    text = F.concat_ws("\n", F.lit("[Sequence]"), *lines, F.lit(f"imExt = {ext}"))
    # small rows, but a file for each: so tasks are cut by their number
    tasks = max(1, -(-sequences.count() // FILES))
    sequences.select(F.col(name).alias("sequence"), text.alias("value")).repartition(tasks, "sequence").write.mode("errorifexists").partitionBy("sequence").text(path)
