"""Statistics of boxes and frames, group features and their distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import boxes as B
from tidewell.functions.scalars import pct


def site_class_stats(boxes: DataFrame, site: str, cls: str, frame_key: Sequence[str]) -> DataFrame:
    """(site, class, n_boxes, n_frames) with shares of the class, the site and the data set; a frame counts once a class."""
    s = boxes.groupBy(site, cls).agg(F.count("*").alias("n_boxes"), F.countDistinct(*frame_key).alias("n_frames"))
    total = lambda *by: F.sum("n_boxes").over(Window.partitionBy(*by))
    return s.select(site, cls, "n_boxes", "n_frames", pct(F.col("n_boxes"), total(cls)).alias("pct_of_class"), pct(F.col("n_boxes"), total(site)).alias("pct_of_site"), pct(F.col("n_boxes"), total()).alias("pct_of_all"))


def site_class_grid(boxes: DataFrame, site: str, cls: str) -> DataFrame:
    """(site, class, n_boxes) for every site with every class, 0 where there is none. Both lists are aggregates."""
    counts = boxes.groupBy(site, cls).agg(F.count("*").alias("n_boxes"))
    grid = counts.select(site).distinct().join(counts.select(cls).distinct())
    return grid.join(counts, [site, cls], "left").select(site, cls, F.coalesce("n_boxes", F.lit(0)).alias("n_boxes"))


def site_totals(boxes: DataFrame, site: str, stem: str, frame: str, stride: int = 1, offset: int = 0) -> DataFrame:
    """(site, n_frames, n_boxes, n_videos): frames and boxes after stride sampling, videos with boxes before it."""
    kept = F.pmod(F.col(frame), F.lit(stride)) == offset
    return boxes.groupBy(site).agg(
        F.countDistinct(F.when(kept, F.struct(stem, frame))).alias("n_frames"), F.count_if(kept).alias("n_boxes"), F.countDistinct(stem).alias("n_videos")
    )


def class_totals(boxes: DataFrame, cls: str, site: str, frame_key: Sequence[str]) -> DataFrame:
    return boxes.groupBy(cls).agg(F.count("*").alias("n_boxes"), F.countDistinct(*frame_key).alias("n_frames"), F.countDistinct(site).alias("n_sites"))


def box_bins(boxes: DataFrame, w: str, h: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, ar_bin, area_bin, n)"""
    binned = boxes.withColumns({"ar_bin": B.ar_bin(F.col(w), F.col(h)), "area_bin": B.area_bin(F.col(w) * F.col(h))})
    return binned.groupBy(*by, "ar_bin", "area_bin").agg(F.count("*").alias("n"))


def _names(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def group_stats(boxes: DataFrame, group: str | Sequence[str], stem: str, frame: str) -> DataFrame:
    """(group, n_videos, n_frames, n_boxes); group is a column or several (site, device and day)."""
    return boxes.groupBy(*_names(group)).agg(F.countDistinct(stem).alias("n_videos"), F.countDistinct(stem, frame).alias("n_frames"), F.count("*").alias("n_boxes"))


def group_hist(boxes: DataFrame, group: str | Sequence[str], stem: str, frame: str, cls: str, w: str, h: str, time: str | None = None) -> DataFrame:
    """(group, feature, key, cnt): boxes by class, area and aspect; frames by their number of boxes and, with a column of the
    video's time (HHMMSS), by time of day. group is a column or several."""
    by = _names(group)
    per_box = {"class": F.col(cls).cast("string"), "area": B.area_bin(F.col(w) * F.col(h)), "ar": B.ar_bin(F.col(w), F.col(h))}
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("key")) for k, v in per_box.items()]))
    of_boxes = boxes.select(*by, stacked.alias("x")).groupBy(*by, "x.feature", "x.key").agg(F.count("*").alias("cnt"))
    frames = boxes.groupBy(*by, stem, frame).agg(F.count("*").alias("n"), *([F.first(time).alias("t")] if time else []))
    per_frame = {"density": B.density_bin(F.col("n"))} | ({"tod": B.time_bucket(F.col("t"))} if time else {})
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("key")) for k, v in per_frame.items()]))
    of_frames = frames.select(*by, stacked.alias("x")).groupBy(*by, "x.feature", "x.key").agg(F.count("*").alias("cnt"))
    return of_boxes.unionByName(of_frames)


def global_targets(hist: DataFrame) -> DataFrame:
    """(feature, key, cnt, p): counts and shares over all groups."""
    s = hist.groupBy("feature", "key").agg(F.sum("cnt").alias("cnt"))
    return s.withColumn("p", F.col("cnt") / F.sum("cnt").over(Window.partitionBy("feature")))


def l1_distance(a: DataFrame, b: DataFrame) -> DataFrame:
    """(feature, l1): distance of two tables (feature, key, p)."""
    both = a.select("feature", "key", F.col("p").alias("pa")).join(b.select("feature", "key", F.col("p").alias("pb")), ["feature", "key"], "full")
    return both.groupBy("feature").agg(F.sum(F.abs(F.coalesce("pa", F.lit(0.0)) - F.coalesce("pb", F.lit(0.0)))).alias("l1"))


def rarity(hist: DataFrame, group: str) -> DataFrame:
    """(group, rarity): each box weighs the inverse share of its class; boxes add a quarter each."""
    classes = hist.where("feature = 'class'")
    targets = global_targets(classes).select("key", "p")
    score = F.sum(F.col("cnt") / F.greatest("p", F.lit(1e-6))) + 0.25 * F.sum("cnt")
    return classes.join(targets, "key").groupBy(group).agg(score.alias("rarity"))


def condition_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, val, n) of the non-null values of the columns."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in columns])).alias("x"))
    return long.where("x.val is not null").groupBy("x.col", "x.val").agg(F.count("*").alias("n"))


def condition_targets(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, val, n, target): each column's values are wanted as often as its rarest one."""
    return condition_counts(rows, columns).withColumn("target", F.min("n").over(Window.partitionBy("col")))


def active_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, n_values) of the columns of two values or more."""
    return condition_counts(rows, columns).groupBy("col").agg(F.count("*").alias("n_values")).where("n_values >= 2")


def class_pivot(counts: DataFrame, row: str, column: str, n: str, values: Sequence) -> DataFrame:
    """One row per row value, a column for each of values, 0 where there is none."""
    return counts.groupBy(row).pivot(column, list(values)).agg(F.sum(n)).na.fill(0)


def crop_boxes(boxes: DataFrame, xc: str, yc: str, w: str, h: str, y0: float = 0.0, y1: float = 0.5, min_visible: float = 0.05) -> DataFrame:
    """boxes with their part in the band y0..y1, in its coordinates: columns crop_xc, crop_yc, crop_w, crop_h, all null for a
    box of which too little is visible. Corners come out of a generator, so that each is computed once and no filter above is
    rewritten in terms of what they are made of."""
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    half_w, half_h = F.col(w) / 2, F.col(h) / 2
    ends = {"__x1": unit(F.col(xc) - half_w), "__x2": unit(F.col(xc) + half_w), "__t": unit(F.col(yc) - half_h), "__b": unit(F.col(yc) + half_h)}
    corners = boxes.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in ends.items()]))))
    band = corners.withColumns({"__c1": F.greatest(F.col("__t"), F.lit(y0)), "__c2": F.least(F.col("__b"), F.lit(y1)), "__area": F.greatest(F.col("__x2") - F.col("__x1"), F.lit(0.0)) * F.greatest(F.col("__b") - F.col("__t"), F.lit(0.0))})
    seen = F.try_divide((F.col("__x2") - F.col("__x1")) * (F.col("__c2") - F.col("__c1")), F.col("__area"))
    keep = (F.col("__area") > 0) & (F.col("__c2") > F.col("__c1")) & (seen >= min_visible) & (F.col("__x2") > F.col("__x1"))
    n1, n2 = ((F.col(c) - y0) / (y1 - y0) for c in ("__c1", "__c2"))
    out = {"crop_xc": (F.col("__x1") + F.col("__x2")) / 2, "crop_yc": (n1 + n2) / 2, "crop_w": F.col("__x2") - F.col("__x1"), "crop_h": n2 - n1}
    kept = band.withColumn("__keep", F.coalesce(keep, F.lit(False)))
    return kept.withColumns({k: F.when(F.col("__keep"), unit(v)) for k, v in out.items()}).select(*boxes.columns, *out)


def crop_summary(boxes: DataFrame, xc: str, yc: str, w: str, h: str, by: Sequence[str], y0: float = 0.0, y1: float = 0.5) -> DataFrame:
    """(by, boxes_before, boxes_after, dropped)"""
    kept = F.col("crop_w").isNotNull()
    cropped = crop_boxes(boxes, xc, yc, w, h, y0, y1)
    return cropped.groupBy(*by).agg(F.count("*").alias("boxes_before"), F.count_if(kept).alias("boxes_after"), F.count_if(~kept).alias("dropped"))


def echogram(samples: DataFrame, frame: str, row: str, value: str) -> DataFrame:
    return samples.groupBy(frame, row).agg(F.max(value).alias("peak"))


def union_names(*parts: DataFrame) -> DataFrame:
    """The distinct rows of several tables of one kind of name (sites, labels)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def split_summary(assignment: DataFrame, groups: DataFrame, hist: DataFrame, group: str, frames: str, boxes: str) -> DataFrame:
    """(split, n_groups, n_frames, n_boxes, histograms): histograms maps each feature to its counts by key."""
    sizes = assignment.join(groups, group).groupBy("split").agg(F.count("*").alias("n_groups"), F.sum(frames).alias("n_frames"), F.sum(boxes).alias("n_boxes"))
    cells = assignment.join(hist, group).groupBy("split", "feature", "key").agg(F.sum("cnt").alias("cnt"))
    by_feature = cells.groupBy("split", "feature").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "cnt")))).alias("counts"))
    maps = by_feature.groupBy("split").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", F.col("counts").cast("map<string,bigint>").alias("counts"))), lambda a, b: F.when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0))).alias("histograms"))
    return sizes.join(maps, "split", "left")


def condition_manifest(samples: DataFrame, stem: str, frame: str, info: DataFrame, conditions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(stem, info's columns, sampled_frames, columns): a row for each sampled video, its frames in one text, and its
    conditions, an empty text where it has none."""
    frames = samples.groupBy(stem).agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.col(frame).cast("long"))), lambda x: x.cast("string")), " ").alias("sampled_frames"))
    rows = frames.join(info, stem, "left").join(conditions.select(stem, *columns), stem, "left")
    return rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def condition_summary(manifest: DataFrame, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, val, input_rows, target, selected): each condition's value among all rows, as wanted, and among the chosen."""
    chosen = condition_counts(manifest.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in columns]), columns).withColumnRenamed("n", "selected")
    return condition_targets(rows, columns).withColumnRenamed("n", "input_rows").join(chosen, ["col", "val"], "left").na.fill(0, ["selected"])
