"""Reproducible sampling and splitting. Random order is the order of a hash of seed and key, so results don't depend on
partitioning; sizes, caps and eligibility are those of a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.scalars import hash_order
from tidewell.operators.ordered import least_by_hash, with_rank


def sample_per_group(rows: DataFrame, group: Sequence[str], key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """At most k rows of each group; all of a smaller one."""
    w = Window.partitionBy(*group).orderBy(hash_order(seed, *[F.col(c) for c in (*group, *key)]), *key)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def random_subset(rows: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """The first n rows by hash order, without a sort of all rows."""
    return least_by_hash(rows, [], key, n, seed)


def sample_negatives(candidates: DataFrame, stem: str, frame: str, n_positive: int, ratio: float, k: int, seed: int = 0) -> DataFrame:
    """At most k frames of each empty video, of which a share ``ratio`` of the final set is kept; none without positives."""
    return share_of_negatives(sample_per_group(candidates, [stem], [frame], k, seed), stem, frame, n_positive, ratio, seed + 1)


def share_of_negatives(drawn: DataFrame, stem: str, frame: str, n_positive: int, ratio: float, seed: int = 0) -> DataFrame:
    """Of the frames drawn so many that they are a share ``ratio`` of the final set; none without positives."""
    if n_positive <= 0 or ratio <= 0:
        return drawn.limit(0)
    return drawn if ratio >= 1 else random_subset(drawn, [stem, frame], int(ratio / (1 - ratio) * n_positive), seed)


def target_count(total: int, fraction: float | None = None, n: int | None = None) -> int:
    if (fraction is None) == (n is None):
        raise ValueError("give either fraction or n")
    if fraction is not None:
        if not 0 < fraction <= 1:
            raise ValueError("fraction must be in (0, 1]")
        return max(1, int(total * fraction)) if total else 0
    if n <= 0:
        raise ValueError("n must be positive")
    return min(total, n)


def proportional_sizes(sizes: DataFrame, group: str, n: str, target: int) -> DataFrame:
    """(group, n, take): largest-remainder shares of target; equal remainders go by group name, last first."""
    exact = F.lit(target) * F.col(n) / F.sum(n).over(Window.partitionBy())
    base = sizes.withColumn("__x", exact).withColumn("__b", F.least(F.floor("__x"), F.col(n)))
    left = F.lit(target) - F.sum("__b").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc(F.col("__x") - F.col("__b")), F.desc(group)))
    return base.withColumns({"__l": left, "__p": place}).select(group, n, (F.col("__b") + ((F.col("__p") <= F.col("__l")) & (F.col("__b") < F.col(n))).cast("long")).alias("take"))


def stratified_subset(rows: DataFrame, group: str, key: Sequence[str], fraction: float | None = None, n: int | None = None, seed: int = 0) -> DataFrame:
    """A subset in which the groups keep their shares. The sizes table has a row per group."""
    total = rows.count()
    sizes = proportional_sizes(rows.groupBy(group).agg(F.count("*").alias("n")), group, "n", target_count(total, fraction, n))
    return least_by_hash(rows, [group], key, sizes.select(group, "take"), seed, total)


def task_prefix(name: Column, tail: int = 10) -> Column:
    """A file name less its last characters (frame number and extension): the task it belongs to."""
    return F.when(F.length(name) > tail, F.left(name, F.length(name) - tail)).otherwise(F.lit(""))


def random_split(rows: DataFrame, key: str, shares: Sequence[tuple[str, float]] = (("train", 0.7), ("val", 0.15), ("test", 0.15)), seed: int = 0) -> DataFrame:
    """rows with ``split``: keys in hash order are cut at whole numbers of the cumulative shares.

    A key that rows share (a task's prefix, say) goes to one split with all its rows.
    """
    keys = rows.select(key).distinct()
    total = keys.count()
    place = with_rank(keys.withColumn("__h", hash_order(seed, F.col(key))), ["__h", key], "__r")
    at, split = 0.0, None
    for name, share in shares:
        at += share
        to = int(round(total * at, 6))
        split = F.when(F.col("__r") <= to, name) if split is None else split.when(F.col("__r") <= to, name)
    return rows.join(place.select(key, split.otherwise(shares[-1][0]).alias("split")), key)


def site_manifests(manifest: DataFrame, split: str, site: str, sites: dict[str, Sequence]) -> DataFrame:
    """Lines of each split whose site is wanted for it; splits without a list keep all."""
    keep = F.lit(True)
    for name, wanted in sites.items():
        keep = keep & ((F.col(split) != name) | F.col(site).isin(list(wanted)))
    return manifest.where(keep)


def eval_manifest(manifest: DataFrame, split: str, site: str, path: str, sites: Sequence, root: str) -> DataFrame:
    """Test lines of the sites under another root."""
    rows = manifest.where((F.col(split) == "test") & F.col(site).isin(list(sites)))
    return rows.select(site, F.concat(F.lit(root.rstrip("/") + "/"), F.col(path)).alias("path"))


def mark_boxes(objects: DataFrame, edits: DataFrame, frame: str, position: str) -> DataFrame:
    """objects after edits (frame, position, action): ``noise`` and ``object`` change a box's kind, ``delete`` removes it.

    Of several edits of one box the last by ``edit_pos`` holds.
    """
    rank = F.row_number().over(Window.partitionBy(frame, position).orderBy(F.desc("edit_pos")))
    last = edits.withColumn("__r", rank).where("__r = 1").select(frame, position, "action")
    kind = F.when(F.col("action") == "noise", "noises").when(F.col("action") == "object", "interested_objects").otherwise(F.col("kind"))
    return objects.join(last, [frame, position], "left").where("coalesce(action, '') <> 'delete'").withColumn("kind", kind).drop("action")


def empties_per_sequence(items: Column, sequences: Column) -> Column:
    """How many empty frames to draw from each sequence: a nineteenth of the items, shared out, and one."""
    return (F.floor(F.floor(items / 19) / sequences) + 1).cast("long")


def shard(rows: DataFrame, order: Sequence[str], size: int, prefix: str = "shard") -> DataFrame:
    """rows with shard names ``prefix-%06d`` of ``size`` members in order."""
    ranked = with_rank(rows, order, "__n")
    return ranked.withColumn("shard", F.format_string(prefix + "-%06d", F.floor((F.col("__n") - 1) / size))).drop("__n")


def sample_empty(items: DataFrame, boxes: DataFrame, key: str, sequence: str, count: int | DataFrame, seed: int = 0) -> DataFrame:
    """Of each sequence ``count`` of the items without boxes, by hash order; count may be a table (sequence, take)."""
    empty = items.join(boxes.select(key).distinct(), key, "left_anti")
    takes = count if isinstance(count, DataFrame) else empty.select(sequence).distinct().withColumn("take", F.lit(count))
    return least_by_hash(empty, [sequence], [key], takes, seed)


def manifest_counts(manifest: DataFrame, split: str) -> DataFrame:
    """(split, n_frames)"""
    return manifest.groupBy(split).agg(F.count("*").alias("n_frames"))
