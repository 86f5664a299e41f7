"""Keyframed tracks, detections, line crossings and object tracking."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.ordered import best_from_here, dealt, with_running
from tidewell.session import materialize


def interpolate_tracks(keyframes: DataFrame, keys: Sequence[str], frame: str = "frame", position: str = "kf_pos", values: Sequence[str] = ("x", "y", "w", "h"), enabled: str = "enabled", stride: int = 1, offset: int = 0) -> DataFrame:
    """Boxes for every frame of keyframed tracks: keys, frame, values, keyframe.

    Each keyframe of a frame >= 0 gives its own box. An enabled one also gives linear boxes strictly between it and the
    track's next keyframe; a missing ``enabled`` counts as true. With a stride only frames with frame % stride == offset are
    generated, rather than filtered afterwards. Keyframes sort by frame (missing: 0, but dropped), then position.
    """
    w = Window.partitionBy(*keys).orderBy(F.coalesce(F.col(frame), F.lit(0)), position)
    after = F.lead(F.struct(F.coalesce(F.col(frame), F.lit(-1)).alias("f"), *values)).over(w)
    df = keyframes.select(*keys, F.coalesce(F.col(frame), F.lit(-1)).cast("int").alias("__f"), F.coalesce(F.col(enabled), F.lit(True)).alias("__on"), *values, after.alias("__n"))
    f0, f1 = F.col("__f"), F.col("__n.f").cast("int")
    start = f0 + 1 + F.pmod(F.lit(offset) - (f0 + 1), F.lit(stride))
    between = F.when(F.col("__on") & (f0 >= 0) & (start <= f1 - 1), F.sequence(start, f1 - 1, F.lit(stride)))
    own = F.when((f0 >= 0) & (F.pmod(f0, F.lit(stride)) == offset % stride), F.array(f0))
    none = F.array().cast("array<int>")
    df = df.withColumn(frame, F.explode(F.concat(F.coalesce(own, none), F.coalesce(between, none))))
    part = (F.col(frame) - f0) / (f1 - f0)
    moved = [F.when(F.col(frame) == f0, F.col(v)).otherwise(F.col(v) + (F.col(f"__n.{v}") - F.col(v)) * part).alias(v) for v in values]
    return df.select(*keys, frame, *moved, (F.col(frame) == f0).alias("keyframe"))


def offset_track_ids(tracks: DataFrame, video: str, track: str, out: str = "global_id") -> DataFrame:
    """Track ids unique over videos: each video's ids follow the largest of the videos before it (by name)."""
    tops = tracks.groupBy(video).agg((F.max(track) + 1).alias("__n"))
    summed = with_running(tops, [], [video], {"__to": F.col("__n")}, "__rank")
    return tracks.join(summed.select(video, (F.col("__to") - F.col("__n")).alias("__base")), video).withColumn(out, F.col(track) + F.col("__base")).drop("__base")


def change_point_ids(rows: DataFrame, sequence: str, order: Sequence[str], track: str, out: str = "run_id") -> DataFrame:
    """A new id at each change of the track in a sequence's order, from 1; a track that comes again gets another."""
    w = Window.partitionBy(sequence).orderBy(*order)
    new = F.coalesce((F.col(track) != F.lag(track).over(w)).cast("int"), F.lit(1))
    return rows.withColumn("__new", new).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def drop_short_tracks(rows: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """Rows of tracks of at least so many rows."""
    counts = rows.groupBy(*keys).count().where(F.col("count") >= least).drop("count")
    return rows.join(counts, list(keys), "left_semi")


def vote_class(detections: DataFrame, keys: Sequence[str], order: Sequence[str], cls: str = "cls", method: str = "all", confidence: str = "conf", width: str | None = None, height: str | None = None) -> DataFrame:
    """Each track's class by vote (keys, cls, weight). Ties go to the class seen first; no vote, no row.

    all: every box counts 1; ignore_thin: only boxes wider than high; confidence: boxes count their confidence.
    """
    if method not in ("all", "ignore_thin", "confidence"):
        raise ValueError(f"unknown vote method: {method}")
    df = detections.where(F.col(width) > F.col(height)) if method == "ignore_thin" else detections
    weight = F.sum(confidence) if method == "confidence" else F.count("*").cast("double")
    votes = df.groupBy(*keys, cls).agg(weight.alias("weight"), F.min(F.struct(*order)).alias("__first"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("weight"), "__first"))
    return votes.withColumn("__r", rank).where("__r = 1").select(*keys, cls, "weight")


def line_crossings(detections: DataFrame, keys: Sequence[str], order: Sequence[str], x: str = "x", line: float = 0.5, y: str | None = None, bound: float | None = None) -> DataFrame:
    """(keys, first_x, last_x, direction): r from left of the line to it or beyond, l the other way, null for neither.

    y, bound: boxes below the bound line (a greater y) are no part of a track's path; a track of such boxes alone has none.
    """
    if y is not None and bound is not None:
        path = F.col(y) <= bound
        when = F.when(path, F.struct(*order))
    else:
        when = F.struct(*order)
    ends = detections.groupBy(*keys).agg(F.min_by(x, when).alias("first_x"), F.max_by(x, when).alias("last_x"))
    way = F.when((F.col("first_x") < line) & (F.col("last_x") >= line), "r").when((F.col("first_x") > line) & (F.col("last_x") <= line), "l")
    return ends.withColumn("direction", way)


def clip_counts(crossings: DataFrame, votes: DataFrame, clips: DataFrame, clip: str, track: str, cls: str = "cls") -> DataFrame:
    """(clip, direction, species, n): crossings by direction and class; clips without any have one row of n = 0."""
    hits = crossings.where(F.col("direction").isNotNull()).join(votes, [clip, track]).groupBy(clip, "direction", F.col(cls).alias("species")).agg(F.count("*").alias("n"))
    empty = clips.select(clip).distinct().join(hits, clip, "left_anti").select(clip, F.lit(None).cast("string").alias("direction"), F.lit(None).cast("string").alias("species"), F.lit(0).cast("long").alias("n"))
    return hits.unionByName(empty)


#: Frames of a clip whose boxes of a track lie in one row, at most.
RUN_FRAMES = 1024
#: Runs that a task holds before it gives them, about.
RUN_ROWS = 10_000


def _runs(budget: int):
    """Rows (clip, track, fs), a track's rows one after another in the order of their frames fs, to its runs."""
    names = ["clip", "track", "run", "start", "end", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, types, out = None, [], []
        number = start = last = missed = n = 0  # of the run that is open, a run of track key; missed: up to last

        def batch_of_runs() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            types = [batch.column("clip").type, batch.column("track").type, pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            for own, fs in zip(zip(batch.column("clip").to_pylist(), batch.column("track").to_pylist(), strict=True), batch.column("fs"), strict=True):
                f = fs.values.to_numpy().astype(np.int64)
                g = f - np.arange(len(f))  # grows by the frames that are missed
                # the first place where the open run's budget is gone
                at = int(g.searchsorted(last + 1 - missed + budget, side="right")) if own == key else 0
                if at:
                    missed, last, n = missed + int(g[at - 1]) - last - 1, int(f[at - 1]), n + at
                    if at == len(f):
                        continue
                if n:
                    out.append((*key, number, start, last, n))
                number = number + 1 if own == key else 0
                after = g.searchsorted(g + budget, side="right").tolist()
                starts = [at]
                while (at := after[at]) < len(f):
                    starts.append(at)
                to = np.array(starts[1:], np.int64)
                out.extend(zip(*[[k] * len(to) for k in own], range(number, number + len(to)), f[starts[:-1]].tolist(), f[to - 1].tolist(), np.diff(starts).tolist(), strict=True))
                at = starts[-1]
                key, number, start, last, missed, n = own, number + len(to), int(f[at]), int(f[-1]), int(g[-1] - g[at]), len(f) - at
                if len(out) >= RUN_ROWS:
                    yield batch_of_runs()
            yield batch_of_runs()
        if n:
            out.append((*key, number, start, last, n))
            yield batch_of_runs()

    return run


def track_runs(detections: DataFrame, clip: str, track: str, frame: str, length: str, budget: int = 10) -> DataFrame:
    """(clip, track, run, start, end, n): runs of a track, each with a budget of missed frames that is never refilled.

    A run ends at the first missing frame after the budget is gone, and at the clip's last frame, whose own boxes are
    dropped. ``length`` is the clip's number of frames. A track's frames are packed into rows of RUN_FRAMES at most, which
    one pass reads in order, so a task holds a batch of them and the work grows with the frames.
    """
    at = F.col(frame).cast("int")
    seen = detections.where(F.col(frame) < F.col(length) - 1).select(F.col(clip).alias("clip"), F.col(track).alias("track"), F.floor(at / RUN_FRAMES).alias("piece"), at.alias("f"))
    packed = seen.groupBy("clip", "track", "piece").agg(F.array_sort(F.collect_set("f")).alias("fs"))
    in_order = packed.repartition("clip", "track").sortWithinPartitions("clip", "track", "piece").select("clip", "track", "fs")
    kind = StructType(in_order.schema.fields[:2] + StructType.fromDDL("run int, start int, `end` int, n long").fields)
    return in_order.mapInArrow(_runs(budget), kind).toDF(clip, track, "run", "start", "end", "n")


def track_objects(objects: DataFrame, sequence: str, frame: str, position: str, x: str = "x", y: str = "y", w: str = "w", h: str = "h", radius: float = 25.0, history: int = 5) -> DataFrame:
    """(seq, frame, pos, object_id): ids by nearest history. An object takes the id of the first object within radius of its
    centre, searched from the oldest of the last ``history`` frames on; else a new id. Where two objects of a frame take one
    id, the later keeps it.

    A sequence is cut where no object can have a partner on the other side, the pieces are run apart, and ids are made
    the sequence's by running sums. Partners are looked for by cells of a grid as wide as the radius, so a cut may be missed
    where objects are near without being partners, but never set wrongly.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        past: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        out, here, piece, fresh = [], [], None, 0  # here: objects of the frame that is being read

        def close() -> None:
            nonlocal past, fresh
            cx, cy = (np.array([o[i] for o in here], float) for i in (4, 5))
            ids = []
            for i in range(len(here)):
                for hx, hy, hid in past:
                    near = np.flatnonzero(np.hypot(hx - cx[i], hy - cy[i]) <= radius)
                    if len(near):
                        ids.append(int(hid[near[0]]))
                        break
                else:
                    ids.append(fresh)
                    fresh += 1
            last = {x: i for i, x in enumerate(ids)}
            keep = sorted(last.values())
            past = [*past, (cx[keep], cy[keep], np.array(ids)[keep])][-history:]
            out.extend((*here[i][:4], ids[i], 0) for i in keep)
            here.clear()

        def end() -> None:
            if here:
                close()
                out[-1] = (*out[-1][:5], fresh)  # once a piece

        columns = ["seq", "piece", "frame", "pos", "id", "fresh"]
        for pdf in batches:
            for o in zip(*[pdf[c].tolist() for c in ("seq", "piece", "frame", "pos", "cx", "cy")], strict=True):
                if piece != o[:2]:
                    end()
                    piece, past, fresh = o[:2], [], 0
                elif here and here[-1][2] != o[2]:
                    close()
                here.append(o)
            # a piece's last row may yet be told its new ids
            if len(out) > 1:
                yield pd.DataFrame(out[:-1], columns=columns)
                del out[:-1]
        end()
        yield pd.DataFrame(out, columns=columns)

    centre = {"cx": F.col(x).cast("double") + F.col(w).cast("double") / 2, "cy": F.col(y).cast("double") + F.col(h).cast("double") / 2}
    df = objects.select(F.col(sequence).cast("string").alias("seq"), F.col(frame).cast("long").alias("frame"), F.col(position).cast("long").alias("pos"), *[c.alias(n) for n, c in centre.items()])
    pieces = materialize(cut_sequences(df, radius, history), "pieces")
    # read in order, batch by batch, so that a task holds a few frames
    in_order = pieces.where("frame is not null").repartition("seq", "piece").sortWithinPartitions("seq", "piece", "frame", F.asc_nulls_last("pos")).select("seq", "piece", "frame", "pos", "cx", "cy")
    local = materialize(in_order.mapInPandas(run, "seq string, piece long, frame long, pos long, id long, fresh long"), "ids")
    number = with_running(local.groupBy("seq", "piece").agg(F.sum("fresh").alias("fresh")), ["seq"], ["piece"], {"to": F.col("fresh")})
    before = number.select(F.col("seq").alias("s"), F.col("piece").alias("p"), (F.col("to") - F.col("fresh")).alias("before"))
    both = local.join(before, F.col("seq").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
    return both.select("seq", "frame", "pos", (F.col("id") + F.col("before")).alias("object_id"))


def cut_sequences(objects: DataFrame, radius: float, history: int) -> DataFrame:
    """objects (seq, frame, cx, cy, ...) with their ``piece``: its number grows at each frame such that no object from it on is
    within radius of one of up to history frames before."""
    frames = with_running(objects.select("seq", "frame").distinct(), ["seq"], ["frame"], {}, "at")
    frames = materialize(frames.select(F.col("seq").alias("s"), F.col("frame").alias("f"), "at"), "frames")
    side = max(radius, 1e-300) * (1 + 1e-9)
    same = F.col("seq").eqNullSafe(F.col("s")) & (F.col("frame") == F.col("f"))
    cells = objects.join(frames, same).where(F.col("cx").isNotNull() & F.col("cy").isNotNull()).select("seq", "at", F.floor(F.col("cx") / side).alias("i"), F.floor(F.col("cy") / side).alias("j")).distinct()
    # a cell reaches those around it in the frames behind, which lie in its own block of frames or the next one
    block = lambda c: F.floor(F.col(c) / history)
    around = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    ahead = cells.withColumn("block", F.explode(F.array(block("at"), block("at") + 1))).withColumn("d", F.explode(around))
    ahead = ahead.select("seq", F.col("at").alias("from"), "block", (F.col("i") + F.col("d.a")).alias("i"), (F.col("j") + F.col("d.b")).alias("j"))
    links = cells.withColumn("block", block("at")).join(ahead, ["seq", "block", "i", "j"]).where((F.col("at") > F.col("from")) & (F.col("at") - F.col("from") <= history))
    held = links.select("seq", F.explode(F.sequence(F.col("from") + 1, F.col("at"))).alias("k")).distinct().select(F.col("seq").alias("q"), "k", F.lit(0).alias("cut"))
    marked = frames.join(held, F.col("s").eqNullSafe(F.col("q")) & (F.col("at") == F.col("k")), "left").select("s", "f", F.coalesce("cut", F.lit(1)).alias("cut"))
    numbered = with_running(marked, ["s"], ["f"], {"piece": F.col("cut")}).select("s", "f", F.col("piece").cast("long").alias("piece"))
    return objects.join(numbered, same).select(*objects.columns, "piece")


def transcribe_track_ids(mot: DataFrame, labels: DataFrame, frame: str = "frame_name", position: str = "line_pos", track: str = "track_id") -> DataFrame:
    """labels with the track ids of another label set, by frame and line; lines without a partner keep null."""
    return labels.join(mot.select(frame, position, track), [frame, position], "left")


#: The overlaps that mean average precision is averaged over.
IOUS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))


def _greedy(ious: Sequence[float]):
    """Rows (image, cls, ps), ps in the order of matching, to the predictions that take a box, with a bit for each overlap."""
    order = np.argsort(ious, kind="stable")
    levels, bits = np.array(ious)[order], np.concatenate([[0], np.cumsum(np.int64(1) << order)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column("ps")
            _, pos, less, box = ps.flatten().flatten()
            row = np.repeat(np.arange(len(ps)), ps.value_lengths())
            fit = bits[np.searchsorted(levels, -np.array(less), side="right")]
            at, hit, masks = [], [], []
            last, taken = (-1, None), {}
            for r, p, t, b in zip(row.tolist(), pos.to_pylist(), box.to_pylist(), fit.tolist(), strict=True):
                if (r, p) != last:
                    if r != last[0]:
                        taken = {}
                    last, own = (r, p), 0
                free = b & ~own & ~taken.get(t, 0)
                if free:
                    if own:
                        masks[-1] |= free
                    else:
                        at.append(r)
                        hit.append(p)
                        masks.append(free)
                    own |= free
                    taken[t] = taken.get(t, 0) | free
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("image").take(rows), batch.column("cls").take(rows), pa.array(hit, pa.int64()), pa.array(masks, pa.int64())], names=["image", "cls", "pos", "mask"])

    return run


def detection_metrics(predictions: DataFrame, truth: DataFrame, iou: float | Sequence[float] = 0.5) -> DataFrame:
    """(cls, n_truth, n_pred, ap, ap50, precision, recall) by class, boxes matched greedily by confidence within an image.

    predictions: image, cls, x1, y1, x2, y2, conf, pos; truth: image, cls, x1, y1, x2, y2, pos, which is unique in an image.
    ap is the mean over the overlaps given, ap50 that of the first of them, at which precision and recall are taken too, at
    the confidence of the best F1 (the highest of equals). A class without truth has no row.
    """
    ious = [float(x) for x in ([iou] if isinstance(iou, (int, float)) else iou)]
    if not 0 < len(ious) <= 62:
        raise ValueError("between 1 and 62 overlaps, as each is a bit")

    def side(df: DataFrame, prefix: str, *more: str) -> DataFrame:
        return df.select(F.col("image").cast("string").alias("image"), F.col("cls").cast("string").alias("cls"), *[F.col(c).alias(prefix + c) for c in ("x1", "y1", "x2", "y2", "pos", *more)])

    p, t = (dealt(df, truth, "image", "cls") for df in (side(predictions, "p_", "conf"), side(truth, "t_")))
    size = lambda s, axis: F.col(f"{s}{axis}2") - F.col(f"{s}{axis}1")
    over = lambda axis: F.greatest(F.least(f"p_{axis}2", f"t_{axis}2") - F.greatest(f"p_{axis}1", f"t_{axis}1"), F.lit(0.0))
    both = over("x") * over("y")
    score = F.try_divide(both, size("p_", "x") * size("p_", "y") + size("t_", "x") * size("t_", "y") - both)
    pairs = p.join(t, ["image", "cls"]).withColumn("iou", score).where((F.col("iou") >= min(ious)) & ~F.isnan("iou"))
    # in order of confidence each prediction takes the free box it overlaps most
    pair = F.struct((-F.col("p_conf")).alias("c"), F.col("p_pos").cast("long").alias("p"), (-F.col("iou")).alias("i"), F.col("t_pos").cast("long").alias("t"))
    sorted_pairs = pairs.groupBy("image", "cls").agg(F.array_sort(F.collect_list(pair)).alias("ps"))
    matched = sorted_pairs.mapInArrow(_greedy(ious), "image string, cls string, pos long, mask long")
    ids = range(len(ious))
    hits = p.select("image", "cls", F.col("p_conf").alias("conf"), F.col("p_pos").cast("long").alias("pos")).join(matched, ["image", "cls", "pos"], "left")
    hits = hits.select("image", "cls", "conf", "pos", *[F.coalesce(F.shiftright("mask", i).bitwiseAND(F.lit(1).cast("long")), F.lit(0)).alias(f"hit{i}") for i in ids])
    curve = with_running(hits, ["cls"], [F.desc("conf"), "image", "pos"], {f"tp{i}": F.col(f"hit{i}") for i in ids}, "k", keep_part=True)
    curve = best_from_here(curve.withColumns({f"p{i}": F.col(f"tp{i}") / F.col("k") for i in ids}), ["cls"], "k", [f"p{i}" for i in ids])
    n = t.groupBy("cls").agg(F.count("*").alias("n_truth"))
    # 2 tp / (k + n) is F1 after k predictions
    curve = curve.join(n, "cls").withColumn("f1", 2 * F.col("tp0") / (F.col("k") + F.col("n_truth")))
    sums = [F.sum(F.when(F.col(f"hit{i}") == 1, F.col(f"best_p{i}"))).alias(f"s{i}") for i in ids]
    area = curve.groupBy("cls").agg(F.count("*").alias("n_pred"), F.max_by(F.struct("tp0", "k"), F.struct("f1", (-F.col("k")).alias("o"))).alias("top"), *sums)
    out = n.join(area, "cls", "left")
    ap = [F.coalesce(F.col(f"s{i}") / F.col("n_truth"), F.lit(0.0)) for i in ids]
    return out.select(
        "cls", "n_truth", F.coalesce("n_pred", F.lit(0)).alias("n_pred"), (reduce(lambda x, y: x + y, ap) / len(ap)).alias("ap"), ap[0].alias("ap50"),
        F.coalesce(F.col("top.tp0") / F.col("top.k"), F.lit(0.0)).alias("precision"), F.coalesce(F.col("top.tp0") / F.col("n_truth"), F.lit(0.0)).alias("recall"),
    )


def mean_metrics(metrics: DataFrame) -> DataFrame:
    """One row: means of detection_metrics over the classes (map50, map50_95, mp, mr)."""
    return metrics.agg(F.avg("ap50").alias("map50"), F.avg("ap").alias("map50_95"), F.avg("precision").alias("mp"), F.avg("recall").alias("mr"))


def unique_instance_ids(runs: DataFrame, clip: str, track: str, run: str, out: str = "instance_id") -> DataFrame:
    """Runs of tracks with an id that is unique within the clip: the first run keeps its track's id, later ones follow the
    clip's largest track id in the order of track and run."""
    again = F.col(run) > 0
    w = Window.partitionBy(clip)
    later = F.row_number().over(w.orderBy(F.when(again, F.lit(0)).otherwise(F.lit(1)), track, run))
    return runs.withColumn(out, F.when(again, F.max(track).over(w) + later).otherwise(F.col(track)))


def keyframe_labels(tasks: DataFrame, classes: dict[str, int], width: int, height: int) -> DataFrame:
    """(id, video, frame, class_id, xc, yc, w, h, conf) of flat tasks' keyframes, not interpolated; unknown labels are left out."""
    from tidewell.functions.boxes import with_class_id

    boxes = tasks.select("id", "video", F.explode("box").alias("b")).select("id", "video", F.get("b.labels", 0).alias("label"), F.explode("b.sequence").alias("k"))
    known = with_class_id(boxes, classes)
    over = lambda c, size: (F.col(f"k.{c}") / size)
    centre = [(over("x", width) + over("width", width) / 2).alias("xc"), (over("y", height) + over("height", height) / 2).alias("yc"), over("width", width).alias("w"), over("height", height).alias("h")]
    return known.select("id", "video", F.col("k.frame").cast("int").alias("frame"), "class_id", *centre, F.lit(1.0).alias("conf"))


def frames_per_label(boxes: DataFrame, label: str, frame_key: Sequence[str]) -> DataFrame:
    return boxes.groupBy(label).agg(F.countDistinct(*frame_key).alias("n_frames"))
