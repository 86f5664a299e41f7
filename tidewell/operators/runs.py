"""Runs of logs, motion and clips over time."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.ordered import PART, with_rank
from tidewell.session import materialize

# Parts of the messages that a device logs while it works.
HEALTHY = ("Retrieval time", "BGSub:", "Size of shared frames", "Time elapsed:", "Cont save:", "Writing continuous video to")


def parse_log_line(line: Column) -> Column:
    """struct(ts, level, module, message) of ``ts - LEVEL [file:line] - message``; null for any other line."""
    p = F.split(line, " - ", 3)
    ts = F.try_to_timestamp(F.trim(F.get(p, 0)), F.lit("yyyy-MM-dd HH:mm:ss,SSS"))
    tokens = F.split(F.trim(F.get(p, 1)), r"\s+")
    fields = F.struct(ts.alias("ts"), F.get(tokens, 0).alias("level"), F.regexp_replace(F.get(tokens, 1), r"[\[\]]", "").alias("module"), F.trim(F.get(p, 2)).alias("message"))
    return F.when((F.size(p) == 3) & ts.isNotNull() & (F.size(tokens) == 2), fields)


def is_healthy(message: Column, marks: Sequence[str] = HEALTHY) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | message.contains(m)
    return out


def log_runs(logs: DataFrame, device: str, order: Sequence[str], ts: str, restart: str, healthy: str) -> DataFrame:
    """(device, run, restart_ts, last_healthy): a restart opens a run; the last healthy line by order, not by time."""
    w = Window.partitionBy(device).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    runs = logs.withColumn("run", F.sum(F.col(restart).cast("int")).over(w)).where("run > 0")
    last = F.max_by(F.when(F.col(healthy) & ~F.col(restart), F.col(ts)), F.when(F.col(healthy) & ~F.col(restart), F.struct(*order)))
    return runs.groupBy(device, "run").agg(F.min_by(ts, F.struct(*order)).alias("restart_ts"), last.alias("last_healthy"))


def detect_outages(logs: DataFrame, device: str, order: Sequence[str], ts: str, restart: str, healthy: str, min_downtime: int = 0) -> DataFrame:
    """(device, run, restart_ts, last_healthy, next_restart, uptime_s, downtime_s) of runs that end with a restart and had
    a healthy line."""
    runs = log_runs(logs, device, order, ts, restart, healthy)
    runs = runs.withColumn("next_restart", F.lead("restart_ts").over(Window.partitionBy(device).orderBy("run")))
    seconds = lambda a, b: (F.unix_micros(F.col(b).cast("timestamp")) - F.unix_micros(F.col(a).cast("timestamp"))) / F.lit(1e6)
    out = runs.where(F.col("last_healthy").isNotNull() & F.col("next_restart").isNotNull())
    out = out.withColumns({"uptime_s": seconds("restart_ts", "last_healthy"), "downtime_s": seconds("last_healthy", "next_restart")})
    return out.where(F.col("downtime_s") >= min_downtime)


def number_outages(outages: DataFrame, order: Sequence[str]) -> DataFrame:
    """Outages with their number in the order; for numbers that never change as outages come in see streaming.write_outages."""
    return with_rank(outages, order, "incident")


def assign_contiguous(clips: DataFrame, date: str, order: Sequence[str | Column], duration: str, day_start: Column, skip_missing: bool = True) -> DataFrame:
    """Clips of a day one after another: start_ts = start of the day + the rounded sum of the durations before.

    skip_missing: clips without duration are left out; else they stay and take no time.
    """
    w = Window.partitionBy(date).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.bround(F.coalesce(F.sum(duration).over(w), F.lit(0.0)), 0).cast("long")
    kept = clips.where(F.col(duration).isNotNull()) if skip_missing else clips
    return kept.withColumn("start_ts", F.timestamp_seconds(F.unix_timestamp(day_start) + before))


def segment_clips(clips: DataFrame, duration: str, start: str, length: int = 120) -> DataFrame:
    """A row for each part of at most ``length`` seconds: part, part_start, part_seconds."""
    n = F.greatest(F.lit(1), F.floor((F.col(duration) + length - 1) / length).cast("int"))
    parts = clips.withColumn("part", F.explode(F.sequence(F.lit(0), n - 1)))
    return parts.withColumns({
        "part_start": F.timestamp_seconds(F.unix_timestamp(start) + F.col("part") * length),
        "part_seconds": F.least(F.lit(float(length)), F.col(duration) - F.col("part") * length),
    })


def resolve_collisions(plan: DataFrame, existing: DataFrame, key: str, policy: str = "skip") -> DataFrame:
    """skip: rows whose key exists are left out; overwrite: all stay; error: all stay, with an error."""
    if policy not in ("skip", "overwrite", "error"):
        raise ValueError(f"unknown policy: {policy}")
    there = existing.select(key).distinct()
    if policy == "skip":
        return plan.join(there, key, "left_anti").withColumn("error", F.lit(None).cast("string"))
    marked = plan.join(there.withColumn("__there", F.lit(True)), key, "left")
    error = F.when(F.col("__there"), F.lit("exists")) if policy == "error" else F.lit(None).cast("string")
    return marked.withColumn("error", error).drop("__there")


def continuous_segments(frames: DataFrame, camera: str, frame: str, fps: float, seconds: int = 1800) -> DataFrame:
    segment = F.floor(F.col(frame) / (fps * seconds)).cast("int")
    return frames.groupBy(camera, segment.alias("segment")).agg(F.min(frame).alias("start"), F.max(frame).alias("end"))


def event_clips(sidecars: DataFrame, event: str, part: str, clip: str) -> DataFrame:
    """(event, n_parts, clips): clips of an event in the order of their parts."""
    return sidecars.groupBy(event).agg(F.count("*").alias("n_parts"), F.transform(F.array_sort(F.collect_list(F.struct(part, clip))), lambda x: x[clip]).alias("clips"))


def frame_motion(contours: DataFrame, camera: str, frame: str, area: str, min_area: float) -> DataFrame:
    """(camera, frame, has_motion): whether any contour is larger than min_area."""
    return contours.groupBy(camera, frame).agg((F.max(area) > min_area).alias("has_motion"))


class MotionMachine:
    """Clips of one camera from its per-frame motion flags.

    A clip opens after ``need`` motion frames in a row; it closes on the quiet frame after ``delay`` quiet ones, or when
    a motion frame finds it longer than ``longest``, or at the end. The first ``warm`` frames are ignored.
    """

    def __init__(self, fps: float, warm: float = 1.0, need: float = 0.2, delay: float = 5.0, longest: float = 120.0, state: tuple | None = None):
        self.need, self.delay, self.longest, self.warm = max(1, round(need * fps)), int(delay * fps), int(longest * fps), round(warm * fps)
        self.seen, self.motion, self.quiet, self.start, self.last = state or (0, 0, 0, -1, -1)

    @property
    def state(self) -> tuple:
        return self.seen, self.motion, self.quiet, self.start, self.last

    def step(self, frame: int, moves: bool) -> tuple[int, int, str] | None:
        self.seen += 1
        self.last = frame
        if self.seen <= self.warm:
            return None
        out = None
        if moves:
            self.motion, self.quiet = self.motion + 1, 0
            if self.start < 0 and self.motion >= self.need:
                self.start = frame
            elif self.start >= 0 and frame - self.start > self.longest:
                out, self.start, self.motion = (self.start, frame, "length"), -1, 0
        else:
            self.motion = 0
            if self.start >= 0:
                self.quiet += 1
                if self.quiet > self.delay:
                    out, self.start, self.quiet = (self.start, frame, "quiet"), -1, 0
        return out

    def end(self) -> tuple[int, int, str] | None:
        return (self.start, self.last, "end") if self.start >= 0 else None


class MotionRange:
    """A range of a camera's frames as a function of the MotionMachine's state, with places of clips found by search.

    States: ("closed", motion frames in a row) and ("open", start, quiet frames in a row).
    """

    def __init__(self, frames: np.ndarray, moves: np.ndarray, need: int, delay: int, longest: int):
        self.f, self.need, self.delay, self.longest, self.n = frames, need, delay, longest, len(frames)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], moves.astype(np.int8), [0]])))
        self.run_from, self.run_to = edge[::2], edge[1::2]  # runs of motion, their ends not included
        self.motion = np.flatnonzero(moves)
        self.motion_f = frames[self.motion]
        ends = np.concatenate([[0], self.run_to]), np.concatenate([self.run_from, [self.n]])
        self.lead = int(ends[1][0])  # quiet frames at the beginning
        self.trail = int(self.n - ends[0][-1])
        still = ends[1] - ends[0] > delay
        self.still = (ends[0] + delay)[still]  # where a quiet run closes what is open before it
        self.long_from = self.run_from[self.run_to - self.run_from >= need]
        self.known: dict[int, tuple] = {}

    def _opens(self, p: int) -> int | None:
        """The place where a clip opens, of a camera that is closed before place p."""
        i = int(np.searchsorted(self.run_to, p, side="right"))
        if i < len(self.run_to) and self.run_from[i] < p and self.run_to[i] - p >= self.need:
            return p + self.need - 1
        j = int(np.searchsorted(self.long_from, p))
        return int(self.long_from[j]) + self.need - 1 if j < len(self.long_from) else None

    def _closes(self, start: int, place: int) -> tuple[int | None, str]:
        """Where and why a clip of that start, open behind place, closes."""
        i = int(np.searchsorted(self.still, place))
        quiet = int(self.still[i]) if i < len(self.still) else self.n
        j = max(int(np.searchsorted(self.motion_f, start + self.longest, side="right")), int(np.searchsorted(self.motion, place)))
        length = int(self.motion[j]) if j < len(self.motion) else self.n
        at = min(quiet, length)
        return (None if at == self.n else at), ("length" if length < quiet else "quiet")

    def _closed_end(self, p: int) -> tuple:
        tail = self.n - int(self.run_from[-1]) if len(self.run_to) and self.run_to[-1] == self.n else 0
        return "closed", min(tail, self.n - p)

    def walk(self, state: tuple, clips: list | None = None) -> tuple:
        """The state behind the range; clips: gets (start, end, reason)."""
        if state[0] == "open":
            _, start, quiet = state
            if quiet + self.lead <= self.delay and self.lead == self.n:
                return "open", start, quiet + self.n
            if quiet + self.lead > self.delay:
                at, why = self.delay - quiet, "quiet"
            else:
                at, why = self._closes(start, self.lead)
            if at is None:
                return "open", start, self.trail
            if clips is not None:
                clips.append((start, int(self.f[at]), why))
            return self._from(at + 1, clips)
        first = int(self.run_to[0]) if len(self.run_to) and self.run_from[0] == 0 else 0  # motion frames at the beginning
        if state[1] and first >= self.need - state[1]:
            return self._opened(self.need - state[1] - 1, clips)
        if state[1] and first == self.n:
            return "closed", state[1] + self.n
        return self._from(0 if not state[1] else first, clips)

    def _from(self, p: int, clips: list | None) -> tuple:
        at = self._opens(p)
        return self._closed_end(p) if at is None else self._opened(at, clips)

    def _opened(self, at: int, clips: list | None) -> tuple:
        path = []
        while True:
            if clips is None and at in self.known:
                end = self.known[at]
                break
            path.append(at)
            start = int(self.f[at])
            to, why = self._closes(start, at + 1)
            if to is None:
                end = ("open", start, self.trail)
                break
            if clips is not None:
                clips.append((start, int(self.f[to]), why))
            again = self._opens(to + 1)
            if again is None:
                end = self._closed_end(to + 1)
                break
            at = again
        self.known |= dict.fromkeys(path, end)
        return end

    def summary(self) -> dict:
        """All that walk gives, as numbers: the state behind for each closed state, and for open ones by their start.

        An open clip that gets as far as the first motion frame closes by length at the first motion frame later than its start
        by more than longest. Starts lie before the range, so that is one of the frames up to longest behind its
        beginning: there are as many pieces as such frames at most, whatever the range's size.
        """
        closed = [self.walk(("closed", m)) for m in range(self.need)]
        pieces = []
        if self.lead < self.n:
            i = int(np.searchsorted(self.still, self.lead))
            still = int(self.still[i]) if i < len(self.still) else self.n
            last = int(np.searchsorted(self.motion_f, self.f[0] + self.longest)) + 1
            for place in self.motion[:last].tolist():
                if place >= still:
                    break
                end = self._from(place + 1, None)
                bound = int(self.f[place]) - self.longest  # of starts below it
                if pieces and pieces[-1][1] == end:
                    pieces[-1] = (bound, end)
                else:
                    pieces.append((bound, end))
            rest = self._from(still + 1, None) if still < self.n else None
        else:
            rest = None
        return {"n": self.n, "lead": self.lead, "trail": self.trail, "closed": closed, "pieces": pieces, "rest": rest, "last": int(self.f[-1])}


def state_behind(part: dict, state: tuple, delay: int) -> tuple:
    """MotionRange.walk by the range's summary."""
    if state[0] == "closed":
        return tuple(part["closed"][state[1]])
    _, start, quiet = state
    if quiet + part["lead"] > delay:
        return tuple(part["closed"][0])
    if part["lead"] == part["n"]:
        return "open", start, quiet + part["n"]
    for bound, end in part["pieces"]:
        if start < bound:
            return tuple(end)
    return tuple(part["rest"]) if part["rest"] else ("open", start, part["trail"])


def motion_clips(frames: DataFrame, camera: str, frame: str, flag: str, fps: float = 10.0, ranges: int | None = None, **rules: float) -> DataFrame:
    """(camera, start, end, reason) by the MotionMachine of each camera.

    A camera's frames are dealt by ranges to many tasks. Each range is first summed up as a function of the state it begins
    in; the functions are applied one after another, a short row for each range, and then each range gives its clips.
    ranges: how many to deal to. A missing flag is no motion; frames without number are left out.
    """
    machine = MotionMachine(fps, **rules)
    need, delay, longest, warm = machine.need, machine.delay, machine.longest, machine.warm
    df = frames.select(F.col(camera).cast("string").alias("camera"), F.col(frame).cast("long").alias("frame"), F.coalesce(F.col(flag).cast("boolean"), F.lit(False)).alias("moves")).where("frame is not null")
    order = ["camera", "frame", "moves"]
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    dealt = materialize(dealt.withColumn(PART, F.spark_partition_id()), "ranges")
    before = Window.partitionBy("camera").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("camera", PART).agg(F.count("*").alias("own")).withColumn("ahead", F.coalesce(F.sum("own").over(before), F.lit(0)))

    def of(pdf: pd.DataFrame) -> MotionRange | None:
        pdf = pdf.sort_values(["frame", "moves"], kind="stable").iloc[max(0, warm - int(pdf["ahead"].iloc[0])) :]
        return MotionRange(pdf["frame"].to_numpy(), pdf["moves"].to_numpy(bool), need, delay, longest) if len(pdf) else None

    def sum_up(pdf: pd.DataFrame) -> pd.DataFrame:
        part = of(pdf)
        return pd.DataFrame({"camera": pdf["camera"].iloc[:1], PART: pdf[PART].iloc[:1], "part": [json.dumps(part.summary()) if part else None]})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        state, out = ("closed", 0), []
        for number, text in pdf.sort_values(PART)[[PART, "part"]].itertuples(index=False):
            out.append((pdf["camera"].iloc[0], number, json.dumps(state), False))
            if text:
                part = json.loads(text)
                state = state_behind(part, state, delay)
        out[-1] = (*out[-1][:3], True)
        return pd.DataFrame(out, columns=["camera", PART, "state", "ends"])

    def give(pdf: pd.DataFrame) -> pd.DataFrame:
        part, clips = of(pdf), []
        state = tuple(json.loads(pdf["state"].iloc[0]))
        if part:
            state = part.walk(state, clips)
        if pdf["ends"].iloc[0] and state[0] == "open":
            clips.append((state[1], int(pdf["frame"].max()), "end"))
        return pd.DataFrame([(pdf["camera"].iloc[0], *c) for c in clips], columns=["camera", "start", "end", "reason"])

    same = F.col("camera").eqNullSafe(F.col("c")) & (F.col(PART) == F.col("p"))
    key = [F.col("camera").alias("c"), F.col(PART).alias("p")]
    with_ahead = dealt.join(counts.select(*key, "ahead"), same).drop("c", "p")
    parts = with_ahead.groupBy("camera", PART).applyInPandas(sum_up, f"camera string, {PART} int, part string")
    states = materialize(parts.groupBy("camera").applyInPandas(chain, f"camera string, {PART} int, state string, ends boolean"), "states")
    ready = with_ahead.join(states.select(*key, "state", "ends"), same).drop("c", "p")
    return ready.groupBy("camera", PART).applyInPandas(give, "camera string, start long, end long, reason string")


def multi_camera_events(frames: DataFrame, site: str, ts: str, flag: str, gap_seconds: int = 5, part_seconds: int = 120) -> DataFrame:
    """(site, event, start, end, n_cameras, n_parts): islands of motion on any camera of a site, parted by quiet gaps."""
    moving = frames.where(F.col(flag)).withColumn("__t", F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6))
    w = Window.partitionBy(site).orderBy("__t", "camera")
    new = F.coalesce(F.col("__t") - F.lag("__t").over(w) > gap_seconds, F.lit(True)).cast("int")
    marked = moving.withColumn("__new", new).withColumn("event", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy(site, "event").agg(F.min("__t").alias("start_s"), F.max("__t").alias("end_s"), F.countDistinct("camera").alias("n_cameras"))
    return out.withColumn("n_parts", (F.floor((F.col("end_s") - F.col("start_s")) / part_seconds) + 1).cast("long"))


def multi_camera_parts(frames: DataFrame, site: str, camera: str, ts: str, flag: str, gap_seconds: int = 5, part_seconds: int = 120) -> DataFrame:
    """(site, event_id, part, start_us, end_us, n_cameras): the parts of each event of a site, as streaming.event_parts gives
    them when all events have ended."""
    rows = frames.where(F.col(flag)).select(F.col(site).cast("string").alias("site"), F.col(camera).cast("string").alias("camera"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    w = Window.partitionBy("site").orderBy("us", "camera")
    new = F.coalesce((F.col("us") - F.lag("us").over(w) > gap_seconds * 1_000_000).cast("int"), F.lit(1))
    events = rows.withColumn("new", new).withColumn("event", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    opened = F.min("us").over(Window.partitionBy("site", "event"))
    parts = events.withColumn("opened_us", opened).withColumn("part", F.floor((F.col("us") - F.col("opened_us")) / (part_seconds * 1_000_000)))
    out = parts.groupBy("site", "opened_us", "part").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.countDistinct("camera").alias("n_cameras"))
    return out.select("site", F.sha1(F.concat_ws("|", "site", F.col("opened_us").cast("string"))).alias("event_id"), "part", "start_us", "end_us", "n_cameras")
