import json
from functools import partial

from pyspark.sql import functions as F

from tidewell.operators import runs
from tidewell.plans import registry
from tidewell.plans.adapters import view
from tidewell.streaming import machines, streams


def test_motion_stream_equals_batch(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/events.parquet").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("frame"), (F.col("value") > 50).alias("moves"))
    batch = runs.motion_clips(e, "user_id", "frame", "moves", fps=2.0, delay=1.0, longest=1e9).where("reason <> 'end'")
    stream = registry.queries()["motion_clip_stream"](spark, sf_small)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_outage_stream_equals_batch(spark, sf_small):
    q = registry.queries()
    assert sorted(map(tuple, q["outage_stream"](spark, sf_small).collect())) == sorted(map(tuple, q["outages"](spark, sf_small).collect()))


def test_sessions_equal_events(spark, sf_small):
    stream = registry.queries()["session_stream"](spark, sf_small)
    batch = runs.multi_camera_events(view(spark, sf_small, "motion"), "site", "ts", "has_motion", 3600)
    starts = {(r["site"], round(r["start_s"] * 1e6)) for r in batch.collect()}
    assert all((r["site"], r["start_us"]) in starts for r in stream.collect())


def test_event_parts_stream_equals_batch(spark, sf_small):
    stream = {tuple(r) for r in registry.queries()["event_parts_stream"](spark, sf_small).collect()}
    m = view(spark, sf_small, "motion").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = {tuple(r) for r in runs.multi_camera_parts(m, "site", "camera", "ts", "has_motion", 3600, 7200).collect()}
    assert stream <= batch and len(batch) - len(stream) <= 3  # what is still open at the end of the input is not given


def test_batches_are_written_anew(spark, tmp_path):
    """A batch that is tried again replaces its rows; numbers go on from the batches before."""
    b = spark.range(3)
    for n in (0, 1, 1):
        streams.write_batch(b, n, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6
    schema = "us long, device string"
    for i, rows in enumerate(([(5, "b"), (3, "a")], [(4, "a"), (9, "c")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streams.write_outages(source, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ["us", "device"])
        got = sorted((r["incident"], r["us"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
        assert got == [(1, 3), (2, 5), (3, 4), (4, 9)][: 2 * i + 2]


def test_state_ends(spark, tmp_path):
    """Tracks, events and outputs are given when later time tells they ended, over several batches, and once."""
    t0 = 1_700_000_000
    batches = [[(t0, 0.1), (t0 + 1, 0.9)], [(t0 + 2, 0.2), (t0 + 3, 0.3)], [(t0 + 500, 0.4)], [(t0 + 900, 0.1)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(float(t), x) for t, x in rows], "t double, x double").selectExpr("timestamp_seconds(t) ts", "x", "'c' clip", "1 track", "cast(t as long) pos", "'k' cls", "cast(10 * x as long) size", "x > 0.15 moves")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        # one file a batch, in the order of writing
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run(df, name):
        streams.run_available(df, str(tmp_path / name), str(tmp_path / f"{name}-c"))
        return sorted(tuple(r) for r in spark.read.schema(df.schema).parquet(str(tmp_path / name)).collect())

    us = t0 * 1_000_000
    tracks = run(streams.crossing_stream(source(), "clip", "track", "ts", "pos", "x", "cls", 0.25, 60, "1 second"), "tracks")
    assert tracks == [("c", 1, us, 4, 0.1, 0.3, "k", "r"), ("c", 1, us + 500_000_000, 1, 0.4, 0.4, "k", None)]
    parts = run(streams.event_parts(source(), "clip", "track", "ts", "moves", 5, 2, "1 second"), "parts")
    assert sorted((r[3] - us, r[4] - us, r[2], r[5]) for r in parts) == [(1_000_000, 2_000_000, 0, 1), (3_000_000, 3_000_000, 1, 1), (500_000_000, 500_000_000, 0, 1)]
    assert len({r[1] for r in parts}) == 2
    stalled = run(streams.stalled_outputs(source(), "clip", "ts", "size", 100, "1 second"), "stalled")
    assert stalled == [("c", "absent", us + 3_000_000), ("c", "absent", us + 500_000_000), ("c", "stalled", us + 1_000_000)]


S = 1_000_000


def run_machine(machine, rows):
    """A machine's results of all rows in order, and of the time behind them; its state goes through JSON at each row."""
    make, state, out = machine, None, []
    for r in sorted(rows):
        m = make(state)
        out += m.step(*r)
        state = json.loads(json.dumps(m.state)) if m.state is not None else None
    m = make(state)
    return out + m.until(10**18)


def test_camera_clips_rules():
    """The protocol rule by rule: fan-out, rollover, end for all, refusal while draining, end before rollover, silence."""
    make = partial(machines.Coordinator, gap=5 * S, length=20 * S, need=2)
    frame = lambda t, cam, moves=False: (int(t * S), cam, moves)
    # a opens at its second moving frame; b joins at its next one; motion of b keeps the event open; both end by one decision
    rows = [frame(0, "a", True), frame(0.5, "b"), frame(1, "a", True), frame(1.5, "b"), *[frame(t, "a") for t in range(2, 10)], frame(2.5, "b", True), frame(5.5, "b"), frame(7.6, "b"), frame(8.5, "b")]
    assert run_machine(make, rows) == [(S, 0, "b", 1_500_000, 7_600_000, "final", "a"), (S, 0, "a", S, 8 * S, "final", "a")]
    # rollover: found by a at 21, b ends its part at its next frame, and both go on at the frame behind
    rows = [frame(t / 2, "a", True) for t in range(0, 50)] + [frame(t + 0.25, "b", True) for t in range(1, 25)]
    got = run_machine(make, rows)
    assert got[0] == (500_000, 0, "a", 500_000, 20_500_000, "part", "a") and got[1] == (500_000, 0, "b", 1_250_000, 21_250_000, "part", "a")
    assert [(x[1], x[2], x[3], x[5]) for x in got[2:]] == [(1, "a", 21 * S, "silent"), (1, "b", 22_250_000, "silent")]
    # refusal: a finds the end at 6; b, slower, still records; a moves again and may not join; b leaves at 9; then a opens anew
    rows = [frame(0, "a", True), frame(0.5, "a", True), frame(1, "b"), frame(3, "a"), frame(5.4, "b"), frame(6, "a"), frame(6.5, "a", True), frame(7, "a", True), frame(8, "a", True), frame(9, "b"), frame(9.5, "a", True), frame(10, "b")]
    got = run_machine(make, rows)
    assert got[:3] == [(500_000, 0, "a", 500_000, 6 * S, "final", "a"), (500_000, 0, "a", 7 * S, 7 * S, "refused", "a"), (500_000, 0, "b", S, 9 * S, "final", "a")]
    assert [x[0] for x in got[3:]] == [9_500_000, 9_500_000] and {x[2] for x in got[3:]} == {"a", "b"}
    # both are due at one frame: the end wins, and no next part begins
    rows = [frame(0, "a", True), frame(1, "a", True), *[frame(t, "a", t <= 16) for t in range(2, 30)]]
    assert run_machine(make, rows) == [(S, 0, "a", S, 21 * S, "final", "a")]
    # the end is found between b's end of a part and its next frame: b leaves without another clip
    rows = [frame(0, "a", True), frame(0.5, "a", True), *[frame(t, "b", t <= 16) for t in range(1, 21)], *[frame(t + 0.5, "a", t <= 15) for t in range(1, 24)], frame(20.9, "b"), frame(24.9, "b")]
    got = run_machine(make, rows)
    assert [x[2:6] for x in got if x[2] == "b"][:1] == [("b", S, 20_900_000, "part")] and not [x for x in got if x[2] == "b" and x[1] == 1]
    # a camera that is silent for the gap leaves at its last frame, and can't hold the event open
    rows = [frame(0, "a", True), frame(0.5, "a", True), frame(1, "b"), *[frame(t, "a", t < 9) for t in range(2, 20)]]
    assert run_machine(make, rows) == [(500_000, 0, "b", S, S, "silent", "a"), (500_000, 0, "a", 500_000, 13 * S, "final", "a")]


def test_camera_clips_any_order(spark, sf_small):
    """The stream of overlapping batches gives what the machine gives of all frames in order."""
    got = registry.queries()["camera_clips_stream"](spark, sf_small).collect()
    rows = spark.read.parquet(f"{sf_small}/events.parquet").selectExpr("cast(user_id % 2 as string) site", "unix_micros(cast(ts as timestamp)) us", "cast(user_id % 3 as string) camera", "value > 80 moves").collect()
    mark = max(r["us"] for r in rows) // 1000 * 1000 - 3 * 3600 * S
    want = []
    for site in ("0", "1"):
        own = [(r["us"], r["camera"], r["moves"]) for r in rows if r["site"] == site and r["us"] <= mark]
        m, state = None, None
        for r in sorted(own):
            m = machines.Coordinator(state, 6 * 3600 * S, 8 * 3600 * S, 1)
            want += [(site, *x[1:]) for x in m.step(*r)]
            state = m.state
        want += [(site, *x[1:]) for x in machines.Coordinator(state, 6 * 3600 * S, 8 * 3600 * S, 1).until(mark)]
    assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got) == sorted(want)
    assert {r["reason"] for r in got} >= {"final", "part", "silent", "refused"}


def test_late_rows(spark, tmp_path):
    """An event is one, whatever order its frames come in: 0 to 10 s, then 8 s again, then 14 s."""
    base = 1_700_000_000
    for rows in ([0, 5, 10], [8], [14], [200]):
        spark.createDataFrame([(float(base + t),) for t in rows], "t double").selectExpr("timestamp_seconds(t) ts", "'s' site", "'c' camera", "true moves").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("ts timestamp, site string, camera string, moves boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    parts = streams.event_parts(source, "site", "camera", "ts", "moves", 5, 120, "1 minute")
    streams.run_available(parts, str(tmp_path / "out"), str(tmp_path / "c"))
    assert [((r["start_us"] - base * S) // S, (r["end_us"] - base * S) // S) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(0, 14)]


def test_outputs_that_never_report(spark, tmp_path):
    """Expected outputs are absent since they were expected, once, when time has passed; those that report in time are not."""
    t0 = 1_700_000_000
    for rows in ([(0, "a", 1)], [(50, "a", 2), (55, "b", 1)], [(120, "b", 2)], [(400, "b", 3)], [(800, "b", 4)]):
        spark.createDataFrame([(float(t0 + t), k, n) for t, k, n in rows], "t double, key string, size long").selectExpr("timestamp_seconds(t) ts", "key", "size").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    expected = spark.createDataFrame([("a", t0), ("b", t0), ("c", t0), ("d", t0 + 700), ("e", t0 + 3600)], "key string, s long").selectExpr("key", "timestamp_seconds(s) ts")
    source = spark.readStream.schema("ts timestamp, key string, size long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stalled = streams.stalled_outputs(source, "key", "ts", "size", 60, "10 seconds", expected)
    streams.run_available(stalled, str(tmp_path / "out"), str(tmp_path / "c"))
    got = sorted((r["key"], r["kind"], r["since_us"] // S - t0) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", "absent", 50), *[("b", "absent", t) for t in (55, 120, 400)], ("c", "absent", 0), ("d", "absent", 700)]


def test_watch_clips(spark, tmp_path):
    """Each clip once; young ones wait; a failed one is tried again after a restart; a changed one is another clip."""
    import os
    import time

    clips, ledger, checkpoint = tmp_path / "clips", str(tmp_path / "ledger"), str(tmp_path / "checkpoint")
    (clips / "cam").mkdir(parents=True)
    old = time.time() - 1000
    for name, text in (("a.mp4", "aa"), ("b.mp4", ""), ("cam/c.mp4", "cccc"), ("young.mp4", "y"), ("note.txt", "n")):
        (clips / name).write_text(text)
        if name != "young.mp4":
            os.utime(clips / name, (old, old))

    def process(df):
        fails = df.path.endswith("c.mp4") & (df.attempt == 0)
        return df.select("path", "size", "modified", F.when(fails, "broken").alias("error"), (F.col("size") * 10).alias("result"), "attempt")

    seen = []

    def run():
        streams.watch_clips(spark, str(clips), ledger, checkpoint, process, "*.mp4", 240).awaitTermination()
        rows = [r for r in spark.read.parquet(ledger).collect() if r["batch"] not in seen]
        seen.extend({r["batch"] for r in rows})
        return sorted((r["path"].rpartition("/")[2], r["error"], r["attempt"]) for r in rows)

    assert run() == [("a.mp4", None, 0), ("b.mp4", None, 0), ("c.mp4", "broken", 0)]
    assert run() == [("c.mp4", None, 1)]
    assert run() == []
    (clips / "a.mp4").write_text("aaa")
    os.utime(clips / "a.mp4", (old + 1, old + 1))
    os.utime(clips / "young.mp4", (old, old))
    assert run() == [("a.mp4", None, 0), ("young.mp4", None, 0)]
    done = sorted((r["path"].rpartition("/")[2], r["result"], r["failures"]) for r in streams.ledger_results(spark, ledger).collect())
    assert done == [("a.mp4", 20, 0), ("a.mp4", 30, 0), ("b.mp4", 0, 0), ("c.mp4", 40, 1), ("young.mp4", 10, 0)]


def test_waiting_rows_are_packed():
    """Rows that wait pass to the state by packs, not one by one, and are given in order whatever their packs."""
    import pandas as pd

    from tidewell.streaming.event_time import InOrder

    class State:
        def __init__(self):
            self.rows, self.calls = [], 0

        def appendList(self, rows):
            self.rows += rows
            self.calls += 1

        def get(self):
            return iter(list(self.rows)) if self.rows is not None else None

        exists = lambda self: bool(self.rows)

        def clear(self):
            self.rows = []

    class Value(State):
        get = lambda self: self.rows[-1] if self.rows else None

        def update(self, value):
            self.rows = [value]

    class Handle:
        def getListState(self, *_):
            return State()

        def getValueState(self, *_):
            return Value()

        def registerTimer(self, at):
            pass

    class Machine:
        state = None

        def step(self, us, x):
            return [(us, x)]

        def until(self, us):
            return []

        def wait(self):
            return None

    class Times:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    p = InOrder(lambda s: Machine(), "us long, x double", ["k", "us", "x"])
    p.init(Handle())
    us = [(i * 7919) % 20_000 * 1000 for i in range(20_000)]
    parts = [pd.DataFrame({"us": us[i::2], "x": [None if u == 0 else 0.5 for u in us[i::2]]}) for i in (0, 1)]
    list(p.handleInputRows(("a",), iter(parts), None))
    assert p.waiting.calls == len(p.waiting.rows) == 2
    got = [pd.concat(p.handleExpiredTimer(("a",), Times(ms), None)) for ms in (9_999, 19_999)]
    assert [x["us"].tolist() for x in got] == [list(range(0, 10_000_000, 1000)), list(range(10_000_000, 20_000_000, 1000))]
    assert p.waiting.rows == []
