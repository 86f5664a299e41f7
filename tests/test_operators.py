import hashlib
import json
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import balance, counts, measures, ordered, runs, sampling, similarity, stats, tasks, tracks


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_interpolation(spark):
    k = spark.createDataFrame([("v", 0, 10, 0, 0.0, True), ("v", 0, 12, 1, 20.0, True), ("u", 0, 10, 0, 0.0, False), ("u", 0, 12, 1, 5.0, None), ("n", 0, -3, 0, 1.0, True)], "stem string, track int, frame int, kf_pos int, x double, enabled boolean")
    got = rows(tracks.interpolate_tracks(k, ["stem", "track"], values=("x",)), "stem", "frame", "x", "keyframe")
    assert got == [("u", 10, 0.0, True), ("u", 12, 5.0, True), ("v", 10, 0.0, True), ("v", 11, 10.0, False), ("v", 12, 20.0, True)]
    assert rows(tracks.interpolate_tracks(k, ["stem", "track"], values=("x",), stride=2, offset=1), "frame") == [(11,)]
    assert rows(tracks.interpolate_tracks(k.limit(0), ["stem", "track"], values=("x",)), "frame") == []


def test_crossings_and_votes(spark):
    d = spark.createDataFrame([("c", 1, 0, 0.2, "a", 0.1), ("c", 1, 1, 0.5, "b", 0.9), ("c", 2, 0, 0.5, "a", 1.0), ("c", 2, 5, 0.9, "a", 1.0), ("c", 3, 0, 0.9, "b", 1.0), ("c", 3, 2, 0.5, "b", 1.0)], "clip string, track int, frame int, x double, cls string, conf double")
    got = dict(rows(tracks.line_crossings(d, ["clip", "track"], ["frame"]), "track", "direction"))
    assert got == {1: "r", 2: None, 3: "l"}
    assert rows(tracks.vote_class(d, ["clip", "track"], ["frame"]), "track", "cls") == [(1, "a"), (2, "a"), (3, "b")]
    assert rows(tracks.vote_class(d, ["clip", "track"], ["frame"], method="confidence"), "track", "cls")[0] == (1, "b")
    with pytest.raises(ValueError):
        tracks.vote_class(d, ["clip"], ["frame"], method="odd")


def test_track_budget(spark):
    # ten missed frames are allowed in all, and never given back
    frames = [0, 6, 12, 13, 40, 99]
    d = spark.createDataFrame([("c", 1, f, 100) for f in frames], "clip string, track int, frame int, length int")
    assert rows(tracks.track_runs(d, "clip", "track", "frame", "length"), "run", "start", "end", "n") == [(0, 0, 13, 4), (1, 40, 40, 1)]


def test_track_budget_over_rows_and_batches(spark, monkeypatch):
    """Runs that go on over packed rows, and tracks over batches, against the rule read frame by frame."""
    monkeypatch.setattr(tracks, "RUN_FRAMES", 16)
    rng, data, want = random.Random(3), [], []
    for clip, track in [(c, t) for c in ("a", "b", None) for t in (1, 2, None)]:
        frames = sorted(rng.sample(range(-20, 400), rng.choice([1, 40, 150])))
        data += [(clip, track, f, 380) for f in [*frames, frames[0], None]]
        run, kept = 0, []
        for f in [f for f in frames if f < 379]:
            if kept and f - kept[0] - len(kept) > 10:
                want.append((clip, track, run, kept[0], kept[-1], len(kept)))
                run, kept = run + 1, []
            kept.append(f)
        want += [(clip, track, run, kept[0], kept[-1], len(kept))] if kept else []
    rng.shuffle(data)
    d = spark.createDataFrame(data, "clip string, track int, frame int, length int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = [tuple(r) for r in tracks.track_runs(d, "clip", "track", "frame", "length").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_track_budget_of_many_runs(spark):
    """Work grows with the frames of a track, not with their number times that of its runs."""
    n = 100_000
    d = spark.range(n).selectExpr("'c' clip", "1 track", "int(id * 12) frame", f"{n * 12} length")
    began = time.monotonic()
    got = tracks.track_runs(d, "clip", "track", "frame", "length").selectExpr("count(*) runs", "sum(n) frames", "max(run) last", "bool_and(start = run * 12 and end = start) whole").first()
    assert tuple(got) == (n, n, n - 1, True)
    assert time.monotonic() - began < 60


def test_objects_keep_ids(spark):
    o = spark.createDataFrame([("s", 0, 0, 0.0, 0.0), ("s", 0, 1, 100.0, 0.0), ("s", 1, 0, 101.0, 0.0), ("s", 2, 0, 1.0, 0.0)], "seq string, frame int, pos int, x double, y double").selectExpr("*", "2.0 w", "2.0 h")
    assert rows(tracks.track_objects(o, "seq", "frame", "pos", radius=5.0), "frame", "object_id") == [(0, 0), (0, 1), (1, 1), (2, 0)]


def test_detection_metrics(spark):
    t = spark.createDataFrame([("i", "a", 0.0, 0.0, 1.0, 1.0, 1), ("i", "a", 2.0, 0.0, 3.0, 1.0, 2)], "image string, cls string, x1 double, y1 double, x2 double, y2 double, pos long")
    p = spark.createDataFrame([("i", "a", 0.0, 0.0, 1.0, 1.0, 1, 0.9), ("i", "a", 0.0, 0.0, 1.0, 0.9, 2, 0.8), ("i", "a", 2.0, 0.0, 3.0, 1.0, 3, 0.7)], "image string, cls string, x1 double, y1 double, x2 double, y2 double, pos long, conf double")
    assert rows(tracks.detection_metrics(p, t), "n_truth", "n_pred", "ap") == [(2, 3, pytest.approx((1 + 2 / 3) / 2))]


def test_l1_and_groups(spark):
    a = spark.createDataFrame([("f", "a", 0.5), ("f", "b", 0.5)], "feature string, key string, p double")
    b = spark.createDataFrame([("f", "a", 1.0)], "feature string, key string, p double")
    assert rows(stats.l1_distance(a, b), "feature", "l1") == [("f", 1.0)]
    boxes = spark.createDataFrame([("g", "s", 1, 0, 0.1, 0.1), ("g", "s", 1, 1, 0.1, 0.1), ("g", "s", 2, 0, 0.1, 0.3)], "g string, stem string, frame int, cls int, w double, h double")
    hist = stats.group_hist(boxes, "g", "stem", "frame", "cls", "w", "h")
    assert rows(hist.where("feature = 'class'"), "key", "cnt") == [("0", 2), ("1", 1)]
    assert rows(stats.group_stats(boxes, "g", "stem", "frame"), "n_frames", "n_boxes") == [(2, 3)]


def test_conditions(spark):
    c = spark.createDataFrame([(1, "1", "2"), (2, "1", "2"), (3, "2", "2"), (4, None, "2")], "id int, turbidity string, lighting string")
    assert rows(stats.active_columns(c, ["turbidity", "lighting"]), "col") == [("turbidity",)]
    assert rows(stats.condition_targets(c, ["turbidity"]), "val", "target") == [("1", 1), ("2", 1)]
    assert rows(balance.balance_conditions(c, ["turbidity"], "id"), "id") == [(1,), (3,)]


def test_negatives(spark):
    v = spark.createDataFrame([("v", 10), ("w", 0), (None, 5)], "stem string, n int")
    p = spark.createDataFrame([("v", 0), ("v", 3), ("v", 6)], "stem string, frame int")
    got = tasks.eligible_negatives(v.where("stem is not null"), p, "stem", "n", "frame", 3, "fixed", 0)
    assert rows(got, "stem", "frame") == [("v", 9)]
    empty = spark.createDataFrame([("a", f) for f in range(9)] + [("b", f) for f in range(9)], "stem string, frame int")
    few = sampling.sample_per_group(empty, ["stem"], ["frame"], 3, seed=4)
    assert few.count() == 6
    chosen = sampling.sample_negatives(empty, "stem", "frame", 8, 0.25, 3, seed=4)
    assert chosen.count() == 2
    again = sampling.sample_negatives(empty.repartition(7), "stem", "frame", 8, 0.25, 3, seed=4)
    assert rows(chosen, "stem", "frame") == rows(again, "stem", "frame")
    assert sampling.sample_negatives(empty, "stem", "frame", 0, 0.25, 3).count() == 0


def test_stratified(spark):
    m = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(100)], "id int, site string")
    s = sampling.stratified_subset(m, "site", ["id"], n=25, seed=1)
    assert rows(s.groupBy("site").count(), "site", "count") == [("a", 22), ("b", 3)]  # equal remainders: the last name first
    with pytest.raises(ValueError):
        sampling.target_count(5, 0.5, 3)
    split = sampling.random_split(m, "id", seed=2)
    assert dict(rows(split.groupBy("split").count(), "split", "count")) == {"train": 70, "val": 15, "test": 15}


def test_shards(spark):
    m = spark.range(95).select("id").repartition(6)
    got = rows(sampling.shard(m, ["id"], 20).groupBy("shard").agg({"id": "min", "*": "count"}), "shard", "min(id)", "count(1)")
    assert got == [(f"shard-{i:06d}", 20 * i, 20 if i < 4 else 15) for i in range(5)]


def test_split_groups(spark):
    boxes = spark.createDataFrame([(f"g{i % 12}", f"v{i % 12}", i, (i // 12) % 3, 0.1, 0.1 * (1 + (i // 12) % 2)) for i in range(240)], "g string, stem string, frame int, cls int, w double, h double")
    hist = stats.group_hist(boxes, "g", "stem", "frame", "cls", "w", "h")
    out = balance.split_groups(stats.group_stats(boxes, "g", "stem", "frame"), hist, "g", "n_frames", stats.rarity(hist, "g"))
    got = dict(rows(out, "g", "split"))
    assert len(got) == 12 and {"train", "val", "test"} == set(got.values())
    assert sum(s == "train" for s in got.values()) == 10


def test_split_by_counts(spark):
    c = spark.createDataFrame([(f"c{i}", "x", 10) for i in range(20)] + [("c0", "rare", 1), ("c1", "rare", 1), ("c2", "rare", 1)], "clip string, species string, n int")
    got = dict(rows(balance.split_by_counts(c, "clip", "species", "n"), "clip", "split"))
    assert len(got) == 20 and sorted(got[k] for k in ("c0", "c1", "c2")) == ["test", "train", "val"]


def test_outages(spark):
    t = lambda s: f"2025-01-01 00:00:{s:02d}"
    logs = spark.createDataFrame([("d", t(0), 0, True, False), ("d", t(5), 1, False, True), ("d", t(9), 2, True, False), ("d", t(20), 3, True, False), ("d", t(21), 4, False, True)], "device string, ts string, pos int, restart boolean, healthy boolean").selectExpr("device", "cast(ts as timestamp) ts", "pos", "restart", "healthy")
    out = runs.detect_outages(logs, "device", ["pos"], "ts", "restart", "healthy")
    assert rows(out, "uptime_s", "downtime_s") == [(5.0, 4.0)]
    assert runs.detect_outages(logs, "device", ["pos"], "ts", "restart", "healthy", 5).count() == 0
    assert rows(runs.number_outages(out, ["restart_ts"]), "incident") == [(1,)]


def test_motion_clips(spark):
    flags = [0] * 10 + [1] * 3 + [0] * 8 + [1] * 2
    f = spark.createDataFrame([("c", i, bool(x)) for i, x in enumerate(flags)], "cam string, frame int, moves boolean")
    got = rows(runs.motion_clips(f, "cam", "frame", "moves", fps=10.0, delay=0.5), "start", "end", "reason")
    assert got == [(11, 18, "quiet"), (22, 22, "end")]


def machine_clips(frames, moves, **rules):
    m = runs.MotionMachine(1.0, **rules)
    found = [m.step(f, x) for f, x in zip(frames, moves, strict=True)]
    return [c for c in [*found, m.end()] if c]


def test_motion_ranges_compose():
    """Ranges as functions of the state before them: by their summaries and by themselves they give what the machine gives."""
    r = np.random.default_rng(5)
    for _ in range(800):
        n = int(r.integers(1, 60))
        frames, moves = np.cumsum(r.integers(1, 4, size=n)), np.repeat(r.random(n) < r.choice([0.3, 0.5, 0.9]), int(r.integers(1, 4)))[:n]
        rules = {"warm": 0.0, "need": float(r.integers(1, 4)), "delay": float(r.integers(0, 4)), "longest": float(r.integers(0, 12))}
        m = runs.MotionMachine(1.0, **rules)
        cuts = sorted({0, n, *r.integers(0, n + 1, size=4).tolist()})
        state, clips = ("closed", 0), []
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = runs.MotionRange(frames[a:b], moves[a:b], m.need, m.delay, m.longest)
            told = runs.state_behind(json.loads(json.dumps(part.summary())), state, m.delay)
            state = part.walk(state, clips)
            assert told == state
        if state[0] == "open":
            clips.append((state[1], int(frames[-1]), "end"))
        assert clips == machine_clips(frames.tolist(), moves.tolist(), **rules)


def test_motion_clips_over_many_tasks(spark):
    """A camera whose frames lie in many ranges, beside short ones, with frames to ignore at the beginning."""
    r = random.Random(3)
    data = [("long", i, r.random() < 0.6) for i in range(3000)] + [("b", i * 2, r.random() < 0.5) for i in range(40)] + [("c", 1, True), ("d", 1, None)]
    f = spark.createDataFrame(data, "cam string, frame int, moves boolean")
    rules = {"warm": 5.0, "need": 2.0, "delay": 3.0, "longest": 30.0}
    got = rows(runs.motion_clips(f, "cam", "frame", "moves", fps=1.0, ranges=9, **rules), "camera", "start", "end", "reason")
    want = [(c, *x) for c in "bcd" for x in machine_clips([d[1] for d in data if d[0] == c], [bool(d[2]) for d in data if d[0] == c], **rules)]
    want += [("long", *x) for x in machine_clips(range(3000), [d[2] for d in data if d[0] == "long"], **rules)]
    assert got == sorted(want) and len(got) > 50


def test_segments_and_collisions(spark):
    c = spark.createDataFrame([("a", 250.0), ("b", 0.0)], "clip string, seconds double").selectExpr("*", "timestamp '2025-01-01' start")
    assert rows(runs.segment_clips(c, "seconds", "start"), "clip", "part", "part_seconds") == [("a", 0, 120.0), ("a", 1, 120.0), ("a", 2, 10.0), ("b", 0, 0.0)]
    there = spark.createDataFrame([("a",)], "clip string")
    assert rows(runs.resolve_collisions(c, there, "clip"), "clip") == [("b",)]
    assert rows(runs.resolve_collisions(c, there, "clip", "error"), "clip", "error") == [("a", "exists"), ("b", None)]


def test_counts(spark):
    g = spark.createDataFrame([("f", "l", "x", 4), ("f", "r", "x", 1), ("g", "l", "x", 9)], "filename string, direction string, species string, n long")
    p = spark.createDataFrame([("f", "l", "x", 2), ("f", "r", "y", 1)], "filename string, direction string, species string, n long")
    assert rows(counts.nmae(g, p, "filename"), "species", "abs_error", "gt") == [("x", 3, 5), ("y", 1, 0)]
    assert rows(counts.net_upstream(g, "filename"), "net") == [(12,)]
    wide = counts.counts_wide(g, "filename", [("l", "x"), ("r", "x")])
    assert rows(wide, "filename", "l_x", "r_x") == [("f", 4, 1), ("g", 9, 0)]
    assert rows(counts.counts_long(wide, "filename").where("n > 0"), "filename", "direction", "species", "n") == rows(g, "filename", "direction", "species", "n")


def test_measures(spark):
    m = spark.createDataFrame([("r", i * 60 + (1000 if i > 2 else 0), float(i)) for i in range(6)], "r string, s long, v double").selectExpr("r", "timestamp_seconds(s) ts", "v")
    got = measures.mask_first(m, "r", "ts", "v", 2)
    assert [r["v"] for r in got.orderBy("ts").collect()] == [None, None, 2.0, None, None, 5.0]
    assert rows(measures.box_summary(m, ["r"], "v"), "n", "q1", "median", "q3", "low", "high") == [(6, 1.25, 2.5, 3.75, 0.0, 5.0)]
    assert measures.mask_outliers(m, ["v"], low=4).count() == 2


def test_similarity(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0]), (4, None)], "id long, v array<float>")
    got = dict(rows(similarity.max_similarity(v, "id", "v", block=2), "id", "max_sim"))
    assert got == {1: pytest.approx(0.5**0.5), 2: pytest.approx(0.5**0.5), 3: pytest.approx(0.5**0.5)}
    assert not rows(similarity.max_similarity(v.limit(0), "id", "v"), "id")


@pytest.mark.parametrize("spread", [0.05, 10.0])
def test_similarity_by_shells(spark, spread):
    """Equal maxima where most blocks are pruned (clusters) and where hardly any is; zero vectors, copies, repeated ids."""
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 8))
    v = (centres[r.integers(0, 12, size=600)] + spread * r.normal(size=(600, 8))).astype(np.float32)
    v[5], v[7] = 0, v[6]
    ids = [*range(598), 3, 3]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in zip(ids, v, strict=True)], "id long, v array<float>")
    u = v.astype(float) / np.maximum(np.linalg.norm(v.astype(float), axis=1, keepdims=True), 1e-300)
    s = u @ u.T
    s[np.equal.outer(ids, ids)] = -np.inf
    want = {}
    for i, x in zip(ids, s.max(axis=1), strict=True):
        want[i] = max(want.get(i, -1.0), x)
    for block in (20, 2000):
        assert dict(rows(similarity.max_similarity(df, "id", "v", block=block), "id", "max_sim")) == pytest.approx(want)
    if spread < 1:
        assert similarity.compared_share(df, "id", "v", block=20) < 0.3


def test_tasks(spark):
    t = spark.createDataFrame([("t", "2025-01-02", 0), ("t", "2025-01-02", 1), ("t", None, 2)], "task string, u string, pos int")
    assert rows(tasks.latest_annotation(t, "task", "u", "pos"), "pos") == [(0,)]
    assert rows(tasks.dedupe_last(t, "task", ["pos"]), "pos") == [(2,)]
    a, b = spark.createDataFrame([("v", 1)], "k string, x int"), spark.createDataFrame([("v", 2), ("w", 3)], "k string, x int")
    assert rows(tasks.merge_metadata([a, b], "k"), "k", "x") == [("v", 2), ("w", 3)]
    assert rows(tasks.combine_labels(a, b, "k"), "k", "x", "conflict") == [("v", 1, True), ("w", 3, False)]
    r = spark.createDataFrame([("train", "v", 1), ("train", "v", 2), ("train", "w", 1)], "split string, stem string, frame int")
    meta = spark.createDataFrame([("v", 10.0, "k")], "stem string, fps double, video_key string")
    labels = spark.createDataFrame([("v", 1, "x"), ("w", 1, "x")], "stem string, frame int, label_text string")
    plan = tasks.pack_plan(r, meta, labels, "stem", "frame")
    assert rows(plan, "stem", "frame", "error") == [("v", 1, "label missing"), ("v", 2, "label missing"), ("w", 1, "metadata missing")]


def test_mark_and_ids(spark):
    o = spark.createDataFrame([(0, 0, "interested_objects"), (0, 1, "noises"), (1, 0, "noises")], "frame int, pos int, kind string")
    e = spark.createDataFrame([(0, 0, "delete", 0), (0, 0, "noise", 1), (1, 0, "delete", 2)], "frame int, pos int, action string, edit_pos int")
    assert rows(sampling.mark_boxes(o, e, "frame", "pos"), "frame", "pos", "kind") == [(0, 0, "noises"), (0, 1, "noises")]
    r = spark.createDataFrame([("c", 1, 0), ("c", 1, 1), ("c", 4, 0), ("c", 4, 1)], "clip string, track int, run int")
    assert rows(tracks.unique_instance_ids(r, "clip", "track", "run"), "track", "run", "instance_id") == [(1, 0, 1), (1, 1, 5), (4, 0, 4), (4, 1, 6)]


def test_keyframe_labels(spark):
    seq = "array<struct<frame: double, x: double, y: double, width: double, height: double, enabled: boolean>>"
    t = spark.createDataFrame([(1, "v", [([(2.0, 10.0, 20.0, 40.0, 20.0, True)], ["a"]), ([(2.0, 1.0, 1.0, 1.0, 1.0, True)], ["odd"])]), (2, "w", None)], f"id long, video string, box array<struct<sequence: {seq}, labels: array<string>>>")
    assert rows(tracks.keyframe_labels(t, {"a": 7}, 100, 100), "video", "frame", "class_id", "xc", "yc") == [("v", 2, 7, pytest.approx(0.3), pytest.approx(0.3))]


def test_reviewed_counts(spark):
    t = spark.createDataFrame([("a", {"counts_l_x": "3"}, [([1],)]), ("b", {"counts_r_x": "2"}, [([],)]), ("c", {}, None)], "k string, data map<string,string>, annotations array<struct<result: array<int>>>")
    assert rows(counts.reviewed_counts(t, "k", "data", ["x"]), "k", "direction", "n") == [("a", "l", 3), ("a", "r", 0)]


def test_stratified_sequences(spark):
    c = spark.createDataFrame([(f"s{i}", "x", 10) for i in range(40)] + [(f"s{i}", "y", 1) for i in range(6)], "seq string, label string, n int")
    got = dict(rows(balance.stratified_sequences(c, "seq", "label", "n"), "seq", "split"))
    assert len(got) == 40
    for name in ("train", "val", "test"):
        own = [s for s, x in got.items() if x == name]
        assert any(int(s[1:]) < 6 for s in own) and (name == "train" or len(own) == 6)


def test_balance_is_greedy(spark):
    """The chosen rows are those of the greedy rule read row by row."""
    r = random.Random(5)
    data = [(i, r.choice(["a", "a", "a", "b", "c", None]), r.choice(["x", "y", "y", None]), r.choice("12")) for i in range(300)]
    df = spark.createDataFrame(data, "id long, p string, q string, s string").repartition(4)
    columns = ["p", "q", "s"]
    n = Counter((c, row[j + 1]) for row in data for j, c in enumerate(columns) if row[j + 1] is not None)
    deficit = {k: min(m for (c, _), m in n.items() if c == k[0]) for k in n}
    left, chosen = list(data), []
    while left:
        score = lambda row: sum(deficit.get((c, row[j + 1]), 0) for j, c in enumerate(columns))
        best = max(left, key=lambda row: (score(row), -row[0]))
        if score(best) <= 0:
            break
        chosen.append(best[0])
        left.remove(best)
        for j, c in enumerate(columns):
            k = (c, best[j + 1])
            if deficit.get(k, 0) > 0:
                deficit[k] -= 1
    assert [i for (i,) in rows(balance.balance_conditions(df, columns, "id"), "id")] == sorted(chosen)


def test_tiny_set(spark):
    c = spark.createDataFrame([(f"s{i}", label, 5) for i in range(30) for label in "xyz" if (i + ord(label)) % 3], "seq string, label string, n int")
    got = balance.stratified_sequences(c, "seq", "label", "n").collect()
    tiny = {r["seq"] for r in got if r["tiny"]}
    assert 0 < len(tiny) <= 3 and all(r["split"] == "test" for r in got if r["tiny"])
    assert {r["label"] for r in c.collect() if r["seq"] in tiny} == set("xyz")


def test_ordered(spark, monkeypatch):
    """Ranks, running sums, best values from here and least rows by hash equal those of one list, with nulls among the groups."""
    r = random.Random(3)
    data = [(r.choice(["a", "a", "a", "b", None]), r.randrange(1000), i, r.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, o long, i long, v double").repartition(5)
    run = ordered.with_running(df, ["g"], [F.desc("o"), "i"], {"sum": F.col("o")}, "rank", keep_part=True)
    got = {x["i"]: x for x in ordered.best_from_here(run, ["g"], "rank", ["v"]).collect()}
    for g in ("a", "b", None):
        own = sorted((x for x in data if x[0] == g), key=lambda x: (-x[1], x[2]))
        total, best = 0, [max(y[3] for y in own[k:]) for k in range(len(own))]
        for k, x in enumerate(own):
            total += x[1]
            assert (got[x[2]]["rank"], got[x[2]]["sum"], got[x[2]]["best_v"]) == (k + 1, total, best[k])
    order = lambda x: (hashlib.md5(f"9|{x[2]}".encode()).hexdigest(), x[2])
    for size in (1, 100_000):
        monkeypatch.setattr(ordered, "HASH_ROWS", size)
        some = ordered.least_by_hash(df, [], ["i"], 50, 9)
        assert [x["i"] for x in some.orderBy("i").collect()] == sorted(x[2] for x in sorted(data, key=order)[:50])
        takes = spark.createDataFrame([("a", 7), (None, 3), ("none", 5)], "g string, take long")
        want = sorted(x[2] for g, k in (("a", 7), (None, 3)) for x in sorted((y for y in data if y[0] == g), key=order)[:k])
        assert sorted(x["i"] for x in ordered.least_by_hash(df, ["g"], ["i"], takes, 9).collect()) == want


def test_more_metrics(spark):
    box = lambda i, c, x, pos, *conf: ("i" + str(i), c, x, 0.0, x + 1.0, 1.0, pos, *conf)
    t = spark.createDataFrame([box(1, "a", 0.0, 1), box(1, "a", 5.0, 2), box(2, "b", 0.0, 1), box(3, "none", 0.0, 1)], "image string, cls string, x1 double, y1 double, x2 double, y2 double, pos long")
    p = spark.createDataFrame([box(1, "a", 0.2, 1, 0.9), box(1, "a", 9.0, 2, 0.8), box(2, "b", 0.0, 1, 0.7), box(2, "b", 0.0, 2, 0.6)], "image string, cls string, x1 double, y1 double, x2 double, y2 double, pos long, conf double")
    m = {r["cls"]: r for r in tracks.detection_metrics(p, t, tracks.IOUS).collect()}
    # a: overlap 0.8 / 1.2 = 2/3, so a hit at 0.5, 0.55, 0.6 and 0.65
    assert (m["a"]["ap50"], m["a"]["ap"], m["a"]["precision"], m["a"]["recall"]) == (0.5, pytest.approx(0.2), 1.0, 0.5)
    assert (m["b"]["ap50"], m["b"]["ap"], m["b"]["precision"], m["b"]["recall"]) == (1.0, 1.0, 1.0, 1.0)
    assert (m["none"]["n_pred"], m["none"]["ap"], m["none"]["recall"]) == (0, 0.0, 0.0)
    assert tracks.mean_metrics(tracks.detection_metrics(p, t)).first()["map50"] == pytest.approx(0.5)


def test_clean_attributes(spark):
    raw = ['{"attribute": [{"name": "n", "mutable": "True", "values": "a\\nb"}]}', '[{"name": "m", "mutable": false, "values": ["c"]}]', None, "odd"]
    got = [r["a"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, raw string").orderBy("i").select(tasks.clean_label_attributes(F.col("raw")).alias("a")).collect()]
    assert [tuple(x) for x in got[0]] == [("n", True, ["a", "b"])] and [tuple(x) for x in got[1]] == [("m", False, ["c"])] and not got[2] and not got[3]


def test_split_summary(spark):
    a = spark.createDataFrame([("g1", "train"), ("g2", "train"), ("g3", "val")], "g string, split string")
    g = spark.createDataFrame([("g1", 2, 3), ("g2", 1, 1), ("g3", 4, 4)], "g string, f long, b long")
    h = spark.createDataFrame([("g1", "class", "0", 2), ("g2", "class", "0", 1), ("g2", "tod", "night", 1)], "g string, feature string, key string, cnt long")
    got = {r["split"]: r for r in stats.split_summary(a, g, h, "g", "f", "b").collect()}
    assert (got["train"]["n_groups"], got["train"]["n_frames"], got["train"]["n_boxes"]) == (2, 3, 4)
    assert got["train"]["histograms"] == {"class": {"0": 3}, "tod": {"night": 1}} and got["val"]["histograms"] is None


def test_split_groups_is_greedy(spark):
    """The assignment is that of the rule read group by group with counters."""
    r = random.Random(8)
    data = [(f"g{r.randrange(9)}", f"v{i % 30}", i % 7, r.randrange(3), r.choice([0.05, 0.2, 0.5]), r.choice([0.05, 0.3]), r.choice(["010000", "090000", "200000"])) for i in range(400)]
    boxes = spark.createDataFrame(data, "g string, stem string, frame int, cls int, w double, h double, t string")
    hist, groups = stats.group_hist(boxes, "g", "stem", "frame", "cls", "w", "h", "t"), stats.group_stats(boxes, "g", "stem", "frame")
    rarity = stats.rarity(hist, "g")
    got = dict(rows(balance.split_groups(groups, hist, "g", "n_frames", rarity, seed=4), "g", "split"))
    frames = dict(rows(groups, "g", "n_frames"))
    own = {g: {f: Counter() for f in balance.FEATURES} for g in frames}
    for g, f, k, n in rows(hist, "g", "feature", "key", "cnt"):
        own[g][f][k] += n
    share = lambda c: {k: v / max(sum(c.values()), 1) for k, v in c.items()}
    goal = {f: share(sum((own[g][f] for g in own), Counter())) for f in balance.FEATURES}
    want = {"test": 0.1 * sum(frames.values()), "val": 0.1 * sum(frames.values()), "train": 0.8 * sum(frames.values())}
    have = {s: ({f: Counter() for f in balance.FEATURES}, 0) for s in want}

    def cost(state):
        total = 0.0
        for s, (c, n) in state.items():
            for f in balance.FEATURES:
                p = share(c[f])
                total += balance.WEIGHTS[f] * sum(abs(p.get(k, 0) - goal[f][k]) for k in goal[f])
            total += balance.WEIGHTS["size"] * abs(n - want[s]) / max(want[s], 1)
        return total

    tie = {g: hashlib.md5(f"4|{g}".encode()).hexdigest() for g in own}
    for g in sorted(own, key=lambda x: (-dict(rows(rarity, "g", "rarity"))[x], tie[x])):
        tries = []
        for s in want:
            c, n = have[s]
            tries.append((round(cost(have | {s: ({f: c[f] + own[g][f] for f in balance.FEATURES}, n + frames[g])}), 9), s))
        best = min(x for x, _ in tries)
        assert got[g] in {s for x, s in tries if x <= best + 1e-6}
        c, n = have[got[g]]
        have[got[g]] = ({f: c[f] + own[g][f] for f in balance.FEATURES}, n + frames[g])


def test_sequences_fill_by_capacity(spark):
    r = random.Random(2)
    data = [(f"s{i}", label, r.randint(1, 20)) for i in range(60) for label in "wxyz" if r.random() < 0.5]
    got = {x["s"]: x["split"] for x in balance.stratified_sequences(spark.createDataFrame(data, "s string, l string, n int"), "s", "l", "n", seed=1).collect()}
    own = {}
    for s, k, n in data:
        own.setdefault(s, {})[k] = n
    totals = Counter()
    for v in own.values():
        totals.update(v)
    order = sorted(own, key=lambda s: (hashlib.md5(f"1|{s}".encode()).hexdigest(), s))
    split, have = {}, {"test": Counter(), "val": Counter()}
    for k in sorted(totals, key=lambda x: (totals[x], x)):
        for name in ("test", "val"):
            free = [s for s in order if k in own[s] and s not in split]
            if not have[name][k] and len(free) > 1:
                split[free[0]] = name
                have[name].update(own[free[0]])
    for s in order:
        if s not in split:
            split[s] = next((m for m in ("test", "val") if all(have[m][k] + n <= 0.15 * totals[k] for k, n in own[s].items())), "train")
            if split[s] != "train":
                have[split[s]].update(own[s])
    assert got == split


def test_sequences_are_cut(spark):
    """Objects that come and go far apart are several pieces, whose ids go on."""
    data = [("s", f, 0, 100.0 * (f // 10), 5.0 * (f % 2)) for f in range(100)] + [("t", 1, 0, 0.0, 0.0), ("t", 2, 0, 1.0, None)]
    o = spark.createDataFrame(data, "seq string, frame int, pos int, x double, y double").selectExpr("*", "2.0 w", "2.0 h")
    pieces = tracks.cut_sequences(o.selectExpr("seq", "cast(frame as long) frame", "x + 1 cx", "y + 1 cy"), 8.0, 5)
    assert pieces.select("seq", "piece").distinct().count() == 12
    got = rows(tracks.track_objects(o, "seq", "frame", "pos", radius=8.0), "seq", "frame", "object_id")
    assert got == [("s", f, f // 10) for f in range(100)] + [("t", 1, 0), ("t", 2, 1)]


def test_objects_by_history(spark):
    r = random.Random(7)
    data = [("s", f, p, r.uniform(0, 60), r.uniform(0, 60)) for f in range(40) for p in range(r.randint(0, 5))]
    got = rows(tracks.track_objects(spark.createDataFrame(data, "seq string, frame int, pos int, x double, y double").selectExpr("*", "2.0 w", "2.0 h"), "seq", "frame", "pos", radius=8.0), "frame", "pos", "object_id")
    past, fresh, want = [], 0, []
    for f in range(40):
        ids = {}
        for _, _, p, x, y in sorted(d for d in data if d[1] == f):
            near = [o for frame in past for o, (a, b) in frame.items() if ((a - x) ** 2 + (b - y) ** 2) ** 0.5 <= 8]
            if not near:
                near, fresh = [fresh], fresh + 1
            ids[p] = (near[0], (x, y))
        if ids:
            last = {o: (p, at) for p, (o, at) in ids.items()}
            past = [*past, {o: at for o, (_, at) in sorted(last.items(), key=lambda z: z[1][0])}][-5:]
            want += [(f, p, o) for o, (p, _) in last.items()]
    assert got == sorted(want)


def test_greedy_match_equals_rules(spark):
    """Each prediction, in order of confidence, takes the free box it overlaps most; every overlap by itself."""
    rng = random.Random(5)
    box = lambda i, pos: (f"i{i}", rng.choice("AB"), x := rng.randint(0, 6), y := rng.randint(0, 6), x + rng.randint(1, 5), y + rng.randint(1, 5), pos)
    truth = [box(i, k) for i in range(12) for k in range(6)]
    found = [(*box(i, k), rng.randint(1, 5) / 5) for i in range(12) for k in range(8)]
    ious = [0.75, 0.25, 0.5]

    def over(p, t):
        w, h = min(p[4], t[4]) - max(p[2], t[2]), min(p[5], t[5]) - max(p[3], t[3])
        both = max(w, 0) * max(h, 0)
        return both / ((p[4] - p[2]) * (p[5] - p[3]) + (t[4] - t[2]) * (t[5] - t[3]) - both)

    wanted = {}
    for cls in "AB":
        ps = sorted((p for p in found if p[1] == cls), key=lambda p: (-p[7], p[0], p[6]))
        n = sum(t[1] == cls for t in truth)
        areas = []
        for least in ious:
            free, hits = {(t[0], t[6]): t for t in truth if t[1] == cls}, []
            for p in ps:
                near = sorted((-over(p, t), t[6], k) for k, t in free.items() if t[0] == p[0] and over(p, t) >= least)
                hits.append(bool(near))
                if near:
                    del free[near[0][2]]
            precision = [sum(hits[: k + 1]) / (k + 1) for k in range(len(hits))]
            areas.append(sum(max(precision[k:]) for k, h in enumerate(hits) if h) / n)
        wanted[cls] = (n, len(ps), sum(areas) / 3, areas[0])
    names = "image string, cls string, x1 int, y1 int, x2 int, y2 int, pos int"
    out = tracks.detection_metrics(spark.createDataFrame(found, names + ", conf double"), spark.createDataFrame(truth, names), ious)
    assert {r["cls"]: (r["n_truth"], r["n_pred"], r["ap"], r["ap50"]) for r in out.collect()} == {k: pytest.approx(v) for k, v in wanted.items()}


def test_box_summary_of_hot_group(spark):
    data = {"a": [float((i * 7919) % 503) for i in range(2000)], "b": [3.0], "c": [1.0, 1.0, 2.0, 90.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in [*vs, None]], "g string, v double").repartition(5)
    got = {r["g"]: r for r in measures.box_summary(df, ["g"], "v").collect()}
    for k, vs in data.items():
        q1, q2, q3 = np.percentile(vs, [25, 50, 75])
        inside = [v for v in vs if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        assert tuple(got[k][c] for c in ("n", "q1", "median", "q3", "low", "high")) == pytest.approx((len(vs), q1, q2, q3, min(inside), max(inside)))
    assert measures.box_summary(df, [], "v").first()["n"] == 2005


def test_conform_splits_status(spark):
    wanted = spark.createDataFrame([("a", "train"), ("b", "val"), ("c", "val"), ("d", "test")], "k string, split string")
    actual = spark.createDataFrame([("a", "train"), ("b", "train"), ("c", "val"), ("c", "train"), ("e", "val")], "k string, split string")
    got = sorted((r["k"], r["status"]) for r in counts.conform_splits(wanted, actual, "k").collect())
    assert got == [("a", "ok"), ("b", "move"), ("c", "duplicate"), ("c", "duplicate"), ("d", "missing"), ("e", "extra")]


def test_drawn_negatives(spark):
    """Those drawn of all eligible frames, with rows only for what is drawn."""
    v = spark.createDataFrame([(i, i % 12) for i in range(40)], "stem long, n int")
    p = spark.createDataFrame([(i, f) for i in range(0, 40, 2) for f in (0, 3, 4)], "stem long, frame int")
    want = sampling.sample_per_group(tasks.eligible_negatives(v, p, "stem", "n", "frame"), ["stem"], ["frame"], 3, seed=1)
    got = tasks.draw_negatives(v, p, "stem", "n", "frame", 3, seed=1)
    assert rows(got, "stem", "frame") == rows(want, "stem", "frame")


def test_dealt(spark, sf_small, monkeypatch):
    """Parts grow with the rows, and grouping by the key doesn't shuffle again."""
    from tidewell.operators import ordered
    from tidewell.plans.adapters import view

    monkeypatch.setattr(ordered, "DEAL_ROWS", 500)
    boxes = view(spark, sf_small, "boxes")
    want = -(-spark.read.parquet(f"{sf_small}/lineitem.parquet").count() // 500)
    assert boxes.hint("merge").rdd.getNumPartitions() == want
    few = spark.range(400)
    assert ordered.dealt(few, few, "id") is few


def test_objects_are_read_in_order(spark):
    """Ids of a long sequence without a cut: one object near its last place, and one that is new in each tenth frame."""
    frames = [("s", f, 2 * f, float(f % 3), 0.0) for f in range(3000)] + [("s", f, 2 * f + 1, 1e6 + 1e3 * f, 0.0) for f in range(0, 3000, 10)]
    df = spark.createDataFrame(frames, "clip string, f long, pos long, x double, y double").withColumn("w", F.lit(2.0)).withColumn("h", F.lit(2.0))
    got = rows(tracks.track_objects(df, "clip", "f", "pos"), "frame", "pos", "object_id")
    assert len(got) == 3300
    assert {i for f, pos, i in got if pos % 2 == 0} == {0}
    assert [i for f, pos, i in got if pos % 2] == list(range(1, 301))


def test_similarity_asks_a_set_once(spark, monkeypatch):
    """A vector goes to each set of shells once, not to each shell; maxima are equal with shells cut by sets."""
    monkeypatch.setattr(similarity, "SET_BYTES", 4 * 8 * 45)
    v = np.random.default_rng(3).normal(size=(160, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id long, v array<float>")
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    s = u @ u.T - 3 * np.eye(len(u))
    assert dict(rows(similarity.max_similarity(df, "id", "v", block=10), "id", "max_sim")) == pytest.approx(dict(enumerate(s.max(axis=1))))
    found = similarity.shells(df, "id", "v", 10)
    asks = similarity._asks(similarity._own_best(found), found).collect()
    assert max(len(r["sets"]) for r in asks) == 4 < max(sum(len(x["os"]) for x in r["sets"]) for r in asks)
    assert all(len({x["g"] for x in r["sets"]}) == len(r["sets"]) for r in asks)
