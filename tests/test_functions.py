import zlib

import pytest
from pyspark.sql import functions as F

from tidewell.functions import boxes as B
from tidewell.functions import names as N
from tidewell.functions import scalars as S
from tidewell.operators import runs


def one(spark, c):
    return spark.range(1).select(c.alias("c")).first()["c"]


def test_stem(spark):
    p = one(spark, N.parse_stem(F.lit("ORG-upper-weir-0_20250714_012827_M")))
    assert tuple(p) == ("ORG", "upper", "weir-0", "20250714", "012827", "M")
    assert one(spark, N.parse_stem(F.lit("a-b_20250714_012827_M"))) is None
    assert one(spark, N.parse_stem(F.lit("nothing"))) is None
    assert one(spark, N.parse_stem(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(("hhmmss", "name"), [("010203", "night"), ("070000", "morning"), ("130000", "afternoon"), ("200000", "evening"), ("bad", "unknown"), ("", "unknown")])
def test_time_bucket(spark, hhmmss, name):
    assert one(spark, B.time_bucket(F.lit(hhmmss))) == name


def test_bins(spark):
    assert [one(spark, B.density_bin(F.lit(n))) for n in (0, 1, 2, 3, 4, 5, 9, 10)] == ["0", "1", "2", "3-4", "3-4", "5-9", "5-9", "10+"]
    assert [one(spark, B.ar_bin(F.lit(w), F.lit(1.0))) for w in (0.0, 0.5, 1.0, 1.5, 2.0)] == ["invalid", "tall", "square", "square", "wide"]
    assert [one(spark, B.area_bin(F.lit(a))) for a in (0.0, 0.001, 0.005, 0.02, 0.1, 0.5)] == ["0", "<0.0025", "0.0025-0.01", "0.01-0.04", "0.04-0.16", ">=0.16"]


def test_label_line(spark):
    assert one(spark, B.parse_label_line(F.lit("bad line"))) is None
    p = one(spark, B.parse_label_line(F.lit(" 0 0.5 0.5 nope 0.2 9 ")))
    assert (p["class_id"], p["w"], p["h"], p["extras"]) == (0, 0.0, 0.2, ["9"])
    assert one(spark, B.clamp_label_line(F.lit("3 0.5 1.2 0.1 2"))) == "3 0.5 1.0 0.1 1.0"


def test_center(spark):
    c = one(spark, B.to_center(*[F.lit(v) for v in (10.0, 20.0, 30.0, 40.0)], F.lit(1280), F.lit(720)))
    assert [round(x, 6) for x in c] == [0.25, 0.40, 0.30, 0.40]
    c = one(spark, B.to_center(*[F.lit(v) for v in (200.0, 20.0, 30.0, 40.0)], F.lit(0), F.lit(720)))
    assert c["xc"] == 0 and round(c["yc"], 6) == round(40 / 720, 6)
    with pytest.raises(ValueError):
        B.to_center(F.lit(1), F.lit(1), F.lit(1), F.lit(1), F.lit(1), F.lit(1), "odd")


def test_crop(spark):
    c = one(spark, B.crop_box(F.lit(0.5), F.lit(0.5), F.lit(0.2), F.lit(0.2)))
    assert [round(x, 6) for x in c] == [0.5, 0.9, 0.2, 0.2]
    assert one(spark, B.crop_box(F.lit(0.5), F.lit(0.9), F.lit(0.2), F.lit(0.1))) is None


def test_rates(spark):
    for text, want in (("30000/1001", 30000 / 1001), ("5/0", 0.0), ("12.5", 12.5), ("x", 0.0), ("", 0.0), (None, 0.0)):
        assert one(spark, S.parse_rate(F.lit(text).cast("string"))) == pytest.approx(want)
    none = F.lit(None).cast("string")
    assert one(spark, S.infer_fps(none, none, none, F.lit("97"), F.lit("9.7"))) == pytest.approx(10)
    assert one(spark, S.infer_total_frames(none, F.array().cast("array<string>"), F.lit("9.7"), F.lit("10"))) == 97
    assert one(spark, S.infer_total_frames(none, F.array(F.lit("0"), F.lit("12")), F.lit("9.7"), F.lit("10"))) == 12


def test_stride_hash(spark):
    assert one(spark, S.stride_offset(F.lit("a_b"), 7, "video_hash")) == zlib.crc32(b"a_b") % 7
    assert one(spark, S.stride_offset(F.lit("a_b"), 1, "video_hash")) == 0
    with pytest.raises(ValueError):
        S.stride_offset(F.lit("a"), 3, "other")


def test_construct_stem(spark):
    f = lambda *v: one(spark, N.construct_stem(*[F.lit(x).cast("string") for x in v]))
    assert f("P", "S", "C", "2025-06-04", "3:17:05") == "P-S-C_20250604_031705_M"
    assert f("P", "S", "C", "2025-06-04", "bad") is None and f(None, "S", "C", "2025-06-04", "3:17:05") is None


def test_clip_names(spark):
    got = one(spark, N.parse_clip_name(F.lit("DFO-Brechin-1-2024-09-01_21.21.27.mp4")))
    assert (got["family"], got["org"], got["site"], got["device"], str(got["recorded_at"])) == ("dashed", "DFO", "brechin", "camera-1", "2024-09-01 21:21:27")
    got = one(spark, N.parse_clip_name(F.lit("04-07-2025 15-17-26 M upper club fish box.m4v")))
    assert (got["family"], str(got["recorded_at"])) == ("motion", "2025-07-04 15:17:26")
    assert str(one(spark, N.parse_clip_name(F.lit("04-07-2025 5 m box.m4v"), "mdy"))["recorded_at"]) == "2025-04-07 05:00:00"
    assert one(spark, N.parse_clip_name(F.lit("04-07-2025 13 C box.m4v"))) is None
    assert one(spark, N.parse_clip_name(F.lit("._04-07-2025 13 M box.m4v"))) is None
    got = one(spark, N.parse_clip_name(F.lit("SodaFL-010322-001.avi")))
    assert (str(got["recorded_at"]), got["index"]) == ("2022-01-03 00:00:00", 1)


def test_paths(spark):
    assert one(spark, N.path_stem(F.lit("a/b.c/d.tar.gz"))) == "d.tar"
    assert one(spark, N.parse_frame_idx(F.lit("frame_000012.txt"))) == 12
    assert tuple(one(spark, N.parse_manifest_relpath(F.lit("v/frame_3.txt")))) == ("v", 3, None)
    assert one(spark, N.parse_manifest_relpath(F.lit("v/x.txt")))["error"]
    assert one(spark, N.sanitize(F.lit("  a b__/c-- "))) == "a-b__-c"
    assert one(spark, N.shift_name_ts(F.lit("A-b-c_20250101_235959_M"), F.lit(20), F.lit(10.0))) == "A-b-c_20250102_000001_M"
    assert one(spark, N.video_key(F.lit("a"), F.lit(None).cast("string"), F.lit("c"), F.lit("d"))) == ""


def test_log_line(spark):
    p = one(spark, runs.parse_log_line(F.lit("2025-06-25 05:21:24,544 - INFO [run.py:61] - hello - there")))
    assert (p["level"], p["module"], p["message"]) == ("INFO", "run.py:61", "hello - there")
    assert one(spark, runs.parse_log_line(F.lit("2025-06-25 05:21:24,544 - INFO - x"))) is None


def test_packed_paths(spark):
    assert tuple(one(spark, N.packed_paths("val", F.lit("v.x/frame_1.txt")))) == ("val/v.x/frame_1.txt", "val/v.x/frame_1.jpg")
    assert one(spark, runs.is_healthy(F.lit("12 BGSub: 3"))) and not one(spark, runs.is_healthy(F.lit("restart")))
