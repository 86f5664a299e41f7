"""Number, rate and time-token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(c: Column, default: float | None = 0.0) -> Column:
    """The value as a double; default where it is none."""
    out = c.try_cast("double")
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def parse_rate(c: Column) -> Column:
    """Frames per second of ``a/b`` or a plain number; 0 for b = 0 and for what can't be read."""
    parts = F.split(F.trim(c.cast("string")), "/", 2)
    ratio = F.try_divide(F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double"))
    return F.coalesce(F.when(F.size(parts) == 2, ratio).otherwise(F.get(parts, 0).try_cast("double")), F.lit(0.0))


def infer_fps(fps: Column, r_rate: Column, avg_rate: Column, nb_frames: Column, duration: Column) -> Column:
    """The first positive of: fps, real rate, average rate, frames / duration; else 0."""
    per = F.try_divide(safe_double(nb_frames), safe_double(duration))
    tries = [safe_double(fps), parse_rate(r_rate), parse_rate(avg_rate), per]
    return F.coalesce(*[F.when(x > 0, x) for x in tries], F.lit(0.0))


def infer_total_frames(nb_frames: Column, frame_counts: Column, duration: Column, fps: Column) -> Column:
    """Number of frames: declared, else the first positive of frame_counts, else duration * fps rounded half to even."""
    declared = nb_frames.try_cast("double").cast("long")
    first = F.get(F.filter(F.transform(frame_counts, lambda x: x.try_cast("double").cast("long")), lambda x: x > 0), 0)
    timed = F.bround(safe_double(duration) * safe_double(fps), 0).cast("long")
    return F.coalesce(F.when(declared > 0, declared), first, F.when(timed > 0, timed), F.lit(0).cast("long"))


def infer_duration(format_duration: Column, stream_duration: Column, nb_frames: Column, rate: Column) -> Column:
    """Seconds: of the container, else of the stream, else frames / rate; null where none is positive."""
    tries = [safe_double(format_duration), safe_double(stream_duration), F.try_divide(safe_double(nb_frames), parse_rate(rate))]
    return F.coalesce(*[F.when(x > 0, x) for x in tries])


def pct(n: Column, d: Column) -> Column:
    """100 * n / d with six decimals, 0 where d isn't positive."""
    return F.coalesce(F.bround(F.when(d > 0, F.lit(100.0) * n / d), 6), F.lit(0.0))


def fmt6(c: Column) -> Column:
    return F.format_string("%.6f", c)


def to_mbps(bits: Column) -> Column:
    return bits / F.lit(1e6)


def frame_seconds(frame: Column, fps: Column) -> Column:
    return F.try_divide(frame.cast("double"), fps)


def is_check_frame(frame: Column, fps: Column, seconds: int = 30) -> Column:
    """Whether a periodic check falls on the frame: every fps * seconds frames."""
    return F.coalesce(F.try_mod(frame.cast("long"), F.floor(fps * seconds).cast("long")) == 0, F.lit(False))


def parse_hms(c: Column) -> Column:
    """Seconds of a day of H:MM:SS, or null."""
    p = F.regexp_extract_all(F.trim(c), F.lit(r"^(\d{1,2}):(\d{2}):(\d{2})$"), F.lit(0))
    h, m, s = (F.regexp_extract(F.trim(c), r"^(\d{1,2}):(\d{2}):(\d{2})$", i).try_cast("int") for i in (1, 2, 3))
    return F.when((F.size(p) == 1) & (h < 24) & (m < 60) & (s < 60), h * 3600 + m * 60 + s)


def time_to_ms(ts: Column) -> Column:
    """Milliseconds of the day of a timestamp."""
    return ((F.hour(ts) * 3600 + F.minute(ts) * 60) * 1000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000)).cast("long")


def stride_offset(stem: Column, stride: int, mode: str = "fixed", offset: int = 0) -> Column:
    """The first kept frame of a video: fixed, or by the CRC-32 of its stem."""
    if mode not in ("fixed", "video_hash"):
        raise ValueError(f"unknown offset mode: {mode}")
    if stride <= 1:
        return F.lit(0).cast("long")
    return F.lit(offset % stride).cast("long") if mode == "fixed" else (F.crc32(stem.cast("binary")) % stride).cast("long")


def norm_value(c: Column) -> Column:
    """Trimmed text; null for empty text and NA."""
    t = F.trim(c)
    return F.when(~F.upper(t).isin("", "NA"), t)


def hash_order(seed: int, *keys: Column) -> Column:
    """A deterministic pseudo-random order of rows, the same however they are partitioned: the MD5 of seed and keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
