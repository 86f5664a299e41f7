"""Stems, paths, storage keys and clip file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of stems and of three families of clip file names.
STEM = r"^(.+?)_(\d{8})_(\d{6})_(.+)$"
INDEXED = r"(?i)^SodaFL-(\d{2})(\d{2})(\d{2})-(\d{3})\.(avi|mp4|m4v|mov)$"
MOTION = r"(?i)^(?!\._)(\d{2})-(\d{2})-(\d{4})\s+(\d{1,2})(?:-(\d{2})-(\d{2}))?\s+([MC])\b"
DASHED = r"(?i)^(?!\._)([A-Za-z0-9]+)-(.+)-(\d+)-(\d{4})-(\d{2})-(\d{2})_(\d{1,2})\.(\d{2})\.(\d{2})\.(avi|mp4|m4v|mov)$"
VIDEO_EXTENSIONS = ("avi", "mp4", "m4v", "mov")


def parse_stem(c: Column) -> Column:
    """struct(org, site, device, date, time, suffix) of ``ORG-site-device_YYYYMMDD_HHMMSS_SUFFIX``; null if it isn't one."""
    parts = F.split(F.regexp_extract(c, STEM, 1), "-")
    fields = F.struct(
        F.get(parts, 0).alias("org"),
        F.get(parts, 1).alias("site"),
        F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), "-").alias("device"),
        *[F.regexp_extract(c, STEM, i).alias(n) for i, n in ((2, "date"), (3, "time"), (4, "suffix"))],
    )
    return F.when(c.rlike(STEM) & (F.size(parts) >= 3), fields)


def path_stem(c: Column) -> Column:
    """Base name without its last extension."""
    base = F.regexp_extract(c, r"([^/]*)/*$", 1)
    return F.regexp_replace(base, r"^(.+)\.[^.]*$", "$1")


def parse_frame_idx(c: Column) -> Column:
    """Number of a label file ``frame_N.txt``, or null."""
    return F.regexp_extract(c, r"^frame_(\d+)\.txt$", 1).try_cast("int")


def parse_manifest_relpath(c: Column) -> Column:
    """struct(video_stem, frame_idx, error) of ``<stem>/.../frame_N.txt``."""
    p = F.split(F.trim(c), "/")
    frame = parse_frame_idx(F.element_at(p, -1))
    bad = F.coalesce((F.size(p) < 2) | (F.get(p, 0) == "") | frame.isNull(), F.lit(True))
    return F.struct(F.when(~bad, F.get(p, 0)).alias("video_stem"), F.when(~bad, frame).alias("frame_idx"), F.when(bad, F.lit("bad manifest line")).alias("error"))


def packed_paths(split: str, relpath: Column, ext: str = "jpg") -> Column:
    """struct(label, image): paths under the split's folder of a packed data set."""
    label = F.concat(F.lit(f"{split}/"), F.trim(relpath))
    return F.struct(label.alias("label"), F.regexp_replace(label, r"\.[^./]*$", f".{ext}").alias("image"))


def site_of_relpath(c: Column, policy: str = "positional") -> Column:
    """Site of an image path: of its stem at a fixed place (unknown if it is none), or after a train, val or test part."""
    if policy == "positional":
        stem = F.get(F.split(c, "/"), 1)
        return F.coalesce(parse_stem(stem)["site"], F.lit("unknown"))
    if policy == "split":
        return parse_stem(F.regexp_extract(c, r"(?:^|/)(?:train|val|test)/([^/]+)/[^/]+$", 1))["site"]
    raise ValueError(f"unknown policy: {policy}")


def rebase(c: Column, root: str) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(c, "^/+", ""))


def video_key(org: Column, site: Column, device: Column, stem: Column, ext: str = "mp4") -> Column:
    """Storage key of a video; empty where a part is missing."""
    parts = [org, site, device, stem]
    missing = F.array_contains(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), "")
    return F.when(missing, F.lit("")).otherwise(F.concat_ws("/", org, site, device, F.lit("motion_vids"), F.concat(stem, F.lit("." + ext))))


def task_key(org: Column, site: Column, device: Column, stem: Column) -> Column:
    return F.concat_ws("/", org, site, device, F.lit("labelstudio_tasks"), F.concat(stem, F.lit(".json")))


def sanitize(c: Column) -> Column:
    """Only letters, digits, dots, dashes and underscores; single dashes; none at the ends."""
    t = F.regexp_replace(F.regexp_replace(F.trim(c), r"\s+", "-"), r"[^A-Za-z0-9._-]+", "-")
    return F.regexp_replace(F.regexp_replace(t, "-+", "-"), "^[-_]+|[-_]+$", "")


def construct_stem(project: Column, site: Column, camera: Column, date: Column, time: Column, suffix: str = "M") -> Column:
    """Stem from a table's fields (YYYY-MM-DD, H:MM:SS); null where one can't be read."""
    day = F.try_to_timestamp(F.trim(date), F.lit("yyyy-MM-dd"))
    clock = F.try_to_timestamp(F.trim(time), F.lit("H:mm:ss"))
    who = F.concat_ws("-", F.trim(project), F.trim(site), F.trim(camera))
    bad = day.isNull() | clock.isNull() | project.isNull() | site.isNull() | camera.isNull()
    return F.when(~bad, F.concat_ws("_", who, F.date_format(day, "yyyyMMdd"), F.date_format(clock, "HHmmss"), F.lit(suffix)))


def _when(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    text = F.format_string("%s-%s-%s %s:%s:%s", y, mo, d, F.lpad(h, 2, "0"), mi, s)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def _clip(family: str, org, site, device, ts, index=None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(family).alias("family"), (org if org is not None else none.cast("string")).alias("org"), (site if site is not None else none.cast("string")).alias("site"),
        (device if device is not None else none.cast("string")).alias("device"), ts.alias("recorded_at"), (index if index is not None else none.cast("int")).alias("index"),
    )


def parse_name_indexed(c: Column) -> Column:
    """``SodaFL-MMDDYY-INDEX.ext``: the date at midnight and the index."""
    g = [F.regexp_extract(c, INDEXED, i) for i in range(5)]
    ts = _when(F.concat(F.lit("20"), g[3]), g[1], g[2], F.lit("00"), F.lit("00"), F.lit("00"))
    return F.when(c.rlike(INDEXED), _clip("indexed", None, None, None, ts, g[4].try_cast("int")))


def parse_name_motion(c: Column, date_order: str = "dmy") -> Column:
    """``DD-MM-YYYY H[-MM-SS] M ...``; only motion clips (M)."""
    if date_order not in ("dmy", "mdy"):
        raise ValueError(f"unknown date order: {date_order}")
    g = [F.regexp_extract(c, MOTION, i) for i in range(8)]
    day, month = (g[1], g[2]) if date_order == "dmy" else (g[2], g[1])
    zero = lambda x: F.when(x == "", F.lit("00")).otherwise(x)
    ts = _when(g[3], month, day, g[4], zero(g[5]), zero(g[6]))
    return F.when(c.rlike(MOTION) & (F.upper(g[7]) == "M"), _clip("motion", None, None, None, ts))


def parse_name_dashed(c: Column, device_prefix: str = "camera-") -> Column:
    """``ORG-Site-N-YYYY-MM-DD_H.MM.SS.ext``."""
    g = [F.regexp_extract(c, DASHED, i) for i in range(10)]
    ts = _when(g[4], g[5], g[6], g[7], g[8], g[9])
    device = F.concat(F.lit(device_prefix), g[3].try_cast("int").cast("string"))
    return F.when(c.rlike(DASHED), _clip("dashed", sanitize(g[1]), F.lower(sanitize(g[2])), device, ts))


def parse_clip_name(c: Column, date_order: str = "dmy") -> Column:
    """The first family a file name belongs to: dashed, motion, indexed; null for none."""
    return F.coalesce(parse_name_dashed(c), parse_name_motion(c, date_order), parse_name_indexed(c))


def resolve_identity(clip: Column, org: str | None = None, site: str | None = None, device: str | None = None) -> Column:
    """struct(org, site, device, error): parsed parts, else the given ones."""
    parts = {n: F.coalesce(clip[n], F.lit(v)) for n, v in (("org", org), ("site", site), ("device", device))}
    missing = F.concat_ws(",", *[F.when(v.isNull(), F.lit(n)) for n, v in parts.items()])
    return F.struct(*[v.alias(n) for n, v in parts.items()], F.when(missing != "", F.concat(F.lit("missing: "), missing)).alias("error"))


def shift_name_ts(c: Column, frame: Column, fps: Column) -> Column:
    """A stem whose time is moved on by frame / fps seconds."""
    p = parse_stem(c)
    ts = F.try_to_timestamp(F.concat(p["date"], p["time"]), F.lit("yyyyMMddHHmmss"))
    moved = F.timestamp_seconds(F.unix_timestamp(ts) + F.floor(F.try_divide(frame.cast("double"), fps)))
    return F.concat_ws("_", F.concat_ws("-", p["org"], p["site"], p["device"]), F.date_format(moved, "yyyyMMdd"), F.date_format(moved, "HHmmss"), p["suffix"])


def event_clip_name(stem: Column, event_id: Column, part: Column) -> Column:
    """Name of a part of an event: the first eight digits of its id, three of the part's number."""
    return F.format_string("%s_E%s_p%03d", stem, F.substring(event_id, 1, 8), part)


def file_date(path: Column) -> Column:
    """The day in a file's name, its first eight digits; null where there are none or they are no day."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(F.substring_index(path, "/", -1), r"(\d{8})", 1), F.lit("")), F.lit("yyyyMMdd")).cast("date")


def split_metric(name: Column) -> Column:
    """struct(side, species) of ``counts_l_<species>`` and ``counts_r_<species>``; null for any other name."""
    side, species = F.regexp_extract(name, r"counts_(l|r)_(.*)", 1), F.regexp_extract(name, r"counts_(l|r)_(.*)", 2)
    return F.when(side != "", F.struct(F.when(side == "l", "Left").otherwise("Right").alias("side"), species.alias("species")))


def signed_value(name: Column, n: Column) -> Column:
    """n, negative for counts to the left."""
    return F.when(split_metric(name)["side"] == "Left", -n).otherwise(n)
