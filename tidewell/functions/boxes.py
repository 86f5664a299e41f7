"""Box coordinates, bins, crops and label lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import safe_double


def _unit(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def coord_mode(x: Column, y: Column, w: Column, h: Column) -> Column:
    most = F.greatest(x, y, w, h)
    return F.when(most <= 1.0000001, "normalized").when(most <= 100.0000001, "percent").otherwise("pixel")


def to_center(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, mode: str = "auto") -> Column:
    """struct(xc, yc, w, h) in 0..1 of a box given by corner and size; pixels of a video of unknown size give 0."""
    if mode not in ("auto", "normalized", "percent", "pixel"):
        raise ValueError(f"unknown coordinate mode: {mode}")
    m = coord_mode(x, y, w, h) if mode == "auto" else F.lit(mode)
    over = lambda size: F.when(m == "normalized", F.lit(1.0)).when(m == "percent", F.lit(100.0)).otherwise(F.when(size != 0, size.cast("double")))
    part = lambda v, size: _unit(F.coalesce(v / over(size), F.lit(0.0)))
    return F.struct(part(x + w / 2, width).alias("xc"), part(y + h / 2, height).alias("yc"), part(w, width).alias("w"), part(h, height).alias("h"))


def mot_to_center(left: Column, top: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    return F.struct(((left + w / 2) / width).alias("xc"), ((top + h / 2) / height).alias("yc"), (w / width).alias("w"), (h / height).alias("h"))


def density_bin(n: Column) -> Column:
    return F.when(n <= 0, "0").when(n <= 2, n.cast("string")).when(n <= 4, "3-4").when(n <= 9, "5-9").otherwise("10+")


def ar_bin(w: Column, h: Column) -> Column:
    r = F.try_divide(w, h)
    return F.when((w <= 0) | (h <= 0), "invalid").when(r < 0.67, "tall").when(r <= 1.5, "square").otherwise("wide")


def area_bin(a: Column) -> Column:
    # Upper bounds of the bins.
    out = F.when(a <= 0, "0")
    for low, high, name in ((None, 0.0025, "<0.0025"), (0.0025, 0.01, "0.0025-0.01"), (0.01, 0.04, "0.01-0.04"), (0.04, 0.16, "0.04-0.16")):
        out = out.when(a < high, name)
    return out.otherwise(">=0.16")


def time_bucket(hhmmss: Column) -> Column:
    hour = F.when(F.length(hhmmss) >= 2, F.substring(hhmmss, 1, 2).try_cast("int"))
    return F.when((hour < 0) | (hour > 23) | hour.isNull(), "unknown").when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")


def parse_label_line(c: Column) -> Column:
    """struct(class_id, xc, yc, w, h, extras) of a label line; null for under five tokens or a class that is no integer."""
    t = F.split(F.trim(c), r"\s+")
    number = lambda i: safe_double(F.get(t, i))
    cls = F.get(t, 0).try_cast("int")
    fields = F.struct(cls.alias("class_id"), *[number(i).alias(n) for i, n in ((1, "xc"), (2, "yc"), (3, "w"), (4, "h"))], F.slice(t, 6, F.greatest(F.size(t), F.lit(1))).alias("extras"))
    return F.when((F.size(t) >= 5) & cls.isNotNull(), fields)


def is_label_line(c: Column) -> Column:
    """Whether parse_label_line can read the line."""
    t = F.split(F.trim(c), r"\s+")
    return (F.size(t) >= 5) & F.get(t, 0).try_cast("int").isNotNull()


def clamp_label_line(c: Column) -> Column:
    """The line with the last four tokens above 1 set to 1.0."""
    t = F.split(F.trim(c), r"\s+")
    n = F.size(t)
    return F.array_join(F.transform(t, lambda x, i: F.when((i >= n - 4) & (x.try_cast("double") > 1.0), F.lit("1.0")).otherwise(x)), " ")


def crop_box(xc: Column, yc: Column, w: Column, h: Column, y0: float = 0.0, y1: float = 0.5, min_visible: float = 0.05) -> Column:
    """struct(xc, yc, w, h) of a box within the band y0..y1 of its image, in the band's coordinates; null where too little
    of it is visible."""
    x1, x2, t, b = _unit(xc - w / 2), _unit(xc + w / 2), _unit(yc - h / 2), _unit(yc + h / 2)
    area = F.greatest(x2 - x1, F.lit(0.0)) * F.greatest(b - t, F.lit(0.0))
    c1, c2 = F.greatest(t, F.lit(y0)), F.least(b, F.lit(y1))
    seen = F.try_divide((x2 - x1) * (c2 - c1), area)
    n1, n2 = (c1 - y0) / (y1 - y0), (c2 - y0) / (y1 - y0)
    out = F.struct(_unit((x1 + x2) / 2).alias("xc"), _unit((n1 + n2) / 2).alias("yc"), _unit(x2 - x1).alias("w"), _unit(n2 - n1).alias("h"))
    return F.when((area > 0) & (c2 > c1) & (seen >= min_visible) & (x2 > x1) & (n2 > n1), out)


def centroid(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct((x + w / 2).alias("cx"), (y + h / 2).alias("cy"))


def within_radius(ax: Column, ay: Column, bx: Column, by: Column, radius: float) -> Column:
    return F.sqrt(F.pow(ax - bx, 2) + F.pow(ay - by, 2)) <= radius


def with_class_id(df: DataFrame, classes: dict[str, int], label: str = "label", class_id: str = "class_id") -> DataFrame:
    """Rows of known labels with their class number. The class map is a literal of the plan, as a class list is short."""
    table = F.create_map(*[F.lit(x) for kv in classes.items() for x in kv]) if classes else F.create_map().cast("map<string,int>")
    return df.withColumn(class_id, F.try_element_at(table, F.col(label))).where(F.col(class_id).isNotNull())


def remap_labels(c: Column, aliases: dict[str, str]) -> Column:
    if not aliases:
        return c
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), c), c)


def project_labels(df: DataFrame, classes: list[str], label: str = "label", class_id: str = "class_id") -> DataFrame:
    """Rows of the labels of a fixed list, numbered by their place in it; others are left out."""
    return with_class_id(df, {c: i for i, c in enumerate(classes)}, label, class_id)
