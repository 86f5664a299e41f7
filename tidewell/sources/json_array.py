"""Large JSON arrays, read by many tasks at once.

Spark reads a file of one JSON value in one task. Here a file is cut into byte ranges, and where elements begin is found out in
two steps. A task can't know whether its range begins inside a string, nor how deep, so it sums the range up for both cases:
whether it ends inside a string, how the depth changes and when it falls below where it began, and how many commas there are
at each depth. These summaries are put together file by file, which gives each range its state and the place of its first
element. Then each range gives the elements whose separator lies in it, reading on behind its end for the last one, and Spark
parses them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import materialize
from tidewell.sources.listing import list_files, open_root

SPLIT_BYTES = 8 << 20
#: Bytes read at once beside a range: what may stand from a field's name to its array, and behind a range.
REACH = 1 << 12
_DEPTH = np.zeros(256, np.int64)
_DEPTH[[91, 123]], _DEPTH[[93, 125]] = 1, -1
_MARK = _DEPTH != 0
_MARK[44] = True
_SPACE = b" \t\r\n"


class File:
    """Bytes of a file by ranges. Borders lie where no escape is open."""

    def __init__(self, path: str):
        folder, _, name = path.rpartition("/")
        system, inner, _ = open_root(folder)
        self.file = system.open_input_file(f"{inner.rstrip('/')}/{name}")
        self.size = self.file.size()

    def read(self, a: int, b: int) -> bytes:
        self.file.seek(a)
        return self.file.read(max(0, b - a))

    def border(self, at: int) -> int:
        """The first place from ``at`` on that no backslash is right before."""
        if at <= 0:
            return 0
        while at < self.size:
            block = np.frombuffer(self.read(at - 1, at - 1 + REACH), np.uint8)
            other = np.flatnonzero(block != 92)
            if len(other):
                return min(self.size, at + int(other[0]))
            at += len(block)
        return self.size


    def head(self) -> tuple[str, int]:
        """The first character that is no space, and its place."""
        at = 3 if self.read(0, 3) == b"\xef\xbb\xbf" else 0
        while at < self.size:
            block = self.read(at, at + REACH)
            if rest := block.lstrip(_SPACE):
                return rest[:1].decode("latin-1"), at + len(block) - len(rest)
            at += len(block)
        return "", at


class Marks:
    """Brackets, braces and commas of some bytes, of which the first is not escaped; quotes: those that open or close a string."""

    def __init__(self, data: bytes):
        b = np.frombuffer(data, np.uint8)
        slash, quotes = np.flatnonzero(b == 92), np.flatnonzero(b == 34)
        if len(slash) and len(quotes):
            i = np.searchsorted(slash, quotes) - 1
            begins = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(slash) != 1]), np.arange(len(slash)), 0))
            quotes = quotes[~((i >= 0) & (slash[i] == quotes - 1) & ((i - begins[i]) % 2 == 0))]
        self.quotes, self.at = quotes, np.flatnonzero(_MARK[b])
        self.odd = np.searchsorted(quotes, self.at) % 2
        self.kind = b[self.at]

    def outside(self, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, kinds, depth behind each) of the marks outside of strings, if the bytes begin inside one or not."""
        out = self.odd == inside
        return self.at[out], self.kind[out], np.cumsum(_DEPTH[self.kind[out]])

    def ends_inside(self, inside: int) -> int:
        return (len(self.quotes) + inside) % 2


def _counts(depths: np.ndarray) -> dict[str, int]:
    value, n = np.unique(depths, return_counts=True)
    return {str(v): int(c) for v, c in zip(value, n, strict=True)}


def summary(file: File, start: int, end: int, field: str | None) -> dict:
    """What a range does, if it begins outside (0) or inside (1) of a string, and the file's first character."""
    a, b = file.border(start), file.border(end)
    data = file.read(a, b)
    marks, (char, place) = Marks(data), file.head()
    out = {"a": a, "b": b, "head": char}
    begins = []  # brackets of the field's arrays, or of the file's
    if field is not None:
        back = file.read(max(0, a - REACH), a)
        key = rb'(?<!\\)"' + re.escape(json.dumps(field)[1:-1].encode()) + rb'"\s*:\s*\['
        begins = [x for m in re.finditer(key, back + data) if (x := m.end() - 1 - len(back)) >= 0]
    elif char == "[" and a <= place < b:
        begins = [place - a]
    for inside in (0, 1):
        at, kind, depth = marks.outside(inside)
        commas, low = kind == 44, np.minimum.accumulate(np.append(0, depth))
        falls = at[low[1:] < low[:-1]]
        found = []
        for bracket in begins:
            k = int(np.searchsorted(at, bracket))
            if k == len(at) or at[k] != bracket:  # within a string
                continue
            under = int(depth[k - 1]) if k else 0
            behind = at > bracket
            closed = np.flatnonzero(behind & (depth <= under))
            found.append({"open": a + bracket, "depth": under, "commas": _counts(depth[commas & behind]), "close": a + int(at[closed[0]]) if len(closed) else None})
        out[str(inside)] = {"inside": marks.ends_inside(inside), "depth": int(depth[-1]) if len(depth) else 0, "falls": [a + int(x) for x in falls], "commas": _counts(depth[commas]), "opens": found}
    return out


def assemble(parts: list[dict], field: str | None, single: bool) -> tuple[list[tuple], str | None]:
    """The state in which each range begins, (a, b, inside, depth, first item, open, close), of those with elements; or an error."""
    level = 1 if field is None else 2  # of the elements
    char = parts[0]["head"]
    if field is None and char == "{" and single:
        return [(parts[0]["a"], parts[-1]["b"], 0, 0, -1, -1, -1)], None
    if char != ("[" if field is None else "{"):
        return [], "no list"
    inside = depth = items = 0
    opened = closed = None
    rows = []
    for p in parts:
        s = p[str(inside)]
        first = items
        if opened is None:
            own = next((o for o in s["opens"] if depth + o["depth"] == level - 1), None)
            if own:
                opened, closed = own["open"], own["close"]
                items += 1 + own["commas"].get(str(level - depth), 0)
        elif closed is None:
            fall = depth - level
            closed = s["falls"][fall] if fall < len(s["falls"]) else None
            items += s["commas"].get(str(level - depth), 0)
        rows.append((p["a"], p["b"], inside, depth, first))
        inside, depth = s["inside"], depth + s["depth"]
    if opened is None:
        return [], "no list"
    if closed is None or inside or depth:
        return [], "not readable"
    return [(*r, opened, closed) for r in rows if r[1] > opened and r[0] <= closed], None


def elements(file: File, a: int, b: int, inside: int, depth: int, opened: int, closed: int, level: int) -> Iterator[bytes]:
    """The elements of the array from opened to closed whose separators lie from a to b."""

    def borders(data: bytes, at: int) -> tuple[list[int], int, int]:
        marks = Marks(data)
        place, kind, d = marks.outside(inside)
        place = place + at
        own = place[((kind == 44) & (d + depth == level) & (place > opened) & (place < closed)) | (place == opened)]
        return own.tolist(), marks.ends_inside(inside), depth + (int(d[-1]) if len(d) else 0)

    data = file.read(a, b)
    own, inside, depth = borders(data, a)
    if not own:
        return
    for x, y in zip(own, own[1:], strict=False):
        yield data[x + 1 - a : y - a]
    rest, at = [data[own[-1] + 1 - a :]], b
    if closed < b:
        yield data[own[-1] + 1 - a : closed - a]
        return
    while True:
        to = file.border(min(at + REACH, file.size))
        data = file.read(at, to)
        more, inside, depth = borders(data, at)
        stop = more[0] if more else closed
        if stop < to:
            yield b"".join([*rest, data[: stop - at]])
            return
        rest.append(data)
        at = to


def array_elements(spark: SparkSession, path: str, glob: str = "*.json", field: str | None = None, single: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, item_pos, body, error): the elements of each file's array as JSON text, with their place.

    The array is the file's value, or (field) the one of that name in the object that is the file's value. single: a file that is
    an object counts as a list of it alone. A file without such an array, or that breaks off, gives one row with an error.
    """
    files = list_files(spark, path, glob)
    n = F.greatest(F.lit(1), F.ceil(F.col("size") / split_bytes)).cast("int")
    ranges = materialize(files.select("path", F.explode(F.sequence(F.lit(0), n - 1)).alias("i")).select("path", (F.col("i") * F.lit(split_bytes).cast("long")).alias("start")), "ranges")
    tasks = max(1, min(ranges.count(), 64 * spark.sparkContext.defaultParallelism))
    level = 1 if field is None else 2

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, start in zip(pdf["path"], pdf["start"], strict=True):
                file = File(p)
                yield pd.DataFrame({"path": [p], "start": [start], "part": [json.dumps(summary(file, start, min(start + split_bytes, file.size), field))]})

    def put_together(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, error = assemble([json.loads(x) for x in pdf.sort_values("start")["part"]], field, single)
        if error:
            rows = [(0, 0, 0, 0, 0, 0, 0)]
        out = pd.DataFrame(rows, columns=["a", "b", "inside", "depth", "first", "opened", "closed"])
        return out.assign(path=pdf["path"].iloc[0], error=error)[["path", *out.columns, "error"]]

    plan = "path string, a long, b long, inside int, depth int, first long, opened long, closed long, error string"
    parts = ranges.repartition(tasks, "path", "start").mapInPandas(sum_up, "path string, start long, part string")
    states = materialize(parts.groupBy("path").applyInPandas(put_together, plan), "ranges")

    def give(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.error is not None:
                    yield pd.DataFrame({"path": [r.path], "item_pos": [None], "body": [None], "error": [r.error]})
                    continue
                file = File(r.path)
                found = enumerate(elements(file, r.a, r.b, r.inside, r.depth, r.opened, r.closed, level), r.first) if r.first >= 0 else [(0, file.read(0, file.size).removeprefix(b"\xef\xbb\xbf"))]
                some, size = [], 0
                for i, x in found:
                    if x := x.strip(_SPACE):
                        some.append((r.path, i, x.decode("utf-8", "replace"), None))
                        size += len(x)
                    if size > SPLIT_BYTES:
                        yield pd.DataFrame(some, columns=["path", "item_pos", "body", "error"])
                        some, size = [], 0
                yield pd.DataFrame(some, columns=["path", "item_pos", "body", "error"])

    return states.repartition(tasks, "path", "a").mapInPandas(give, "path string, item_pos int, body string, error string")


def read_json_array(spark: SparkSession, path: str, schema: str, glob: str = "*.json", field: str | None = None, single: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, item_pos, item, error): array_elements parsed by a schema. A file that holds an element which can't be parsed gives
    one row with an error, and no other; so does a file without such an array."""
    rows = array_elements(spark, path, glob, field, single, split_bytes)
    # a number given as text is no broken JSON: its field is null
    broken = F.col("error").isNull() & ~(F.col("body").startswith("{") & F.get_json_object("body", "$").isNotNull())
    rows = materialize(rows.select("path", "item_pos", F.from_json("body", schema).alias("item"), "error", broken.alias("broken")), "elements")
    bad = rows.where("broken").select("path").distinct()
    good = rows.join(bad, "path", "left_anti").select("path", "item_pos", "item", "error")
    kind = good.schema["item"].dataType.simpleString()
    return good.unionByName(bad.select("path", F.lit(None).cast("int").alias("item_pos"), F.lit(None).cast(kind).alias("item"), F.lit("not readable").alias("error")))
