"""Nearest neighbours by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import hash_order
from tidewell.session import materialize

#: Pivots, and shells about each of them, at most. What tasks are told of is PIVOTS vectors and PIVOTS * SHELLS angles at most.
PIVOTS = 1024
SHELLS = 64
#: Angles are exact but for so much.
SLACK = 1e-6
#: Vectors that are compared with shells at once.
ROWS = 256
#: Bytes of the vectors of a set of neighbouring shells, and of those that ask it, that one task holds.
SET_BYTES = 16 << 20


def _unit(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.array(column.value_lengths())
    if len(n) and (n != n[0]).any():
        raise ValueError("vectors differ in length")
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(n), int(n[0]) if len(n) else 1)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


@dataclass
class Shells:
    """Shells of vectors about pivots: rows (k, v, o, h, g) of vectors with their shell, block and set, and for each shell its number,
    pivot, least and greatest angle, vectors and blocks."""

    rows: DataFrame
    pivots: np.ndarray
    number: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    blocks: dict[int, int]

    def set_size(self) -> int:
        """Vectors of a set, about."""
        return max(1, SET_BYTES // (4 * self.pivots.shape[1]))

    def sets(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last set of each shell: sets are cut from the shells in order by their vectors."""
        to = np.cumsum(self.size)
        return (to - self.size) // self.set_size(), np.maximum(to - 1, 0) // self.set_size()


def shells(vectors: DataFrame, key: str, vector: str, block: int = 2000) -> Shells:
    """Pivots are vectors drawn by hash, one for each ``block`` vectors up to PIVOTS. A vector goes to its nearest pivot's cell; cells
    are cut to shells of about ``block`` by the angle to the pivot, and shells that are larger still to blocks by hash."""
    base = materialize(vectors.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<float>").alias("v")).where("v is not null and k is not null"), "vectors")
    drawn = base.orderBy(hash_order(0, F.col("k")), "k").limit(min(PIVOTS, max(1, -(-base.count() // block)))).collect()
    pivots = _unit(pa.array([r["v"] for r in drawn])) if drawn else np.zeros((0, 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = _angles(_unit(batch.column("v")), pivots)
            p = t.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("v"), pa.array(p.astype(np.int32)), pa.array(t[np.arange(len(p)), p])], names=["k", "v", "p", "t"])

    placed = materialize(base.mapInArrow(place, "k long, v array<float>, p int, t double"), "vectors")
    parts = [F.lit(i / SHELLS) for i in range(1, SHELLS)]
    cells = placed.groupBy("p").agg(F.count("*").alias("n"), F.percentile_approx("t", F.array(*parts), 10_000).alias("q")).collect()
    cuts = {}
    for r in cells:
        some = min(SHELLS, -(-r["n"] // block))
        cuts[r["p"]] = np.unique([r["q"][i * SHELLS // some - 1] for i in range(1, some)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, t = batch.column("p").to_numpy(), batch.column("t").to_numpy()
            o = np.array([a * SHELLS + np.searchsorted(cuts[a], x) for a, x in zip(p.tolist(), t, strict=True)], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("v"), pa.array(o), batch.column("t")], names=["k", "v", "o", "t"])

    inside = materialize(placed.mapInArrow(cut, "k long, v array<float>, o int, t double"), "vectors")
    found = inside.groupBy("o").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count("*").alias("n")).orderBy("o").collect()
    number, low, high, n = (np.array([r[c] for r in found], kind) for c, kind in (("o", np.int64), ("low", float), ("high", float), ("n", np.int64)))
    blocks = {int(o): int(-(-x // (2 * block))) for o, x in zip(number, n, strict=True)}
    out = Shells(inside, pivots, number, number // SHELLS, low, high, n, blocks)
    before = np.cumsum(n) - n
    some = [(int(o), blocks[int(o)], int(x), int(y)) for o, x, y in zip(number, n, before, strict=True)]  # PIVOTS * SHELLS at most
    sizes = inside.sparkSession.createDataFrame(some, "o int, b int, n long, before long")
    h = F.pmod(F.xxhash64("k"), "b").cast("int")
    g = F.floor((F.col("before") + F.pmod(F.xxhash64("k", F.lit(1)), "n")) / out.set_size()).cast("int")
    out.rows = inside.join(F.broadcast(sizes), "o").select("k", "v", "o", h.alias("h"), g.alias("g"))
    return out


def _own_best(s: Shells) -> DataFrame:
    """(k, v, o, s): each vector's largest similarity within its block."""

    def run(table: pa.Table) -> pa.Table:
        k, v = table.column("k").to_numpy(), _unit(table.column("v"))
        best = [np.zeros(0)]
        for at in range(0, len(k), 2000):
            found = v[at : at + 2000] @ v.T
            found[k[at : at + 2000][:, None] == k[None, :]] = -np.inf
            best.append(found.max(axis=1))
        return pa.table({"k": table.column("k"), "v": table.column("v"), "o": table.column("o"), "s": np.concatenate(best)})

    return materialize(s.rows.groupBy("o", "h").applyInArrow(run, "k long, v array<float>, o int, s double"), "own")


def _asks(own: DataFrame, s: Shells) -> DataFrame:
    """(k, v, sets): the shells os, by their sets g, that may hold a vector nearer than the best of its own block.

    A vector at an angle t to a pivot is, by the triangle inequality, at t - high and at low - t at least from all of its shell.
    """
    pivots, number, pivot, low, high = s.pivots, s.number, s.pivot, s.low, s.high
    lone = np.array([s.blocks[int(o)] == 1 for o in number])
    first, last = s.sets()
    count = last - first + 1
    shell = np.repeat(np.arange(len(number)), count)  # a column for each shell and set of it, in the order of sets
    group = np.repeat(first, count) + np.arange(len(shell)) - np.repeat(np.cumsum(count) - count, count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                v, have = _unit(batch.column("v")), batch.column("s").to_numpy()
                best = np.where(have > -np.inf, np.arccos(np.clip(have, -1, 1)), 4.0) + SLACK
                best[np.abs(v).max(axis=1) == 0] = 8.0  # without direction: the inequality says nothing of it
                t = _angles(v, pivots)[:, pivot]
                ask = np.maximum(t - high, low - t) <= best[:, None]
                ask &= ~((batch.column("o").to_numpy()[:, None] == number) & lone)
                row, column = np.nonzero(ask[:, shell])
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (group[column[1:]] != group[column[:-1]])])) if len(row) else np.zeros(0, int)
                os = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(number[shell[column]], pa.int32()))
                each = pa.StructArray.from_arrays([pa.array(group[column[new]], pa.int32()), os], names=["g", "os"])
                ends = np.searchsorted(row[new], np.arange(len(v) + 1))
                yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("v"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)], names=["k", "v", "sets"])

    return own.mapInArrow(run, "k long, v array<float>, sets array<struct<g: int, os: array<int>>>")


def max_similarity(vectors: DataFrame, key: str, vector: str, block: int = 2000) -> DataFrame:
    """(key, max_sim): the largest cosine similarity of each vector with one of another key; null for a lone vector.

    Exact. Each vector is multiplied with those of its own block first, and then with those of the shells that could hold a nearer
    one, by its angles to the pivots. Those are few where vectors lie in clusters, and up to all where they are
    spread evenly: the work is then quadratic by nature. compared_share reports it. Rows without key or vector are left out.
    """
    s = shells(vectors, key, vector, block)
    own = _own_best(s)
    asks = materialize(_asks(own, s), "asks")
    # a vector asks a set once, with the shells it asks of it; asks of a set may be many: they are dealt to parts, and the set's
    # vectors come once to each part
    size = s.set_size()
    each_set = asks.select("k", "v", F.explode("sets").alias("x")).select("k", "v", "x.g", "x.os")
    parts = asks.select(F.explode("sets.g").alias("g")).groupBy("g").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    asking = each_set.join(F.broadcast(parts), "g").select("g", F.pmod(F.hash("k"), "parts").alias("part"), "k", "v", "os", F.lit(None).cast("int").alias("o"))
    asked = s.rows.join(F.broadcast(parts), "g").select("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "k", "v", F.lit(None).cast("array<int>").alias("os"), "o")

    def run(table: pa.Table) -> pa.Table:
        left = np.array(table.column("o").is_null())
        there, rows = table.filter(pa.array(~left)).sort_by("o"), table.filter(pa.array(left))
        held_k, held, o = there.column("k").to_numpy(), _unit(there.column("v")), there.column("o").to_numpy()
        k, out = rows.column("k").to_numpy(), np.full(rows.num_rows, -np.inf)
        for at in range(0, len(k), 2000):
            some = rows.slice(at, 2000)
            v, wanted = _unit(some.column("v")), some.column("os").combine_chunks()
            shell = wanted.flatten().to_numpy()
            row = np.repeat(np.arange(len(v)), np.array(wanted.value_lengths()))
            order = np.argsort(shell, kind="stable")
            shell, row = shell[order], row[order]
            for x in np.unique(shell).tolist():
                who = row[np.searchsorted(shell, x) : np.searchsorted(shell, x, "right")]
                lo, hi = np.searchsorted(o, x), np.searchsorted(o, x, "right")
                for b in range(lo, hi, 2 * block):
                    to = min(hi, b + 2 * block)
                    found = v[who] @ held[b:to].T
                    found[k[at + who][:, None] == held_k[None, b:to]] = -np.inf
                    out[at + who] = np.maximum(out[at + who], found.max(axis=1))
        return pa.table({"k": k, "s": out})

    found = asking.unionByName(asked).groupBy("g", "part").applyInArrow(run, "k long, s double")
    best = found.unionByName(own.select("k", "s")).groupBy("k").agg(F.max("s").alias("s"))
    return best.select(F.col("k").alias(key), F.when(F.col("s") > float("-inf"), F.col("s")).alias("max_sim"))


def compared_share(vectors: DataFrame, key: str, vector: str, block: int = 2000) -> float:
    """The share of all pairs of vectors that max_similarity multiplies: within blocks, and with the shells that could be nearer."""
    s = shells(vectors, key, vector, block)
    sizes = s.rows.sparkSession.createDataFrame([(int(o), int(n)) for o, n in zip(s.number, s.size, strict=True)], "o int, n long")
    asks = _asks(_own_best(s), s).select(F.explode(F.array_distinct(F.flatten("sets.os"))).alias("o"))
    asked = asks.join(F.broadcast(sizes), "o").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inside = s.rows.groupBy("o", "h").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0))).first()[0]
    n = int(s.size.sum())
    return (asked + inside) / max(1, n * n)


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
