"""Whitening of embeddings by shifted Cholesky QR.

The rows to fit on are centred and orthogonalised by passes over them. A pass solves each block of rows against the triangular
factors found so far, adds up the Gram matrix of what that gives, block by block and in Spark, and its Cholesky factor joins
the others. The first pass shifts its Gram matrix, so that it has a factor however badly the columns are conditioned; the next
ones repair what the shift and rounding cost. The rows are then Q R with Q orthogonal, so R alone has their singular values
and vectors: components, and their variances.

Only matrices of (dimensions)**2 numbers reach the driver, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Passes after the shifted one.
PASSES = 2
#: Rows that a task holds at once.
BLOCK_ROWS = 4096
#: Entries of greater size have no whole number of their own among doubles.
LIMIT = float(1 << 53)


def grid(vectors: DataFrame, key: str, vector: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(k, x): vectors of finite entries as whole numbers."""
    base = vectors.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < LIMIT)) & (F.size("v") > 0)
    return base.where(F.coalesce(good, F.lit(False))).select("k", F.transform("v", lambda c: F.floor(c * scale) + F.lit(offset)).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, part.column("x").flatten().to_numpy().reshape(-1, d)


def _wide(most: int) -> type:
    """Numbers to count with where none exceeds most."""
    return np.int64 if most < 1 << 62 else object


class Fit:
    """n rows with the whole sums of their dimensions, the triangular factors found and, at last, the components."""

    def __init__(self, n: int, sums: list[int], most: int):
        self.n, self.sums, self.d = n, sums, len(sums)
        self.base = [s // n for s in sums]  # x - S / n = (x - base) - rest / n
        self.rest = [s % n for s in sums]
        self.most = most  # no x is farther from its base
        self.factors: list[np.ndarray] = []

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.base, np.int64)).astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)**2, in whole numbers; null where a long can't hold it."""
        most = self.n * (self.most + 1)
        kind = _wide(most * most * self.d)
        y = self.n * (x - np.array(self.base, np.int64)).astype(kind) - np.array(self.rest, kind)
        return [s if s < 1 << 63 else None for s in (y * y).sum(axis=1).tolist()]

    def orthogonalised(self, x: np.ndarray) -> np.ndarray:
        q = self.centred(x)
        for r in self.factors:
            q = solve_right(q, r)
        return q

    def solve(self) -> None:
        """Components (columns) by falling variance, the variances e and their sum, from the singular values of R."""
        r = np.eye(self.d)
        for f in self.factors:
            r = f @ r
        _, s, wt = np.linalg.svd(r)
        e = s * s / self.n
        self.total = float(e.sum())
        rank = int((s > s[0] * max(self.n, self.d) * np.finfo(float).eps).sum()) if s[0] > 0 else 0
        self.e, self.w = e[:rank], wt[:rank].T

    def whitened(self, x: np.ndarray, count: int) -> np.ndarray:
        return self.centred(x) @ self.w[:, :count] / np.sqrt(self.e[:count])


def solve_right(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x times the inverse of the upper triangular r, column by column."""
    out = np.empty_like(x)
    for j in range(len(r)):
        out[:, j] = (x[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper factor of gram, shifted as far as asked, or further where it has none without."""
    eps = np.finfo(float).eps * max(float(np.trace(gram)), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, eps)


def gram(rows: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The Gram matrix of what ``of`` makes of the rows: each task adds up its own, then Spark adds them line by line."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for _, x in _blocks(batches, d):
            q = of(x)
            total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], names=["i", "line"])

    def add(table: pa.Table) -> pa.Table:
        lines = sorted(x.as_py() for x in table.column("line"))  # a fixed order, for a fixed sum
        total = np.sum([np.frombuffer(x) for x in lines], axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "line": pa.array([total.tobytes()], pa.binary())})

    lines = rows.mapInArrow(own, "i int, line binary").groupBy("i").applyInArrow(add, "i int, line binary").collect()
    out = np.zeros((size, size))
    for r in lines:
        out[r["i"]] = np.frombuffer(r["line"])
    return out


def fit(points: DataFrame, d: int, passes: int = PASSES) -> Fit | None:
    """The components of distinct points (x) of d dimensions; None of no points."""
    parts = (("high", lambda x: F.shiftright(x, 24)), ("low", lambda x: x.bitwiseAND((1 << 24) - 1)))
    each = points.select(F.posexplode("x").alias("j", "x")).groupBy("j").agg(*[F.sum(f(F.col("x"))).alias(name) for name, f in parts], F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
    each = each.orderBy("j").collect()
    if not each:
        return None
    found = Fit(each[0]["n"], [(r["high"] << 24) + r["low"] for r in each], max(r["most"] - r["least"] for r in each))
    for k in range(1 + passes):
        g = gram(points, d, found.orthogonalised, d)
        # 11 (n d + d (d + 1)) u |X|**2 keeps the Gram matrix positive definite whatever its condition
        shift = 11 * (found.n * d + d * (d + 1)) * np.finfo(float).eps / 2 * float(np.trace(g)) if k == 0 else 0.0
        found.factors.append(cholesky(g, shift))
    found.solve()
    return found


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each vector and component.

    Vectors become whole numbers x = floor(scale * c) + offset, and components are fitted on each distinct x once: n of them.
    Vectors that are null, empty, or hold a null or an entry that isn't finite (or is so large that doubles have no whole
    numbers there) are left out; where lengths differ, those not of the commonest length (of equals the greater). Components
    without variance, beyond the rank of the points, have no rows, so equal vectors alone give none. A null id stays; repeated
    rows get equal results. An empty table gives no rows; other columns are not read.
    """
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = grid(vectors, key, vector, scale, offset)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    rows = rows.where(F.size("x") == d)
    points = materialize(rows.select("x").distinct(), "points")
    found = fit(points, d)
    count = min(components, len(found.e)) if found else 0
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    error = float(np.abs(gram(points, d, lambda x: found.whitened(x, count), count) / found.n - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, share = np.arange(1, count + 1, dtype=np.int32), found.e[:count] / found.total
        for batch, x in _blocks(batches, d):
            m = len(x)
            keys = batch.column("k").take(pa.array(np.repeat(np.arange(m), count)))
            deviation = pa.array(found.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), count)))
            columns = [keys, pa.array(np.tile(number, m)), pa.array(np.full(m * count, found.n, np.int64)), deviation, pa.array(found.whitened(x, count).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * count, error))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema.replace(f"{key} long", "key long", 1)).withColumnRenamed("key", key)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Every embedding in whitened components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = None
