"""Exact nearest neighbours by inner product: a block matrix join with int8 tiles and error bounds.

Queries and candidates are packed to blocks of bounded bytes, and every cell of a query block and a candidate block is one
task's work. A cell goes tile by tile: vectors are stored as int8 steps of their own scale, a tile's product of whole numbers is
exact, and by the Cauchy-Schwarz inequality the lengths of what rounding took away bound how far the true product lies
from it. A pair is left out only if its upper bound is below the k-th best lower bound known for its query; survivors are computed
again from the original vectors in double precision, and heaps merge a query's best over tiles, and then over cells.

The work is (queries) x (candidates) by nature, as the result is exact. What is shuffled is each block once for every block of
the other side.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 20
EVERY = 20
#: Bytes of a block of queries or candidates, about.
BLOCK_BYTES = 12 << 20
#: Candidate blocks for each core there is, at least, so that all have work.
BLOCKS_A_CORE = 2
TILE = 2048
#: Products of int8 vectors of so many entries are exact in single precision.
EXACT = 1024
#: Queries whose results travel in one row, and results of cells that are merged at once.
QUERY_ROWS = 2048
FAN_IN = 64


def quantize(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 steps, the scale of each row, and upper bounds on the lengths of what the steps stand for and of what they leave."""
    scale = np.abs(v).max(axis=1) / 127
    scale[scale == 0] = 1.0
    steps = np.rint(v / scale[:, None]).astype(np.int8)
    stands = steps * scale[:, None]
    slack = 1 + 1e-9
    return steps, scale, np.linalg.norm(stands, axis=1) * slack, np.linalg.norm(v - stands, axis=1) * slack


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows as whole numbers, exact: floats hold them, EXACT entries at a time."""
    out = np.zeros((len(a), len(b)), np.float64 if a.shape[1] > EXACT else np.float32)
    for at in range(0, a.shape[1], EXACT):
        out += a[:, at : at + EXACT].astype(np.float32) @ b[:, at : at + EXACT].astype(np.float32).T
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each row of a with that of b, summed entry by entry from the first on."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return np.where(np.isnan(out), -np.inf, out)  # of products that overflowed both ways


class Best:
    """The k best candidates of a query, each id once; ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.heap, self.score = k, [], {}

    def put(self, scores: list[float], ids: list[int]) -> None:
        for s, i in zip(scores, ids, strict=True):
            if i in self.score:
                if s > self.score[i]:  # another vector of the same id
                    self.heap.remove((self.score[i], -i))
                    heapq.heapify(self.heap)
                    heapq.heappush(self.heap, (s, -i))
                    self.score[i] = s
            elif len(self.heap) < self.k:
                heapq.heappush(self.heap, (s, -i))
                self.score[i] = s
            elif (s, -i) > self.heap[0]:
                _, gone = heapq.heappushpop(self.heap, (s, -i))
                del self.score[-gone]
                self.score[i] = s

    @property
    def least(self) -> float:
        return self.heap[0][0] if len(self.heap) == self.k else -np.inf


def cell(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, tile: int = TILE) -> tuple[list[Best], int]:
    """The best candidates of a cell for each query row, and the number of pairs that were computed in double precision.

    Candidates are sorted by id, and a bound counts once for an id, however many vectors it has.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    best = [Best(k) for _ in q_ids]
    with np.errstate(over="ignore", invalid="ignore"):
        exact = _tiles(q_ids, q, c_ids, c, k, tile, best)
    return best, exact


def _tiles(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, tile: int, best: list[Best]) -> int:
    exact = 0
    (qs, q_scale, q_long, q_rest), (cs, c_scale, c_long, c_rest) = quantize(q), quantize(c)
    for i in range(0, len(q), tile):
        rows = slice(i, i + tile)
        for j in range(0, len(c), tile):
            cols = slice(j, j + tile)
            product = tile_product(qs[rows], cs[cols]).astype(np.float64) * (q_scale[rows, None] * c_scale[None, cols])
            # <a, b> - <a', b'> = <a - a', b> + <a', b - b'>, with |b| <= |b'| + |b - b'|
            error = q_rest[rows, None] * (c_long[cols] + c_rest[cols])[None, :] + q_long[rows, None] * c_rest[None, cols]
            error += 1e-12 * (q_long[rows, None] + q_rest[rows, None]) * (c_long[cols] + c_rest[cols])[None, :]
            ids = c_ids[cols]
            own = q_ids[rows, None] == ids[None, :]
            least = np.array([b.least for b in best[rows]])
            lower = product - error
            lower[own | ~np.isfinite(lower)] = -np.inf
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            by_id = np.maximum.reduceat(lower, starts, axis=1) if len(starts) < len(ids) else lower
            if by_id.shape[1] >= k and (least == -np.inf).any():
                least = np.maximum(least, np.partition(by_id, by_id.shape[1] - k, axis=1)[:, by_id.shape[1] - k])
            at, of = np.nonzero(~((product + error < least[:, None]) | own))  # what overflowed stays
            exact += len(at)
            for part in range(0, len(at), 1 << 16):
                a, b = at[part : part + (1 << 16)], of[part : part + (1 << 16)]
                scores = inner(q[i + a], c[j + b])
                edge = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                for x, y in zip(edge, [*edge[1:], len(a)], strict=True):
                    best[i + a[x]].put(scores[x:y].tolist(), ids[b[x:y]].tolist())
    return exact


def merged(lists: list[list[tuple[float, int]]], k: int) -> list[tuple[float, int]]:
    """The first k of sorted lists of (-score, id), each id once."""
    out: dict[int, float] = {}
    for s, i in heapq.merge(*lists):
        if i not in out:
            out[i] = s
            if len(out) == k:
                break
    return [(s, i) for i, s in out.items()]


RESULTS = "part int, cell int, query binary, n binary, score binary, id binary"


def _results(part: int, number: int, found: dict[int, list[tuple[float, int]]]) -> dict:
    """A row of results: sorted (-score, id) of some queries."""
    flat = [x for r in found.values() for x in r]
    return {"part": part, "cell": number, "query": np.array(list(found), np.int64).tobytes(), "n": np.array([len(r) for r in found.values()], np.int32).tobytes(), "score": np.array([x[0] for x in flat]).tobytes(), "id": np.array([x[1] for x in flat], np.int64).tobytes()}


def _read(row: dict) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    score, ids = np.frombuffer(row["score"]).tolist(), np.frombuffer(row["id"], np.int64).tolist()
    at = 0
    for q, n in zip(np.frombuffer(row["query"], np.int64).tolist(), np.frombuffer(row["n"], np.int32).tolist(), strict=True):
        yield q, list(zip(score[at : at + n], ids[at : at + n], strict=True))
        at += n


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(k, v): rows with an id and a vector of finite numbers of which one is not zero."""
    base = vectors.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return base.where(F.col("k").isNotNull() & F.coalesce(good, F.lit(False)))


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product for each id divisible by every.

    Exact, ties to the smaller id; all candidates where there are fewer than k. Candidates are all other ids. Rows without
    id, and vectors that are null, empty, zero or hold a null or a number that isn't finite take no part; vectors are near only
    to those of as many entries. Rows of one id are one query and one candidate, whose score is the largest of its vectors';
    repeated rows count once. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    base = usable(vectors, key, vector).withColumn("d", F.size("v"))
    size = base.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("d").cast("long")), F.lit(0)).alias("entries"), F.count(F.when(F.col("k") % every == 0, 1)).alias("q")).first()
    asked = size["entries"] * 8 / block_bytes
    c_blocks = max(BLOCKS_A_CORE * spark.sparkContext.defaultParallelism, int(asked) + 1)
    q_blocks = int(asked * size["q"] / max(1, size["n"])) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths = np.array(batch.column("k")), np.array(batch.column("d"))
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            c_of, q_of = np.array(batch.column("c")), np.array(batch.column("q"))
            for d in np.unique(lengths):
                for side, block_of in ((0, q_of), (1, c_of)):
                    mine = (lengths == d) & (block_of >= 0)
                    for b in np.unique(block_of[mine]):
                        rows = np.flatnonzero(mine & (block_of == b))
                        v = flat[(ends[rows] - d)[:, None] + np.arange(d)]
                        whole = np.unique(np.column_stack([ids[rows].view(np.float64), v]).view(np.int64), axis=0)  # repeated rows once
                        for at in range(0, len(whole), max(1, (1 << 20) // (8 * int(d)))):
                            w = np.ascontiguousarray(whole[at : at + max(1, (1 << 20) // (8 * int(d)))])
                            columns = [[int(d)], [side], [int(b)], [np.ascontiguousarray(w[:, 0]).tobytes()], [np.ascontiguousarray(w[:, 1:]).tobytes()]]
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["d", "side", "b", "ids", "v"])

    spread = F.xxhash64("k", "v")  # repeated rows come to one block, those of an id needn't
    dealt = base.select("k", "v", "d", F.pmod(spread, F.lit(c_blocks)).cast("int").alias("c"), F.when(F.col("k") % every == 0, F.pmod(F.shiftrightunsigned(spread, 32), F.lit(q_blocks)).cast("int")).otherwise(-1).alias("q"))
    packed = dealt.mapInArrow(pack, "d int, side int, b int, ids binary, v binary")
    other = F.when(F.col("side") == 0, F.lit(c_blocks)).otherwise(F.lit(q_blocks))
    cells = packed.withColumn("o", F.explode(F.sequence(F.lit(0), other - 1)))
    cells = cells.select("d", "side", "ids", "v", F.when(F.col("side") == 0, F.col("b")).otherwise(F.col("o")).alias("x"), F.when(F.col("side") == 0, F.col("o")).otherwise(F.col("b")).alias("y"))

    schema = pa.schema([("part", pa.int32()), ("cell", pa.int32()), ("query", pa.binary()), ("n", pa.binary()), ("score", pa.binary()), ("id", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        d, x, y = (table.column(c)[0].as_py() for c in ("d", "x", "y"))
        sides = []
        for side in (0, 1):
            own = table.filter(pc.equal(table.column("side"), side))
            ids = np.concatenate([np.frombuffer(r.as_py(), np.int64) for r in own.column("ids")] or [np.zeros(0, np.int64)])
            v = np.concatenate([np.frombuffer(r.as_py(), np.float64).reshape(-1, d) for r in own.column("v")] or [np.zeros((0, d))])
            sides.append((ids, v))
        (q_ids, q), (c_ids, c) = sides
        if not len(q_ids) or not len(c_ids):
            return schema.empty_table()
        best, _ = cell(q_ids, q, c_ids, c, k)
        lists: dict[int, list] = {}
        for i, b in zip(q_ids.tolist(), best, strict=True):
            lists.setdefault(i, []).append(sorted((-s, -m) for s, m in b.heap))
        parts: dict[int, dict] = {}
        for i, own in lists.items():
            parts.setdefault(hash(i) % query_parts, {})[i] = merged(own, k)
        return pa.Table.from_pylist([_results(p, y, found) for p, found in parts.items()], schema)

    # queries of one part come from all query blocks: an id may have vectors in several
    query_parts = max(1, -(-size["q"] // QUERY_ROWS))

    def merge(table: pa.Table) -> pa.Table:
        part, number = table.column("part")[0].as_py(), table.column("group")[0].as_py()
        lists: dict[int, list] = {}
        for batch in table.to_batches():
            for row in batch.to_pylist():
                for q, found in _read(row):
                    lists.setdefault(q, []).append(found)
        return pa.Table.from_pylist([_results(part, number, {q: merged(own, k) for q, own in lists.items()})], schema)

    found, left = cells.groupBy("d", "x", "y").applyInArrow(run, RESULTS), c_blocks
    while True:
        left = -(-left // FAN_IN)
        found = found.withColumn("group", F.pmod("cell", F.lit(left))).groupBy("part", "group").applyInArrow(merge, RESULTS)
        if left == 1:
            break

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = [(q, r, i, -s) for q, own in _read(row) for r, (s, i) in enumerate(own, 1)]
                for at in range(0, len(rows), 10_000):
                    columns = zip(*rows[at : at + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "rank", "vec_id", "score"])

    return found.mapInArrow(unpack, "query_id long, rank int, vec_id long, score double")


def op12_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest embeddings of every embedding whose id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, max(list_inner_product(q.e, c.e)) AS score FROM (SELECT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


def brute_force(rows: list[tuple], k: int = K, every: int = EVERY) -> list[tuple]:
    """The contract read pair by pair, for tests: (query_id, rank, vec_id, score)."""
    good = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        score: dict[int, float] = {}
        for a in (v for i, v in good if i == q):
            for i, b in good:
                if i != q and len(a) == len(b):
                    s = 0.0
                    for x, y in zip(a, b, strict=True):
                        s += x * y
                    score[i] = max(score.get(i, -np.inf), s)
        out += [(q, r, i, score[i]) for r, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:k], 1)]
    return out
