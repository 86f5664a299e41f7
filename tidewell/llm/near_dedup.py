"""Near-duplicate groups by SuperMinHash.

SuperMinHash gives every element of a set a random permutation of the signature's places; in round j the element offers
the value j + r (r random in 0..1) to the j-th place of its permutation, and each place keeps its least value. As one
element's offers differ in rank from place to place, the places are correlated and estimates vary less than with
independent hashes. A set is finished as soon as all its places hold values below the next round's, which for all but
short texts is after a few rounds (early stopping that changes nothing).

Bands of the signatures name buckets. Candidates are verified on the full sets: first each class of equal sets against
the least class of any of its buckets, then against the least class of each bucket. Where a bucket still holds several
components, its members outside the largest one are compared with all others, block by block with matrix products. Pairs
within one component need no test, so a group of near copies costs little more than its size, and yet no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words
from tidewell.llm.components import components
from tidewell.session import materialize, materialize_keys

SHINGLE = 5
PERCENT = 80
BANDS = 40
BAND_ROWS = 5
CHUNK = 100_000
BLOCK_BYTES = 256 << 10
CELL_BLOCKS = 12
#: Shingles that a matrix of a block holds at once, and members that are compared at once.
CHUNK_SHINGLES = 2048
ROWS = 256
_U = np.uint64
_HIGH = _U(48)


def superminhash(doc: np.ndarray, h: np.ndarray, n: int, places: int) -> np.ndarray:
    """Signatures (n x places) of n sets given as (set, element hash) pairs sorted by set. places: at most 256."""
    sig = np.full(n * places, np.iinfo(np.uint64).max, _U)
    at = 0
    while at < len(doc):
        to = min(len(doc), at + CHUNK)
        to = int(np.searchsorted(doc, doc[to - 1], side="right"))
        d, e, perm = doc[at:to], h[at:to], None
        for j in range(places):
            x = words.mix(e * _U(0x9E3779B97F4A7C15) + _U(j + 1))
            value = (_U(j) << _HIGH) | (x >> _U(16))
            k = j + ((x & _U(0xFFFF)) % _U(places - j)).astype(np.int64)
            if perm is None:
                place = k
            else:
                rows = np.arange(len(e))
                place = perm[rows, k].astype(np.int64)
                perm[rows, k] = perm[:, j]
                perm[:, j] = place
            np.minimum.at(sig, d * places + place, value)
            first, last = int(d[0]), int(d[-1])
            done = sig[first * places : (last + 1) * places].reshape(-1, places).max(axis=1) < (_U(j + 1) << _HIGH)
            go = ~done[d - first]
            if not go.any():
                break
            if perm is None:
                perm = np.tile(np.arange(places, dtype=np.uint8), (int(go.sum()), 1))
                rows = np.arange(len(perm))
                perm[:, 0] = k[go]
                perm[rows, k[go]] = 0
            else:
                perm = perm[go]
            d, e = d[go], e[go]
        at = to
    return sig.reshape(n, places)


SIGNED = "d long, r long, n long, k long, bands array<bigint>, t string"


def _sign(shingle: int, bands: int, band_rows: int):
    weights = words.mix(np.arange(1, band_rows + 1, dtype=_U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in words.slices(batch, "t"):
                w = words.split(piece.column("t"), "white_lower")
                doc, h = words.shingles(w, shingle)
                m = piece.num_rows
                n = np.bincount(doc, minlength=m)
                with np.errstate(over="ignore"):
                    sums = np.concatenate([np.zeros(1, _U), np.cumsum(words.mix(h + _U(1)))])
                    to = np.cumsum(n)
                    k = words.mix(sums[to] - sums[to - n] + n.astype(_U)).view(np.int64)
                    sig = superminhash(doc, h, m, bands * band_rows).reshape(m, bands, band_rows)
                    keys = words.mix((sig * weights).sum(axis=2) + np.arange(bands, dtype=_U) * _U(0xD6E8FEB86659FD93)).view(np.int64)
                full = n > 0
                offsets = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("d"), pa.array(row + np.arange(m)), pa.array(n), pa.array(k, mask=~full), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel())), piece.column("t")],
                    names=["d", "r", "n", "k", "bands", "t"],
                )
                row += m

    return run


def _same(shingle: int, percent: int):
    """Edges (a, b, ta, tb) whose texts' full sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, "ta", max_docs=1024):
                sets = [words.shingles(words.split(piece.column(c), "white_lower"), shingle) for c in ("ta", "tb")]
                sizes = [np.bincount(d, minlength=piece.num_rows) for d, _ in sets]
                key = np.concatenate([(d.astype(_U) << _U(52)) | h for d, h in sets])
                key.sort()
                both = np.bincount((key[1:][key[1:] == key[:-1]] >> _U(52)).astype(np.int64), minlength=piece.num_rows)
                keep = np.flatnonzero(100 * both >= percent * (sizes[0] + sizes[1] - both))
                yield pa.RecordBatch.from_arrays([piece.column("a").take(pa.array(keep)), piece.column("b").take(pa.array(keep))], names=["a", "b"])

    return run


def _linked_blocks(shingle: int, percent: int):
    """Links between members of the pairs of blocks of a cell that are in different components: one for each stray member
    of the first block and component of the second. A cell's rows are its members (block, k, c, stray, t) and its pairs of
    blocks (x, y); each block's sets are made once."""

    def sets(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        found, at = [], 0
        for batch in pa.table([texts], names=["t"]).combine_chunks().to_batches():
            for piece in words.slices(batch, "t"):
                doc, h = words.shingles(words.split(piece.column("t"), "white_lower"), shingle)
                found.append((doc + at, h))
                at += piece.num_rows
        return np.concatenate([d for d, _ in found]), np.concatenate([h for _, h in found])

    def only(block: tuple, rows: np.ndarray) -> tuple:
        """The block's members at rows."""
        k, c, stray, d, h = block
        place = np.full(len(k), -1)
        place[rows] = np.arange(len(rows))
        own = place[d] >= 0
        return k[rows], c[rows], stray[rows], place[d[own]], h[own]

    def link(x: tuple, y: tuple) -> tuple[list[int], list[int]]:
        (kx, cx, _, dx, hx), (ky, cy, _, dy, hy) = x, y
        nx, ny = np.bincount(dx, minlength=len(kx)), np.bincount(dy, minlength=len(ky))
        both = np.intersect1d(hx, hy)
        shared = np.zeros((len(kx), len(ky)), np.float32)  # whole numbers, far below 2**24
        for part in np.split(both, range(CHUNK_SHINGLES, len(both), CHUNK_SHINGLES)):
            sides = []
            for d, h, n in ((dx, hx, len(kx)), (dy, hy, len(ky))):
                column = np.minimum(np.searchsorted(part, h), max(len(part) - 1, 0))
                there = part[column] == h if len(part) else np.zeros(len(h), bool)
                side = np.zeros((n, len(part)), np.float32)
                side[d[there], column[there]] = 1
                sides.append(side)
            shared += sides[0] @ sides[1].T
        a, b = [], []
        for at in range(0, len(kx), ROWS):  # so that no other matrix is as large
            own = slice(at, at + ROWS)
            s = np.rint(shared[own]).astype(np.int64)
            near = (100 * s >= percent * (nx[own, None] + ny[None, :] - s)) & (cx[own, None] != cy[None, :])
            for i in np.flatnonzero(near.any(axis=1)):
                hit = np.flatnonzero(near[i])
                for j in hit[np.unique(cy[hit], return_index=True)[1]]:
                    a.append(int(kx[at + i]))
                    b.append(int(ky[j]))
        return a, b

    def run(cell: pa.Table) -> pa.Table:
        pair = np.array(cell.column("x").is_valid())
        members = cell.filter(pa.array(~pair)).sort_by([("block", "ascending"), ("k", "ascending")])
        ids = np.array(members.column("block"))
        cut = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        blocks = {}
        for lo, hi in zip(cut, [*cut[1:], len(ids)], strict=True):
            part = members.slice(lo, hi - lo)
            blocks[int(ids[lo])] = (*(np.array(part.column(c)) for c in ("k", "c", "stray")), *sets(part.column("t")))
        a, b = [], []
        pairs = cell.filter(pa.array(pair))
        for x, y in zip(pairs.column("x").to_pylist(), pairs.column("y").to_pylist(), strict=True):
            found = link(only(blocks[x], np.flatnonzero(blocks[x][2])), blocks[y])
            a += found[0]
            b += found[1]
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _block_links(at: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links that join components, out of the buckets that hold several. at: members h, k, lo, c.

    In such a bucket the members outside its largest component are compared with all others. Members are put in blocks of
    bounded size, those that hang together by such buckets side by side. Pairs of blocks that meet in a bucket are compared
    by a matrix product, so pairs of documents never become rows, and pairs of blocks are rows of two numbers. Blocks are
    put in sets of about CELL_BLOCKS; all pairs between two such sets are one task's group, a cell, to which each of their
    blocks comes once.
    """
    at = materialize_keys(at, "placed")
    sizes = at.groupBy("h", "c").agg(F.count("*").alias("m"))
    main = sizes.groupBy("h").agg(F.max(F.struct("m", "c")).alias("x"), F.count("*").alias("parts")).where("parts > 1").select("h", F.col("x.c").alias("main"))
    open_ = materialize_keys(at.join(main, "h"), "open")
    family = components(open_.select("k", F.col("lo").alias("b")), "k", "b").select(F.col("node").alias("k"), F.col("component").alias("f"))
    home = open_.groupBy("k").agg(F.min("h").alias("g"), F.first("c").alias("c"), F.max(F.col("c") != F.col("main")).alias("stray"))
    home = home.join(texts.select("k", (F.length("t") + 64).alias("bytes")), "k").join(family, "k")
    of_g = home.groupBy("f", "g").agg(F.sum("bytes").alias("g_bytes"))
    of_f = of_g.groupBy("f").agg(F.sum("g_bytes").alias("f_bytes"))
    home = home.join(of_g, ["f", "g"]).join(of_f, "f")
    parts = [F.pmod(F.col(x), F.ceil(F.col(n) / BLOCK_BYTES)) for x, n in (("g", "f_bytes"), ("k", "g_bytes"))]
    home = materialize_keys(home.select("k", "c", "stray", "f", F.xxhash64("f", *parts).alias("block")), "blocks")
    meet = open_.join(home.select("k", "block"), "k")
    left = meet.where("c <> main").select("h", F.col("block").alias("x")).distinct()
    pairs = left.join(meet.select("h", F.col("block").alias("y")).distinct(), "h").select("x", "y").distinct()
    blocks = home.select("f", "block").distinct()
    sets_of = blocks.groupBy("f").agg(F.ceil(F.count("*") / CELL_BLOCKS).alias("sets"))
    placed = materialize_keys(blocks.join(sets_of, "f").select("block", F.xxhash64("f", F.pmod("block", "sets")).alias("set")), "block-sets")
    ends = [placed.select(F.col("block").alias(e), F.col("set").alias(f"set_{e}")) for e in ("x", "y")]
    cells = pairs.join(ends[0], "x").join(ends[1], "y").select(F.xxhash64(F.least("set_x", "set_y"), F.greatest("set_x", "set_y")).alias("cell"), "x", "y")
    cells = materialize_keys(cells, "cells")
    need = cells.select("cell", F.col("x").alias("block")).unionByName(cells.select("cell", F.col("y").alias("block"))).distinct()
    members = need.join(home.select("block", "k", "c", "stray"), "block").join(texts, "k")
    rows = members.select("cell", "block", "k", "c", "stray", "t").unionByName(cells, allowMissingColumns=True)
    return materialize_keys(rows.groupBy("cell").applyInArrow(_linked_blocks(shingle, percent), "a long, b long"), "links")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """For each row of docs: doc_id, key (its text's hash), n_shingles, component_id, kept, first.

    A text's set is its distinct runs of ``shingle`` words (A-Z as a-z, parted by white space); a text of fewer words has
    one run of them all; null, empty and blank texts have none and are linked with nothing. Two texts are linked if
    100 * intersection >= percent * union. component_id is the least doc_id reachable over links; kept marks rows of that
    id, first exactly one row of each component, also where rows repeat or ids are null (nulls are last). With 40 bands
    of 5 a pair of similarity 0.8 shares no bucket with a chance of 1.3e-7. Other columns are not read; an empty table
    gives no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    signed = materialize(base.mapInArrow(_sign(shingle, bands, band_rows), SIGNED), "signed")
    keyed = signed.where("n > 0").select("k", F.explode("bands").alias("h"))
    buckets = keyed.groupBy("h").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi").select("h", "lo")
    buckets = materialize_keys(buckets, "buckets")
    members = materialize_keys(keyed.join(buckets, "h").distinct(), "members")  # h, k, lo
    firsts = signed.where("n > 0").groupBy("k").agg(F.min("r").alias("r")).join(members.select("k").distinct(), "k", "left_semi")
    texts = materialize(signed.select("r", "t").join(firsts, "r").select("k", "t"), "texts")

    def verify(pairs: DataFrame) -> DataFrame:
        """pairs: distinct (a, b)."""
        sides = pairs.join(texts.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")
        longer = F.length("ta") >= F.length("tb")  # slices are bounded by the first text
        sides = sides.select("a", "b", F.when(longer, F.col("ta")).otherwise(F.col("tb")).alias("ta"), F.when(longer, F.col("tb")).otherwise(F.col("ta")).alias("tb"))
        return sides.mapInArrow(_same(shingle, percent), "a long, b long")

    nothing = members.select(F.col("k").alias("a"), F.col("k").alias("b")).limit(0)
    tested, comp = nothing, members.select(F.col("k").alias("node"), F.col("k").alias("component")).limit(0)

    def test(pairs: DataFrame, name: str) -> int:
        """Verifies the pairs not tested yet, and brings the components up to date; how many pairs they were."""
        nonlocal tested, comp
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not nothing:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize_keys(pairs, name)
        n = pairs.count()
        if n:
            tested = pairs if tested is nothing else tested.unionByName(pairs)
            found = materialize_keys(verify(pairs), "links")
            comp = components(found.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        return n

    def placed() -> DataFrame:
        """members with their components c"""
        c = comp.select(F.col("node").alias("k"), F.col("component").alias("c"))
        return members.join(c, "k", "left").select("h", "k", "lo", F.coalesce("c", "k").alias("c"))

    test(members.groupBy("k").agg(F.min("lo").alias("lo")).where("k <> lo").select(F.col("k").alias("a"), F.col("lo").alias("b")), "pairs")
    at = placed()
    centre = at.where("k = lo").select("h", F.col("c").alias("lo_c"))
    test(at.where("k <> lo").join(centre, "h").where("c <> lo_c").select(F.col("k").alias("a"), F.col("lo").alias("b")).distinct(), "pairs")
    links = _block_links(placed(), texts, shingle, percent)
    comp = components(links.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    c = comp.select(F.col("node").alias("k"), F.col("component").alias("c"))
    rows = words.spread_join(signed.select("d", "r", "n", "k", F.xxhash64("t").alias("key")), c, ["k"]).withColumn("c", F.coalesce("c", "k"))
    lone = rows.where("k is null").select(F.col("d").alias(doc_id), "key", F.col("n").alias("n_shingles"), F.col("d").alias("component_id"), F.lit(True).alias("kept"), F.lit(True).alias("first"))
    best = rows.where("k is not null").groupBy("c").agg(F.min("d").alias("component_id"), F.min(F.struct(F.col("d").isNull().alias("x"), "d", "r")).alias("best"))
    grouped = words.spread_join(rows.where("k is not null"), best, ["c"], "inner")
    grouped = grouped.select(F.col("d").alias(doc_id), "key", F.col("n").alias("n_shingles"), "component_id", F.col("d").eqNullSafe(F.col("component_id")).alias("kept"), (F.col("r") == F.col("best.r")).alias("first"))
    return grouped.unionByName(lone)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of docs for each group of near-duplicates, all columns kept. Rows without words all stay, once for each
    (doc_id, text)."""
    d, k, t = (words.unused(docs, x) for x in ("near_d", "near_k", "near_t"))
    keep = near_groups(docs, doc_id, text, **options).where("first").select(F.col(doc_id).alias(d), F.col("key").alias(k)).distinct()
    marked = docs.withColumn(t, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(d)) & (F.col(t) == F.col(k))
    return marked.join(keep, same, "left_semi").dropDuplicates([doc_id, t]).drop(t)


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate group on 2-word shingles."""
    out = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=2)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = None


def brute_force(docs: list[tuple], shingle: int = 2, percent: int = PERCENT) -> list[tuple]:
    """All pairs of exact sets, for tests: (doc_id, n_shingles, component_id, kept); ids are distinct."""
    import re

    sets = {}
    for d, t in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[d] = {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()
    holders: dict[tuple, list] = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        shared: dict[int, int] = {}
        for g in s:
            for o in holders[g]:
                if o < d:
                    shared[o] = shared.get(o, 0) + 1
        for o, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = root(d), root(o)
                parent[max(a, b)] = min(a, b)
    return [(d, len(s), root(d), root(d) == d) for d, s in sets.items()]
