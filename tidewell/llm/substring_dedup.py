"""Removal of passages that recur across documents, with sharded Aho-Corasick automata.

A window is ``window`` consecutive words. Equal windows share their minimizer, the least hash of their runs of MINI words,
so neighbouring windows travel together to the shard of their minimizer as one short piece of text. In a shard, windows
found in two documents or more are confirmed; an automaton is compiled of them and run over the shard's pieces to locate
every occurrence, and each pattern's occurrences outside its smallest document are marked. The marks go back to the
documents, and each word under a marked window is removed. The automaton reads runs of a few words, a window being SYMBOLS
of them that overlap or touch, each given as two digits: so it has fewer states than single words would take, and no state
has many successors, which an automaton looks through one by one.

There are as many shards as the texts' bytes ask for, so a shard fits a task at any size of the input.

Hot passages: a slice of documents decides by itself the windows that also start in a smaller document of the slice, and
ships only the first occurrence. Windows around a hot passage would still share its minimizer; minimizers that are hot in
a sample are dealt by window instead, and a task remembers the smallest document of each such window over all its slices,
so a hot passage comes to its shard about once a task, however often it occurs. The sample only decides where windows go,
never what is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words

WINDOW = 13
MINI = 3
HOT_SHARE = 0.002
HOT_SAMPLE_ROWS = 4000
#: Bytes of text for each shard.
SHARD_BYTES = 3 << 20
SYMBOLS = 3
CHUNK_WORDS = 200_000
NULL_ID = np.iinfo(np.int64).max
_U = np.uint64


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbours, by doubling."""
    done, m = 1, x
    while done * 2 <= size:
        m, done = np.minimum(m[:-done], m[done:]), done * 2
    return np.minimum(m[: len(m) - (size - done)], m[size - done :]) if done < size else m


def _windows(w: words.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows within one document, their hashes, their minimizers."""
    if len(w.h) < window:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U)
    h, least = words.windows(w.h, window), _sliding_min(words.windows(w.h, min(MINI, window)), window - min(MINI, window) + 1)
    at = np.flatnonzero(w.doc[: len(h)] == w.doc[window - 1 :])
    return at, h[at], least[at]


def _hot_minimizers(docs: DataFrame, rows: int, window: int) -> np.ndarray:
    """Minimizers of over HOT_SHARE of a bounded sample's windows: at most 1 / HOT_SHARE of them."""

    def count(batches):
        for batch in batches:
            for piece in words.slices(batch, "t"):
                _, _, least = _windows(words.split(piece.column("t"), "white"), window)
                value, n = np.unique(least, return_counts=True)
                keep = n > max(1, HOT_SHARE / 20 * n.sum())
                total = np.zeros(1, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(value[keep].view(np.int64), total)), pa.array(np.append(n[keep], n.sum()))], names=["m", "n"])

    sample = docs.select("t").sample(min(1.0, HOT_SAMPLE_ROWS / max(rows, 1)), seed=1)
    counts = sample.mapInArrow(count, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("m") == 0, F.col("n")))
    of = counts.agg(total).first()[0] or 0
    found = counts.where((F.col("m") != 0) & (F.col("n") > HOT_SHARE * of)).select("m").collect()
    return np.sort(np.array([r["m"] for r in found], np.int64).view(_U))


PIECES = "shard int, doc binary, key binary, word binary, n binary, text binary, size long, runs binary"


def _ship(docs: DataFrame, window: int, shards: int, hot: np.ndarray) -> DataFrame:
    """Rows of packed pieces by shard (shard >= 0), and of windows already decided in their slice (shard -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        seen, seen_id = np.zeros(0, _U), np.zeros(0, np.int64)  # hot windows of earlier slices and their smallest documents
        for batch in batches:
            for piece in words.slices(batch, "t", 3 * words.SLICE_BYTES):
                w = words.split(piece.column("t"), "white")
                ids = np.array(piece.column("id"), np.int64)
                keys = np.array(piece.column("key"), np.int64)
                first = w.first
                at, h, least = _windows(w, window)
                if not len(at):
                    continue
                # the smallest document of each window hash in this slice; the others are decided
                owner = ids[w.doc[at]]
                order = np.argsort(h)
                hs = h[order]
                cut = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
                least_id = np.empty(len(at), np.int64)
                least_id[order] = np.repeat(np.minimum.reduceat(owner[order], cut), np.diff(np.append(cut, len(at))))
                gone = owner > least_id
                split = np.isin(least, hot) if len(hot) else np.zeros(len(at), bool)
                if split.any():
                    if len(seen):
                        i = np.minimum(np.searchsorted(seen, h[split]), len(seen) - 1)
                        gone[split] |= (seen[i] == h[split]) & (owner[split] > seen_id[i])
                    both, both_id = np.concatenate([seen, h[split]]), np.concatenate([seen_id, least_id[split]])
                    by = np.lexsort((both_id, both))
                    new = np.concatenate([[True], both[by][1:] != both[by][:-1]])
                    seen, seen_id = both[by][new], both_id[by][new]
                del order, hs, least_id
                out = []
                if gone.any():
                    a, n = _runs(at[gone], w.doc[at[gone]])
                    d = w.doc[a]
                    out.append((-1, ids[d], keys[d], a - first[d], n, b"", 0))
                keep = ~gone
                at, h, least, split = at[keep], h[keep], least[keep], split[keep]
                route = words.mix(least)
                route[split] = h[split]
                shard = (route % _U(shards)).astype(np.int64)
                # runs of neighbouring windows that go the same way
                cut = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (route[1:] != route[:-1]) | (w.doc[at[1:]] != w.doc[at[:-1]])]) if len(at) else np.zeros(0, bool)
                a = np.flatnonzero(cut)
                n = np.diff(np.append(a, len(at)))
                start, sh = at[a], shard[a]
                by = np.argsort(sh, kind="stable")
                start, n, sh = start[by], n[by], sh[by]
                lo, hi = w.start[start], w.end[start + n + window - 2]
                edges = np.flatnonzero(np.concatenate([[True], sh[1:] != sh[:-1]])) if len(sh) else []
                for b, e in zip(edges, [*edges[1:], len(sh)], strict=True) if len(sh) else []:
                    size = hi[b:e] - lo[b:e] + 1  # with a separator
                    to = np.cumsum(size)
                    take = np.arange(int(to[-1])) + np.repeat(lo[b:e] - (to - size), size)
                    raw = w.data[np.minimum(take, len(w.data) - 1)].copy()
                    raw[to - 1] = 10
                    d = w.doc[start[b:e]]
                    out.append((int(sh[b]), ids[d], keys[d], start[b:e] - first[d], n[b:e], pack(raw.tobytes()), len(raw)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in out], pa.int32()),
                        pa.array([pack(x[1].tobytes()) for x in out], pa.binary()),
                        pa.array([pack(x[2].tobytes()) for x in out], pa.binary()),
                        pa.array([pack(x[3].astype(np.int32).tobytes()) for x in out], pa.binary()),
                        pa.array([pack(x[4].astype(np.int32).tobytes()) for x in out], pa.binary()),
                        pa.array([x[5] for x in out], pa.binary()),
                        pa.array([x[6] for x in out], pa.int64()),
                        pa.array([b""] * len(out), pa.binary()),
                    ],
                    names=["shard", "doc", "key", "word", "n", "text", "size", "runs"],
                )

    return docs.mapInArrow(run, PIECES)


def _runs(at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of neighbouring windows of one document: first window, number. at is sorted."""
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])]))
    return at[cut], np.diff(np.append(cut, len(at)))


def _rows(doc: np.ndarray, key: np.ndarray, word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row for each document: its runs of removed windows as packed (first word, number) pairs."""
    order = np.lexsort((word, key, doc))
    doc, key, word, n = doc[order], key[order], word[order], n[order]
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.zeros(0, np.int64)
    pairs = np.stack([word, n], axis=1).astype(np.int32)
    ends = np.append(cut[1:], len(doc))
    return pa.RecordBatch.from_arrays([pa.array(doc[cut]), pa.array(key[cut]), pa.array([pairs[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary())], names=["id", "key", "runs"])


def _locate(rows: pa.Table, window: int) -> Iterator[pa.RecordBatch]:
    """Confirms a shard's recurring windows, and finds all their occurrences with an automaton."""
    import ahocorasick
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress

    def column(name: str, kind) -> list[np.ndarray]:
        return [np.frombuffer(unpack(x.as_py()), kind) for x in rows.column(name)]

    doc, key = np.concatenate(column("doc", np.int64)), np.concatenate(column("key", np.int64))
    word, n = np.concatenate(column("word", np.int32)).astype(np.int64), np.concatenate(column("n", np.int32)).astype(np.int64)
    texts = b"".join(unpack(x.as_py(), max_output_size=s.as_py()) for x, s in zip(rows.column("text"), rows.column("size"), strict=True))
    w = words.split(pa.array([texts], pa.large_binary()), "white")
    del texts
    span = n + window - 1
    base = np.cumsum(span) - span  # first word of each piece
    # all windows of all pieces
    piece = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(piece)) + np.repeat(base - (np.cumsum(n) - n), n)
    h = words.windows(w.h, window)[at]
    owner = doc[piece]
    order = np.argsort(h)
    hs, ow = h[order], owner[order]
    cut = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
    times = np.diff(np.append(cut, len(hs)))
    low, high = np.minimum.reduceat(ow, cut), np.maximum.reduceat(ow, cut)
    twice = low != high
    patterns, least = order[cut[twice]], low[twice]  # a place of each confirmed window, and its smallest document
    if not len(patterns):
        return
    # only pieces with a confirmed window are run through the automaton
    busy = np.zeros(len(n), bool)
    busy[piece[order[np.repeat(twice, times)]]] = True
    del hs, ow, order, times, h, owner
    parts = min(SYMBOLS, window)
    stride = max(1, (window - 1) // SYMBOLS)
    gram = window - stride * (parts - 1)  # words of a symbol, at least stride
    grams = words.windows(w.h, gram)
    used = np.repeat(busy, span)[: len(grams)]
    symbol = np.zeros(len(grams), np.int64)  # 0 parts sequences
    symbol[used] = np.unique(grams[used], return_inverse=True)[1] + 1
    del grams, used
    digit = int(np.sqrt(symbol.max())) + 1

    def digits(x: np.ndarray) -> np.ndarray:
        """Each symbol as two digits of different ranges; 0 stays 0, 0."""
        return np.where(x[..., None] > 0, np.stack([1 + x // digit, digit + 2 + x % digit], axis=-1), 0).reshape(*x.shape[:-1], -1)

    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, key_of in enumerate(digits(symbol[at[patterns][:, None] + stride * np.arange(parts)]).tolist()):
        automaton.add_word(tuple(key_of), k)
    automaton.make_automaton()
    fp, fa, fk = [], [], []
    some = np.flatnonzero(busy)
    for ps in np.split(some, np.flatnonzero(np.diff(np.cumsum(span[some]) // CHUNK_WORDS)) + 1):
        # each piece as one sequence of symbols for each phase of the stride
        size = span[ps] - gram + 1
        of = np.repeat(np.arange(len(ps)), size)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        lengths = (size[:, None] - np.arange(stride) + stride - 1) // stride + 1
        starts = (np.cumsum(lengths.ravel()) - lengths.ravel()).reshape(lengths.shape)
        place = starts[of, offset % stride] + offset // stride
        sequence, word_at = np.zeros(int(lengths.sum()), np.int64), np.zeros(int(lengths.sum()), np.int64)
        word_at[place] = base[ps][of] + offset
        sequence[place] = symbol[word_at[place]]
        found = np.array(list(automaton.iter(tuple(digits(sequence).tolist()))), np.int64).reshape(-1, 2)
        first = word_at[found[:, 0] // 2] - stride * (parts - 1)
        p = np.searchsorted(base, first, side="right") - 1
        fp.append(p)
        fa.append(first - base[p])
        fk.append(found[:, 1])
    fp, fa, fk = np.concatenate(fp), np.concatenate(fa), np.concatenate(fk)
    by = np.lexsort((fa, fp))
    fp, fa, fk = fp[by], fa[by], fk[by]
    removed = doc[fp] > least[fk]
    fp, fa = fp[removed], fa[removed]
    if len(fp):
        flat = fp * (int(span.max()) + 2) + fa
        a, m = _runs(flat, fp)
        p = a // (int(span.max()) + 2)
        yield _rows(doc[p], key[p], word[p] + a % (int(span.max()) + 2), m)


def removed_runs(docs: DataFrame, window: int = WINDOW, shards: int | None = None) -> DataFrame:
    """(id, key, runs) of the documents that lose words; docs has id, key and t."""
    size = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("bytes")).first()
    shards = shards or size["bytes"] // SHARD_BYTES + 1
    shipped = _ship(docs, window, shards, _hot_minimizers(docs, size["rows"], window))

    # rows decided in their slice are spread over all tasks, beside the shards
    dealt = shipped.withColumn("deal", F.when(F.col("shard") >= 0, F.col("shard")).otherwise(-1 - F.pmod(F.hash("doc"), F.lit(shards))))

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("runs", pa.binary())])
        out = []
        if table.column("deal")[0].as_py() < 0:
            unpack = zstandard.ZstdDecompressor().decompress
            for r in table.to_batches():
                for x in r.to_pylist():
                    out.append(_rows(*(np.frombuffer(unpack(x[c]), k) for c, k in (("doc", np.int64), ("key", np.int64), ("word", np.int32), ("n", np.int32)))))
        else:
            out = list(_locate(table, window))
        return pa.Table.from_batches([b.cast(schema) for b in out], schema)

    marks = dealt.groupBy("deal").applyInArrow(run, "id long, key long, runs binary")
    return marks.groupBy("id", "key").agg(F.collect_list("runs").alias("runs"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed for their way to their marks."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        z = [pack(t.encode()) for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("d", "id", "key")), pa.array(z, pa.binary())], names=["d", "id", "key", "z"])


def _kept(window: int, digest: bool):
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                t = pa.array([unpack(z) for z in batch.column("z").to_pylist()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("d"), t, batch.column("runs")], names=["d", "t", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            for piece in words.slices(batch, "t"):
                w = words.split(piece.column("t"), "white")
                first = w.first
                mark = np.zeros(len(w.h) + 1, np.int64)
                for i, runs in enumerate(piece.column("runs").to_pylist()):
                    for raw in runs or ():
                        pairs = np.frombuffer(raw, np.int32).reshape(-1, 2).astype(np.int64)
                        np.add.at(mark, first[i] + pairs[:, 0], 1)
                        np.add.at(mark, first[i] + pairs[:, 0] + pairs[:, 1] + window - 1, -1)
                keep = np.cumsum(mark[:-1]) == 0
                kept = np.flatnonzero(keep)
                # the kept words and one space after each
                size = w.end[kept] - w.start[kept] + 1
                to = np.cumsum(size)
                take = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(w.start[kept] - (to - size), size)
                raw = w.data[np.minimum(take, max(len(w.data) - 1, 0))].copy()
                raw[to - 1] = 32
                ends = np.concatenate([[0], to])
                by = np.searchsorted(kept, first)
                texts = [raw[ends[by[i]] : max(ends[by[i]], ends[by[i + 1]] - 1)].tobytes() for i in range(piece.num_rows)]
                n = pa.array(w.counts.astype(np.int64))
                gone = pa.array((w.counts - np.diff(by)).astype(np.int64))
                last = pa.array([hashlib.sha256(t).hexdigest() for t in texts]) if digest else pa.array([t.decode() for t in texts])
                yield pa.RecordBatch.from_arrays([piece.column("d"), n, gone, last], names=["d", "n_words", "n_removed", "kept"])

    return run


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, digest: bool = False) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_removed, kept (the kept words joined by one space, or their SHA-256).

    A word is removed if a window over it also starts in a document of a smaller id. Null and empty texts have no words.
    A null id is larger than all others. Rows of one id and text are one document and get equal results; texts that share
    an id don't remove from each other (64 bits of hash tell them apart). An empty table gives no rows; other columns are not read.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = base.select("d", F.coalesce("d", F.lit(int(NULL_ID))).alias("id"), F.xxhash64("t").alias("key"), "t")
    marks = removed_runs(base.select("id", "key", "t"), window)
    both = base.mapInArrow(_packed, "d long, id long, key long, z binary").join(marks, ["id", "key"], "left").select("d", "z", "runs")
    return both.mapInArrow(_kept(window, digest), "d long, n_words long, n_removed long, kept string").withColumnRenamed("d", doc_id)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the digest of its words outside recurring passages."""
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLE_SQL = None


def brute_force(docs: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The contract read window by window, for tests: (doc_id, n_words, n_removed, kept_sha256)."""
    import re

    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    least: dict[tuple, int] = {}
    for d, w in split:
        for j in range(len(w) - window + 1):
            g = tuple(w[j : j + window])
            least[g] = min(least.get(g, NULL_ID), NULL_ID if d is None else d)
    out = []
    for d, w in split:
        gone = set()
        for j in range(len(w) - window + 1):
            if least[tuple(w[j : j + window])] < (NULL_ID if d is None else d):
                gone |= set(range(j, j + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
