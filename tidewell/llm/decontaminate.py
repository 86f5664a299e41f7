"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` cuts the documents into segments of bounded size and stores for each segment the postings of every
token: terms sorted by their 64-bit hash, and for each term its sorted positions. A segment is one row of a Parquet
table, so searching needs no shuffle: each task answers a block of phrases on its segments. A phrase's terms are ordered
by the lengths of their lists in the segment; the rarest list, shifted by the term's offset, gives the candidate starts,
and the other lists, shifted alike, are intersected with it one after another. ``search`` returns exact phrase matches and,
with a slop, proximity matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words
from tidewell.session import materialize

WINDOW = 10
#: Phrases are sent to the tasks in blocks of at most so many words, however many there are.
BLOCK_WORDS = 1_000_000
#: Documents lie this far apart in a segment's positions, so that no phrase or slop reaches across.
GAP = 64
#: Positions of rarest words that are tried at once.
CANDIDATES = 4_000_000
SEGMENT_BYTES = 4 << 20
FILE_SEGMENTS = 8

INDEX_SCHEMA = "segment string, doc_ids array<bigint>, n_words array<bigint>, bases binary, terms binary, lists binary, positions binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId(), 0
    for batch in batches:
        for piece in words.slices(batch, "t", SEGMENT_BYTES):
            w = words.split(piece.column("t"), "alnum_lower")
            bases = np.concatenate([[0], np.cumsum(w.counts + GAP)])[:-1].astype(np.int64)
            at = bases[w.doc] + (np.arange(len(w.h)) - w.first[w.doc])
            order = np.argsort(w.h, kind="stable")
            h = w.h[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{part}-{k}"]),
                    pa.array([piece.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([w.counts.tolist()], pa.list_(pa.int64())),
                    pa.array([bases.tobytes()], pa.binary()),
                    pa.array([h[new].tobytes()], pa.binary()),
                    pa.array([np.append(new, len(h)).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([at[order].astype(np.int32).tobytes()], pa.binary()),
                ],
                names=["segment", "doc_ids", "n_words", "bases", "terms", "lists", "positions"],
            )
            k += 1


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Positional postings of every token of docs, a row per segment, written to the shared folder.

    Words are runs of digits, letters and non-ASCII bytes, A-Z as a-z. Null texts have no words.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    # few segments a file, as a reader holds a whole batch of rows at once
    return materialize(rows.mapInArrow(_segments, INDEX_SCHEMA), "postings", maxRecordsPerFile=FILE_SEGMENTS)


class Segment:
    """One segment's postings, ready to be intersected."""

    def __init__(self, row: dict):
        self.bases = np.frombuffer(row["bases"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.lists = np.frombuffer(row["lists"], np.int32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        self.span = int(self.bases[-1]) + (1 << 31) if len(self.bases) else 1

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each term among the segment's (-1: absent), and the length of its list."""
        if not len(self.terms):
            return np.full(terms.shape, -1), np.zeros(terms.shape, np.int64)
        i = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        there = self.terms[i] == terms
        return np.where(there, i, -1), np.where(there, self.lists[i + 1] - self.lists[i], 0)

    def keys(self, used: np.ndarray) -> np.ndarray:
        """The lists of the used terms as one sorted array of (term, position)."""
        n = self.lists[used + 1] - self.lists[used]
        to = np.cumsum(n)
        take = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(self.lists[used] - (to - n), n)
        return np.repeat(used, n) * self.span + self.positions[take]

    def starts(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of the terms all its positions: index into term, position."""
        n = self.lists[term + 1] - self.lists[term]
        to = np.cumsum(n)
        take = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(self.lists[term] - (to - n), n)
        return np.repeat(np.arange(len(term)), n), self.positions[take]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, at, side="right") - 1


def phrase_matches(seg: Segment, phrases: np.ndarray, size: np.ndarray, slop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of each match. phrases: a row of term hashes each, of which the first size[i] count.

    slop None: the words in order, side by side. Otherwise, for each position of the rarest word, a match if every
    other word lies within slop words of it, in any order; start is then the rarest word's position.
    """
    none = np.zeros(0, np.int64)
    inside = np.arange(phrases.shape[1])[None, :] < size[:, None]
    term, n = seg.find(phrases)
    alive = np.flatnonzero(((term >= 0) | ~inside).all(axis=1) & (size > 0))
    if not len(alive):
        return none, none
    term, inside = term[alive], inside[alive]
    n = np.where(inside, n[alive], np.iinfo(np.int64).max)
    order = np.argsort(n, axis=1, kind="stable")  # rarest first; what is no word comes last
    keys = seg.keys(np.unique(term[inside]))
    rows = np.arange(len(alive))
    # phrases in chunks whose rarest words have so many positions together; one word has at most those of the segment
    chunk = np.cumsum(n[rows, order[:, 0]]) // CANDIDATES
    found = []
    for c in np.split(rows, np.flatnonzero(np.diff(chunk)) + 1):
        which, start = _chunk_matches(seg, term[c], inside[c], order[c], keys, slop)
        found.append((alive[c[which]], start))
    return np.concatenate([w for w, _ in found]), np.concatenate([x for _, x in found])


def _chunk_matches(seg: Segment, term: np.ndarray, inside: np.ndarray, order: np.ndarray, keys: np.ndarray, slop: int | None) -> tuple[np.ndarray, np.ndarray]:
    which, at = seg.starts(term[np.arange(len(term)), order[:, 0]])
    start = at - order[which, 0] if slop is None else at
    for r in range(1, term.shape[1]):
        if not len(which):
            break
        offset = order[which, r]
        counts = inside[which, offset]
        base = term[which, offset] * seg.span
        wanted = base + start + (offset if slop is None else -slop)
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[i] == wanted if slop is None else (keys[i] >= wanted) & (keys[i] <= base + start + slop)
        keep = found | ~counts
        which, start = which[keep], start[keep]
    return which, start


def search(index: DataFrame, phrases: list[list[str]], slop: int | None = None) -> DataFrame:
    """Matches (phrase, doc_id, position) of phrases given as lists of lower-case words. See phrase_matches for slop."""
    hashed = [words.split(pa.array([" ".join(p)]), "alnum_lower").h for p in phrases]
    size = np.array([len(h) for h in hashed], np.int64)
    table = np.zeros((len(hashed), max([1, *size])), np.uint64)
    for i, h in enumerate(hashed):
        table[i, : len(h)] = h
    if slop is not None and slop >= GAP:
        raise ValueError(f"slop must be under {GAP}")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                seg = Segment(row)
                which, start = phrase_matches(seg, table, size, slop)
                doc = seg.doc_of(start)
                ids = np.array([-1 if x is None else x for x in row["doc_ids"]], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(ids[doc] if len(doc) else doc), pa.array(start - seg.bases[doc] if len(doc) else start)], names=["phrase", "doc_id", "position"])

    return index.mapInArrow(run, "phrase long, doc_id long, position long")


def _item_windows(texts: list[str], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows of each item: rows of hashes, sizes, item index."""
    w = words.split(pa.array(texts, pa.string()), "alnum_lower")
    first, found = w.first, {}
    for i, n in enumerate(w.counts):
        h = w.h[first[i] : first[i] + n]
        for j in range(max(1, n - window + 1) if n else 0):
            found[(i, h[j : j + window].tobytes())] = None
    table, size, item = np.zeros((len(found), window), np.uint64), np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    for r, (i, raw) in enumerate(found):
        h = np.frombuffer(raw, np.uint64)
        table[r, : len(h)], size[r], item[r] = h, len(h), i
    return table, size, item


def _hits(index: DataFrame, ids: list[str], texts: list[str], window: int) -> DataFrame:
    """(segment, doc, hit word positions, items with occurring windows) of the documents that a block of items touches."""
    table, size, item = _item_windows(texts, window)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                seg = Segment(row)
                which, start = phrase_matches(seg, table, size)
                doc = seg.doc_of(start)
                order = np.argsort(doc, kind="stable")
                which, start, doc = which[order], start[order], doc[order]
                cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else []
                out = []
                for a, b in zip(cut, [*cut[1:], len(doc)], strict=True) if len(doc) else []:
                    mark = np.zeros(row["n_words"][doc[a]] + 1, np.int64)
                    s = start[a:b] - seg.bases[doc[a]]
                    np.add.at(mark, s, 1)
                    np.add.at(mark, s + size[which[a:b]], -1)
                    out.append((int(doc[a]), np.flatnonzero(np.cumsum(mark) > 0).tolist(), sorted({ids[i] for i in np.unique(item[which[a:b]])})))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * len(out), pa.string()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.list_(pa.int32())), pa.array([x[2] for x in out], pa.list_(pa.string()))],
                    names=["segment", "doc", "hit", "items"],
                )

    return index.mapInArrow(run, "segment string, doc int, hit array<int>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_hit, n_items, items (sorted array), contaminated.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A document
    word in any occurrence of a window is hit. Null and empty texts have no words; null item ids count as "". Repeated
    rows are judged each on its own and alike; other columns are not read. Empty tables give no rows, and no hits.
    Items are read to the driver in blocks of bounded size, sorted by id, and each block is searched on all segments.
    """
    index = build_index(docs, doc_id, text)
    per = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("doc", "d")).select("segment", "doc", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("t")).orderBy("item", "t")
    found, ids, texts, n = [], [], [], 0
    for r in items.toLocalIterator():
        ids.append(r["item"])
        texts.append(r["t"])
        n += len(r["t"]) // 2 + 1
        if n >= BLOCK_WORDS:
            found.append(_hits(index, ids, texts, window))
            ids, texts, n = [], [], 0
    if ids or not found:
        found.append(_hits(index, ids, texts, window))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = hits.groupBy("segment", "doc").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    out = per.join(hits, ["segment", "doc"], "left")
    items_col = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_col).cast("long").alias("n_items"), items_col.alias("items"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of docs that hold no window of the benchmark, all columns kept. Rows of a null doc_id are judged together."""
    own = words.unused(docs, "bad")
    bad = contamination(docs, benchmark, doc_id, text, window=window).where("contaminated").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(bad, F.col(doc_id).cast("long").eqNullSafe(F.col(own)), "left_anti")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE_SQL = None


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The contract read word by word, for tests: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    import re

    def toks(t: str | None) -> list[str]:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    grams: dict[tuple, set] = {}
    for item, text in items:
        w = toks(text)
        for j in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[j : j + window]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, seen = toks(text), set(), set()
        for size in sizes:
            for j in range(len(w) - size + 1):
                if (g := tuple(w[j : j + size])) in grams:
                    hit |= set(range(j, j + size))
                    seen |= grams[g]
        out.append((doc, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return out
