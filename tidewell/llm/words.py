"""Words of whole texts as arrays: where they lie and a 64-bit hash of each, over Arrow batches in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20
SLICE_DOCS = 4096
HASH_BYTES = 1 << 18
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, HASH_BYTES * 2)
        for i, base in enumerate((int(_STEP), pow(int(_STEP), -1, 1 << 64))):
            full = np.full(size, base, _U)
            full[0] = 1
            _powers[i] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


@cache
def alphabet(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: whether it belongs to a word, and its random 64-bit value.

    "white": words are what lies between white space 09-0D, 20. "white_lower": the same, A-Z equal to a-z.
    "alnum_lower": words are of digits, letters and bytes from 80 on, A-Z equal to a-z.
    """
    value = mix(np.arange(1, 257, dtype=_U) * _STEP) | _U(1)
    byte = np.arange(256)
    if kind.endswith("_lower"):
        value[65:91] = value[97:123]
    if kind.startswith("white"):
        word = ~((byte == 32) | ((byte >= 9) & (byte <= 13)))
    else:
        word = (byte >= 128) | ((byte >= 48) & (byte <= 57)) | ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
    return word, value


@dataclass
class Words:
    """Words of a slice of texts: data holds the texts' bytes; doc, start, end and h have an item for each word."""

    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    h: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word, and at the end the number of words."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n+1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if off is not None and len(texts) else np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, kind: str) -> Words:
    data, offsets = buffers(texts)
    word, value = alphabet(kind)
    n = len(data)
    inside = np.zeros(n + 1, bool)
    np.take(word, data, out=inside[:n])
    opens = inside[:n].copy()
    opens[1:] &= ~inside[: n - 1] if n else opens[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts < n)]
    opens[cuts] = inside[cuts]
    start = np.flatnonzero(opens)
    closes = inside[:n] & ~inside[1:]
    last = cuts[cuts > 0] - 1
    closes[last] = inside[last]
    end = np.flatnonzero(closes) + 1
    h = np.empty(len(start), _U)
    i = 0
    while i < len(start):  # block by block, as this needs many bytes for each byte of text
        j = max(i + 1, int(np.searchsorted(start, start[i] + HASH_BYTES)))
        lo, hi = start[i], end[j - 1]
        up, down = powers(int(hi - lo) + 1)
        sums = np.zeros(int(hi - lo) + 1, _U)
        np.cumsum(value[data[lo:hi]] * up[:-1], out=sums[1:])
        h[i:j] = (sums[end[i:j] - lo] - sums[start[i:j] - lo]) * down[start[i:j] - lo]
        i = j
    h = mix(h)
    counts = np.searchsorted(start, offsets[1:]) - np.searchsorted(start, offsets[:-1])
    return Words(data, offsets, np.repeat(np.arange(len(counts), dtype=np.int32), counts), start, end, h, counts)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of size neighbouring items (also across texts: callers drop those)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, down = powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, _U)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:n] + _U(size))


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Parts that spread_join deals the rows of one key to.
SALTS = 8


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """left joined with right, which has one small row for each key, where many rows of left may share a key: those are
    dealt to SALTS parts, to each of which right's row comes."""
    salt = unused(left, "salt")
    dealt = left.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [*on, salt], how).drop(salt)


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES, max_docs: int = SLICE_DOCS) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most max_bytes of text; a longer text is a piece of its own."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), at + max_docs, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def per_doc_unique(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, h) pairs of a slice, sorted. 52 bits of h are kept beside 12 of doc (SLICE_DOCS of them)."""
    key = (doc.astype(_U) << _U(52)) | (h >> _U(12))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return (key >> _U(52)).astype(np.int64), key & _U((1 << 52) - 1)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, shingle) pairs; a text of fewer words, but not none, has one shingle of all of them."""
    hs = windows(words.h, size)
    n = len(hs)
    same = words.doc[:n] == words.doc[size - 1 : size - 1 + n] if n else np.zeros(0, bool)
    doc, h = words.doc[:n][same], hs[same]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        first = words.first
        whole = np.array([windows(words.h[first[i] : first[i + 1]], int(words.counts[i]))[0] for i in short], _U)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    return per_doc_unique(doc, h)
