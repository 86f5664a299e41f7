"""Media columns of progressive JPEG images.

``decode`` reads progressive JPEG streams: the scans of spectral selection and successive approximation are accumulated
into coefficient arrays, an integer inverse transform makes samples, chroma is upsampled, and full-resolution RGB tensors
come out. Entropy-coded data is sequential, so many independent stretches (restart intervals of many images) are decoded in
lockstep: each numpy step reads one symbol of every stretch. ``encode`` stores bytes losslessly as quantized coefficients.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words

BATCH_BYTES = 2 << 20
BATCH_DOCS = 1024
RESTART = 8
#: What decoding raises on bytes that are no such stream.
BROKEN = (ValueError, IndexError, KeyError, TypeError, struct.error)
CENTRE = 104  # bytes are stored as their distance from a letter's code, so that most coefficients are small


@cache
def zigzag() -> np.ndarray:
    """Raster index of each coefficient in zigzag order."""
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([y * 8 + x for y, x in cells])


@cache
def inverse() -> np.ndarray:
    """Row k: the samples (times 2**16, whole numbers) that coefficient k in zigzag order adds."""
    u, x = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    one = np.cos((2 * x + 1) * u * np.pi / 16) / 2 * np.where(u == 0, np.sqrt(0.5), 1)
    return np.rint(np.einsum("uy,vx->uvyx", one, one).reshape(64, 64)[zigzag()] * 65536)


def _samples(coefficients: np.ndarray) -> np.ndarray:
    """Blocks of samples 0..255. Whole numbers in float64 sums are exact, so equal blocks give equal samples in any batch."""
    sums = coefficients.astype(np.float64) @ inverse()
    return np.clip(np.floor(sums / 65536 + 0.5) + 128, 0, 255).astype(np.uint8)


# --- Huffman tables ---------------------------------------------------------------------------------------------------


def _dht(by_length: dict[int, list[int]]) -> bytes:
    return bytes(len(by_length.get(n, [])) for n in range(1, 17)) + bytes(s for n in range(1, 17) for s in by_length.get(n, []))


@cache
def own_tables() -> tuple[bytes, bytes]:
    """DC and AC tables of the encoder: short codes for coefficients without or with one zero before them."""
    rest = [r << 4 | s for r in range(16) for s in range(1, 11) if r > 1 or s > 8] + [r << 4 for r in range(1, 16)]
    return _dht({4: list(range(12))}), _dht({4: list(range(1, 9)), 5: [0], 6: [0x10 + s for s in range(1, 9)], 11: rest})


def _codes(table: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a table in its stored form."""
    out, code, at = [], 0, 16
    for n in range(1, 17):
        for _ in range(table[n - 1]):
            out.append((table[at], code, n))
            code, at = code + 1, at + 1
        code <<= 1
    return out


@cache
def _writer(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    code, size = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    for s, c, n in _codes(table):
        code[s], size[s] = c, n
    return code, size


@cache
def _reader(table: bytes) -> np.ndarray:
    """For each 16 bits ahead: length << 8 | symbol; length 0 where no code fits."""
    lut = np.zeros(1 << 16, np.int64)
    for s, c, n in _codes(table):
        lut[c << (16 - n) : (c + 1) << (16 - n)] = n << 8 | s
    return lut


# --- writing ------------------------------------------------------------------------------------------------------------


def _category(v: np.ndarray) -> np.ndarray:
    """Number of bits of each magnitude (under 2**15)."""
    return np.frexp(np.abs(v).astype(np.float64))[1].astype(np.int64)


def _extra(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(v >= 0, v, v + (1 << s) - 1).astype(np.uint64)


def _stream(value: np.ndarray, size: np.ndarray, lane: np.ndarray, lanes_of: np.ndarray) -> list[bytes]:
    """Packs bit strings (value, size) into lanes that end on whole bytes. lanes_of: number of lanes of each image.

    Returns each image's entropy-coded data, with stuffed zeros and a restart marker between lanes.
    """
    n = int(lanes_of.sum())
    bits = np.bincount(lane, weights=size, minlength=n).astype(np.int64)
    length = (bits + 7) // 8
    base = np.cumsum(length) - length
    before = np.cumsum(size) - size
    first = np.searchsorted(lane, np.arange(n))
    at = before - before[first][lane] + 8 * base[lane]
    pad = 8 * length - bits
    at = np.concatenate([at, 8 * base + bits])
    value = np.concatenate([value, (np.uint64(1) << pad.astype(np.uint64)) - np.uint64(1)])
    size = np.concatenate([size, pad])
    total = int(length.sum())
    wide = value << (64 - (at & 31) - size).astype(np.uint64)
    wide[size == 0] = 0
    high = np.bincount(at >> 5, weights=(wide >> np.uint64(32)).astype(np.float64), minlength=total // 4 + 2)
    low = np.bincount((at >> 5) + 1, weights=(wide & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=total // 4 + 2)
    m = max(len(high), len(low))
    high, low = np.pad(high, (0, m - len(high))), np.pad(low, (0, m - len(low)))
    raw = np.frombuffer((high + low).astype(np.uint64).astype(">u4").tobytes(), np.uint8)[:total]
    full = raw == 255
    last = np.ones(n, bool)  # lanes followed by a marker
    last[np.cumsum(lanes_of) - 1] = False
    marks = np.cumsum(last) - last
    to = np.arange(total) + np.cumsum(full) - full + 2 * np.repeat(marks, length)
    out = np.zeros(total + int(full.sum()) + 2 * int(last.sum()), np.uint8)
    out[to] = raw
    ends = base + length - 1
    after = to[ends] + full[ends] + 1
    number = np.arange(n) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
    out[after[last]] = 255
    out[after[last] + 1] = 0xD0 + (number[last] & 7)
    stop = after[np.cumsum(lanes_of) - 1]
    starts = np.concatenate([[0], stop[:-1]])
    data = out.tobytes()
    return [data[a:b] for a, b in zip(starts.tolist(), stop.tolist(), strict=True)]


def _ac_first(c: np.ndarray, lane: np.ndarray, lanes_of: np.ndarray, first: int, last: int, low: int) -> list[bytes]:
    code, size = _writer(own_tables()[1])
    band = c[:, first : last + 1].astype(np.int64)
    v = np.where(band >= 0, band >> low, -(-band >> low))
    block, k = np.nonzero(v)
    v = v[block, k]
    same = np.concatenate([[False], block[1:] == block[:-1]])
    run = k - np.where(same, np.concatenate([[0], k[:-1]]), -1) - 1
    skip = run >> 4
    run &= 15
    ends = np.full(len(c), -1)
    ends[block] = k  # the last one stays
    eob = ends < last - first
    eob_before = np.cumsum(eob) - eob
    place = np.cumsum(1 + skip) - 1 + eob_before[block]
    per = np.bincount(block, weights=1 + skip, minlength=len(c)).astype(np.int64)
    n = int(per.sum() + eob.sum())
    values, sizes, lanes = np.full(n, code[0xF0]), np.full(n, size[0xF0]), np.repeat(lane, per + eob)
    s = _category(v)
    symbol = run << 4 | s
    values[place] = code[symbol] << s.astype(np.uint64) | _extra(v, s)
    sizes[place] = size[symbol] + s
    at = (np.cumsum(per + eob) - 1)[eob]
    values[at], sizes[at] = code[0], size[0]
    return _stream(values, sizes, lanes, lanes_of)


def _ac_refine(c: np.ndarray, lane: np.ndarray, lanes_of: np.ndarray, first: int, last: int) -> list[bytes]:
    """The lowest bit of coefficients sent without it. Bands of up to 16 coefficients."""
    code, size = _writer(own_tables()[1])
    width = last - first + 1
    values, sizes = np.zeros((len(c), width + 1), np.uint64), np.zeros((len(c), width + 1), np.int64)
    run, bits, number = np.zeros(len(c), np.int64), np.zeros(len(c), np.uint64), np.zeros(len(c), np.int64)
    for k in range(first, last + 1):
        v = c[:, k].astype(np.int64)
        known, fresh = np.abs(v) > 1, np.abs(v) == 1
        bits = np.where(known, bits << np.uint64(1) | (np.abs(v) & 1).astype(np.uint64), bits)
        number += known
        symbol = run << 4 | 1
        values[fresh, k - first] = ((code[symbol] << np.uint64(1) | (v > 0).astype(np.uint64)) << number.astype(np.uint64) | bits)[fresh]
        sizes[fresh, k - first] = (size[symbol] + 1 + number)[fresh]
        run = np.where(fresh, 0, run + ~known)
        bits, number = np.where(fresh, np.uint64(0), bits), np.where(fresh, 0, number)
    open_ = (run > 0) | (number > 0)
    values[open_, width] = (code[0] << number.astype(np.uint64) | bits)[open_]
    sizes[open_, width] = (size[0] + number)[open_]
    use = sizes > 0
    return _stream(values[use], sizes[use], np.repeat(lane, use.sum(axis=1)), lanes_of)


@cache
def _mcus(w: int, h: int) -> np.ndarray:
    """Blocks in the order of an interleaved 4:2:0 scan, where an image's blocks are all of Y, Cb, Cr in raster order."""
    r, c = np.meshgrid(np.arange(h), np.arange(w), indexing="ij")
    y = [(2 * r + dr) * 2 * w + 2 * c + dc for dr in (0, 1) for dc in (0, 1)]
    return np.stack([*y, 4 * w * h + r * w + c, 5 * w * h + r * w + c], axis=2).reshape(-1)


def grid(blocks: int) -> tuple[int, int]:
    """Width and height in 16x16 units of an image with room for so many blocks."""
    units = -(-blocks // 6)
    w = int(np.ceil(np.sqrt(units)))
    return w, -(-units // w)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _sos(components: list[int], first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(components)]) + b"".join(bytes([c, 0]) for c in components) + bytes([first, last, high << 4 | low]))


def encode(payloads: list[bytes]) -> list[bytes]:
    """A progressive JPEG of each payload (a positive multiple of 64 bytes): a block of coefficients for each 64 bytes."""
    sizes = [len(p) // 64 for p in payloads]
    shapes = [grid(n) for n in sizes]
    rooms = np.array([6 * w * h for w, h in shapes])
    base = np.cumsum(rooms) - rooms
    c = np.zeros((int(rooms.sum()), 64), np.int16)
    for p, b, n in zip(payloads, base.tolist(), sizes, strict=True):
        c[b : b + n] = ((np.frombuffer(p, np.uint8).astype(np.int16) - CENTRE + 128) % 256 - 128).reshape(n, 64)

    def lanes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lane of each unit, number of lanes of each image."""
        of = -(-units // RESTART)
        number = np.arange(int(units.sum())) - np.repeat(np.cumsum(units) - units, units)
        return number // RESTART + np.repeat(np.cumsum(of) - of, units), of

    units = rooms // 6
    order = np.concatenate([_mcus(w, h) + b for (w, h), b in zip(shapes, base.tolist(), strict=True)])
    lane, of = lanes(units)
    lane = np.repeat(lane, 6)
    dc = c[order, 0].astype(np.int64)
    # differences to the block before of the same component in the same lane
    part = np.tile([0, 0, 0, 0, 1, 2], len(order) // 6)
    diff = dc >> 1
    shifted = diff.copy()
    for p in range(3):
        own = np.flatnonzero(part == p)
        same = np.concatenate([[False], lane[own][1:] == lane[own][:-1]])
        diff[own] -= np.where(same, np.concatenate([[0], shifted[own][:-1]]), 0)
    code, size = _writer(own_tables()[0])
    s = _category(diff)
    scans = [(_sos([1, 2, 3], 0, 0, 0, 1), _stream(code[s] << s.astype(np.uint64) | _extra(diff, s), size[s] + s, lane, of))]
    last = (_sos([1, 2, 3], 0, 0, 1, 0), _stream((dc & 1).astype(np.uint64), np.ones(len(dc), np.int64), lane, of))
    luma = np.concatenate([np.arange(b, b + 4 * u) for b, u in zip(base.tolist(), units.tolist(), strict=True)])
    y, (y_lane, y_of) = c[luma], lanes(4 * units)
    scans.append((_sos([1], 1, 5, 0, 1), _ac_first(y, y_lane, y_of, 1, 5, 1)))
    scans.append((_sos([1], 6, 63, 0, 0), _ac_first(y, y_lane, y_of, 6, 63, 0)))
    c_lane, c_of = lanes(units)
    for i in (4, 5):
        own = np.concatenate([np.arange(b + i * u, b + (i + 1) * u) for b, u in zip(base.tolist(), units.tolist(), strict=True)])
        scans.append((_sos([i - 2], 1, 63, 0, 0), _ac_first(c[own], c_lane, c_of, 1, 63, 0)))
    scans += [(_sos([1], 1, 5, 1, 0), _ac_refine(y, y_lane, y_of, 1, 5)), last]
    head = b"\xff\xd8" + _segment(0xDB, b"\0" + b"\1" * 64)
    tables = b"".join(_segment(0xC4, bytes([k << 4]) + t) for k, t in enumerate(own_tables())) + _segment(0xDD, struct.pack(">H", RESTART))
    out = []
    for i, ((w, h), n) in enumerate(zip(shapes, sizes, strict=True)):
        frame = _segment(0xC2, struct.pack(">BHHB", 8, 16 * h, 16 * w, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        note = _segment(0xFE, b"blocks %d" % n)
        out.append(b"".join([head, note, frame, tables, *(x for sos, data in scans for x in (sos, data[i])), b"\xff\xd9"]))
    return out


# --- reading ------------------------------------------------------------------------------------------------------------


@dataclass
class Scan:
    components: tuple[int, ...]
    first: int
    last: int
    high: int
    low: int
    tables: tuple[bytes | None, ...]
    restart: int
    data: bytes


@dataclass
class Image:
    """A parsed stream: size, for each component its sampling and quantizers, its scans, and the number in its comment."""

    width: int = 0
    height: int = 0
    sampling: list[tuple[int, int]] = field(default_factory=list)
    quantizers: list[np.ndarray] = field(default_factory=list)
    scans: list[Scan] = field(default_factory=list)
    blocks: int | None = None

    def shape(self, i: int) -> tuple[int, int]:
        """Blocks across and down of component i, whole interleaved units."""
        hm, vm = max(h for h, _ in self.sampling), max(v for _, v in self.sampling)
        h, v = self.sampling[i]
        return -(-self.width // (8 * hm)) * h, -(-self.height // (8 * vm)) * v

    def order(self, components: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, int]:
        """Block numbers (within the image) in the order of a scan, their places in components, and blocks a unit."""
        starts = np.cumsum([0] + [self.shape(i)[0] * self.shape(i)[1] for i in range(len(self.sampling))])
        hm, vm = max(h for h, _ in self.sampling), max(v for _, v in self.sampling)
        if len(components) == 1:
            i = components[0]
            across = self.shape(i)[0]
            h, v = self.sampling[i]
            w, t = -(-self.width * h // (8 * hm)), -(-self.height * v // (8 * vm))
            blocks = (starts[i] + np.arange(t)[:, None] * across + np.arange(w)[None, :]).reshape(-1)
            return blocks, np.zeros(len(blocks), np.int64), 1
        r, c = np.meshgrid(np.arange(-(-self.height // (8 * vm))), np.arange(-(-self.width // (8 * hm))), indexing="ij")
        planes, places = [], []
        for place, i in enumerate(components):
            h, v = self.sampling[i]
            for dr in range(v):
                for dc in range(h):
                    planes.append(starts[i] + (v * r + dr) * self.shape(i)[0] + h * c + dc)
                    places.append(place)
        return np.stack(planes, axis=2).reshape(-1), np.tile(places, r.size), len(places)


_MARKER = re.compile(rb"\xff+[^\x00\xff\xd0-\xd7]")
_COUNT = re.compile(rb"blocks (\d+)")


def parse(stream: bytes) -> Image:
    """Reads the segments of a progressive JPEG. ValueError if it isn't one."""
    if stream[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    image, at, restart = Image(), 2, 0
    quant: dict[int, np.ndarray] = {}
    tables: dict[int, bytes] = {}
    ids: list[int] = []
    targets: list[int] = []
    while at + 4 <= len(stream):
        if stream[at] != 0xFF:
            raise ValueError("no marker")
        kind = stream[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        if kind == 0xD9:
            break
        n = struct.unpack(">H", stream[at + 2 : at + 4])[0]
        body, at = stream[at + 4 : at + 2 + n], at + 2 + n
        if kind == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[65 + 64 * wide :]
        elif kind == 0xC4:
            while body:
                size = 17 + sum(body[1:17])
                tables[body[0]] = body[1:size]
                body = body[size:]
        elif kind == 0xDD:
            restart = struct.unpack(">H", body[:2])[0]
        elif kind == 0xFE:
            m = _COUNT.fullmatch(body)
            image.blocks = int(m[1]) if m else None
        elif kind == 0xC2:
            _, image.height, image.width, n = struct.unpack(">BHHB", body[:6])
            for i in range(n):
                a, b, q = body[6 + 3 * i : 9 + 3 * i]
                ids.append(a)
                image.sampling.append((b >> 4, b & 15))
                targets.append(q)
        elif kind in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("no progressive JPEG")
        elif kind == 0xDA:
            n = body[0]
            comps = tuple(ids.index(body[1 + 2 * i]) for i in range(n))
            first, last, hl = body[1 + 2 * n : 4 + 2 * n]
            which = tuple(tables.get(body[2 + 2 * i] >> 4 if first == 0 else 0x10 | body[2 + 2 * i] & 15) for i in range(n))
            m = _MARKER.search(stream, at)
            end = m.start() if m else len(stream)
            image.scans.append(Scan(comps, first, last, hl >> 4, hl & 15, which, restart, stream[at:end]))
            at = end
    if not image.sampling or not image.width or not image.height:
        raise ValueError("no frame")
    image.quantizers = [quant[q] for q in targets]
    return image


class Bits:
    """Entropy-coded data of many images, without stuffing; peeks at any bit positions at once."""

    def __init__(self, data: list[bytes]):
        raw = np.frombuffer(b"".join(data) + b"\0\0", np.uint8)[:-2]
        sizes = np.array([len(d) for d in data])
        follows = np.concatenate([[False], raw[:-1] == 255]) if len(raw) else np.zeros(0, bool)
        stuffed = follows & (raw == 0)
        second = follows & (raw >= 0xD0) & (raw <= 0xD7)
        marker = second | np.concatenate([second[1:], [False]]) if len(raw) else second
        starts = np.cumsum(sizes) - sizes
        keep = ~(stuffed | marker)
        to = np.cumsum(keep) - keep
        begins = np.concatenate([starts, np.flatnonzero(second) + 1])
        begins.sort()
        padded = np.append(to, int(keep.sum()))
        self.lane = padded[begins] * 8  # first bit of each lane
        self.lanes_of = np.bincount(np.searchsorted(starts, begins, side="right") - 1, minlength=len(data))
        clean = np.concatenate([raw[keep], np.zeros(64, np.uint8)]).astype(np.uint32)
        self.word = clean[:-3] << np.uint32(24) | clean[1:-2] << np.uint32(16) | clean[2:-1] << np.uint32(8) | clean[3:]
        self.limit = int(keep.sum()) * 8 + 256

    def peek(self, p: np.ndarray) -> np.ndarray:
        """At least 25 bits from each position on, in the high bits of 32."""
        return self.word[p >> 3] << (p & 7).astype(np.uint32)

    def take(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        """n (at most 16) bits from each position p."""
        return ((self.peek(p) >> np.uint32(1)) >> (31 - n).astype(np.uint32)).astype(np.int64)


def _signed(bits: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << np.maximum(s - 1, 0)), bits - (1 << s) + 1, bits)


_SYMBOL = np.arange(256)
#: Bits after an AC symbol: the coefficient's, or the end-of-band run's.
_AFTER = np.where(_SYMBOL & 15 > 0, _SYMBOL & 15, np.where(_SYMBOL >> 4 < 15, _SYMBOL >> 4, 0))


def _read_dc(c: np.ndarray, order: np.ndarray, place: np.ndarray, bits: Bits, begin: np.ndarray, end: np.ndarray, scan: Scan) -> None:
    if scan.high:
        lane = np.repeat(np.arange(len(begin)), end - begin)
        at = np.arange(len(order)) - begin[lane] + bits.lane[lane]
        c[order, 0] |= (bits.take(at, np.ones(len(at), np.int64)) << scan.low).astype(c.dtype)
        return
    luts = np.stack([_reader(t) for t in scan.tables])
    p, u, stop = bits.lane.copy(), begin.copy(), end
    before = np.zeros((len(begin), len(scan.components)), np.int64)
    lane = np.arange(len(begin))
    while len(lane):
        go = u < stop
        if not go.all():
            p, u, stop, lane = p[go], u[go], stop[go], lane[go]
            continue
        which = place[u]
        e = luts[which, bits.peek(p) >> np.uint32(16)]
        s = e & 255
        p += e >> 8
        diff = _signed(bits.take(p, s), s)
        p += s
        before[lane, which] += diff
        c[order[u], 0] = before[lane, which] << scan.low
        u += 1
        if len(p) and int(p.max()) > bits.limit:
            raise ValueError("data ends early")


def _read_ac(c: np.ndarray, order: np.ndarray, bits: Bits, begin: np.ndarray, end: np.ndarray, scan: Scan) -> None:
    lut, first, last = _reader(scan.tables[0]), scan.first, scan.last
    p, u, stop = bits.lane.copy(), begin.copy(), end
    k = np.full(len(u), first)
    while True:
        go = u < stop
        if not go.all():
            p, u, stop, k = p[go], u[go], stop[go], k[go]
        if not len(p):
            return
        e = lut[bits.peek(p) >> np.uint32(16)]
        symbol = e & 255
        p += e >> 8
        n = _AFTER[symbol]
        x = bits.take(p, n)
        p += n
        r, s = symbol >> 4, symbol & 15
        k += r
        put = np.flatnonzero(s)
        at = np.minimum(k[put], last)
        c[order[u[put]], at] = _signed(x[put], s[put]) << scan.low
        k += 1
        eob = (s == 0) & (r < 15)
        u += np.where(eob, (1 << r) + x, k > last)
        k = np.where(eob | (k > last), first, k)
        if int(p.max()) > bits.limit or not e.all():
            raise ValueError("damaged data")


def _read_refine(c: np.ndarray, order: np.ndarray, bits: Bits, begin: np.ndarray, end: np.ndarray, scan: Scan) -> None:
    lut, first, last, one = _reader(scan.tables[0]), scan.first, scan.last, 1 << scan.low
    p, u, stop = bits.lane.copy(), begin.copy(), end
    k, run = np.full(len(u), first), np.full(len(u), -1)  # run -1: a symbol is due
    fresh, band = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
    while True:
        go = u < stop
        if not go.all():
            p, u, stop, k, run, fresh, band = p[go], u[go], stop[go], k[go], run[go], fresh[go], band[go]
        if not len(p):
            return
        due = np.flatnonzero((run < 0) & (band == 0))
        if len(due):
            q = p[due]
            e = lut[bits.peek(q) >> np.uint32(16)]
            if not e.all():
                raise ValueError("damaged data")
            symbol = e & 255
            q += e >> 8
            r, s = symbol >> 4, symbol & 15
            n = np.where(s > 0, 1, np.where(r < 15, r, 0))
            x = bits.take(q, n)
            p[due] = q + n
            eob = (s == 0) & (r < 15)
            band[due] = np.where(eob, (1 << r) + x, 0)
            run[due] = np.where(eob, -1, r)
            fresh[due] = np.where(s > 0, np.where(x > 0, one, -one), 0)
        row = order[u]
        v = c[row, k].astype(np.int64)
        known = v != 0
        bit = bits.take(p, known.astype(np.int64))
        p += known
        grow = known & (bit > 0) & ((np.abs(v) & one) == 0)
        v = np.where(grow, v + np.sign(v) * one, v)
        lands = ~known & (run == 0) & (band == 0)
        v = np.where(lands, fresh, v)
        c[row, k] = v
        run = np.where(band > 0, -1, np.where(lands, -1, np.where(known, run, run - 1)))
        k += 1
        over = k > last
        u += over
        band -= over & (band > 0)
        run = np.where(over, -1, run)
        k = np.where(over, first, k)
        if int(p.max()) > bits.limit:
            raise ValueError("data ends early")


def coefficients(images: list[Image]) -> list[np.ndarray]:
    """Coefficients of each image: a row of 64 in zigzag order for each block, component by component in raster order."""
    rooms = [sum(w * h for w, h in (im.shape(i) for i in range(len(im.sampling)))) for im in images]
    base = np.cumsum([0, *rooms])
    c = np.zeros((int(base[-1]), 64), np.int16)
    for step in range(max((len(im.scans) for im in images), default=0)):
        groups: dict[tuple, list[int]] = {}
        for i, im in enumerate(images):
            if step < len(im.scans):
                s = im.scans[step]
                groups.setdefault((len(s.components), s.components, s.first, s.last, s.high, s.low, s.tables, s.restart), []).append(i)
        for members in groups.values():
            scan = images[members[0]].scans[step]
            bits = Bits([images[i].scans[step].data for i in members])
            orders, places, begins, ends, at = [], [], [], [], 0
            for i, lanes in zip(members, bits.lanes_of.tolist(), strict=True):
                order, place, unit = _order(images[i], scan.components)
                n = scan.restart * unit if scan.restart else len(order)
                start = np.arange(0, len(order), n)
                if len(start) != lanes:
                    raise ValueError("restart intervals are missing")
                orders.append(order + base[i])
                places.append(place)
                begins.append(start + at)
                ends.append(np.minimum(start + n, len(order)) + at)
                at += len(order)
            order, begin, end = np.concatenate(orders), np.concatenate(begins), np.concatenate(ends)
            if scan.first == 0:
                _read_dc(c, order, np.concatenate(places), bits, begin, end, scan)
            elif scan.high:
                _read_refine(c, order, bits, begin, end, scan)
            else:
                _read_ac(c, order, bits, begin, end, scan)
    return [c[a:b] for a, b in zip(base, base[1:], strict=False)]


def _order(image: Image, components: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, int]:
    return _cached_order(image.width, image.height, tuple(image.sampling), components)


@cache
def _cached_order(width: int, height: int, sampling: tuple, components: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, int]:
    return Image(width, height, list(sampling)).order(components)


def _chroma(cb: np.ndarray, cr: np.ndarray) -> list[np.ndarray]:
    """What chroma adds to red, green and blue."""
    cb, cr = cb.astype(np.int32) - 128, cr.astype(np.int32) - 128
    return [((x + 32768) >> 16).astype(np.int16) for x in (91881 * cr, -22554 * cb - 46802 * cr, 116130 * cb)]


def planes(image: Image, samples: np.ndarray) -> list[np.ndarray]:
    """Full-resolution red, green and blue (height, width) from the samples of an image of one or three components."""
    own, at = [], 0
    hm, vm = max(h for h, _ in image.sampling), max(v for _, v in image.sampling)
    for i in range(len(image.sampling)):
        w, t = image.shape(i)
        own.append(samples[at : at + w * t].reshape(t, w, 8, 8).transpose(0, 2, 1, 3).reshape(8 * t, 8 * w))
        at += w * t
    if len(own) == 1:
        return [own[0][: image.height, : image.width]] * 3
    scale = [(vm // v, hm // h) for h, v in image.sampling]
    if scale[0] == (1, 1) and scale[1] == scale[2]:  # chroma is converted before it is upsampled
        y, (v, h) = own[0].astype(np.int16), scale[1]
        wide = y.reshape(y.shape[0] // v, v, y.shape[1] // h, h)
        out = [np.clip(wide + add[:, None, :, None], 0, 255).astype(np.uint8).reshape(y.shape) for add in _chroma(own[1], own[2])]
    else:
        y, cb, cr = (p.repeat(v, axis=0).repeat(h, axis=1) for p, (v, h) in zip(own, scale, strict=True))
        out = [np.clip(y.astype(np.int16) + add, 0, 255).astype(np.uint8) for add in _chroma(cb, cr)]
    return [p[: image.height, : image.width] for p in out]


def samples(found: list[tuple[Image, np.ndarray]]) -> list[np.ndarray]:
    """Samples of all blocks of each image."""
    scaled = []
    for im, c in found:
        if all((q == 1).all() for q in im.quantizers):
            scaled.append(c)
            continue
        rooms = [w * t for w, t in (im.shape(i) for i in range(len(im.sampling)))]
        scaled.append(c.astype(np.int64) * np.repeat(np.stack(im.quantizers), rooms, axis=0))
    ends = np.cumsum([len(c) for c in scaled])[:-1]
    return np.split(_samples(np.concatenate(scaled)), ends) if scaled else []


def rgb(image: Image, c: np.ndarray) -> np.ndarray:
    """The full-resolution tensor (height, width, 3) of an image with one or three components."""
    return np.stack(planes(image, samples([(image, c)])[0]), axis=2)


def decode(streams: list[bytes]) -> list[tuple[Image, np.ndarray]]:
    """Images with their coefficients. ValueError for a stream that is no whole progressive JPEG."""
    images = [parse(s) for s in streams]
    return list(zip(images, coefficients(images), strict=True))


def payload(image: Image, c: np.ndarray) -> bytes:
    """The bytes that encode() stored."""
    return ((c[: image.blocks].astype(np.int64) + CENTRE) % 256).astype(np.uint8).tobytes()


# --- Spark --------------------------------------------------------------------------------------------------------------


def media_column(docs: DataFrame, text: str = "text", media: str = "media", size: str = "n_bytes") -> DataFrame:
    """docs with ``media``, a progressive JPEG of each text's UTF-8 bytes padded with zeros to a positive multiple of 64,
    and ``size``, the bytes before that. The text itself is dropped.

    Null and empty texts are stored as 64 zeros. Equal texts give equal media. All rows and other columns stay (columns
    called as the new ones are replaced); an empty table gives no rows.
    """
    base = docs.drop(*({media, size} - {text}))
    others = [c for c in base.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, text, BATCH_BYTES, BATCH_DOCS):
                data, off = words.buffers(piece.column(text))
                raw, off = data.tobytes(), off.tolist()
                texts = [raw[a:b] for a, b in zip(off, off[1:], strict=False)]
                padded = [t + b"\0" * (-len(t) % 64 or (0 if t else 64)) for t in texts]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in others), pa.array(encode(padded), pa.binary()), pa.array([len(t) for t in texts], pa.int64())], names=[*others, media, size])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields if f.name != text]
    return base.mapInArrow(run, ", ".join([*fields, f"`{media}` binary", f"`{size}` long"]))


def tensor_column(df: DataFrame, media: str = "media", tensor: str = "rgb") -> DataFrame:
    """df with ``tensor`` (height, width, samples: rows of RGB bytes) decoded from ``media``; null for what is null or no
    progressive JPEG. All rows and other columns stay; a column called ``tensor`` is replaced."""
    base = df.drop(tensor)
    kind = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("samples", pa.binary())])

    def one(stream: bytes | None) -> dict | None:
        try:
            x = rgb(*decode([stream])[0])
        except BROKEN:
            return None
        return {"height": x.shape[0], "width": x.shape[1], "samples": x.tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                some = batch.slice(at, 16)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array([one(s) for s in some.column(media).to_pylist()], kind)], names=[*some.schema.names, tensor])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, `{tensor}` struct<height: int, width: int, samples: binary>")


def _feature(channels: list[np.ndarray]) -> str:
    """Size, channel sums and the horizontal contrast of green."""
    g = channels[1].astype(np.int16)
    return "%dx%d:%d:%d:%d:%d" % (*g.shape, *(int(x.sum(dtype=np.int64)) for x in channels), int(np.abs(g[:, 1:] - g[:, :-1]).sum(dtype=np.int64)))


def digests(df: DataFrame, media: str = "media", doc_id: str = "doc_id", size: str = "n_bytes") -> DataFrame:
    """What is read back from a media column: digests of the payload and of the stream, and a feature of the RGB tensor.

    A null, or what is no stream of media_column, gives nulls in all columns but the id, n_bytes and, for a stream, its
    size and digest. Repeated rows give equal rows; other columns are not read; an empty table gives no rows.
    """

    def read(streams: list[bytes]) -> list[tuple | None]:
        """Image and component of each stream; one that is broken is None, found by halving its batch."""
        try:
            return decode(streams)
        except BROKEN:
            half = len(streams) // 2
            return read(streams[:half]) + read(streams[half:]) if half else [None]

    def digest(streams: list[bytes | None]) -> list[tuple]:
        good = [i for i, s in enumerate(streams) if s is not None]
        out: list[tuple] = [(None,) * 6] * len(streams)
        found = dict(zip(good, read([streams[i] for i in good]), strict=True)) if good else {}
        whole = {i: f for i, f in found.items() if f is not None}
        features = dict(zip(whole, (_feature(planes(im, x)) for (im, _), x in zip(whole.values(), samples(list(whole.values())), strict=True)), strict=True)) if whole else {}
        for i in good:
            raw = streams[i]
            out[i] = (None, None, None, len(raw), hashlib.sha256(raw).hexdigest(), None)
            if i in whole:
                back = payload(*whole[i])
                out[i] = (len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), *out[i][3:5], features[i])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes = 0, np.array([len(m or b"") for m in batch.column("m").to_pylist()])
            while at < batch.num_rows:
                to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH_BYTES)))
                some = batch.slice(at, min(to - at, BATCH_DOCS))
                at += some.num_rows
                columns = zip(*digest(some.column("m").to_pylist()), strict=True)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [some.column("d"), some.column("n"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
                )

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return df.select(F.col(doc_id).cast("long").alias("d"), F.col(size).alias("n"), F.col(media).alias("m")).mapInArrow(run, schema)


def op7_progressive_jpeg(spark, sf_dir: str) -> DataFrame:
    """Every document stored as a progressive JPEG and read back."""
    return digests(media_column(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


ORACLE_SQL = None
