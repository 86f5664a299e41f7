"""Hierarchical multi-length packing of tokenized documents.

Documents are routed to context tiers: the smallest tier that holds them whole; what exceeds the longest tier is first cut
into full windows of it. Each tier packs its documents best fit, longest first. Gaps of the longer windows are filled from
shorter tiers, whole documents first, then cut ones, so that windows end full; a full window of a shorter tier is a
power of two long and needs no padding. The windows of a block are dealt to step groups, longest first to the least filled
one, so that every group holds all tiers and the groups' tokens differ by one window at most.

All of this is local to a block of documents of bounded size within a task: lengths are known where the text is tokenized,
so nothing is shuffled, and only the last window of a block can be short.
"""

from __future__ import annotations

import bisect
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words

TIERS = (256, 512, 1024, 2048)
EOT = 1
BLOCK_TOKENS = 4_000_000
#: Chunks whose ids a worker remembers, at most twice as many for a while, beside those of the slice at hand.
WORD_CACHE = 300_000
#: Chunks whose ids are put in place at once.
GATHER = 1 << 18
STEP_TOKENS = 1 << 18

_UNSURE = re.compile(r"\s \s|\s\Z")
_SPECIAL = "<|endoftext|>"
#: Marks that part from a letter or digit before them whatever follows; an apostrophe may open an ending.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTER = re.compile("[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts as bytes of little-endian unsigned 32-bit numbers.

    A byte-level BPE never joins what a single space parts, so a text is encoded chunk by chunk, and each distinct chunk
    " word" once, put together from its lines, words and marks. Where white space meets other white space around a space,
    where the text ends in white space, or where a special token's string occurs, chunks don't tell, and the whole text is
    encoded as it is.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        n = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(n)])
        self.known: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}  # of what has no space before it
        self.before: dict[str, bytes] = {}  # the last full cache; what is used again moves on to the next

    def whole(self, text: str) -> bytes:
        return self.each([text])[0]

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each encoded as it is; offsets in the text, which take most of the time, are left out."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parts(self, chunk: str) -> list[str] | None:
        """What a chunk is put together from: its first word, and then line ends, words and the marks behind words, where
        white space or a change from letters or digits to marks parts them for sure. None if it has one part only."""
        out = []
        for line in chunk.split("\n"):
            word = line.rstrip(_MARKS)
            if not line or line != line.strip():
                return None
            if len(word) == len(line) or not word or not _LETTER.match(word[-1]):
                out += ["\n", line]
            else:
                out += ["\n", word, line[len(word) :]]
        return out[1:] if len(out) > 2 else None

    def learn(self, chunks: list[str]) -> None:
        """Ids of many chunks (each stands for a space and the chunk, which has no space)."""
        made, plain, odd, inner = {}, set(), [], set()
        for c in chunks:
            if not c or c != c.strip():  # white space at an edge would meet that of a neighbour
                odd.append(c)
            elif (c[-1] in _MARKS or "\n" in c) and (parts := self.parts(c)):
                made[c] = parts
                plain.add(parts[0])
                inner.update(parts[1:])
            else:
                plain.add(c)
        self.known.update(zip(odd, self.each([" " + c for c in odd]), strict=True))
        self.open(inner)
        plain.difference_update(self.known)
        again = {c: self.before[c] for c in plain if c in self.before}
        self.known.update(again)
        plain = list(plain.difference(again))
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            raw = self.whole(" " + " ".join(some))
            starts = np.flatnonzero(self.opens[np.frombuffer(raw, "<u4")])
            if len(starts) != len(some):  # a chunk that holds the mark of a space itself
                self.known.update(zip(some, self.each([" " + c for c in some]), strict=True))
                continue
            cuts = [*(starts * 4).tolist(), len(raw)]
            self.known.update(zip(some, map(raw.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
        for c, (head, *rest) in made.items():
            self.known[c] = b"".join([self.known[head], *map(self.first.__getitem__, rest)])

    def open(self, chunks: Iterable[str]) -> None:
        """Ids of chunks without a space before them."""
        if len(self.first) > WORD_CACHE:
            self.first = {}
        fresh = [c for c in chunks if c not in self.first]
        self.first.update(zip(fresh, self.each(fresh), strict=True))

    def recall(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, each with a space before it; those not known yet are learned."""
        found = list(map(self.known.get, chunks))
        at = [i for i, x in enumerate(found) if x is None]
        if len(self.known) + len(at) > WORD_CACHE:
            self.before, self.known = self.known, {c: x for c, x in zip(chunks, found, strict=True) if x is not None}
        missing = []
        for i in at:
            c = chunks[i]
            if (x := self.before.get(c)) is None:
                missing.append(c)
            else:
                self.known[c] = x
        self.learn(missing)
        for i in at:
            found[i] = self.known[chunks[i]]
        return found

    def chunked(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in which chunks tell: those of each distinct chunk are put to its places."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        index, chunks = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        opening, place = np.unique(index[bounds[:-1]], return_inverse=True)
        opening = [chunks[i] for i in opening.tolist()]
        index[bounds[:-1]] = len(chunks) + place
        pool = self.recall(chunks)
        self.open(opening)
        pool += map(self.first.__getitem__, opening)
        ids = np.frombuffer(b"".join(pool), "<u4")
        n = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        start = np.cumsum(n) - n
        out, ends = [], np.concatenate([[0], np.cumsum(n[index])])[bounds] * 4
        for at in range(0, len(index), GATHER):
            some = index[at : at + GATHER]
            size = n[some]
            out.append(ids[np.arange(size.sum()) + np.repeat(start[some] - (np.cumsum(size) - size), size)].tobytes())
        raw = b"".join(out)
        return [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        tell = [bool(t) and not _UNSURE.search(t) and _SPECIAL not in t for t in texts]
        some = [t for t, x in zip(texts, tell, strict=True) if x]
        found = iter(self.chunked(some) if some else [])
        return [next(found) if x else self.whole(t) for t, x in zip(texts, tell, strict=True)]


@cache
def _encoder(vocabulary: str) -> Encoder:
    """One for all tasks of a worker, so that words are encoded once."""
    return Encoder(vocabulary)


def pack_block(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset, tier) of documents of the given numbers of tokens.

    Every token lies in one piece; every sequence but the last one is full.
    """
    top = tiers[-1]
    pieces: list[tuple[int, int, int, int, int, int]] = []
    queues: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}  # (length, document, start)
    seq = 0
    for d, n in enumerate(lengths):
        start = 0
        while n - start >= top:
            pieces.append((d, start, top, seq, 0, top))
            seq += 1
            start += top
        if n > start:
            queues[next(t for t in tiers if t >= n - start)].append((n - start, d, start))
    for q in queues.values():
        q.sort()

    def take(q: list, i: int) -> tuple[int, int, int]:
        return q.pop(i)

    def place(item: tuple[int, int, int], tier: int, used: int) -> int:
        pieces.append((item[1], item[2], item[0], seq, used, tier))
        return used + item[0]

    for k in range(len(tiers) - 1, -1, -1):
        tier, own = tiers[k], queues[tiers[k]]
        while own:
            # a shorter tier's window opens only if enough is left to fill it
            if k and sum(x[0] for x in own[-2:]) < tier and sum(x[0] for x in own[-64:]) + sum(x[0] for s in tiers[:k] for x in queues[s][-256:]) < tier:
                below = tiers[k - 1]
                for n, d, start in own:  # too little: full windows of the next tier, and what is left of them
                    while n >= below:
                        place((below, d, start), below, 0)
                        n, start, seq = n - below, start + below, seq + 1
                    if n:
                        bisect.insort(queues[next(t for t in tiers if t >= n)], (n, d, start))
                own.clear()
                break
            used = place(take(own, len(own) - 1), tier, 0)
            while used < tier:
                room = tier - used
                for s in tiers[k::-1]:  # whole documents, longest that fits
                    i = bisect.bisect_right(queues[s], (room, len(lengths), 0)) - 1
                    if i >= 0:
                        used = place(take(queues[s], i), tier, used)
                        break
                else:  # none fits whole: cut the shortest
                    s = next((s for s in tiers[: k + 1] if queues[s]), None)
                    if s is None:
                        break
                    n, d, start = take(queues[s], 0)
                    used = place((room, d, start), tier, used)
                    rest = n - room
                    bisect.insort(queues[next(t for t in tiers if t >= rest)], (rest, d, start + room))
            seq += 1
    return pieces


def deal(filled: dict[int, int], tier_of: dict[int, int], step_tokens: int = STEP_TOKENS) -> dict[int, int]:
    """Step group of each sequence: as many groups as the tokens fill, each sequence to the least filled one.

    filled: tokens of each sequence. Longer tiers go first, so every tier is spread over all groups, and the groups' totals
    differ by one sequence of the longest tier at most.
    """
    groups = [(0, g) for g in range(max(1, -(-sum(filled.values()) // step_tokens)))]
    out = {}
    for s in sorted(filled, key=lambda s: (-tier_of[s], -filled[s], s)):
        have, g = groups[0]
        heapq.heapreplace(groups, (have + filled[s], g))
        out[s] = g
    return out


def _pack(vocabulary: str, tiers: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(vocabulary)
        eot = np.array([EOT], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 33
        ids: list = []
        tokens: list[bytes] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, tokens, size, base
            pieces = pack_block([len(t) // 4 for t in tokens], tiers)
            crc = [zlib.crc32(memoryview(tokens[d])[4 * a : 4 * (a + n)]) for d, a, n, *_ in pieces]
            filled, tier_of = {}, {}
            for _, _, n, s, _, tier in pieces:
                filled[s], tier_of[s] = filled.get(s, 0) + n, tier
            step = deal(filled, tier_of)
            cols = list(zip(*pieces, strict=True)) if pieces else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[d] for d in cols[0]], pa.int64()),
                    pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array([len(tokens[d]) // 4 for d in cols[0]], pa.int64()),
                    pa.array([base + s for s in cols[3]], pa.int64()),
                    pa.array(cols[4], pa.int64()),
                    pa.array(cols[5], pa.int32()),
                    pa.array([base + step[s] for s in cols[3]], pa.int64()),
                    pa.array([tokens[d][4 * a : 4 * (a + n)] for d, a, n, *_ in pieces], pa.binary()),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids"],
            )
            base += len(filled)
            ids, tokens, size = [], [], 0

        for batch in batches:
            for piece in words.slices(batch, "t"):
                for d, raw in zip(piece.column("d").to_pylist(), encoder.encode(piece.column("t").to_pylist()), strict=True):
                    ids.append(d)
                    tokens.append(raw + eot)
                    size += len(raw) // 4 + 1
                if size >= BLOCK_TOKENS:
                    yield from flush()
        if ids:
            yield from flush()

    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, tiers: tuple[int, ...] = TIERS, ids: bool = True) -> DataFrame:
    """Packs docs into sequences; a row for each piece of a document.

    Columns: doc_id, start and length (in the document's ids, to which id 1 is appended), ids_crc32, doc_tokens,
    sequence_id, offset, tier, step_group (sequences of about STEP_TOKENS tokens together), and, with ids, the piece's ids as little-endian unsigned 32-bit numbers. Null and empty texts are documents of the closing id alone.
    Repeated rows are packed each; null ids stay null; other columns are not read; an empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long, ids binary"
    out = base.mapInArrow(_pack(vocabulary or default_vocabulary(), tuple(sorted(tiers))), schema)
    return (out if ids else out.drop("ids")).withColumnRenamed("doc_id", doc_id)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), ids=False)


ORACLE_SQL = None
