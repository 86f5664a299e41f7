"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found by permuterm rotations.

Each word gets a terminator, and all its rotations are sorted. The rotation that ends with a word's edited character is, but
for that character, a prefix that says all there is about the edit: words that have the character replaced share the
prefix, and the word without it is the prefix itself. So a group of the sort is one edit of one word: it has a member for
each character of the alphabet at most, plus the word without it, and is scanned once. A member takes the number of the others
and the best of them from the group's first three rows, so no pair is ever emitted, and what leaves a group is a row
for each member.

A word of L code points has 2 L + 1 rotations of L code points. Beyond LONG code points that would be too much text: such
rotations are known by a rolling hash of 124 bits and their length instead, so their rows grow with the word only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.ordered import with_rank
from tidewell.session import materialize

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DROP = 31
TERMINATOR = "$"
LONG = 64
#: Distinct words, and code points of them, that a task counts before it gives them on.
ENTRIES = 200_000
ENTRY_CHARS = 8 << 20
#: Largest primes below 2**31, moduli of the rolling hash.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASE = 1_000_003


def dropped(run: str, seed: int) -> str:
    """The run, or for one in DROP of a document's runs, by CRC-32, the run without one code point. seed: the CRC of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), seed)
    if h % DROP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words of at least so many code points and occurrences. Tasks count in a dictionary of bounded size."""

    def give(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        chars = 0
        for batch in batches:
            for d, t in zip(batch.column("d"), batch.column("t"), strict=True):
                seed = zlib.crc32(f"{d.as_py()}:".encode())
                # lower() of bytes turns A-Z only
                for found, n in Counter(RUN.findall(t.as_py().lower().decode("utf-8", "replace"))).items():
                    if len(found) < least_length:
                        continue
                    word = dropped(found, seed)
                    if len(word) >= least_length:
                        had = counts.get(word)
                        chars += 0 if had else len(word)
                        counts[word] = (had or 0) + n
                if len(counts) >= ENTRIES or chars >= ENTRY_CHARS:
                    yield give(counts)
                    counts, chars = {}, 0
        if counts:
            yield give(counts)

    base = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.col(text).cast("binary").alias("t"))
    return base.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# A row of a group: kind 2 is the word without the edited character. Kinds 0 and 1 have it; 1: it doubles the one before it, so
# taking out that one gives the same word, and the link to kind 2 counts there.


def _rotations(words: DataFrame, long: int) -> DataFrame:
    """(key, kind, word, n): each word's rotations without their last character, and whole, for edits of words up to long."""
    size = F.length("word")
    most = F.when(size < long, 2 * size + 1).otherwise(size)
    each = words.where(size <= long).select("word", "n", size.alias("l"), F.explode(F.sequence(F.lit(1), most)).alias("k"))
    each = each.withColumn("skips", F.col("k") <= F.col("l")).withColumn("i", F.when(F.col("skips"), F.col("k")).otherwise(F.col("k") - F.col("l")))
    word = F.col("word")
    key = F.concat(word.substr(F.col("i") + F.col("skips").cast("int"), F.col("l")), F.lit(TERMINATOR), word.substr(F.lit(1), F.col("i") - 1))
    doubles = (F.col("i") > 1) & (word.substr(F.col("i") - 1, F.lit(1)) == word.substr(F.col("i"), F.lit(1)))
    kind = F.when(~F.col("skips"), 2).when(doubles, 1).otherwise(0)
    return each.select(key.alias("key"), kind.alias("kind"), "word", "n")


def _powers(base: int, p: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo p, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
    return out[:n]


def rotation_keys(word: str, skips: bool) -> np.ndarray:
    """A key of 16 bytes for each rotation of a word: without its last character (skips), or whole, in the order of _rotations."""
    x = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    size, out = len(x), []
    i = np.arange(size if skips else size + 1)
    after = i + 1 if skips else i  # the first character behind the cut
    for p in PRIMES:
        q = np.uint64(p)
        up, down = _powers(BASE, p, size + 2), _powers(pow(BASE, -1, p), p, size + 2)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x + np.uint64(7)) * up[:size] % q)]) % q
        tail = (sums[size] + q - sums[after]) % q * down[after] % q
        h = tail + np.uint64(3) * up[size - after] + sums[i] * up[size - after + 1] % q
        out.append((h % q).astype(np.uint32))
    return np.ascontiguousarray(np.stack(out, axis=1)).view("V16").ravel()


def _hashed_rotations(words: DataFrame, long: int) -> DataFrame:
    """_rotations of edits of words longer than long, with hashed keys; words has id (the place among the words), word and n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, w, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n")), strict=True):
                for skips in (True, False):
                    if skips and len(w) <= long:
                        continue
                    keys = rotation_keys(w, skips)
                    x = np.frombuffer(w.encode("utf-32-le"), np.uint32)
                    kind = np.concatenate([[0], x[1:] == x[:-1]]).astype(np.int32) if skips else np.full(len(keys), 2, np.int32)
                    edge = f"{len(w) + (not skips)}:".encode()
                    for at in range(0, len(keys), 10_000):
                        part = keys[at : at + 10_000]
                        columns = [pa.array([edge + k.tobytes() for k in part], pa.binary()), pa.array(kind[at : at + 10_000]), pa.array(np.full(len(part), i, np.int64)), pa.array(np.full(len(part), n, np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "kind", "word", "n"])

    return words.mapInArrow(run, "key binary, kind int, word long, n long")


def _scan(rows: DataFrame) -> DataFrame:
    """(word, n, near, best): for each member of a group the number of its neighbours there, and the best of them."""
    group = Window.partitionBy("key").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.struct((-F.col("n")).alias("m"), "word", "kind")
    seen = rows.select("word", "n", "kind", F.count("*").over(group).alias("size"), F.sum((F.col("kind") > 0).cast("int")).over(group).alias("odd"), *[F.nth_value(top, i + 1).over(group).alias(f"t{i}") for i in range(3)])
    # kinds 1 and 2 are no neighbours by this group
    best = F.coalesce(*[F.when((F.col(f"t{i}.word") != F.col("word")) & (F.col(f"t{i}.kind") + F.col("kind") != 3), F.struct(f"t{i}.m", f"t{i}.word")) for i in range(3)])
    near = F.col("size") - 1 - ((F.col("kind") > 0) & (F.col("odd") == 2)).cast("int")
    return seen.where("size > 1").select("word", "n", near.alias("near"), best.alias("best")).where("near > 0")


def neighbours(words: DataFrame, long: int = LONG) -> DataFrame:
    """(word, n, n_near, best_n, best): for each word the number of words one edit away, and of those the one of the largest n
    (of equals the first in code-point order). words: distinct words with n."""
    found = _scan(_rotations(words, long))
    far = words.where(F.length("word") >= long)
    if not far.isEmpty():
        ids = materialize(with_rank(far, ["word"], "id"), "long-words")
        names = ids.select(F.col("id").alias("i"), F.col("word").alias("w"))
        hashed = _scan(_hashed_rotations(ids.select("id", "word", "n"), long))
        hashed = hashed.join(names, F.col("word") == F.col("i")).select(F.col("w").alias("word"), "n", "near", "best")
        hashed = hashed.join(names, F.col("best.word") == F.col("i")).select("word", "n", "near", F.struct("best.m", F.col("w").alias("word")).alias("best"))
        found = found.unionByName(hashed)
    none = F.lit(None).cast("struct<m: bigint, word: string>")
    every = found.unionByName(words.select("word", "n", F.lit(0).cast("long").alias("near"), none.alias("best")))
    out = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return out.select("word", "n", "n_near", (-F.col("best.m")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: where their forms lead. n grows RATIO times a step, so a path has less than 20."""
    tops = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        above = tops.select(F.col("word").alias("root"), F.col("root").alias("up"))
        tops = materialize(tops.join(above, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "forms")
        if tops.where("moved").isEmpty():
            return tops.select("word", "root")
        tops = tops.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, long: int = LONG) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the texts.

    Words are runs of Latin letters, A-Z lower-cased, one in DROP of them by (document, run) without one code point. A word's
    form is its most frequent neighbour, if that is ratio times as frequent as the word.
    Null and empty texts have no words; a null id counts as an empty one; repeated rows count as often as they come; equally
    frequent neighbours go by code-point order. An empty table gives no rows. Other columns are not read.
    """
    words = materialize(word_counts(docs, doc_id, text, least_length, least_count), "words")
    near = neighbours(words, long)
    has = F.col("best_n") >= ratio * F.col("n")
    found = materialize(near.select("word", "n", "n_near", F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "neighbours")
    led = roots(found.where("form is not null"))
    return found.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Every word of the documents with its standard form."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = None


def brute_force(docs: list[tuple], least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> list[tuple]:
    """The contract read word by word, for tests: (word, form, root, n, n_near, form_n)."""
    counts: Counter = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    alphabet = sorted({c for w in n for c in w})
    form, near = {}, {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        own = [x for x in edits - {w} if x in n]
        near[w] = len(own)
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= RATIO * n[w] else None

    def last(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], last(w), n[w], near[w], n.get(form[w])) for w in n]
