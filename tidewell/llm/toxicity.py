"""Toxicity by weak supervision.

Voters are mined from labelled rows: lexicon voters fire on a word or a word's beginning, pattern voters on the shape of a
text. Which voters fire together is counted over all documents. A generative label model is fitted to these votes alone,
without labels: a text is of one of several hidden classes, ordinary or one of a few kinds of toxic (voters of one kind are
those that agree more than chance; words of different languages hardly ever meet), each with its rates of firing, which
expectation maximization estimates in passes over the votes. Voters that fire together more than the hidden class explains
are correlated; they are united to one vote, and the rates are estimated again. The model's posteriors label the sample,
and a linear classifier over more features is trained on them, which scores every document. Its score is calibrated on the
sample's labels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm import words
from tidewell.session import materialize

#: The classifier and the lexicon are fitted on at most so many labelled rows, by order of a hash of their ids.
SAMPLE_ROWS = 20_000
#: The features are at most so many, those of most toxic rows; so many of them, the first, are lexicon voters.
FEATURES = 512
VOTERS = 256
#: A feature fires in at least so many toxic rows of the sample, and so many times as often in toxic as in other rows.
MIN_SUPPORT = 3
SUPPORT_SHARE = 0.004
ODDS = 19
PREFIXES = (4, 5)
#: Voters with more than this agreement are the same voter; with more than the next, of one kind; with this excess over
#: the model, correlated. A kind has at least so many voters, as fewer tell nothing about their rates.
SAME, KIND, CORRELATED, KIND_VOTERS = 0.8, 0.1, 0.15, 3
FOLDS = 5
PATTERNS = ("capitals", "shouts", "digits", "long_word", "repeats", "short")
_U = np.uint64


def _keys(w: words.Words) -> list[np.ndarray]:
    """For each word the keys of its features: itself, and its first bytes."""
    _, value = words.alphabet("alnum_lower")
    up, _ = words.powers(max(PREFIXES) + 1)
    out = [w.h]
    size = w.end - w.start
    for k in PREFIXES:
        sums = np.zeros(len(w.h), _U)
        for i in range(k):
            sums += value[w.data[np.minimum(w.start + i, len(w.data) - 1)]] * up[i]
        out.append(np.where(size > k, words.mix(words.mix(sums) + _U(k)), w.h))
    return out


def _patterns(w: words.Words) -> np.ndarray:
    """For each text whether each of PATTERNS holds."""
    n = np.diff(w.offsets)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[w.offsets[1:]] - sums[w.offsets[:-1]]) / np.maximum(n, 1)

    d = w.data
    size = np.zeros(len(n), np.int64)
    np.maximum.at(size, w.doc, w.end - w.start)
    doc, _ = words.per_doc_unique(w.doc, w.h)
    distinct = np.bincount(doc, minlength=len(n)) / np.maximum(w.counts, 1)
    columns = [share((d >= 65) & (d <= 90)) > 0.3, share(d == 33) > 0.01, share((d >= 48) & (d <= 57)) > 0.1, size > 25, (distinct < 0.4) & (w.counts > 20), w.counts < 10]
    return np.stack(columns, axis=1)


class Table:
    """Features by key; finds those of a slice's words."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.sorted = keys[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys >> _U(44)).astype(np.int64)] = True

    def fired(self, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature) pairs."""
        doc, found = [], []
        for key in _keys(w):
            near = np.flatnonzero(self.maybe[(key >> _U(44)).astype(np.int64)])
            if not len(near) or not len(self.sorted):
                continue
            i = np.minimum(np.searchsorted(self.sorted, key[near]), len(self.sorted) - 1)
            hit = self.sorted[i] == key[near]
            doc.append(w.doc[near[hit]])
            found.append(self.order[i[hit]])
        if not doc:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = np.unique(np.concatenate(doc).astype(np.int64) * len(self.sorted) + np.concatenate(found))
        return pair // len(self.sorted), pair % len(self.sorted)


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Texts and labels (r, t, y) of at most ``rows`` labelled documents outside the held-out fold: of an id that has several
    texts the one of the least hash, so there is a row for each id at most, however often it comes."""
    known = labels.where(F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # bounded by rows, whatever the input
    found = docs.join(F.broadcast(known.select(F.col("doc_id").alias("d"), "y")), "d").select("d", F.struct(F.xxhash64("d", "t").alias("r"), "t", F.col("y").cast("int").alias("y")).alias("x"))
    return materialize(found.groupBy("d").agg(F.min("x").alias("x")).select("x.*"), "labelled")


def _mine(sample: DataFrame, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Keys of the features that fire mostly in toxic rows, their toxic and other counts, and the numbers of such rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, "t"):
                w = words.split(piece.column("t"), "alnum_lower")
                y = np.array(piece.column("y"), np.int64)
                key = np.concatenate(_keys(w)) if len(w.h) else np.zeros(0, _U)
                doc = np.tile(w.doc, 1 + len(PREFIXES)) if len(w.h) else w.doc
                # whole keys are kept, as they name the features later
                order = np.lexsort((key, doc))
                key, doc = key[order], doc[order]
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]) if len(key) else np.zeros(0, bool)
                key, toxic = key[new], y[doc[new]]
                value, back = np.unique(key, return_inverse=True)
                t = np.bincount(back, weights=toxic, minlength=len(value)).astype(np.int64)
                n = np.bincount(back, minlength=len(value)) - t
                yield pa.RecordBatch.from_arrays([pa.array(np.append(value.view(np.int64), 0)), pa.array(np.append(t, y.sum())), pa.array(np.append(n, len(y) - y.sum()))], names=["key", "t", "n"])

    counts = materialize(sample.mapInArrow(count, "key long, t long, n long").groupBy("key").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).where((F.col("key") == 0) | (F.col("t") >= MIN_SUPPORT)), "counts")
    total = counts.where("key = 0").first()
    toxic, clean = (int(total["t"]), int(total["n"])) if total else (0, 0)
    lift = counts.where((F.col("key") != 0) & (F.col("t") >= SUPPORT_SHARE * toxic) & (F.col("t") >= ODDS * F.col("n")))
    rows = lift.orderBy(F.desc("t"), "n", "key").limit(features).collect()
    return np.array([r["key"] for r in rows], np.int64).view(_U), np.array([r["t"] for r in rows], float), np.array([r["n"] for r in rows], float), toxic, clean


def _votes(docs: DataFrame, table: Table, voters: int) -> DataFrame:
    """(bits, n): the sets of voters that fire, and on how many of all documents."""
    size = voters + len(PATTERNS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, "t"):
                w = words.split(piece.column("t"), "alnum_lower")
                fired = np.zeros((piece.num_rows, size), bool)
                fired[table.fired(w)] = True
                fired[:, voters:] = _patterns(w)
                bits, n = np.unique(np.packbits(fired, axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(n)], names=["bits", "n"])

    return materialize(docs.select("t").mapInArrow(count, "bits binary, n long").groupBy("bits").agg(F.sum("n").alias("n")), "votes")


def _unite(fired: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether any voter of each group fires."""
    order = np.argsort(group, kind="stable")
    return np.logical_or.reduceat(fired[:, order], np.searchsorted(group[order], np.arange(group.max() + 1)), axis=1)


def _sums(votes: DataFrame, width: int, shape: tuple[int, int], f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all votes of f(which voters fired, how often), an array of the given (bounded) shape."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                some = batch.slice(at, 4000)
                bits = np.frombuffer(b"".join(some.column("bits").to_pylist()), np.uint8).reshape(some.num_rows, -1)
                total += f(np.unpackbits(bits, axis=1, count=width).astype(bool), np.array(some.column("n"), float))
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    out = np.zeros(shape)
    for r in votes.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = round(r["v"], 6)  # so that the order of summing doesn't show
    return out


def _components(link: np.ndarray) -> np.ndarray:
    """The least node that each node hangs together with."""
    least = np.arange(len(link))
    while True:
        new = np.array([min([least[i], *least[link[i]]]) for i in range(len(link))], int)
        if (new == least).all():
            return least
        least = new


@dataclass
class LabelModel:
    """What the votes tell about their hidden class.

    group: for each voter its number among the united ones; lexicon: how many of those are of lexicon voters, which come
    first; prior: shares of the classes, the first of them ordinary texts; rates: how often each united voter fires in each
    class; correlation: how much more often than the classes explain two united voters fire together.
    """

    group: np.ndarray
    lexicon: int
    prior: np.ndarray
    rates: np.ndarray
    correlation: np.ndarray

    @property
    def a(self) -> np.ndarray:
        """How often each united voter fires in toxic texts."""
        return self.prior[1:] @ self.rates[1:] / self.prior[1:].sum()

    @property
    def b(self) -> np.ndarray:
        """How often each united voter fires in other texts."""
        return self.rates[0]

    def classes(self, fired: np.ndarray) -> np.ndarray:
        """Probability of each class given the united votes."""
        on, off = np.log(self.rates), np.log(1 - self.rates)
        p = fired.astype(float) @ (on - off).T + off.sum(axis=1) + np.log(self.prior)
        p = np.exp(p - p.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """Probability of a toxic class given which voters fired."""
        return self.classes(_unite(fired, self.group))[:, 1:].sum(axis=1)


def _agreement(together: np.ndarray, n: float, expected: np.ndarray | None = None) -> np.ndarray:
    """Excess of how often two voters fire together over what is expected (by chance), as a correlation of rare events."""
    rate = together / max(n, 1)
    single = np.diag(rate)
    excess = (rate - (np.outer(single, single) if expected is None else expected)) / (np.sqrt(np.outer(single, single)) + 1e-9)
    np.fill_diagonal(excess, 0)
    return excess


def _kinds(agreement: np.ndarray, lexicon: int) -> list[np.ndarray]:
    """Lexicon voters that hang together by agreement; all of them where none do."""
    of = _components(agreement[:lexicon, :lexicon] > KIND)
    kinds = [np.flatnonzero(of == k) for k in np.unique(of)]
    return [k for k in kinds if len(k) >= KIND_VOTERS] or [np.arange(lexicon)]


def _regroup(group: np.ndarray, link: np.ndarray, lexicon: int) -> tuple[np.ndarray, int]:
    """Groups after linked ones are united, lexicon and pattern voters apart; and how many are of lexicon voters."""
    link = link.copy()
    link[:lexicon, lexicon:] = link[lexicon:, :lexicon] = False
    least = _components(link)
    names = np.unique(least)
    return np.searchsorted(names, least)[group], int((names < lexicon).sum())


def fit_label_model(votes: DataFrame, lexicon: int, width: int, prior: float, rounds: int = 30) -> LabelModel:
    """Fits classes, rates and correlations to votes (bits, n) of ``width`` voters, the first ``lexicon`` of them of words.

    No label is seen. prior is the share of toxic texts to start from; every kind starts with a rate of 0.3 for its voters,
    which only says that they fire more often in toxic texts than elsewhere.
    """
    group, count = np.arange(width), lexicon
    together = _sums(votes, width, (width, width), lambda x, n: (x * n[:, None]).T @ x)
    total = _sums(votes, width, (1, 1), lambda x, n: np.array([[n.sum()]]))[0, 0]
    group, count = _regroup(group, _agreement(together, total) > SAME, count)
    for last in (False, True):
        size = int(group.max()) + 1
        together = _sums(votes, width, (size, size), lambda x, n, g=group: (u := _unite(x, g)).T.astype(float) @ (u * n[:, None]))
        single = np.diag(together) / max(total, 1)
        kinds = _kinds(_agreement(together, total), count)
        rates = np.tile(single, (len(kinds) + 1, 1))
        rates[0, :count] *= 0.2
        for k, own in enumerate(kinds, 1):
            rates[k, own] = 0.3
        model = LabelModel(group, count, np.array([1 - prior, *[prior / len(kinds)] * len(kinds)]), np.clip(rates, 1e-6, 1 - 1e-6), np.zeros((size, size)))
        for _ in range(rounds):
            shape = (len(kinds) + 1, size + 1)
            got = _sums(votes, width, shape, lambda x, n, m=model: (m.classes(u := _unite(x, m.group)) * n[:, None]).T @ np.append(u, np.ones((len(u), 1)), axis=1))
            of = got[:, -1]
            rates = np.clip((got[:, :-1] + single) / (of[:, None] + 1), 1e-6, 1 - 1e-6)
            moved = np.abs(rates - model.rates).max()
            model.rates, model.prior = rates, (of + 0.01) / (of + 0.01).sum()
            if moved < 2e-3:
                break
        model.correlation = _agreement(together, total, (model.rates.T * model.prior) @ model.rates)
        if not last:
            group, count = _regroup(group, model.correlation > CORRELATED, count)
            if group.max() + 1 == size:
                break
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft labels, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * w
        bend = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def calibrate(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The weights scaled and shifted, so that the score is the probability of label 1 among the sample's rows: posteriors tell
    texts apart, but not where labels draw the line. Where the score doesn't grow with the label, the weights stay."""
    z = x.astype(np.float32) @ weights[:-1] + weights[-1]
    slope, shift = fit_linear(z[:, None], y)
    if slope <= 0:
        return weights
    out = weights * slope
    out[-1] += shift
    return out


@dataclass
class Model:
    table: Table
    weights: np.ndarray
    labels: LabelModel | None


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of labels.toxic, learned from labelled rows outside the held-out fold and from the votes of all docs.

    labels has doc_id and toxic; of repeated labels the greatest counts, nulls don't. Labels choose the voters and the share
    of toxic texts to start from, and at the end calibrate the score. Without toxic labels, or a feature of theirs, the model scores every text at 0.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    sample = _sample(base, labels.select(F.col(doc_id).cast("long").alias("doc_id"), "toxic"), sample_rows)
    keys, t, n, toxic, clean = _mine(sample, FEATURES)
    width = len(keys) + len(PATTERNS)
    table = Table(keys)
    if not toxic or not len(keys):
        return Model(table, np.append(np.zeros(width), -30.0), None)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, "t"):
                w = words.split(piece.column("t"), "alnum_lower")
                fired = np.zeros((piece.num_rows, width), bool)
                fired[table.fired(w)] = True
                fired[:, len(keys) :] = _patterns(w)
                yield pa.RecordBatch.from_arrays([piece.column("r"), piece.column("y"), pa.array([np.packbits(x).tobytes() for x in fired], pa.binary())], names=["r", "y", "x"])

    rows = sorted(map(tuple, sample.mapInArrow(features, "r long, y int, x binary").collect()))
    x = np.stack([np.unpackbits(np.frombuffer(r[2], np.uint8), count=width) for r in rows]).astype(bool)
    voters = min(VOTERS, len(keys))
    own = np.concatenate([np.arange(voters), np.arange(len(keys), width)])  # lexicon voters, then patterns
    model = fit_label_model(_votes(base, Table(keys[:voters]), voters), voters, voters + len(PATTERNS), toxic / (toxic + clean))
    weights = fit_linear(x.astype(np.float32), model.posterior(x[:, own]))
    return Model(table, calibrate(weights, x, np.array([r[1] for r in rows], float)), model)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with the score (0 to 1) of every whole text in column ``name``; a null text is scored as an empty one.

    All rows and other columns stay; a column of that name is replaced.
    """
    table, weights = model.table, model.weights
    base = docs.drop(name)
    columns = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, text):
                w = words.split(piece.column(text), "alnum_lower")
                doc, feature = table.fired(w)
                total = np.bincount(doc, weights=weights[feature], minlength=piece.num_rows) + _patterns(w) @ weights[-1 - len(PATTERNS) : -1] + weights[-1]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in columns), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], names=[*columns, name])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(name, T.DoubleType())]))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's score by a model of the labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


ORACLE_SQL = None
