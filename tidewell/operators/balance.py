"""Greedy balancing over aggregates: condition profiles, groups of frames, clips of a class.

Rows are reduced to the aggregate in Spark, the sequential step runs over the aggregate in one task, and its decisions are
joined back to the rows. Such a step depends on all its earlier choices, so it can't be dealt out; what it sees grows with
videos (a number for each that may be chosen), with sites' devices and days, or with sequences and labels, never with frames
or boxes, and it takes 8 bytes for each.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.scalars import hash_order
from tidewell.operators.ordered import with_running
from tidewell.operators.stats import condition_targets

FEATURES = ("class", "tod", "density", "area", "ar")
WEIGHTS = {"class": 4.0, "tod": 1.0, "density": 1.0, "area": 1.0, "ar": 1.0, "size": 2.0}


def balance_conditions(rows: DataFrame, columns: Sequence[str], position: str) -> DataFrame:
    """Rows chosen so that each value of a column is wanted as often as the column's rarest: always the row that fills the
    most deficits, the first of equals by position, until none fills any.

    Rows (videos) of one condition vector are alike, so the choice runs over vectors; a vector brings the positions of at
    most as many rows as any value is wanted, as equal vectors' rows compete by position.
    """
    targets = condition_targets(rows, columns)
    most = targets.agg(F.max("target")).first()[0] or 0
    place = F.row_number().over(Window.partitionBy(*columns).orderBy(position))
    ranked = rows.withColumn("__r", place)
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    few = ranked.where(F.col("__r") <= most).groupBy(F.array(*keys).alias("vector")).agg(F.array_sort(F.collect_list(F.col(position).cast("long"))).alias("at"))
    wanted = targets.agg(F.collect_list(F.struct("col", "val", "target")).alias("targets"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        number = {(t["col"], t["val"]): i for i, t in enumerate(pdf["targets"].iloc[0])}
        deficit = np.array([t["target"] for t in pdf["targets"].iloc[0]], float)
        has = np.zeros((len(pdf), len(number)))
        for i, x in enumerate(pdf["vector"]):
            has[i, [number[c, v] for c, v in zip(columns, x, strict=True) if v != "\0"]] = 1
        at, used = [np.asarray(x) for x in pdf["at"]], np.zeros(len(pdf), int)
        after = np.array([x[0] for x in at], float)  # position of each vector's next row
        scores = has @ deficit
        while True:
            scores[np.isinf(after)] = 0
            most_filled = scores.max(initial=0)
            if most_filled <= 0:
                return pd.DataFrame({"vector": pdf["vector"], "take": used})
            equal = np.flatnonzero(scores == most_filled)
            best = equal[after[equal].argmin()]
            used[best] += 1
            after[best] = at[best][used[best]] if used[best] < len(at[best]) else np.inf
            filled = (has[best] > 0) & (deficit > 0)
            deficit[filled] -= 1
            scores -= has[:, filled].sum(axis=1)

    taken = few.join(wanted).withColumn("__one", F.lit(0)).groupBy("__one").applyInPandas(choose, "vector array<string>, take long")
    return ranked.withColumn("__v", F.array(*keys)).join(taken, F.col("__v") == F.col("vector")).where(F.col("__r") <= F.col("take")).drop("__r", "__v", "vector", "take")


def split_groups(groups: DataFrame, hist: DataFrame, group: str, frames: str, rarity: DataFrame, shares: dict[str, float] | None = None, weights: dict[str, float] | None = None, seed: int = 0) -> DataFrame:
    """(group, split): groups, rarest first, each go to the split (tried test, val, train) that brings all splits closest
    to the global distributions and to their sizes.

    groups has a row per group, hist is (group, feature, key, cnt). Equal rarities go in hash order.
    """
    shares = shares or {"train": 0.8, "val": 0.1, "test": 0.1}
    if abs(sum(shares.values()) - 1) > 1e-6:
        raise ValueError("shares must sum to 1")
    weight = WEIGHTS | (weights or {})
    cells = hist.groupBy(group).agg(F.collect_list(F.struct("feature", F.col("key").alias("k"), "cnt")).alias("cells"))
    table = groups.select(group, F.col(frames).alias("frames")).join(rarity, group).join(cells, group, "left").withColumn("tie", hash_order(seed, F.col(group)))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rarity", "tie"], ascending=[False, True], kind="stable")
        index = {f: {} for f in FEATURES}
        for cs in pdf["cells"]:
            for c in cs if cs is not None else ():
                index[c["feature"]].setdefault(c["k"], len(index[c["feature"]]))
        own = {f: np.zeros((len(pdf), max(1, len(index[f])))) for f in FEATURES}
        for i, cs in enumerate(pdf["cells"]):
            for c in cs if cs is not None else ():
                own[c["feature"]][i, index[c["feature"]][c["k"]]] += c["cnt"]
        share = lambda x: x / np.maximum(x.sum(axis=-1, keepdims=True), 1)
        goal = {f: share(own[f].sum(axis=0)) for f in FEATURES}
        n = pdf["frames"].to_numpy(float)
        names = ["test", "val", "train"]
        want = np.array([shares[s] * n.sum() for s in names])
        have = {f: np.zeros((3, own[f].shape[1])) for f in FEATURES}
        size, out = np.zeros(3), []

        def cost(counts: dict, sizes: np.ndarray) -> np.ndarray:
            far = sum(weight[f] * np.abs(share(counts[f]) - goal[f]).sum(axis=-1) for f in FEATURES)
            return far + weight["size"] * np.abs(sizes - want) / np.maximum(want, 1)

        for i in range(len(pdf)):
            now = cost(have, size)
            after = cost({f: have[f] + own[f][i] for f in FEATURES}, size + n[i])
            s = int(np.argmin(now.sum() - now + after))
            for f in FEATURES:
                have[f][s] += own[f][i]
            size[s] += n[i]
            out.append(names[s])
        return pd.DataFrame({"g": pdf[group].astype(str), "split": out})

    return table.withColumn("__one", F.lit(0)).groupBy("__one").applyInPandas(choose, "g string, split string").select(F.col("g").alias(group), "split")


def split_by_counts(counts: DataFrame, clip: str, cls: str, n: str, val: float = 0.1, test: float = 0.1, seed: int = 0) -> DataFrame:
    """(clip, split): classes from the rarest on; of each, clips in hash order go to test until a share of the class's total
    is reached, then to val, then to train; clips of a class are out of the pool for the next ones.

    So a clip is dealt with its rarest class. Of three clips of a class or fewer the first is test and the last train. The
    class totals are the only thing small enough to be one task's work; clips are placed by distributed running sums.
    """
    per = counts.groupBy(clip, cls).agg(F.sum(n).cast("long").alias("n")).where("n > 0")
    order = per.groupBy(cls).agg(F.sum("n").alias("__all")).withColumn("__o", F.row_number().over(Window.orderBy("__all", F.col(cls).cast("string"))))
    own = per.join(order.select(cls, "__o"), cls).groupBy(clip).agg(F.min_by(F.struct(F.col("__o").alias("o"), "n"), "__o").alias("x")).select(clip, F.col("x.o").alias("__o"), F.col("x.n").alias("n"))
    placed = with_running(own.withColumn("__tie", hash_order(seed, F.col(clip))), ["__o"], ["__tie", clip], {"__sum": F.col("n")}, "__r")
    # what a set holds is what it takes until its share is reached
    pool = placed.groupBy("__o").agg(F.count("*").alias("__clips"), F.sum("n").alias("__total"))
    placed = placed.join(pool, "__o").withColumn("__before", F.col("__sum") - F.col("n"))
    in_test = F.col("__before") < F.ceil(F.lit(test) * F.col("__total"))
    tested = placed.where(in_test).groupBy("__o").agg(F.max("__sum").alias("__tested"))
    placed = placed.join(tested, "__o", "left")
    in_val = F.col("__before") - F.coalesce("__tested", F.lit(0)) < F.ceil(F.lit(val) * F.col("__total"))
    few = F.when(F.col("__r") == 1, "test").when((F.col("__r") == 2) & (F.col("__clips") == 3), "val").otherwise("train")
    return placed.select(clip, F.when(F.col("__clips") <= 3, few).when(in_test, "test").when(in_val, "val").otherwise("train").alias("split"))


def stratified_sequences(counts: DataFrame, sequence: str, label: str, n: str, val: float = 0.15, test: float = 0.15, seed: int = 0) -> DataFrame:
    """(sequence, split, tiny): sequences in hash order fill test and val up to their share of every label's total, once each
    set has a sequence of every label; the rest is train. tiny marks the sequences that brought test its labels: a small set
    of them all. One row per sequence and label is all the step sees."""
    per = counts.groupBy(sequence, label).agg(F.sum(n).alias("n")).where("n > 0")
    table = per.select(F.col(sequence).cast("string").alias("s"), F.col(label).cast("string").alias("l"), "n", hash_order(seed, F.col(sequence)).alias("tie"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        totals = pdf.groupby("l")["n"].sum().to_dict()
        order = pdf[["s", "tie"]].drop_duplicates().sort_values(["tie", "s"])["s"].tolist()
        own = {s: dict(zip(g["l"], g["n"], strict=True)) for s, g in pdf.groupby("s")}
        split, have, tiny = {}, {"test": {}, "val": {}}, set()

        def put(s: str, name: str) -> None:
            split[s] = name
            for k, v in own[s].items():
                have[name][k] = have[name].get(k, 0) + v

        for k in sorted(totals, key=lambda x: (totals[x], x)):  # every label in every set, rare ones first
            holders = [s for s in order if k in own[s]]
            for name in ("test", "val"):
                free = [s for s in holders if s not in split]
                if k not in have[name] and len(free) > 1:
                    put(free[0], name)
                    tiny |= {free[0]} if name == "test" else set()
        for s in order:
            if s in split:
                continue
            fits = (name for name, share in (("test", test), ("val", val)) if all(have[name].get(k, 0) + v <= share * totals[k] for k, v in own[s].items()))
            name = next(fits, None)
            if name:
                put(s, name)
            else:
                split[s] = "train"
        return pd.DataFrame([(s, x, s in tiny) for s, x in sorted(split.items())], columns=["s", "split", "tiny"])

    return table.withColumn("__one", F.lit(0)).groupBy("__one").applyInPandas(choose, "s string, split string, tiny boolean").withColumnRenamed("s", sequence)
