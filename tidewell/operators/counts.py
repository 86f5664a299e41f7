"""Species counts of clips, their scores, and set operations on names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.ordered import with_rank


def sum_groups(counts: DataFrame, by: str = "species") -> DataFrame:
    """(by, n): totals by species or by direction."""
    return counts.groupBy(by).agg(F.sum("n").alias("n"))


def net_upstream(counts: DataFrame, key: str, direction: str = "l", contains: str | None = None) -> DataFrame:
    """(species, net): crossings in the favoured direction less those against it, of files whose name matches."""
    df = counts.where(F.col(key).cast("string").rlike(f"(?i){contains}")) if contains else counts
    return df.groupBy("species").agg(F.sum(F.when(F.col("direction") == direction, F.col("n")).otherwise(-F.col("n"))).alias("net"))


def align_counts(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """(key, direction, species, gt, pred) of the files in both, 0 where one has no row."""
    both = truth.select(key).distinct().join(predicted.select(key).distinct(), key, "left_semi")
    on = [key, "direction", "species"]
    a = truth.join(both, key, "left_semi").groupBy(*on).agg(F.sum("n").alias("gt"))
    b = predicted.join(both, key, "left_semi").groupBy(*on).agg(F.sum("n").alias("pred"))
    return a.join(b, on, "full").select(*on, F.coalesce("gt", F.lit(0)).alias("gt"), F.coalesce("pred", F.lit(0)).alias("pred"))


def nmae(truth: DataFrame, predicted: DataFrame, key: str, by: str = "species") -> DataFrame:
    """(by, abs_error, gt, nmae): errors of each file and direction, summed, over the true total."""
    s = align_counts(truth, predicted, key).groupBy(by).agg(F.sum(F.abs(F.col("pred") - F.col("gt"))).alias("abs_error"), F.sum("gt").alias("gt"))
    return s.withColumn("nmae", F.try_divide("abs_error", "gt"))


def t_test(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """One row: means, pooled standard deviation, standard error and t of the per-file totals."""

    def side(df: DataFrame, name: str) -> DataFrame:
        per = df.groupBy(key).agg(F.sum("n").cast("double").alias("v"))
        return per.agg(F.count("*").alias(f"n_{name}"), F.avg("v").alias(f"mean_{name}"), F.var_samp("v").alias(f"var_{name}"))

    both = side(truth, "gt").join(side(predicted, "pred"))
    pooled = F.sqrt(((F.col("n_gt") - 1) * F.col("var_gt") + (F.col("n_pred") - 1) * F.col("var_pred")) / (F.col("n_gt") + F.col("n_pred") - 2))
    error = pooled * F.sqrt(F.lit(1.0) / F.col("n_gt") + F.lit(1.0) / F.col("n_pred"))
    return both.select("mean_gt", "mean_pred", pooled.alias("pooled_sd"), error.alias("std_error"), F.try_divide(F.col("mean_pred") - F.col("mean_gt"), error).alias("t"))


def counts_wide(counts: DataFrame, key: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Wide table: key and a column ``<direction>_<species>`` for each pair."""
    cells = [F.coalesce(F.sum(F.when((F.col("direction") == d) & (F.col("species") == s), F.col("n"))), F.lit(0)).alias(f"{d}_{s}") for d, s in columns]
    return counts.groupBy(key).agg(*cells)


def counts_long(wide: DataFrame, key: str) -> DataFrame:
    """(key, direction, species, n) of a wide table whose columns are called l_<species> and r_<species>."""
    cells = [c for c in wide.columns if c[:2] in ("l_", "r_")]
    long = wide.unpivot(key, cells, "metric", "n")
    return long.select(key, F.substring("metric", 1, 1).alias("direction"), F.expr("substring(metric, 3)").alias("species"), F.col("n").cast("long").alias("n"))


def unfinished(paths: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return paths.join(done.select(key).distinct(), key, "left_anti")


def select_paths(paths: DataFrame, names: DataFrame, key: str) -> DataFrame:
    return paths.join(names.select(key).distinct(), key, "left_semi")


def compare_scores(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, score_a, score_b): two tables side by side; rows missing in both are dropped."""
    both = a.select(key, F.col(value).alias("score_a")).join(b.select(key, F.col(value).alias("score_b")), key, "full")
    return both.dropna(how="all", subset=["score_a", "score_b"])


def rank_trials(epochs: DataFrame, trial: str, epoch: str, metrics: Sequence[str]) -> DataFrame:
    """(trial, epoch, score, rank): the last epoch of each trial, scored by its first non-null metric; trials without come last."""
    last = F.row_number().over(Window.partitionBy(trial).orderBy(F.desc(epoch)))
    rows = epochs.withColumn("__r", last).where("__r = 1").select(trial, epoch, F.coalesce(*metrics).alias("score"))
    return with_rank(rows, [F.desc_nulls_last("score"), F.col(trial)], "rank")


def ap50_by_site(metrics: DataFrame, site: str, cls: str, value: str) -> DataFrame:
    """Metrics with their place within the site, best first."""
    return metrics.withColumn("place", F.row_number().over(Window.partitionBy(site).orderBy(F.desc(value), cls)))


def conform_splits(wanted: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, wanted, actual, status) of sequences: ok, move, missing, extra, or duplicate for one found in several places,
    which has a row for each."""
    found = actual.select(key, F.col("split").alias("actual"), F.count("*").over(Window.partitionBy(key)).alias("__n"))
    both = wanted.select(key, F.col("split").alias("wanted")).join(found, key, "full")
    status = F.when(F.col("wanted").isNull(), "extra").when(F.col("actual").isNull(), "missing").when(F.col("__n") > 1, "duplicate").when(F.col("wanted") == F.col("actual"), "ok").otherwise("move")
    return both.withColumn("status", status).drop("__n")


def sum_distributions(df: DataFrame, column: str) -> DataFrame:
    """(key, n): maps of label counts, summed."""
    return df.select(F.explode(column).alias("key", "v")).groupBy("key").agg(F.sum("v").alias("n"))


def tracks_per_class(tracks: DataFrame, cls: str, track: Sequence[str], classes: DataFrame) -> DataFrame:
    n = tracks.groupBy(cls).agg(F.countDistinct(*track).alias("n"))
    return classes.select(cls).join(n, cls, "left").select(cls, F.coalesce("n", F.lit(0)).alias("n"))


def reviewed_counts(tasks: DataFrame, key: str, data: str, species: Sequence[str], annotations: str = "annotations") -> DataFrame:
    """(key, direction, species, n) from the fields counts_l_<species> and counts_r_<species> of a task's data, 0 where one is
    missing. Tasks without annotations, or with an empty first result, are left out."""
    first = F.get(annotations, 0)["result"]
    used = tasks.where(F.coalesce(F.size(first) > 0, F.lit(False)))
    cells = [F.struct(F.lit(d).alias("direction"), F.lit(s).alias("species"), F.coalesce(F.try_element_at(data, F.lit(f"counts_{d}_{s}")).try_cast("long"), F.lit(0)).alias("n")) for s in species for d in ("l", "r")]
    return used.select(key, F.explode(F.array(*cells)).alias("c")).select(key, "c.*")


def seq_species_counts(boxes: DataFrame, sequence: str, label: str) -> DataFrame:
    return boxes.groupBy(sequence, label).agg(F.count("*").alias("n"))


def missing_names(wanted: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, n): names that were asked for and are not there, and how often."""
    return wanted.join(found.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("n"))


def nonzero_sorted(totals: DataFrame, n: str, *, name: str) -> DataFrame:
    """Rows of other than zero, the greatest first, with their place; equal numbers go by name."""
    return with_rank(totals.where(F.col(n) != 0), [F.desc(n), F.col(name)], "place")


def total_counts(tables: Sequence[DataFrame], by: Sequence[str] = ("species",)) -> DataFrame:
    """(by, n): totals over several count tables (rivers, years)."""
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    return union.groupBy(*by).agg(F.sum("n").alias("n"))


def column_sums(wide: DataFrame, key: str) -> DataFrame:
    """(metric, n): the sum of each column of a wide count table but the key."""
    cells = [c for c in wide.columns if c != key]
    return wide.agg(*[F.sum(F.coalesce(F.col(f"`{c}`"), F.lit(0))).alias(c) for c in cells]).unpivot([], cells, "metric", "n")


def order_results(results: DataFrame, name: str, cls: str, value: str, digits: int = 4) -> DataFrame:
    """Results with the value rounded (half to even) and their place: by the name without its first letter, name, class."""
    rows = results.withColumns({value: F.bround(value, digits), "sort_key": F.substring(F.col(name), F.lit(2), F.length(name))})
    return with_rank(rows, ["sort_key", name, cls], "place")


def ap_vs_counts(metrics: DataFrame, counts: DataFrame, cls: str, ap: str, n: str) -> DataFrame:
    """(cls, ap, n, corr): metrics beside the classes' counts, and their correlation over all classes."""
    both = metrics.select(cls, ap).join(counts.select(cls, n), cls)
    return both.join(both.agg(F.corr(ap, n).alias("corr")))
