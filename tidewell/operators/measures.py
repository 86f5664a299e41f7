"""Network measurements: bursts, means over time, five-number summaries and joined series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.ordered import with_running


def mask_first(df: DataFrame, key: str, ts: str, value: str, n: int = 1, gap_seconds: int = 300) -> DataFrame:
    """df with the first n values of each burst set to null; a gap of gap_seconds or more opens a burst."""
    w = Window.partitionBy(key).orderBy(ts)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    new = F.coalesce((t - F.lag(t).over(w) >= gap_seconds * 1_000_000).cast("int"), F.lit(1))
    marked = df.withColumn("__new", new).withColumn("burst", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.row_number().over(Window.partitionBy(key, "burst").orderBy(ts))
    return marked.withColumn("__p", place).withColumn(value, F.when(F.col("__p") > n, F.col(value))).drop("__new", "__p")


def resample_mean(df: DataFrame, ts: str, value: str, width: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, start, mean): means over tumbling windows; empty ones have no row."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, F.window(ts, width).alias("w")).agg(F.avg(value).alias("mean")).select(*by, F.col("w.start").alias("start"), "mean")


def box_summary(df: DataFrame, by: Sequence[str], value: str, exact: bool = True) -> DataFrame:
    """(by, n, q1, median, q3, low, high): quartiles, and the outermost values within 1.5 times their distance.

    exact: quartiles lie between the values at their places, which are found by distributed ranks; otherwise they are
    approximate, in one aggregation.
    """
    names, quarters = [*by], ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    rows = df.select(*by, F.col(value).cast("double").alias("__v"), F.monotonically_increasing_id().alias("__i")).where("__v is not null")
    if exact:
        ranked = with_running(rows, names, ["__v", "__i"], {}, "__r")
        sizes = ranked.groupBy(*names).agg(F.max("__r").alias("n")).select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(names)], "n")
        # a row for each place that a quartile lies between, so no task gets a whole group
        at = lambda q: F.lit(q) * (F.col("n") - 1)
        ends = [F.struct(F.lit(name).alias("q"), (f(at(q)) + 1).cast("long").alias("at"), F.lit(i).alias("end"), (at(q) - F.floor(at(q))).alias("part")) for q, name in quarters for i, f in enumerate((F.floor, F.ceil))]
        wanted = sizes.select(*[f"__k_{i}" for i in range(len(names))], "n", F.inline(F.array(*ends)))
        same = F.col("__r") == F.col("at")
        for i, c in enumerate(names):
            same = same & F.col(c).eqNullSafe(F.col(f"__k_{i}"))
        both = ranked.join(wanted, same)
        cells = []
        for _, name in quarters:
            low, high = (F.max(F.when((F.col("q") == name) & (F.col("end") == i), F.col("__v"))) for i in (0, 1))
            cells.append((low + (high - low) * F.max(F.when(F.col("q") == name, F.col("part")))).alias(name))
        s = both.groupBy(*names).agg(F.max("n").alias("n"), *cells)
        rows = ranked
    else:
        q = F.percentile_approx("__v", F.array(*[F.lit(q) for q, _ in quarters]))
        s = rows.groupBy(*names).agg(F.count("*").alias("n"), q.alias("q")).select(*names, "n", *[F.get("q", i).alias(k) for i, (_, k) in enumerate(quarters)])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.when((F.col("__v") >= F.col("q1") - reach) & (F.col("__v") <= F.col("q3") + reach), F.col("__v"))
    ends = rows.join(s, names).groupBy(*names).agg(F.min(inside).alias("low"), F.max(inside).alias("high")) if names else rows.join(s).agg(F.min(inside).alias("low"), F.max(inside).alias("high"))
    return s.join(ends, names) if names else s.join(ends)


def throughput_summary(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, mean, peak, ratio): ratio of the mean to the peak."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.max(value).alias("peak")).withColumn("ratio", F.try_divide("mean", "peak"))


def bandwidth_weather(measures: DataFrame, weather: DataFrame, ts: str, value: str, hour: str, rain: str, unit: str = "hour") -> DataFrame:
    """(hour, value, rain): means of a unit of time beside the weather; equal rows of one hour collapse."""
    m = measures.groupBy(F.date_trunc(unit, ts).alias("hour")).agg(F.avg(value).alias("value"))
    return m.join(weather.select(F.date_trunc(unit, hour).alias("hour"), F.col(rain).alias("rain")), "hour").dropDuplicates()


def merge_series(df: DataFrame, ts: Column, series: str, value: str, names: Sequence) -> DataFrame:
    """One row per time and a column per series, null where it has no value: the outer merge of all series."""
    return df.groupBy(ts.alias("ts")).pivot(series, list(names)).agg(F.avg(value))


def mask_outliers(df: DataFrame, columns: Sequence[str], low: float | None = None, high: float | None = None) -> DataFrame:
    """Values outside [low, high) become null; rows left without any go."""
    keep = lambda c: (F.lit(True) if low is None else F.col(c) >= low) & (F.lit(True) if high is None else F.col(c) < high)
    return df.withColumns({c: F.when(keep(c), F.col(c)) for c in columns}).dropna(how="all", subset=list(columns))


def average_jitter(df: DataFrame, direction: str, jitter: str) -> DataFrame:
    """(direction, jitter): the mean jitter of each direction, measurements without one left out."""
    return df.where(F.col(jitter).isNotNull()).groupBy(direction).agg(F.avg(jitter).alias("jitter"))
