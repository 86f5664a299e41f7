"""Places, running sums and least rows in a total order, without a task that sees all rows of a group.

Rows are dealt by ranges of the order and counted within each range; what lies in the ranges before is added from a table
with a row for each range and group. The dealt rows are written once, as ranges are drawn from a sample and may differ when
drawn again. The order must be total: rows that are equal in it can't be parted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.scalars import hash_order
from tidewell.session import materialize

PART = "__part"
#: Rows of a group that share a prefix of their hash, about.
HASH_ROWS = 100_000
#: Rows of one part of dealt, about.
DEAL_ROWS = 1_000_000


def dealt(rows: DataFrame, counted: DataFrame, *keys: Column | str) -> DataFrame:
    """rows by their keys in as many parts as the rows of ``counted`` ask for, so that what joins and groups by these keys hold in
    a task doesn't grow with the table. As they are, if one part would do."""
    parts = -(-counted.count() // DEAL_ROWS)
    return rows.repartition(parts, *keys) if parts > 1 else rows


def with_running(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], sums: dict[str, Column], rank: str = "rank", keep_part: bool = False) -> DataFrame:
    """rows with their place (from 1) within their group in the order, and for each of ``sums`` its sum up to and with the row.

    keep_part: the number of a row's range stays as column PART; ranges follow the groups and the order.
    """
    dealt = materialize(rows.repartitionByRange(*by, *order).withColumn(PART, F.spark_partition_id()), "ranges")
    own = Window.partitionBy(PART, *by).orderBy(*order)
    local = dealt.withColumns({f"__l_{rank}": F.row_number().over(own).cast("long")} | {f"__l_{n}": F.sum(c).over(own.rowsBetween(Window.unboundedPreceding, 0)) for n, c in sums.items()})
    totals = dealt.groupBy(PART, *by).agg(F.count("*").alias(f"__b_{rank}"), *[F.sum(c).alias(f"__b_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    names = [rank, *sums]
    ahead = totals.select(F.col(PART).alias("__p"), *[F.col(c).alias(f"__k_{i}") for i, c in enumerate(by)], *[F.coalesce(F.sum(f"__b_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in names])
    same = F.col(PART) == F.col("__p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{i}"))
    both = local.join(ahead, same)
    out = both.select(*rows.columns, *[(F.col(f"__l_{n}") + F.col(f"__b_{n}")).alias(n) for n in names], *([PART] if keep_part else []))
    return out


def with_rank(rows: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """rows with their place (from 1) in a total order."""
    return with_running(rows, [], order, {}, name)


def best_from_here(rows: DataFrame, by: Sequence[str], rank: str, values: Sequence[str]) -> DataFrame:
    """rows of with_running (keep_part) with ``best_<value>``: the greatest value of the group from the row's place on."""
    on = Window.partitionBy(PART, *by).orderBy(F.desc(rank)).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"__m_{v}": F.max(v).over(on) for v in values})
    after = Window.partitionBy(*by).orderBy(F.desc(PART)).rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(PART, *by).agg(*[F.max(v).alias(v) for v in values])
    later = tops.select(F.col(PART).alias("__p"), *[F.col(c).alias(f"__k_{i}") for i, c in enumerate(by)], *[F.max(v).over(after).alias(f"__a_{v}") for v in values])
    same = F.col(PART) == F.col("__p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{i}"))
    return local.join(later, same).select(*rows.columns, *[F.greatest(f"__m_{v}", f"__a_{v}").alias(f"best_{v}") for v in values])


def least_by_hash(rows: DataFrame, by: Sequence[str], key: Sequence[str], takes: DataFrame | int, seed: int = 0, size: int | None = None) -> DataFrame:
    """The rows that come first in hash order: of each group as many as takes (by, take) says, or so many of all rows.

    Rows are counted by group and a prefix of their hash, as long as the number of rows asks for. Prefixes below the last
    one needed are taken whole; only the rows that share that one are ranked. size: number of rows, if known.
    """
    if size is None:
        size = rows.count()
    digits = 1
    while size > HASH_ROWS * 16**digits:
        digits += 1
    hashed = rows.withColumn("__h", hash_order(seed, *[F.col(c) for c in key])).withColumn("__x", F.substring("__h", 1, digits))
    counts = hashed.groupBy(*by, "__x").agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__to", F.sum("__n").over(Window.partitionBy(*by).orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)))
    names = [f"__k_{i}" for i in range(len(by))]
    if isinstance(takes, int):
        wanted = counts.withColumn("__take", F.lit(takes))
    else:
        limits = takes.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col("take").alias("__take"))
        same = F.lit(True)
        for c, n in zip(by, names, strict=True):
            same = same & F.col(c).eqNullSafe(F.col(n))
        wanted = counts.join(limits, same).drop(*names)
    room = F.least(F.col("__take") - (F.col("__to") - F.col("__n")), F.col("__n"))
    wanted = wanted.withColumn("__room", room).where(F.col("__room") > 0).select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col("__x").alias("__y"), "__room", (F.col("__room") == F.col("__n")).alias("__whole"))
    same = F.col("__x") == F.col("__y")
    for c, n in zip(by, names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(n))
    near = hashed.join(wanted, same)
    place = F.row_number().over(Window.partitionBy(*by, "__x").orderBy("__h", *key))
    last = near.where(~F.col("__whole")).withColumn("__r", place).where(F.col("__r") <= F.col("__room"))
    return near.where("__whole").select(*rows.columns).unionByName(last.select(*rows.columns))
