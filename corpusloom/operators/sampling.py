"""Sorting, sampling and splitting.

Order comes from keyed hashes, never from ``rand()``.  Running numbers and totals over a whole table are
taken in two steps - totals of hash or value ranges, then inside a range - so that no task sees the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.workspace import materialize

#: Rows of a range by which whole-table running numbers are split, about; and ranges of a hash order at least.
RANGE_ROWS, RANGES = 1_000_000, 256


def running(df: DataFrame, place: Column, order: list[str | Column], value: Column, out: str) -> DataFrame:
    """Exclusive running total of ``value`` in the order (place, *order); ``place`` is an integer that grows with the order."""
    r = df.withColumn("__p", place).withColumn("__v", value)
    totals = r.groupBy("__p").agg(F.sum("__v").alias("__t")).withColumn("__s", F.sum("__t").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = r.withColumn("__b", F.coalesce(F.sum("__v").over(inside), F.lit(0))).join(F.broadcast(totals.select("__p", "__s")), "__p")  # one row a range or hash prefix: at most 65,536, or a millionth of the rows
    return joined.withColumn(out, F.coalesce("__s", F.lit(0)) + F.col("__b")).drop("__p", "__v", "__s", "__b")


def with_row_number(df: DataFrame, key: str, out: str = "i") -> DataFrame:
    """0-based number of every row in the order of a unique key without nulls.

    A table of more than ``RANGE_ROWS`` rows is written in that many ranges of the key's own distribution, so a skewed key makes no hot range.
    """
    ranges = df.count() // RANGE_ROWS + 1
    if ranges == 1:
        return running(df, F.lit(0), [key], F.lit(1).cast("long"), out)
    placed = materialize(df.repartitionByRange(ranges, key).withColumn("__range", F.spark_partition_id()), "ranges")
    return running(placed, F.col("__range"), [key], F.lit(1).cast("long"), out).drop("__range")


def stratified_holdout(df: DataFrame, stratum: str, h: str, tie: str, count: int) -> DataFrame:
    """``side`` val or train: of every stratum the max(1, count // strata) rows of smallest hash, then the smallest of the rest up to ``count`` in all.

    With more strata than ``count`` more than ``count`` rows are held out.
    """
    k = df.agg(F.count_distinct(stratum).alias("k"))
    each = df.crossJoin(F.broadcast(k)).withColumn("__need", F.greatest(F.lit(1), F.floor(F.lit(count) / F.col("k"))))
    ranked = each.withColumn("__r", F.row_number().over(Window.partitionBy(stratum, F.pmod(F.col(h), F.lit(64))).orderBy(h, tie)))
    # Only the first rows of each hash part can be among a stratum's smallest: rank those alone.
    near = ranked.where(F.col("__r") <= F.col("__need")).withColumn("__r", F.row_number().over(Window.partitionBy(stratum).orderBy(h, tie))).where(F.col("__r") <= F.col("__need")).select(tie, F.lit(True).alias("__first"))
    taken = near.agg(F.count("*").alias("__taken"))
    rest = df.join(near, tie, "left_anti").orderBy(h, tie).limit(count).select(tie, h).withColumn("__g", F.row_number().over(Window.orderBy(h, tie))).crossJoin(F.broadcast(taken)).where(F.col("__g") <= count - F.col("__taken")).select(tie, F.lit(True).alias("__fill"))
    return df.join(near, tie, "left").join(rest, tie, "left").withColumn("side", F.when(F.coalesce("__first", "__fill"), "val").otherwise("train")).drop("__first", "__fill")


def cap_per_group(df: DataFrame, groups: list[str], h: Column, tie: str, cap: int) -> DataFrame:
    """At most ``cap`` rows a group, by keyed hash; thinned in hash parts first, so a hot group is never sorted in one task."""
    x = df.withColumn("__h", h)
    part = Window.partitionBy(*groups, F.pmod(F.xxhash64(tie), F.lit(64))).orderBy("__h", tie)
    thin = x.withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= cap)
    return thin.withColumn("__r", F.row_number().over(Window.partitionBy(*groups).orderBy("__h", tie))).where(F.col("__r") <= cap).drop("__h", "__r")


def take_budget(df: DataFrame, h: str, tie: str, size: str, budget: float, span: int) -> DataFrame:
    """Rows in hash order until the running size reaches the budget; the row that crosses it is in.  A budget of 0 or less takes none.

    ``h`` is an integer in [0, span).
    """
    place = F.floor(F.col(h) / (span / max(RANGES, df.count() // RANGE_ROWS))).cast("int")
    return running(df, place, [h, tie], F.col(size), "__before").where(F.col("__before") < budget).drop("__before")


def balanced_chunks(df: DataFrame, i: str, n: int) -> DataFrame:
    """P10: contiguous chunks of a 0-based row number; sizes differ by at most one, the first ones are longer."""
    total = df.agg(F.count("*").alias("__n"))
    q, r = F.floor(F.col("__n") / n), F.col("__n") % n
    long_part = r * (q + 1)
    chunk = F.when(F.col(i) < long_part, F.floor(F.col(i) / (q + 1))).otherwise(r + F.floor((F.col(i) - long_part) / F.greatest(q, F.lit(1))))
    return df.crossJoin(F.broadcast(total)).withColumn("chunk", chunk.cast("int")).drop("__n")


def length_batches(df: DataFrame, h: Column, tie: str, length: str, size: int, per_group: int) -> DataFrame:
    """Rows shuffled by hash, cut into groups of ``size * per_group``, sorted by length inside, cut into batches of ``size``."""
    x = df.withColumn("__h", h)
    place = F.conv(F.substring("__h", 1, 4), 16, 10).cast("int")
    x = running(x, place, ["__h", tie], F.lit(1).cast("long"), "__i").withColumn("__g", F.floor(F.col("__i") / (size * per_group)))
    r = F.row_number().over(Window.partitionBy("__g").orderBy(length, tie)) - 1
    return x.withColumn("batch", (F.col("__g") * per_group + F.floor(r / size)).cast("long")).drop("__h", "__i", "__g")


def terciles(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Low, mid, high by rank below a third and two thirds of the group; groups under three rows are all mid."""
    i, n = F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) - 1, F.count("*").over(Window.partitionBy(*groups))
    x = df.withColumn("__i", i).withColumn("__n", n)
    return x.withColumn("tercile", F.when(F.col("__n") < 3, "mid").when(F.col("__i") < F.col("__n") / 3, "low").when(F.col("__i") < 2 * F.col("__n") / 3, "mid").otherwise("high")).drop("__i", "__n")


def coverage_window(n: int, start: int, width: int) -> list[int]:
    """The positions of a window that wraps around ``n`` places, each at most once."""
    return [(start + i) % n for i in range(min(width, n))] if n > 0 else []


def inside_window(i: Column, n: Column, start: Column, width: int) -> Column:
    """Does place i of n lie in a window that wraps around the end?  The rows where it does not are the complement, each place once."""
    return (i - start + n) % n < width
