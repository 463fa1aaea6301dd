"""Splits that keep related records together.

Rows that name the same preset file or carry the same take number are linked; a star to the first row
of each key gives the links, so a key that a third of all rows share costs one link a row.  Components
come from the frontier search of ``operators.graph``.  Whole components are then laid out in the order
of a hash, the large ones first, and cut at the shares of the plan, within each stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.graph import components
from corpusloom.plans.workspace import materialize

#: Hash ranges by which component sizes are summed before the running total (rows of that table: strata x buckets).
BUCKETS = 1024


def preset_key(path: Column) -> Column:
    """Bank directory and file below the last ``presets`` directory of a path, however it is spelled; null if there is none.

    Letter case, back slashes, doubled slashes, ``.`` and ``..`` steps, a ``file:`` scheme, percent codes and outer white space do not matter.
    """
    p = F.trim(F.regexp_replace(path, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    decoded = F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p)
    p = F.when(p.rlike("%[0-9a-fA-F]{2}"), decoded).otherwise(p)
    p = F.regexp_replace(F.lower(F.replace(p, F.lit("\\"), F.lit("/"))), "^file:", "")
    steps = F.transform(F.filter(F.split(p, "/"), lambda s: ~F.trim(s).isin("", ".")), lambda s: F.trim(s))
    walked = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.when(F.size(done) > 0, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(done)).otherwise(F.concat(done, F.array(s))),
    )
    key = F.regexp_extract(F.array_join(walked, "/"), "^(?:.*/)?presets/(.+)$", 1)
    return F.when(key != "", key)


def take_numbers(ident: Column) -> Column:
    """The 8-digit hexadecimal numbers in an id, lower case: runs of exactly eight hexadecimal digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(ident), F.lit("(?<![0-9a-f])([0-9a-f]{8})(?![0-9a-f])"), F.lit(1)))


def related_sets(rows: DataFrame, keys: list[Column], id_col: str = "seq") -> DataFrame:
    """(node, root): rows linked through any of the array-valued ``keys``; root is the smallest id of the set.  Only rows of sets of two or more.

    Null or empty keys link nothing; equal strings of different keys are different.
    """
    tag = lambda k, i: F.transform(F.coalesce(k, F.array().cast("array<string>")), lambda v: F.concat(F.lit(f"{i}:"), v))
    tagged = [tag(k, i) for i, k in enumerate(keys)]
    held = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("seq"), F.explode(F.array_distinct(F.concat(*tagged))).alias("k")).where("k is not null")
    held = materialize(held, "keys")
    first = held.groupBy("k").agg(F.min("seq").alias("a"), F.count("*").alias("m")).where("m > 1").select("k", "a")
    return components(held.join(first, "k").where("seq <> a").select("a", F.col("seq").alias("b")))


def sample_sets(samples: DataFrame) -> DataFrame:
    """Related rows of the samples table: the same preset file or the same take number."""
    return related_sets(samples, [F.when(F.col("gt_preset_path").isNotNull(), F.array(preset_key(F.col("gt_preset_path")))), take_numbers(F.col("id"))], "sample_seq")


def assign_splits(rows: DataFrame, sets: DataFrame, plan: list[tuple[str, float]], id_col: str, stratum_col: str, salt: str = "0") -> DataFrame:
    """(id, set, stratum, split): every row gets a split of ``plan`` (name, share); rows of one set get the same.

    A set's stratum is the most frequent value of ``stratum_col`` among its rows (ties: the smallest; null counts as a value of its own).
    Within a stratum sets lie in the order of their hash, sets above 0.5 % of the stratum before all others and with the largest
    split first, and are cut where their middle passes a share.  Running totals are taken over hash ranges, then inside a range, so no task sees a whole stratum.
    """
    shares = sorted(plan, key=lambda x: -x[1])
    total = sum(s for _, s in shares)
    base = rows.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("st"))
    base = materialize(base.join(sets.select(F.col("node").alias("id"), "root"), "id", "left").select("id", "st", F.coalesce("root", "id").alias("set")), "rows")
    parts = base.groupBy("set", "st").agg(F.count("*").alias("n"))
    unit = parts.groupBy("set").agg(F.sum("n").alias("n"), F.min_by("st", F.struct(-F.col("n"), F.col("st"))).alias("stratum"))
    sums = unit.groupBy("stratum").agg(F.sum("n").alias("all"))
    unit = unit.join(F.broadcast(sums) if sums.count() <= 100_000 else sums, "stratum").withColumn("h", F.xxhash64("set", F.lit(salt)))
    unit = materialize(unit.withColumn("bucket", F.when(F.col("n") * 200 > F.col("all"), F.lit(-1)).otherwise(F.pmod("h", F.lit(BUCKETS)))), "sets")
    per = unit.groupBy("stratum", "bucket").agg(F.sum("n").alias("m")).withColumn("start", F.sum("m").over(Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("stratum", "bucket").orderBy(F.when(F.col("bucket") < 0, -F.col("n")).otherwise(F.lit(0)), "h", "set").rowsBetween(Window.unboundedPreceding, -1)
    placed = unit.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(per.select("stratum", "bucket", "start"), ["stratum", "bucket"])
    middle = (F.coalesce("start", F.lit(0)) + F.col("before") + F.col("n") / 2) / F.col("all")
    cut, passed = F.lit(shares[-1][0]), total
    for name, share in reversed(shares[:-1]):
        passed = sum(s for _, s in shares[: [n for n, _ in shares].index(name) + 1])
        cut = F.when(middle < passed / total, F.lit(name)).otherwise(cut)
    return base.join(placed.select("set", "stratum", cut.alias("split")), "set").select("id", "set", "stratum", "split")
