"""Aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distribution(df: DataFrame, value: str, by: list[str] | None = None, points: tuple[float, ...] = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) -> DataFrame:
    """Count, min, max, mean, population deviation and interpolated percentiles; zeros if there is nothing to count."""
    by = by or []
    v = F.col(value).cast("double")
    z = lambda c: F.coalesce(c, F.lit(0.0))
    out = [F.count(v).alias("n"), z(F.min(v)).alias("v_min"), z(F.max(v)).alias("v_max"), F.round(z(F.avg(v)), 4).alias("v_mean"), F.round(z(F.stddev_pop(v)), 4).alias("v_std")]
    got = join_groups(df.groupBy(*by).agg(*out), percentiles(df, value, by, list(points)).drop("n"), by)
    return got.select(*by, "n", "v_min", "v_max", "v_mean", "v_std", *[F.round(z(F.col("q")[i]), 4).alias(f"p{round(p * 100):02d}") for i, p in enumerate(points)])


def join_groups(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Left join of two tables with the same group columns; null groups meet; without group columns ``b`` has at most one row."""
    if not by:
        return a.join(F.broadcast(b), F.lit(True), "left")
    b = b.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], *[c for c in b.columns if c not in by])
    return a.join(b, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(by)]), "left").drop(*[f"__g{i}" for i in range(len(by))])


def located(df: DataFrame, value: str, by: list[str], ranges: int = 64) -> DataFrame:
    """(by, value, c, upto, n): every distinct value that is not null with its count, the running count and the group's.

    A group's values are counted first and split at approximate percentiles into ``ranges`` parts, which are summed before the running counts inside a
    part are taken, so no task sorts a whole group.
    """
    v = df.where(F.col(value).isNotNull())
    edges = v.groupBy(*by).agg(F.percentile_approx(value, F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), 10_000).alias("__e"), F.count("*").alias("n"))
    per = join_groups(v.groupBy(*by, value).agg(F.count("*").alias("c")), edges, by)
    per = per.withColumn("__p", F.size(F.filter("__e", lambda e: e < F.col(value)))).drop("__e")
    whole = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = per.groupBy(*by, "__p").agg(F.sum("c").alias("__t")).withColumn("__s", F.coalesce(F.sum("__t").over(whole), F.lit(0))).drop("__t")
    inside = Window.partitionBy(*by, "__p").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return join_groups(per.withColumn("__u", F.sum("c").over(inside)), totals, [*by, "__p"]).withColumn("upto", F.col("__s") + F.col("__u")).drop("__s", "__u", "__p")


def percentiles(df: DataFrame, value: str, by: list[str], points: list[float]) -> DataFrame:
    """(by, n, q): the interpolated percentiles of a numeric column as an array of doubles; groups without a value have no row (q is null without groups)."""
    at = located(df.select(*by, F.col(value).cast("double").alias("__v")), "__v", by)
    out = []
    for p in points:
        h = F.lit(float(p)) * (F.col("n") - 1)
        held = lambda r: F.max(F.when((r < F.col("upto")) & (r >= F.col("upto") - F.col("c")), F.col("__v")))
        low = held(F.floor(h))
        out.append(low + (held(F.ceil(h)) - low) * F.max(h - F.floor(h)))
    return at.groupBy(*by).agg(F.max("n").alias("n"), F.array(*out).alias("q"))


def ranked_value(df: DataFrame, value: str, by: list[str], rank: Column) -> DataFrame:
    """The value at a 0-based rank that may depend on the group's count ``n``.

    Values are counted first and located by running counts, so no group's values gather in an array.
    """
    per = located(df, value, by)
    return per.withColumn("r", rank).where((F.col("r") < F.col("upto")) & (F.col("r") >= F.col("upto") - F.col("c"))).select(*by, "n", F.col(value).alias("at_rank"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bins`` equal bins from min to max, the last closed; a constant column has one bin, no bins give no rows."""
    if bins <= 0:
        return df.select(F.lit(0).alias("bin"), F.lit(0.0).alias("low"), F.lit(0).cast("long").alias("n")).where("false")
    v = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    span = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / step))).cast("int")
    got = v.crossJoin(F.broadcast(span)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = span.where("lo is not null").select("lo", "hi", F.explode(F.when(F.col("hi") == F.col("lo"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(bins - 1)))).alias("bin"))
    return every.join(got, "bin", "left").select("bin", F.round(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins, 4).alias("low"), F.coalesce("n", F.lit(0)).alias("n"))


def term_statistics(df: DataFrame, doc: str, words: Column, k: int) -> DataFrame:
    """The k most frequent terms with term and document frequency; ties by term."""
    per = df.select(doc, F.explode(words).alias("term")).groupBy("term", doc).agg(F.count("*").alias("c"))
    return per.groupBy("term").agg(F.sum("c").alias("tf"), F.count("*").alias("df")).orderBy(F.desc("tf"), "term").limit(k)


def shares(df: DataFrame, by: list[str], measures: dict[str, Column]) -> DataFrame:
    """Sums by key with each sum's share of the total."""
    got = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.sum(c).alias(n) for n, c in measures.items()])
    total = Window.partitionBy()
    for n in ("n_rows", *measures):
        got = got.withColumn(f"{n}_share", F.round(F.col(n) / F.sum(n).over(total), 6))
    return got


def mean_pairwise_distance(df: DataFrame, vector: str, by: list[str] | None = None) -> DataFrame:
    """Mean cosine distance of all pairs in closed form, 1 - (|sum u|^2 - sum |u|^2) / (n (n - 1)), linear in the rows; 0 under two rows."""
    v = F.col(vector)
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = F.transform(v, lambda x: x.cast("double") / F.col("__len"))
    keys = by or []
    per = df.withColumn("__len", length).where("__len > 0").select(*keys, F.posexplode(unit).alias("i", "x"))
    dims = per.groupBy(*keys, "i").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    got = (dims.groupBy(*keys) if keys else dims.groupBy()).agg(F.sum(F.col("s") * F.col("s")).alias("s2"), F.max("n").alias("n"))
    return got.select(*keys, "n", F.round(F.when(F.col("n") < 2, F.lit(0.0)).otherwise(1 - (F.col("s2") - F.col("n")) / (F.col("n") * (F.col("n") - 1))), 8).alias("diversity"))


def spearman(df: DataFrame, x: str, y: str, by: list[str], tie: str) -> DataFrame:
    """1 - 6 sum d^2 / (m (m^2 - 1)) over ordinal ranks (ties by ``tie``); null under two rows."""
    rank = lambda c: F.row_number().over(Window.partitionBy(*by).orderBy(c, tie))
    r = df.withColumn("__d", (rank(x) - rank(y)).cast("double"))
    return r.groupBy(*by).agg(F.count("*").alias("m"), F.sum(F.col("__d") * F.col("__d")).alias("d2")).select(*by, "m", F.round(F.when(F.col("m") > 1, 1 - 6 * F.col("d2") / (F.col("m") * (F.col("m") * F.col("m") - 1))), 8).alias("rho"))


def auc(df: DataFrame, score: str, label: Column, by: list[str]) -> DataFrame:
    """Mann-Whitney share of positive-negative pairs in the right order, ties half; null without both kinds."""
    per = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count_if(label).alias("p"), F.count_if(~label).alias("q"))
    below = F.coalesce(F.sum("q").over(Window.partitionBy(*by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.withColumn("w", F.col("p") * (below + F.col("q") / 2)).groupBy(*by).agg(F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"), F.sum("w").alias("w")).select(*by, "n_pos", "n_neg", F.round(F.try_divide("w", F.col("n_pos") * F.col("n_neg")), 8).alias("auc"))


def precision_recall(matched: Column, predicted: Column, truth: Column) -> list[Column]:
    """Precision, recall and F1, 0 where undefined."""
    p = F.when(predicted > 0, matched / predicted).otherwise(0.0)
    r = F.when(truth > 0, matched / truth).otherwise(0.0)
    return [F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1")]
