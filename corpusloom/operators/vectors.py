"""Similarity search and candidate pools over embedding tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.numbers import cosine


#: Query vectors of one pass, about: 512 bytes each at 128 dimensions, so 10 MB are broadcast.
QUERY_ROWS = 20_000


def similarities(queries: DataFrame, index: DataFrame, query: str, name: str, vector: str, digits: int = 9) -> DataFrame:
    """Cosine of a stated, bounded query set against every index row, the best row of every name.

    The queries are counted; up to ``QUERY_ROWS`` they are the broadcast side, so the index is read once and never shuffled, and more come in blocks of
    as many, one pass a block.  Only one row a query and name leaves a task.  Zero vectors have no similarity and are left out.
    """
    q = queries.select(query, F.col(vector).alias("__q"))
    blocks = q.count() // QUERY_ROWS + 1
    if blocks > 1:
        out = None
        for i in range(blocks):
            part = _similar(q.where(F.pmod(F.xxhash64(query), F.lit(blocks)) == i), index, query, name, vector, digits)
            out = part if out is None else out.union(part)
        return out
    return _similar(q, index, query, name, vector, digits)


def _similar(q: DataFrame, index: DataFrame, query: str, name: str, vector: str, digits: int) -> DataFrame:
    pairs = index.select(name, F.col(vector).alias("__x")).crossJoin(F.broadcast(q))
    return pairs.withColumn("cos", F.round(cosine(F.col("__q"), F.col("__x")), digits)).where("cos is not null").groupBy(query, name).agg(F.max("cos").alias("cos"))


def top_k(scored: DataFrame, query: str, name: str, k: int) -> DataFrame:
    """The k best of every query with their rank; ties by name."""
    w = Window.partitionBy(query).orderBy(F.desc("cos"), name)
    return scored.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)


def exclude_truth(scored: DataFrame, truth: DataFrame, query: str, name: str) -> DataFrame:
    """Mask every true name of the query, not only the current one."""
    return scored.join(truth.select(query, name).distinct(), [query, name], "left_anti")


def first_hit(ranked: DataFrame, truth: DataFrame, query: str, name: str) -> DataFrame:
    """Rank of the first true name of every query, null if none is ranked."""
    hit = ranked.join(truth.select(query, name).distinct().withColumn("__t", F.lit(True)), [query, name], "left")
    return hit.groupBy(query).agg(F.min(F.when(F.col("__t"), F.col("rk"))).alias("best_rank"))


def best_true_rank(scored: DataFrame, truth: DataFrame, query: str, name: str) -> DataFrame:
    """W8 without a ranking: one more than the names that beat the query's best true name; null if none is scored."""
    true = scored.join(truth.select(query, name).distinct(), [query, name], "left_semi").groupBy(query).agg(F.min(F.struct((-F.col("cos")).alias("far"), F.col(name).alias("t"))).alias("best"))
    beats = (-F.col("cos") < F.col("best.far")) | ((-F.col("cos") == F.col("best.far")) & (F.col(name) < F.col("best.t")))
    counted = scored.join(true, query, "left").groupBy(query).agg((F.count_if(beats) + 1).alias("r"), F.bool_or(F.col("best").isNotNull()).alias("h"))
    return counted.select(query, F.when(F.col("h"), F.col("r")).alias("best_rank"))


def recall_flags(truth: Column, ranked: Column, points: list[int]) -> list[Column]:
    """Is any true name among the first k?  False, not null, for empty truth."""
    return [F.coalesce(F.arrays_overlap(truth, F.slice(ranked, 1, k)), F.lit(False)).alias(f"r_at_{k}") for k in points]


def mean_vectors(df: DataFrame, name: str, vector: str) -> DataFrame:
    """(name, i, x): mean by dimension, then scaled to unit length (plus 1e-12); means in the long form, so no name's rows gather."""
    dims = df.select(name, F.posexplode(vector).alias("i", "x")).groupBy(name, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    length = dims.groupBy(name).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("l"))
    return dims.join(length, name).select(name, "i", (F.col("m") / (F.col("l") + 1e-12)).alias("x"))


def candidate_pool(scored: DataFrame, truth: DataFrame, universe: DataFrame, query: str, name: str, size: int, salt: str = "0") -> DataFrame:
    """True names first, then the hardest others, then others by keyed hash, up to ``size``; no rows for a query without a true name in the universe.

    A query is filled from the 3 * size names of smallest hash: at most ``size`` true and ``size`` hard names can be among those and not count.
    """
    names = universe.select(name).distinct()
    known = truth.select(query, name).distinct().join(names, name, "left_semi")
    hard = top_k(exclude_truth(scored, truth, query, name), query, name, size)
    rows = known.select(query, name, F.lit(0).alias("kind"), F.lit(0.0).alias("o")).union(hard.select(query, name, F.lit(1), -F.col("cos")))
    short = known.select(query).distinct().join(rows.groupBy(query).agg(F.count("*").alias("__n")), query).where(F.col("__n") < size).select(query)
    spare = names.withColumn("__h", F.md5(F.concat(F.col(name).cast("string"), F.lit(salt)))).orderBy("__h", name).limit(3 * size).select(name)
    fill = short.crossJoin(F.broadcast(spare)).join(truth.select(query, name), [query, name], "left_anti").join(hard.select(query, name), [query, name], "left_anti")
    rows = rows.union(fill.select(query, name, F.lit(2), F.lit(0.0)))
    w = Window.partitionBy(query).orderBy("kind", "o", F.md5(F.concat(F.col(name).cast("string"), F.lit(salt))), name)
    return rows.join(known.select(query).distinct(), query, "left_semi").withColumn("place", F.row_number().over(w)).where(F.col("place") <= size).drop("o")


def delta_select(scored: DataFrame, baseline: DataFrame, query: str, name: str, least: float, k: int, force_first: bool = False) -> DataFrame:
    """Similarity minus the baseline's; above ``least``, the k largest; with ``force_first`` a query's largest is in whatever its size."""
    d = scored.join(baseline.select(query, name, F.col("cos").alias("__b")), [query, name]).withColumn("delta", F.round(F.col("cos") - F.col("__b"), 9))
    if force_first:
        d = d.withColumn("__best", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("delta"), name)) == 1).where((F.col("delta") > least) | F.col("__best")).drop("__best")
    else:
        d = d.where(F.col("delta") > least)
    return d.withColumn("rk", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("delta"), name))).where(F.col("rk") <= k).drop("__b")


def selection_rates(queries: DataFrame, selected: DataFrame, truth: DataFrame, query: str, name: str) -> DataFrame:
    """(n, any_rate, top_rate, mean_best_rank): shares of queries with a true name selected and with one in first place, and the mean best rank of those that have one."""
    best = first_hit(selected, truth, query, name)
    x = queries.select(query).distinct().join(best, query, "left")
    n = F.greatest(F.lit(1), F.count("*"))
    return x.agg(F.count("*").alias("n"), F.round(F.count("best_rank") / n, 6).alias("any_rate"), F.round(F.count_if(F.col("best_rank") == 1) / n, 6).alias("top_rate"), F.round(F.avg("best_rank"), 6).alias("mean_best_rank"))
