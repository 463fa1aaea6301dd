"""Joins that Spark has no single operator for."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_all(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with ``orphan``: does a row lack a partner?  The caller decides whether to raise."""
    return df.join(dim.withColumn("__hit", F.lit(True)), keys, "left").withColumn("orphan", F.col("__hit").isNull()).drop("__hit")


def matched_once(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Candidates by content with an exactly-one rule: (left_id, n_candidates, problem); rows of the right that nothing uses come with a null left_id.

    Candidates are counted per key before the join, so a key that many rows share makes no pairs.
    """
    lc = left.groupBy(*keys).agg(F.count("*").alias("n_left"))
    rc = right.groupBy(*keys).agg(F.count("*").alias("n_right"))
    a = left.join(rc, keys, "left").select(F.col(left_id), F.lit(None).cast(right.schema[right_id].dataType).alias(right_id), F.coalesce("n_right", F.lit(0)).alias("n_candidates"))
    b = right.join(lc, keys, "left_anti").select(F.lit(None).cast(left.schema[left_id].dataType).alias(left_id), F.col(right_id), F.lit(0).cast("long").alias("n_candidates"))
    problem = F.when(F.col(left_id).isNull(), "unused").when(F.col("n_candidates") == 0, "none").when(F.col("n_candidates") > 1, "ambiguous")
    return a.union(b).withColumn("problem", problem)


def manifest_diff(a: DataFrame, b: DataFrame, key: str, digest: str) -> DataFrame:
    """Full outer comparison of two listings: missing (only in a), extra (only in b), identical, changed."""
    j = a.select(key, F.col(digest).alias("da"), F.lit(1).alias("ia")).join(b.select(key, F.col(digest).alias("db"), F.lit(1).alias("ib")), key, "full_outer")
    state = F.when(F.col("ib").isNull(), "missing").when(F.col("ia").isNull(), "extra").when(F.col("da").eqNullSafe(F.col("db")), "identical").otherwise("changed")
    return j.select(key, state.alias("state"))


def map_diff(df: DataFrame, a: str, b: str, ids: list[str], absolute: float = 0.005, relative: float = 0.01) -> DataFrame:
    """Keys whose values differ by more than max(absolute, relative * |a|), or that only one map has."""
    keys = F.array_union(F.map_keys(a), F.map_keys(b))
    x = df.select(*ids, a, b, F.explode(keys).alias("key")).select(*ids, "key", F.col(a)[F.col("key")].alias("va"), F.col(b)[F.col("key")].alias("vb"))
    far = F.round(F.abs(F.col("va") - F.col("vb")), 9) > F.round(F.greatest(F.lit(absolute), F.abs("va") * relative), 9)  # sums in another order must not decide
    return x.where(F.col("va").isNull() | F.col("vb").isNull() | far)


def long_diff(a: DataFrame, b: DataFrame, keys: list[str], value: str, absolute: float = 0.005, relative: float = 0.01) -> DataFrame:
    """J9, U37 with one row a key instead of maps: no key range is gathered in one row.  ``keys`` are unique and not null on each side."""
    x = a.select(*keys, F.col(value).alias("va")).join(b.select(*keys, F.col(value).alias("vb")), keys, "full_outer")
    far = F.round(F.abs(F.col("va") - F.col("vb")), 9) > F.round(F.greatest(F.lit(absolute), F.abs("va") * relative), 9)  # sums in another order must not decide
    return x.where(F.col("va").isNull() | F.col("vb").isNull() | far)


def asof_backward(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, tie: str | None = None) -> DataFrame:
    """Of every left row the right value at the latest ``at`` not after its own (null before the first).

    Both sides are united and carried forward by one window: one shuffle, no range join.  At equal times right rows come first,
    the last of them by ``tie`` counts.
    """
    cols = [c for c in left.columns if c not in (*keys, at)]
    u = left.select(*keys, at, F.struct(*cols).alias("__l"), F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.lit(1).alias("__s"), F.lit(None).cast(right.schema[tie].dataType if tie else "long").alias("__t"))
    u = u.union(right.select(*keys, at, F.lit(None).cast(u.schema["__l"].dataType), F.col(value), F.lit(0), F.col(tie) if tie else F.lit(None).cast("long")))
    w = Window.partitionBy(*keys).orderBy(at, "__s", "__t").rowsBetween(Window.unboundedPreceding, 0)
    return u.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__s = 1").select(*keys, at, "__l.*", F.col("__v").alias(value))


def contained_intervals(points: DataFrame, windows: DataFrame, key: str, start: str, end: str, lo: str, hi: str, width: float) -> DataFrame:
    """Intervals that lie in a window, lo <= start and end <= hi, of the same key.

    An equi-join on buckets of ``width``: a window is repeated for every bucket that it touches, an interval lies in the bucket of its start.
    """
    w = windows.select("*", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))).alias("__b"))
    p = points.withColumn("__b", F.floor(F.col(start) / width))
    return p.join(w, [key, "__b"]).where((F.col(start) >= F.col(lo)) & (F.col(end) <= F.col(hi))).drop("__b")


def greedy_match(truth: DataFrame, predicted: DataFrame, group: str, label: str, at: str, tolerance: float) -> DataFrame:
    """One-to-one matches a group: each truth in order takes the first unused prediction of the same label within the tolerance.

    Sequential inside a group and label, so Arrow-batched pandas; groups are clips, of bounded size.  Returns (group, n_truth, n_predicted, n_matched).
    """
    both = truth.select(group, label, at, F.lit(True).alias("is_truth")).union(predicted.select(group, label, at, F.lit(False)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t, p = pdf[pdf["is_truth"]].sort_values(at), pdf[~pdf["is_truth"]].sort_values(at)
        waiting = {k: list(v) for k, v in p.groupby(label)[at]}
        hits = 0
        for k, x in zip(t[label], t[at], strict=True):
            left = waiting.get(k, [])
            found = next((i for i, y in enumerate(left) if abs(y - x) <= tolerance), None)
            if found is not None:
                left.pop(found)
                hits += 1
        return pd.DataFrame({group: [pdf[group].iloc[0]], "n_truth": [len(t)], "n_predicted": [len(p)], "n_matched": [hits]})

    return both.groupBy(group).applyInPandas(run, f"{group} {truth.schema[group].dataType.simpleString()}, n_truth long, n_predicted long, n_matched long")


def positional_zip(a: DataFrame, b: DataFrame, ia: str, ib: str) -> DataFrame:
    """Rows by position; rows beyond the shorter side come with nulls instead of being lost."""
    return a.withColumnRenamed(ia, "__i").join(b.withColumnRenamed(ib, "__i"), "__i", "full_outer").withColumnRenamed("__i", "position")


def ordered_pairs(df: DataFrame, ident: str, within: list[str]) -> DataFrame:
    """All ordered pairs of different rows of a bounded group (a sample, a beam)."""
    a, b = (df.select(*within, F.col(ident).alias(n)) for n in ("a", "b"))
    return a.join(b, within).where("a <> b")


def last_value_or(df: DataFrame, dim: DataFrame, keys: list[str], seq: str, value: str, fallback: Column) -> DataFrame:
    """Left join with the last dimension row of every key; the fallback where there is none, with ``filled`` telling so."""
    last = dim.groupBy(*keys).agg(F.max_by(value, seq).alias("__v"))
    return df.join(last, keys, "left").withColumn("filled", F.col("__v").isNull()).withColumn(value, F.coalesce("__v", fallback)).drop("__v")
