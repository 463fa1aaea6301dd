"""Sequence analytics inside conversations, clips and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.joins import asof_backward


def _micros(c: Column) -> Column:
    """Microseconds of a timestamp with or without zone (the session's zone)."""
    return F.unix_micros(c.cast("timestamp"))


def messages_long(records: DataFrame, ident: str) -> DataFrame:
    """(ident, i, role, content): one row a message, i from 0."""
    return records.select(ident, F.posexplode("messages").alias("i", "m")).select(ident, "i", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def step_sessions(messages: DataFrame, ident: str, inside: list[str]) -> DataFrame:
    """Number the runs of messages whose role is in ``inside``; a run starts where the role before is outside.  Other messages have step null."""
    w = Window.partitionBy(ident).orderBy("i")
    member = F.col("role").isin(inside)
    starts = member & ~F.coalesce(F.lag("role").over(w).isin(inside), F.lit(False))
    return messages.withColumn("__s", F.sum(starts.cast("int")).over(w)).withColumn("step", F.when(member, F.col("__s"))).drop("__s")


def adjacent_repeats(messages: DataFrame, ident: str, allowed: list[str]) -> DataFrame:
    """Messages with the role of the one before, but for the allowed roles."""
    w = Window.partitionBy(ident).orderBy("i")
    return messages.withColumn("__p", F.lag("role").over(w)).where((F.col("role") == F.col("__p")) & ~F.col("role").isin(allowed)).drop("__p")


def response_before_call(messages: DataFrame, ident: str) -> DataFrame:
    """Tool responses with no tool call anywhere before."""
    w = Window.partitionBy(ident).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return messages.withColumn("__c", F.max(F.col("role") == "tool_call").over(w)).where((F.col("role") == "tool_response") & ~F.coalesce("__c", F.lit(False))).drop("__c")


def turn_pairs(messages: DataFrame, ident: str) -> DataFrame:
    """The n-th call of a step with its n-th response; a side without partner has null content.  (ident, step, pos, call, response)"""
    s = step_sessions(messages, ident, ["tool_call", "tool_response"]).where("step is not null")
    s = s.withColumn("pos", F.row_number().over(Window.partitionBy(ident, "step", "role").orderBy("i")))
    return s.groupBy(ident, "step", "pos").agg(F.max(F.when(F.col("role") == "tool_call", F.col("content"))).alias("call"), F.max(F.when(F.col("role") == "tool_response", F.col("content"))).alias("response"))


def last_before(messages: DataFrame, ident: str, target: Column, source: Column, out: str) -> DataFrame:
    """Of every target message the content of the last source message before it."""
    w = Window.partitionBy(ident).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return messages.withColumn(out, F.last(F.when(source, F.col("content")), ignorenulls=True).over(w)).where(target)


def first_after(messages: DataFrame, ident: str, target: Column, source: Column, out: str) -> DataFrame:
    """Of every target message the place of the first source message after it."""
    w = Window.partitionBy(ident).orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    return messages.withColumn(out, F.min(F.when(source, F.col("i"))).over(w)).where(target)


def gap_sessions(df: DataFrame, by: list[str], at: str, tie: str, gap_seconds: int) -> DataFrame:
    """Sessions by gap: a row starts one if the row before is more than the gap away."""
    w = Window.partitionBy(*by).orderBy(at, tie)
    gap = _micros(F.col(at)) - _micros(F.lag(at).over(w))
    return df.withColumn("session", F.sum(F.coalesce(gap > gap_seconds * 1_000_000, F.lit(True)).cast("int")).over(w))


def rising_trigger(points: DataFrame, by: list[str], step: str, value: str, least: float) -> DataFrame:
    """Points whose last two differences both reach ``least``; fewer than three points give none."""
    w = Window.partitionBy(*by).orderBy(step)
    a, b = F.lag(value, 1).over(w), F.lag(value, 2).over(w)
    return points.withColumn("__a", a).withColumn("__b", b).where((F.col(value) - F.col("__a") >= least) & (F.col("__a") - F.col("__b") >= least)).drop("__a", "__b")


def aligned_trigger(evals: DataFrame, train: DataFrame, by: list[str], step: str, value: str, least: float) -> DataFrame:
    """Evaluation points whose last two differences both reach ``least`` while the training curve does not rise.

    The training value of an evaluation point is the last one at or before its step; without one for all three points there is no trigger.
    """
    points = asof_backward(evals.select(*by, step, F.col(value).alias("__e")), train.select(*by, step, F.col(value).alias("__t"), F.monotonically_increasing_id().alias("__o")), by, step, "__t", "__o")
    w = Window.partitionBy(*by).orderBy(step)
    e = [F.col("__e"), F.lag("__e", 1).over(w), F.lag("__e", 2).over(w)]
    t = [F.col("__t"), F.lag("__t", 1).over(w), F.lag("__t", 2).over(w)]
    rises = (e[0] - e[1] >= least) & (e[1] - e[2] >= least) & (t[0] <= t[1]) & (t[1] <= t[2])
    return points.withColumn("__hit", F.coalesce(rises, F.lit(False))).where("__hit").select(*by, step, F.col("__e").alias(value))


def overlap_density(df: DataFrame, by: list[str], start: str, end: str, from_zero: bool = False) -> DataFrame:
    """Time that pairs of intervals share, over the span; a sweep sums level * (level - 1) / 2 over time, so no pairs are formed.

    The span runs to the last end, from the first start or from 0; null for no span.
    """
    ev = df.select(*by, F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d")))).alias("e")).groupBy(*by, F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(*by).orderBy("t")
    level = F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = ev.withColumn("level", level).withColumn("dt", F.lead("t").over(w) - F.col("t"))
    first = F.lit(0.0) if from_zero else F.min("t")
    return x.groupBy(*by).agg(F.round(F.try_divide(F.sum(F.col("level") * (F.col("level") - 1) / 2 * F.col("dt")), F.max("t") - first), 6).alias("density"))


def gap_median(df: DataFrame, by: list[str], start: str, end: str, tie: str, level: str, least: float = 0.08) -> DataFrame:
    """Median level before the gaps of at least ``least`` in which nothing sounds; null with fewer than two."""
    w = Window.partitionBy(*by).orderBy(start, tie)
    x = df.withColumn("__e", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__gap", F.lead(start).over(w) - F.col("__e") >= least)
    return x.groupBy(*by).agg(F.count_if("__gap").alias("n_gaps"), F.when(F.count_if("__gap") >= 2, F.round(F.median(F.when(F.col("__gap"), F.col(level))), 6)).alias("level"))


def net_improvement(df: DataFrame, by: list[str], order: str, value: str, full: float = 0.30) -> DataFrame:
    """(last - first) / full, clamped to 0 .. 1, over non-null values; null under two."""
    v = df.where(F.col(value).isNotNull())
    got = v.groupBy(*by).agg(F.count("*").alias("n"), F.max_by(value, order).alias("__z"), F.min_by(value, order).alias("__a"))
    return got.withColumn("improvement", F.when(F.col("n") >= 2, F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("__z") - F.col("__a")) / full)), 6))).drop("__a", "__z")


def stage_bucket(i: Column, n: Column) -> Column:
    """Early, mid, late by i / (n - 1): below .34, below .67; a single step is early."""
    f = i / (n - 1)
    return F.when(n <= 1, "early").when(f < 0.34, "early").when(f < 0.67, "mid").otherwise("late")


def max_concurrency(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Sweep line; an end at the same time comes before a start."""
    ev = df.select(*by, F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d")))).alias("e")).select(*by, "e.t", "e.d")
    ev = ev.groupBy(*by, "t", "d").agg(F.sum("d").alias("s"))  # pre-aggregated: ties move as one
    w = Window.partitionBy(*by).orderBy("t", "d").rowsBetween(Window.unboundedPreceding, 0)
    return ev.withColumn("level", F.sum("s").over(w)).groupBy(*by).agg(F.max("level").alias("most"))


def overlap_flags(df: DataFrame, by: list[str], start: str, end: str, tie: str) -> DataFrame:
    """Share of neighbours (by start) that overlap by more than 1e-6, and whether none does."""
    w = Window.partitionBy(*by).orderBy(start, tie)
    nxt = F.lead(start).over(w)
    x = df.withColumn("__n", nxt).withColumn("__o", F.col("__n") < F.col(end) - 1e-6)
    return x.groupBy(*by).agg(F.count("__n").alias("n_pairs"), F.round(F.coalesce(F.try_divide(F.count_if("__o"), F.count("__n")), F.lit(0.0)), 6).alias("overlap_share"), (F.count_if("__o") == 0).alias("monophonic"))


def legato_share(df: DataFrame, by: list[str], start: str, end: str, tie: str, close: float = 0.08, apart: float = 0.03) -> DataFrame:
    """Share of next starts within ``close`` of the running last end, among starts more than ``apart`` after the one before."""
    w = Window.partitionBy(*by).orderBy(start, tie)
    x = df.withColumn("__e", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__n", F.lead(start).over(w)).where(F.col("__n") - F.col(start) > apart)
    return x.groupBy(*by).agg(F.count("*").alias("n_steps"), F.round(F.avg((F.col("__n") - F.col("__e") < close).cast("int")), 6).alias("legato"))


def impact_split(df: DataFrame, by: list[str], value: str, tie: str, share: float, rank: str | None = None, least_fine: int = 2) -> DataFrame:
    """Keys by value, descending, are coarse until the running sum before them reaches the share of the total, and so are keys of rank 0 and 1.

    A group with fewer than ``least_fine`` other keys, or without a positive total, is not split: all its keys are coarse.  Null values count as 0.
    """
    v = F.coalesce(F.col(value), F.lit(0.0))
    w, whole = Window.partitionBy(*by).orderBy(F.desc(v), tie), Window.partitionBy(*by)
    before = F.coalesce(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    first = F.coalesce(F.col(rank) <= 1, F.lit(False)) if rank else F.lit(False)
    x = df.withColumn("__c", (before < F.sum(v).over(whole) * share) | first).withColumn("__t", F.sum(v).over(whole))
    return x.withColumn("coarse", F.col("__c") | (F.count_if(~F.col("__c")).over(whole) < least_fine) | (F.col("__t") <= 0)).drop("__c", "__t")


def rate_and_eta(df: DataFrame, by: list[str], at: str, size: str, goal: str) -> DataFrame:
    """Size gained a second since the snapshot before (interval of at least a second), and seconds left; null at first, at no progress and when done."""
    w = Window.partitionBy(*by).orderBy(at)
    seconds = F.greatest(F.lit(1.0), (_micros(F.col(at)) - _micros(F.lag(at).over(w))) / 1e6)
    rate = (F.col(size) - F.lag(size).over(w)) / seconds
    return df.withColumn("rate", F.round(rate, 6)).withColumn("eta", F.when((F.col(size) < F.col(goal)) & (rate > 0), F.round((F.col(goal) - F.col(size)) / rate, 3)))
