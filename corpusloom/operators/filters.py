"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.aggregates import percentiles


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """name of the first rule that holds, null if none; a null condition doesn't hold.  The order of the rules is part of the result."""
    c = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        c = F.when(rule, F.lit(name)).otherwise(c)
    return c


def cascade(df: DataFrame, rules: list[tuple[str, Column]], column: str = "reason") -> DataFrame:
    """the rows with their drop reason (``kept`` if none): one pass, one CASE expression."""
    return df.withColumn(column, F.coalesce(first_reason(rules), F.lit("kept")))


def starts_with_expected(answer: Column, expected: Column) -> Column:
    """the lower-cased answer without leading ``*``, ``#`` and spaces begins with the expected value."""
    return F.startswith(F.regexp_replace(F.lower(answer), "^[*# ]+", ""), expected)


def exclude_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """drop the rows with one of the values; null values stay."""
    return df.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def learned_thresholds(reference: DataFrame, floors: dict[str, float], quantile: float, scale: float) -> DataFrame:
    """one row with a threshold a column: the larger of a floor and the scaled quantile (clamped to 0 .. 0.5) of the reference."""
    q = min(0.5, max(0.0, quantile))
    out = None
    for c, f in floors.items():
        one = percentiles(reference, c, [], [q]).select(F.greatest(F.lit(float(f)), F.coalesce(F.col("q")[0], F.lit(0.0)) * max(1e-6, scale)).alias(f"t_{c}"))
        out = one if out is None else out.crossJoin(F.broadcast(one))
    return out


def quiet_rows(df: DataFrame, thresholds: DataFrame, peak: str, rms: str, p95: str, active: str) -> DataFrame:
    """mark rows below all of three thresholds, or with a spike in near silence.  ``thresholds`` is one row."""
    low = lambda c: F.col(c) < F.col(f"t_{c}")
    quiet = (low(rms) & low(p95) & low(active)) | (low(peak) & (F.col(rms) < F.col(f"t_{rms}") * 1.5))
    return df.crossJoin(F.broadcast(thresholds)).withColumn("quiet", F.coalesce(quiet, F.lit(False)))


def failure_ratio(df: DataFrame, failed: Column, limit: float) -> DataFrame:
    """counts and whether failed / total is above (not at) the limit; an empty table does not trip."""
    return df.agg(F.count_if(failed).alias("n_failed"), F.count("*").alias("n_total")).withColumn("tripped", F.coalesce(F.try_divide("n_failed", "n_total") > limit, F.lit(False)))


def missing_references(df: DataFrame, refs: Column, listing: DataFrame, key: str) -> DataFrame:
    """exploded references that the listing lacks."""
    return df.select("*", F.explode(refs).alias(key)).join(listing.select(key).distinct(), key, "left_anti")


def changed_scalars(df: DataFrame, values: Column, skip: list[str]) -> Column:
    """a map without the keys to skip and without null values."""
    return F.map_filter(values, lambda k, v: ~k.isin(skip) & v.isNotNull())


def keyword_match(name: Column, query: str) -> Column:
    """every word of the query is part of the lower-cased name; an empty query matches all."""
    return F.forall(F.array(*[F.lit(w) for w in query.lower().split()]) if query.split() else F.array().cast("array<string>"), lambda k: F.contains(F.lower(name), k))


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, value: str, steps: str) -> DataFrame:
    """an override of a discrete parameter (steps not null) is an index, rounded half to even over max(1, steps - 1); others round to 6 decimals."""
    o = overrides.select(F.col(key), F.col(value).alias("o"))
    shown = F.when(F.col(steps).isNotNull(), F.rint(F.coalesce("o", F.col(value)) * F.greatest(F.lit(1), F.col(steps) - 1))).otherwise(F.round(F.coalesce("o", F.col(value)), 6))
    return df.join(o, key, "left").withColumn("shown", shown).drop("o")
