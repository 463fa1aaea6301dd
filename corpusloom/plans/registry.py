"""The core queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.plans import queries_audits, queries_composites, queries_curation, queries_records, queries_sequences

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (queries_curation, queries_records, queries_sequences, queries_composites, queries_audits, queries_records)


def queries() -> dict[str, Query]:
    return {name: q for m in _MODULES for name, q in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in _MODULES for name, q in m.SQL.items()}
