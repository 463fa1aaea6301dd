"""Token counts with a tokenizer of the caller's choice."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = r"\w+|[^\w\s]"


def token_count(text: Column, encode: Callable[[str], list] | None = None) -> Column:
    """Tokens of a text; 0 for null and empty texts.

    Without ``encode`` words and single marks count, inside the JVM.  ``encode`` maps a text to a list; it is sent to the executors
    and runs over Arrow batches, so it must be picklable (load large vocabularies inside it, once a process).
    """
    if encode is None:
        return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORDS), F.lit(0)))

    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(encode(t)) if t else 0).astype("int32")

    return count(text)
