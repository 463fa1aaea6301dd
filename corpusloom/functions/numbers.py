"""Numeric, vector and token-length column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def audio_tokens_mel(seconds: Column) -> Column:
    """Tokens of a clip by its mel frames, at least 1."""
    mel = F.floor(seconds * 100).cast("long")
    return F.greatest(F.lit(1).cast("long"), (F.floor((F.floor((mel - 1) / 2) + 1 - 2) / 2) + 1).cast("long"))


def audio_tokens_seconds(seconds: Column) -> Column:
    """13 tokens a full second and the rest through two halvings and one more; floor division also below zero."""
    frames = F.floor(seconds * 100).cast("long")
    half = lambda x: F.floor((x - 1) / 2) + 1
    return (half(half(half(frames % 100))) + F.floor(frames / 100) * 13).cast("long")


def length_estimate(chars: Column, audio: Column) -> Column:
    """2.5 characters a token, 4 % for the template, and the audio tokens."""
    return (F.floor(F.floor(chars / 2.5) * 1.04) + audio).cast("long")


def round_half_even_rank(p: float, n: Column) -> Column:
    """A5: 0-based nearest rank, halves to even."""
    return F.rint(F.lit(p) * (n - 1)).cast("int")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def normalise_range(x: Column, low: Column, high: Column) -> Column:
    """(x - low) / (high - low); 0 for a zero span, null for an unknown range."""
    return F.when(high == low, F.lit(0.0)).otherwise((x - low) / (high - low))


def bucket(x: Column, limits: list[float], names: list[str]) -> Column:
    """Half-open ladder: the first name whose limit is above x, else the last."""
    c = F.lit(names[-1])
    for limit, name in reversed(list(zip(limits, names, strict=False))):
        c = F.when(x < limit, F.lit(name)).otherwise(c)
    return F.when(x.isNotNull(), c)
