"""Text, regular-expression and hash column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and lists that results depend on (fixed values).
REFUSAL = r"(?i)\b(i can(?:no|')t (?:hear|listen|process)|i'm unable to|as an ai|no audio (?:was|is) (?:provided|attached))"
TOO_PRECISE = r"(?i)millisecond|\bms\b|exact (?:second|time|moment|timestamp|timing|interval|duration)|nearest (?:0\.1|tenth|hundredth)|to the (?:tenth|hundredth)"
LEAK = r"(?i)\bgt\b\s*[—\-:]|\(gt\b|\bground\s+truth\b|\boracle\b|\bcorrect\s+answer\b|\bknown\s+(right|correct)\b|\bthis\s+is\s+the\s+(target|gt)\b"
SNAKE_CASE = r"(?U)\b[a-z][a-z0-9]*(?:_[a-z0-9]+){2,}\b"
BOLD_HEADER = r"\*\*(HEARD|HYPOTHESIS|PLAN):\*\*"
NUMERIC_SCORE = r"\d\.\d{3}"


def slug(c: Column) -> Column:
    """Letters and digits, other runs as one underscore, none at the ends, at most 80 characters; ``unnamed`` if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9]+", "_"), "^_+|_+$", "")
    s = F.substring(s, 1, 80)
    return F.when(s == "", F.lit("unnamed")).otherwise(s)


def word_set(c: Column) -> Column:
    """Distinct lower-case words of ASCII letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over united elements of two arrays without repeats; 0 for two empty ones."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.size(F.array_union(a, b)))


def shingles(words: Column, k: int) -> Column:
    """Distinct runs of k neighbouring array elements, joined by a space."""
    last = F.size(words) - k + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(words, i, k), " "))
    return F.when(last >= 1, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def hash32(c: Column) -> Column:
    """The first 8 hexadecimal digits of md5 as an integer."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def hash64(c: Column) -> Column:
    """The first 16 hexadecimal digits of md5 as decimal(20, 0)."""
    return F.conv(F.substring(F.md5(c), 1, 16), 16, 10).cast("decimal(20,0)")


def hash128_mod(c: Column, m: int) -> Column:
    """The whole md5 modulo m, by its two 64-bit halves."""
    half = lambda i: F.conv(F.substring(F.md5(c), i, 16), 16, 10).cast("decimal(20,0)") % F.lit(m).cast("decimal(20,0)")
    return ((half(1).cast("long") * (2**64 % m) + half(17).cast("long")) % m).cast("int")


def unnegated(c: Column, claim: str, negation: str = r"\b(no|not|never|without|neither|nor|isn't|wasn't|doesn't|didn't)\b") -> Column:
    """Does a clause (between . ; ! ?) make the claim without a negation in the same clause?"""
    return F.exists(F.split(c, "[.;!?]"), lambda s: s.rlike("(?i)" + claim) & ~s.rlike("(?i)" + negation))


def last_json_array(c: Column) -> Column:
    """The last bracketed list without inner brackets, or null."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(r"\[[^\[\]]*\]"), F.lit(0)), F.lit(-1))


def masked_numbers(c: Column) -> Column:
    """Numbers replaced by #, white space runs by one space: for comparing tool outputs."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"-?\d+(\.\d+)?", "#"), r"\s+", " "))


def sorted_lines(c: Column) -> Column:
    """The lines in order."""
    return F.array_join(F.array_sort(F.split(c, "\n")), "\n")
