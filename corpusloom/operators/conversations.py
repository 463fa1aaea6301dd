"""Text and conversation transforms."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def chat_prompt(prompt: Column, clips: Column, think: Column) -> Column:
    """A tag for every clip, prefixed ``Audio k: `` if there are several, then the prompt and the head for thinking or not."""
    many = F.size(clips) > 1
    tags = F.transform(clips, lambda c, i: F.concat(F.when(many, F.concat(F.lit("Audio "), (i + 1).cast("string"), F.lit(": "))).otherwise(F.lit("")), F.lit("<audio>")))
    return F.concat_ws("\n", F.array_join(tags, "\n"), prompt, F.when(think, F.lit("<think>")).otherwise(F.lit("<think>\n\n</think>")))


def masked_labels(prompt_ids: Column, target_ids: Column) -> Column:
    """-100 for every prompt token, then the target's ids."""
    return F.concat(F.array_repeat(F.lit(-100), F.size(prompt_ids)), target_ids)


def padded(ids: Column, width: Column, fill: int) -> Column:
    """Filled on the right to a width; longer rows stay."""
    return F.concat(ids, F.array_repeat(F.lit(fill), F.greatest(width - F.size(ids), F.lit(0))))


def keyed_draw(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the key and salt alone."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(":" + salt))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def weighted_choice(draw: Column, choices: list[tuple[str, float]]) -> Column:
    """The choice whose share of the weights holds the draw."""
    total, upto, c = sum(w for _, w in choices), 0.0, F.lit(choices[-1][0])
    limits = []
    for name, w in choices[:-1]:
        upto += w
        limits.append((name, upto / total))
    for name, limit in reversed(limits):
        c = F.when(draw < limit, F.lit(name)).otherwise(c)
    return c


def yes_no_task(labels: Column, universe: Column, key: Column, share: float = 0.12) -> Column:
    """For a keyed share of rows with labels a question about a label, half true, half absent; struct(label, expected), null for others."""
    pick = lambda xs, salt: F.try_element_at(xs, (F.floor(keyed_draw(key, salt) * F.size(xs)) + 1).cast("int"))
    absent = F.array_except(universe, labels)
    true = F.struct(pick(F.array_sort(labels), "t").alias("label"), F.lit("yes").alias("expected"))
    false = F.struct(pick(F.array_sort(absent), "f").alias("label"), F.lit("no").alias("expected"))
    return F.when((F.size(labels) > 0) & (keyed_draw(key, "task") < share), F.when((keyed_draw(key, "side") < 0.5) | (F.size(absent) == 0), true).otherwise(false))


def fill_slots(text: Column, slots: Column) -> Column:
    """Every ``⟦narr:key⟧`` becomes the map's value; unknown keys stay."""
    return F.aggregate(F.map_entries(slots), text, lambda t, e: F.replace(t, F.concat(F.lit("⟦narr:"), e["key"], F.lit("⟧")), F.coalesce(e["value"], F.lit(""))))


def tail_lines(text: Column, lines: int, size: int) -> Column:
    """X11: the last lines, at most ``size`` bytes of them (whole characters), with a mark of what was cut."""
    parts = F.split(text, "\n")
    cut = F.array_join(F.slice(parts, F.greatest(F.size(parts) - lines + 1, F.lit(1)), lines), "\n")
    raw = F.substring(F.encode(cut, "UTF-8"), -size, size)
    inner = lambda i: F.hex(F.substring(raw, i, 1)).between("80", "BF").cast("int")  # noqa: E731  # a byte inside a character
    skip = F.when(inner(1) == 0, 0).when(inner(2) == 0, 1).when(inner(3) == 0, 2).otherwise(3)
    whole = F.decode(F.substring(raw, skip + 1, F.lit(size)), "UTF-8")
    kept = F.when(F.octet_length(cut) > size, whole).otherwise(cut)
    return F.when(F.length(kept) < F.length(text), F.concat(F.lit("[truncated]\n"), kept)).otherwise(text)


def realigned_openers(records: DataFrame, prompts: DataFrame, keys: list[str], prompt: str, messages: str = "messages") -> DataFrame:
    """A record whose first turn is a user's audio gets the prompt that its keys name as that turn's text; ``aligned`` tells which did.

    prompts(keys, prompt): unique keys.  A record without a prompt, or that opens otherwise, stays as it is.
    """
    j = records.join(prompts.select(*keys, F.col(prompt).alias("__p")), keys, "left")
    first = F.try_element_at(F.col(messages), F.lit(1))
    fits = F.coalesce(F.col("__p").isNotNull() & (F.col("__p") != "") & (first["role"] == "user") & F.startswith(first["content"], F.lit("<audio>")), F.lit(False))
    new = F.concat(F.array(F.struct(first["role"].alias("role"), F.concat(F.lit("<audio>\n"), F.col("__p")).alias("content"))), F.slice(messages, F.lit(2), F.greatest(F.size(messages), F.lit(1))))
    return j.withColumn("aligned", fits).withColumn(messages, F.when(fits, new).otherwise(F.col(messages))).drop("__p")


def inject_mistake(messages: Column, broken: Column, fault: Column, diagnosis: Column) -> Column:
    """Before the first call of a record a broken variant of it, the fault it answers with, and a turn that tells what was wrong; the right call
    follows as the retry.  Null ``broken``, or one equal to the call, or a record without a call changes nothing."""
    kind = "struct<role:string,content:string>"
    at = F.array_position(F.transform(messages, lambda m: m["role"]), "tool_call").cast("int")
    call = F.try_element_at(messages, F.when(at > 0, at))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content")).cast(kind)
    new = F.concat(F.slice(messages, F.lit(1), F.greatest(at - 1, F.lit(0))), F.array(turn("tool_call", broken), turn("tool_response", fault), turn("assistant", diagnosis)), F.slice(messages, F.greatest(at, F.lit(1)), F.greatest(F.size(messages), F.lit(1))))
    return F.when(F.coalesce((at > 0) & (broken != call["content"]), F.lit(False)), new).otherwise(messages)


def path_typo(path: Column, key: Column) -> Column:
    """A typo in a file name, by keyed draws: the suffix loses its last letter, or the stem an inner one; null for names too short for it."""
    head, stem, suffix = (F.regexp_extract(path, r"^(.*/)?([^/]+)\.([^./]+)$", i) for i in (1, 2, 3))
    cut = (F.floor(keyed_draw(key, "c") * (F.length(stem) - 1)) + 2).cast("int")
    shorter = F.concat(head, stem, F.lit("."), F.substring(suffix, F.lit(1), F.length(suffix) - 1))
    inner = F.concat(head, F.substring(stem, F.lit(1), cut - 1), F.substring(stem, cut + 1, F.length(stem)), F.lit("."), suffix)
    return F.when((F.length(stem) >= 2) & (F.length(suffix) >= 3), F.when(keyed_draw(key, "k") < 0.5, shorter).otherwise(inner))


def join_parts(parts: Column) -> Column:
    """Multi-part content as one text: text parts as they are, audio parts as their tag; others are left out."""
    shown = F.transform(parts, lambda p: F.when(p["type"] == "text", p["text"]).when(p["type"].isin("audio", "input_audio"), F.lit("<audio>")))
    return F.array_join(F.filter(shown, lambda s: s.isNotNull()), "\n")


def normalised_message(text: Column) -> Column:
    """Session paths, ids, elapsed times and times of day masked, white space runs as one space."""
    t = F.regexp_replace(text, r"/(?:sessions|tmp)/[\w./-]+", "<path>")
    t = F.regexp_replace(t, r"\b[0-9a-f]{8,}\b", "<id>")
    t = F.regexp_replace(t, r"\b\d+(\.\d+)?\s?m?s\b", "<time>")
    t = F.regexp_replace(t, r"\b\d{2}:\d{2}(:\d{2})?\b", "<clock>")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


@F.pandas_udf(T.StringType())
def unified_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Unified diff of two texts, by lines; null sides count as empty."""
    return pd.Series(["\n".join(difflib.unified_diff((x or "").splitlines(), (y or "").splitlines(), lineterm="", n=1)) for x, y in zip(a, b, strict=True)])


def replay_class(expected: Column, got: Column) -> Column:
    """V8: match; acceptable with the same text but for numbers that drift under 25 %, or with over 85 % of the distinct words shared; error; divergent.

    Whole texts are compared, in linear time: twice the shared words over the words of both sides.
    """
    same = F.regexp_replace(expected, r"-?\d+(\.\d+)?", "#") == F.regexp_replace(got, r"-?\d+(\.\d+)?", "#")
    numbers = lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0)), lambda x: x.cast("double"))
    drift = F.forall(F.zip_with(numbers(expected), numbers(got), lambda x, y: F.abs(x - y) <= 0.25 * F.greatest(F.abs(x), F.lit(1e-9))), lambda ok: ok)
    words = lambda c: F.array_distinct(F.split(F.trim(c), r"\s+"))
    ratio = 2 * F.size(F.array_intersect(words(expected), words(got))) / (F.size(words(expected)) + F.size(words(got)))
    return F.when(got.isNull(), "error").when(expected == got, "match").when(F.startswith(F.lower(got), F.lit("error")), "error").when((same & drift) | (ratio > 0.85), "acceptable").otherwise("divergent")


def quantised_notes(notes: DataFrame, clip: str, pitch: str, onset: str, tie: str, grid: float) -> DataFrame:
    """Onsets on the grid (halves to even); of equal onset and pitch in a clip the first stays."""
    q = notes.withColumn("slot", F.rint(F.col(onset) / grid).cast("long"))
    return q.groupBy(clip, "slot", pitch).agg(F.min_by(tie, F.struct(onset, tie)).alias(tie))


def corrupt_notes(df: DataFrame, ident: str, notes: str, salt: str) -> DataFrame:
    """One of six changes a clip, by keyed draw: drop, add, shift, transpose, stretch, swap.  Null for under three notes or if nothing changed.

    ``notes`` is array<struct<pitch int, start_s double, dur_s double>>.
    """
    key = F.col(ident).cast("string")
    n = F.col(notes)
    i = F.floor(keyed_draw(key, salt + "i") * F.size(n)).cast("int")
    change = lambda f: F.transform(n, lambda x, j: F.when(j == i, f(x)).otherwise(x))
    note = lambda p, s, d: F.struct(p.cast("int").alias("pitch"), s.alias("start_s"), d.alias("dur_s"))
    kind = F.floor(keyed_draw(key, salt + "k") * 6)
    at = F.element_at(n, i + 1)
    out = (
        F.when(kind == 0, F.filter(n, lambda x, j: j != i)).when(kind == 1, F.concat(n, F.array(note(at["pitch"] + 7, at["start_s"], at["dur_s"]))))
        .when(kind == 2, change(lambda x: note(x["pitch"], x["start_s"] + 0.25, x["dur_s"]))).when(kind == 3, change(lambda x: note(x["pitch"] + 12, x["start_s"], x["dur_s"])))
        .when(kind == 4, change(lambda x: note(x["pitch"], x["start_s"], x["dur_s"] * 2))).otherwise(F.reverse(n))
    )
    return df.withColumn("changed", F.when((F.size(n) >= 3) & (F.to_json(out) != F.to_json(n)), out))
