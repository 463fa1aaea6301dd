"""Validation: every rule appends a code to an array; an empty array is a valid row (V1 to V8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ["user", "assistant", "tool_call", "tool_response"]
REPEATABLE = ["tool_call", "tool_response"]


def _codes(*codes: Column) -> Column:
    return F.filter(F.array(*codes), lambda c: c.isNotNull())


def conversation_errors(ident: Column, messages: Column, audios: Column, roles: list[str] = ROLES, first: str = "user") -> Column:
    """V1 (and, with other roles, the common part of V3): error codes of a multi-turn record, in order.

    All inside one expression over the message array: no explode, no shuffle, no Python.  Null or empty messages stop the check.
    """
    at = lambda i: F.try_element_at(messages, i)
    say = lambda text, i, *more: F.concat(F.lit("message_"), i.cast("string"), F.lit(text), *more)
    content = lambda m: F.coalesce(m["content"], F.lit(""))
    tags = lambda m: (F.length(content(m)) - F.length(F.replace(content(m), F.lit("<audio>"), F.lit("")))) / 7

    def per_message(m: Column, i: Column) -> Column:
        before = F.slice(messages, F.lit(1), i)
        role = m["role"]
        return _codes(
            F.when(~F.coalesce(role.isin(roles), F.lit(False)), say("_invalid_role:", i, F.coalesce(role, F.lit("None")))),
            F.when((role == "tool_response") & ~F.exists(before, lambda x: x["role"] == "tool_call"), say("_tool_response_before_tool_call", i)),
            F.when((i > 0) & (role == at(F.greatest(i, F.lit(1)))["role"]) & ~role.isin(REPEATABLE), say("_duplicate_adjacent_role:", i, role)),
            F.when(m["content"].isNull(), say("_content_not_string", i)),
            F.when((tags(m) > 1) & role.isin("user", "assistant"), say("_multiple_audio_tags", i)),
        )

    total = F.aggregate(messages, F.lit(0.0), lambda s, m: s + tags(m)).cast("int")
    n_audio = F.coalesce(F.when(audios.isNotNull(), F.size(audios)), F.lit(0))
    no_id = _codes(F.when(F.coalesce(ident, F.lit("")) == "", F.lit("id_missing")))
    body = F.concat(
        no_id,
        _codes(
            F.when(audios.isNull(), F.lit("audios_missing_or_not_list")),
            F.when(~at(F.lit(1))["role"].eqNullSafe(first), F.lit(f"first_message_not_{first}")),
            F.when(~at(F.lit(-1))["role"].eqNullSafe("assistant"), F.lit("last_message_not_assistant")),
        ),
        F.flatten(F.transform(messages, per_message)),
        _codes(F.when(total != n_audio, F.concat(F.lit("audio_tag_mismatch:tags="), total.cast("string"), F.lit(":audios="), n_audio.cast("string")))),
        F.filter(F.transform(F.coalesce(audios, F.array().cast("array<string>")), lambda p, i: F.when(F.coalesce(F.trim(p), F.lit("")) == "", F.concat(F.lit("audio_"), i.cast("string"), F.lit("_invalid_path")))), lambda c: c.isNotNull()),
    )
    empty = messages.isNull() | (F.size(messages) <= 0)
    return F.when(empty, F.concat(no_id, F.array(F.lit("messages_missing_or_empty")))).otherwise(body)


def tool_call_errors(content: Column, tools: Column) -> Column:
    """V2: codes of a tool call: not JSON, no name, unknown tool (where the record lists its tools)."""
    name, args = F.get_json_object(content, "$.name"), F.get_json_object(content, "$.arguments")
    known = F.transform(F.from_json(tools, "array<struct<name:string>>"), lambda t: t["name"])
    return _codes(
        F.when(F.try_parse_json(content).isNull(), F.lit("call_not_json")),
        F.when(name.isNull(), F.lit("call_without_name")),
        F.when(args.isNull(), F.lit("call_without_arguments")),
        F.when(tools.isNotNull() & name.isNotNull() & ~F.coalesce(F.array_contains(known, name), F.lit(False)), F.lit("call_unknown_tool")),
    )


def apply_errors(df: DataFrame, errors: str, mode: str) -> DataFrame:
    """V5: ``drop`` keeps the rows without errors, ``abort`` raises at the first action if there is one, ``keep`` returns all."""
    if mode == "drop":
        return df.where(F.size(errors) == 0)
    if mode == "abort":
        return df.where(F.when(F.size(errors) > 0, F.raise_error(F.concat(F.lit("invalid row: "), F.array_join(errors, ", ")))).otherwise(F.lit(True)))
    return df


def required_fields(df: DataFrame, fields: list[str]) -> Column:
    """The names of required fields that are null; a missing column counts as null."""
    return _codes(*[F.when(F.col(f).isNull(), F.lit(f)) if f in df.columns else F.lit(f) for f in fields])


def unchanged_but(df: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """V7: keys whose named columns differ between two versions, by content hash."""
    digest = lambda x: x.select(key, F.sha2(F.to_json(F.struct(*columns)), 256).alias("h"))
    return digest(df).join(digest(other).withColumnRenamed("h", "g"), key).where("h <> g").select(key)
