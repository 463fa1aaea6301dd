"""The step grammar of agent records (V2, V4): one fold over the message array, no explode, no shuffle, no Python.

A record opens with a system and a user turn.  Then come steps: an optional assistant text, one or more calls, as many responses, and,
if calls of the step read audio files, one user turn that attaches them.  It closes with an assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that results depend on (fixed values).
ROLES = ["system", "user", "assistant", "tool_call", "tool_response"]
AUDIO_SUFFIXES = (".wav", ".mp3", ".flac", ".ogg", ".m4a", ".aac", ".opus")
TASK_RESULT = r'(?s)^<task id="(ses_[0-9a-f]{12}[0-9A-Za-z]{14})" state="completed">\n<task_result>\n(.*)\n</task_result>\n</task>$'

_STATE = "struct<phase:string,calls:int,responses:int,audio:int,attached:int,i:int,errors:array<string>>"


def reads_audio(call: Column, path: str = "filePath") -> Column:
    """Is the call a read of a file with an audio suffix?"""
    name, file = F.get_json_object(call, "$.name"), F.lower(F.get_json_object(call, f"$.arguments.{path}"))
    hit = F.lit(False)
    for s in AUDIO_SUFFIXES:
        hit = hit | F.endswith(file, F.lit(s))
    return F.coalesce((name == "read") & hit, F.lit(False))


def step_errors(messages: Column, attachment: str = "<audio>", path: str = "filePath") -> Column:
    """V2: codes of broken steps in order, ``code:index`` each; an empty array is a valid record, a null one has too few messages.

    ``attachment``: a step with k audio reads is followed by exactly one user turn of this text with its tag k times.
    """
    tag = "<audio>"
    head = attachment.removesuffix(tag)

    def code(name: str, i: Column) -> Column:
        return F.concat(F.lit(name + ":"), i.cast("string"))

    def step(s: Column, m: Column) -> Column:
        role, text, i = F.coalesce(m["role"], F.lit("")), F.coalesce(m["content"], F.lit("")), s["i"]
        later = i >= 2
        closing = later & s["phase"].isin("call", "response") & ~((role == "tool_response") | ((role == "tool_call") & (s["phase"] == "call")))
        attaching = later & (role == "user") & (s["phase"] == "response") & (s["calls"] == s["responses"]) & (s["audio"] > 0)
        right = text == F.concat(F.lit(head), F.repeat(F.lit(tag), s["audio"]))
        found = F.filter(
            F.array(
                F.when(~role.isin(ROLES), code("bad_role", i)),
                F.when(m["content"].isNull(), code("content_not_string", i)),
                F.when((i == 0) & (role != "system"), code("first_not_system", i)),
                F.when((i == 1) & (role != "user"), code("second_not_user", i)),
                F.when((i == 1) & F.contains(text, F.lit(tag)), code("audio_in_prompt", i)),
                F.when(closing & (s["calls"] != s["responses"]), code("calls_and_responses_differ", i)),
                F.when(closing & (s["calls"] == s["responses"]) & (s["audio"] > 0) & ~(attaching & right), code("attachment_missing", i)),
                F.when(later & (role == "assistant") & (F.trim(text) == ""), code("empty_assistant", i)),
                F.when(later & (role == "assistant") & F.contains(text, F.lit(tag)), code("audio_in_assistant", i)),
                F.when(later & (role == "assistant") & (s["phase"] == "assistant"), code("two_assistants", i)),
                F.when(later & (role == "tool_response") & ~s["phase"].isin("call", "response"), code("response_without_call", i)),
                F.when(later & (role == "user") & ~attaching, code("unexpected_user", i)),
                F.when(later & (role == "system"), code("later_system", i)),
            ),
            lambda c: c.isNotNull(),
        )
        new = (role == "tool_call") & (s["phase"] != "call")
        zero = F.lit(0)
        phase = F.when(~later, "open").when(role == "tool_call", "call").when((role == "tool_response") & s["phase"].isin("call", "response"), "response").when(role == "assistant", "assistant").otherwise("other")
        runs = later & role.isin("tool_call", "tool_response") & ~new
        calls = F.when(runs, s["calls"] + (role == "tool_call").cast("int")).when(later & new, F.lit(1)).otherwise(zero)
        audio = F.when(runs, s["audio"]).otherwise(zero) + F.when(later & (role == "tool_call"), reads_audio(text, path).cast("int")).otherwise(zero)
        return F.struct(
            phase.alias("phase"), calls.alias("calls"), F.when(runs, s["responses"] + (role == "tool_response").cast("int")).otherwise(zero).alias("responses"), audio.alias("audio"),
            (s["attached"] + F.when(attaching & right, s["audio"]).otherwise(zero)).alias("attached"), (i + 1).alias("i"), F.concat(s["errors"], found).alias("errors"),
        ).cast(_STATE)

    start = F.struct(F.lit("open").alias("phase"), F.lit(0).alias("calls"), F.lit(0).alias("responses"), F.lit(0).alias("audio"), F.lit(0).alias("attached"), F.lit(0).alias("i"), F.array().cast("array<string>").alias("errors")).cast(_STATE)

    def finish(s: Column) -> Column:
        tail = F.filter(F.array(F.when(s["phase"].isin("call", "response") & (s["calls"] != s["responses"]), code("calls_and_responses_differ", s["i"])), F.when(s["phase"] != "assistant", code("not_closed", s["i"]))), lambda c: c.isNotNull())
        return F.concat(s["errors"], tail)

    return F.when(F.size(messages) >= 3, F.aggregate(messages, start, step, finish))


def argument_errors(call: Column, tools: Column) -> Column:
    """V2: codes of one call against the record's tools, JSON of array<struct<name, parameters map, required array>>: not JSON, other keys than
    name and arguments, unknown tool, missing arguments (all parameters if the tool names none as required), unknown arguments."""
    table = F.from_json(tools, "array<struct<name:string,parameters:map<string,string>,required:array<string>>>")
    name = F.get_json_object(call, "$.name")
    arguments = F.coalesce(F.map_keys(F.from_json(F.get_json_object(call, "$.arguments"), "map<string,string>")), F.array().cast("array<string>"))
    tool = F.try_element_at(F.filter(table, lambda t: t["name"] == name), F.lit(1))
    known = F.coalesce(F.map_keys(tool["parameters"]), F.array().cast("array<string>"))
    needed = F.coalesce(tool["required"], known)
    keys = F.array_sort(F.coalesce(F.map_keys(F.from_json(call, "map<string,string>")), F.array().cast("array<string>")))
    listed = lambda text, xs: F.when(F.size(xs) > 0, F.concat(F.lit(text + ":"), F.array_join(F.array_sort(xs), ",")))
    whole = F.filter(
        F.array(
            F.when(keys != F.array(F.lit("arguments"), F.lit("name")), F.lit("call_keys")), F.when(tools.isNotNull() & tool.isNull(), F.lit("unknown_tool")),
            F.when(tool.isNotNull(), listed("missing_arguments", F.array_except(needed, arguments))), F.when(tool.isNotNull(), listed("unknown_arguments", F.array_except(arguments, known))),
        ),
        lambda c: c.isNotNull(),
    )
    return F.when(F.try_parse_json(call).isNull(), F.array(F.lit("call_not_json"))).otherwise(whole)


def task_result(response: Column) -> list[Column]:
    """V4: session and text of a completed task block, null if the response is none."""
    session = F.regexp_extract(response, TASK_RESULT, 1)
    return [F.when(session != "", session).alias("session_id"), F.when(session != "", F.regexp_extract(response, TASK_RESULT, 2)).alias("result")]
