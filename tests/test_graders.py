"""Grader metrics and the step grammar against plain Python."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from corpusloom.operators import grade, graders, grammar

_MSG = "array<struct<role:string,content:string>>"


def call(name, **arguments):
    return ("tool_call", json.dumps({"name": name, "arguments": arguments}))


def values(spark, schema, row, metrics):
    r = spark.createDataFrame([row], schema).select(*[v.alias(k) for k, v in metrics.items()]).first()
    return r.asDict()


def test_search_and_judge(spark):
    m = [("user", "x"), call("bash", command="a vital_chunk b"), ("tool_response", json.dumps({"stderr": "Traceback ..."})), ("assistant", "There was a typo, I Fix it."), call("bash", command="again"), ("tool_response", "ok"), ("assistant", "The Shortlist: my tuple slot pool_a_b, **PLAN:** Ivory")]
    schema = f"m {_MSG}, a array<string>, b array<string>, v string"
    got = values(spark, schema, (m, ["p", "q"], ["p"], None), graders.search_metrics(F.col("m"), F.col("a"), F.col("b"), F.col("b"), F.lit(True)))
    assert got == {"snake_case_clean": 0.5, "format_consistent": 0.5, "closing_assistant": 1.0, "no_gt_leak": 1.0, "code_mistake_recovery": 1.0, "gt_recovery": 0.5, "result_communicated": 1.0, "has_render_probes": 1.0, "shortlist_nonempty": 1.0}
    got = values(spark, schema, (m, None, None, None), graders.search_metrics(F.col("m"), F.col("a"), F.col("b"), F.col("b"), F.lit(None).cast("boolean")))
    assert got["gt_recovery"] is None and got["shortlist_nonempty"] is None and got["code_mistake_recovery"] is None
    pool = F.array(F.lit("Ivory"), F.lit("Reed"))
    judge = lambda v, chosen, truth, missing: values(spark, schema, (m, chosen, truth, v), graders.judge_metrics(F.col("m"), F.col("v"), F.col("a"), pool, F.lit(1), F.col("b"), F.lit(missing), F.lit(True), F.lit(False)))
    good = judge(None, ["Ivory"], ["Ivory"], None)
    assert (good["verdict_correct"], good["tuple_size_correct"], good["tuple_names_in_pool"], good["judge_correct"], good["missing_character_nonempty"], good["pool_candidates_discussed"], good["output_schema_valid"]) == (1, 1, 1, 1, None, 0.5, 1)
    none = judge("no_match", [], ["Other"], "a bright thing")
    assert (none["verdict_correct"], none["tuple_size_correct"], none["missing_character_nonempty"], none["no_match_narration_present"]) == (1, None, 1, 0)
    assert judge("partial_match", ["Other"], ["Ivory", "Other"], "two words")["missing_character_nonempty"] == 0
    empty = judge("good", None, None, None)
    assert empty["verdict_correct"] is None and empty["tuple_names_in_pool"] == 0


def test_transcription(spark):
    done = json.dumps({"stdout": json.dumps({"status": "ok", "notes_inserted": 3})})
    m = [("user", "<audio> go"), call("Bash", command="RPR_MIDI_InsertNote 60"), ("tool_response", done), call("bash", command="listen_probe x"), ("tool_response", "not json"), ("assistant", "look"), call("Read", filePath="a.wav"), ("tool_response", ""), ("assistant", "C#4 matches. Done, one semitone up")]
    got = values(spark, f"m {_MSG}, n int, p array<int>", (m, 3, [60, 61, 62, 60]), graders.transcription_v4_metrics(F.col("m"), F.col("n"), F.col("p"), F.lit(1), F.lit(False)))
    assert {k: got[k] for k in ("has_midi_insert", "result_communicated", "note_count_match", "has_render_listen", "has_verify_cycle", "verify_conclusion", "perceptual_narration_clean", "pitch_coverage")} == {"has_midi_insert": 1, "result_communicated": 1, "note_count_match": 1, "has_render_listen": 1, "has_verify_cycle": 1, "verify_conclusion": 1, "perceptual_narration_clean": 0, "pitch_coverage": 0.6667}
    bare = values(spark, f"m {_MSG}, n int, p array<int>", (None, None, None), graders.transcription_v4_metrics(F.col("m"), F.col("n"), F.col("p"), F.lit(None).cast("int"), F.lit(False)))
    assert bare["has_midi_insert"] == 0 and bare["pitch_coverage"] is None and bare["perceptual_narration_clean"] is None and bare["snake_case_clean"] == 1


def test_main_metrics(spark):
    plan = lambda h, p: f"HEARD: x\nHYPOTHESIS: {h}\nPLAN: {p}"
    turns = [plan("the Filter is off", "Raise the cutoff now please. The brighter tone follows from that change here."), plan("nothing", "Lower the level of it. The brighter tone follows from that change again."), "HEARD: only"]
    m = [("assistant", t) for t in turns]
    schema = f"m {_MSG}, t array<string>, r array<array<string>>, c array<array<string>>, s array<double>"
    got = values(spark, schema, (m, turns, [["filter"], ["lfo"], []], [["cutoff"], ["mix level"], ["x y z"]], [0.1, None, 0.25]), graders.main_v2_metrics(F.col("m"), F.col("t"), F.lit(False), F.col("r"), F.col("c"), F.col("s"), F.lit(False)))
    assert (got["section_structure"], got["hypothesis_grounding"], got["plan_alignment_for_overall"], got["clap_net_improvement"]) == (0.6667, 0.5, 0.3333, 0.5)
    assert got["plan_rationale_unique"] == 0.0  # the second sentences share most words
    b = "array<struct<is_correction:boolean,subsystem:string,param_names:array<string>>>"
    batches = [(False, "filter", ["filter_1_cutoff"]), (False, "filter", ["filter_1_cutoff", "lfo_1"]), (False, "lfo", []), (True, "x", ["y"])]
    row = ([("assistant", "FINAL ASSESSMENT the reverb is off")], batches, [0.5, 0.4, 0.6], ["much closer", "sounds off", "still off", "improved"], ["filter", "lfo"], ["filter"])
    sub = lambda n: F.regexp_extract(n, "^([a-z]+)_", 1)
    got = values(spark, f"m {_MSG}, b {b}, s array<double>, n array<string>, f array<string>, g array<string>", row, graders.main_v3_metrics(F.col("m"), F.col("b"), F.col("s"), F.col("n"), F.lit(None).cast("double"), F.col("f"), F.col("g"), sub, F.lit(True), F.lit(None).cast("boolean"), F.lit(False)))
    assert (got["batch_param_alignment"], got["diagnosis_subsystem_coverage"], got["verdict_grounded"], got["mistake_recovery"], got["clap_net_improvement"]) == (0.3333, 0.6667, 1.0, 0.0, 0.3333)
    assert got["narration_clap_consistency"] == 0.5  # no change at first; then a rise that "sounds off" denies
    assert values(spark, "a array<string>", (None,), {"f": graders.set_f1(F.col("a"), F.col("a"))})["f"] == 1.0
    assert set(grade.WEIGHTS["main_v2"]) <= set(values(spark, schema, (m, turns, None, None, None), graders.main_v2_metrics(F.col("m"), F.col("t"), F.lit(True), F.col("r"), F.col("c"), F.col("s"), F.lit(False))))


def plain_grammar(ms):
    """The grammar, written as a loop."""
    if len(ms) < 3:
        return None
    out, phase, calls, responses, audio = [], "open", 0, 0, 0
    reads = lambda c: c is not None and '"read"' in c and ".wav" in c.lower()
    for i, (role, content) in enumerate(ms):
        t = content or ""
        if role not in grammar.ROLES:
            out.append(f"bad_role:{i}")
        if content is None:
            out.append(f"content_not_string:{i}")
        if i < 2:
            if i == 0 and role != "system":
                out.append("first_not_system:0")
            if i == 1 and role != "user":
                out.append("second_not_user:1")
            if i == 1 and "<audio>" in t:
                out.append("audio_in_prompt:1")
            continue
        leaving = phase in ("call", "response") and not (role == "tool_response" or (role == "tool_call" and phase == "call"))
        attaching = role == "user" and phase == "response" and calls == responses and audio > 0
        right = t == "Attached: " + "<audio>" * audio
        if leaving and calls != responses:
            out.append(f"calls_and_responses_differ:{i}")
        elif leaving and audio and not (attaching and right):
            out.append(f"attachment_missing:{i}")
        if role == "assistant":
            out += [f"empty_assistant:{i}"] * (not t.strip(" ")) + [f"audio_in_assistant:{i}"] * ("<audio>" in t) + [f"two_assistants:{i}"] * (phase == "assistant")
        if role == "tool_response" and phase not in ("call", "response"):
            out.append(f"response_without_call:{i}")
        if role == "user" and not attaching:
            out.append(f"unexpected_user:{i}")
        if role == "system":
            out.append(f"later_system:{i}")
        if role == "tool_call":
            if phase != "call":
                calls = responses = audio = 0
            calls, phase = calls + 1, "call"
            audio += reads(content)
        elif role == "tool_response" and phase in ("call", "response"):
            responses, phase = responses + 1, "response"
        else:
            calls = responses = audio = 0
            phase = "assistant" if role == "assistant" else "other"
            if role == "tool_response":
                responses = 1
    if phase in ("call", "response") and calls != responses:
        out.append(f"calls_and_responses_differ:{len(ms)}")
    if phase != "assistant":
        out.append(f"not_closed:{len(ms)}")
    return out


def test_step_grammar_equals_a_plain_loop(spark):
    rng = random.Random(5)
    pieces = [("assistant", "text"), ("assistant", " "), ("assistant", "<audio>"), call("bash", command="x"), call("read", filePath="A.WAV"), ("tool_response", "r"), ("tool_response", None), ("user", "Attached: <audio>"), ("user", "Attached: <audio><audio>"), ("user", "hm"), ("system", "s"), ("odd", "o"), (None, "n")]
    rows = [[], [("system", "s"), ("user", "u")], [("system", "s"), ("user", "u"), call("read", filePath="a.wav"), ("tool_response", "r"), ("user", "Attached: <audio>"), ("assistant", "done")], [("system", "s"), ("user", "u"), ("assistant", "done")]]
    for _ in range(400):
        rows.append(rng.choice([[("system", "s"), ("user", "u")], [("user", "<audio>"), ("system", "s")]]) + [rng.choice(pieces[:8] if rng.random() < 0.8 else pieces) for _ in range(rng.randrange(1, 9))])
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)] + [(999, None)], f"i int, m {_MSG}")
    got = {r.i: r.e for r in df.select("i", grammar.step_errors(F.col("m"), "Attached: <audio>").alias("e")).collect()}
    assert got[999] is None and got[2] == [] and got[3] == []
    for i, r in enumerate(rows):
        assert got[i] == plain_grammar(r), (r, got[i], plain_grammar(r))


def test_arguments_and_tasks(spark):
    tools = json.dumps([{"name": "bash", "parameters": {"command": "string", "timeout": "int"}, "required": ["command"]}, {"name": "read", "parameters": {"path": "string"}}])
    calls = ["{", json.dumps({"name": "bash", "arguments": {"command": "x"}}), json.dumps({"name": "bash", "arguments": {"cmd": "x"}}), json.dumps({"name": "read", "arguments": {}, "id": 1}), json.dumps({"name": "other", "arguments": {}})]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(calls)], "i int, c string").select("i", grammar.argument_errors(F.col("c"), F.lit(tools)).alias("e"))
    assert [r.e for r in df.orderBy("i").collect()] == [["call_not_json"], [], ["missing_arguments:command", "unknown_arguments:cmd"], ["call_keys", "missing_arguments:path"], ["unknown_tool"]]
    block = '<task id="ses_0123456789abABCDEFGHIJKLMN" state="completed">\n<task_result>\ntwo\nlines\n</task_result>\n</task>'
    r = spark.createDataFrame([(block,), ("x",)], "c string").select(*grammar.task_result(F.col("c"))).collect()
    assert tuple(r[0]) == ("ses_0123456789abABCDEFGHIJKLMN", "two\nlines") and tuple(r[1]) == (None, None)
