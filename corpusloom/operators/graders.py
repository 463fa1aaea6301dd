"""The metrics of the graders (G3, G6), each an expression over a record's message array and its label columns.

Nothing is exploded or shuffled: a record's metrics are computed where it is read, and ``grade.overall`` weighs them.  A metric is null where it
does not apply.  Null arrays count as empty, null contents as empty texts; a content that is not JSON has no fields.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

# Words, markers and names that results depend on (fixed values).
DIAGNOSIS_WORDS = ["error", "failed", "traceback", "fix", "correct", "wrong", "typo", "missing"]
PROBE_MARKS = ["render_probes.py", "TrackFX_SetNamedConfigParm", "vital_chunk", "render_vital_preset"]
NO_MATCH_WORDS = ["no_match", "no-match", "partial_match", "partial-match", "re-search", "research", "doesn't contain", "does not contain", "missing"]
CLAIMS_BETTER = r"(?i)\b(closer to the target|now matches|sits (?:back )?in line|locks in|improved|much closer|now captures)\b"
CLAIMS_WORSE = r"(?i)\b(sounds off|doesn'?t sound right|still off|moved away|worse|needs (?:a )?correct)\w*\b"
OMNISCIENT = r"(?i)note \d+|semitone|±\d+|\+\d+ semitone|-\d+ semitone"
PITCH_NAMES = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
SUBSYSTEM_ALIASES = {
    "oscillator": ["oscillator", "oscillators", "osc"], "envelope": ["envelope", "envelopes", "amp envelope", "amp env"], "filter": ["filter", "filters", "low-pass", "lowpass", "high-pass", "highpass", "band-pass"], "lfo": ["lfo", "lfos"],
    "fx": ["fx", "effects", "reverb", "delay", "chorus", "distortion", "compressor", "phaser", "flanger", "eq", "equalizer"], "modulation": ["modulation", "mod matrix", "mod routes", "modulation routes", "routes"], "macro": ["macro", "macros"],
}
HEADERS = ["HEARD:", "HYPOTHESIS:", "PLAN:"]


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{kind}>"))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def _any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def _content(m: Column) -> Column:
    return F.coalesce(m["content"], F.lit(""))


def _mean(rows: Column) -> Column:
    """Mean of an array of doubles to 4 decimals, over the values that are not null; null without any."""
    held = F.filter(rows, lambda x: x.isNotNull())
    return F.round(F.try_divide(F.aggregate(held, F.lit(0.0), lambda s, x: s + x), F.size(held)), 4)


def assistant_turns(messages: Column) -> Column:
    return F.transform(F.filter(_list(messages, "struct<role:string,content:string>"), lambda m: m["role"] == "assistant"), _content)


def clean_share(turns: Column, pattern: str) -> Column:
    """1 - share of turns that match, 1 without turns."""
    hits = F.size(F.filter(turns, lambda t: F.rlike(t, F.lit(pattern))))
    return 1.0 - F.least(F.lit(1.0), hits / F.greatest(F.lit(1), F.size(turns)))


def closing_assistant(messages: Column) -> Column:
    return _flag(F.try_element_at(messages, F.lit(-1))["role"] == "assistant")


def _final(messages: Column) -> Column:
    """The closing assistant text, empty if the record closes otherwise."""
    last = F.try_element_at(messages, F.lit(-1))
    return F.when(last["role"] == "assistant", _content(last)).otherwise("")


def code_mistake_recovery(messages: Column, injected: Column) -> Column:
    """Null unless a mistake was injected; 1 if a response with an error on stderr is followed by a diagnosing assistant turn and then by a call."""
    at = lambda i: F.try_element_at(messages, i)

    def recovers(i: Column) -> Column:
        err = F.coalesce(F.get_json_object(at(i)["content"], "$.stderr"), F.lit(""))
        told = (at(i + 1)["role"] == "assistant") & _any(F.lower(_content(at(i + 1))), DIAGNOSIS_WORDS)
        return F.coalesce((at(i)["role"] == "tool_response") & _any(err, ["Traceback", "Error"]) & told & (at(i + 2)["role"] == "tool_call"), F.lit(False))

    n = F.coalesce(F.size(messages), F.lit(0))
    hit = F.when(n > 2, F.exists(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), recovers)).otherwise(False)
    return F.when(F.coalesce(injected, F.lit(False)), hit.cast("double"))


def common(messages: Column, injected: Column) -> dict[str, Column]:
    """What all graders share."""
    turns = assistant_turns(messages)
    return {
        "snake_case_clean": clean_share(turns, tx.SNAKE_CASE), "format_consistent": clean_share(turns, tx.BOLD_HEADER), "closing_assistant": closing_assistant(messages),
        "no_gt_leak": 1.0 - _flag(F.exists(turns, lambda t: F.rlike(t, F.lit(tx.LEAK)))), "code_mistake_recovery": code_mistake_recovery(messages, injected),
    }


def shell_commands(messages: Column) -> Column:
    """The commands of all shell calls, in order."""
    calls = F.filter(_list(messages, "struct<role:string,content:string>"), lambda m: (m["role"] == "tool_call") & F.lower(F.coalesce(F.get_json_object(m["content"], "$.name"), F.lit(""))).isin("bash"))
    return F.transform(calls, lambda m: F.coalesce(F.get_json_object(m["content"], "$.arguments.command"), F.lit("")))


def has_render_probes(messages: Column) -> Column:
    return _flag(F.exists(shell_commands(messages), lambda c: _any(c, PROBE_MARKS)))


def search_metrics(messages: Column, in_shard: Column, recovered: Column, shortlist: Column, injected: Column) -> dict[str, Column]:
    """search v2; in_shard, recovered and shortlist are name arrays."""
    some = F.coalesce(F.size(in_shard) > 0, F.lit(False)) & in_shard.isNotNull()
    size = lambda c: F.size(_list(c, "string"))
    return common(messages, injected) | {
        "gt_recovery": F.when(some, F.round(size(recovered) / F.size(in_shard), 4)), "result_communicated": _flag(_any(F.lower(_final(messages)), ["shortlist", "candidate"])), "has_render_probes": has_render_probes(messages),
        "shortlist_nonempty": F.when(some, (size(shortlist) > 0).cast("double")),
    }


def judge_metrics(messages: Column, verdict: Column, chosen: Column, pool: Column, slots: Column, truth: Column, missing: Column, right: Column, injected: Column) -> dict[str, Column]:
    """judge v3.  A null verdict counts as good; ``right``: does the chosen tuple match the truth in the pool?"""
    said, pool, chosen, truth = F.coalesce(verdict, F.lit("good")), _list(pool, "string"), _list(chosen, "string"), _list(truth, "string")
    picks, lacks = said.isin("good", "partial_match"), said.isin("no_match", "partial_match")
    held = F.size(F.filter(truth, lambda t: F.array_contains(pool, t)))
    wanted = F.when(held == F.size(truth), "good").when(held > 0, "partial_match").otherwise("no_match")
    turns, final = assistant_turns(messages), _final(messages)
    everything = F.array_join(turns, " ")
    told = _any(final, ["tuple", "PARTIAL_MATCH", "NO_MATCH"])
    full = F.contains(everything, F.lit("tuple")) & _any(everything, ["PARTIAL_MATCH", "NO_MATCH", "slot"])
    return common(messages, injected) | {
        "verdict_correct": F.when(F.size(truth) > 0, (said == wanted).cast("double")), "result_communicated": _flag(told), "output_schema_valid": _flag(told & (full | F.contains(final, F.lit("tuple")))),
        "judge_correct": F.when(picks, _flag(right)), "tuple_size_correct": F.when(picks, _flag(F.size(chosen) == F.coalesce(slots, F.lit(0)))),
        "tuple_names_in_pool": F.when(picks, _flag((F.size(chosen) > 0) & F.forall(chosen, lambda c: F.array_contains(pool, c)))),
        "missing_character_nonempty": F.when(lacks, (F.size(F.regexp_extract_all(F.coalesce(missing, F.lit("")), F.lit(r"\S+"), F.lit(0))) >= 3).cast("double")),
        "no_match_narration_present": F.when(lacks, _flag(F.exists(turns, lambda t: _any(F.lower(t), NO_MATCH_WORDS)))),
        "pool_candidates_discussed": F.when((F.size(pool) > 0) & (F.size(turns) > 0), F.round(F.size(F.filter(pool, lambda p: F.contains(F.lower(everything), F.lower(p)))) / F.size(pool), 4)),
        "has_render_probes": has_render_probes(messages),
    }


def pitch_name(pitch: Column) -> Column:
    """Sharps, octave -1 at 0."""
    return F.concat(F.element_at(F.lit(PITCH_NAMES), (F.pmod(pitch, F.lit(12)) + 1).cast("int")), (F.floor(pitch / 12) - 1).cast("string"))


def _inserted(messages: Column) -> Column:
    """Numbers of notes that successful responses report; the report may be JSON in a field ``stdout``."""
    responses = F.filter(_list(messages, "struct<role:string,content:string>"), lambda m: m["role"] == "tool_response")

    def report(m: Column) -> Column:
        out = F.coalesce(F.get_json_object(m["content"], "$.stdout"), F.lit(""))
        return F.when(F.trim(out) != "", out).otherwise(_content(m))

    ok = F.filter(F.transform(responses, report), lambda r: F.coalesce(F.get_json_object(r, "$.status") == "ok", F.lit(False)))
    return F.filter(F.transform(ok, lambda r: F.get_json_object(r, "$.notes_inserted").try_cast("int")), lambda n: F.coalesce(n > 0, F.lit(False)))


def transcription_metrics(messages: Column, n_notes: Column, pitches: Column, injected: Column) -> dict[str, Column]:
    """transcription; pitches: the true pitches as an int array."""
    commands, reports = shell_commands(messages), _inserted(messages)
    inserts = F.filter(commands, lambda c: F.contains(c, F.lit("MIDI_InsertNote")))
    text = F.concat(F.array_join(assistant_turns(messages), " "), F.lit(" "), F.coalesce(F.try_element_at(inserts, F.lit(1)), F.lit("")))
    true = F.array_distinct(_list(pitches, "int"))
    seen = F.filter(true, lambda p: F.rlike(text, F.concat(F.lit(r"\b"), p.cast("string"), F.lit(r"\b"))) | F.contains(text, pitch_name(p)))
    first = F.try_element_at(messages, F.lit(1))
    return common(messages, injected) | {
        "has_midi_insert": _flag(F.size(inserts) > 0), "result_communicated": _flag(F.size(reports) > 0), "note_count_match": _flag(F.exists(reports, lambda n: n == n_notes)),
        "pitch_coverage": F.when(F.size(true) > 0, F.round(F.size(seen) / F.size(true), 4)), "has_render_listen": _flag((first["role"] == "user") & F.contains(_content(first), F.lit("<audio>"))),
    }


def has_verify_cycle(messages: Column) -> Column:
    """A reading call within the four messages after a shell call that renders or listens."""
    at = lambda i: F.try_element_at(messages, i)
    name = lambda i: F.coalesce(F.when(at(i)["role"] == "tool_call", F.get_json_object(at(i)["content"], "$.name")), F.lit(""))

    def cycle(i: Column) -> Column:
        command = F.coalesce(F.get_json_object(at(i)["content"], "$.arguments.command"), F.lit(""))
        reads = (name(i + 1) == "Read") | (name(i + 2) == "Read") | (name(i + 3) == "Read") | (name(i + 4) == "Read")
        return (F.lower(name(i)) == "bash") & _any(command, ["listen_probe", "render_vital_preset"]) & reads

    n = F.coalesce(F.size(messages), F.lit(0))
    return _flag(F.when(n > 0, F.exists(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), cycle)))


def transcription_v4_metrics(messages: Column, n_notes: Column, pitches: Column, retries: Column, injected: Column) -> dict[str, Column]:
    """transcription with a verification loop."""
    turns = assistant_turns(messages)
    return transcription_metrics(messages, n_notes, pitches, injected) | {
        "has_verify_cycle": has_verify_cycle(messages), "verify_conclusion": _flag(_any(F.lower(F.try_element_at(turns, F.lit(-1))), ["match", "done"])),
        "perceptual_narration_clean": F.when(F.coalesce(retries, F.lit(0)) > 0, 1.0 - _flag(F.exists(turns, lambda t: F.rlike(t, F.lit(OMNISCIENT))))),
    }


def net_improvement(scores: Column) -> Column:
    """clamp((last - first) / 0.30, 0, 1) of the scores that are not null; null with fewer than two."""
    s = F.filter(scores, lambda x: x.isNotNull())
    gain = (F.try_element_at(s, F.lit(-1)) - F.try_element_at(s, F.lit(1))) / 0.30
    return F.when(F.size(s) >= 2, F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), gain)), 4))


def narration_consistency(narrations: Column, scores: Column, determinism: Column) -> Column:
    """Share of narrations that claim better or worse and are not contradicted by a change of more than 0.02; null if unstable or none claims.

    The first narration is held against no change, a later one against the change to the next score.
    """
    s = F.filter(scores, lambda x: x.isNotNull())
    at = lambda i: F.try_element_at(s, i)

    def fair(text: Column, i: Column) -> Column:
        d = F.when(i > 0, at(i + 2) - at(F.greatest(i + 1, F.lit(1)))).otherwise(0.0)
        better, worse = F.rlike(F.coalesce(text, F.lit("")), F.lit(CLAIMS_BETTER)), F.rlike(F.coalesce(text, F.lit("")), F.lit(CLAIMS_WORSE))
        return F.when((i + 1 < F.size(s)) & (better | worse), F.when((better & (d < -0.02)) | (worse & (d > 0.02)), 0.0).otherwise(1.0))

    stable = F.coalesce(determinism > 0.95, F.lit(True)) & (F.size(s) >= 2)
    return F.when(stable, _mean(F.transform(_list(narrations, "string"), fair)))


def set_f1(found: Column, truth: Column) -> Column:
    """F1 of two sets; 1 if there is nothing to find."""
    found, truth = F.array_distinct(_list(found, "string")), F.array_distinct(_list(truth, "string"))
    both = F.size(F.array_intersect(found, truth))
    p, r = F.coalesce(F.try_divide(both, F.size(found)), F.lit(0.0)), F.try_divide(both, F.size(truth))
    return F.when(F.size(truth) == 0, 1.0).otherwise(F.round(2 * p * r / F.greatest(F.lit(1e-9), p + r), 4))


def batch_alignment(batches: Column, subsystem_of: Callable[[Column], Column]) -> Column:
    """batches: array<struct<is_correction, subsystem, param_names>>: share of those that correct nothing whose parameters are all of the
    named subsystem; a batch without parameters is not aligned."""
    plain = F.filter(batches, lambda b: ~F.coalesce(b["is_correction"], F.lit(False)))
    names = lambda b: _list(b["param_names"], "string")
    good = F.filter(plain, lambda b: (F.size(names(b)) > 0) & F.forall(names(b), lambda n: subsystem_of(n).eqNullSafe(b["subsystem"])))
    return F.round(F.try_divide(F.size(good), F.size(plain)), 4)


def verdict_grounded(messages: Column, heading: str = "FINAL ASSESSMENT") -> Column:
    """Does the last assistant turn with the heading name a subsystem?"""
    last = F.lower(F.coalesce(F.try_element_at(F.filter(assistant_turns(messages), lambda t: F.contains(t, F.lit(heading))), F.lit(-1)), F.lit("")))
    words = "|".join(w for ws in SUBSYSTEM_ALIASES.values() for w in ws)
    return F.rlike(last, F.lit(rf"\b(?:{words})\b")).cast("double")


def main_v3_metrics(messages: Column, batches: Column, scores: Column, narrations: Column, determinism: Column, mentioned: Column, truth: Column, subsystem_of: Callable[[Column], Column], mistake: Column, caught: Column, injected: Column) -> dict[str, Column]:
    return common(messages, injected) | {
        "clap_net_improvement": net_improvement(scores), "narration_clap_consistency": narration_consistency(narrations, scores, determinism), "diagnosis_subsystem_coverage": set_f1(mentioned, truth),
        "batch_param_alignment": batch_alignment(batches, subsystem_of), "verdict_grounded": verdict_grounded(messages), "mistake_recovery": F.when(F.coalesce(mistake, F.lit(False)), _flag(caught)),
    }


def section(text: Column, header: str) -> Column:
    """What follows a header, plain or bold, up to the next header; empty without it."""
    name = header.removesuffix(":")
    others = "|".join(h.removesuffix(":") for h in HEADERS)
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?s){name}:(?:\*\*)?(.*?)(?:(?:\*\*)?(?:{others}):|\z)", 1))


def named_share(wanted: Column, texts: Column) -> Column:
    """wanted: array of token arrays, texts: array: share of the places with tokens whose text names one, paired by place; null without any."""
    n = F.least(F.size(wanted), F.size(texts))

    def hit(i: Column) -> Column:
        tokens = F.filter(F.transform(_list(F.try_element_at(wanted, i), "string"), lambda t: F.trim(F.regexp_replace(F.lower(t), "[^a-z0-9 ]+", " "))), lambda t: F.length(t) >= 3)
        text = F.lower(F.coalesce(F.try_element_at(texts, i), F.lit("")))
        return F.when(F.size(tokens) > 0, F.exists(tokens, lambda t: F.rlike(text, F.concat(F.lit(r"\b"), t, F.lit(r"\b")))).cast("double"))

    return F.when(n > 0, _mean(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), hit)))


def main_v2_metrics(messages: Column, listening: Column, planning_only: Column, remaining: Column, changed: Column, scores: Column, injected: Column) -> dict[str, Column]:
    """main v2.  listening: turns with commentary; planning_only: are there other planning turns?  remaining, changed: token arrays by step."""
    turns = _list(listening, "string")
    whole = F.filter(turns, lambda t: F.contains(t, F.lit(HEADERS[0])) & F.contains(t, F.lit(HEADERS[1])) & F.contains(t, F.lit(HEADERS[2])))
    second = F.filter(F.transform(turns, lambda t: _rationale(section(t, "PLAN:"))), lambda s: s.isNotNull())
    pairs = F.when(F.size(second) > 1, F.transform(F.sequence(F.lit(2), F.greatest(F.size(second), F.lit(2))), lambda i: F.when(tx.jaccard(tx.word_set(F.element_at(second, i)), tx.word_set(F.element_at(second, i - 1))) < 0.60, 1.0).otherwise(0.0)))
    return common(messages, injected) | {
        "section_structure": F.when(F.size(turns) > 0, F.round(F.size(whole) / F.size(turns), 4)).otherwise(_flag(planning_only)),
        "plan_alignment_for_overall": named_share(changed, F.transform(turns, lambda t: section(t, "PLAN:"))), "hypothesis_grounding": named_share(remaining, F.transform(turns, lambda t: section(t, "HYPOTHESIS:"))),
        "plan_rationale_unique": _mean(pairs), "clap_net_improvement": net_improvement(scores),
    }


def _rationale(plan: Column) -> Column:
    """The second sentence of more than 15 characters, else the first, or null."""
    said = F.filter(F.transform(F.split(plan, r"\."), F.trim), lambda s: F.length(s) > 15)
    return F.coalesce(F.try_element_at(said, F.lit(2)), F.try_element_at(said, F.lit(1)))


def long_form(metrics: dict[str, Column]) -> Column:
    """array<struct<metric, v>> of the metrics in order of name, to explode."""
    return F.array(*[F.struct(F.lit(m).alias("metric"), metrics[m].cast("double").alias("v")) for m in sorted(metrics)])
