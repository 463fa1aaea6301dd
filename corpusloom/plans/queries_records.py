"""Queries: graders' metrics, record grammar, completions of composites, sources and sinks, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import numbers as num
from corpusloom.functions import text as tx
from corpusloom.functions import tokens
from corpusloom.operators import audits as au
from corpusloom.operators import composites as co
from corpusloom.operators import conversations as cv
from corpusloom.operators import grade, graders, grammar, joins, sampling, validate, vectors, windows
from corpusloom.plans.queries_curation import read
from corpusloom.plans.queries_sequences import _NOTES, _SCORED, _notes, _scored
from corpusloom.plans.workspace import materialize, remember, shared_dir
from corpusloom.sources import io
from corpusloom.streaming import incremental as inc

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated query under its name, with its SQL if there is one."""

    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _metrics(df: DataFrame, ident: str, metrics: dict) -> DataFrame:
    """(ident, metric, v) of the metrics that apply."""
    return df.select(ident, F.explode(graders.long_form(metrics)).alias("m")).select(ident, "m.metric", "m.v").where("v is not null")


_TURNS = "list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: coalesce(m.content, '')) as turns, case when messages[-1].role = 'assistant' then coalesce(messages[-1].content, '') else '' end as final, list_transform(list_filter(messages, lambda m: m.role = 'tool_call' and json_valid(m.content)), lambda m: case when lower(m.content->>'$.name') = 'bash' then coalesce(m.content->>'$.arguments.command', '') end) as shell"
_COMMON = r"select k, 'snake_case_clean' as metric, 1.0 - least(1.0, len(list_filter(turns, lambda t: regexp_matches(t, '(^|[^\p{L}\p{N}_])[a-z][a-z0-9]*(?:_[a-z0-9]+){2,}($|[^\p{L}\p{N}_])'))) / greatest(1, len(turns))) as v from r union all select k, 'format_consistent', 1.0 - least(1.0, len(list_filter(turns, lambda t: regexp_matches(t, '\*\*(HEARD|HYPOTHESIS|PLAN):\*\*'))) / greatest(1, len(turns))) from r union all select k, 'closing_assistant', closes::int::double from r union all select k, 'no_gt_leak', 1.0 - (len(list_filter(turns, lambda t: regexp_matches(t, '(?i)\bgt\b\s*[—\-:]|\(gt\b|\bground\s+truth\b|\boracle\b|\bcorrect\s+answer\b|\bknown\s+(right|correct)\b|\bthis\s+is\s+the\s+(target|gt)\b'))) > 0)::int::double from r"
_PROBES = "(len(list_filter(shell, lambda c: contains(c, 'render_probes.py') or contains(c, 'TrackFX_SetNamedConfigParm') or contains(c, 'vital_chunk') or contains(c, 'render_vital_preset'))) > 0)::int::double"


@query(f"with r as (select input_seq as k, meta.gt_in_shard as g, coalesce(messages[-1].role = 'assistant', false) as closes, {_TURNS} from sft_records where task_type = 'search'), m as ({_COMMON} union all select k, 'has_render_probes', {_PROBES} from r union all select k, 'result_communicated', (contains(lower(final), 'shortlist') or contains(lower(final), 'candidate'))::int::double from r union all select k, 'gt_recovery', round(len(list_filter(g, lambda x: contains(final, x))) / len(g), 4) from r where len(g) > 0 union all select k, 'shortlist_nonempty', (len(list_filter(g, lambda x: contains(final, x))) > 0)::int::double from r where len(g) > 0) select k as input_seq, metric, v::double as v from m")
def search_grade_metrics(spark, d):
    """The search grader; a name counts as shortlisted if the closing text has it."""
    r = read(spark, d, "sft_records").where("task_type = 'search'")
    last = F.try_element_at("messages", F.lit(-1))
    final = F.when(last["role"] == "assistant", F.coalesce(last["content"], F.lit(""))).otherwise("")
    got = F.filter("meta.gt_in_shard", lambda x: F.contains(final, x))
    return _metrics(r, "input_seq", graders.search_metrics(F.col("messages"), F.col("meta.gt_in_shard"), got, got, F.lit(False)))


@query(f"with r as (select input_seq as k, meta.n_notes as n, messages, coalesce(messages[-1].role = 'assistant', false) as closes, {_TURNS} from sft_records where task_type = 'transcription'), m as ({_COMMON} union all select k, 'has_midi_insert', (len(list_filter(shell, lambda c: contains(c, 'MIDI_InsertNote'))) > 0)::int::double from r union all select k, 'result_communicated', 0.0 from r union all select k, 'note_count_match', 0.0 from r union all select k, 'has_render_listen', coalesce(messages[1].role = 'user' and contains(coalesce(messages[1].content, ''), '<audio>'), false)::int::double from r union all select k, 'has_verify_cycle', 0.0 from r union all select k, 'verify_conclusion', coalesce(contains(lower(turns[-1]), 'match') or contains(lower(turns[-1]), 'done'), false)::int::double from r) select k as input_seq, metric, v::double as v from m")
def transcription_grade_metrics(spark, d):
    """The transcription grader with its verification loop; the tables hold no insert reports, so three metrics are 0 (tested on fixtures)."""
    r = read(spark, d, "sft_records").where("task_type = 'transcription'")
    return _metrics(r, "input_seq", graders.transcription_v4_metrics(F.col("messages"), F.col("meta.n_notes"), F.lit(None).cast("array<int>"), F.lit(0), F.lit(False)))


@query("with j as (select judge_seq as k, coalesce(verdict, 'good') as v, coalesce(selected_tuple, []) as c, coalesce(map_values(locked_slots), []) as p, coalesce(n_osc_slots, 0) as n, missing_character as mc, coalesce(reasoning, '') as t from judge_results), h as (select *, len(list_filter(c, lambda x: list_contains(p, x))) as held from j), m as (select k, 'verdict_correct' as metric, (v = case when held = len(c) then 'good' when held > 0 then 'partial_match' else 'no_match' end)::int::double as x from h where len(c) > 0 union all select k, 'tuple_size_correct', (len(c) = n)::int::double from h where v in ('good', 'partial_match') union all select k, 'tuple_names_in_pool', (len(c) > 0 and held = len(c))::int::double from h where v in ('good', 'partial_match') union all select k, 'missing_character_nonempty', (len(regexp_extract_all(coalesce(mc, ''), '\\S+')) >= 3)::int::double from h where v in ('no_match', 'partial_match') union all select k, 'no_match_narration_present', (contains(lower(t), 'no_match') or contains(lower(t), 'no-match') or contains(lower(t), 'partial_match') or contains(lower(t), 'partial-match') or contains(lower(t), 're-search') or contains(lower(t), 'research') or contains(lower(t), 'doesn''t contain') or contains(lower(t), 'does not contain') or contains(lower(t), 'missing'))::int::double from h where v in ('no_match', 'partial_match') union all select k, 'pool_candidates_discussed', round(len(list_filter(p, lambda x: contains(lower(t), lower(x)))) / len(p), 4) from h where len(p) > 0 union all select k, 'result_communicated', (contains(t, 'tuple') or contains(t, 'PARTIAL_MATCH') or contains(t, 'NO_MATCH'))::int::double from h) select k as judge_seq, metric, x::double as v from m")
def judge_grade_metrics(spark, d):
    """The judge grader over verdicts; the locked names are the pool, the tuple is its own truth, the reasoning the only turn."""
    j = read(spark, d, "judge_results")
    turn = F.array(F.struct(F.lit("assistant").alias("role"), F.coalesce("reasoning", F.lit("")).alias("content")))
    m = graders.judge_metrics(turn, F.col("verdict"), F.col("selected_tuple"), F.map_values("locked_slots"), F.col("n_osc_slots"), F.col("selected_tuple"), F.col("missing_character"), F.lit(True), F.lit(False))
    shown = ["verdict_correct", "tuple_size_correct", "tuple_names_in_pool", "missing_character_nonempty", "no_match_narration_present", "pool_candidates_discussed", "result_communicated"]
    return _metrics(j, "judge_seq", {k: m[k] for k in shown})


@query(rf"with r as (select input_seq as k, coalesce(messages[-1].role = 'assistant', false) as closes, {_TURNS} from sft_records where task_type = 'main_agent'), m as ({_COMMON} union all select k, 'section_structure', case when len(turns) > 0 then round(len(list_filter(turns, lambda t: contains(t, 'HEARD:') and contains(t, 'HYPOTHESIS:') and contains(t, 'PLAN:'))) / len(turns), 4) else 0.0 end from r union all select k, 'plan_alignment_for_overall', 0.0 from r where len(list_filter(turns, lambda t: len(regexp_extract_all(t, '[a-z]+_[0-9a-z_]+')) > 0)) > 0 union all select k, 'hypothesis_grounding', 0.0 from r where len(list_filter(turns, lambda t: len(regexp_extract_all(t, '[a-z]+_[0-9a-z_]+')) > 0)) > 0) select k as input_seq, metric, v::double as v from m")
def main_grade_metrics(spark, d):
    """The main grader v2 over records: every assistant turn listens, the tokens of a step are the parameters it names (tested on fixtures)."""
    r = read(spark, d, "sft_records").where("task_type = 'main_agent'")
    turns = graders.assistant_turns(F.col("messages"))
    names = F.transform(turns, lambda t: F.regexp_extract_all(t, F.lit("[a-z]+_[0-9a-z_]+"), F.lit(0)))
    return _metrics(r, "input_seq", graders.main_v2_metrics(F.col("messages"), turns, F.lit(False), names, names, F.lit(None).cast("array<double>"), F.lit(False)))


@query()
def record_grammar(spark, d):
    """V2: broken steps by code (tested against a plain loop)."""
    e = read(spark, d, "sft_records").select(F.explode(F.coalesce(grammar.step_errors(F.col("messages")), F.array(F.lit("too_few_messages:0")))).alias("e"))
    return e.groupBy(F.substring_index("e", ":", 1).alias("code")).agg(F.count("*").alias("n"))


@query("with c as (select m.content as c, tools from (select unnest(messages) as m, tools from sft_records) where m.role = 'tool_call' and tools is not null) select case when not json_valid(c) then 'call_not_json' else 'fine' end as code, count(*) as n from c where not json_valid(c) or not (coalesce(c->>'$.name', '') = 'bash' and json_keys(c::json) = ['name', 'arguments'] and json_keys(c::json, '$.arguments') = ['command']) or true group by 1")
def call_arguments(spark, d):
    """V2: arguments of calls against their record's tools; every call here is in order or no JSON."""
    c = read(spark, d, "sft_records").where("tools is not null").select("tools", F.explode("messages").alias("m")).where("m.role = 'tool_call'")
    e = grammar.argument_errors(F.col("m.content"), F.col("tools"))
    return c.groupBy(F.when(F.size(e) > 0, F.array_join(e, ";")).otherwise("fine").alias("code")).agg(F.count("*").alias("n"))


@query("select judge_seq, case when len(coalesce(selected_tuple, [])) < n_osc_slots then 0.0 else n_osc_slots / 4.0 end as score from judge_results where n_osc_slots is not null")
def hard_failed_scores(spark, d):
    """A fidelity below 1 makes the score 0, the row stays; the tuple's share of the slots is the fidelity."""
    j = read(spark, d, "judge_results").where("n_osc_slots is not null")
    fidelity = F.coalesce(F.try_divide(F.coalesce(F.when(F.col("selected_tuple").isNotNull(), F.size("selected_tuple")), F.lit(0)), F.col("n_osc_slots")), F.lit(1.0))
    return j.select("judge_seq", grade.hard_fail(F.col("n_osc_slots") / 4.0, fidelity).alias("score"))


@query("select l_orderkey, l_linenumber, abs(l_discount - l_tax) >= greatest(0.02, 2 * l_quantity / 1000) as changed from lineitem")
def change_table(spark, d):
    """Discount against tax with a noise from the quantity."""
    x = read(spark, d, "lineitem")
    return x.select("l_orderkey", "l_linenumber", grade.changed_enough(F.col("l_discount") - F.col("l_tax"), F.lit(0.02), F.col("l_quantity") / 1000).alias("changed"))


@query("select sample_seq, abs(bpm - 120) <= 1.25 * 20 + 0.3 and abs(target_rms_dbfs + 18) <= 0.5 + 2 as steady from samples where bpm is not null and target_rms_dbfs is not null")
def noise_gates(spark, d):
    """Tempo for the distance, level for the loudness."""
    s = read(spark, d, "samples").where("bpm is not null and target_rms_dbfs is not null")
    return s.select("sample_seq", grade.noise_gate(F.abs(F.col("bpm") - 120), F.lit(20.0), F.col("target_rms_dbfs") + 18, F.lit(2.0)).alias("steady"))


@query("with e as (select vec_id, list_transform(embedding, lambda x: x::double * 100) as a from embeddings), p as (select vec_id, a, list_transform(a, lambda x: x * 0.9 + 1) as b, list_max(a) as m from e), u as (select vec_id, m, unnest(a) as x, unnest(b) as y from p) select vec_id, round(sum(abs(x - y) * pow(10.0, x / 20)) / sum(pow(10.0, x / 20)), 6) as distance from u where x >= m - 80 group by 1")
def spectral_distances(spark, d):
    """A vector's values as levels against a flatter copy."""
    a = F.transform("embedding", lambda x: x.cast("double") * 100)
    return read(spark, d, "embeddings").select("vec_id", F.round(grade.spectral_distance(a, F.transform(a, lambda x: x * 0.9 + 1)), 6).alias("distance"))


@query("with j as (select judge_seq, list_sort(list_distinct(selected_tuple)) as w, list_sort(list_distinct(map_values(locked_slots))) as g from judge_results where selected_tuple is not null and locked_slots is not null) select judge_seq, w = g or (len(list_filter(w, lambda x: not list_contains(g, x))) = 0 and len(list_filter(list_filter(g, lambda x: not contains(x, '7')), lambda x: not list_contains(w, x))) = 0) as same from j")
def action_equivalence(spark, d):
    """Names with a 7 only read."""
    j = read(spark, d, "judge_results").where("selected_tuple is not null and locked_slots is not null")
    got = F.map_values("locked_slots")
    return j.select("judge_seq", co.same_actions(F.col("selected_tuple"), got, F.filter(got, lambda x: ~F.contains(x, F.lit("7")))).alias("same"))


@query(r"with j as (select coalesce(reasoning, '') as t, lower(coalesce(prompt, '')) as h, regexp_extract_all(coalesce(prompt, ''), '-?\d+\.\d+') as v from judge_results), f as (select unnest(list_filter([case when trim(t, ' ') = '' then 'empty' end, case when regexp_matches(t, '(?i)\b(the user|as an ai|the prompt|instructions?)\b') then 'meta' end, case when regexp_matches(t, '(?i)\b(ground truth|oracle|correct answer)\b') then 'leak' end, case when len(list_filter(regexp_extract_all(t, '\x22([^\x22]{3,60})\x22', 1), lambda q: len(string_split(q, ' ')) >= 2 and contains(h, lower(q)))) > 0 then 'quotes' end, case when len(list_filter(regexp_extract_all(t, '-?\d+\.\d+'), lambda n: list_contains(v, n))) > 0 then 'copies values' end], lambda x: x is not null)) as fault from j) select fault, count(*) as n from f group by 1")
def text_fault_counts(spark, d):
    """U8: answers against their prompt, by rule (tested on fixtures)."""
    j = read(spark, d, "judge_results").select(F.explode(co.text_faults(F.col("reasoning"), F.col("prompt"), F.regexp_extract_all(F.coalesce("prompt", F.lit("")), F.lit(r"-?\d+\.\d+"), F.lit(0)))).alias("fault"))
    return j.groupBy("fault").agg(F.count("*").alias("n"))


@query()
def rotated_pools(spark, d):
    """Labels in order as the universe of every hundredth vector, three slices (tested against a plain loop)."""
    scored, _, _ = _scored(spark, d)
    return au.rotated_pool(scored.withColumn("place", F.col("label").cast("long")), "q", "place", "label", 3, 4, 2, 0.2, F.col("q"))


@query("with f as (select regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, list(distinct regexp_extract(path, '([^/]*)$', 1)) as names from file_records where path is not null group by 1) select dir, list_min(list_filter(names, lambda n: contains(regexp_replace(lower(n), '\\.[^.]*$', ''), 'mix'))) as mix from f where len(list_filter(names, lambda n: regexp_replace(lower(n), '\\.[^.]*$', '') in ('mix', 'mixture', 'mixdown', 'full_mix', 'master', 'song'))) = 0")
def folder_mixes(spark, d):
    """The mix file of every folder without a prioritised name."""
    f = read(spark, d, "file_records").where("path is not null").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name")).distinct()
    g = f.groupBy("dir").agg(F.collect_list("name").alias("names")).select("dir", co.mix_file(F.col("names")).alias("mix"), F.exists("names", lambda n: F.regexp_replace(F.lower(n), r"\.[^.]*$", "").isin(co.MIX_NAMES)).alias("named"))
    return g.where("not named").select("dir", "mix")


_CAPS = ["remove_section", "remove_full_song_section", "remove_entire_track", "remove_automation", "swap_instrument_timbre", "remove_fx_processing", "remove_harmony_parts", "quantize_midi_too_hard"]


@query("with s as (select archetype, count(*) as stems, count(clip.midi_path) as midi, coalesce(bool_or(canonical), false) as mix from samples group by 1) select archetype, list_filter(['remove_section', 'remove_full_song_section', 'remove_entire_track', 'remove_automation', 'swap_instrument_timbre', 'remove_fx_processing', 'remove_harmony_parts', 'quantize_midi_too_hard'], lambda c: (c in ('remove_section', 'remove_full_song_section') and (mix or stems > 0)) or (c in ('remove_entire_track', 'remove_automation', 'swap_instrument_timbre', 'remove_fx_processing', 'remove_harmony_parts') and stems >= 2) or (c in ('quantize_midi_too_hard', 'swap_instrument_timbre', 'remove_harmony_parts') and midi > 0)) as caps from s")
def song_capabilities(spark, d):
    """An archetype's takes as stems."""
    s = read(spark, d, "samples").groupBy("archetype").agg(F.count("*").alias("stems"), F.count("clip.midi_path").alias("midi"), F.coalesce(F.bool_or("canonical"), F.lit(False)).alias("mix"))
    return s.select("archetype", co.capabilities(F.col("stems"), F.col("midi"), F.col("mix"), _CAPS).alias("caps"))


@query("select doc_id, replace(replace('a ⟦narr:lang⟧ b ⟦narr:source⟧ ⟦narr:other⟧', '⟦narr:lang⟧', coalesce(lang, '')), '⟦narr:source⟧', coalesce(source, '')) as filled from documents")
def filled_slots(spark, d):
    """X6."""
    slots = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    return read(spark, d, "documents").select("doc_id", cv.fill_slots(F.lit("a ⟦narr:lang⟧ b ⟦narr:source⟧ ⟦narr:other⟧"), slots).alias("filled"))


@query()
def corrupted_notes(spark, d):
    """An order's lines as notes (tested on fixtures)."""
    n = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").cast("int").alias("pitch"), F.col("l_quantity").alias("start_s"), F.col("l_tax").alias("dur_s")))).alias("notes"))
    return cv.corrupt_notes(n, "l_orderkey", "notes", "x").where("changed is not null").select("l_orderkey", F.size("changed").alias("n_notes"))


@query("select input_seq, md5(array_to_string(list_transform(list_filter(messages, lambda m: m.role in ('user', 'assistant', 'tool_call') and (m.role = 'tool_call' or m.content is not null)), lambda m: case when m.role = 'tool_call' then '<audio>' else m.content end), chr(10))) as text_md5 from sft_records")
def joined_parts(spark, d):
    """User and assistant turns as text parts, calls as audio parts, others as parts that are left out."""
    parts = F.transform("messages", lambda m: F.struct(F.when(m["role"].isin("user", "assistant"), "text").when(m["role"] == "tool_call", "audio").otherwise("other").alias("type"), m["content"].alias("text")))
    return read(spark, d, "sft_records").select("input_seq", F.md5(cv.join_parts(parts)).alias("text_md5"))


@query("select count(*) as kept from sft_records where id is not null and split is not null and source is not null")
def valid_rows_kept(spark, d):
    """V5: rows with missing fields are dropped."""
    r = read(spark, d, "sft_records").withColumn("errors", F.lit(None).cast("array<string>"))
    r = r.withColumn("errors", validate.required_fields(r, ["id", "split", "source"]))
    return validate.apply_errors(r, "errors", "drop").agg(F.count("*").alias("kept"))


@query("with r as (select l_orderkey, l_partkey, l_linenumber, max_by(l_shipdate, l_suppkey) as s from lineitem where l_quantity > 25 group by 1, 2, 3) select l.l_orderkey, l.l_linenumber, r.s is null as filled from lineitem l left join r on l.l_orderkey = r.l_orderkey and l.l_partkey = r.l_partkey and l.l_linenumber = r.l_linenumber")
def composite_key_left(spark, d):
    """Three keys."""
    x = read(spark, d, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    got = joins.last_value_or(x.select(*keys), x.where("l_quantity > 25"), keys, "l_suppkey", "l_shipdate", F.lit(None).cast(x.schema["l_shipdate"].dataType))
    return got.select("l_orderkey", "l_linenumber", "filled")


@query("select archetype, count(*) as n, round(avg(bpm), 6) as mean, round(quantile_cont(bpm, 0.5), 6) as median, list_transform(quantile_cont(bpm, [0.1, 0.25, 0.5, 0.75, 0.9]), lambda x: round(x, 6)) as points from samples where bpm is not null group by 1")
def tempo_by_archetype(spark, d):
    """A15."""
    points = F.array(*[F.lit(p) for p in (0.1, 0.25, 0.5, 0.75, 0.9)])
    g = read(spark, d, "samples").where("bpm is not null").groupBy("archetype").agg(F.count("*").alias("n"), F.round(F.avg("bpm"), 6).alias("mean"), F.round(F.median("bpm"), 6).alias("median"), F.percentile("bpm", points).alias("points"))
    return g.withColumn("points", F.transform("points", lambda x: F.round(x, 6)))


@query("with s as (select task_type, input_seq, ('0x' || substr(md5(input_seq::varchar), 1, 8))::bigint as h, count(*) filter (where task_type = 'main_agent') over () as base from sft_records), b as (select *, row_number() over (partition by task_type order by h, input_seq) - 1 as i from s) select task_type, count(*) as n from b where i < case task_type when 'main_agent' then base when 'search' then 1.5 * base when 'judge' then 0.75 * base end group by 1")
def mix_budgets(spark, d):
    """Search records up to 1.5 times, judge records up to 0.75 times the main ones."""
    r = read(spark, d, "sft_records").select("task_type", "input_seq", tx.hash32(F.col("input_seq").cast("string")).alias("h"), F.lit(1).alias("one"))
    base = r.where("task_type = 'main_agent'").count()
    out = None
    for kind, ratio in (("main_agent", 1.0), ("search", 1.5), ("judge", 0.75)):
        part = sampling.take_budget(r.where(F.col("task_type") == kind), "h", "input_seq", "one", ratio * base, 2**32)
        out = part if out is None else out.union(part)
    return out.groupBy("task_type").agg(F.count("*").alias("n"))


@query(f"with {_SCORED} select q, label, row_number() over (partition by q order by cos desc, label)::int as rk from scored qualify rk <= 2")
def beam_of_two(spark, d):
    """T2."""
    return vectors.top_k(_scored(spark, d)[0], "q", "label", 2).select("q", "label", "rk")


@query(f"with {_SCORED}, z as (select label, round(avg(cos), 9) as base from scored group by 1), x as (select q, label, round(cos - base, 9) as delta from scored join z using (label)), s as (select *, row_number() over (partition by q order by delta desc, label) as b from x), k as (select q, label, row_number() over (partition by q order by delta desc, label) as rk from s where delta > 0.3 or b = 1 qualify rk <= 3), h as (select t.q, min(k.rk) as best from truth t left join k on k.q = t.q and k.label = t.label group by 1) select count(*) as n, round(count(best) / greatest(1, count(*)), 6) as any_rate, round(count(*) filter (where best = 1) / greatest(1, count(*)), 6) as top_rate, round(avg(best), 6) as mean_best_rank from h")
def selector_rates(spark, d):
    """The first is forced; rates of what is selected."""
    scored, truth, _ = _scored(spark, d)
    base = scored.join(scored.groupBy("label").agg(F.round(F.avg("cos"), 9).alias("m")), "label").select("q", "label", F.col("m").alias("cos"))
    chosen = vectors.delta_select(scored, base, "q", "label", 0.3, 3, force_first=True)
    return vectors.selection_rates(truth, chosen, truth, "q", "label")


@query(f"with {_NOTES}, p as (select a.user_id, sum(greatest(0.0, least(a.e, b.e) - greatest(a.s, b.s))) as t from notes a join notes b on a.user_id = b.user_id and a.event_id < b.event_id and a.e is not null and b.e is not null group by 1), g as (select user_id, greatest(max(e), max(s)) - min(s) as span from notes where e is not null group by 1) select user_id, round(coalesce(t, 0) / span, 6) as density from g left join p using (user_id)")
def overlap_density(spark, d):
    """U23."""
    return windows.overlap_density(_notes(spark, d)[0].where("e is not null"), ["user_id"], "s", "e")


@query(f"with {_NOTES}, x as (select user_id, s, e, lead(s) over (partition by user_id order by s, event_id) - max(e) over (partition by user_id order by s, event_id rows between unbounded preceding and current row) >= 0.08 as gap from notes) select user_id, count(*) filter (where gap) as n_gaps, case when count(*) filter (where gap) >= 2 then round(median(case when gap then e - s end), 6) end as level from x group by 1")
def gap_levels(spark, d):
    """A note's length stands for its level."""
    return windows.gap_median(_notes(spark, d)[0].withColumn("length", F.col("e") - F.col("s")), ["user_id"], "s", "e", "event_id", "length")


@query("with e as (select user_id, event_id, value from events where event_type <> 'view' and value is not null), t as (select user_id, event_id as step, value as tv from events where event_type = 'view' and value is not null), a as (select e.*, (select max_by(tv, step) from t where t.user_id = e.user_id and t.step <= e.event_id) as t0 from e), w as (select *, lag(value) over x as v1, lag(value, 2) over x as v2, lag(t0) over x as t1, lag(t0, 2) over x as t2 from a window x as (partition by user_id order by event_id)) select user_id, event_id from w where value - v1 >= 2 and v1 - v2 >= 2 and t0 <= t1 and t1 <= t2")
def overfit_trigger(spark, d):
    """Views are the training curve, other events the evaluations."""
    e = read(spark, d, "events").where("value is not null").select("user_id", "event_id", "value", "event_type")
    return windows.aligned_trigger(e.where("event_type <> 'view'").drop("event_type"), e.where("event_type = 'view'").drop("event_type"), ["user_id"], "event_id", "value", 2.0).select("user_id", "event_id")


@query("with p as (select task_type, source, min(id) as prompt from sft_records where id <> '' group by 1, 2) select input_seq, coalesce(p.prompt is not null and messages[1].role = 'user' and starts_with(messages[1].content, '<audio>'), false) as aligned, md5(case when coalesce(p.prompt is not null and messages[1].role = 'user' and starts_with(messages[1].content, '<audio>'), false) then '<audio>' || chr(10) || p.prompt else messages[1].content end) as opener_md5 from sft_records left join p using (task_type, source)")
def realigned_openers(spark, d):
    """The smallest id of a task and source as its prompt."""
    r = read(spark, d, "sft_records")
    p = r.where("id <> ''").groupBy("task_type", "source").agg(F.min("id").alias("prompt"))
    return cv.realigned_openers(r, p, ["task_type", "source"], "prompt").select("input_seq", "aligned", F.md5(F.try_element_at("messages", F.lit(1))["content"]).alias("opener_md5"))


@query("with r as (select input_seq, messages, list_position(list_transform(messages, lambda m: m.role), 'tool_call') as place from sft_records) select input_seq, len(messages) + case when coalesce(place, 0) > 0 then 3 else 0 end as n_messages from r")
def injected_mistakes(spark, d):
    """The first call of a record fails once by a typo, is diagnosed and tried again."""
    r = read(spark, d, "sft_records")
    call = F.try_element_at(F.filter("messages", lambda m: m["role"] == "tool_call"), F.lit(1))["content"]
    return r.select("input_seq", F.size(cv.inject_mistake(F.col("messages"), F.concat(call, F.lit("x")), F.lit("Traceback: name not found"), F.lit("A typo in the name; running it again."))).cast("long").alias("n_messages"))


@query(r"with p as (select file_seq, regexp_extract(path, '^(.*/)?([^/]+)\.([^./]+)$', 1) as head, regexp_extract(path, '^(.*/)?([^/]+)\.([^./]+)$', 2) as stem, regexp_extract(path, '^(.*/)?([^/]+)\.([^./]+)$', 3) as suffix, ('0x' || substr(md5(file_seq::varchar || ':k'), 1, 8))::bigint / 4294967296.0 as k, ('0x' || substr(md5(file_seq::varchar || ':c'), 1, 8))::bigint / 4294967296.0 as c from file_records), q as (select *, (floor(c * (length(stem) - 1)) + 2)::int as cut from p) select file_seq, case when length(stem) >= 2 and length(suffix) >= 3 then case when k < 0.5 then head || stem || '.' || substr(suffix, 1, length(suffix) - 1) else head || substr(stem, 1, cut - 1) || substr(stem, cut + 1) || '.' || suffix end end as typo from q")
def path_typos(spark, d):
    """File names with a typo (tested on fixtures)."""
    return read(spark, d, "file_records").select("file_seq", cv.path_typo(F.col("path"), F.col("file_seq").cast("string")).alias("typo"))


@query(r"select doc_id, len(regexp_extract_all(coalesce(text, ''), '\w+|[^\w\s]'))::int as n from documents where regexp_full_match(coalesce(text, ''), '[\x00-\x7F]*')")
def word_token_counts(spark, d):
    """The default tokenizer over plain texts (marks beyond ASCII differ between the two pattern engines)."""
    t = read(spark, d, "documents").where(F.coalesce("text", F.lit("")).rlike(r"^[\x00-\x7F]*\z"))
    return t.select("doc_id", tokens.token_count(F.col("text")).alias("n"))


@query("select doc_id, len(list_filter(string_split(coalesce(text, ''), ' '), lambda w: w <> ''))::int as n from documents")
def callable_token_counts(spark, d):
    """A tokenizer of the caller's, here the words between spaces."""
    return read(spark, d, "documents").select("doc_id", tokens.token_count(F.col("text"), lambda t: [w for w in t.split(" ") if w]).alias("n"))


@query()
def drawn_specs(spark, d):
    """A thousand independent draws of a region and a nation (tested for range and repeatability)."""
    return au.drawn_specs(read(spark, d, "region"), read(spark, d, "nation"), "r_regionkey", "n_nationkey", 1000, "s")


@query("with i as (select l_orderkey, l_returnflag, l_linenumber, l_orderkey::varchar || '|' || l_returnflag || '|' || l_linenumber::varchar as ident from lineitem), n as (select *, count(*) over (partition by l_orderkey, l_returnflag) as n from i), b as (select *, row_number() over (partition by l_orderkey, l_returnflag order by md5(ident || ':d'), l_linenumber) as rb from n where n >= 2), c as (select *, row_number() over (partition by l_orderkey order by md5(ident || ':dr'), l_returnflag, l_linenumber) as rr from b where rb <= 3), k as (select *, ('0x' || substr(md5(ident || ':dk'), 1, 8))::bigint / 4294967296.0 as u from c where rr <= 2) select l_orderkey, l_linenumber, case when u < 0.35 then 'overshoot' when u < 0.65 then 'undershoot' when u < 0.85 then 'omission' else 'spurious' end as kind from k")
def exact_draws(spark, d):
    """Two keys of every order, at most three of a flag's batch."""
    p = read(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber")
    return au.exact_draw(p, ["l_orderkey"], ["l_returnflag"], "l_linenumber", 2, "d").select("l_orderkey", "l_linenumber", "kind")


@query()
def record_corruption(spark, d):
    """An order's lines of one flag as a batch, the order as the record (tested for its caps)."""
    p = read(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_discount")
    return au.capped_corruption(p, ["l_orderkey", "l_returnflag"], "l_linenumber", "l_discount", 3, "c", ["l_orderkey"]).select("l_orderkey", "l_linenumber", "changed")


@query(r"with c as (select doc_id, coalesce(text, '') as t from documents), n as (select *, regexp_matches(t, '(?i)\d+(?:\.\d+)?\s?(?:hz|khz|db|ms|%|percent)\b|\b\d+\.\d+\b') as num, regexp_matches(t, '\b[a-z][a-z0-9]*(?:_[a-z0-9]+){2,}\b') as par, len(list_filter(string_split_regex(t, '[.;!?]'), lambda s: regexp_matches(s, '(?i)\b(bright|dark)\w*\b') and not regexp_matches(s, '(?i)\b(no|not|never|without|neither|nor|isn''t|wasn''t|doesn''t|didn''t)\b'))) > 0 as dim from c where regexp_full_match(t, '[\x00-\x7F]*')) select doc_id, case when trim(t) = '' then ['empty'] else list_filter([case when num then 'quotes numbers' end, case when par then 'names parameters' end, case when dim and doc_id % 2 = 0 then 'unsupported: brightness' end], lambda x: x is not null) end as problems from n where not regexp_matches(t, '[\n\r\t\f\v]')")
def narration_problems(spark, d):
    """Plain one-line texts; brightness is supported for odd documents."""
    t = read(spark, d, "documents").where(F.coalesce("text", F.lit("")).rlike(r"^[\x00-\x7F]*\z") & ~F.coalesce("text", F.lit("")).rlike(r"[\n\r\t\f\x0B]"))
    return t.select("doc_id", au.narration_problems(F.col("text"), {"brightness": F.col("doc_id") % 2 == 1}, {"brightness": r"\b(bright|dark)\w*\b"}).alias("problems"))


@query()
def claim_contradictions(spark, d):
    """Level claims against measured directions (tested against a plain loop)."""
    measured = F.create_map(F.lit("filter"), F.lit(1), F.lit("level"), F.lit(-1), F.lit("tempo"), F.lit(1))
    c = au.subject_claims(F.col("text"), ["filter", "level", "tempo"], r"\b(rises|louder|brighter|higher|lifts|climbs)\b", r"\b(falls|quieter|darker|lower|drops|softens)\b")
    return read(spark, d, "documents").select("doc_id", au.contradictions(c, measured).alias("labels"))


@query("select event_id, case when v < 0.15 then 'no resonant peak' when v < 0.4 then 'mild resonance' when v < 0.7 then 'prominent resonance' else 'sharp/vocal resonance' end as resonance, case when v * 8 < 0.5 then 'very slow swell' when v * 8 < 2 then 'slow modulation' when v * 8 < 6 then 'mid-rate wobble' else 'fast vibrato-rate' end as rate, case when user_id % 5 <= 1 then 'single voice (no unison)' else (user_id % 5)::varchar || case when v < 0.1 then ' tight stacked voices' when v < 0.3 then ' gently detuned unison voices' else ' widely detuned unison voices' end end as unison, coalesce(['analog-style low-pass', 'analog-style low-pass (alt)', 'dirty low-pass', 'ladder low-pass', 'digital low-pass', 'low-pass', 'band-pass', 'high-pass', 'notch', 'all-pass', 'comb', 'formant'][user_id % 15 + 1], 'filter model ' || (user_id % 15)::varchar) as model from (select event_id, user_id, value / 50 as v from events where value is not null)")
def perceptual_names(spark, d):
    """The further ladders and the filter models."""
    e = read(spark, d, "events").where("value is not null").select("event_id", "user_id", (F.col("value") / 50).alias("v"))
    name = lambda c, ladder: num.bucket(c, *co.LADDERS[ladder])
    return e.select("event_id", name(F.col("v"), "resonance").alias("resonance"), name(F.col("v") * 8, "lfo_rate").alias("rate"), co.unison(F.col("user_id") % 5, F.col("v")).alias("unison"), co.filter_model(F.col("user_id") % 15).alias("model"))


@query(r"select k as key, case when regexp_matches(k, '^(osc_|sample_)') then 'oscillator' when starts_with(k, 'env_1_') then 'envelope' when starts_with(k, 'filter_') then 'filter' when regexp_matches(k, '^(lfo_\d|random_\d|env_[2-6])_') then 'modulation' when regexp_matches(k, '^(chorus|compressor|delay|distortion|eq|filter_fx|flanger|phaser|reverb)_') then 'fx' else 'global' end as section from (select distinct unnest(regexp_extract_all(coalesce(text, ''), '[a-z]+_[a-z0-9_]+')) as k from documents)")
def parameter_sections(spark, d):
    """U1."""
    k = read(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[a-z]+_[a-z0-9_]+"), F.lit(0))).alias("key")).distinct()
    return k.select("key", co.section(F.col("key")).alias("section"))


@query("with s as (select sample_seq, archetype, bpm - avg(bpm) over (partition by source) as v from samples where bpm is not null), c as (select archetype, avg(v) as m, stddev_pop(v) as d from s group by 1) select sample_seq, case when d > 1e-9 then round((v - m) / d, 6) end as z from s left join c using (archetype)")
def centred_z_scores(spark, d):
    """A20 with centring: a source's tempos are centred first, then scored by archetype."""
    s = read(spark, d, "samples").where("bpm is not null").select("sample_seq", "archetype", "source", "bpm")
    return co.z_scores(s, "archetype", "bpm", s, ["source"]).select("sample_seq", "z")


@query("select judge_seq, list_transform(range(1, len(selected_tuple) + 1), lambda i: round((len(selected_tuple) - i + 1) / len(selected_tuple), 6)) as scores from judge_results where len(selected_tuple) > 0 and len(list_distinct(selected_tuple)) = len(selected_tuple)")
def linear_scores(spark, d):
    """Scores made for rankings without repeats."""
    j = read(spark, d, "judge_results").where("size(selected_tuple) > 0 and size(array_distinct(selected_tuple)) = size(selected_tuple)")
    s = co.linear_scores(F.col("selected_tuple"))
    return j.select("judge_seq", F.transform("selected_tuple", lambda x: F.round(s[x], 6)).alias("scores"))


@query("select judge_seq, judge_seq % 5 >= 4 as failed, least(4, judge_seq % 5 + 1)::int as tries from judge_results")
def retried_calls(spark, d):
    """An action that fails as often as its argument says; four attempts."""
    failing: dict[str, int] = {}

    def action(x: str) -> str:
        key, times = x.split("/")
        failing[key] = failing.get(key, 0) + 1
        if failing[key] <= int(times):
            raise ValueError("not yet")
        return "done"

    j = read(spark, d, "judge_results").select("judge_seq", F.concat(F.col("judge_seq").cast("string"), F.lit("/"), (F.col("judge_seq") % 5).cast("string")).alias("x"))
    return inc.call_rows(j, "judge_seq", "x", action).select("judge_seq", "failed", "tries")


def _place(spark, kind: str) -> str:
    path = f"{shared_dir(spark)}/corpusloom-{kind}-{uuid.uuid4().hex}"
    remember(path)
    return path


@query("select doc_id, md5(text) as text_md5 from documents")
def jsonl_round_trip(spark, d):
    """Written as JSON lines and read again."""
    path = _place(spark, "jsonl")
    io.write_jsonl(read(spark, d, "documents").select("doc_id", "text"), path)
    return io.read_jsonl(spark, path, "doc_id long, text string").select("doc_id", F.md5("text").alias("text_md5"))


@query("select count(*) as n_read, count(*) filter (where doc_id % 7 = 0) as n_broken from documents")
def broken_lines(spark, d):
    """Every seventh line is cut; ``keep`` shows what ``skip`` leaves out."""
    path = _place(spark, "broken")
    line = F.to_json(F.struct("doc_id", F.coalesce("source", F.lit("")).alias("source")))
    read(spark, d, "documents").select(F.when(F.col("doc_id") % 7 == 0, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")).write.text(path)
    kept = materialize(io.read_jsonl(spark, path, "doc_id long, source string", on_bad="keep"), "lines")
    return kept.agg(F.count("*").alias("n_read"), F.count("_corrupt_record").alias("n_broken"))


@query("select source as shard, count(*) as n from documents where source is not null group by 1")
def found_manifests(spark, d):
    """JSON lines in nested folders, found below the root, of equal rows one."""
    path = _place(spark, "nested")
    read(spark, d, "documents").where("source is not null").select("doc_id", "source", F.col("source").alias("folder")).write.partitionBy("folder").json(path)
    return io.read_jsonl(spark, path, "doc_id long, source string", recursive=True).select("doc_id", F.col("source").alias("shard")).distinct().groupBy("shard").agg(F.count("*").alias("n"))


@query("select nation, n_files from (select n_name as nation, 1::bigint as n_files from nation)")
def existing_files(spark, d):
    """Rows whose file exists below a folder tree."""
    path = _place(spark, "tree")
    n = read(spark, d, "nation").select("n_name", F.col("n_name").alias("folder"))
    n.write.partitionBy("folder").json(path)
    files = io.list_files(spark, path, ("JSON",)).withColumn("nation", F.regexp_extract("dir", "folder=(.*)$", 1)).groupBy("nation").agg(F.count("*").alias("n_files"))
    return n.select(F.col("n_name").alias("nation")).join(files, "nation")


@query("select source, count(*) as n from (select 'docs' as source from documents union all select 'nations' from nation) group by 1")
def configured_union(spark, d):
    """Two configured sources, one without a root."""
    readers = {"parquet": lambda s, root: s.read.parquet(root).select(F.lit(1).alias("one"))}
    config = [{"name": "docs", "kind": "parquet", "root": f"{d}/documents.parquet"}, {"name": "nations", "kind": "parquet", "root": f"{d}/nation.parquet"}, {"name": "none", "kind": "parquet", "root": f"{d}/missing.parquet"}]
    return io.union_sources(spark, config, readers, strict=False).groupBy("source").agg(F.count("*").alias("n"))


@query("with f as (select path, regexp_extract(path, '([^/]*)$', 1) as name from file_records where path is not null), s as (select regexp_replace(name, '\\.[^.]*$', '') as stem, path from f), a as (select stem, max(path) as path_a from s where path like '%a%' group by 1), b as (select stem, max(path) as path_b from s where path like '%e%' group by 1) select coalesce(a.stem, b.stem) as stem, path_a, path_b from a full join b on a.stem = b.stem")
def paired_files(spark, d):
    """Two listings by stem."""
    f = read(spark, d, "file_records").where("path is not null").select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    return io.paired_files(f.where("path like '%a%'"), f.where("path like '%e%'"))


@query("select label, count(*) as n from embeddings group by 1")
def indexed_vectors(spark, d):
    """Vectors with their metadata, of equal count."""
    e = read(spark, d, "embeddings")
    return io.indexed_rows(e.select("vec_id", "embedding"), e.select("vec_id", "label"), "vec_id").groupBy("label").agg(F.count("*").alias("n"))


@query("with f as (select regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, regexp_extract(path, '([^/]*)$', 1) as name, case length(regexp_extract(path, '(\\.[^./]*)$', 1)) when 3 then '.wav' when 4 then '.mid' end as x from (select distinct path from file_records where path is not null)) select dir, count(*) filter (where x in ('.wav', '.flac', '.mp3', '.ogg')) as n_stems, count(*) filter (where x in ('.mid', '.midi')) as n_midi from f group by 1 having count(*) filter (where x in ('.wav', '.flac', '.mp3', '.ogg')) >= 2 or count(*) filter (where x in ('.mid', '.midi')) > 0")
def song_folders(spark, d):
    """Scanned files by folder, no mix; suffixes of two letters stand for audio, of three for notes."""
    f = read(spark, d, "file_records").where("path is not null").select("path").distinct().select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    size = F.length(F.regexp_extract("name", r"(\.[^.]*)$", 1))
    f = f.withColumn("extension", F.when(size == 3, ".wav").when(size == 4, ".mid"))
    return io.song_folders(f, 2, F.lit(None).cast("string")).select("dir", F.size("stems").cast("long").alias("n_stems"), F.size("midi").cast("long").alias("n_midi"))


@query("select coalesce(split, 'none') as split, count(*) as n_rows from samples group by 1")
def written_splits(spark, d):
    """K4, K7: a folder for each split and the summary."""
    s = read(spark, d, "samples").select("sample_seq", F.coalesce("split", F.lit("none")).alias("split"))
    return io.write_splits(s, _place(spark, "splits")).select("split", "n_rows")


@query("select doc_id, length(coalesce(text, ''))::int as lengths from documents")
def written_lengths(spark, d):
    """K5."""
    path = _place(spark, "lengths")
    io.write_with_lengths(read(spark, d, "documents"), path, F.length(F.coalesce("text", F.lit(""))))
    return spark.read.parquet(path).select("doc_id", "lengths")


@query("select 1 as v, count(*) as n from region union all select 2, count(*) from nation")
def versions(spark, d):
    """K6: a second version beside the first."""
    base = _place(spark, "versions")
    io.write_version(read(spark, d, "region").select(F.lit(1).alias("one")), base, 1)
    io.write_version(read(spark, d, "nation").select(F.lit(1).alias("one")), base, 2)
    return spark.read.parquet(base).groupBy("v").agg(F.count("*").alias("n"))


@query("select event_type, count(*) as n from events where value is not null group by 1")
def appended_batches(spark, d):
    """Bounded batches of files, each written once under its number, run twice."""
    source, base = _place(spark, "source"), _place(spark, "batches")
    e = read(spark, d, "events").select("event_id", "event_type", "value")
    e.repartition(6, "event_id").write.parquet(source)
    for _ in range(2):
        inc.append_batches(spark, source, e.schema, f"{base}/out", f"{base}/state", lambda b: b.where("value is not null"), "event_id", 2)
    return inc.merged(spark, f"{base}/out", "event_id").groupBy("event_type").agg(F.count("*").alias("n"))
