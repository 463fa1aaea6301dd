"""Queries: joins, sequences, validation, vectors and grading, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import aggregates as agg
from corpusloom.operators import dedup, grade, joins, sampling, validate, vectors, windows
from corpusloom.plans.queries_curation import read

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


def messages(spark: SparkSession, d: str) -> DataFrame:
    return windows.messages_long(read(spark, d, "sft_records"), "input_seq")


_M = "m as (select input_seq, x.i as i, x.role as role, x.c as content from (select input_seq, unnest(list_transform(range(1, len(messages) + 1), lambda i: {'i': (i - 1)::int, 'role': messages[i].role, 'c': messages[i].content})) as x from sft_records))"


@query("select o_orderkey, o_orderstatus, c_custkey is null as orphan from orders left join customer on o_custkey = c_custkey")
def orders_with_orphans(spark, d):
    """J1."""
    o, c = read(spark, d, "orders"), read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.require_all(o, c, ["o_custkey"]).select("o_orderkey", "o_orderstatus", "orphan")


@query("select input_seq, id from sft_records s where not exists (select 1 from judge_results j where j.record_id = s.id)")
def unjudged_records(spark, d):
    """J2."""
    done = read(spark, d, "judge_results").select(F.col("record_id").alias("id"))
    return read(spark, d, "sft_records").join(done, "id", "left_anti").select("input_seq", "id")


@query("with j as (select record_id as id, max_by(verdict, judge_seq) as verdict from judge_results where record_id is not null group by 1) select input_seq, coalesce(verdict, 'unjudged') as verdict, verdict is null as filled from sft_records left join j using (id)")
def last_verdict(spark, d):
    """The last row of a key wins, with a fallback."""
    j = read(spark, d, "judge_results").where("record_id is not null").select(F.col("record_id").alias("id"), "judge_seq", "verdict")
    return joins.last_value_or(read(spark, d, "sft_records").select("input_seq", "id"), j, ["id"], "judge_seq", "verdict", F.lit("unjudged")).select("input_seq", "verdict", "filled")


@query("select distinct l_orderkey, l_linenumber, l_partkey from lineitem l where exists (select 1 from part p where p.p_partkey = l.l_partkey and p_size = 10)")
def semi_join_parts(spark, d):
    """J5."""
    p = read(spark, d, "part").where("p_size = 10").select(F.col("p_partkey").alias("l_partkey"))
    return read(spark, d, "lineitem").join(p, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey").distinct()


@query("with l as (select judge_seq, prompt from judge_results where prompt is not null), r as (select input_seq, list_filter(messages, lambda m: m.role = 'user')[1].content as prompt from sft_records), rc as (select prompt, count(*) as n from r group by 1), x as (select judge_seq, null::bigint as input_seq, coalesce(n, 0) as n from l left join rc using (prompt) union all select null, input_seq, 0 from r where not exists (select 1 from l where l.prompt = r.prompt)) select judge_seq, input_seq, n as n_candidates, case when judge_seq is null then 'unused' when n = 0 then 'none' when n > 1 then 'ambiguous' end as problem from x")
def prompt_match_once(spark, d):
    """J7, V4."""
    j = read(spark, d, "judge_results").where("prompt is not null").select("judge_seq", "prompt")
    users = F.filter("messages", lambda m: m["role"] == "user")
    r = read(spark, d, "sft_records").select("input_seq", F.try_element_at(users, F.lit(1))["content"].alias("prompt"))
    return joins.matched_once(j, r, ["prompt"], "judge_seq", "input_seq")


@query("with a as (select doc_id, md5(text) as h from documents where doc_id % 3 <> 0), b as (select doc_id, md5(case when doc_id % 5 = 0 then text || '!' else text end) as h from documents where doc_id % 4 <> 0) select doc_id, case when b.doc_id is null then 'missing' when a.doc_id is null then 'extra' when a.h is not distinct from b.h then 'identical' else 'changed' end as state from a full join b using (doc_id)")
def manifest_diff(spark, d):
    """J8."""
    t = read(spark, d, "documents")
    a = t.where("doc_id % 3 <> 0").select("doc_id", F.md5("text").alias("h"))
    b = t.where("doc_id % 4 <> 0").select("doc_id", F.md5(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"))
    return joins.manifest_diff(a, b, "doc_id", "h")


@query("with v as (select s_nationkey as n, l_partkey as key, avg(l_discount) as v from lineitem join supplier on s_suppkey = l_suppkey group by 1, 2), y as (select coalesce(a.n, b.n - 1) as nation, coalesce(a.key, b.key) as key, a.v as va, b.v as vb from (select * from v where n + 1 in (select n_nationkey from nation)) a full join (select * from v where n - 1 in (select n_nationkey from nation)) b on b.n = a.n + 1 and b.key = a.key) select nation, key, round(va, 6) as va, round(vb, 6) as vb from y where va is null or vb is null or round(abs(va - vb), 9) > round(greatest(0.005, abs(va) * 0.01), 9)")
def map_tolerance_diff(spark, d):
    """Mean discount by part of every nation against the next one, all parts, in long form."""
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    v = read(spark, d, "lineitem").join(s, "l_suppkey").groupBy("nation", F.col("l_partkey").alias("key")).agg(F.avg("l_discount").alias("v"))
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("nation"))
    a = v.join(n.select((F.col("nation") - 1).alias("nation")), "nation", "left_semi")
    b = v.withColumn("nation", F.col("nation") - 1).join(n, "nation", "left_semi")
    return joins.long_diff(a, b, ["nation", "key"], "v").select("nation", "key", F.round("va", 6).alias("va"), F.round("vb", 6).alias("vb"))


@query("with n as (select n_nationkey, n_name, n_regionkey from nation) select a.n_regionkey, a.n_name as a, b.n_name as b from n a join n b on a.n_regionkey = b.n_regionkey and a.n_name <> b.n_name")
def ordered_pairs(spark, d):
    """Within a region."""
    return joins.ordered_pairs(read(spark, d, "nation"), "n_name", ["n_regionkey"])


@query("with p as (select user_id, ts, value, event_id from events where event_type = 'purchase'), v as (select user_id, ts, event_id from events where event_type = 'view'), u as (select user_id, ts, event_id as e, null::double as val, 1 as s from v union all select user_id, ts, event_id, value, 0 from p), w as (select *, last_value(val ignore nulls) over (partition by user_id order by ts, s, case when s = 0 then e end nulls first rows between unbounded preceding and current row) as got from u) select e as event_id, got as value from w where s = 1")
def asof_purchase(spark, d):
    """The last purchase value before each view of the user."""
    e = read(spark, d, "events")
    left = e.where("event_type = 'view'").select("user_id", "ts", "event_id")
    right = e.where("event_type = 'purchase'").select("user_id", "ts", "value", F.col("event_id").alias("o"))
    return joins.asof_backward(left, right, ["user_id"], "ts", "value", "o").select("event_id", "value")


_NOTES = "notes as (select event_id, user_id, epoch_us(ts) / 1000000.0 as s, epoch_us(ts) / 1000000.0 + 30 + value as e from events where event_type = 'click'), wins as (select user_id, event_id as w, epoch_us(ts) / 1000000.0 as lo, epoch_us(ts) / 1000000.0 + 3600 as hi from events where event_type = 'signup')"


def _notes(spark, d):
    e = read(spark, d, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return e.where("event_type = 'click'").select("event_id", "user_id", at.alias("s"), (at + 30 + F.col("value")).alias("e")), e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("w"), at.alias("lo"), (at + 3600).alias("hi"))


@query(f"with {_NOTES} select n.event_id, w.w from notes n join wins w using (user_id) where n.s >= w.lo and n.e <= w.hi")
def contained_intervals(spark, d):
    """Clicks that lie inside an hour after a sign-up of the user."""
    n, w = _notes(spark, d)
    return joins.contained_intervals(n, w, "user_id", "s", "e", "lo", "hi", 3600.0).select("event_id", "w")


@query(f"with {_NOTES}, x as (select user_id, e, lead(s) over (partition by user_id order by s, event_id) as n from notes) select user_id, count(n) as n_pairs, round(coalesce(count(*) filter (where n < e - 1e-6) / nullif(count(n), 0), 0), 6) as overlap_share, count(*) filter (where n < e - 1e-6) = 0 as monophonic from x group by 1")
def interval_overlap(spark, d):
    """J16, W12, W13."""
    return windows.overlap_flags(_notes(spark, d)[0], ["user_id"], "s", "e", "event_id")


@query(f"with {_NOTES}, v as (select user_id, s as t, 1 as d from notes union all select user_id, e, -1 from notes), w as (select user_id, sum(d) over (partition by user_id order by t, d rows between unbounded preceding and current row) as l from v) select user_id, max(l)::bigint as most from w group by 1")
def sweep_line(spark, d):
    """U22."""
    return windows.max_concurrency(_notes(spark, d)[0], ["user_id"], "s", "e")


@query(f"with {_NOTES}, x as (select user_id, s, max(e) over w as le, lead(s) over (partition by user_id order by s, event_id) as n from notes window w as (partition by user_id order by s, event_id rows between unbounded preceding and current row)) select user_id, count(*) as n_steps, round(avg(case when n - le < 0.08 then 1 else 0 end), 6) as legato from x where n - s > 0.03 group by 1")
def legato_share(spark, d):
    """U24."""
    return windows.legato_share(_notes(spark, d)[0], ["user_id"], "s", "e", "event_id")


@query()
def greedy_note_match(spark, d):
    """Clicks against views of a user with the same whole value, within a day; precision, recall and F1."""
    e = read(spark, d, "events").withColumn("label", F.floor("value").cast("long")).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6))
    m = joins.greedy_match(e.where("event_type = 'click'"), e.where("event_type = 'view'"), "user_id", "label", "at", 86_400.0)
    return m.select("user_id", "n_truth", "n_predicted", "n_matched", *agg.precision_recall(F.col("n_matched"), F.col("n_predicted"), F.col("n_truth")))


@query("with a as (select c_name, row_number() over (order by c_custkey) - 1 as i from customer), b as (select s_name, row_number() over (order by s_suppkey) - 1 as i from supplier) select coalesce(a.i, b.i) as position, c_name, s_name from a full join b on a.i = b.i")
def positional_zip(spark, d):
    """All customers with all suppliers."""
    return _zipped(read(spark, d, "customer"), read(spark, d, "supplier"))


def _zipped(customers: DataFrame, suppliers: DataFrame) -> DataFrame:
    a = sampling.with_row_number(customers, "c_custkey").select("c_name", F.col("i").cast("long").alias("i"))
    b = sampling.with_row_number(suppliers, "s_suppkey").select("s_name", F.col("i").cast("long").alias("j"))
    return joins.positional_zip(a, b, "i", "j")


@query(f"with {_M}, s as (select *, role in ('assistant', 'tool_call') as inside, case when role in ('assistant', 'tool_call') and coalesce(lag(role) over (partition by input_seq order by i) not in ('assistant', 'tool_call'), true) then 1 else 0 end as b from m), t as (select *, sum(b) over (partition by input_seq order by i) as step from s) select input_seq, step::bigint as step, count(*) as n, min(i) as first_i from t where inside group by 1, 2")
def step_sessions(spark, d):
    """W1."""
    s = windows.step_sessions(messages(spark, d), "input_seq", ["assistant", "tool_call"]).where("step is not null")
    return s.groupBy("input_seq", "step").agg(F.count("*").alias("n"), F.min("i").alias("first_i"))


@query(f"with {_M}, p as (select *, lag(role) over (partition by input_seq order by i) as b from m where role not like 'tool%') select input_seq, i, role from p where role = b and role <> 'system'")
def role_adjacency(spark, d):
    """Among the turns that are no tool turns."""
    return windows.adjacent_repeats(messages(spark, d).where("role not like 'tool%'"), "input_seq", ["system"]).select("input_seq", "i", "role")


@query(f"with {_M}, p as (select *, max(case when role = 'tool_call' then 1 else 0 end) over (partition by input_seq order by i rows between unbounded preceding and 1 preceding) as b from m) select count(*) as n from p where role = 'tool_response' and coalesce(b, 0) = 0")
def early_responses(spark, d):
    """W3."""
    return windows.response_before_call(messages(spark, d), "input_seq").agg(F.count("*").alias("n"))


@query(f"with {_M}, s as (select *, case when role in ('tool_call', 'tool_response') and coalesce(lag(role) over (partition by input_seq order by i) not in ('tool_call', 'tool_response'), true) then 1 else 0 end as b from m), t as (select *, sum(b) over (partition by input_seq order by i) as step from s), u as (select *, row_number() over (partition by input_seq, step, role order by i) as pos from t where role in ('tool_call', 'tool_response')) select input_seq, step::bigint as step, pos::int as pos, md5(max(case when role = 'tool_call' then content end)) as call_md5, md5(max(case when role = 'tool_response' then content end)) as response_md5 from u group by 1, 2, 3")
def turn_pairing(spark, d):
    """W17."""
    return windows.turn_pairs(messages(spark, d), "input_seq").select("input_seq", "step", "pos", F.md5("call").alias("call_md5"), F.md5("response").alias("response_md5"))


@query(f"with {_M}, p as (select *, last_value(case when role = 'tool_call' then content end ignore nulls) over (partition by input_seq order by i rows between unbounded preceding and 1 preceding) as call, min(case when role = 'tool_response' then i end) over (partition by input_seq order by i rows between 1 following and unbounded following) as nxt from m) select input_seq, i, md5(call) as call_md5, nxt from p where role = 'assistant'")
def neighbouring_calls(spark, d):
    """Of every assistant turn the call before it and the next response."""
    m = messages(spark, d)
    a = windows.last_before(m, "input_seq", F.col("role") == "assistant", F.col("role") == "tool_call", "call").select("input_seq", "i", F.md5("call").alias("call_md5"))
    b = windows.first_after(m, "input_seq", F.col("role") == "assistant", F.col("role") == "tool_response", "nxt").select("input_seq", "i", "nxt")
    return a.join(b, ["input_seq", "i"])


@query(f"with {_M} select input_seq, max_by(content, i) as last_call from m where role = 'tool_call' and content like '%set.py%' group by 1")
def last_matching_call(spark, d):
    """W14."""
    return messages(spark, d).where("role = 'tool_call' and content like '%set.py%'").groupBy("input_seq").agg(F.max_by("content", "i").alias("last_call"))


@query("with g as (select *, case when epoch_us(ts) - lag(epoch_us(ts)) over w <= 1800000000 then 0 else 1 end as b from events window w as (partition by user_id order by ts, event_id)), s as (select *, sum(b) over (partition by user_id order by ts, event_id) as session from g) select user_id, session::bigint as session, count(*) as n, round(sum(value), 6) as total from s group by 1, 2")
def gap_sessions(spark, d):
    """Sessions of 30 minutes over events."""
    return windows.gap_sessions(read(spark, d, "events"), ["user_id"], "ts", "event_id", 1800).groupBy("user_id", "session").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("with p as (select user_id, event_id, value, lag(value, 1) over w as a, lag(value, 2) over w as b from events window w as (partition by user_id order by event_id)) select user_id, event_id from p where value - a >= 5 and a - b >= 5")
def rising_trigger(spark, d):
    """W9."""
    return windows.rising_trigger(read(spark, d, "events"), ["user_id"], "event_id", "value", 5.0).select("user_id", "event_id")


@query("select user_id, count(value) as n, case when count(value) >= 2 then round(greatest(0.0, least(1.0, (max_by(value, event_id) - min_by(value, event_id)) / 0.30)), 6) end as improvement from events where value is not null group by 1")
def net_improvement(spark, d):
    """W10."""
    return windows.net_improvement(read(spark, d, "events"), ["user_id"], "event_id", "value")


@query(f"with {_M}, n as (select *, count(*) over (partition by input_seq) as n from m) select role, case when n <= 1 then 'early' when i / (n - 1) < 0.34 then 'early' when i / (n - 1) < 0.67 then 'mid' else 'late' end as stage, count(*) as n_messages from n group by 1, 2")
def stage_buckets(spark, d):
    """W11."""
    m = messages(spark, d).withColumn("n", F.count("*").over(Window.partitionBy("input_seq")))
    return m.groupBy("role", windows.stage_bucket(F.col("i"), F.col("n")).alias("stage")).agg(F.count("*").alias("n_messages"))


@query("with x as (select p_type, p_partkey, coalesce(sum(p_retailprice) over (partition by p_type order by p_retailprice desc, p_partkey rows between unbounded preceding and 1 preceding), 0) < 0.8 * sum(p_retailprice) over (partition by p_type) or p_size <= 1 as c, sum(p_retailprice) over (partition by p_type) as t from part) select p_type, p_partkey, c or count(*) filter (where not c) over (partition by p_type) < 2 or t <= 0 as coarse from x")
def impact_split(spark, d):
    """The size stands for the rank of a key."""
    return windows.impact_split(read(spark, d, "part"), ["p_type"], "p_retailprice", "p_partkey", 0.8, "p_size").select("p_type", "p_partkey", "coarse")


_ERR = """list_filter([case when not coalesce(m.role in ('user', 'assistant', 'tool_call', 'tool_response'), false) then 'message_' || i || '_invalid_role:' || coalesce(m.role, 'None') end,
 case when m.role = 'tool_response' and len(list_filter(messages[1:i], lambda y: y.role = 'tool_call')) = 0 then 'message_' || i || '_tool_response_before_tool_call' end,
 case when i > 0 and m.role = messages[i].role and m.role not in ('tool_call', 'tool_response') then 'message_' || i || '_duplicate_adjacent_role:' || m.role end,
 case when m.content is null then 'message_' || i || '_content_not_string' end,
 case when (length(m.content) - length(replace(m.content, '<audio>', ''))) / 7 > 1 and m.role in ('user', 'assistant') then 'message_' || i || '_multiple_audio_tags' end], lambda e: e is not null)"""


@query(
    f"""with b as (select input_seq, id, messages, audios, coalesce(list_sum(list_transform(messages, lambda m: (length(coalesce(m.content, '')) - length(replace(coalesce(m.content, ''), '<audio>', ''))) / 7)), 0)::int as tags, coalesce(len(audios), 0)::int as n_audio from sft_records)
 select input_seq, array_to_string(list_concat(list_filter([case when coalesce(id, '') = '' then 'id_missing' end, case when audios is null then 'audios_missing_or_not_list' end,
  case when messages[1].role is distinct from 'user' then 'first_message_not_user' end, case when messages[-1].role is distinct from 'assistant' then 'last_message_not_assistant' end], lambda e: e is not null),
  flatten(list_transform(range(0, len(messages)), lambda i: list_transform([messages[i + 1]], lambda m: {_ERR})[1])),
  list_filter([case when tags <> n_audio then 'audio_tag_mismatch:tags=' || tags || ':audios=' || n_audio end], lambda e: e is not null),
  list_filter(list_transform(range(0, n_audio), lambda i: case when coalesce(trim(audios[i + 1]), '') = '' then 'audio_' || i || '_invalid_path' end), lambda e: e is not null)), '; ') as errors from b where len(messages) > 0"""
)
def conversation_validate(spark, d):
    """V1."""
    r = read(spark, d, "sft_records").where(F.size("messages") > 0)
    return r.select("input_seq", F.array_join(validate.conversation_errors(F.col("id"), F.col("messages"), F.col("audios")), "; ").alias("errors"))


@query("select reason, count(*) as n from (select regexp_replace(unnest(string_split(errors, '; ')), '[0-9]+', 'N', 'g') as reason from (" + SQL["conversation_validate"] + ") v where errors <> '' union all select case when coalesce(id, '') = '' and k = 1 then 'id_missing' else 'messages_missing_or_empty' end from sft_records, (select unnest([1, 2]) as k) where coalesce(len(messages), 0) = 0 and (k = 2 or coalesce(id, '') = '')) group by 1 order by n desc, reason limit 10")
def error_reasons(spark, d):
    """A3: the ten most frequent error kinds (codes without numbers)."""
    r = read(spark, d, "sft_records").select(F.explode(validate.conversation_errors(F.col("id"), F.col("messages"), F.col("audios"))).alias("e"))
    return r.groupBy(F.regexp_replace("e", r"\d+", "N").alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(10)


@query(f"with {_M}, t as (select m.*, tools from m join sft_records using (input_seq) where role = 'tool_call') select input_seq, i, array_to_string(list_filter([case when content is null or not json_valid(content) then 'call_not_json' end, case when not json_valid(coalesce(content, 'x')) or json_extract_string(content, '$.name') is null then 'call_without_name' end, case when not json_valid(coalesce(content, 'x')) or json_extract(content, '$.arguments') is null then 'call_without_arguments' end, case when tools is not null and json_valid(coalesce(content, 'x')) and json_extract_string(content, '$.name') is not null and not list_contains(json_extract_string(tools, '$[*].name'), json_extract_string(content, '$.name')) then 'call_unknown_tool' end], lambda e: e is not null), '; ') as errors from t")
def tool_call_validate(spark, d):
    """V2."""
    m = messages(spark, d).where("role = 'tool_call'").join(read(spark, d, "sft_records").select("input_seq", "tools"), "input_seq")
    return m.select("input_seq", "i", F.array_join(validate.tool_call_errors(F.col("content"), F.col("tools")), "; ").alias("errors"))


@query("select sample_seq, array_to_string(list_filter([case when id is null then 'id' end, case when gt_preset_path is null then 'gt_preset_path' end, case when split is null then 'split' end, 'licence'], lambda e: e is not null), ',') as missing from samples")
def required_fields(spark, d):
    """A column that is not there counts as missing."""
    s = read(spark, d, "samples")
    return s.select("sample_seq", F.array_join(validate.required_fields(s, ["id", "gt_preset_path", "split", "licence"]), ",").alias("missing"))


@query("select c_custkey from customer where c_custkey % 10 = 0")
def changed_rows(spark, d):
    """V7: rows changed between two versions of a table."""
    c = read(spark, d, "customer")
    return validate.unchanged_but(c, c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))), "c_custkey", ["c_name", "c_acctbal"])


_COS = "round(list_sum(list_transform(range(1, 65), lambda i: q.embedding[i]::double * x.embedding[i]::double)) / (sqrt(list_sum(list_transform(q.embedding, lambda v: v::double * v::double))) * sqrt(list_sum(list_transform(x.embedding, lambda v: v::double * v::double)))), 9)"
_SCORED = f"scored as (select q.vec_id as q, x.label, max({_COS}) as cos from (select * from embeddings where vec_id % 100 = 0) q, embeddings x where q.vec_id <> x.vec_id or true group by 1, 2), truth as (select vec_id as q, label from embeddings where vec_id % 100 = 0)"


def _scored(spark, d):
    e = read(spark, d, "embeddings")
    qs = e.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "q")
    return vectors.similarities(qs, e, "q", "label", "embedding"), qs.select("q", "label"), e.select("label").distinct()


@query(f"with {_SCORED} select q, label, cos, row_number() over (partition by q order by cos desc, label)::int as rk from scored qualify rk <= 5")
def cosine_topk(spark, d):
    """Queries are every hundredth vector, against all."""
    return vectors.top_k(_scored(spark, d)[0], "q", "label", 5)


@query(f"with {_SCORED} select q, label, cos, row_number() over (partition by q order by cos desc, label)::int as rk from scored s where not exists (select 1 from truth t where t.q = s.q and t.label = s.label) qualify rk <= 3")
def nn_excluding_label(spark, d):
    """J18."""
    scored, truth, _ = _scored(spark, d)
    return vectors.top_k(vectors.exclude_truth(scored, truth, "q", "label"), "q", "label", 3)


@query(f"with {_SCORED}, r as (select *, row_number() over (partition by q order by cos desc, label) as rk from scored), b as (select r.q, min(case when t.q is not null then rk end) as best from r left join truth t on t.q = r.q and t.label = r.label group by 1) select count(*) as n, sum(case when best <= 1 then 1 else 0 end) / greatest(1, count(*)) as r_at_1, sum(case when best <= 3 then 1 else 0 end) / greatest(1, count(*)) as r_at_3, round(avg(best), 6) as mean_rank from b")
def recall_at_k(spark, d):
    """A10, A11, W8, U28."""
    scored, truth, universe = _scored(spark, d)
    best = vectors.best_true_rank(scored, truth, "q", "label")
    n = F.greatest(F.lit(1), F.count("*"))
    return best.agg(F.count("*").alias("n"), (F.count_if(F.col("best_rank") <= 1) / n).alias("r_at_1"), (F.count_if(F.col("best_rank") <= 3) / n).alias("r_at_3"), F.round(F.avg("best_rank"), 6).alias("mean_rank"))


@query("with u as (select label, unnest(range(1, 65)) as i, unnest(embedding)::double as x from embeddings), m as (select label, i, avg(x) as m from u group by 1, 2), l as (select label, sqrt(sum(m * m)) as l from m group by 1) select label, (i - 1)::int as i, round(m / (l + 1e-12), 8) as x from m join l using (label)")
def centroid_by_label(spark, d):
    """A18."""
    return vectors.mean_vectors(read(spark, d, "embeddings"), "label", "embedding").select("label", "i", F.round("x", 8).alias("x"))


@query(f"with {_SCORED}, p as (select q, label, 0 as kind, 0.0 as o from truth union all select q, label, 1, -cos from scored s where not exists (select 1 from truth t where t.q = s.q and t.label = s.label)) select q, label, kind, row_number() over (partition by q order by kind, o, md5(label::varchar || '0'), label)::int as place from p qualify place <= 5")
def hard_negatives(spark, d):
    """P13, P14."""
    scored, truth, universe = _scored(spark, d)
    return vectors.candidate_pool(scored, truth, universe, "q", "label", 5)


@query(f"with {_SCORED}, b as (select label, q, cos from scored where q % 200 = 0), z as (select label, avg(cos) as base from scored group by 1) select q, label, cos, round(cos - base9, 9) as delta, row_number() over (partition by q order by round(cos - base9, 9) desc, label)::int as rk from (select s.*, round(base, 9) as base9 from scored s join z using (label)) where round(cos - base9, 9) > 0.01 qualify rk <= 3")
def delta_selector(spark, d):
    """Similarity over the name's mean."""
    scored, _, _ = _scored(spark, d)
    base = scored.join(scored.groupBy("label").agg(F.round(F.avg("cos"), 9).alias("m")), "label").select("q", "label", F.col("m").alias("cos"))
    return vectors.delta_select(scored, base, "q", "label", 0.01, 3)


_JW = {"verdict_correct": 0.25, "result_communicated": 0.15, "judge_correct": 0.15, "missing_character_nonempty": 0.05}
_JM = "case when verdict in ('good', 'partial_match', 'no_match') then (verdict <> 'no_match') = (selected_tuple is not null and len(selected_tuple) > 0) end::int as a, (regexp_matches(reasoning, '[a-z]'))::int as b, case when verdict in ('good', 'partial_match') then (len(selected_tuple) = n_osc_slots)::int end as c, case when verdict in ('no_match', 'partial_match') then (len(regexp_extract_all(coalesce(missing_character, ''), '[^ ]+')) >= 3)::int end as e"


def _judge_metrics():
    picked = F.coalesce(F.size("selected_tuple") > 0, F.lit(False)) & F.col("selected_tuple").isNotNull()
    v = F.col("verdict")
    return {
        "verdict_correct": F.when(v.isin("good", "partial_match", "no_match"), ((v != "no_match") == picked).cast("int")),
        "result_communicated": F.col("reasoning").rlike("[a-z]").cast("int"),
        "judge_correct": F.when(v.isin("good", "partial_match") & F.col("selected_tuple").isNotNull(), (F.size("selected_tuple") == F.col("n_osc_slots")).cast("int")),
        "missing_character_nonempty": F.when(v.isin("no_match", "partial_match"), (F.size(F.regexp_extract_all(F.coalesce("missing_character", F.lit("")), F.lit("[^ ]+"), F.lit(0))) >= 3).cast("int")),
    }


_OVERALL = "case when coalesce(a * 0 + 0.25, 0) + coalesce(b * 0 + 0.15, 0) + coalesce(c * 0 + 0.15, 0) + coalesce(e * 0 + 0.05, 0) > 0 then round((coalesce(a * 0.25::double, 0) + coalesce(b * 0.15::double, 0) + coalesce(c * 0.15::double, 0) + coalesce(e * 0.05::double, 0)) / (coalesce(a * 0 + 0.25::double, 0) + coalesce(b * 0 + 0.15::double, 0) + coalesce(c * 0 + 0.15::double, 0) + coalesce(e * 0 + 0.05::double, 0)), 4) else 0.0 end"


@query(f"with m as (select judge_seq, verdict, {_JM} from judge_results) select judge_seq, {_OVERALL} as overall from m")
def weighted_grade(spark, d):
    """The judge's weights; metrics that don't apply are null."""
    return read(spark, d, "judge_results").select("judge_seq", grade.overall(_judge_metrics(), grade.WEIGHTS["judge_v3"]).alias("overall"))


@query(f"with m as (select judge_seq, verdict, {_JM} from judge_results), o as (select verdict, {_OVERALL} as overall from m) select verdict, count(*) as n, count(*) filter (where overall >= 0.8) as kept, count(*) filter (where overall < 0.8) as filtered, min(overall) as low, max(overall) as high, round(avg(overall), 4) as mean from o group by 1")
def grade_summary(spark, d):
    """A27, G4."""
    o = read(spark, d, "judge_results").select("verdict", grade.overall(_judge_metrics(), grade.WEIGHTS["judge_v3"]).alias("overall"))
    return o.groupBy("verdict").agg(F.count("*").alias("n"), F.count_if(F.col("overall") >= 0.8).alias("kept"), F.count_if(F.col("overall") < 0.8).alias("filtered"), F.min("overall").alias("low"), F.max("overall").alias("high"), F.round(F.avg("overall"), 4).alias("mean"))


@query("select coalesce(case when task_type = 'main_agent' then case when meta.pipeline_version like 'v3%' or meta.pipeline_version like 'v4%' or meta.pipeline_version like 'v5%' then 'main_v3' else 'main_v2' end when task_type = 'search' then 'search_v2' when task_type = 'judge' then 'judge_v3' when task_type = 'transcription' then case when meta.pipeline_version like 'v4%' or meta.pipeline_version like 'v5%' then 'transcription_v4' else 'transcription' end end, 'none') as grader, count(*) as n from sft_records group by 1")
def grader_dispatch(spark, d):
    """G2."""
    return read(spark, d, "sft_records").groupBy(F.coalesce(grade.dispatch(F.col("task_type"), F.col("meta.pipeline_version")), F.lit("none")).alias("grader")).agg(F.count("*").alias("n"))


@query("with o as (select judge_seq, row_number() over (order by md5(judge_seq::varchar || ':1337'), judge_seq) - 1 as i, count(*) over () as n from judge_results) select x.judge_seq as a, s.step::int as step, y.judge_seq as b from o x cross join (select unnest([1, 2, 3]) as step) s join o y on y.i = (x.i + s.step) % x.n where x.n > s.step")
def cross_references(spark, d):
    """Three other records of each, by keyed order."""
    return grade.references(read(spark, d, "judge_results"), "judge_seq", "judge_seq", 3, 1337)


@query("with t as (select judge_seq, verdict, list_distinct(list_transform(range(1, greatest(1, len(w) - 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as s from (select *, regexp_extract_all(lower(coalesce(reasoning, '')), '[a-z0-9]+') as w from judge_results) where len(w) >= 3), u as (select verdict, unnest(s) as g from t), f as (select verdict, g, count(*) as c from u group by 1, 2) select t.judge_seq, round(avg(case when f.c = 1 then 1.0 else 0.0 end), 6) as novelty, count(*) as n_grams from (select judge_seq, verdict, unnest(s) as g from t) t join f using (verdict, g) group by 1")
def trigram_novelty(spark, d):
    """A count measure beside D12 (which is mean_trigram_novelty): share of a text's trigrams that no other text of its group has; linear in the trigrams, not in the pairs."""
    j = read(spark, d, "judge_results").select("judge_seq", "verdict", F.regexp_extract_all(F.lower(F.coalesce("reasoning", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)).alias("w")).where(F.size("w") >= 3)
    g = j.select("judge_seq", "verdict", F.explode(tx.shingles(F.col("w"), 3)).alias("g"))
    f = g.groupBy("verdict", "g").agg(F.count("*").alias("c"))
    return g.join(f, ["verdict", "g"]).groupBy("judge_seq").agg(F.round(F.avg(F.when(F.col("c") == 1, 1.0).otherwise(0.0)), 6).alias("novelty"), F.count("*").alias("n_grams"))


@query()
def mean_trigram_novelty(spark, d):
    """D12 as surveyed: 1 - mean Jaccard of a text's word trigrams with those of every other text of its group; null without another."""
    j = read(spark, d, "judge_results").select("judge_seq", "verdict", F.regexp_extract_all(F.lower(F.coalesce("reasoning", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)).alias("w")).where(F.size("w") >= 3)
    return dedup.mean_novelty(j.select("judge_seq", F.coalesce("verdict", F.lit("")).alias("verdict"), tx.shingles(F.col("w"), 3).alias("g")), "judge_seq", "verdict", "g")
