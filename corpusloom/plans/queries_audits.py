"""Queries: audits and further composites, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import audits as au
from corpusloom.operators import windows
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


_LONG = "m as (select input_seq, task_type, i::int as i, role, content from (select input_seq, task_type, unnest(range(len(messages))) as i, unnest(list_transform(messages, lambda m: m.role)) as role, unnest(list_transform(messages, lambda m: m.content)) as content from sft_records))"


def messages(spark, d):
    return windows.messages_long(read(spark, d, "sft_records"), "input_seq")


@query("select event_type, case when value is null or abs(value - 10) < 2 then 'unexplained' when sign(value - 10) = case when user_id % 2 = 0 then 1 else -1 end then 'supported' else 'contradicted' end as state, count(*) as n, round(median(abs(value - 10)), 6) as median_move from events group by 1, 2")
def verdict_counts(spark, d):
    """A17."""
    return au.verdict_counts(read(spark, d, "events"), ["event_type"], F.when(F.col("user_id") % 2 == 0, 1.0).otherwise(-1.0), F.col("value") - 10, 2.0)


@query("with t as (select task_type, len(messages)::bigint as k from sft_records), r as (select *, row_number() over (partition by task_type order by k) - 1 as i, count(*) over (partition by task_type) as n from t) select task_type, count(*) as n, round(avg(k), 4) as mean, median(k)::double as median, max(k) as most, max(case when i = round_even(0.95 * (n - 1), 0) then k end) as p95 from r group by 1")
def token_table(spark, d):
    """Messages stand for tokens."""
    return au.token_table(read(spark, d, "sft_records").select("task_type", F.size("messages").cast("long").alias("k")), "task_type", "k")


@query("select verdict, count(*) as n, round(avg((reasoning is null)::int), 6) as rejected, round(avg((missing_character is null)::int), 6) as fallback, median(case when reasoning is not null then length(reasoning) end)::double as median_length from judge_results group by 1")
def rejection_rates(spark, d):
    """A24."""
    return au.rejection_rates(read(spark, d, "judge_results"), ["verdict"], F.col("reasoning").isNull(), F.col("missing_character").isNull(), F.length("reasoning"))


@query("select judge_seq, case when record_id is null then 'no_record' when reasoning is null then 'no_reasoning' end as reason from judge_results where record_id is null or reasoning is null order by judge_seq limit 200")
def first_failures(spark, d):
    """The first 200 failures are the report."""
    reason = F.when(F.col("record_id").isNull(), "no_record").when(F.col("reasoning").isNull(), "no_reasoning")
    return au.failure_taxonomy(read(spark, d, "judge_results"), reason, "judge_seq", 200)[1].select("judge_seq", "reason")


@query("select p_brand as b, p_partkey as key, case p_partkey % 3 when 0 then true when 1 then coalesce((select bool_or(q.p_size <> 25) from part q where q.p_brand = p.p_brand and q.p_partkey = p.p_partkey - 1), false) else coalesce((select bool_or(q.p_size <> 25) from part q where q.p_brand = p.p_brand and q.p_partkey = p.p_partkey - 1), false) and coalesce((select bool_or(q.p_size <> 25) from part q where q.p_brand = p.p_brand and q.p_partkey = p.p_partkey - 2), false) end as live from part p")
def live_keys(spark, d):
    """all parts."""
    return _live(read(spark, d, "part"))


def _live(parts: DataFrame) -> DataFrame:
    p = parts.select(F.col("p_brand").alias("b"), F.col("p_partkey").alias("key"), (F.col("p_size") - 25).alias("value"))
    rules = p.where("key % 3 > 0").select("key", (F.col("key") - 1).alias("needs"))
    return au.live_keys(p, rules, ["b"], 3).select("b", "key", "live")


@query(r"select doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '[.;!?\n]'), lambda c: not regexp_matches(c, '(?i)\b(no|not|never|without|neither|nor)\b') and case when doc_id % 2 = 0 then regexp_matches(c, '(?i)\b(falls|quieter|darker|lower|drops|softens)\b') and not regexp_matches(c, '(?i)\b(rises|louder|brighter|higher|lifts|climbs)\b') else regexp_matches(c, '(?i)\b(rises|louder|brighter|higher|lifts|climbs)\b') and not regexp_matches(c, '(?i)\b(falls|quieter|darker|lower|drops|softens)\b') end))::int as faults from documents")
def direction_faults(spark, d):
    """G10, U39."""
    return read(spark, d, "documents").select("doc_id", au.direction_faults(F.col("text"), F.col("doc_id") % 2 == 0).alias("faults"))


@query("with j as (select judge_seq, selected_tuple as a, map_values(locked_slots) as b from judge_results where selected_tuple is not null and locked_slots is not null) select judge_seq, list_sort(list_distinct(list_filter(a, lambda x: not list_contains(b, x)))) as unfounded, list_sort(list_distinct(list_filter(b, lambda x: not list_contains(a, x) and not list_contains(b, x)))) as missed, list_sort(list_intersect(a, b)) as agreed from j")
def claim_sets(spark, d):
    """Locked names are both the ground and the measure."""
    j = read(spark, d, "judge_results").where("selected_tuple is not null and locked_slots is not null")
    b = F.map_values("locked_slots")
    return j.select("judge_seq", *au.claim_sets(F.col("selected_tuple"), b, b))


@query("with h as (select doc_id, ('0x' || substr(md5(doc_id::varchar || '|9'), 1, 16))::ubigint as h, n_chars from documents), v as (select doc_id from h where n_chars <= 900 order by h, doc_id limit 40) select doc_id, case when doc_id in (select doc_id from v) then 'val' else 'train' end as side from h")
def counted_holdout(spark, d):
    """Of all documents."""
    return _counted(read(spark, d, "documents"))


def _counted(docs: DataFrame) -> DataFrame:
    h = docs.select("doc_id", tx.hash64(F.concat(F.col("doc_id").cast("string"), F.lit("|9"))).alias("h"), "n_chars")
    return au.counted_holdout(h, "h", "doc_id", F.col("n_chars"), 900, 40).select("doc_id", "side")


@query("select sample_seq, (('0x' || substr(md5(coalesce(clip.midi_path, '')), 1, 2))::int % 5) + 4 as bars from samples")
def drawn_bars(spark, d):
    """P17."""
    return read(spark, d, "samples").select("sample_seq", au.drawn_bars(F.coalesce("clip.midi_path", F.lit("")), 4, 8).alias("bars"))


@query()
def agent_record_errors(spark, d):
    """V3: counts by code kind."""
    r = read(spark, d, "sft_records").select(F.explode(au.agent_record_errors(F.col("id"), F.col("messages"), F.col("audios"), ["bash", "read"])).alias("e"))
    return r.groupBy(F.regexp_replace("e", r"\d+", "N").alias("code")).agg(F.count("*").alias("n"))


@query("with e as (select user_id, event_id as i, case when event_type in ('view', 'signup') then 'write' else 'read' end as kind, (floor(value))::bigint as path from events), w as (select user_id, path, min(i) as w from e where kind = 'write' group by 1, 2) select e.user_id, i, e.path from e left join w on w.user_id = e.user_id and w.path is not distinct from e.path where kind = 'read' and e.path is not null and (w is null or i <= w)")
def reads_before_writes(spark, d):
    """W4 over events: views and sign-ups write, the others read."""
    e = read(spark, d, "events").where("value is not null").select("user_id", F.col("event_id").alias("i"), F.when(F.col("event_type").isin("view", "signup"), "write").otherwise("read").alias("kind"), F.floor("value").cast("long").alias("path"))
    return au.reads_before_writes(e, "user_id").select("user_id", "i", "path")


@query(f"with {_LONG}, r as (select input_seq, i, regexp_extract(content, '[a-z]+_[0-9]_[a-z_]+') as ref from m where role = 'assistant' and regexp_extract(content, '[a-z]+_[0-9]_[a-z_]+') <> '') select r.input_seq, r.i, r.ref, coalesce(bool_or(m.i < r.i and contains(coalesce(m.content, ''), r.ref)), false) as seen from r join m using (input_seq) group by 1, 2, 3")
def seen_before(spark, d):
    """The first parameter named in an assistant turn."""
    m = messages(spark, d)
    r = m.where("role = 'assistant'").select("input_seq", "i", F.regexp_extract("content", "[a-z]+_[0-9]_[a-z_]+", 0).alias("ref")).where("ref <> ''")
    return au.seen_before(m, "input_seq", r, "ref").select("input_seq", "i", "ref", "seen")


@query("select input_seq, regexp_matches(array_to_string(list_transform(messages, lambda m: m.role), ','), '(^|,)user(,.*)?,tool_call(,.*)?,assistant(,|$)') as found from sft_records")
def contains_ordered(spark, d):
    """User, tool_call, assistant in this order."""
    return read(spark, d, "sft_records").select("input_seq", au.contains_ordered(F.transform("messages", lambda m: m["role"]), ["user", "tool_call", "assistant"]).alias("found"))


@query("select event_id // 8 as q, min(case when value >= 25 then event_id % 8 end) as kept, coalesce(min(case when value >= 25 then event_id % 8 end), count(*)) as rejected from events group by 1")
def first_passing(spark, d):
    """Events as attempts of eights."""
    e = read(spark, d, "events").select(F.expr("event_id div 8").alias("q"), (F.col("event_id") % 8).alias("a"), "value")
    return au.first_passing(e, "q", "a", F.col("value") >= 25, 8)


@query("select round(sum(len(list_intersect(t, f))) / greatest(1, sum(len(t))), 6) as micro, round(count(*) filter (where len(list_intersect(t, f)) > 0) / greatest(1, count(*)), 6) as macro from (select selected_tuple as t, map_values(locked_slots) as f from judge_results where selected_tuple is not null and locked_slots is not null)")
def micro_macro(spark, d):
    """U29."""
    j = read(spark, d, "judge_results").where("selected_tuple is not null and locked_slots is not null").withColumn("t", F.array_distinct("selected_tuple"))
    return au.micro_macro(j, F.col("t"), F.map_values("locked_slots"))


@query("with s as (select source, median(doc_id) as mid, (select count(*) from documents) as n from documents where source is not null group by 1) select source, greatest(0, least(floor(mid)::bigint - 25, n - 50)) as w_first, least(n, greatest(0, least(floor(mid)::bigint - 25, n - 50)) + 50) as w_last from s")
def centred_window(spark, d):
    """U30."""
    t = read(spark, d, "documents")
    s = t.where("source is not null").groupBy("source").agg(F.median("doc_id").alias("mid")).crossJoin(F.broadcast(t.agg(F.count("*").alias("n"))))
    return s.select("source", *au.centred_window(F.col("mid"), 50, F.col("n")))


@query()
def job_specs(spark, d):
    """Nations times regions, with the specs whose nation has a customer."""
    specs = au.job_specs(read(spark, d, "nation"), read(spark, d, "region"), "n_nationkey", "r_regionkey", "0")
    files = read(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_files"))
    return au.finished_specs(specs, files, "n_nationkey", ["n_files"])


@query()
def capped_corruption(spark, d):
    """Up to three parts a brand."""
    p = read(spark, d, "part").select("p_brand", "p_partkey", (F.col("p_size") / 50).alias("v"))
    return au.capped_corruption(p, ["p_brand"], "p_partkey", "v", 3, "0")


@query("select l_orderkey, max_by(case when abs(l_discount - l_tax) > 0.02 then l_linenumber end, {'d': coalesce(case when abs(l_discount - l_tax) > 0.02 then abs(l_discount - l_tax) end, -1.0), 'n': l_linenumber}) as cue from lineitem group by 1")
def strongest_cue(spark, d):
    """U38."""
    return au.strongest(read(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", "l_discount", "l_tax", 0.02)


@query(f"with {_LONG}, x as (select *, lead(role, 1) over w as r1, lead(content, 1) over w as c1, lead(role, 3) over w as r3, lead(content, 3) over w as c3 from m window w as (partition by input_seq order by i)) select input_seq, i, md5(case when r1 = 'assistant' then c1 when r1 = 'tool_call' and r3 = 'assistant' then c3 end) as narration_md5 from x where role = 'tool_response'")
def narration_after(spark, d):
    """After every tool response."""
    n = au.narration_after(messages(spark, d), "input_seq", F.col("role") == "tool_response")
    return n.select("input_seq", "i", F.md5("narration").alias("narration_md5"))


@query("with t as (select list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: coalesce(m.content, '')) as t from sft_records) select case when len(t) > 0 then round(len(list_filter(t, lambda x: contains(x, 'HEARD:') and contains(x, 'HYPOTHESIS:') and contains(x, 'PLAN:'))) / len(t), 6) end as share, count(*) as n from t group by 1")
def section_shares(spark, d):
    """G6."""
    turns = F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: m["content"])
    return read(spark, d, "sft_records").groupBy(au.section_share(turns).alias("share")).agg(F.count("*").alias("n"))
