"""Queries: filters, duplicates, aggregates, splits and lengths over the corpus tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import numbers as num
from corpusloom.functions import text as tx
from corpusloom.operators import aggregates as agg
from corpusloom.operators import dedup, filters, sampling

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


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def last_message(df: DataFrame) -> Column:
    return F.try_element_at("messages", F.lit(-1))


_CLOSE = "messages[-1]"
_REFUSAL = tx.REFUSAL.replace("'", "''")
_PRECISE = tx.TOO_PRECISE
#: The closing answer of a record, its first user message and its length estimate, in SQL.
_RECORD_SQL = f"""rec as (select input_seq, id, task_type, source, split, meta.gt_in_shard as clips, {_CLOSE}.role as close_role,
  case when {_CLOSE}.role = 'assistant' then regexp_replace(coalesce({_CLOSE}.content, ''), '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g') else '' end as answer,
  coalesce(list_filter(messages, lambda m: m.role = 'user')[1].content, '') as prompt,
  coalesce(list_sum(list_transform(messages, lambda m: length(coalesce(m.content, '')))), 0) as chars,
  len(messages) as n_messages, coalesce(len(audios), 0) as n_audio from sft_records)"""


def record_view(spark: SparkSession, d: str) -> DataFrame:
    """Conversation records with closing answer, first user message, clips, characters and audio count."""
    r = read(spark, d, "sft_records")
    close = last_message(r)
    users = F.filter("messages", lambda m: m["role"] == "user")
    return r.select(
        "input_seq", "id", "task_type", "source", "split", F.col("meta.gt_in_shard").alias("clips"), close["role"].alias("close_role"),
        F.when(close["role"] == "assistant", F.regexp_replace(F.coalesce(close["content"], F.lit("")), r"^[ \t\n\r]+|[ \t\n\r]+$", "")).otherwise("").alias("answer"),
        F.coalesce(F.try_element_at(users, F.lit(1))["content"], F.lit("")).alias("prompt"),
        F.aggregate("messages", F.lit(0).cast("long"), lambda s, m: s + F.length(F.coalesce(m["content"], F.lit("")))).alias("chars"),
        F.size("messages").alias("n_messages"), F.coalesce(F.when(F.size("audios") >= 0, F.size("audios")), F.lit(0)).alias("n_audio"),
    )


def _held(c: Column) -> Column:
    return tx.hash128_mod(c, 10_000) < 3000


_HELD_SQL = "('0x' || md5(x))::uhugeint % 10000 < 3000"


@query(
    f"""with {_RECORD_SQL}, r as (select *, list_transform(coalesce(clips, []), lambda x: {_HELD_SQL}) as held,
  cast(floor(floor(chars / 2.5) * 1.04) + 750 * n_audio as bigint) as n_tok from rec),
 c as (select *, case when close_role is distinct from 'assistant' then 'not_stop' when answer = '' then 'empty'
  when regexp_matches(answer, '{_REFUSAL}') then 'refusal'
  when task_type like 'selfq%' and regexp_matches(prompt, '{_PRECISE}') then 'too_precise'
  when n_tok > 6144 then 'too_long'
  when list_contains(held, true) and list_contains(held, false) then 'mixed_split' else 'kept' end as reason,
  case when list_contains(held, true) then 'val' else 'train' end as side from r)
 select coalesce(task_type, '') as task_type, side, reason, count(*) as n_rows, sum(n_tok)::bigint as tokens from c group by 1, 2, 3"""
)
def filter_cascade_report(spark: SparkSession, d: str) -> DataFrame:
    """Flagship (F1, F2, F3, N3, P3, A2): reason cascade of the records with split by clip hash and token estimate."""
    r = record_view(spark, d)
    clips = F.coalesce("clips", F.array().cast("array<string>"))
    some, every = F.exists(clips, _held), F.forall(clips, _held)
    r = r.withColumn("n_tok", num.length_estimate(F.col("chars"), 750 * F.col("n_audio")))
    rules = [
        ("not_stop", ~F.col("close_role").eqNullSafe("assistant")), ("empty", F.col("answer") == ""), ("refusal", F.col("answer").rlike(tx.REFUSAL)),
        ("too_precise", F.startswith("task_type", F.lit("selfq")) & F.col("prompt").rlike(tx.TOO_PRECISE)), ("too_long", F.col("n_tok") > 6144), ("mixed_split", some & ~every),
    ]
    side = F.when(some, F.lit("val")).otherwise("train").alias("side")
    return filters.cascade(r, rules).groupBy(F.coalesce("task_type", F.lit("")).alias("task_type"), side, "reason").agg(F.count("*").alias("n_rows"), F.sum("n_tok").alias("tokens"))


@query(f"select judge_seq, verdict from judge_results where regexp_matches(reasoning, '{_REFUSAL}')")
def refusal_filter(spark, d):
    """F2."""
    return read(spark, d, "judge_results").where(F.col("reasoning").rlike(tx.REFUSAL)).select("judge_seq", "verdict")


@query(f"with {_RECORD_SQL} select input_seq, task_type from rec where regexp_matches(prompt, '{_PRECISE}')")
def too_precise_prompts(spark, d):
    """F3."""
    return record_view(spark, d).where(F.col("prompt").rlike(tx.TOO_PRECISE)).select("input_seq", "task_type")


@query("select verdict, count(*) as n, count(*) filter (where starts_with(regexp_replace(lower(reasoning), '^[*# ]+', ''), replace(verdict, '_', ' '))) as n_consistent from judge_results group by 1")
def label_consistency(spark, d):
    """F4."""
    ok = filters.starts_with_expected(F.col("reasoning"), F.replace("verdict", F.lit("_"), F.lit(" ")))
    return read(spark, d, "judge_results").groupBy("verdict").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_consistent"))


@query("select task_type, count(*) as n from sft_records where coalesce(task_type not in ('selfq', 'search'), true) group by 1")
def exclude_task_types(spark, d):
    """F5, A2."""
    return filters.exclude_values(read(spark, d, "sft_records"), "task_type", ["selfq", "search"]).groupBy("task_type").agg(F.count("*").alias("n"))


@query("select sample_seq from samples where bpm between 60 and 180 and clip.program < 112 and clip.start_s >= 3 and target_rms_dbfs > -40")
def playable_samples(spark, d):
    """F6."""
    return read(spark, d, "samples").where("bpm between 60 and 180 and clip.program < 112 and clip.start_s >= 3 and target_rms_dbfs > -40").select("sample_seq")


_THR = "greatest({f}, coalesce(quantile_cont({c}::double, 0.05), 0) * 0.8)"


@query(
    f"""with t as (select {_THR.format(f=100.0, c='bytes_size')} as b, {_THR.format(f=10.0, c='tokens')} as k, {_THR.format(f=50.0, c='chars')} as c, {_THR.format(f=2.0, c='lines')} as l from file_records)
 select file_seq, coalesce((tokens < k and chars < c and lines < l) or (bytes_size < b and tokens < k * 1.5), false) as quiet from file_records, t"""
)
def learned_threshold_filter(spark, d):
    """The reference is the table itself."""
    f = read(spark, d, "file_records")
    t = filters.learned_thresholds(f, {"bytes_size": 100.0, "tokens": 10.0, "chars": 50.0, "lines": 2.0}, 0.05, 0.8)
    return filters.quiet_rows(f, t, "bytes_size", "tokens", "chars", "lines").select("file_seq", "quiet")


@query("select case when target_wav_path is null or trim(target_wav_path) = '' then 'missing' when target_rms_dbfs is null then 'read_error' when target_rms_dbfs < -30 then 'silent' else 'ok' end as gate, count(*) as n from samples group by 1")
def silence_gate(spark, d):
    """F9."""
    rules = [("missing", F.col("target_wav_path").isNull() | (F.trim("target_wav_path") == "")), ("read_error", F.col("target_rms_dbfs").isNull()), ("silent", F.col("target_rms_dbfs") < -30)]
    return read(spark, d, "samples").groupBy(F.coalesce(filters.first_reason(rules), F.lit("ok")).alias("gate")).agg(F.count("*").alias("n"))


@query("select case when clip.start_s < 1.0 then 'dropped' when clip.start_s <= 30.05 then 'whole' else 'segmented' end as kind, count(*) as n, sum(case when clip.start_s > 30.05 then ceil(clip.start_s / 30) else 1 end)::bigint as pieces from samples group by 1")
def duration_gate(spark, d):
    """dropped under a second, whole up to 30.05, else cut."""
    s = F.col("clip.start_s")
    kind = F.when(s < 1.0, "dropped").when(s <= 30.05, "whole").otherwise("segmented")
    return read(spark, d, "samples").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum(F.when(s > 30.05, F.ceil(s / 30)).otherwise(1)).cast("long").alias("pieces"))


@query("with a as (select input_seq, unnest(meta.gt_in_shard) as name from sft_records) select a.name, count(*) as n from a where not exists (select 1 from clap_cache c where c.wavetable_name = a.name) group by 1")
def missing_references(spark, d):
    """F11."""
    names = read(spark, d, "clap_cache").select(F.col("wavetable_name").alias("name"))
    return filters.missing_references(read(spark, d, "sft_records").select("input_seq", "meta"), F.col("meta.gt_in_shard"), names, "name").groupBy("name").agg(F.count("*").alias("n"))


@query("select count(*) filter (where not coalesce(regexp_matches(reasoning, '[^ \\t\\n\\r]'), false)) as n_failed, count(*) as n_total, count(*) filter (where not coalesce(regexp_matches(reasoning, '[^ \\t\\n\\r]'), false)) / count(*) > 0.01 as tripped from judge_results")
def failure_breaker(spark, d):
    """F12."""
    return filters.failure_ratio(read(spark, d, "judge_results"), ~F.coalesce(F.col("reasoning").rlike(r"[^ \t\n\r]"), F.lit(False)), 0.01)


@query("select judge_seq, k as slot, v as name from (select judge_seq, unnest(map_keys(locked_slots)) as k, unnest(map_values(locked_slots)) as v from judge_results) where k <> 3 and v is not null")
def changed_slots(spark, d):
    """F14."""
    j = read(spark, d, "judge_results")
    return j.select("judge_seq", F.explode(filters.changed_scalars(j, F.col("locked_slots"), [3])).alias("slot", "name"))


@query("with r as (select p_type, min(p_size) as lo, max(p_size) as hi from part where p_size > 5 group by 1) select p_partkey, round(case when hi = lo then 0.0 else (p_size - lo) / (hi - lo) end, 6) as scaled from part left join r using (p_type)")
def range_normalise(spark, d):
    """F15."""
    p = read(spark, d, "part")
    r = p.where("p_size > 5").groupBy("p_type").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"))
    return p.join(r, "p_type", "left").select("p_partkey", F.round(num.normalise_range(F.col("p_size"), F.col("lo"), F.col("hi")), 6).alias("scaled"))


_NEG = r"(?i)\b(no|not|never|without|neither|nor|isn''t|wasn''t|doesn''t|didn''t)\b"


@query(rf"select doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '[.;!?]'), lambda s: regexp_matches(s, '(?i)\b(warm|bright|dark)\b') and not regexp_matches(s, '{_NEG}'))) > 0 as claims from documents")
def unnegated_claims(spark, d):
    """F16."""
    return read(spark, d, "documents").select("doc_id", tx.unnegated(F.coalesce("text", F.lit("")), r"\b(warm|bright|dark)\b").alias("claims"))


_LEAK = tx.LEAK.replace("'", "''")


@query(
    rf"""select input_seq, case when len(list_filter(messages, lambda m: m.role = 'assistant' and regexp_matches(coalesce(m.content, ''), '{_LEAK}'))) > 0 then 0 else 1 end as no_leak,
 coalesce(list_sum(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: len(regexp_extract_all(regexp_replace(coalesce(m.content, ''), '[^\x00-\x7F]', 'Z', 'g'), '{tx.SNAKE_CASE[4:]}')))), 0)::bigint as snake_hits,
 len(list_filter(messages, lambda m: m.role = 'assistant' and regexp_matches(coalesce(m.content, ''), '{tx.NUMERIC_SCORE}'))) as scored_turns from sft_records"""
)
def turn_detectors(spark, d):
    """F17, F18."""
    turns = F.filter("messages", lambda m: m["role"] == "assistant")
    said = lambda m: F.coalesce(m["content"], F.lit(""))
    return read(spark, d, "sft_records").select(
        "input_seq", F.when(F.exists(turns, lambda m: said(m).rlike(tx.LEAK)), 0).otherwise(1).alias("no_leak"),
        F.aggregate(turns, F.lit(0).cast("long"), lambda s, m: s + F.size(F.regexp_extract_all(said(m), F.lit(tx.SNAKE_CASE), F.lit(0)))).alias("snake_hits"),
        F.size(F.filter(turns, lambda m: said(m).rlike(tx.NUMERIC_SCORE))).cast("long").alias("scored_turns"),
    )


@query("select wavetable_name, min(row_idx) as first_row from clap_cache where contains(lower(wavetable_name), 'br') and contains(lower(wavetable_name), 'an') group by 1 order by 2 limit 20")
def keyword_search(spark, d):
    """the first 20 names, by first row."""
    c = read(spark, d, "clap_cache")
    return c.where(filters.keyword_match(F.col("wavetable_name"), "br an")).groupBy("wavetable_name").agg(F.min("row_idx").alias("first_row")).orderBy("first_row").limit(20)


@query("with o as (select p_partkey, p_size / 50.0 as v from part where p_partkey % 3 = 0) select p_partkey, case when p_size % 2 = 0 then round_even(coalesce(o.v, p_retailprice / 2000) * greatest(1, p_size - 1), 0) else round(coalesce(o.v, p_retailprice / 2000), 6) end as shown from (select *, case when p_size % 2 = 0 then p_size end as steps from part) left join o using (p_partkey)")
def value_overrides(spark, d):
    """override table of every third part."""
    p = read(spark, d, "part").select("p_partkey", (F.col("p_retailprice") / 2000).alias("v"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("steps"), "p_size")
    o = p.where("p_partkey % 3 = 0").select("p_partkey", (F.col("p_size") / F.lit(50.0)).alias("v"))
    return filters.apply_overrides(p, o, "p_partkey", "v", "steps").select("p_partkey", "shown")


@query("select input_seq, id, split from (select *, row_number() over (partition by id order by input_seq) as r from sft_records) where r = 1 or id is null or id = ''")
def dedup_by_id_first(spark, d):
    """Rows with a null or empty id all stay."""
    r = read(spark, d, "sft_records").select("input_seq", "id", "split")
    return dedup.first_by_key(r, ["id"], "input_seq", F.col("id").isNull() | (F.col("id") == "")).select("input_seq", "id", "split")


@query("select md5(text) as fp, min(doc_id) as first_doc, count(*) as copies from documents where text is not null group by 1 having count(*) > 1")
def dedup_exact_text(spark, d):
    """Repeated texts by content hash."""
    return read(spark, d, "documents").where("text is not null").groupBy(F.md5("text").alias("fp")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")).where("copies > 1")


@query("select row_idx, wavetable_name, frame_idx from (select *, row_number() over (partition by wavetable_name order by frame_idx, row_idx) as r from clap_cache where wavetable_name is not null) where r = 1")
def dedup_by_name(spark, d):
    """The lowest frame of every name."""
    c = read(spark, d, "clap_cache").where("wavetable_name is not null").select("row_idx", "wavetable_name", "frame_idx", F.struct("frame_idx", "row_idx").alias("o"))
    return dedup.first_by_key(c, ["wavetable_name"], "o").select("row_idx", "wavetable_name", "frame_idx")


@query("select path_key, min(file_seq) as first_seq, count(*) as scans from (select *, lower(trim(path)) as path_key from file_records where path is not null) group by 1 having count(*) > 1")
def dedup_paths(spark, d):
    """D5."""
    return read(spark, d, "file_records").where("path is not null").groupBy(F.lower(F.trim("path")).alias("path_key")).agg(F.min("file_seq").alias("first_seq"), F.count("*").alias("scans")).where("scans > 1")


@query("with t as (select input_seq as seq, id, 'sft' as src from sft_records union all select sample_seq, id, 'sample' from samples), u as (select *, row_number() over (partition by id order by src, seq) as r from t where id is not null) select src, count(*) as n from u where r = 1 group by 1")
def union_first_seen(spark, d):
    """Inputs in order, first id wins."""
    a = read(spark, d, "sft_records").select(F.col("input_seq").alias("seq"), "id", F.lit("sft").alias("src"))
    b = read(spark, d, "samples").select(F.col("sample_seq").alias("seq"), "id", F.lit("sample").alias("src"))
    t = a.unionByName(b).where("id is not null").withColumn("o", F.struct("src", "seq"))
    return dedup.first_by_key(t, ["id"], "o").groupBy("src").agg(F.count("*").alias("n"))


@query("select 'intersect' as op, count(*) as n from (select record_id from judge_results where record_id is not null intersect select id from sft_records) union all select 'left_only', count(*) from (select record_id from judge_results where record_id is not null except select id from sft_records) union all select 'right_only', count(*) from (select id from sft_records where id is not null except select record_id from judge_results)")
def id_set_operations(spark, d):
    """D10."""
    a = read(spark, d, "judge_results").select(F.col("record_id").alias("id")).where("id is not null")
    b = read(spark, d, "sft_records").select("id").where("id is not null")
    count = lambda df, op: df.agg(F.lit(op).alias("op"), F.count("*").alias("n"))
    return count(a.intersect(b), "intersect").union(count(a.subtract(b), "left_only")).union(count(b.subtract(a), "right_only"))


_WORDS = "list_distinct(regexp_extract_all(lower({c}), '[a-z0-9]+'))"
_JACCARD = "len(list_intersect({a}, {b})) / greatest(1, len(list_distinct(list_concat({a}, {b}))))"


@query(f"with w as (select judge_seq, {_WORDS.format(c='coalesce(prompt, $$$$)')} as a, {_WORDS.format(c='coalesce(reasoning, $$$$)')} as b from judge_results) select judge_seq, round({_JACCARD.format(a='a', b='b')}, 6) as similarity from w")
def prompt_overlap(spark, d):
    """D11."""
    e = lambda c: tx.word_set(F.coalesce(c, F.lit("")))
    return read(spark, d, "judge_results").select("judge_seq", F.round(tx.jaccard(e("prompt"), e("reasoning")), 6).alias("similarity"))


@query(
    f"""with t as (select input_seq, m.idx as i, {_WORDS.format(c="coalesce(m.c, '')")} as w from (select input_seq, unnest(list_transform(range(1, len(messages) + 1), lambda i: {{'idx': i, 'role': messages[i].role, 'c': messages[i].content}})) as m from sft_records) where m.role = 'assistant'),
 p as (select *, lag(w) over (partition by input_seq order by i) as p from t)
 select input_seq, count(*) as n_pairs, count(*) filter (where {_JACCARD.format(a='w', b='p')} < 0.6) as n_ok from p where p is not null group by 1"""
)
def template_duplication(spark, d):
    """D13."""
    m = read(spark, d, "sft_records").select("input_seq", F.posexplode("messages").alias("i", "m")).where("m.role = 'assistant'").select("input_seq", "i", F.col("m.content").alias("text"))
    return dedup.consecutive_overlap(m, ["input_seq"], "i", "text").groupBy("input_seq").agg(F.count("*").alias("n_pairs"), F.count_if("distinct_enough").alias("n_ok"))


@query("select source, count(*) as n_rows, sum(len(messages))::bigint as n_messages, coalesce(sum(len(audios)), 0)::bigint as n_audios from sft_records group by 1")
def source_totals(spark, d):
    """A1."""
    return read(spark, d, "sft_records").groupBy("source").agg(F.count("*").alias("n_rows"), F.sum(F.size("messages")).alias("n_messages"), F.coalesce(F.sum(F.when(F.col("audios").isNotNull(), F.size("audios"))), F.lit(0)).cast("long").alias("n_audios"))


@query("select extension, count(*) as n, coalesce(sum(tokens), 0)::bigint as total, coalesce(min(tokens), 0)::double as v_min, coalesce(max(tokens), 0)::double as v_max, round(coalesce(avg(tokens), 0), 4) as v_mean, round(coalesce(stddev_pop(tokens), 0), 4) as v_std, round(coalesce(quantile_cont(tokens, 0.5), 0), 4) as p50, round(coalesce(quantile_cont(tokens, 0.99), 0), 4) as p99 from (select tokens, case when starts_with(lower(trim(extension)), '.') then lower(trim(extension)) else '.' || lower(trim(extension)) end as extension from file_records) group by 1")
def extension_rollup(spark, d):
    """Extensions in lower case with a leading dot."""
    e = F.lower(F.trim("extension"))
    f = read(spark, d, "file_records").withColumn("extension", F.when(F.startswith(e, F.lit(".")), e).otherwise(F.concat(F.lit("."), e)))
    got = agg.distribution(f, "tokens", ["extension"], (0.5, 0.99)).drop("n")
    return f.groupBy(F.col("extension").alias("x")).agg(F.count("*").alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("total")).join(got, F.col("x").eqNullSafe(F.col("extension"))).drop("x")


@query("select count(n_chars) as n, coalesce(min(n_chars), 0)::double as v_min, coalesce(max(n_chars), 0)::double as v_max, round(coalesce(avg(n_chars), 0), 4) as v_mean, round(coalesce(stddev_pop(n_chars), 0), 4) as v_std, " + ", ".join(f"round(coalesce(quantile_cont(n_chars, {p}), 0), 4) as p{round(p * 100):02d}" for p in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) + " from documents")
def length_distribution(spark, d):
    """A4."""
    return agg.distribution(read(spark, d, "documents"), "n_chars")


@query("with l as (select source, n_chars, row_number() over (partition by source order by n_chars) - 1 as i, count(*) over (partition by source) as n from documents where n_chars is not null) select source, n, n_chars as at_rank from l where i = round_even(0.95 * (n - 1), 0)")
def nearest_rank_percentile(spark, d):
    """A5."""
    return agg.ranked_value(read(spark, d, "documents"), "n_chars", ["source"], num.round_half_even_rank(0.95, F.col("n")))


@query("with l as (select source, n_chars, row_number() over (partition by source order by n_chars) - 1 as i, count(*) over (partition by source) as n from documents where n_chars is not null) select source, n, n_chars as at_rank from l where i = least(n - 1, floor(n * 0.95))")
def floor_percentile(spark, d):
    """A6."""
    return agg.ranked_value(read(spark, d, "documents"), "n_chars", ["source"], F.least(F.col("n") - 1, F.floor(F.col("n") * 0.95)))


@query("with s as (select min(n_chars)::double as lo, max(n_chars)::double as hi from documents), b as (select least(19, floor((n_chars - lo) / ((hi - lo) / 20)))::int as bin, count(*) as n from documents, s where n_chars is not null group by 1) select r.bin::int as bin, round(lo + r.bin * (hi - lo) / 20, 4) as low, coalesce(n, 0) as n from (select unnest(range(20)) as bin) r cross join s left join b on b.bin = r.bin")
def length_histogram(spark, d):
    """A7."""
    return agg.histogram(read(spark, d, "documents"), "n_chars", 20)


@query("select term, sum(c)::bigint as tf, count(*) as df from (select term, doc_id, count(*) as c from (select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) as term from documents) group by 1, 2) group by 1 order by 2 desc, 1 limit 100")
def term_doc_freq(spark, d):
    """A9."""
    return agg.term_statistics(read(spark, d, "documents"), "doc_id", F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0)), 100)


@query("select task_type, source, count(*) as n_rows, sum(len(messages))::bigint as n_messages, round(count(*) / sum(count(*)) over (), 6) as n_rows_share, round(sum(len(messages)) / sum(sum(len(messages))) over (), 6) as n_messages_share from sft_records group by 1, 2")
def mix_share(spark, d):
    """A28."""
    return agg.shares(read(spark, d, "sft_records"), ["task_type", "source"], {"n_messages": F.size("messages")})


@query("select verdict, count(*) as n_rows, round(avg(n_osc_slots), 6) as slots_mean, round(avg(case when verdict <> 'no_match' then len(selected_tuple) end), 6) as picked_mean, round(sum(coalesce(len(selected_tuple), 0)) / greatest(1, count(*)), 6) as picked_per_row from judge_results group by 1")
def conditional_means(spark, d):
    """Null where nothing applies, and the mean over at least one."""
    picked = F.when(F.col("selected_tuple").isNotNull(), F.size("selected_tuple"))
    return read(spark, d, "judge_results").groupBy("verdict").agg(
        F.count("*").alias("n_rows"), F.round(F.avg("n_osc_slots"), 6).alias("slots_mean"), F.round(F.avg(F.when(F.col("verdict") != "no_match", picked)), 6).alias("picked_mean"),
        F.round(F.sum(F.coalesce(picked, F.lit(0))) / F.greatest(F.lit(1), F.count("*")), 6).alias("picked_per_row"),
    )


@query("select t.t as threshold, round(avg(case when v >= t.t then 1 else 0 end), 6) as coverage from (select unnest([0.2::double, 0.4, 0.6, 0.8]) as t) t, (select value / (select max(value) from events) as v from events) group by 1")
def coverage_curve(spark, d):
    """Share at or above each threshold; null without rows."""
    e = read(spark, d, "events")
    v = e.crossJoin(F.broadcast(e.agg(F.max("value").alias("top")))).select((F.col("value") / F.col("top")).alias("v"))
    steps = [0.2, 0.4, 0.6, 0.8]
    one = v.agg(*[F.round(F.avg(F.when(F.col("v") >= t, 1).otherwise(0)), 6).alias(f"t{i}") for i, t in enumerate(steps)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("coverage")) for i, t in enumerate(steps)])))


@query("select extension_lc as extension, round(1 - 6 * sum(dd * dd) / (count(*) * (count(*) * count(*) - 1)), 8) as rho, count(*) as m from (select extension_lc, (row_number() over (partition by extension_lc order by chars, file_seq) - row_number() over (partition by extension_lc order by lines, file_seq))::double as dd from (select *, lower(extension) as extension_lc from file_records where chars is not null and lines is not null)) group by 1 having count(*) > 1")
def rank_correlation(spark, d):
    """A22."""
    f = read(spark, d, "file_records").where("chars is not null and lines is not null").select(F.lower("extension").alias("extension"), "chars", "lines", "file_seq")
    return agg.spearman(f, "chars", "lines", ["extension"], "file_seq").where("m > 1")


@query("with p as (select event_type, value, count(*) filter (where user_id % 2 = 0) as p, count(*) filter (where user_id % 2 <> 0) as q from events where value is not null group by 1, 2), w as (select *, p * (coalesce(sum(q) over (partition by event_type order by value rows between unbounded preceding and 1 preceding), 0) + q / 2) as w from p) select event_type, sum(p)::bigint as n_pos, sum(q)::bigint as n_neg, round(sum(w) / nullif(sum(p) * sum(q), 0), 8) as auc from w group by 1")
def ranking_auc(spark, d):
    """G9."""
    return agg.auc(read(spark, d, "events"), "value", F.col("user_id") % 2 == 0, ["event_type"])


@query("with u as (select label, vec_id, unnest(range(1, len(embedding) + 1)) as i, unnest(embedding)::double as x, sqrt(list_sum(list_transform(embedding, lambda v: v::double * v::double))) as l from embeddings), dm as (select label, i, sum(x / l) as s, count(*) as n from u where l > 0 group by 1, 2) select label, max(n) as n, round(case when max(n) < 2 then 0.0 else 1 - (sum(s * s) - max(n)) / (max(n) * (max(n) - 1)) end, 8) as diversity from dm group by 1")
def diversity_by_label(spark, d):
    """A19."""
    return agg.mean_pairwise_distance(read(spark, d, "embeddings"), "embedding", ["label"])


@query("select file_seq, path, tokens from file_records where tokens is not null and path is not null order by tokens desc, path, file_seq limit 50")
def top_k_files(spark, d):
    """T1."""
    return read(spark, d, "file_records").where("tokens is not null and path is not null").orderBy(F.desc("tokens"), "path", "file_seq").limit(50).select("file_seq", "path", "tokens")


@query(
    """with h as (select input_seq, coalesce(task_type, '') as task, ('0x' || substr(md5(coalesce(id, '') || ':42'), 1, 8))::bigint as h from sft_records),
 a as (select *, row_number() over (partition by task order by h, input_seq) as r, count(*) over () as n from h),
 t as (select count(distinct task) as k from h),
 f as (select a.*, r <= greatest(1, (200 // k)) as first_pick from a, t),
 g as (select *, row_number() over (order by first_pick, h, input_seq) as g, count(*) filter (where first_pick) over () as taken from f)
 select task, case when first_pick or g <= greatest(0, 200 - taken) then 'val' else 'train' end as side, count(*) as n from g group by 1, 2"""
)
def hash_split_stratified(spark, d):
    """P1."""
    r = read(spark, d, "sft_records").select("input_seq", F.coalesce("task_type", F.lit("")).alias("task"), tx.hash32(F.concat(F.coalesce("id", F.lit("")), F.lit(":42"))).alias("h"))
    return sampling.stratified_holdout(r, "task", "h", "input_seq", 200).groupBy("task", "side").agg(F.count("*").alias("n"))


@query("select ('0x' || md5(wavetable_name))::uhugeint % 10000 < 300 as held, count(*) as n from clap_cache where wavetable_name is not null group by 1")
def hash_split_modulo(spark, d):
    """P3."""
    return read(spark, d, "clap_cache").where("wavetable_name is not null").groupBy((tx.hash128_mod(F.col("wavetable_name"), 10_000) < 300).alias("held")).agg(F.count("*").alias("n"))


@query("select doc_id, ('0x' || substr(md5(doc_id::varchar || '|7'), 1, 16))::ubigint < 0.1 * 18446744073709551615 as held from documents")
def hash_split_ratio(spark, d):
    """A side for every document."""
    return _side(read(spark, d, "documents"))


def _side(docs: DataFrame) -> DataFrame:
    limit = F.lit(int(0.1 * (2**64 - 1))).cast("decimal(20,0)")
    return docs.select("doc_id", (tx.hash64(F.concat(F.col("doc_id").cast("string"), F.lit("|7"))) < limit).alias("held"))


@query("select source, doc_id from (select *, row_number() over (partition by source order by md5(doc_id::varchar || ':3'), doc_id) as r from documents) where r <= 5")
def capped_per_source(spark, d):
    """P4, S5."""
    return sampling.cap_per_group(read(spark, d, "documents"), ["source"], F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":3"))), "doc_id", 5).select("source", "doc_id")


@query("select doc_id, n_chars from (select *, coalesce(sum(n_chars) over (order by h, doc_id rows between unbounded preceding and 1 preceding), 0) as before from (select doc_id, n_chars, ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint as h from documents where n_chars is not null)) where before < 100000")
def budget_sample(spark, d):
    """P5: rows until the budget is reached, the crossing row included."""
    r = read(spark, d, "documents").where("n_chars is not null").select("doc_id", "n_chars", tx.hash32(F.col("doc_id").cast("string")).alias("h"))
    return sampling.take_budget(r, "h", "doc_id", "n_chars", 100_000, 2**32).select("doc_id", "n_chars")


@query("select doc_id, ((row_number() over (order by doc_id) - 1) % 8)::int as shard from documents")
def round_robin_shards(spark, d):
    """P11."""
    return sampling.with_row_number(read(spark, d, "documents"), "doc_id").select("doc_id", (F.col("i") % 8).cast("int").alias("shard"))


@query("with c as (select count(*) as n from documents), r as (select doc_id, row_number() over (order by doc_id) - 1 as i from documents) select doc_id, (case when i < (n % 7) * (n // 7 + 1) then i // (n // 7 + 1) else (n % 7) + (i - (n % 7) * (n // 7 + 1)) // (n // 7) end)::int as chunk from r, c")
def balanced_chunks(spark, d):
    """P10: seven contiguous chunks whose sizes differ by at most one."""
    return sampling.balanced_chunks(sampling.with_row_number(read(spark, d, "documents"), "doc_id"), "i", 7).select("doc_id", "chunk")


@query("with r as (select doc_id, n_chars, (row_number() over (order by md5(doc_id::varchar), doc_id) - 1) // 512 as g from documents where n_chars is not null) select doc_id, (g * 64 + (row_number() over (partition by g order by n_chars, doc_id) - 1) // 8)::bigint as batch from r")
def length_batches(spark, d):
    """Batches of 8 of like length inside shuffled groups of 64 batches."""
    return sampling.length_batches(read(spark, d, "documents").where("n_chars is not null"), F.md5(F.col("doc_id").cast("string")), "doc_id", "n_chars", 8, 64).select("doc_id", "batch")


@query("with s as (select source, sqrt(count(*)) as w from documents where source is not null group by 1) select source, round(w / sum(w) over (), 8) as weight from s")
def sqrt_source_weights(spark, d):
    """P7."""
    s = read(spark, d, "documents").where("source is not null").groupBy("source").agg(F.sqrt(F.count("*")).alias("w"))
    return s.select("source", F.round(F.col("w") / F.sum("w").over(Window.partitionBy()), 8).alias("weight"))


@query("with r as (select doc_id, source, row_number() over (partition by source order by n_chars, doc_id) - 1 as i, count(*) over (partition by source) as n from documents where n_chars is not null) select doc_id, case when n < 3 then 'mid' when i < n / 3 then 'low' when i < 2 * n / 3 then 'mid' else 'high' end as tercile from r")
def tercile_labels(spark, d):
    """W6."""
    return sampling.terciles(read(spark, d, "documents").where("n_chars is not null"), ["source"], ["n_chars", "doc_id"]).select("doc_id", "tercile")


@query(f"with {_RECORD_SQL} select input_seq, cast(floor(floor(chars / 2.5) * 1.04) + 750 * n_audio as bigint) as est, cast(6 * n_messages + 20 + floor(chars / 4) + round_even(25 * n_audio * 11.0, 0) as bigint) as linear_est from rec")
def token_estimate(spark, d):
    """N3, N4, N5."""
    r = record_view(spark, d)
    return r.select("input_seq", num.length_estimate(F.col("chars"), 750 * F.col("n_audio")).alias("est"), (6 * F.col("n_messages") + 20 + F.floor(F.col("chars") / 4) + F.rint(25 * F.col("n_audio") * F.lit(11.0))).cast("long").alias("linear_est"))


@query("with f as (select sample_seq, clip.start_s as s, floor(clip.start_s * 100)::bigint as mel from samples where clip.start_s is not null) select sample_seq, greatest(1, floor((floor((mel - 1) / 2) + 1 - 2) / 2)::bigint + 1) as v1, (floor(((floor((floor(((mel % 100) - 1) / 2) + 1 - 1) / 2) + 1) - 1) / 2) + 1 + floor(mel / 100) * 13)::bigint as v2 from f")
def audio_token_counts(spark, d):
    """The two encoders, on the clip offsets."""
    s = read(spark, d, "samples").where("clip.start_s is not null")
    return s.select("sample_seq", num.audio_tokens_mel(F.col("clip.start_s")).alias("v1"), num.audio_tokens_seconds(F.col("clip.start_s")).alias("v2"))


@query(f"with {_RECORD_SQL} select task_type, count(*) as n, count(*) filter (where chars > 8000) as n_over, round(avg(case when chars > 8000 then 1 else 0 end), 6) as share_over, sum(case when chars <= 8000 then chars else 0 end)::bigint as chars_kept from rec group by 1")
def max_length_overflow(spark, d):
    """Rows above the limit are counted and left out, never cut."""
    over = F.col("chars") > 8000
    return record_view(spark, d).groupBy("task_type").agg(F.count("*").alias("n"), F.count_if(over).alias("n_over"), F.round(F.avg(over.cast("int")), 6).alias("share_over"), F.sum(F.when(over, 0).otherwise(F.col("chars"))).alias("chars_kept"))
