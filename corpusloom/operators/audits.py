"""Audits and further composites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.numbers import round_half_even_rank
from corpusloom.operators.aggregates import ranked_value
from corpusloom.operators.conversations import keyed_draw, weighted_choice
from corpusloom.operators.validate import conversation_errors

SECTIONS = ["HEARD:", "HYPOTHESIS:", "PLAN:"]
# Kinds of corruption with their shares, and the totals a record may draw with theirs (fixed values).
CORRUPTIONS = [("drop", 0.35), ("scale", 0.30), ("shift", 0.20), ("flip", 0.15)]
MISTAKES = [("overshoot", 0.35), ("undershoot", 0.30), ("omission", 0.20), ("spurious", 0.15)]
TOTALS = [(0, 0.35), (1, 0.25), (2, 0.15), (3, 0.10), (4, 0.07), (5, 0.05), (6, 0.03)]


def verdict_counts(df: DataFrame, by: list[str], predicted: Column, measured: Column, least: float) -> DataFrame:
    """Claims against measured moves: supported, contradicted (other direction), unexplained (under ``least``), with the median move."""
    state = F.when(measured.isNull() | (F.abs(measured) < least), "unexplained").when(F.signum(measured) == predicted, "supported").otherwise("contradicted")
    return df.withColumn("__m", F.abs(measured)).groupBy(*by, state.alias("state")).agg(F.count("*").alias("n"), F.round(F.median("__m"), 6).alias("median_move"))


def token_table(df: DataFrame, kind: str, tokens: str) -> DataFrame:
    """Count, mean, median, nearest-rank p95 and maximum a record type."""
    p95 = ranked_value(df, tokens, [kind], round_half_even_rank(0.95, F.col("n"))).select(F.col(kind).alias("__k"), F.col("at_rank").alias("p95"))
    g = df.where(F.col(tokens).isNotNull()).groupBy(kind).agg(F.count("*").alias("n"), F.round(F.avg(tokens), 4).alias("mean"), F.median(tokens).alias("median"), F.max(tokens).alias("most"))
    return g.join(p95, F.col(kind).eqNullSafe(F.col("__k"))).drop("__k")


def rejection_rates(df: DataFrame, by: list[str], rejected: Column, fallback: Column, length: Column) -> DataFrame:
    """Share of rejected rows and of template fallbacks, and the median length of the others."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg(rejected.cast("int")), 6).alias("rejected"), F.round(F.avg(fallback.cast("int")), 6).alias("fallback"), F.median(F.when(~rejected, length)).alias("median_length"))


def failure_taxonomy(df: DataFrame, reason: Column, order: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Counts by reason, and the first k failed rows."""
    failed = df.withColumn("reason", reason).where("reason is not null")
    return failed.groupBy("reason").agg(F.count("*").alias("n")), failed.orderBy(order).limit(k)


def live_keys(values: DataFrame, rules: DataFrame, by: list[str], depth: int = 4) -> DataFrame:
    """is a key heard?  values(by, key, value) and rules(key, needs): a key is live if every key it needs is live and not zero; keys without rules are live.

    The rules nest at most ``depth`` deep, so the recursion is unrolled into that many joins.
    """
    live = values.select(*by, "key", "value").withColumn("live", F.lit(True))
    need = values.join(rules, "key").select(*by, "key", F.col("needs").alias("n"))
    for _ in range(depth):
        on = live.select(*by, F.col("key").alias("n"), (F.col("live") & F.coalesce(F.col("value") != 0, F.lit(False))).alias("on"))
        met = need.join(on, [*by, "n"], "left").groupBy(*by, "key").agg(F.bool_and(F.coalesce("on", F.lit(False))).alias("ok"))
        live = live.select(*by, "key", "value").join(met, [*by, "key"], "left").select(*by, "key", "value", F.coalesce("ok", F.lit(True)).alias("live"))
    return live


def section_share(turns: Column) -> Column:
    """Share of turns with all sections; null without turns."""
    full = F.filter(turns, lambda t: F.forall(F.lit(SECTIONS), lambda s: F.contains(F.coalesce(t, F.lit("")), s)))
    return F.round(F.try_divide(F.size(full), F.size(turns)), 6)


def direction_faults(text: Column, rises: Column, up: str = r"\b(rises|louder|brighter|higher|lifts|climbs)\b", down: str = r"\b(falls|quieter|darker|lower|drops|softens)\b", negation: str = r"\b(no|not|never|without|neither|nor)\b") -> Column:
    """Clauses that claim the other direction than the measured one, without a negation in the clause; null direction has none."""
    clauses = F.filter(F.split(F.coalesce(text, F.lit("")), r"[.;!?\n]"), lambda c: ~c.rlike("(?i)" + negation))
    wrong = F.when(rises, F.size(F.filter(clauses, lambda c: c.rlike("(?i)" + down) & ~c.rlike("(?i)" + up)))).when(~rises, F.size(F.filter(clauses, lambda c: c.rlike("(?i)" + up) & ~c.rlike("(?i)" + down))))
    return F.coalesce(wrong, F.lit(0))


def narration_problems(text: Column, supported: dict[str, Column], words: dict[str, str]) -> Column:
    """Names of what is wrong with a narration: empty, quoted numbers, named parameters, and dimensions it speaks of that ``supported`` does not hold.

    ``words``: a pattern of each dimension; a negated clause speaks of none.
    """
    t = F.coalesce(text, F.lit(""))
    numbers = F.when(F.rlike(t, F.lit(r"(?i)\d+(?:\.\d+)?\s?(?:hz|khz|db|ms|%|percent)\b|\b\d+\.\d+\b")), F.lit("quotes numbers"))
    params = F.when(F.rlike(t, F.lit(tx.SNAKE_CASE)), F.lit("names parameters"))
    dims = [F.when(tx.unnegated(t, w) & ~F.coalesce(supported[d], F.lit(False)), F.lit("unsupported: " + d)) for d, w in words.items()]
    found = F.filter(F.array(numbers, params, *dims), lambda c: c.isNotNull())
    return F.when(F.trim(t) == "", F.array(F.lit("empty"))).otherwise(found)


def subject_claims(text: Column, subjects: list[str], up: str, down: str) -> Column:
    """array<struct<subject, direction>> of a text in first-seen order without repeats: a sentence's subject is the first it names, else that of the
    sentence before; a sentence that claims both directions or none claims nothing."""
    sentences = F.split(F.coalesce(text, F.lit("")), r"[.;!?\n]")
    named = "(?i)\\b(" + "|".join(subjects) + ")\\b"
    kind = "struct<last:string,found:array<struct<subject:string,direction:int>>>"
    start = F.struct(F.lit(None).cast("string").alias("last"), F.array().cast("array<struct<subject:string,direction:int>>").alias("found")).cast(kind)

    def step(s: Column, c: Column) -> Column:
        own = F.lower(F.regexp_extract(c, named, 1))
        subject = F.when(own != "", own).otherwise(s["last"])
        rises, falls = F.rlike(c, F.lit("(?i)" + up)), F.rlike(c, F.lit("(?i)" + down))
        claim = F.struct(subject.alias("subject"), F.when(rises, 1).otherwise(-1).alias("direction"))
        fresh = subject.isNotNull() & (rises != falls) & ~F.coalesce(F.array_contains(s["found"], claim), F.lit(False))
        return F.struct(subject.alias("last"), F.when(F.coalesce(fresh, F.lit(False)), F.array_append(s["found"], claim)).otherwise(s["found"]).alias("found")).cast(kind)

    return F.aggregate(sentences, start, step, lambda s: s["found"])


def contradictions(claims: Column, measured: Column) -> Column:
    """Labels ``subject:direction`` of the claims that go against a map of measured directions (1, -1), in their order."""
    against = F.filter(claims, lambda c: F.coalesce(F.try_element_at(measured, c["subject"]) == -c["direction"], F.lit(False)))
    return F.transform(against, lambda c: F.concat(c["subject"], F.lit(":"), F.when(c["direction"] > 0, "up").otherwise("down")))


def claim_sets(predicted: Column, grounded: Column, measured: Column) -> list[Column]:
    """Claims without ground, measured changes nobody claimed, and those all three share."""
    return [F.array_sort(F.array_except(predicted, grounded)).alias("unfounded"), F.array_sort(F.array_except(measured, F.array_union(predicted, grounded))).alias("missed"), F.array_sort(F.array_intersect(F.array_intersect(predicted, grounded), measured)).alias("agreed")]


def counted_holdout(df: DataFrame, h: str, tie: str, size: Column, most: float, count: int) -> DataFrame:
    """P2 in count mode, P16: the ``count`` rows of smallest hash among those whose size is within ``most`` are held out; both sides keep a row if there are two."""
    n = df.count()
    first = df.where(size <= most).orderBy(h, tie).limit(max(1, min(count, n - 1)) if n > 1 else 0).select(tie, F.lit(True).alias("__v"))
    return df.join(first, tie, "left").withColumn("side", F.when(F.col("__v"), "val").otherwise("train")).drop("__v")


def drawn_bars(key: Column, least: int, most: int) -> Column:
    """A bar count from the first md5 byte."""
    return (F.conv(F.substring(F.md5(key), 1, 2), 16, 10).cast("int") % (most - least + 1)) + least


def agent_record_errors(ident: Column, messages: Column, audios: Column, tools: list[str]) -> Column:
    """V3: the common rules with a system turn first; at least three messages, no later system turn, known tools in JSON calls, no audio tag in assistant and system turns."""
    rest = F.slice(messages, F.lit(2), F.greatest(F.size(messages), F.lit(1)))
    name = lambda m: F.get_json_object(m["content"], "$.name")
    extra = F.array(
        F.when(F.size(messages) < 3, F.lit("too_few_messages")), F.when(~F.try_element_at(messages, F.lit(2))["role"].eqNullSafe("user"), F.lit("second_message_not_user")), F.when(F.exists(rest, lambda m: m["role"] == "system"), F.lit("later_system_turn")),
        F.when(F.exists(messages, lambda m: (m["role"] == "tool_call") & F.try_parse_json(m["content"]).isNull()), F.lit("tool_call_not_json")),
        F.when(F.exists(messages, lambda m: (m["role"] == "tool_call") & F.try_parse_json(m["content"]).isNotNull() & ~F.coalesce(name(m).isin(tools), F.lit(False))), F.lit("tool_call_unknown_tool")),
        F.when(F.exists(messages, lambda m: m["role"].isin("assistant", "system") & F.contains(F.coalesce(m["content"], F.lit("")), F.lit("<audio>"))), F.lit("audio_tag_in_own_turn")),
    )
    return F.concat(conversation_errors(ident, messages, audios, ["system", "user", "assistant", "tool_call", "tool_response"], "system"), F.filter(extra, lambda c: c.isNotNull()))


def reads_before_writes(events: DataFrame, ident: str, given: DataFrame | None = None) -> DataFrame:
    """events(ident, i, kind, path): reads of a path that nothing wrote before and that is not given(ident, path)."""
    first = events.where("kind = 'write'").groupBy(ident, "path").agg(F.min("i").alias("__w"))
    bad = events.where("kind = 'read'").join(first, [ident, "path"], "left").where("__w is null or i <= __w").drop("__w")
    return bad if given is None else bad.join(given.select(ident, "path").distinct(), [ident, "path"], "left_anti")


def seen_before(messages: DataFrame, ident: str, refs: DataFrame, ref: str) -> DataFrame:
    """refs(ident, i, ref) with ``seen``: does an earlier message of the record contain it?  Joined inside a record, which is bounded."""
    m = messages.select(ident, F.col("i").alias("__j"), F.coalesce("content", F.lit("")).alias("__c"))
    got = refs.join(m, ident, "left").groupBy(ident, "i", ref).agg(F.bool_or((F.col("__j") < F.col("i")) & F.contains("__c", F.col(ref))).alias("seen"))
    return got.withColumn("seen", F.coalesce("seen", F.lit(False)))


def contains_ordered(items: Column, wanted: list[str]) -> Column:
    """Are the wanted values a subsequence?"""
    at = F.aggregate(items, F.lit(0), lambda s, x: F.when((s < len(wanted)) & (x == F.try_element_at(F.lit(wanted), s + 1)), s + 1).otherwise(s))
    return at == len(wanted)


def pooled_candidates(scored: DataFrame, query: str, name: str, least: float, size: int) -> DataFrame:
    """Names at or above ``least`` first, filled up by similarity to ``size``; ``padded`` tells which."""
    x = scored.withColumn("padded", F.col("cos") < least)
    return x.withColumn("place", F.row_number().over(Window.partitionBy(query).orderBy("padded", F.desc("cos"), name))).where(F.col("place") <= size)


def slice_starts(n: Column, agents: int, width: int, offset: Column) -> Column:
    """Starts of ``agents`` slices of ``width`` places among n, a stride apart from an offset; a slice over the end is moved back."""
    stride = F.greatest(F.lit(1), F.floor(n / agents))
    start = lambda i: (offset % stride + i * stride) % n
    return F.transform(F.sequence(F.lit(0), F.lit(agents - 1)), lambda i: F.when(start(i) + width > n, F.greatest(F.lit(0), n - width)).otherwise(start(i)).cast("long"))


def rotated_pool(scored: DataFrame, query: str, place: str, name: str, agents: int, width: int, each: int, least: float, offset: Column) -> DataFrame:
    """(query, name, pool_place): scored(query, place, name, cos) cut into rotated slices; a slice gives its names of at least ``least``, in
    order of place, then the most similar others, ``each`` in all; names of several slices count once, where they come first."""
    n = scored.groupBy(query).agg((F.max(place) + 1).alias("__n"))
    starts = n.select(query, F.posexplode(slice_starts(F.col("__n"), agents, width, offset)).alias("__s", "__at"))
    x = scored.join(starts, query).where((F.col(place) >= F.col("__at")) & (F.col(place) < F.col("__at") + width))
    picked = F.col("cos") >= least
    order = [F.when(picked, 0).otherwise(1), F.when(picked, F.col(place)), F.when(~picked, -F.col("cos")), F.col(place)]
    x = x.withColumn("__r", F.row_number().over(Window.partitionBy(query, "__s").orderBy(*order))).where(F.col("__r") <= each)
    first = x.groupBy(query, name).agg(F.min(F.struct("__s", "__r")).alias("__f"))
    return first.withColumn("pool_place", F.row_number().over(Window.partitionBy(query).orderBy("__f"))).drop("__f")


def first_passing(attempts: DataFrame, ident: str, attempt: str, passed: Column, most: int) -> DataFrame:
    """The first passing attempt of every id within ``most``, null if none, and the number rejected before it."""
    ok = attempts.where(F.col(attempt) < most).groupBy(ident).agg(F.min(F.when(passed, F.col(attempt))).alias("kept"), F.count("*").alias("__n"))
    return ok.withColumn("rejected", F.coalesce("kept", F.col("__n"))).drop("__n")


def micro_macro(df: DataFrame, truth: Column, found: Column) -> DataFrame:
    """Recalled over all true names, and the share of rows with any hit; over at least one."""
    hit = F.size(F.array_intersect(truth, found))
    return df.agg(F.round(F.sum(hit) / F.greatest(F.lit(1), F.sum(F.size(truth))), 6).alias("micro"), F.round(F.count_if(hit > 0) / F.greatest(F.lit(1), F.count("*")), 6).alias("macro"))


def centred_window(middle: Column, width: int, n: Column) -> list[Column]:
    """[first, last) of a window around a place, moved inside 0 .. n."""
    first = F.greatest(F.lit(0), F.least(F.floor(middle).cast("long") - width // 2, n - width))
    return [first.alias("w_first"), F.least(n, first + width).alias("w_last")]


def job_specs(a: DataFrame, b: DataFrame, ka: str, kb: str, salt: str) -> DataFrame:
    """Every pair of two bounded lists with a seed from its identity."""
    return a.select(ka).crossJoin(F.broadcast(b.select(kb))).withColumn("seed", F.xxhash64(F.concat_ws("|", F.col(ka).cast("string"), F.col(kb).cast("string"), F.lit(salt))))


def drawn_specs(a: DataFrame, b: DataFrame, ka: str, kb: str, count: int, salt: str) -> DataFrame:
    """``count`` independent draws of a pair, with repeats: job i takes the rows of both bounded lists that a keyed draw names, and a seed from its identity."""
    numbered = lambda t, k, i: t.select(k).distinct().withColumn(i, F.row_number().over(Window.orderBy(k)) - 1)
    na, nb = (t.select(k).distinct().agg(F.count("*").alias(c)) for t, k, c in ((a, ka, "__na"), (b, kb, "__nb")))
    jobs = a.sparkSession.range(count).withColumnRenamed("id", "job").crossJoin(F.broadcast(na)).crossJoin(F.broadcast(nb)).where("__na > 0 and __nb > 0")
    draw = lambda s, n: F.floor(keyed_draw(F.col("job").cast("string"), salt + s) * F.col(n)).cast("int")
    x = jobs.withColumn("__i", draw("a", "__na")).withColumn("__j", draw("b", "__nb")).join(F.broadcast(numbered(a, ka, "__i")), "__i").join(F.broadcast(numbered(b, kb, "__j")), "__j")
    return x.select("job", ka, kb, F.xxhash64(F.concat_ws("|", F.col("job").cast("string"), F.col(ka).cast("string"), F.col(kb).cast("string"), F.lit(salt))).alias("seed"))


def finished_specs(specs: DataFrame, files: DataFrame, key: str, meta: list[str]) -> DataFrame:
    """U32: specs whose file exists, with the file's columns."""
    return specs.join(files.select(key, *meta), key)


def capped_corruption(params: DataFrame, by: list[str], key: str, value: str, cap: int, salt: str, record: list[str] | None = None) -> DataFrame:
    """Of every batch of two or more parameters at most ``cap`` change, by keyed draws of ``CORRUPTIONS``; effects under 0.03 are left out after the cap.

    With ``record`` (columns that name the record of a batch) all batches of a record change no more than a total drawn from ``TOTALS``.
    """
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in (*by, key)])
    w = Window.partitionBy(*by)
    x = params.withColumn("__n", F.count("*").over(w)).where("__n >= 2").withColumn("__r", F.row_number().over(w.orderBy(F.md5(F.concat(ident, F.lit(salt))), key))).where(F.col("__r") <= cap)
    if record:
        total = weighted_choice(keyed_draw(F.concat_ws("|", *[F.col(c).cast("string") for c in record]), salt + "t"), [(str(n), w) for n, w in TOTALS]).cast("int")
        whole = Window.partitionBy(*record).orderBy(F.md5(F.concat(ident, F.lit(salt + "o"))), *by, key)
        x = x.withColumn("__t", F.row_number().over(whole)).where(F.col("__t") <= total).drop("__t")
    v = F.col(value)
    kind = weighted_choice(keyed_draw(ident, salt + "k"), CORRUPTIONS)
    new = F.when(kind == "drop", F.lit(0.0)).when(kind == "scale", v * 0.5).when(kind == "shift", F.least(F.lit(1.0), v + 0.2)).otherwise(1 - v)
    return x.withColumn("changed", F.round(new, 6)).where(F.abs(F.col("changed") - v) >= 0.03).drop("__n", "__r")


def exact_draw(params: DataFrame, record: list[str], batch: list[str], key: str, count: int, salt: str, cap: int = 3) -> DataFrame:
    """Of every record exactly ``count`` keys, or all that are eligible: batches of two or more keys, at most ``cap`` keys a batch; with a ``kind`` by the
    weights of ``MISTAKES``.  Ranks come from keyed hashes, so every key of a record is as likely as another; null keys take no part."""
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in (*record, *batch, key)])
    own = Window.partitionBy(*record, *batch)
    x = params.where(F.col(key).isNotNull()).withColumn("__n", F.count("*").over(own)).where("__n >= 2")
    x = x.withColumn("__b", F.row_number().over(own.orderBy(F.md5(F.concat(ident, F.lit(":" + salt))), key))).where(F.col("__b") <= cap)
    x = x.withColumn("__r", F.row_number().over(Window.partitionBy(*record).orderBy(F.md5(F.concat(ident, F.lit(":" + salt + "r"))), *batch, key))).where(F.col("__r") <= count)
    return x.withColumn("kind", weighted_choice(keyed_draw(ident, salt + "k"), MISTAKES)).drop("__n", "__b", "__r")


def strongest(df: DataFrame, by: list[str], name: str, a: str, b: str, least: float) -> DataFrame:
    """Of every group the name of largest difference above ``least``, or null."""
    d = F.abs(F.col(a) - F.col(b))
    return df.groupBy(*by).agg(F.max_by(F.when(d > least, F.col(name)), F.struct(F.coalesce(F.when(d > least, d), F.lit(-1.0)), F.col(name))).alias("cue"))


def narration_after(messages: DataFrame, ident: str, marker: Column) -> DataFrame:
    """Of every marked message the text at the next place, or three on if a read lies between; a trailing line ``Next: ...`` is cut."""
    w = Window.partitionBy(ident).orderBy("i")
    x = messages.withColumn("__m", marker).withColumn("__r1", F.lead("role", 1).over(w)).withColumn("__c1", F.lead("content", 1).over(w)).withColumn("__r3", F.lead("role", 3).over(w)).withColumn("__c3", F.lead("content", 3).over(w))
    text = F.when(F.col("__r1") == "assistant", F.col("__c1")).when((F.col("__r1") == "tool_call") & (F.col("__r3") == "assistant"), F.col("__c3"))
    return x.where("__m").select(ident, "i", F.regexp_replace(text, r"\nNext: [^\n]*$", "").alias("narration"))
