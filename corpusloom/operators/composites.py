"""Composite operators."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.numbers import bucket
from corpusloom.operators.aggregates import percentiles
from corpusloom.operators.windows import stage_bucket
from corpusloom.plans.workspace import materialize, materialize_counted

# Families of parameter names by prefix, in order (fixed values).
FAMILIES = [
    ("osc", "osc_"), ("osc", "unison_"), ("env1", "env_1_"), ("env2", "env_2_"), ("filter1", "filter_1_"), ("filter2", "filter_2_"), ("lfo", "lfo_"), ("reverb", "reverb_"), ("delay", "delay_"), ("chorus", "chorus_"),
    ("distortion", "distortion_"), ("compressor", "compressor_"), ("phaser", "phaser_"), ("flanger", "flanger_"), ("eq", "eq_"), ("modulation", "modulation_"),
]
# Ladders of perceptual names: limits and names (fixed values).
LADDERS = {
    "attack": ([0.02, 0.08, 0.25, 0.8], ["snappy near-instant", "plucked/fast", "quick", "gradual", "slow swelling"]),
    "decay": ([0.15, 0.6, 1.5], ["short", "moderate", "long", "very long"]),
    "sustain": ([0.15, 0.45, 0.75], ["percussive (drops to near-silence)", "low sustain", "moderate sustain", "held/high sustain"]),
    "release": ([0.15, 0.5, 1.2], ["tight cut-off", "natural release", "long tail", "very long lingering tail"]),
    "cutoff": ([45, 70, 90], ["very dark", "warm", "bright", "very bright / open"]),
    "resonance": ([0.15, 0.4, 0.7], ["no resonant peak", "mild resonance", "prominent resonance", "sharp/vocal resonance"]),
    "detune": ([0.1, 0.3], ["tight stacked voices", "gently detuned unison voices", "widely detuned unison voices"]),
    "lfo_rate": ([0.5, 2, 6], ["very slow swell", "slow modulation", "mid-rate wobble", "fast vibrato-rate"]),
}
# Names of the filter models by number (fixed values).
FILTER_MODELS = ["analog-style low-pass", "analog-style low-pass (alt)", "dirty low-pass", "ladder low-pass", "digital low-pass", "low-pass", "band-pass", "high-pass", "notch", "all-pass", "comb", "formant"]
# Units of the section ``fx`` (fixed values).
FX_UNITS = ["chorus", "compressor", "delay", "distortion", "eq", "filter_fx", "flanger", "phaser", "reverb"]
# Names of a mix file by priority, and perturbations in canonical order (fixed values).
MIX_NAMES = ["mix", "mixture", "mixdown", "full_mix", "master", "song"]


def family(name: Column) -> Column:
    """Family of a parameter by the first prefix that fits, else ``other``."""
    c = F.lit("other")
    for f, prefix in reversed(FAMILIES):
        c = F.when(F.startswith(name, F.lit(prefix)), F.lit(f)).otherwise(c)
    return c


def section(name: Column) -> Column:
    """Section of a parameter, the first rule that fits, else ``global``."""
    starts = lambda *ps: F.rlike(name, F.lit("^(?:" + "|".join(ps) + ")"))
    return (
        F.when(starts("osc_", "sample_"), "oscillator").when(starts("env_1_"), "envelope").when(starts("filter_"), "filter").when(starts(r"(?:lfo_\d|random_\d|env_[2-6])_"), "modulation").when(starts(*[u + "_" for u in FX_UNITS]), "fx").otherwise("global")
    )


def filter_model(model: Column) -> Column:
    """Name of a filter model, or its number in words; null for null."""
    return F.coalesce(F.try_element_at(F.lit(FILTER_MODELS), F.when(model >= 0, model + 1).otherwise(len(FILTER_MODELS) + 1).cast("int")), F.concat(F.lit("filter model "), model.cast("string")))


def unison(voices: Column, detune: Column) -> Column:
    """Voices with their spread in words."""
    return F.when(voices <= 1, "single voice (no unison)").otherwise(F.concat(voices.cast("string"), F.lit(" "), bucket(detune, *LADDERS["detune"])))


def three_way(df: DataFrame, target: str, init: str, final: str, span: str, touched: float = 0.05, exact: float = 0.01) -> DataFrame:
    """State of every key of the target: missing, untracked (no range), below_thresh (near the start), noisy (far from the end), exact."""
    t, i, f, s = (F.col(c) for c in (target, init, final, span))
    state = F.when(f.isNull(), "missing").when(s.isNull() | (s == 0), "untracked").when(F.abs(t - i) / s <= touched, "below_thresh").when(F.abs(t - f) / s > exact, "noisy").otherwise("exact")
    return df.withColumn("state", state)


def top_residuals(df: DataFrame, by: list[str], a: str, b: str, threshold: str, tie: str, k: int) -> DataFrame:
    """Per group the k keys of largest difference relative to its threshold."""
    x = df.withColumn("residual", F.round(F.abs(F.col(a) - F.col(b)) / F.col(threshold), 6)).where("residual is not null")
    return x.withColumn("rk", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("residual"), tie))).where(F.col("rk") <= k)


def repaired_paths(records: DataFrame, ident: str, paths: str, lookup: DataFrame, slug: str, path: str, slug_of) -> DataFrame:
    """Every path replaced by the lookup of its slug, in order; a record with an unresolved path is dropped whole."""
    x = records.select(ident, F.posexplode(paths).alias("i", "p")).withColumn(slug, slug_of(F.col("p"))).join(lookup.select(slug, path), slug, "left")
    good = x.groupBy(ident).agg(F.bool_and(F.col(path).isNotNull()).alias("ok"), F.transform(F.array_sort(F.collect_list(F.struct("i", path))), lambda e: e[path]).alias(paths))
    return good.where("ok").select(ident, paths)


def same_actions(want: Column, got: Column, got_writing: Column) -> Column:
    """Equal sets, or all wanted actions are there and all others only read."""
    w, g, m = (F.array_sort(F.array_distinct(c)) for c in (want, got, got_writing))
    return (w == g) | ((F.size(F.array_except(w, g)) == 0) & (F.size(F.array_except(m, w)) == 0))


def text_faults(text: Column, heard: Column, values: Column) -> Column:
    """U8: names of all rules that a text breaks: empty, meta, leak, quotes, copied values."""
    t = F.coalesce(text, F.lit(""))
    rules = [
        F.when(F.trim(t) == "", F.lit("empty")), F.when(t.rlike(r"(?i)\b(the user|as an ai|the prompt|instructions?)\b"), F.lit("meta")), F.when(t.rlike(r"(?i)\b(ground truth|oracle|correct answer)\b"), F.lit("leak")),
        F.when(F.exists(F.regexp_extract_all(t, F.lit('"([^"]{3,60})"'), F.lit(1)), lambda q: (F.size(F.split(q, " ")) >= 2) & F.contains(F.lower(F.coalesce(heard, F.lit(""))), F.lower(q))), F.lit("quotes")),
        F.when(F.exists(F.regexp_extract_all(t, F.lit(r"-?\d+\.\d+"), F.lit(0)), lambda n: F.array_contains(values, n)), F.lit("copies values")),
    ]
    return F.filter(F.array(*rules), lambda c: c.isNotNull())


def running_best(df: DataFrame, by: list[str], order: str, ident: str, distance: str) -> DataFrame:
    """Best (id of smallest distance) among the rows before each row."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("best_before", F.min_by(ident, F.struct(distance, order)).over(w))


def hybrid_score(a: Column, b: Column, weight: float) -> Column:
    """W a + (1 - w) b; the other one alone if one is null."""
    return F.coalesce(weight * a + (1 - weight) * b, a, b)


def modal_share(df: DataFrame, keys: list[str], limit: float) -> DataFrame:
    """U16: share of the most frequent combination and whether it stays within the limit."""
    c = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return c.agg(F.round(F.max("n") / F.sum("n"), 6).alias("share")).withColumn("varied", F.col("share") <= limit)


def set_recovery(truth: Column, found: Column) -> list[Column]:
    """Recalled share of the truth (null without truth) and whether the sets are equal."""
    return [F.round(F.try_divide(F.size(F.array_intersect(truth, found)), F.size(truth)), 6).alias("recall"), (F.array_sort(F.array_distinct(truth)) == F.array_sort(F.array_distinct(found))).alias("exact")]


def mix_file(names: Column) -> Column:
    """The name whose stem is first in the priority list, else the smallest that contains ``mix``, else null."""
    stem = lambda n: F.regexp_replace(F.lower(n), r"\.[^.]*$", "")
    named = lambda m: F.try_element_at(F.filter(names, lambda n: stem(n) == m), F.lit(-1))
    found = [named(m) for m in MIX_NAMES]
    return F.coalesce(*found, F.array_min(F.filter(names, lambda n: F.contains(stem(n), F.lit("mix")))))


def capabilities(stems: Column, midi: Column, has_mix: Column, order: list[str]) -> Column:
    """What a song allows, in the canonical order."""
    sections, tracks, notes = F.lit(["remove_section", "remove_full_song_section"]), F.lit(["remove_entire_track", "remove_automation", "swap_instrument_timbre", "remove_fx_processing", "remove_harmony_parts"]), F.lit(["quantize_midi_too_hard", "swap_instrument_timbre", "remove_harmony_parts"])
    none = F.array().cast("array<string>")
    got = F.concat(F.when(has_mix | (stems > 0), sections).otherwise(none), F.when(stems >= 2, tracks).otherwise(none), F.when(midi > 0, notes).otherwise(none))
    return F.filter(F.lit(order), lambda x: F.array_contains(got, x))


def clip_slices(df: DataFrame, track: str, bar: str, length: str, sizes: list[int]) -> DataFrame:
    """Consecutive clips of a track whose sizes in bars take turns; the sizes repeat, so a bar's place in the track gives its clip.

    (track, clip, first_bar, n_bars, seconds); a rest too short for its size is left out.
    """
    at, starts = F.row_number().over(Window.partitionBy(track).orderBy(bar)) - 1, [sum(sizes[:i]) for i in range(len(sizes))]
    x = df.select(track, bar, length).withColumn("__p", at).withColumn("__o", F.col("__p") % sum(sizes))
    turn = sum((F.col("__o") >= s).cast("int") for s in starts) - 1
    x = x.withColumn("__t", turn).withColumn("clip", (F.floor(F.col("__p") / sum(sizes)) * len(sizes) + F.col("__t")).cast("int"))
    x = x.groupBy(track, "clip", "__t").agg(F.min(bar).cast("long").alias("first_bar"), F.count("*").cast("int").alias("n_bars"), F.sum(length).cast("double").alias("seconds"))
    return x.where(F.col("n_bars") == F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("__t") + 1)).drop("__t")


def balanced_pick(df: DataFrame, group: str, stratum: str, ident: str, salt: str, shards: int = 16) -> DataFrame:
    """One row a group, from the stratum (true or false) picked less often so far where a group has both; ties by keyed hash.

    The balance is a state, kept exactly within each of ``shards`` hash shards of groups, so the whole is within ``shards`` of even.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        taken = {True: 0, False: 0}
        rows = []
        for _, g in pdf.sort_values([group, "__h"]).groupby(group, sort=True):
            sides = set(g[stratum])
            side = sides.pop() if len(sides) == 1 else taken[True] <= taken[False]
            pick = g[g[stratum] == side].iloc[0]
            taken[bool(side)] += 1
            rows.append((pick[group], pick[ident], bool(side)))
        return pd.DataFrame(rows, columns=[group, ident, stratum])

    x = df.select(group, stratum, ident).withColumn("__h", F.md5(F.concat(F.col(ident).cast("string"), F.lit(salt)))).withColumn("__s", F.pmod(F.xxhash64(group), F.lit(shards)))
    return x.groupBy("__s").applyInPandas(run, f"{group} {df.schema[group].dataType.simpleString()}, {ident} {df.schema[ident].dataType.simpleString()}, {stratum} boolean")


def policy_stats(steps: DataFrame) -> DataFrame:
    """steps(step_id, i, n, family, gain, won): wins, rate over all steps, mean gain overall, when won and by stage (early, mid, late), ordered by wins, rate and gain."""
    total = steps.agg(F.count_distinct("step_id").alias("steps"))
    stage = stage_bucket(F.col("i"), F.col("n"))
    by_stage = [F.round(F.avg(F.when(stage == s, F.col("gain"))), 6).alias(f"gain_{s}") for s in ("early", "mid", "late")]
    g = steps.groupBy("family").agg(F.count_if("won").alias("wins"), F.round(F.avg("gain"), 6).alias("gain"), F.round(F.avg(F.when(F.col("won"), F.col("gain"))), 6).alias("gain_won"), *by_stage)
    g = g.crossJoin(F.broadcast(total)).withColumn("win_rate", F.round(F.col("wins") / F.greatest(F.lit(1), F.col("steps")), 6)).drop("steps")
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("wins"), F.desc("win_rate"), F.desc("gain"), "family")))


def z_scores(df: DataFrame, key: str, value: str, calibration: DataFrame, row: list[str] | None = None) -> DataFrame:
    """(value - mean) / population deviation by key of a calibration table; null for a constant or unknown key.

    With ``row`` the values of every row (its keys' values) are centred by their mean first, in both tables.
    """
    if row:
        centred = lambda t: t.withColumn(value, F.col(value) - F.avg(value).over(Window.partitionBy(*row)))
        df, calibration = centred(df), centred(calibration)
    c = calibration.groupBy(key).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    return df.join(c, key, "left").withColumn("z", F.round(F.when(F.col("__s") > 0, (F.col(value) - F.col("__m")) / F.col("__s")), 6)).drop("__m", "__s")


def knots(df: DataFrame, by: list[str], value: str, points: list[float]) -> DataFrame:
    """The percentiles of every group as one array."""
    return percentiles(df, value, by, points).select(*by, F.col("q").alias("knots"))


def knot_position(x: Column, knots_: Column, points: list[float]) -> Column:
    """Piecewise-linear position of a value among knots, clamped at the ends."""
    last = len(points)
    c = F.lit(points[-1])
    for i in range(last - 1, 0, -1):
        lo, hi = F.element_at(knots_, i), F.element_at(knots_, i + 1)
        c = F.when(x < hi, F.when(hi == lo, F.lit(points[i])).otherwise(points[i - 1] + (points[i] - points[i - 1]) * (x - lo) / (hi - lo))).otherwise(c)
    return F.when(x <= F.element_at(knots_, 1), F.lit(points[0])).otherwise(c)


#: Ids of a chunk of one group, whose ids are an array; ids up to which these arrays are broadcast; pairs that one task makes, about.
CHUNK, BROADCAST_ROWS, TASK_PAIRS = 1000, 400_000, 64_000_000
#: Ids up to which chunks of 8 bytes an id are broadcast to meet chunks (32 MB).
BROADCAST_IDS = 4_000_000


def unrendered_pairs(missed: DataFrame, top: DataFrame, done: DataFrame | Callable[[Column, Column], Column], ident: str, by: str) -> DataFrame:
    """Pairs (both orders) of a missed id with a missed or top id of the same sample that were not rendered.

    Each pair is made once from chunks of a group's ids, and none is shuffled or compared with another. ``done`` has the rendered pairs, which
    become one array an id; where they follow from the ids it is a condition on two ids, so that they are not made at all.
    """
    tasks = 4 * missed.sparkSession.sparkContext.defaultParallelism
    marked = missed.select(by, F.col(ident).alias("a"), F.lit(True).alias("m")).union(top.select(by, F.col(ident).alias("a"), F.lit(False)))
    ids, n = materialize_counted(marked.where(F.col(by).isNotNull() & F.col("a").isNotNull()).groupBy(by, "a").agg(F.max("m").alias("m")), "ids")
    chunks = ids.groupBy(by).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n"))
    lists = ids.join(chunks, by).groupBy(by, F.pmod(F.xxhash64("a"), F.col("n")).alias("j")).agg(F.collect_list(F.when(F.col("m"), F.col("a"))).alias("x"), F.collect_list(F.when(~F.col("m"), F.col("a"))).alias("y"))
    lists = materialize(lists, "lists")
    if callable(done):
        return _chunk_pairs(lists, done, by, n <= BROADCAST_IDS, tasks)
    rendered = done.groupBy(by, "a").agg(F.collect_list("b").alias("r"))
    met = ids.repartition(tasks, by, "a").join(rendered, [by, "a"], "left").join(F.broadcast(lists) if n <= BROADCAST_ROWS else lists, by)
    # Every id meets the missed ids of each chunk; a missed one the others too.
    every = F.when(F.col("m"), F.concat("x", "y")).otherwise(F.col("x"))
    left = F.array_except(every, F.concat(F.array("a"), F.coalesce("r", F.array().cast(met.schema["x"].dataType))))
    return met.select(by, "a", F.explode(left).alias("b"))


def _chunk_pairs(lists: DataFrame, done: Callable[[Column, Column], Column], by: str, small: bool, tasks: int) -> DataFrame:
    """Chunk against chunk of a group: lists(by, x: missed ids, y: others); nothing is held but two chunks, and a run of pairs has few distinct ids, so that it packs well."""
    n = F.size("x") + F.size("y")
    pairs = lists.groupBy(by).agg(F.sum(n.cast("double")).alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
    tasks = max(tasks, min(int(pairs / TASK_PAIRS), 100_000))
    own = lists.select(by, F.col("x").alias("x1"), F.col("y").alias("y1"))
    other = lists.select(by, "x", "y")
    met = own.repartition(tasks).join(F.broadcast(other), by) if small else own.repartition(tasks, by).join(other.repartition(tasks, by), by)
    # Generated code holds all rows that one input row gives.  A coalesce to the same number of partitions moves nothing and parts the code,
    # so that these are the chunks of a group, the ids of a chunk and the pairs of an id with a chunk, never the pairs of two chunks.
    part = lambda df: df.coalesce(tasks)
    # A missed id meets all ids of a chunk, any other its missed ones.
    sides = part(met).select(by, F.inline(F.array(F.struct(F.col("x1").alias("p"), F.concat("x", "y").alias("q")), F.struct(F.col("y1").alias("p"), F.col("x").alias("q")))))
    a, b = F.col("a"), F.col("b")
    return part(sides.select(by, F.explode("p").alias("a"), "q")).select(by, "a", F.explode("q").alias("b")).where((a != b) & ~F.coalesce(done(a, b), F.lit(False)))


def slot_products(options: DataFrame, by: str, ident: str, value: str, slots: int, keep: int) -> DataFrame:
    """All ordered choices for 1 .. ``slots`` slots among a bounded sample's options, scored by the sum; the best ``keep`` a sample."""
    one = options.select(by, F.array(ident).alias("picks"), F.col(value).alias("score"))
    out, now = one, one
    for _ in range(slots - 1):
        now = now.join(options.select(by, F.col(ident).alias("__i"), F.col(value).alias("__v")), by).where(~F.array_contains("picks", F.col("__i"))).select(by, F.concat("picks", F.array("__i")).alias("picks"), (F.col("score") + F.col("__v")).alias("score"))
        out = out.union(now)
    return out.withColumn("rk", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(F.round("score", 9)), "picks"))).where(F.col("rk") <= keep)


def ranking_repair(df: DataFrame, given: str, candidates: str, scores: str) -> Column:
    """The valid ids of a given ranking, first occurrence each, then the other candidates by score (only those of 0 or more), then in their order."""
    valid = F.array_distinct(F.filter(F.col(given), lambda x: F.array_contains(candidates, x)))
    rest = F.array_except(F.col(candidates), valid)
    scored = F.transform(F.array_sort(F.transform(F.filter(rest, lambda x: F.coalesce(F.col(scores)[x] >= 0, F.lit(False))), lambda x: F.struct((-F.col(scores)[x]).alias("s"), F.array_position(candidates, x).alias("p"), x.alias("x")))), lambda e: e["x"])
    return F.concat(valid, scored, F.array_except(rest, scored))


def linear_scores(ranking: Column) -> Column:
    """Scores for a ranking without any: from 1 for the first down to 1 / n, as a map."""
    n = F.size(ranking)
    return F.map_from_arrays(ranking, F.transform(ranking, lambda x, i: (n - i) / n))


def deterministic_id(prefix: str, seed: Column) -> Column:
    """Prefix, 12 hexadecimal digits and 14 base-62 characters from sha-256 of the seed."""
    h = F.sha2(seed, 256)
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    chars = F.transform(F.sequence(F.lit(0), F.lit(13)), lambda i: F.substring(F.lit(alphabet), (F.conv(F.substring(h, 13 + i * 2, F.lit(2)), 16, 10).cast("int") % 62) + 1, F.lit(1)))
    return F.concat(F.lit(prefix + "_"), F.substring(h, 1, 12), F.array_join(chars, ""))


def nth_audio(df: DataFrame, ident: str, i: str, content: str, audios: str) -> DataFrame:
    """The n-th message with an audio tag takes the n-th audio of its record."""
    w = Window.partitionBy(ident).orderBy(i)
    tagged = F.contains(F.coalesce(F.col(content), F.lit("")), F.lit("<audio>"))
    return df.withColumn("__n", F.sum(tagged.cast("int")).over(w)).withColumn("audio", F.when(tagged, F.try_element_at(audios, F.col("__n").cast("int")))).drop("__n")


def gates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row (gate, passed, n_bad) a named rule; a rule is a condition that every row must meet, null counts as met."""
    one = df.agg(*[F.count_if(~F.coalesce(c, F.lit(True))).alias(f"g{i}") for i, c in enumerate(rules.values())])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("gate"), (F.col(f"g{i}") == 0).alias("passed"), F.col(f"g{i}").alias("n_bad")) for i, n in enumerate(rules)])))
