"""Grading with weights that null metrics renormalise away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weights of the metrics by grader (fixed values).  Conditional metrics are null where they do not apply.
WEIGHTS = {
    "main_v2": {"plan_alignment_for_overall": 0.45, "clap_net_improvement": 0.20, "plan_rationale_unique": 0.15, "hypothesis_grounding": 0.10, "section_structure": 0.05, "snake_case_clean": 0.025, "format_consistent": 0.025},
    "main_v3": {
        "batch_param_alignment": 0.15, "diagnosis_subsystem_coverage": 0.10, "clap_net_improvement": 0.15, "verdict_grounded": 0.05, "narration_clap_consistency": 0.05, "no_gt_leak": 0.05, "file_causality": 0.05,
        "snake_case_clean": 0.025, "format_consistent": 0.025, "llm_narration_plan_ref": 0.05, "llm_narration_param_specific": 0.05, "llm_narration_templateness": 0.05, "llm_narration_no_hallucination": 0.10,
        "llm_observations_audio_grounded": 0.10, "llm_verdict_residual_grounded": 0.05, "llm_verdict_novelty": 0.05, "mistake_recovery": 0.05, "code_mistake_recovery": 0.05,
    },
    "search_v2": {"gt_recovery": 0.30, "result_communicated": 0.20, "llm_candidates_audio_grounded": 0.15, "has_render_probes": 0.10, "shortlist_nonempty": 0.10, "no_gt_leak": 0.10, "closing_assistant": 0.025, "snake_case_clean": 0.0125, "format_consistent": 0.0125, "code_mistake_recovery": 0.05},
    "judge_v3": {
        "verdict_correct": 0.25, "result_communicated": 0.15, "output_schema_valid": 0.05, "judge_correct": 0.15, "tuple_size_correct": 0.05, "tuple_names_in_pool": 0.05, "missing_character_nonempty": 0.05, "no_match_narration_present": 0.05,
        "llm_candidates_audio_grounded": 0.10, "pool_candidates_discussed": 0.05, "has_render_probes": 0.025, "closing_assistant": 0.025, "format_consistent": 0.025, "snake_case_clean": 0.025,
    },
    "transcription": {"has_midi_insert": 0.20, "result_communicated": 0.25, "note_count_match": 0.20, "pitch_coverage": 0.10, "has_render_listen": 0.10, "closing_assistant": 0.05, "snake_case_clean": 0.05, "format_consistent": 0.05},
    "transcription_v4": {
        "has_midi_insert": 0.15, "result_communicated": 0.15, "note_count_match": 0.15, "has_verify_cycle": 0.15, "has_render_listen": 0.10, "verify_conclusion": 0.10, "perceptual_narration_clean": 0.05, "pitch_coverage": 0.05, "closing_assistant": 0.03,
        "snake_case_clean": 0.03, "format_consistent": 0.04,
    },
}


def overall(metrics: dict[str, Column], weights: dict[str, float]) -> Column:
    """sum(w v) / sum(w) over the non-null metrics, to 4 decimals; 0 if none applies.  Metrics that are not given are null."""
    held = [(metrics[m].cast("double"), w) for m, w in weights.items() if m in metrics]
    top = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in held), F.lit(0.0))
    low = sum((F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for v, w in held), F.lit(0.0))
    return F.when(low > 0, F.round(top / low, 4)).otherwise(0.0)


def overall_long(scores: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """G1 in the long form: scores(keys, grader, metric, v) with weights(grader, metric, w)."""
    j = scores.join(weights, ["grader", "metric"], "left").where("v is not null and w is not null")
    got = j.groupBy(*keys).agg(F.round(F.sum(F.col("v") * F.col("w")) / F.sum("w"), 4).alias("overall"))
    return scores.select(*keys).distinct().join(got, keys, "left").withColumn("overall", F.coalesce("overall", F.lit(0.0)))


def weight_table(spark) -> DataFrame:
    """The weights as (grader, metric, w)."""
    return spark.createDataFrame([(g, m, w) for g, ms in WEIGHTS.items() for m, w in ms.items()], "grader string, metric string, w double")


def dispatch(task: Column, version: Column) -> Column:
    """Grader of a task type and pipeline version; null if unknown."""
    new = F.coalesce(F.startswith(version, F.lit("v4")) | F.startswith(version, F.lit("v5")), F.lit(False))
    return (
        F.when(task == "main_agent", F.when(new | F.startswith(version, F.lit("v3")), "main_v3").otherwise("main_v2")).when(task == "search", "search_v2").when(task == "judge", "judge_v3")
        .when(task == "transcription", F.when(new, "transcription_v4").otherwise("transcription"))
    )


def keep_above(df: DataFrame, score: str, least: float | None) -> DataFrame:
    """All rows without a threshold, else those at or above it."""
    return df if least is None else df.where(F.col(score) >= least)


def hard_fail(score: Column, fidelity: Column) -> Column:
    """An execution fidelity below 1 makes the score 0; the row stays."""
    return F.when(fidelity < 1, F.lit(0.0)).otherwise(score)


def references(df: DataFrame, ident: str, seq: str, k: int, salt: int) -> DataFrame:
    """K other rows a row, by position: the next ones of a keyed order that wraps round.  No pairs are formed but those returned."""
    order = df.select(ident, seq, F.md5(F.concat(F.col(seq).cast("string"), F.lit(f":{salt}"))).alias("h"))
    n = order.agg(F.count("*").alias("n"))
    numbered = order.withColumn("bucket", F.conv(F.substring("h", 1, 4), 16, 10).cast("int"))
    per = numbered.groupBy("bucket").agg(F.count("*").alias("c")).withColumn("s", F.coalesce(F.sum("c").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = numbered.join(F.broadcast(per.select("bucket", "s")), "bucket").withColumn("i", F.col("s") + F.row_number().over(Window.partitionBy("bucket").orderBy("h", seq)) - 1).crossJoin(F.broadcast(n))
    asks = numbered.where("n > 1").select(F.col(ident).alias("a"), "n", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(k), F.col("n") - 1).cast("int"))).alias("step")).withColumn("j", (F.col("i") + F.col("step")) % F.col("n"))
    return asks.join(numbered.select(F.col("i").alias("j"), F.col(ident).alias("b")), "j").select("a", "step", "b")


def changed_enough(delta: Column, slight: Column, noise: Column) -> Column:
    """|delta| reaches both the slight threshold and twice the noise."""
    return F.abs(delta) >= F.greatest(slight, 2 * noise)


def noise_gate(distance: Column, floor: Column, loudness: Column, spread: Column) -> Column:
    """Mean distance within 1.25 floors and 0.3 dB, loudness difference within 0.5 and the spread."""
    return (distance <= 1.25 * floor + 0.3) & (F.abs(loudness) <= 0.5 + spread)


def spectral_distance(a: Column, b: Column, depth: float = 80.0) -> Column:
    """Mean |dB difference| over bins within ``depth`` dB of the peak of ``a``, weighted by the root of its power; arrays of dB, null if no bin counts."""
    peak = F.array_max(a)
    pairs = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] >= peak - depth)
    w = lambda p: F.pow(F.lit(10.0), p["x"] / 20)
    top = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.abs(p["x"] - p["y"]) * w(p))
    return F.try_divide(top, F.aggregate(pairs, F.lit(0.0), lambda s, p: s + w(p)))
