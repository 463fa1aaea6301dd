"""Core operators on small fixtures: nulls, ties, repeated rows, empty tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import numbers as num
from corpusloom.functions import text as tx
from corpusloom.operators import aggregates as agg
from corpusloom.operators import composites as co
from corpusloom.operators import conversations as cv
from corpusloom.operators import dedup, filters, grade, joins, sampling, validate, vectors, windows
from corpusloom.operators import graph


def one(df):
    return [tuple(r) for r in df.collect()]


def test_components_match_union_find(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_EDGES", 10)
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300, 300 + i) for i in range(1, 60)] + [(1, None), (None, None), (9, 9)]
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = dict(one(graph.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {x: find(x) for x in root}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cascade_takes_the_first_reason(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "long text"), (4, "ok")], "id int, t string")
    rules = [("null", F.col("t").isNull()), ("empty", F.col("t") == ""), ("long", F.length("t") > 5)]
    assert {r.id: r.reason for r in filters.cascade(df, rules).collect()} == {1: "empty", 2: "null", 3: "long", 4: "kept"}


def test_first_by_key_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, "", 3), (4, "", 4), (5, None, 5)], "seq int, id string, v int")
    got = dedup.first_by_key(df, ["id"], "seq", F.coalesce(F.col("id"), F.lit("")) == "")
    assert sorted(r.seq for r in got.collect()) == [1, 2, 4, 5]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (4.0,), (None,)], "v double")
    assert [r.n for r in agg.histogram(df, "v", 4).orderBy("bin").collect()] == [1, 1, 1, 1]
    assert one(agg.histogram(df.where("v = 1"), "v", 4)) == [(0, 1.0, 1)]
    assert agg.histogram(df, "v", 0).count() == 0 and agg.histogram(df.where("false"), "v", 4).count() == 0


def test_distribution_of_nothing_is_zero(spark):
    row = agg.distribution(spark.createDataFrame([], "v double"), "v").first()
    assert row.n == 0 and row.v_mean == 0.0 and row.p50 == 0.0


def test_python_number_idioms(spark):
    got = spark.range(0, 301).select("id", num.audio_tokens_seconds(F.col("id") / 100).alias("t"), num.audio_tokens_mel(F.col("id") / 100).alias("m")).collect()
    for r in got:
        frames = int(r.id / 100 * 100)
        half = lambda x: (x - 1) // 2 + 1
        assert r.t == half(half(half(frames % 100))) + frames // 100 * 13
        assert r.m == max(1, (half(frames) - 2) // 2 + 1)


def test_hashes_equal_python(spark):
    import hashlib

    words = ["a", "", "ünï", "x" * 1000]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", tx.hash32(F.col("w")).alias("a"), tx.hash64(F.col("w")).alias("b"), tx.hash128_mod(F.col("w"), 10_000).alias("c")).collect()
    for r in got:
        h = hashlib.md5(r.w.encode()).hexdigest()
        assert (r.a, int(r.b), r.c) == (int(h[:8], 16), int(h[:16], 16), int(h, 16) % 10_000)


def test_asof_takes_the_latest_not_after(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 5, 11), ("b", 3, 12), ("a", 0, 13)], "k string, t int, i int")
    right = spark.createDataFrame([("a", 1, 1.0, 1), ("a", 1, 2.0, 2), ("a", 6, 3.0, 3)], "k string, t int, v double, o long")
    assert {r.i: r.v for r in joins.asof_backward(left, right, ["k"], "t", "v", "o").collect()} == {10: 2.0, 11: 2.0, 12: None, 13: None}


def test_greedy_match_uses_each_once(spark):
    t = spark.createDataFrame([(1, 60, 0.0), (1, 60, 0.04), (1, 62, 1.0), (2, 60, 0.0)], "c int, p int, s double")
    p = spark.createDataFrame([(1, 60, 0.02), (1, 62, 1.2)], "c int, p int, s double")
    assert sorted(one(joins.greedy_match(t, p, "c", "p", "s", 0.05))) == [(1, 3, 2, 1), (2, 1, 0, 0)]


def test_matched_once(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a long, k string")
    b = spark.createDataFrame([(7, "x"), (8, "y"), (9, "y"), (10, "q")], "b long, k string")
    assert {(r.a, r.b, r.problem) for r in joins.matched_once(a, b, ["k"], "a", "b").collect()} == {(1, None, None), (2, None, "ambiguous"), (3, None, "none"), (None, 10, "unused")}


MESSAGES = "id string, messages array<struct<role:string,content:string>>, audios array<string>"


@pytest.mark.parametrize(
    ("record", "codes"),
    [
        (("r", [("user", "<audio> hi"), ("assistant", "ok")], ["a.wav"]), []),
        ((None, [("user", "hi"), ("assistant", "ok")], []), ["id_missing"]),
        (("r", [], []), ["messages_missing_or_empty"]),
        (("r", None, None), ["messages_missing_or_empty"]),
        (("r", [("assistant", "x"), ("assistant", None)], None), ["audios_missing_or_not_list", "first_message_not_user", "message_1_duplicate_adjacent_role:assistant", "message_1_content_not_string"]),
        (("r", [("user", "<audio><audio>"), ("tool_response", "x"), ("critic", "y")], [" "]), ["last_message_not_assistant", "message_0_multiple_audio_tags", "message_1_tool_response_before_tool_call", "message_2_invalid_role:critic", "audio_tag_mismatch:tags=2:audios=1", "audio_0_invalid_path"]),
        (("r", [("user", "a"), ("tool_call", "b"), ("tool_call", "c"), ("tool_response", "d"), ("tool_response", "e"), ("assistant", "f")], []), []),
    ],
)
def test_conversation_errors(spark, record, codes):
    df = spark.createDataFrame([record], MESSAGES)
    assert df.select(validate.conversation_errors(F.col("id"), F.col("messages"), F.col("audios")).alias("e")).first().e == codes


def test_error_modes(spark):
    df = spark.createDataFrame([(1, []), (2, ["x"])], "id int, errors array<string>")
    assert validate.apply_errors(df, "errors", "drop").count() == 1 and validate.apply_errors(df, "errors", "keep").count() == 2
    with pytest.raises(Exception, match="invalid row"):
        validate.apply_errors(df, "errors", "abort").collect()


def test_null_metrics_are_renormalised_away(spark):
    df = spark.createDataFrame([(1.0, None), (0.5, 0.0), (None, None)], "a double, b double")
    got = [r.s for r in df.select(grade.overall({"a": F.col("a"), "b": F.col("b")}, {"a": 0.3, "b": 0.1, "c": 0.6}).alias("s")).collect()]
    assert got == [1.0, 0.375, 0.0]


def test_references_are_others(spark):
    got = one(grade.references(spark.range(50).withColumnRenamed("id", "x"), "x", "x", 3, 1))
    assert len(got) == 150 and all(a != b for a, _, b in got) and len({(a, b) for a, _, b in got}) == 150
    assert grade.references(spark.range(1).withColumnRenamed("id", "x"), "x", "x", 3, 1).count() == 0


def test_budget_includes_the_crossing_row(spark):
    df = spark.createDataFrame([(i, i * 10, 4) for i in range(10)], "id long, h long, size int")
    assert sorted(r.id for r in sampling.take_budget(df, "h", "id", "size", 10, 100).collect()) == [0, 1, 2]
    assert sampling.take_budget(df, "h", "id", "size", 0, 100).count() == 0


def test_chunks_and_windows_cover_once(spark):
    df = sampling.with_row_number(spark.range(23).withColumnRenamed("id", "k"), "k")
    sizes = sorted(r["count"] for r in sampling.balanced_chunks(df, "i", 5).groupBy("chunk").count().collect())
    assert sizes == [4, 4, 5, 5, 5]
    assert sampling.coverage_window(5, 3, 9) == [3, 4, 0, 1, 2] and sampling.coverage_window(0, 0, 3) == []


def test_balanced_pick_alternates(spark):
    df = spark.createDataFrame([(g, s, g * 2 + s) for g in range(40) for s in (0, 1)], "g int, s int, i int").withColumn("s", F.col("s") == 1)
    got = co.balanced_pick(df, "g", "s", "i", "0", shards=1).collect()
    assert len(got) == 40 and abs(sum(r.s for r in got) - 20) <= 1


def test_sweep_line_and_legato(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, 1), (1, 1.0, 2.0, 2), (1, 1.5, 3.0, 3), (2, 0.0, 1.0, 4)], "c int, s double, e double, i int")
    assert dict(one(windows.max_concurrency(df, ["c"], "s", "e"))) == {1: 2, 2: 1}
    flags = {r.c: r.monophonic for r in windows.overlap_flags(df, ["c"], "s", "e", "i").collect()}
    assert flags == {1: False, 2: True}


def test_vectors(spark):
    e = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "b", [1.0, 1.0]), (4, "z", [0.0, 0.0])], "v int, n string, x array<double>")
    s = vectors.similarities(e.where("v = 1").withColumnRenamed("v", "q"), e, "q", "n", "x")
    assert {r.n: r.cos for r in s.collect()} == {"a": 1.0, "b": 0.707106781}
    truth = spark.createDataFrame([(1, "a")], "q int, n string")
    assert [r.n for r in vectors.top_k(vectors.exclude_truth(s, truth, "q", "n"), "q", "n", 3).collect()] == ["b"]
    pool = vectors.candidate_pool(s, truth, e.select("n"), "q", "n", 2).orderBy("place").collect()
    assert [r.n for r in pool] == ["a", "b"]
    assert agg.mean_pairwise_distance(e.where("v < 3"), "x").first().diversity == 1.0


def test_note_corruption_changes_or_is_null(spark):
    note = [(60, 0.0, 1.0), (62, 1.0, 1.0), (64, 2.0, 1.0)]
    df = spark.createDataFrame([(i, note) for i in range(40)] + [(99, note[:2])], "id int, notes array<struct<pitch:int,start_s:double,dur_s:double>>")
    got = cv.corrupt_notes(df, "id", "notes", "s").collect()
    assert all(r.changed is None or r.changed != r.notes for r in got) and sum(r.changed is not None for r in got) == 40
    assert [r.changed for r in got if r.id == 99] == [None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("It is not warm. Dark! ", "a/b-c d!!"), ("It is warm", "!!"), (None, None)], "t string, s string")
    got = df.select(tx.unnegated(F.col("t"), r"\bwarm\b").alias("w"), tx.slug(F.col("s")).alias("s")).collect()
    assert [(r.w, r.s) for r in got] == [(False, "a_b_c_d"), (True, "unnamed"), (None, None)]
    d = spark.createDataFrame([("a\nb", "a\nc"), (None, "x")], "a string, b string").select(cv.unified_diff("a", "b").alias("d")).collect()
    assert "-b" in d[0].d and "+c" in d[0].d and "+x" in d[1].d
    slots = spark.createDataFrame([("x ⟦narr:k⟧ y ⟦narr:q⟧", {"k": "v"})], "t string, m map<string,string>").select(cv.fill_slots(F.col("t"), F.col("m")).alias("t")).first()
    assert slots.t == "x v y ⟦narr:q⟧"


def test_replay_classes(spark):
    rows = [("a 1.0", "a 1.0"), ("a 1.0", "a 1.1"), ("a 1.0", "zzzz"), ("a", "Error: no"), ("a", None)]
    got = spark.createDataFrame(rows, "e string, g string").select(cv.replay_class(F.col("e"), F.col("g")).alias("c")).collect()
    assert [r.c for r in got] == ["match", "acceptable", "divergent", "error", "error"]


def test_mix_and_capabilities(spark):
    order = ["remove_section", "remove_full_song_section", "remove_entire_track", "remove_automation", "swap_instrument_timbre", "remove_fx_processing", "remove_harmony_parts", "quantize_midi_too_hard"]
    df = spark.createDataFrame([(["a.wav", "Master.wav"],), (["b_mix2.wav", "a_mix.wav"],), (["x.wav"],)], "n array<string>")
    got = df.select(co.mix_file(F.col("n")).alias("m"), co.capabilities(F.size("n"), F.lit(0), F.lit(False), order).alias("c")).collect()
    assert [r.m for r in got] == ["Master.wav", "a_mix.wav", None] and len(got[2].c) == 2 and got[0].c == order[:7]
