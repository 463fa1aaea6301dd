"""Operators without SQL against plain Python, on small fixtures."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens
from corpusloom.operators import audits as au
from corpusloom.operators import composites as co
from corpusloom.operators import conversations as cv
from corpusloom.operators import vectors, windows
from corpusloom.plans import workspace

_MSG = "array<struct<role:string,content:string>>"


def one(spark, schema, row, column):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first().x


def test_tail_bytes_keep_whole_characters(spark):
    for text in ("abc\ndef\nghi", "ä" * 50, "x\n" + "漢字" * 20, "🎛" * 9, "", "one"):
        for size in (3, 7, 10, 1000):
            cut = "\n".join(text.split("\n")[-2:])
            raw = cut.encode()[-size:]
            kept = cut if len(cut.encode()) <= size else raw.decode("utf-8", "ignore")
            want = text if kept == text else "[truncated]\n" + kept
            assert one(spark, "t string", (text,), cv.tail_lines(F.col("t"), 2, size)) == want, (text, size)


def test_replay_compares_whole_outputs(spark):
    long = " ".join(f"w{i}" for i in range(2000))  # over 5,000 characters
    cases = [("a", "a", "match"), ("a", None, "error"), ("x 1.0", "x 1.1", "acceptable"), ("x 1.0", "x 9.0", "divergent"), (long + " same", long + " other", "acceptable"), (long + " " + long.replace("w", "a"), long + " " + long.replace("w", "b"), "divergent"), ("fine", "Error: no", "error")]
    for a, b, want in cases:
        assert one(spark, "a string, b string", (a, b), cv.replay_class(F.col("a"), F.col("b"))) == want, (a[:20], b)


def test_mistakes_and_typos(spark):
    m = [("user", "u"), ("assistant", "a"), ("tool_call", "run x.json"), ("tool_response", "ok")]
    bad = lambda b: one(spark, f"m {_MSG}, b string", (m, b), cv.inject_mistake(F.col("m"), F.col("b"), F.lit("Error"), F.lit("a typo")))
    assert [(x.role, x.content) for x in bad("run x.jso")] == [*m[:2], ("tool_call", "run x.jso"), ("tool_response", "Error"), ("assistant", "a typo"), *m[2:]]
    assert [(x.role, x.content) for x in bad("run x.json")] == m and [(x.role, x.content) for x in bad(None)] == m
    assert len(one(spark, f"m {_MSG}, b string", (m[:2], "z"), cv.inject_mistake(F.col("m"), F.col("b"), F.lit("E"), F.lit("d")))) == 2
    rows = [(i, p) for i in range(40) for p in ("a/b/preset.json", "preset.json", "x.py", "noext", None)]
    got = spark.createDataFrame(rows, "i int, p string").select("p", cv.path_typo(F.col("p"), F.col("i").cast("string")).alias("t")).collect()
    for r in got:
        if r.p in ("x.py", "noext", None):
            assert r.t is None
        else:
            head, base = r.p.rpartition("/")[::2]
            assert r.t.rpartition("/")[0] == head and len(r.t) == len(r.p) - 1 and r.t.rpartition("/")[2][0] == base[0]
    assert len({r.t for r in got if r.p == "preset.json"}) >= 4


def test_realigned_openers(spark):
    df = spark.createDataFrame([(1, [("user", "<audio>\nold"), ("assistant", "a")]), (2, [("user", "no audio")]), (3, [("user", "<audio>")]), (4, None)], f"k int, messages {_MSG}")
    p = spark.createDataFrame([(1, "new"), (2, "new"), (4, "new")], "k int, prompt string")
    got = {r.k: (r.aligned, r.messages and [m.content for m in r.messages]) for r in cv.realigned_openers(df, p, ["k"], "prompt").collect()}
    assert got == {1: (True, ["<audio>\nnew", "a"]), 2: (False, ["no audio"]), 3: (False, ["<audio>"]), 4: (False, None)}


def test_text_faults_and_problems(spark):
    f = lambda t: one(spark, "t string, h string, v array<string>", (t, "he said the bright pad", ["0.52"]), co.text_faults(F.col("t"), F.col("h"), F.col("v")))
    assert f(None) == ["empty"] and f(" ") == ["empty"] and f("fine text") == []
    assert f('As an AI the oracle says "the bright" at 0.52') == ["meta", "leak", "quotes", "copies values"]
    p = lambda t: one(spark, "t string", (t,), au.narration_problems(F.col("t"), {"width": F.lit(False), "tone": F.lit(True)}, {"width": r"\bwide\b", "tone": r"\bdark\b"}))
    assert p("") == ["empty"] and p("a dark pad. It is not wide.") == [] and p("wide at 5 Hz with env_1_decay") == ["quotes numbers", "names parameters", "unsupported: width"]


def test_subject_claims(spark):
    up, down = r"\b(rises|louder)\b", r"\b(falls|quieter)\b"
    text = "The level rises. It falls later; the filter falls and rises. Filter falls! The level rises. louder"
    got = one(spark, "t string", (text,), au.subject_claims(F.col("t"), ["filter", "level"], up, down))
    assert [(c.subject, c.direction) for c in got] == [("level", 1), ("level", -1), ("filter", -1)]
    labels = one(spark, "t string, m map<string,int>", (text, {"filter": 1, "level": -1}), au.contradictions(au.subject_claims(F.col("t"), ["filter", "level"], up, down), F.col("m")))
    assert labels == ["level:up", "filter:down"]
    assert one(spark, "t string", (None,), au.subject_claims(F.col("t"), ["filter"], up, down)) == [] and one(spark, "t string", ("rises",), au.subject_claims(F.col("t"), ["filter"], up, down)) == []


def test_rotated_pool(spark):
    n, agents, width, each, least = 23, 3, 6, 4, 0.5
    cos = {(q, i): round(math.sin(q * 7 + i * 3), 6) for q in range(5) for i in range(n)}
    df = spark.createDataFrame([(q, i, f"n{i % 20}", c) for (q, i), c in cos.items()], "q int, place long, name string, cos double")
    got = {}
    for r in au.rotated_pool(df, "q", "place", "name", agents, width, each, least, F.col("q") * 5).collect():
        got.setdefault(r.q, {})[r.pool_place] = r.name
    for q in range(5):
        stride, pool = n // agents, []
        for i in range(agents):
            start = (q * 5 % stride + i * stride) % n
            start = max(0, n - width) if start + width > n else start
            own = range(start, start + width)
            picks = [p for p in own if cos[q, p] >= least] + sorted((p for p in own if cos[q, p] < least), key=lambda p: (-cos[q, p], p))
            pool += [f"n{p % 20}" for p in picks[:each] if f"n{p % 20}" not in pool]
        assert [got[q][k] for k in sorted(got[q])] == pool


def test_draws_and_caps(spark):
    a, b = spark.range(5).withColumnRenamed("id", "a"), spark.range(9).withColumnRenamed("id", "b")
    got = au.drawn_specs(a, b, "a", "b", 3000, "s").collect()
    assert len(got) == 3000 and {r.job for r in got} == set(range(3000)) and {(r.a, r.b) for r in got} == {(i, j) for i in range(5) for j in range(9)} and len({r.seed for r in got}) == 3000
    assert au.drawn_specs(a.where("false"), b, "a", "b", 10, "s").count() == 0
    p = spark.range(4000).select((F.col("id") % 200).alias("r"), (F.col("id") % 400).alias("g"), F.col("id").alias("k"), ((F.col("id") % 97) / 97).alias("v"))
    by_batch, by_record = {}, {}
    for r in au.capped_corruption(p, ["r", "g"], "k", "v", 3, "c", ["r"]).collect():
        by_batch[r.g] = by_batch.get(r.g, 0) + 1
        by_record[r.r] = by_record.get(r.r, 0) + 1
        assert abs(r.changed - r.v) >= 0.03
    assert max(by_batch.values()) <= 3 and max(by_record.values()) <= 6 and len(by_record) < 180


def test_candidate_pool_is_filled(spark):
    scored = spark.createDataFrame([(1, "a", 0.9), (1, "b", 0.5), (2, "c", 0.4)], "q int, n string, cos double")
    truth = spark.createDataFrame([(1, "a"), (1, "t"), (2, "zz"), (3, "d")], "q int, n string")
    universe = spark.createDataFrame([(x,) for x in "abcdefghijkt"], "n string")
    got = {}
    for r in vectors.candidate_pool(scored, truth, universe, "q", "n", 6).orderBy("q", "place").collect():
        got.setdefault(r.q, []).append((r.n, r.kind))
    assert [k for _, k in got[1]] == [0, 0, 1, 2, 2, 2] and {n for n, k in got[1] if k == 0} == {"a", "t"} and got[1][2][0] == "b"
    assert 2 not in got and len(got[3]) == 6 and got[3][0] == ("d", 0) and len({n for n, _ in got[3]}) == 6


def test_windows_edge_cases(spark):
    df = spark.createDataFrame([(1, 0.0, 2.0), (1, 1.0, 3.0), (1, 1.5, 1.75), (2, 0.0, 1.0), (3, 5.0, 5.0)], "g int, s double, e double")
    got = {r.g: r.density for r in windows.overlap_density(df, ["g"], "s", "e").collect()}
    assert got == {1: round((1.0 + 0.25 + 0.25) / 3, 6), 2: 0.0, 3: None}
    keys = spark.createDataFrame([(1, k, v, r) for k, v, r in (("a", 10.0, 5), ("b", 5.0, 5), ("c", 1.0, 5), ("d", None, 5), ("e", 0.5, 1))] + [(2, "x", 1.0, 5), (2, "y", 1.0, 5), (3, "z", 0.0, 5)], "g int, k string, v double, r int")
    got = {(r.g, r.k): r.coarse for r in windows.impact_split(keys, ["g"], "v", "k", 0.8, "r").collect()}
    assert got == {(1, "a"): True, (1, "b"): True, (1, "c"): False, (1, "d"): False, (1, "e"): True, (2, "x"): True, (2, "y"): True, (3, "z"): True}


def test_corrupted_notes(spark):
    rows = [(i, [(60 + j, j * 0.5, 0.25) for j in range(4)]) for i in range(60)] + [(900, [(60, 0.0, 1.0)] * 2), (901, None)]
    got = {r.i: r for r in cv.corrupt_notes(spark.createDataFrame(rows, "i int, n array<struct<pitch:int,start_s:double,dur_s:double>>"), "i", "n", "x").collect()}
    assert got[900].changed is None and got[901].changed is None
    kinds = {(len(r.changed) - 4, sum(a != b for a, b in zip(r.n, r.changed, strict=False))) for i, r in got.items() if i < 60}
    assert {k[0] for k in kinds} == {-1, 0, 1} and all(got[i].changed != got[i].n for i in range(60))


def test_token_count(spark):
    f = lambda t, e=None: one(spark, "t string", (t,), tokens.token_count(F.col("t"), e))
    assert (f("Hello, world!"), f(""), f(None)) == (4, 0, 0) and (f("a b  c", lambda t: t.split()), f(None, list)) == (3, 0)


def test_tables_that_no_result_reads_are_removed(spark):
    import os

    made = []

    def query():
        a = workspace.materialize(spark.range(10), "first")
        b = workspace.materialize(a.where("id > 3"), "second")
        made.extend(workspace._folders[-2:])
        return b.select("id")

    out = workspace.tidy(query)()
    local = [p.removeprefix("file:") for p in made]
    assert not os.path.exists(local[0]) and os.path.exists(local[1]) and out.count() == 6


@pytest.mark.parametrize("name", ["record_grammar", "claim_contradictions"])
def test_all_records_take_part(spark, data, name):
    from corpusloom.plans import registry
    from corpusloom.plans.queries_curation import read

    rows = registry.queries()[name](spark, data).collect()
    assert len(rows) == read(spark, data, "documents").count() if name == "claim_contradictions" else sum(r.n for r in rows) > 0
