"""Queries over whole tables: every row takes part, values equal those of a plain computation."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from corpusloom.operators import composites as co
from corpusloom.operators import dedup, joins
from corpusloom.plans import registry
from corpusloom.plans.queries_curation import read


def run(spark, data, name):
    return registry.queries()[name](spark, data)


def test_no_key_range_is_left_out(spark, data):
    orders = {r[0] for r in read(spark, data, "lineitem").select("l_orderkey").collect()}
    assert {r.track for r in run(spark, data, "clip_slices").collect()} == orders and max(orders) >= 500
    parts = {(r.p_brand, r.p_partkey): r.p_retailprice for r in read(spark, data, "part").collect()}
    assert {r.key for r in run(spark, data, "live_keys").collect()} == {k for _, k in parts}
    want = {}
    for brand in {b for b, _ in parts}:
        own = [(k, v) for (b, k), v in parts.items() if b == brand]
        picks = [([k], v) for k, v in own] + [([k, j], v + w) for k, v in own for j, w in own if j != k]
        want[brand] = [p for p, _ in sorted(picks, key=lambda x: (-round(x[1], 9), x[0]))[:5]]
    got = {b: [None] * len(w) for b, w in want.items()}
    for r in run(spark, data, "slot_products").collect():
        got[r.s][r.rk - 1] = r.picks
    assert got == want
    pairs = {(r.a, r.b) for r in run(spark, data, "unrendered_pairs").collect()}
    assert pairs == {(a, b) for s, a in parts for t, b in parts if s == t and a != b and (a % 2 or b % 2) and not (a % 2 and b % 2 and (a + b) % 3 == 0)}
    zipped = run(spark, data, "positional_zip").collect()
    assert {r.c_name for r in zipped if r.c_name} == {r.c_name for r in read(spark, data, "customer").collect()}
    assert {r.s_name for r in zipped if r.s_name} == {r.s_name for r in read(spark, data, "supplier").collect()}


def test_long_diff_equals_map_diff(spark):
    a = {1: 0.5, 2: 0.5, 3: 0.5, 4: None}
    b = {2: 0.502, 3: 0.52, 4: 0.1, 5: 0.1}
    maps = spark.createDataFrame([(1, a, b)], "one int, a map<int,double>, b map<int,double>")
    sides = [spark.createDataFrame(list(x.items()), "key int, v double") for x in (a, b)]
    rows = lambda df: sorted(((r.key, r.va, r.vb) for r in df.collect()), key=repr)
    assert rows(joins.long_diff(*sides, ["key"], "v")) == rows(joins.map_diff(maps, "a", "b", ["one"]))


def test_no_row_is_filtered(spark, data):
    docs = {r.doc_id: r.source for r in read(spark, data, "documents").collect()}
    for name in ("hash_split_ratio", "counted_holdout", "masked_labels"):
        assert sorted(r.doc_id for r in run(spark, data, name).collect()) == sorted(docs)
    assert {r.n for r in run(spark, data, "id_lists").collect()} == {sum(s is not None for s in docs.values())}


def test_rankings_with_repeats_and_scores_are_repaired(spark, data):
    rows = run(spark, data, "ranking_repair").collect()
    assert len(rows) == read(spark, data, "judge_results").count()
    for r in rows:
        want = list(dict.fromkeys(x for x in r.given if x in r.names))
        rest = [x for x in r.names if x not in want]
        scored = sorted((x for x in rest if r.scores.get(x, -1) >= 0), key=lambda x: (-r.scores[x], r.names.index(x)))
        assert r.ranking == want + scored + [x for x in rest if x not in scored]
    assert any(len(r.given) > len(set(r.given)) for r in rows) and any(set(r.names) - set(r.given) for r in rows)


def test_mean_novelty_equals_brute_force(spark):
    sets = {1: "abc", 2: "abc", 3: "cde", 4: "xyz", 5: "abcd", 6: "a", 7: "q", 8: "q"}
    group = {i: "one" if i < 7 else "two" for i in sets} | {9: "alone"}
    sets[9] = "abc"
    df = spark.createDataFrame([(i, group[i], sorted(s)) for i, s in sets.items()], "id int, k string, g array<string>")
    want = {}
    for i, s in sets.items():
        js = [len(set(s) & set(t)) / len(set(s) | set(t)) for j, t in sets.items() if j != i and group[j] == group[i]]
        want[i] = round(1 - sum(js) / len(js), 6) if js else None
    assert {r.id: r.novelty for r in dedup.mean_novelty(df, "id", "k", "g").collect()} == want
    assert want[1] > 0  # a copy alone does not make a text's novelty 0


def test_mean_trigram_novelty_of_the_table(spark, data):
    texts = {r.judge_seq: (r.verdict or "", re.findall("[a-z0-9]+", (r.reasoning or "").lower())) for r in read(spark, data, "judge_results").collect()}
    sets = {i: (v, {tuple(w[j : j + 3]) for j in range(len(w) - 2)}) for i, (v, w) in texts.items() if len(w) >= 3}
    got = {r.judge_seq: r.novelty for r in run(spark, data, "mean_trigram_novelty").collect()}
    assert got.keys() == sets.keys()
    for i, (v, s) in sets.items():
        js = [len(s & t) / len(s | t) for j, (u, t) in sets.items() if j != i and u == v]
        assert abs(got[i] - (1 - sum(js) / len(js))) < 2e-6


def test_mean_novelty_in_parts_writes_no_pairs(spark, monkeypatch):
    """Every pair shares a gram: pairs crossed a shuffle before; now groups are cut into parts and tiles and the sums equal brute force."""
    for name, value in (("PART", 9), ("TILE", 4), ("STEP", 20)):
        monkeypatch.setattr(dedup, name, value)
    sets = {i: {"all", *(f"g{(i * j) % 17}" for j in range(1, 2 + i % 5))} for i in range(60)}
    group = {i: "large" if i % 3 else f"small{i % 4}" for i in sets}
    df = spark.createDataFrame([(i, group[i], sorted(s)) for i, s in sets.items()], "id long, k string, g array<string>")
    want = {}
    for i, s in sets.items():
        js = [len(s & t) / len(s | t) for j, t in sets.items() if j != i and group[j] == group[i]]
        want[i] = 1 - sum(js) / len(js)
    out = dedup.mean_novelty(df, "id", "k", "g")
    got = {r.id: (r.novelty, r.n_grams) for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[i][0] - want[i]) < 2e-6 and got[i][1] == len(sets[i]) for i in sets)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()  # no row a gram, of which pairs could be made


def test_unrendered_pairs_are_made_once(spark, monkeypatch):
    """Ids in several chunks, some in both inputs, twice or null; no pair is made distinct or shuffled (all were, three times)."""
    monkeypatch.setattr(co, "CHUNK", 3)
    missed = [("s", i) for i in (1, 3, 5, 7, 9, 11, 2)] + [("u", 1), ("u", None), (None, 4), ("s", 1)]
    top = [("s", i) for i in (2, 4, 6, 8)] + [("u", 2), ("v", 5), ("v", 6)]
    done = [("s", 1, 3), ("s", 3, 1), ("s", 2, 4), ("s", 4, 2), ("s", 9, 9), ("u", 5, 6), ("s", 1, 3)]
    m, t, d = (spark.createDataFrame(rows, schema) for rows, schema in ((missed, "k string, id long"), (top, "k string, id long"), (done, "k string, a long, b long")))
    out = co.unrendered_pairs(m, t, d, "id", "k")
    got = [tuple(r) for r in out.select("k", "a", "b").collect()]
    one = {(k, a, b) for k, a in missed for j, b in missed + top if k and k == j and a and b and a != b}
    assert len(got) == len(set(got)) and set(got) == (one | {(k, b, a) for k, a, b in one}) - set(done)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate")[0] and "LeftAnti" not in plan


def test_rendered_pairs_that_follow_from_ids_are_not_made(spark, data, monkeypatch):
    """A condition on two ids gives the pairs that a table of rendered pairs gives; the query's plan has no such table (it had, grouped by id, and spilled)."""
    missed = [("s", i) for i in (1, 3, 5, 7, 9, 11, 2)] + [("u", 1), ("u", None), (None, 4), ("s", 1)]
    top = [("s", i) for i in (2, 4, 6, 8)] + [("u", 2), ("v", 5), ("v", 6)]
    m, t = (spark.createDataFrame(rows, "k string, id long") for rows in (missed, top))
    one = {(k, a, b) for k, a in missed for j, b in missed + top if k and k == j and a and b and a != b}
    want = {(k, a, b) for k, a, b in one | {(k, b, a) for k, a, b in one} if (a + b) % 3 or a == 8}
    rendered = lambda a, b: F.when(a != 8, (a + b) % 3 == 0)  # noqa: E731 - null is not rendered
    monkeypatch.setattr(co, "CHUNK", 3)
    for most, pairs in ((100, 64), (0, 4)):  # chunks broadcast or shuffled, few tasks or many
        monkeypatch.setattr(co, "BROADCAST_IDS", most)
        monkeypatch.setattr(co, "TASK_PAIRS", pairs)
        got = [tuple(r) for r in co.unrendered_pairs(m, t, rendered, "id", "k").select("k", "a", "b").collect()]
        assert len(got) == len(set(got)) and set(got) == want
    plan = run(spark, data, "unrendered_pairs")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 1
    # Code that makes pairs is apart from the join, so that no more than an id's pairs with a chunk are held at once.
    assert [x for x in re.findall("Generate|Coalesce|Join", plan)] == ["Generate", "Coalesce", "Generate", "Generate", "Coalesce", "Join"]
