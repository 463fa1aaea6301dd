"""Near-duplicate groups and overlaps across splits against brute force."""

from __future__ import annotations

import random
import re

from corpusloom.llm import cross_splits as cs
from corpusloom.llm import near_duplicates as nd


def brute(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both and both * den >= num * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    groups = {}
    for i in ids:
        groups.setdefault(find(i), []).append(i)
    return {(i, r) for r, g in groups.items() if len(g) > 1 for i in g}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    hot = [rng.choice(vocabulary) for _ in range(60)]
    for i in range(120):
        if i % 3 == 0:  # a third of all rows are edits of one text
            words = list(hot)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(60)] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(2, 50))]
            if i % 7 == 0:
                words = rows[-1][1].lower().split()[:-1] + ["tail"] if rows[-1][1] else words
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, "   "), (203, "one two"), (204, "one two"), (205, "A b, c"), (206, "a B c!"), (207, "Ünï_cöde déjà vu 漢字 ½ x"), (208, "ünï cöde DÉJÀ vu 漢字 ½ x"), (209, "w1 " * 20_000), (210, "w1 " * 20_001)]
    return rows


def test_groups_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows] + [(None, "a b c", "x", 1)], "id long, text string, grp string, n int")
    got = {(r.id, r.grp) for r in nd.near_duplicate_groups(df, k=3, theta=0.6).collect()}
    assert got == brute(rows, 3, 6, 10)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert nd.near_duplicate_groups(df).count() == 0


def test_cross_split_groups_match(spark):
    rows = corpus()
    split = lambda i: ["train", "val", "test", None][i % 4]
    df = spark.createDataFrame([(i, t, split(i), "x") for i, t in rows], "id long, text string, split string, rep string")
    got = {(r.id, r.grp) for r in cs.cross_split_groups(df, k=3, theta=0.6).collect()}
    assert got == brute(rows, 3, 6, 10)


def test_index_counts_runs():
    import numpy as np

    texts = ["a b c d a b c", "b c d e", "", "x"]
    index = cs.TextIndex(texts, np.arange(4), np.array([7, 9, 9, 9]), 3, 12)
    back = cs.TextIndex.of_rows(index.rows())
    from corpusloom.llm.textkernel import word_hashes

    words = word_hashes(["a b c d z a b"])[0]
    lo, hi = back.intervals(np.stack([back.symbols(words[j : j + 5]) for j in range(3)], axis=1))
    assert (hi - lo).tolist() == [2, 2, 0, 0, 0]
    run = np.searchsorted(back.runs, lo[1])
    assert back.labels[back.group[back.entry[back.entries[run] : back.entries[run + 1]]]].tolist() == [7, 9]
    got, owner = back.words_of(np.array([1, 0, 2]))
    assert got.tolist() == word_hashes(["b c d e a b c d a b c"])[0].tolist() and owner.tolist() == [0] * 4 + [1] * 7


def test_several_shards_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(cs, "SHARD_WORDS", 100)
    rows = corpus()[:60] + [(500, "only one w1 w2 w3"), (501, None)]
    df = spark.createDataFrame([(i, t, ["train", "test"][i % 2]) for i, t in rows], "id long, text string, split string")
    got = {(r.id, r.grp) for r in cs.cross_split_groups(df, k=3, theta=0.6).collect()}
    assert got == brute(rows, 3, 6, 10)
    assert cs.cross_split_groups(df.where("false")).count() == 0
    assert cs.cross_split_groups(df.where("split = 'train'"), k=3, theta=0.6).count() > 0


def test_split_lists_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(nd, "HOT_LIST", 3)
    monkeypatch.setattr(nd, "BUCKET", 50)
    monkeypatch.setattr(cs, "SHARD_WORDS", 300)
    rng = random.Random(9)
    frame = [f"f{i}" for i in range(12)]  # a passage that a third of all texts hold and that is near to nothing else in them
    rows = corpus() + [(300 + i, " ".join(frame + [f"r{rng.randrange(40)}" for _ in range(14)])) for i in range(60)]
    df = spark.createDataFrame([(i, t, ["train", "val", None][i % 3]) for i, t in rows], "id long, text string, split string")
    want = brute(rows, 3, 6, 10)
    assert {(r.id, r.grp) for r in nd.near_duplicate_groups(df, k=3, theta=0.6).collect()} == want
    assert {(r.id, r.grp) for r in cs.cross_split_groups(df, k=3, theta=0.6).collect()} == want


def test_hot_lists_are_cut(spark):
    """A list of 30,000 postings, of one in a third of the texts, in ten chunks: no list holds more than twice the median."""
    import numpy as np

    m = 30_000
    ids = np.arange(m)
    at, name, flag = nd.spread_hot(np.zeros(m, np.uint64), ids, ids, np.full(m, 10), np.full(m, 50), np.ones(m, np.int32))
    asks, asked = (np.unique(name[(flag & f) > 0], return_counts=True)[1] for f in (nd.ASKS, nd.ASKED))
    assert len(asks) == len(asked) == 100 and asks.max() < 2 * np.median(asks) and asked.max() < 2 * np.median(asked)
    family = nd.spread_hot(np.zeros(m, np.uint64), ids, np.zeros(m, np.int64), np.full(m, 10), np.arange(m), np.ones(m, np.int32))
    assert ((family[2] & nd.ASKED) > 0).sum() <= 20


def test_alignments_are_maximal_matches(spark):
    held = "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12"
    text = "a1 a2 a3 a4 a5 x a7 a8 a9 a10 a11 a12 y"
    df = spark.createDataFrame([(1, text, 1, False), (2, held, 2, True), (3, "q " + held, 2, True)], "id long, text string, comp long, held boolean")
    got = [r for r in cs.evaluation_links(df, 3, 0.4).collect() if r.a == 1]
    assert len(got) == 1 and (got[0].shared, got[0].matches, got[0].longest, got[0].spans, got[0].words) == (7, 2, 6, 2, 11)


def test_pairs_of_a_large_key(spark):
    from pyspark.sql import functions as F

    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") < 290, F.col("id")).alias("grp"))
    got = nd.pairs_within(df, df, "grp", chunk=9)
    assert got.count() == got.distinct().count() == 100 * 100 + df.where("id % 3 <> 0 and id < 290").count()


def test_every_bucket_has_its_partition(spark):
    from pyspark.sql import functions as F

    from corpusloom.llm import packed

    for n in (1, 7, 64):
        names = packed.labels(n)
        df = spark.createDataFrame([(int(x), i) for i, x in enumerate(names)], "bucket int, own int").repartition(n, "bucket")
        assert all(r.own == r.part for r in df.select("own", F.spark_partition_id().alias("part")).collect())
