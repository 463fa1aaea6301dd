"""Block-against-block meetings: the pairs of a plain count, and nothing that grows with the pairs is written."""

from __future__ import annotations

import glob
import random
import tempfile
import time

import numpy as np

from corpusloom.llm import meetings
from corpusloom.llm import textkernel as K
from corpusloom.plans.workspace import materialize


def _texts():
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [[r.choice(words) for _ in range(r.randrange(12, 40))] for _ in range(60)]
    texts = [w[:] for w in base]
    for w in base[:40]:
        texts.append([x if r.random() > 0.06 else r.choice(words) for x in w])
    texts += [[*base[50], r.choice(words)] for _ in range(30)]  # a group that is asked as a whole
    return [" ".join(w) for w in texts]


def test_blocks_give_every_near_pair_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(meetings, "PIECE", 300)
    monkeypatch.setattr(meetings, "STEP", 50)
    monkeypatch.setattr(meetings, "HELD", 100)
    texts = _texts()
    comp = [100 if i >= 100 else i for i in range(len(texts))]
    size = [30 if c == 100 else 1 for c in comp]
    bits, cells = 12, np.zeros(1 << 12)
    sets = {}
    for lo, h, d, m in K.shingle_sets(texts, 3):
        np.add.at(cells, (h >> np.uint64(K.HASH_BITS - bits)).astype(int), 1)
        sets |= {lo + i: set(h[d == i].tolist()) for i in range(m)}
    ranks = spark.sparkContext.broadcast(np.minimum(255, np.log2(cells + 1) * 8).astype(np.uint8).tobytes())
    df = spark.createDataFrame(list(zip(range(len(texts)), texts, comp, size, strict=True)), "id long, text string, comp long, csize int").repartition(3)
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])
    want = {(a, b) for a in sets for b in sets if comp[a] != comp[b] and near(a, b)}
    written = meetings.write_blocks(df.mapInArrow(meetings.postings(3, 0.6, ranks, 4), meetings.SCHEMA))
    met = meetings.meet(spark, (written, 4), None, 0.6, meetings.SLACK * 0.6)
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    got = {(r.q, r.g) for r in met.collect()}
    assert {(a, comp[b]) for a, b in want if (size[a], comp[a]) < (size[b], comp[b])} <= got
    # What does not share its runs is left out before it is counted.
    assert len(got) < 3 * len(want)
    asked = meetings.write_blocks(df.where("id % 2 = 0").mapInArrow(meetings.postings(3, 0.6, None, 2), meetings.SCHEMA))
    got = {(r.q, r.g) for r in meetings.meet(spark, (asked, 2), (written, 4), 0.6, meetings.SLACK).collect()}
    assert {(a, comp[b]) for a, b in want if b % 2 == 0} <= got


def test_a_written_table_leaves_no_shuffle_files(spark):
    files = lambda: set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*"))
    before = files()
    table = materialize(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "clean")
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert sum(r["count"] for r in table.collect()) == 1000


def test_several_shards_leave_no_postings(spark, monkeypatch):
    """The postings of both sides go as soon as they are joined, and the route through them finds the pairs of one shard."""
    from corpusloom.llm import cross_splits
    from corpusloom.llm import near_duplicates as nd
    from corpusloom.plans.workspace import shared_dir

    df = spark.createDataFrame([(i, t, ("train", "val", "test")[i % 3]) for i, t in enumerate(_texts())], "id long, text string, split string")
    folders = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/corpusloom-postings-*"))
    before = folders()
    want = {(r.id, r.grp) for r in cross_splits.cross_split_groups(df, k=3, theta=0.6).collect()}
    monkeypatch.setattr(cross_splits, "SHARD_WORDS", 300)
    monkeypatch.setattr(nd, "BUCKET", 300)
    assert {(r.id, r.grp) for r in cross_splits.cross_split_groups(df, k=3, theta=0.6).collect()} == want and len(want) > 60
    assert folders() == before
