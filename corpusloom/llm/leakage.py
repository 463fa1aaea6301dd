"""Evaluation passages inside training texts, by winnowing.

Of every window of ``w`` neighbouring k-gram hashes the smallest is kept (the rightmost of equals).
A shared run of at least k + w - 1 words holds a whole window, so both texts keep the same k-gram at the
same place of the run: joining the kept fingerprints misses no such run.  Hits are then extended to the
left and right over the texts' words, and the runs that are long enough remain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import textkernel as K
from corpusloom.plans.workspace import materialize, materialize_counted, spread

#: Rows of the evaluation fingerprints up to which they are broadcast (24 bytes each).
BROADCAST_ROWS = 1_000_000
#: Pairs of a document and an item with their hits, up to which these are broadcast to the texts (some 100 bytes each).
BROADCAST_HITS = 200_000


def _fingerprints(k: int, w: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for lo, hi in K.blocks(texts):
                words, doc = K.word_hashes(texts[lo:hi])
                n = len(words) - k - w + 2
                if n <= 0:
                    continue
                grams = np.zeros(len(words) - k + 1, dtype=np.uint64)
                for j in range(k):
                    grams = K.mix(grams * np.uint64(31) + words[j : j + len(grams)])
                best, at = grams[:n].copy(), np.arange(n)
                for j in range(1, w):
                    here = grams[j : j + n]
                    less = here <= best
                    best = np.where(less, here, best)
                    at = np.where(less, np.arange(n) + j, at)
                whole = doc[:n] == doc[k + w - 2 :]
                at = np.unique(at[whole])
                first = np.searchsorted(doc, np.arange(hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + doc[at]]), pa.array(grams[at].view(np.int64)), pa.array((at - first[doc[at]]).astype(np.int32))], names=["id", "fp", "pos"]
                )

    return run


def fingerprints(texts: DataFrame, k: int, w: int) -> DataFrame:
    """(id, fp, pos) of the winnowed k-grams of ``texts(id, text)``; pos counts words."""
    return texts.select("id", "text").mapInArrow(_fingerprints(k, w), "id long, fp long, pos int")


def _longest_runs(least: int):
    """Of each (doc, item, hits, dtext, itext): the longest run of equal words through a hit."""

    def words(text, known):
        if text not in known:
            if len(known) > 500:
                known.clear()
            known[text] = K.word_hashes([text])[0]
        return known[text]

    def run(batches):
        docs: dict = {}
        items: dict = {}
        for batch in batches:
            keep, runs = [], []
            hits, dt, it = (batch.column(i).to_pylist() for i in (2, 3, 4))
            for r, pairs in enumerate(hits):
                a, b = words(dt[r], docs), words(it[r], items)
                most = 0
                for shift in {p["d"] - p["i"] for p in pairs}:
                    lo, hi = max(0, -shift), min(len(b), len(a) - shift)
                    same = np.concatenate(([0], (a[lo + shift : hi + shift] == b[lo:hi]).view(np.int8), [0]))
                    edge = np.flatnonzero(np.diff(same))
                    if len(edge):
                        most = max(most, int((edge[1::2] - edge[::2]).max()))
                if most >= least:
                    keep.append(r)
                    runs.append(most)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(runs, pa.int32())], names=["doc", "item", "run"])

    return run


def leaked_passages(docs: DataFrame, items: DataFrame, least: int = 12, k: int = 8) -> DataFrame:
    """(doc, item, run): texts of ``docs(id, text)`` that hold ``least`` or more consecutive words of a text of ``items(id, text)``, with the longest run.

    Null ids, null and empty texts and texts under ``least`` words give no rows; repeated texts are reported each; further columns are ignored.
    """
    docs, items = (x.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null") for x in (docs, items))
    docs = spread(docs)
    w = least - k + 1
    prints = materialize(fingerprints(items, k, w).select("fp", F.col("id").alias("item"), F.col("pos").alias("i")), "evalprints")
    side = F.broadcast(prints) if prints.count() <= BROADCAST_ROWS else prints
    hits = fingerprints(docs, k, w).join(side, "fp").groupBy(F.col("id").alias("doc"), "item").agg(F.collect_set(F.struct(F.col("pos").alias("d"), "i")).alias("hits"))
    hits, n = materialize_counted(hits, "hits")
    hits = F.broadcast(hits) if n <= BROADCAST_HITS else hits  # few hits go to the texts, many texts never to the hits
    paired = hits.join(docs.select(F.col("id").alias("doc"), F.col("text").alias("dtext")), "doc").join(items.select(F.col("id").alias("item"), F.col("text").alias("itext")), "item")
    return paired.select("doc", "item", "hits", "dtext", "itext").mapInArrow(_longest_runs(least), "doc long, item long, run int")
