"""Subject areas of documents, sentence by sentence.

1. One pass turns every text into its sentences' terms, numbered by hash in a space that grows with the corpus, so that every word of every
   text counts.  The same pass sums document frequencies, and in which language's documents a term stands.
2. A truncated singular value decomposition of the weighted document-term matrix (subspace iteration, one pass over all documents a
   step) gives every term a vector.
3. Terms are weighted by what they tell about subjects: the divergence of a term's subjects from all.  A sentence is the weighted sum of its
   terms' vectors.  Seed centroids, one for each subject and language, are the weighted sums of the terms of labelled documents.
4. Refinement: every sentence of all documents goes to the centroid of highest cosine if that reaches ``NEAR``, else to none; from the
   terms of the sentences then assigned follow new term weights and new centroids, with one for sentences about none, until little changes.
A document has the subjects that at least a quarter of its sentences are nearest to.

A task sends fixed-size sums (terms times rank or subjects), which are added in parts on the executors.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import textkernel as K
from corpusloom.llm.broken_pairs import FUNCTION_WORDS
from corpusloom.plans.workspace import materialize, spread

_U = np.uint64
#: Bits of term numbers: 15, and one more for each doubling of the documents beyond 2 million, up to 17 (the vectors then take 32 MB).
TERM_BITS, TERM_DOCS, TERM_MOST = 15, 2_000_000, 17
RANK, POWER = 64, 2
NEAR, ROUNDS, SHARE = 0.25, 8, 0.25
#: Refinement ends when less than this share of the terms changes its subject (or after ``ROUNDS``); weights under a hundredth of the largest are 0.
STABLE, LIGHT = 0.002, 0.01
#: Pseudo-counts that a term's subjects are smoothed with, from labels and from all sentences.
SMOOTH = (4.0, 10.0)
#: Labelled documents used to seed the centroids, at most, by hash order.
LABELLED = 50_000
LANGUAGES = [*FUNCTION_WORDS, "other"]
_PARTS = 16
_CODED = "kind int, id long, lang int, lengths binary, terms binary, part int, sums binary"


def _blobs(sums: dict[str, np.ndarray]) -> list[bytes]:
    flat = np.concatenate([a.ravel() for a in sums.values()]).astype(np.float32)
    return [zlib.compress(c.tobytes(), 1) for c in np.array_split(flat, _PARTS)]


def _merge(batches):
    out: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a = np.frombuffer(zlib.decompress(blob), np.float32).astype(np.float64)
            out[part] = out[part] + a if part in out else a
    for part, a in out.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([a.astype(np.float32).tobytes()], pa.binary())], names=["part", "sums"])


def _collect(sent: DataFrame, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """Add the parts (part, sums) on the executors; the driver gets one array of each shape."""
    rows = sent.repartition(_PARTS, "part").mapInArrow(_merge, "part int, sums binary").collect()
    size = sum(int(np.prod(s)) for s in shapes.values())
    flat = np.concatenate([np.frombuffer(r.sums, np.float32) for r in sorted(rows, key=lambda r: r.part)]) if rows else np.zeros(size, np.float32)
    result, at = {}, 0
    for n, shape in shapes.items():
        m = int(np.prod(shape))
        result[n] = flat[at : at + m].reshape(shape).astype(np.float64)
        at += m
    return result


def _total(coded: DataFrame, shapes: dict[str, tuple[int, ...]], add) -> dict[str, np.ndarray]:
    """Sum ``add(batch, sums)`` over all batches."""

    def run(batches):
        sums = {n: np.zeros(s, np.float32 if len(s) > 1 else np.float64) for n, s in shapes.items()}
        some = False
        for batch in batches:
            add(batch, sums)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()), pa.array(_blobs(sums), pa.binary())], names=["part", "sums"])

    return _collect(coded.mapInArrow(run, "part int, sums binary"), shapes)


def _votes(bits: int) -> np.ndarray:
    """(terms, languages): what a function word says about the language; words of several languages share a vote."""
    speaks: dict[str, list[int]] = {}
    for i, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            if len(w) > 1:
                speaks.setdefault(w, []).append(i)
    out = np.zeros((1 << bits, len(LANGUAGES)), np.float32)
    for w, found in speaks.items():
        for h in K.word_hashes([w])[0][:1]:
            out[int(h >> _U(64 - bits)), found] += 1 / len(found)
    return out


def _code(bits: int):
    """Map (id, text) to coded documents (kind 0), and at the end the task's document frequencies and language counts in parts (kind 1)."""
    kind_of = np.uint16 if bits <= 16 else np.uint32
    d = 1 << bits

    def run(batches):
        votes = _votes(bits)
        sums = {"df": np.zeros(d), "lang": np.zeros((d, len(LANGUAGES)))}
        some = False
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            langs, lengths, terms = [], [], []
            for lo, hi in K.blocks(texts):
                some = True
                h, sentence, doc = K.sentence_terms(texts[lo:hi])
                t = (h >> _U(64 - bits)).astype(np.int64)
                own = doc[sentence] if len(t) else sentence
                said = np.zeros((hi - lo, len(LANGUAGES)))
                np.add.at(said, own, votes[t])
                lang = np.where(said.max(1) > 0, said.argmax(1), len(LANGUAGES) - 1)
                sums["df"] += np.bincount(K.distinct_values(own * d + t) % d, minlength=d)
                sums["lang"] += np.bincount(t * len(LANGUAGES) + lang[own], minlength=d * len(LANGUAGES)).reshape(d, -1)
                n = np.bincount(sentence).astype(np.uint32) if len(t) else np.empty(0, np.uint32)
                s_at = np.searchsorted(doc, np.arange(hi - lo + 1))
                t_at = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))[s_at] if len(n) else np.zeros(hi - lo + 1, np.int64)
                t = t.astype(kind_of)
                langs.append(lang)
                lengths += [n[a:b].tobytes() for a, b in zip(s_at, s_at[1:], strict=False)]
                terms += [t[a:b].tobytes() for a, b in zip(t_at, t_at[1:], strict=False)]
            m = len(ids)
            if m:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(m, np.int32)), ids, pa.array(np.concatenate(langs).astype(np.int32)), pa.array(lengths, pa.binary()), pa.array(terms, pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    names=["kind", "id", "lang", "lengths", "terms", "part", "sums"],
                )
        if some:
            m = _PARTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.array(range(m), pa.int32()), pa.array(_blobs(sums), pa.binary())],
                names=["kind", "id", "lang", "lengths", "terms", "part", "sums"],
            )

    return run


def _batches(batch: pa.RecordBatch, bits: int, limit: int = 60_000):
    """Of a batch (id, lang, lengths, terms, ...), in slices of about ``limit`` terms: rows lo and hi, sentence of each term, terms, row of each sentence."""
    kind_of = np.uint16 if bits <= 16 else np.uint32
    lengths, terms = batch.column(2).to_pylist(), batch.column(3).to_pylist()
    size = np.cumsum([len(x) // np.dtype(kind_of).itemsize for x in terms])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, side="right")))
        n = np.frombuffer(b"".join(lengths[lo:hi]), np.uint32).astype(np.int64)
        t = np.frombuffer(b"".join(terms[lo:hi]), kind_of).astype(np.int64)
        doc = np.repeat(np.arange(hi - lo), [len(x) // 4 for x in lengths[lo:hi]])
        yield lo, hi, np.repeat(np.arange(len(n)), n), t, doc
        lo = hi


def _group_sum(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Row sums by a sorted group number."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(group):
        at = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        out[group[at]] = np.add.reduceat(values, at, axis=0)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)).astype(np.float32)


def _basis(y: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span y, strongest first; directions that y does not reach are left out."""
    value, vector = np.linalg.eigh(y.T @ y)
    keep = value > 1e-10 * max(value.max(), 1e-30)
    return (y @ (vector[:, keep] / np.sqrt(value[keep])))[:, ::-1].astype(np.float32)


class Model:
    """Weighted term vectors and centroids."""

    def __init__(self, vectors: np.ndarray, by_language: np.ndarray, counts: np.ndarray, smooth: float):
        """counts: (terms, subjects and none) of the sentences, or of the labels' subjects."""
        prior = np.maximum(counts.sum(0) / max(counts.sum(), 1e-9), 1e-9)
        p = (counts + smooth * prior) / (counts.sum(1, keepdims=True) + smooth)
        told = (p * np.log(np.maximum(p, 1e-12) / prior)).sum(1)
        told[told < LIGHT * told.max()] = 0
        self.tells = told > 0
        self.vectors = (vectors * told[:, None]).astype(np.float32)
        share = by_language / np.maximum(by_language.sum(1, keepdims=True), 1e-9)
        self.centroids = np.stack([_unit((counts * share[:, [i]]).T @ self.vectors) for i in range(share.shape[1])])
        self.none = counts.shape[1] - 1

    def nearest(self, s: np.ndarray, t: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Number of the centroid of highest cosine of every sentence; that of none if no cosine reaches ``NEAR``."""
        keep = self.tells[t]
        u = _unit(_group_sum(self.vectors[t[keep]], s[keep], len(lang)))
        best = np.full(len(u), self.none)
        for i in np.unique(lang):
            m = np.flatnonzero(lang == i)
            cos = u[m] @ self.centroids[i].T
            best[m] = np.where(cos.max(1) >= NEAR, cos.argmax(1), self.none)
        return best


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: list[str]) -> DataFrame:
    """(id, subject): the subjects of ``docs(id, text)``; ``labels(id, subject)`` is a sample of labelled ids, wrong and repeated labels included.

    Null, empty, blank and merely chatty texts have none.  Labels of unknown ids or subjects are ignored; without usable labels no document has a
    subject.  Rows with a null id are left out; further columns are ignored; whole texts count.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null")
    k, n_docs = len(subjects), docs.count()
    bits = min(TERM_MOST, TERM_BITS + (n_docs // TERM_DOCS).bit_length())
    d = 1 << bits
    written = materialize(spread(docs).mapInArrow(_code(bits), _CODED), "coded")
    coded = written.where("kind = 0").select("id", "lang", "lengths", "terms")
    stats = _collect(written.where("kind = 1").select("part", "sums"), {"df": (d,), "lang": (d, len(LANGUAGES))})
    idf = (np.log((n_docs + 1) / np.maximum(stats["df"], 1)) * (stats["df"] > 0)).astype(np.float32)

    # Seeds from labelled documents.
    known = labels.select(F.col("id").cast("long").alias("id"), "subject").where(F.col("subject").isin(subjects)).groupBy("id").agg(F.sort_array(F.collect_set("subject")).alias("own"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    index = {x: i for i, x in enumerate(subjects)}

    def seed(batch, sums):
        own = [[index[x] for x in xs] for xs in batch.column(4).to_pylist()]
        share = np.zeros((len(own), k + 1), np.float32)
        for i, o in enumerate(own):
            share[i, o] = 1 / len(o)
        for lo, _, s, t, doc in _batches(batch, bits):
            pair = K.distinct_values(doc[s] * d + t) if len(s) else np.empty(0, np.int64)
            np.add.at(sums["n"], pair % d, share[lo + pair // d])

    seeds = _total(coded.join(F.broadcast(known), "id"), {"n": (d, k + 1)}, seed)["n"]
    if not seeds.any():
        return spark.createDataFrame([], "id long, subject string")

    # Truncated decomposition by subspace iteration: each pass adds X'(XQ) of all documents.
    def project(q):
        sent = spark.sparkContext.broadcast(q)

        def add(batch, sums):
            q = sent.value
            for _, _, s, t, doc in _batches(batch, bits):
                pair, c = np.unique(doc[s] * d + t, return_counts=True) if len(s) else (np.empty(0, np.int64),) * 2
                row, t = pair // d, pair % d
                if not len(row):
                    continue
                w = np.log1p(c) * idf[t]
                w = (w / np.sqrt(np.maximum(np.bincount(row, w * w, minlength=int(row[-1]) + 1), 1e-9))[row]).astype(np.float32)[:, None]
                z = _group_sum(w * q[t], row, int(row[-1]) + 1)
                order = np.argsort(t, kind="stable")
                t = t[order]
                at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
                sums["y"][t[at]] += np.add.reduceat((w * z[row])[order], at, axis=0)

        return _total(coded, {"y": (d, q.shape[1])}, add)["y"]

    q = np.random.default_rng(0).standard_normal((d, RANK)).astype(np.float32) * (idf > 0)[:, None]
    for _ in range(POWER):
        q = _basis(project(q))

    def refine(batch, sums):
        lang = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, _, s, t, doc in _batches(batch, bits):
            a = sent.value.nearest(s, t, lang[lo + doc])
            sums["n"] += np.bincount(t * (k + 1) + a[s], minlength=d * (k + 1)).reshape(d, k + 1)

    model, before = Model(q, stats["lang"], seeds, SMOOTH[0]), None
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        counts = _total(coded, {"n": (d, k + 1)}, refine)["n"]
        model = Model(q, stats["lang"], counts + 2 * seeds, SMOOTH[1])
        if before is not None and np.abs(counts - before).sum() < 2 * STABLE * counts.sum():
            break
        before = counts
    last = spark.sparkContext.broadcast(model)

    def assign(batches):
        for batch in batches:
            lang = batch.column(1).to_numpy(zero_copy_only=False)
            rows, found = [], []
            for lo, hi, s, t, doc in _batches(batch, bits):
                a = last.value.nearest(s, t, lang[lo + doc])
                held = np.bincount(doc * (k + 1) + a, minlength=(hi - lo) * (k + 1)).reshape(hi - lo, k + 1)
                row, col = np.nonzero((held[:, :k] > 0) & (held[:, :k] >= SHARE * held.sum(1, keepdims=True)))
                rows.append(lo + row)
                found.append(col)
            row, col = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, found))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array([subjects[c] for c in col], pa.string())], names=["id", "subject"])

    return coded.mapInArrow(assign, "id long, subject string")
