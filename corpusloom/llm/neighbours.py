"""The k most similar vectors of every vector, by additive quantisation.

A vector is coded as a sum of full-dimensional codewords: the first codebook also names the list a vector
lies in, the others code what is left, and a beam search keeps several partial sums at every level.  A query
is scored against the codes of the nearest lists from lookup tables (query times codeword) over the stored
norm of the coded vector; the best are scored again exactly, in double precision, where the vectors lie.

Codebooks are fitted on a bounded sample; every vector is coded and searched.  There are about as many lists as the root of the
vectors, whatever their number, in cells of some 16 neighbouring lists: a query goes once to each cell that holds a list it asks.  How many
lists a query asks is measured: for ``ASKING`` vectors one exact pass over all rows gives the true neighbours, and so many lists are asked
that ``RECALL`` of these lie in them.  ``exact=True`` scores every pair of blocks instead.
Equal vectors and exact multiples of them are one entry with their first k + 1 rows, so a direction that a third of all rows repeat is searched once.
Cells are cut into chunks of about ``CHUNK`` rows on the data and on the query side: no task sees an unbounded cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import textkernel as K
from corpusloom.plans.workspace import materialize

#: Vectors on which the codebooks are fitted: 20,000, and 16 for each list beyond 1,250, at most 200,000 (100 MB at 128 dimensions).
SAMPLE, SAMPLE_MOST = 20_000, 200_000
#: Share of the true nearest vectors that the asked lists must hold, measured on so many asking vectors, and lists of a cell.
RECALL, ASKING, CELL = 0.995, 500, 16
#: Codebooks after the first, codewords of each, width of the beam.
LEVELS, WORDS, BEAM = 4, 256, 4
CHUNK = 8192


def valid_rows(batch: pa.RecordBatch, dim: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and vectors (float32) of the rows (id, embedding) with ``dim`` values, all finite, not all zero; null vectors and values are invalid."""
    ids, column = batch.column(0), batch.column(1)
    long_enough = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
    ids, column = ids.filter(long_enough), column.filter(long_enough)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)  # null values become NaN
    ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return ids.filter(pa.array(ok)), x[ok]


def direction_keys(x: np.ndarray) -> np.ndarray:
    """(rows, 2) 64-bit hashes of valid vectors over the size of their first value that is not 0, in double: equal for exact multiples.

    Quotients of two floats that differ do so within 48 bits, so they stay apart in a double; adding 0 unites the two zeros.
    """
    x = x.astype(np.float64)
    size = np.abs(x[np.arange(len(x)), (x != 0).argmax(axis=1)])
    bits = np.ascontiguousarray(x / size[:, None] + 0.0).view(np.uint64)
    place = K.mix(np.arange(1, x.shape[1] + 1, dtype=np.uint64))
    return np.stack([K.mix(K.mix(bits + place * np.uint64(c)).sum(axis=1, dtype=np.uint64)) for c in (1, 3)], axis=1)


def _keys(dim: int):
    def run(batches):
        for batch in batches:
            ids, x = valid_rows(batch, dim)
            k = direction_keys(x).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(k[:, 0]), pa.array(k[:, 1])], names=["id", "k1", "k2"])

    return run


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=len(x) < k)].astype(np.float32).copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        has = np.flatnonzero(n)
        c[has] = np.add.reduceat(x[order], np.concatenate(([0], np.cumsum(n)[:-1]))[has], axis=0) / n[has, None]
        empty = np.flatnonzero(n == 0)
        c[empty] = x[rng.choice(len(x), len(empty))]
    return c


def fit_codebooks(sample: np.ndarray, lists: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The list codebook and the residual codebooks of unit vectors, and the cell of every list.

    The lists are fitted cell by cell: about lists / 16 coarse centroids, then as many lists in each as its share of the sample asks for.
    """
    coarse = _kmeans(sample, max(1, round(lists / CELL)), 8, 1)
    near = np.argmax(sample @ coarse.T - 0.5 * (coarse * coarse).sum(1), axis=1)
    parts, cells = [], []
    for c in range(len(coarse)):
        own = sample[near == c]
        n = max(1, round(lists * len(own) / len(sample)))
        parts.append(_kmeans(own, min(n, len(own)), 6, c + 7) if len(own) else coarse[c : c + 1])
        cells += [c] * len(parts[-1])
    books = [np.concatenate(parts)]
    rest = sample - books[0][np.argmax(sample @ books[0].T - 0.5 * (books[0] ** 2).sum(1), axis=1)]
    for level in range(LEVELS):
        book = _kmeans(rest, WORDS, 6, level + 2)
        books.append(book)
        rest = rest - book[np.argmax(rest @ book.T - 0.5 * (book**2).sum(1), axis=1)]
    return books, np.array(cells, np.int32)


def _scan(dim: int, k: int, asks):
    """Brute force for the few asking vectors: of a task, the k nearest other rows of each (q, far, id, vec)."""

    def run(batches):
        q_ids, q = asks.value
        best = [np.full((len(q), k), -2.0), np.zeros((len(q), k), np.int64), np.zeros((len(q), k, dim), np.float32)]
        for batch in batches:
            ids, x = valid_rows(batch, dim)
            ids = ids.to_numpy(zero_copy_only=False)
            for lo in range(0, len(ids), 4096):
                part, own = x[lo : lo + 4096], ids[lo : lo + 4096]
                cos = q @ _unit(part).astype(np.float32).T
                cos[q_ids[:, None] == own[None]] = -2.0
                near = np.argpartition(-cos, min(k, cos.shape[1]) - 1, axis=1)[:, :k]
                both = [np.concatenate((best[0], np.take_along_axis(cos, near, 1)), axis=1), np.concatenate((best[1], own[near]), axis=1), np.concatenate((best[2], part[near]), axis=1)]
                top = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
                best = [np.take_along_axis(both[0], top, 1), np.take_along_axis(both[1], top, 1), np.take_along_axis(both[2], top[:, :, None], 1)]
        row, col = np.nonzero(best[0] > -2.0)
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(-best[0][row, col]), pa.array(best[1][row, col]), pa.array([v.tobytes() for v in best[2][row, col]], pa.binary())], names=["q", "far", "id", "vec"])

    return run


def asked_lists(reps: DataFrame, asks: tuple[np.ndarray, np.ndarray], books: list[np.ndarray], k: int, wanted: float = RECALL) -> int:
    """How many nearest lists hold the share ``wanted`` of the true k nearest others of the asking vectors (ids, unit vectors), found by one exact pass over all rows."""
    dim = asks[1].shape[1]
    sent = reps.sparkSession.sparkContext.broadcast(asks)
    met = reps.mapInArrow(_scan(dim, k, sent), "q long, far double, id long, vec binary").groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "id", "vec"))), 1, k).alias("near"))
    rows = met.select("q", F.explode("near.vec").alias("vec")).collect()  # at most ASKING * k
    if not rows:
        return 1
    x = _unit(np.frombuffer(b"".join(r.vec for r in rows), np.float32).reshape(-1, dim)).astype(np.float32)
    book = books[0]
    rank = np.argsort(np.argsort(-(asks[1] @ book.T - 0.5 * (book * book).sum(1)), axis=1), axis=1)
    place = np.sort(rank[np.array([r.q for r in rows]), encode(x, books)[:, 0]])
    return int(place[int(np.ceil(wanted * len(place))) - 1]) + 1


def encode(x: np.ndarray, books: list[np.ndarray], beam: int = BEAM) -> np.ndarray:
    """Codes (rows, levels + 1) of unit vectors by beam search."""
    n = len(x)
    rest, cost, codes = x[:, None, :], np.zeros((n, 1), np.float32), np.zeros((n, 1, 0), np.int32)
    for book in books:
        half = 0.5 * (book * book).sum(1)
        gain = cost[:, :, None] + half - rest @ book.T  # half the squared error, but for a constant
        flat = gain.reshape(n, -1)
        b = min(beam, flat.shape[1])
        best = np.argpartition(flat, b - 1, axis=1)[:, :b] if b < flat.shape[1] else np.tile(np.arange(b), (n, 1))
        cost = np.take_along_axis(flat, best, axis=1)
        parent, word = best // len(book), (best % len(book)).astype(np.int32)
        rows = np.arange(n)[:, None]
        rest = rest[rows, parent] - book[word]
        codes = np.concatenate((codes[rows, parent], word[:, :, None]), axis=2)
    return codes[np.arange(n), np.argmin(cost, axis=1)]


def decode(codes: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    return sum(book[codes[:, i]] for i, book in enumerate(books))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _code(dim: int, books, probes: int):
    def run(batches):
        all_books, cell_of = books.value
        book = all_books[0]
        half = 0.5 * (book * book).sum(1)
        p = min(probes, len(book))
        for batch in batches:
            all_ids, all_rows = valid_rows(batch, dim)
            for lo in range(0, len(all_rows), 1024):
                flat = all_rows[lo : lo + 1024]
                unit = _unit(flat).astype(np.float32)
                codes = encode(unit, all_books)
                norm = np.linalg.norm(decode(codes, all_books), axis=1).astype(np.float32)
                near = unit @ book.T - half
                asked = np.argpartition(-near, p - 1, axis=1)[:, :p].astype(np.int32) if p < len(book) else np.tile(np.arange(p, dtype=np.int32), (len(unit), 1))
                away = ~(asked == codes[:, :1]).any(axis=1)
                asked[away, -1] = codes[away, 0]  # its own list is always asked
                cells = np.sort(cell_of[asked], axis=1)
                first = np.concatenate((np.ones((len(unit), 1), bool), cells[:, 1:] != cells[:, :-1]), axis=1)
                small = codes[:, 1:].astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        all_ids.slice(lo, 1024), pa.array([r.tobytes() for r in flat], pa.binary()), pa.array([r.tobytes() for r in small], pa.binary()), pa.array(norm), pa.array(codes[:, 0].astype(np.int32)), pa.array(cell_of[codes[:, 0]]),
                        pa.array([r.tobytes() for r in asked], pa.binary()), pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(first.sum(1)))).astype(np.int32), pa.array(cells[first])),
                    ],
                    names=["id", "vec", "codes", "norm", "list", "cell", "asked", "cells"],
                )

    return run


def _score(dim: int, k: int, rerank: int, books):
    """Search of one (cell, data chunk, query chunk): the best k rows of the asked lists for each query, by (cosine to 6 decimals, id)."""

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_n, out_c = [], [], []

        def best(qi, near_ids, cos):
            cos = np.where(near_ids == qi[:, None], -2.0, np.round(cos, 6))
            order = np.lexsort((near_ids, -cos), axis=1)[:, :k]
            c, n = np.take_along_axis(cos, order, 1), np.take_along_axis(near_ids, order, 1)
            keep = c > -2.0
            out_q.append(np.repeat(qi, keep.sum(1)))
            out_n.append(n[keep])
            out_c.append(c[keep])

        def search(first, ids, x, codes, inverse, q, qi):
            if len(ids) <= rerank:
                cos = q @ x.T
                best(qi, np.broadcast_to(ids, cos.shape), cos)
                return
            q32 = q.astype(np.float32)
            s = np.repeat((q32 @ first)[:, None], len(ids), axis=1)
            for m in range(LEVELS):
                s += np.take(q32 @ all_books[m + 1].T, codes[:, m], axis=1)
            s *= inverse
            s[qi[:, None] == ids[None, :]] = -np.inf
            near = np.argpartition(-s, rerank, axis=1)[:, :rerank]
            reached = s >= np.take_along_axis(s, near, 1).min(1, keepdims=True)
            tied = reached.sum(1) > rerank  # rows of one code, such as rounded multiples: all that tie with the last are scored
            for i in np.flatnonzero(tied):
                at = np.flatnonzero(reached[i])
                best(qi[i : i + 1], ids[None, at], (x[at] @ q[i])[None])
            best(qi[~tied], ids[near[~tied]], np.einsum("qd,qrd->qr", q[~tied], x[near[~tied]]))

        if data.num_rows and queries.num_rows:
            all_books, _ = books.value
            order = np.argsort(data.column("list").to_numpy(), kind="stable")
            data, queries = data.take(pa.array(order)).combine_chunks(), queries.combine_chunks()
            ids, lists = data.column("id").to_numpy(), data.column("list").to_numpy()
            x = _unit(_matrix(data.column("vec").combine_chunks(), dim))
            codes = np.frombuffer(b"".join(data.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, LEVELS)
            inverse = 1.0 / np.maximum(data.column("norm").to_numpy(), 1e-12)
            q_ids, q_all = queries.column("qid").to_numpy(), _unit(_matrix(queries.column("qvec").combine_chunks(), dim))
            asked = np.frombuffer(b"".join(queries.column("qasked").to_pylist()), np.int32).reshape(len(q_ids), -1)
            cuts = np.concatenate((np.flatnonzero(np.diff(lists, prepend=-1)), [len(lists)]))
            for a, b in zip(cuts, cuts[1:], strict=False):
                asks = np.flatnonzero((asked == lists[a]).any(axis=1))
                for lo in range(0, len(asks), 128):
                    at = asks[lo : lo + 128]
                    search(all_books[0][lists[a]], ids[a:b], x[a:b], codes[a:b], inverse[a:b], q_all[at], q_ids[at])
        cat = lambda v, t: np.concatenate(v) if v else np.empty(0, t)
        q, n, c = cat(out_q, np.int64), cat(out_n, np.int64), cat(out_c, np.float64)
        order = np.lexsort((n, -c, q))  # of the cell's lists together the best k a query
        q, n, c = q[order], n[order], c[order]
        at = np.flatnonzero(np.concatenate((np.ones(min(1, len(q)), bool), q[1:] != q[:-1])))
        keep = np.arange(len(q)) - np.repeat(at, np.diff(np.concatenate((at, [len(q)])))) < k
        return pa.table({"q": pa.array(q[keep], pa.int64()), "n": pa.array(n[keep], pa.int64()), "cos": pa.array(c[keep], pa.float64())})

    return run


def nearest_vectors(rows: DataFrame, k: int = 5, dim: int = 128, probes: int | None = None, rerank: int = 64, exact: bool = False, lists: int | None = None) -> DataFrame:
    """(id, neighbours): the k nearest other rows of every valid row of ``rows(id, embedding)`` as array<struct<cos, id>>.

    By cosine to 6 decimals, ties to the smaller id; copies are rows of their own.  Null vectors and vectors of another length, with
    null, NaN or infinite values or all zero take no part; rows with a null id neither.  No valid rows give an empty result.
    ``probes``: lists asked, measured if null; ``lists``: their number, the root of the vectors if null; ``exact``: all pairs of blocks, in double.
    """
    spark = rows.sparkSession
    ok = rows.select(F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<float>").alias("embedding")).where("id is not null")
    keyed = materialize(ok.mapInArrow(_keys(dim), "id long, k1 long, k2 long"), "vectorkeys")
    classes = keyed.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    member = materialize(keyed.join(classes, ["k1", "k2"]).select("id", "rep", "copies"), "members")
    n = member.where("id = rep").count()
    if not n:
        return member.select("id", F.array(F.struct(F.lit(0.0).alias("cos"), F.col("rep").alias("id"))).alias("neighbours"))
    copies = member.where("id <> rep").select("id")
    copies = F.broadcast(copies) if copies.count() <= 1_000_000 else copies
    reps = ok.join(copies, "id", "left_anti")
    lists = 1 if exact else lists or int(2 ** max(0, np.round(np.log2(np.sqrt(n)))))
    wanted = int(min(SAMPLE_MOST, max(SAMPLE, 16 * lists)))
    share = int(min(1.0, 2.0 * wanted / n) * (1 << 30))
    taken = reps.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).orderBy(F.xxhash64("id"), "id").limit(wanted).select("id", "embedding").toArrow().combine_chunks()
    ids, vectors = valid_rows(taken.to_batches()[0], dim) if taken.num_rows else (pa.array([], pa.int64()), np.empty((0, dim), np.float32))
    sample = _unit(vectors).astype(np.float32) if len(vectors) else np.full((1, dim), dim**-0.5, np.float32)
    fitted = fit_codebooks(sample, lists)
    books = spark.sparkContext.broadcast(fitted)
    if exact:
        probes, rerank = 1, 2 * CHUNK
    probes = probes or asked_lists(reps, (ids.to_numpy()[:ASKING], sample[:ASKING]), fitted[0], k)

    coded = materialize(reps.mapInArrow(_code(dim, books, probes), "id long, vec binary, codes binary, norm float, list int, cell int, asked binary, cells array<int>"), "codes")
    asked = coded.select("id", "vec", "asked", F.explode("cells").alias("cell"))
    held = {r.cell: r.m for r in coded.groupBy("cell").agg(F.count("*").alias("m")).collect()}  # a sixteenth of the lists
    wanted = {r.cell: r.m for r in asked.groupBy("cell").agg(F.count("*").alias("m")).collect()}
    sizes = spark.createDataFrame([(c, max(1, -(-held.get(c, 0) // CHUNK)), max(1, -(-wanted.get(c, 0) // CHUNK))) for c in sorted(set(held) | set(wanted))], "cell int, dc int, qc int")
    salt = lambda m: F.pmod(F.xxhash64("id"), F.col(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    data = coded.join(F.broadcast(sizes), "cell").select("cell", salt("dc").alias("d"), every("qc").alias("c"), "list", "id", "vec", "codes", "norm")
    queries = asked.join(F.broadcast(sizes), "cell").select(F.col("cell").alias("ql"), every("dc").alias("qd"), salt("qc").alias("qk"), F.col("id").alias("qid"), F.col("vec").alias("qvec"), F.col("asked").alias("qasked"))
    found = data.groupBy("cell", "d", "c").cogroup(queries.groupBy("ql", "qd", "qk")).applyInArrow(_score(dim, k, rerank, books), "q long, n long, cos double")
    best = found.groupBy("q").agg(F.collect_list(F.struct((-F.col("cos")).alias("far"), F.col("n").alias("id"))).alias("near"))  # at most k a chunk that was asked
    best = materialize(best.select("q", F.slice(F.array_sort("near"), 1, k).alias("near")), "nearest")

    # From entries to rows: each entry stands for its first k + 1 rows.
    first = _first_rows(member, k + 1)
    wide = best.select("q", F.explode("near").alias("e")).select("q", F.col("e.far").alias("far"), F.col("e.id").alias("rep"))
    wide = wide.union(member.where("copies > 1 and id = rep").select(F.col("rep").alias("q"), F.lit(-1.0), "rep"))
    wide = wide.join(first, "rep", "left").select("q", "far", F.explode(F.coalesce("ids", F.array("rep"))).alias("id"))
    pool = wide.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("far", "id"))).alias("pool"))  # at most (k + 1) ** 2 entries
    out = member.join(pool, member["rep"] == pool["q"]).select("id", "pool")
    near = F.slice(F.filter("pool", lambda e: e["id"] != F.col("id")), 1, k)
    return out.select("id", F.transform(near, lambda e: F.struct((-e["far"]).alias("cos"), e["id"].alias("id"))).alias("neighbours"))


def _first_rows(member: DataFrame, count: int) -> DataFrame:
    """(rep, ids): the ``count`` smallest ids of each repeated entry; ids are thinned in hash parts first, so no task gathers a whole entry."""
    parts = member.where("copies > 1").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(256)))
    ranked = parts.withColumn("r", F.row_number().over(Window.partitionBy("rep", "part").orderBy("id"))).where(F.col("r") <= count)
    return ranked.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("id")), 1, count).alias("ids"))


def neighbour_pairs(nearest: DataFrame) -> DataFrame:
    """(row_lo, row_hi): pairs of rows of which at least one is among the other's nearest."""
    e = nearest.select("id", F.explode("neighbours").alias("n"))
    return e.select(F.least("id", F.col("n.id")).alias("row_lo"), F.greatest("id", F.col("n.id")).alias("row_hi")).distinct()
