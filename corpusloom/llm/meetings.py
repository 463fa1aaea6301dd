"""Texts and groups that meet in the lists of shingles often enough, block against block.

The number of pairs that share a rare shingle grows with the square of the texts where the vocabulary does not grow, so they are never written
anywhere.  A task writes the postings of its texts in pieces to the shared folder, each piece to a block of about ``BLOCK`` postings, sorted by
shingle; a text's size and parity sketch are written once beside them.  Then every pair of blocks is a task: it reads both, a slice of the hashes
at a time, joins the sorted postings, drops what sizes or sketches rule out and counts what is left.  The disk that this takes is that of the
postings; a task's memory is that of two blocks.

A group of which a block holds more than ``MEMBERS`` texts has there one entry a shingle; it is asked as a whole, without a sketch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corpusloom.llm import packed
from corpusloom.llm import textkernel as K
from corpusloom.plans.workspace import read_part, write_parts

_U = np.uint64
#: Postings of a block, about, and of a piece; blocks that a table of some size has at least, so that all cores have work.
BLOCK, PIECE, LEAST = 8_000_000, 250_000, 6
MEMBERS = 8
SLACK = 0.04
#: Meetings handled in one vectorised step; counted codes held before equal ones are united.
STEP, HELD = 250_000, 4_000_000
#: 64-bit words of a text's parity sketch: every shingle flips one of its bits, so two sketches differ in at most as many bits as the sets in shingles.
SKETCH_WORDS = 8
#: A posting's 40 bits of hash: the slice, and the rest that is sorted in one integer with 27 bits of the text in its block and one mark.
_SLICES, _REST, _TEXT = 16, 36, 28
SCHEMA = "block int, piece long, slice int, n int, data binary"


def sketches(h: np.ndarray, doc: np.ndarray, m: int) -> np.ndarray:
    """Parity sketches of the sets of m texts: (m, SKETCH_WORDS)."""
    wide = SKETCH_WORDS * 64
    flips = np.bincount(doc * wide + (K.mix(h) % _U(wide)).astype(np.int64), minlength=m * wide).astype(np.uint8) & 1
    return np.packbits(flips.reshape(m, wide), axis=1).view(np.int64)


def _data(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(c.view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns), codec="zstd", asbytes=True)


def _undo(n: int, raw: bytes, *types: type) -> list[np.ndarray]:
    return packed.unpack(n, pa.decompress(raw, n * sum(np.dtype(t).itemsize for t in types), codec="zstd", asbytes=True), types)


def _piece(block: int, piece: int, held: list) -> pa.RecordBatch:
    """The rows of a piece: one of its texts (slice -1), one of the postings of each slice."""
    base = np.cumsum([0] + [len(p[3]) for p in held])
    h, mark = np.concatenate([p[0] for p in held]), np.concatenate([((p[1] + b) << 1) | p[2] for p, b in zip(held, base, strict=False)])
    key = np.sort((h << _U(24)) | mark.astype(_U))  # a piece has under 2 ** 23 texts
    h, mark = key >> _U(24), (key & _U((1 << 24) - 1)).astype(np.uint32)
    cut = np.searchsorted(h >> _U(_REST), np.arange(_SLICES + 1, dtype=_U))
    ids, comp, csize, n, sketch = (np.concatenate([p[c] for p in held]) for c in range(3, 8))
    slices, sizes, data = [-1], [len(ids)], [_data(ids, comp, csize, n, *sketch.T.copy())]
    for s in range(_SLICES):
        lo, hi = int(cut[s]), int(cut[s + 1])
        if hi > lo:
            slices.append(s)
            sizes.append(hi - lo)
            data.append(_data(np.diff(h[lo:hi] & _U((1 << _REST) - 1), prepend=_U(0)), mark[lo:hi]))
    rows = len(slices)
    return pa.RecordBatch.from_arrays([pa.array([block] * rows, pa.int32()), pa.array([piece] * rows, pa.int64()), pa.array(slices, pa.int32()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], names=["block", "piece", "slice", "n", "data"])


def postings(k: int, theta: float, ranks, blocks: int, found_only: bool = False):
    """Map (id, text, comp, csize) to pieces of the postings of its rarest shingles; mark: within the shorter prefix.

    ``ranks``: a broadcast of the ranks of cells of hashes; none: all shingles are posted.  ``found_only``: shingles of rank 0 (which the asked lack) are
    not posted, and texts with too few others not at all.
    """

    def run(batches):
        rank = None if ranks is None else np.frombuffer(ranks.value, dtype=np.uint8)
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            comp, csize = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            for lo, h, d, m in K.shingle_sets(texts, k):
                if not len(h):
                    continue
                n = np.bincount(d, minlength=m)
                doc, name, mark = d, h & _U((1 << 40) - 1), np.ones(len(h), np.int64)
                if rank is not None:
                    # The block holds under 2**16 texts: 16 bits text, 8 bits rank, 40 bits hash order a text's shingles in one sort.
                    r = rank[(h >> _U(K.HASH_BITS - (len(rank).bit_length() - 1))).astype(np.int64)].astype(_U)
                    key = np.sort((d.astype(_U) << _U(48)) | (r << _U(40)) | name)
                    pos = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n)
                    extra = (SLACK * n).astype(np.int64)
                    probe = np.minimum(n, n - np.ceil(theta * n - 1e-9).astype(np.int64) + 1 + extra)
                    short = np.minimum(n, n - np.ceil(2 * theta / (1 + theta) * n - 1e-9).astype(np.int64) + 1 + extra)
                    take = pos < np.repeat(probe, n)
                    if found_only:
                        take &= ((key >> _U(40)) & _U(255)) > 0
                        take &= np.repeat(np.bincount(d[take], minlength=m) > extra, n)
                    key, pos = key[take], pos[take]
                    doc, name = (key >> _U(48)).astype(np.int64), key & _U((1 << 40) - 1)
                    mark = (pos < short[doc]).astype(np.int64)
                if not len(doc):
                    continue
                used = K.distinct_values(doc)
                held.append((name, np.searchsorted(used, doc), mark, ids[lo + used], comp[lo + used], csize[lo + used].astype(np.int32), n[used].astype(np.int32), sketches(h, d, m)[used]))
                size += len(name)
                if size >= PIECE:
                    yield _piece((task * 5 + made) % blocks, (task << 20) | made, held)
                    made, held, size = made + 1, [], 0
        if held:
            yield _piece((task * 5 + made) % blocks, (task << 20) | made, held)

    return run


class _Block:
    """The texts of a block, and its postings, still compressed."""

    def __init__(self, path: str, block: int):
        table, rows = read_part(path, "block", block, ["piece", "slice", "n", "data"]), []
        if table is not None:
            rows = sorted(zip(*(c.to_pylist() for c in table.columns), strict=True), key=lambda r: r[:2])
        texts, self.slices, base, total = [], [[] for _ in range(_SLICES)], 0, 0
        for _, s, n, raw in rows:
            if s < 0:
                base, total = total, total + n
                texts.append(_undo(n, raw, np.int64, np.int64, np.int32, np.int32, *[np.int64] * SKETCH_WORDS))
            else:
                self.slices[s].append((base, n, raw))
        self.size = total
        if total:
            self.ids, self.comp, self.csize, self.n, *words = (np.concatenate(c) for c in zip(*texts, strict=True))
            self.sketch = np.stack(words, axis=1).view(_U)  # bits of signed numbers are not counted as they are stored
            self.labels, self.unit, count = np.unique(self.comp, return_inverse=True, return_counts=True)
            self.many = (count > MEMBERS)[self.unit]
            self.unit_size = np.zeros(len(self.labels), np.int32)
            self.unit_size[self.unit] = self.csize

    def keys(self, s: int) -> np.ndarray:
        """Sorted (hash, text, mark) of the postings of a slice."""
        parts = []
        for base, n, raw in self.slices[s]:
            h, mark = _undo(n, raw, np.uint64, np.uint32)
            parts.append((np.cumsum(h, dtype=_U) << _U(_TEXT)) | (mark.astype(_U) + _U(2 * base)))
        return np.sort(np.concatenate(parts)) if parts else np.empty(0, _U)


class _Tally:
    """Counts of codes."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, codes: np.ndarray) -> None:
        if len(codes):
            self.parts.append((codes, np.ones(len(codes), np.int64)))
            self.held += len(codes)
            if self.held > HELD:
                self.parts = [self.counts()]
                self.held = len(self.parts[0][0]) // 2  # so that many different codes are not united again and again

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        codes, n = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(codes)
        codes = codes[order]
        at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        return codes[at], np.add.reduceat(n[order], at)


def _joined(left: np.ndarray, right: np.ndarray):
    """Places (in left, in right) of equal hashes, some ``STEP`` at a time; left is sorted."""
    lo, hi = np.searchsorted(left, right, "left"), np.searchsorted(left, right, "right")
    busy = np.flatnonzero(hi > lo)
    base, width = lo[busy], (hi - lo)[busy]
    ends = np.cumsum(width)
    begin = 0
    while begin < len(busy):
        done = int(ends[begin - 1]) if begin else 0
        end = int(np.searchsorted(ends, done + STEP, side="right"))
        if end > begin:
            w = width[begin:end]
            yield np.repeat(base[begin:end] - (np.cumsum(w) - w), w) + np.arange(w.sum()), np.repeat(busy[begin:end], w)
            begin = end
        else:  # one posting with a longer list
            for at in range(0, int(width[begin]), STEP):
                w = min(STEP, int(width[begin]) - at)
                yield base[begin] + at + np.arange(w), np.full(w, busy[begin])
            begin += 1


def _split(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = key & _U((1 << _TEXT) - 1)
    return (low >> _U(1)).astype(np.int64), (low & _U(1)) > 0


def _text_meetings(a: _Block, b: _Block, ka, kb, theta: float, symmetric: bool, of_b: _Tally, of_a: _Tally) -> None:
    """Count meetings of texts with texts that sizes and sketches leave; of_b: a text of b asks, of_a: a text of a asks.  Symmetric: of two groups the smaller asks (by size, then name)."""
    share = theta / (1 + theta)
    for i, j in _joined(ka >> _U(_TEXT), kb >> _U(_TEXT)):
        (y, oy), (x, ox) = _split(ka[i]), _split(kb[j])
        nx, ny = b.n[x], a.n[y]
        ok = (ny >= theta * nx - 1e-9) & (theta * ny <= nx + 1e-9) & (b.comp[x] != a.comp[y])
        if symmetric:
            ok &= ((nx <= ny) & ox) | ((nx >= ny) & oy)
        x, y, total = x[ok], y[ok], (nx + ny)[ok]
        differ = np.bitwise_count(b.sketch[x] ^ a.sketch[y]).sum(axis=1, dtype=np.int32)
        ok = differ <= total - 2 * np.ceil(share * total - 1e-9)
        x, y = x[ok], y[ok]
        if symmetric:
            asks = (b.csize[x] < a.csize[y]) | ((b.csize[x] == a.csize[y]) & (b.comp[x] < a.comp[y]))
            if a is not b:
                back = ~asks & ~b.many[x]
                of_a.add((y[back] << _TEXT) | x[back])
        else:
            asks = np.ones(len(x), bool)
        asks &= ~a.many[y]
        of_b.add((x[asks] << _TEXT) | y[asks])


def _group_meetings(a: _Block, b: _Block, ka, kb, theta: float, symmetric: bool, tally: _Tally) -> None:
    """Count meetings of texts of b with the large groups of a."""
    y, oy = _split(ka)
    some = a.many[y]
    if not some.any():
        return
    h, y, oy = (ka >> _U(_TEXT))[some], y[some], oy[some]
    u = a.unit[y]
    order = np.lexsort((u, h))
    h, u, n, oy = h[order], u[order], a.n[y[order]], oy[order]
    at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (u[1:] != u[:-1]))))
    least, most, own = np.minimum.reduceat(n, at), np.maximum.reduceat(n, at), np.bitwise_or.reduceat(oy, at)
    h, u = h[at], u[at]
    for i, j in _joined(h, kb >> _U(_TEXT)):
        x, ox = _split(kb[j])
        g, nx = u[i], b.n[x]
        ok = (most[i] >= theta * nx - 1e-9) & (theta * least[i] <= nx + 1e-9) & (b.comp[x] != a.labels[g])
        if symmetric:
            ok &= (b.csize[x] < a.unit_size[g]) | ((b.csize[x] == a.unit_size[g]) & (b.comp[x] < a.labels[g]))
            ok &= ((nx <= most[i]) & ox) | ((nx >= least[i]) & own[i])
        tally.add((x[ok] << _TEXT) | g[ok])


def pairs_of(a: _Block, b: _Block, theta: float, share: float, symmetric: bool):
    """(q, g): texts and groups of two blocks that meet at least 1 + floor(share * n) times; texts of b ask those of a, and the other way round if symmetric."""
    if not a.size or not b.size:
        return
    texts, groups = (_Tally(), _Tally()), (_Tally(), _Tally())
    for s in range(_SLICES):
        ka = a.keys(s)
        kb = ka if a is b else b.keys(s)
        _text_meetings(a, b, ka, kb, theta, symmetric, *texts)
        _group_meetings(a, b, ka, kb, theta, symmetric, groups[0])
        if symmetric and a is not b:
            _group_meetings(b, a, kb, ka, theta, symmetric, groups[1])
    for asks, asked, text, group in ((b, a, texts[0], groups[0]), (a, b, texts[1], groups[1])):
        for tally, name in ((text, asked.comp), (group, asked.labels)):
            codes, count = tally.counts()
            q, g = codes >> _TEXT, codes & ((1 << _TEXT) - 1)
            ok = count >= 1 + np.floor(share * asks.n[q] + 1e-9)
            yield asks.ids[q[ok]], name[g[ok]]


_held: dict[tuple[str, int], _Block] = {}


def _first(path: str, block: int) -> _Block:
    """Tasks that follow each other often share their first block."""
    if (path, block) not in _held:
        _held.clear()
        _held[path, block] = _Block(path, block)
    return _held[path, block]


def block_count(entries: float, least: int = PIECE) -> int:
    """Blocks of about ``BLOCK`` postings, and up to ``LEAST`` of at least ``least``."""
    return max(1, int(min(LEAST, entries // least)), int(-(-entries // BLOCK)))


def write_blocks(pieces: DataFrame) -> str:
    """Write the mapped pieces to the shared folder; the path."""
    return write_parts(pieces, "block", "postings")


def meet(spark, asked: tuple[str, int], asks: tuple[str, int] | None, theta: float, share: float) -> DataFrame:
    """(q, g), some of them repeated: texts that meet a group often enough.  ``asked``, ``asks``: (path, blocks); without ``asks`` the asked ask each other."""
    symmetric = asks is None
    path, blocks = asked
    other, others = asks or asked
    tasks = blocks * (blocks + 1) // 2 if symmetric else blocks * others

    def run(batches):
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if symmetric:
                    i = 0
                    while t >= blocks - i:
                        t, i = t - (blocks - i), i + 1
                    j = i + t
                else:
                    i, j = divmod(t, others)
                a = _first(path, i)
                b = a if symmetric and i == j else _Block(other, j)
                for q, g in pairs_of(a, b, theta, share, symmetric):
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(g)], names=["q", "g"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(run, "q long, g long")

