"""Same or near-same records across splits, by a compressed full-text index of the evaluation records.

The distinct texts of the evaluation splits are laid out in shards of bounded length.  Of each shard a compressed suffix array over
words is built: the successor of every suffix (which is the place of its first word in the transform) in frames of ``FRAME``
suffixes, four bytes a word; no text is stored, records are read back from the successors.  All texts stream through backward search:
of a text with n distinct runs of ``k`` words the n - ceil(theta * n) + 1 that are rarest in the index, and 4 % more, are searched.
A record at the threshold holds at least one of any so many runs, and more than 4 % of n of 4 % more, so what meets fewer is out.
With the records that are left the text is aligned: all matches of k and more words that can't be extended on either side are taken, merged
into spans and counted, and the runs they hold give the similarity, exactly.

Texts are read once whatever the number of shards: with several, the same runs are first joined with those of all shards, and a text goes only
to shards that hold a group it meets often enough.  Records of evaluation that are near each other by their minima are one group of the
index, named once a run, so a family that holds a third of all rows costs a text one entry and one alignment.

Groups are closed over nearness, so links between records outside evaluation matter too; those, and only those, come from the
token-group matrix of ``near_duplicates``.
"""

from __future__ import annotations

from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import meetings
from corpusloom.llm import near_duplicates as nd
from corpusloom.llm import textkernel as K
from corpusloom.plans.workspace import discard, materialize

_U = np.uint64
#: Words of an index shard, about: some 12 bytes a word, so a shard that a Python worker holds stays near 60 MB.  Groups are spread by hash and never cut.
SHARD_WORDS = 5_000_000
SLACK = 0.04
FRAME = 32
#: Index entries, and words of alignments, handled in one vectorised step.
STEP = 2_000_000
_LINK = "a long, b long, shared long, matches long, longest long, spans long, words long"


class TextIndex:
    """Compressed suffix array over the words of some texts, and the groups of every run of ``k`` words."""

    def __init__(self, texts: list, ids: np.ndarray, groups: np.ndarray, k: int, bits: int):
        words, docs = [], []
        for lo, hi in K.blocks(texts):
            w, d = K.word_hashes(texts[lo:hi])
            words.append(w)
            docs.append(d + lo)
        w = np.concatenate(words) if words else np.empty(0, _U)
        d = np.concatenate(docs) if docs else np.empty(0, np.int64)
        m = len(texts)
        self.ids, (self.labels, self.group) = ids, np.unique(groups, return_inverse=True)
        self.vocabulary, symbols = np.unique(w, return_inverse=True)
        # Every text ends in a separator (symbol 0), each of its own rank; words are 1 and above.
        n = np.bincount(d, minlength=m)
        start = np.concatenate(([0], np.cumsum(n + 1))).astype(np.int64)
        text = np.zeros(int(start[-1]), dtype=np.int64)
        text[np.arange(len(w)) + d] = symbols + 1
        size = len(text)
        rank = text + m - 1
        rank[start[1:] - 1] = np.arange(m)
        # A suffix's rank is the number of smaller ones, by its first ``depth`` words; those that share a rank are ordered further, by twice as many.
        open_, depth = np.arange(size), 0
        while len(open_):
            after = rank[np.minimum(open_ + depth, size - 1)] if depth else np.zeros(size, np.int64)
            by = np.lexsort((after, rank[open_])) if depth else np.argsort(rank, kind="stable")
            open_, after = open_[by], after[by]
            group = rank[open_]
            head = np.concatenate(([True], group[1:] != group[:-1]))
            own = np.concatenate(([True], head[1:] | (after[1:] != after[:-1])))
            place = np.arange(len(open_))
            place -= np.maximum.accumulate(np.where(head, place, 0))
            base = group if depth else np.arange(size) - place
            place = np.maximum.accumulate(np.where(own, np.arange(len(open_)), 0)) - np.maximum.accumulate(np.where(head, np.arange(len(open_)), 0))
            rank[open_] = base + place
            single = own & np.concatenate((own[1:], [True]))
            open_ = open_[~single]
            depth = 2 * depth if depth else 1
        order = np.empty(size, np.int64)
        order[rank] = np.arange(size)
        self.size = size
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(self.vocabulary) + 1)))).astype(np.int64)
        self.starts = rank[start[:-1]].astype(np.int32)
        # Successor of every suffix, named with its first word: rises along the suffixes of words.
        place = text[order] * size + np.where(text[order] > 0, rank[(order + 1) % size], 0)
        place = np.concatenate((place, np.full(-size % FRAME, place[-1])))
        self.base = place[::FRAME].copy()
        self.offset = (place.reshape(-1, FRAME) - self.base[:, None]).astype(np.uint32 if size < (1 << 32) // (FRAME + 1) else np.uint64).ravel()
        # Runs of k words in order of suffixes, and one record of every group that has the run.
        first_words = [text[np.minimum(order + j, size - 1)] for j in range(k)]
        whole = np.logical_and.reduce([c > 0 for c in first_words])
        differ = np.logical_or.reduce([np.diff(c, prepend=-1) != 0 for c in first_words])
        head = whole & differ
        self.runs = np.flatnonzero(head).astype(np.int32)
        run = (np.cumsum(head) - 1)[whole]
        record = np.repeat(np.arange(m), n + 1)[order][whole]
        held = K.distinct_values(run * m + record)
        run, record = held // m, held % m
        self.sizes = np.bincount(record, minlength=m).astype(np.int32)
        named, at = np.unique(run * len(self.labels) + self.group[record], return_index=True)
        self.entry = record[at].astype(np.int32)
        self.entries = np.concatenate(([0], np.cumsum(np.bincount(named // max(1, len(self.labels)), minlength=len(self.runs))))).astype(np.int64)
        h = np.zeros(len(self.runs), dtype=_U)
        for j in range(k):
            h = K.mix(h * _U(K._BASE) + self.vocabulary[first_words[j][self.runs] - 1] + _U(j + 1))
        count = np.bincount((h >> _U(64 - bits)).astype(np.int64), np.bincount(run, minlength=len(self.runs)), minlength=1 << bits)
        self.cells = np.minimum(255, np.ceil(np.log2(count + 1.0) * 8)).astype(np.uint8)
        by_group = np.argsort(self.group, kind="stable")
        self.members, self.member_at = by_group.astype(np.int32), np.searchsorted(self.group[by_group], np.arange(len(self.labels) + 1))

    def rows(self):
        """The arrays in pieces of 4 MB: (name, dtype, piece, bytes)."""
        for name, a in vars(self).items():
            a = np.atleast_1d(a)
            raw = a.tobytes()
            for i in range(0, max(1, len(raw)), 4 << 20):
                yield name, a.dtype.str, i >> 22, raw[i : i + (4 << 20)]

    @classmethod
    def of_rows(cls, rows) -> TextIndex:
        new = cls.__new__(cls)
        pieces: dict[str, list] = {}
        for name, dtype, i, raw in rows:
            pieces.setdefault(name, []).append((i, dtype, raw))
        for name, parts in pieces.items():
            parts.sort()
            value = np.frombuffer(b"".join(p[2] for p in parts), dtype=parts[0][1])
            setattr(new, name, int(value[0]) if name == "size" else value)
            parts.clear()
        return new

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of word hashes; 0 for words that the index lacks."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)

    def places(self, key: np.ndarray) -> np.ndarray:
        """How many suffixes have a smaller (first word, successor) than each key."""
        out = np.empty(len(key), np.int64)
        for lo in range(0, len(key), 50_000):
            q = key[lo : lo + 50_000]
            frame = np.maximum(np.searchsorted(self.base, q, side="left") - 1, 0)
            inside = self.offset.reshape(-1, FRAME)[frame].astype(np.int64) < (q - self.base[frame])[:, None]
            out[lo : lo + 50_000] = np.minimum(frame * FRAME + inside.sum(1), self.size)
        return out

    def intervals(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of rows of symbols: interval [lo, hi) of the suffixes that begin with each, empty if there is none."""
        last = symbols[:, -1]
        lo, hi = self.first[last].copy(), self.first[last + 1].copy()
        hi = np.where((symbols == 0).any(axis=1), lo, hi)
        for j in range(symbols.shape[1] - 2, -1, -1):
            live = np.flatnonzero(lo < hi)
            c = symbols[live, j] * self.size
            lo[live], hi[live] = self.places(c + lo[live]), self.places(c + hi[live])
        return lo, hi

    def words_of(self, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of the records, read from the successors, and the place of each word's record in ``records``."""
        now, live = self.starts[records].astype(np.int64), np.arange(len(records))
        found, owner = [], []
        while len(live):
            c = np.searchsorted(self.first, now, side="right") - 1
            on = c > 0
            now, live, c = now[on], live[on], c[on]
            found.append(self.vocabulary[c - 1])
            owner.append(live)
            now = self.base[now // FRAME] + self.offset[now].astype(np.int64) - c * self.size
        if not found:
            return np.empty(0, _U), np.empty(0, np.int64)
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(found)[order], owner[order]


def picks(words: np.ndarray, doc: np.ndarray, m: int, k: int, theta: float, cells: np.ndarray):
    """Of each text of a block: its distinct runs, those first that are rare by ``cells``, as many as must be searched.

    Returns (place of the first word, text, run hash, rank) of the picked runs, and per text the number of distinct runs and the slack.
    """
    runs, run_doc = K.shingle_hashes(words, doc, k)
    at = np.flatnonzero(doc[: len(words) - k + 1] == doc[k - 1 :]) if len(runs) else np.empty(0, np.int64)
    bits = len(cells).bit_length() - 1
    rank = cells[(runs >> _U(64 - bits)).astype(np.int64)]
    key = (run_doc.astype(_U) << _U(48)) | (rank.astype(_U) << _U(40)) | ((runs >> _U(64 - K.HASH_BITS)) & _U((1 << 40) - 1))
    order = np.argsort(key)
    key = key[order]
    pick = order[np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))]
    n = np.bincount(run_doc[pick], minlength=m)
    place = np.arange(len(pick)) - np.repeat(np.cumsum(n) - n, n)
    slack = (SLACK * n).astype(np.int64)
    most = np.minimum(n, n - np.ceil(theta * n - 1e-9).astype(np.int64) + 1 + slack)
    pick = pick[place < most[run_doc[pick]]]
    return at[pick], run_doc[pick], runs[pick], rank[pick], n, slack


def _candidates(found: TextIndex, texts: list, comp: np.ndarray, k: int, theta: float):
    """(text, group, record, n) of the texts and index groups that meet often enough; record: one of the group that has the rarest run they share."""
    out = []
    label = found.labels
    least, most = (f.reduceat(found.sizes[found.members], found.member_at[:-1]) for f in (np.minimum, np.maximum))
    for lo, hi in K.blocks(texts):
        words, doc = K.word_hashes(texts[lo:hi])
        if len(words) < k:
            continue
        at, own, runs, rank, n, slack = picks(words, doc, hi - lo, k, theta, found.cells)
        have = np.bincount(own[rank > 0], minlength=hi - lo) > slack
        keep = (rank > 0) & have[own]
        at, own, runs = at[keep], own[keep], runs[keep]
        if not len(at):
            continue
        _, one, back = np.unique(runs, return_index=True, return_inverse=True)
        left, right = found.intervals(np.stack([found.symbols(words[at[one] + j]) for j in range(k)], axis=1))
        left, has = left[back], (right > left)[back]
        own, run = own[has], np.searchsorted(found.runs, left[has])
        width = found.entries[run + 1] - found.entries[run]
        last = np.flatnonzero(np.diff(own, append=-1))  # of each text
        total = np.cumsum(width)[last]
        begin = done = 0
        while begin < len(run):  # whole texts, about STEP entries at a time
            i = max(int(np.searchsorted(last, begin)), int(np.searchsorted(total, done + STEP, side="right")) - 1)
            end, done = int(last[i]) + 1, int(total[i])
            w = width[begin:end]
            entry = np.repeat(found.entries[run[begin:end]], w) + (np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w))
            x = np.repeat(own[begin:end], w)
            begin = end
            record = found.entry[entry]
            g = found.group[record].astype(np.int64)
            ok = (most[g] >= theta * n[x] - 1e-9) & (theta * least[g] <= n[x] + 1e-9) & (label[g] != comp[lo + x])
            x, g, record = x[ok], g[ok], record[ok]
            pair, first, count = np.unique(x * len(label) + g, return_index=True, return_counts=True)
            ok = count > slack[pair // len(label)]
            pair, first = pair[ok], first[ok]
            out.append((lo + pair // len(label), pair % len(label), record[first], n[pair // len(label)]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4


def align(found: TextIndex, texts: list, x: np.ndarray, record: np.ndarray, k: int, theta: Fraction):
    """Alignments of texts x with records: (near, shared, matches, longest, spans, words), one value a pair."""
    result = np.zeros((6, len(x)), np.int64)
    length = np.array([len(t or "") for t in texts], dtype=np.int64)[x] // 4 + 1
    ends = np.cumsum(length)
    begin = 0
    while begin < len(x):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + STEP, side="right")))
        result[:, begin:end] = _aligned(found, texts, x[begin:end], record[begin:end], k, theta)
        begin = end
    return result


def _aligned(found, texts, x, record, k, theta):
    tx, xi = np.unique(x, return_inverse=True)
    rx, ri = np.unique(record, return_inverse=True)
    parts = [(lo, *K.word_hashes([texts[i] for i in tx[lo:hi]])) for lo, hi in K.blocks([texts[i] for i in tx])]
    t_run, t_doc = K.shingle_hashes(np.concatenate([p[1] for p in parts]), np.concatenate([p[2] + p[0] for p in parts]), k)
    r_run, r_doc = K.shingle_hashes(*found.words_of(rx), k)
    t_run, r_run = t_run >> _U(64 - K.HASH_BITS), r_run >> _U(64 - K.HASH_BITS)
    # The record's runs by (record, hash): first place of each.
    r_key = (r_doc.astype(_U) << _U(K.HASH_BITS)) | r_run
    r_at = np.argsort(r_key, kind="stable")
    r_at = r_at[np.concatenate((np.ones(min(1, len(r_at)), bool), r_key[r_at][1:] != r_key[r_at][:-1]))]
    r_sorted = r_key[r_at]
    n_record = np.bincount(r_doc[r_at], minlength=len(rx))
    # Is it the first time that a text has the run?
    t_key = (t_doc.astype(_U) << _U(K.HASH_BITS)) | t_run
    t_first = np.zeros(len(t_key), bool)
    t_first[np.unique(t_key, return_index=True)[1]] = True
    n_text = np.bincount(t_doc[t_first], minlength=len(tx))
    begin = np.searchsorted(t_doc, np.arange(len(tx) + 1))
    w = (begin[1:] - begin[:-1])[xi]
    place = np.repeat(begin[:-1][xi], w) + (np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w))
    pair = np.repeat(np.arange(len(x)), w)
    want = (ri[pair].astype(_U) << _U(K.HASH_BITS)) | t_run[place]
    at = np.minimum(np.searchsorted(r_sorted, want), max(0, len(r_sorted) - 1))
    hit = np.flatnonzero(r_sorted[at] == want) if len(r_sorted) else np.empty(0, np.int64)
    pair, place, where = pair[hit], place[hit], r_at[at[hit]]
    shared = np.bincount(pair[t_first[place]], minlength=len(x))
    near = (shared > 0) & (shared * theta.denominator >= theta.numerator * (n_text[xi] + n_record[ri] - shared))
    # A match goes on while the next run of the text is also the record's next.
    same = (pair[1:] == pair[:-1]) & (place[1:] == place[:-1] + 1)
    after = np.minimum(where[:-1] + 1, len(r_key) - 1)
    goes_on = same & (r_key[after] == ((ri[pair[1:]].astype(_U) << _U(K.HASH_BITS)) | t_run[place[1:]])) if len(hit) > 1 else same
    start = np.concatenate((np.ones(min(1, len(hit)), bool), ~goes_on))
    at = np.flatnonzero(start)
    size = np.diff(np.concatenate((at, [len(hit)]))) + k - 1
    longest = np.zeros(len(x), np.int64)
    np.maximum.at(longest, pair[at], size)
    apart = np.concatenate((np.ones(min(1, len(hit)), bool), (pair[1:] != pair[:-1]) | (np.diff(place) > k)))
    cut = np.flatnonzero(apart)
    last = np.concatenate((cut[1:], [len(hit)])) - 1 if len(hit) else cut
    covered = np.bincount(pair[cut], place[last] - place[cut] + k, minlength=len(x)).astype(np.int64)
    return np.stack([near.astype(np.int64), shared, np.bincount(pair[at], minlength=len(x)), longest, np.bincount(pair[cut], minlength=len(x)), covered])


def _load(path: str, shard: int) -> TextIndex | None:
    """The index of a shard from the table in the shared folder; null if no text fell into it."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path if ":" in path else "file://" + path)
    table = ds.dataset(inner, filesystem=system, format="parquet", exclude_invalid_files=True).to_table(filter=ds.field("shard") == shard)
    if not table.num_rows:
        return None
    return TextIndex.of_rows(zip(*(table.column(c).to_pylist() for c in ("name", "dtype", "piece", "raw")), strict=True))


_held: dict[tuple[str, int], TextIndex | None] = {}


def _shard(path: str, shard: int) -> TextIndex | None:
    if (path, shard) not in _held:
        _held.clear()
        _held[path, shard] = _load(path, shard)
    return _held[path, shard]


def _stream(path: str, k: int, theta: float):
    """Map (shard, id, text, comp) to links: one for each text and index group, not the text's own, with a near record."""
    t = Fraction(theta).limit_denominator(10_000)

    def links(found, ids, texts, comp):
        x, g, record, n = _candidates(found, texts, comp, k, theta)
        tried = align(found, texts, x, record, k, t)
        yield x, record, tried
        # Groups whose first record is not near: all their other records of an admissible size.
        rest = np.flatnonzero((tried[0] == 0) & (np.diff(found.member_at)[g] > 1))
        for i in rest:  # one text and group at a time, in slices, until one is near
            members = found.members[found.member_at[g[i]] : found.member_at[g[i] + 1]]
            sizes = found.sizes[members]
            members = members[(np.minimum(sizes, n[i]) >= theta * np.maximum(sizes, n[i]) - 1e-9) & (members != record[i])]
            for lo in range(0, len(members), 2000):
                part = members[lo : lo + 2000].astype(np.int64)
                more = align(found, texts, np.full(len(part), x[i]), part, k, t)
                best = int(np.argmax(more[0] * (1 + more[1])))
                if more[0, best]:
                    yield x[i : i + 1], part[best : best + 1], more[:, best : best + 1]
                    break

    def run(batches):
        for batch in batches:
            shard = batch.column(0).to_numpy(zero_copy_only=False)
            for s in np.unique(shard):
                found = _shard(path, int(s))
                if found is None or not len(found.runs):
                    continue
                part = batch.filter(pa.array(shard == s))
                ids, comp = part.column(1).to_numpy(zero_copy_only=False), part.column(3).to_numpy(zero_copy_only=False)
                for x, record, r in links(found, ids, part.column(2).to_pylist(), comp):
                    near = r[0] > 0
                    yield pa.RecordBatch.from_arrays([pa.array(ids[x[near]]), pa.array(found.ids[record[near]]), *(pa.array(v[near]) for v in r[1:])], names=["a", "b", "shared", "matches", "longest", "spans", "words"])

    return run


def _all_cells(built: DataFrame) -> bytes:
    """The shards' counts added, as ranks (at most 4 MB)."""
    def add(batches):
        total = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                count = np.exp2(np.frombuffer(raw, np.uint8) / 8.0) - 1
                total = count if total is None else total + count
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["raw"])

    parts = built.where("name = 'cells'").select("raw").mapInArrow(add, "raw binary").coalesce(1).mapInArrow(lambda b: ([pa.RecordBatch.from_arrays([pa.array([sum(np.frombuffer(r, np.float32) for x in b for r in x.column(0).to_pylist()).tobytes()], pa.binary())], names=["raw"])]), "raw binary")
    count = np.frombuffer(parts.first()[0], np.float32)
    return np.minimum(255, np.ceil(np.log2(count + 1.0) * 8)).astype(np.uint8).tobytes()


def evaluation_links(texts: DataFrame, k: int, theta: float, runs: int | None = None) -> DataFrame:
    """Links of ``texts(id, text, comp, held)`` to the records of which ``held`` is true: (a, b, shared, matches, longest, spans, words).

    a: the text, b: a near record of evaluation; of every group (comp) of those at most one is reported a text.  shared: runs of k words
    that both have; matches: maximal matches, longest: words of the longest; spans, words: the matches merged in the text, and the words they cover.
    ``runs``: distinct runs of all texts, about, which sizes the buckets.  Tasks build the shards and write them to the shared folder, where the tasks that stream the texts read them; the driver holds none.
    """
    chosen = materialize(texts.where("held").select("id", "text", "comp"), "heldout")
    total = int((chosen.agg(F.sum(F.length("text"))).first()[0] or 0) / 5.5)
    if not total:
        return texts.where("false").select(*[F.lit(0).cast("long").alias(c.split()[0]) for c in _LINK.split(", ")])
    shards = max(1, -(-total // SHARD_WORDS))
    bits = int(np.clip(np.ceil(np.log2(total + 1)), 12, nd.CELL_MOST))

    def build(shard: pa.Table) -> pa.Table:
        index = TextIndex(shard.column("text").to_pylist(), shard.column("id").to_numpy(), shard.column("comp").to_numpy(), k, bits)
        number = shard.column("shard")[0].as_py()
        names, kinds, places, raw = zip(*index.rows(), strict=True)
        return pa.table({"shard": pa.array([number] * len(names), pa.int32()), "name": names, "dtype": kinds, "piece": pa.array(places, pa.int32()), "raw": pa.array(raw, pa.binary())})

    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int").alias("shard")
    built = materialize(chosen.withColumn("shard", shard("comp")).groupBy("shard").applyInArrow(build, "shard int, name string, dtype string, piece int, raw binary"), "index")
    path = built.inputFiles()[0].rsplit("/", 1)[0]
    reading = texts.select("id", "text", "comp")
    if shards == 1:
        routed = reading.select(F.lit(0).alias("shard"), "id", "text", "comp")
    else:
        cells = texts.sparkSession.sparkContext.broadcast(_all_cells(built))
        asks, asked = (meetings.block_count(entries, nd.BUCKET) for entries in (0.45 * (runs or 8 * total), total))
        posted = [
            (meetings.write_blocks(df.select("id", "text", "comp", F.lit(1).alias("csize")).mapInArrow(meetings.postings(k, theta, ranks, blocks, found_only=ranks is not None), meetings.SCHEMA)), blocks)
            for df, ranks, blocks in ((chosen, None, asked), (reading, cells, asks))
        ]
        route = nd.side_table(meetings.meet(texts.sparkSession, *posted, theta, SLACK).select(F.col("q").alias("id"), shard("g")).distinct(), "route")
        for written, _ in posted:
            discard(written)
        routed = reading.join(route, "id").select("shard", "id", "text", "comp").repartition("shard", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("shard")
    return materialize(routed.mapInArrow(_stream(path, k, theta), _LINK), "overlaps")


class Overlaps(NamedTuple):
    """groups(id, grp, split) of rows in a group of two or more; links between representatives with their spans; classes(id, rep)."""

    groups: DataFrame
    links: DataFrame
    classes: DataFrame


def overlaps(records: DataFrame, k: int = 5, theta: float = 0.8, held: tuple[str, ...] = ("val", "test")) -> Overlaps:
    """Groups of ``records(id, text, split)`` and the links to evaluation that the index found."""
    side = F.coalesce(F.col("split").isin(*held), F.lit(False)).cast("int").alias("side")
    signed = nd.sign(records.select("id", "text", side), k, theta)
    inner = nd.matrix_links(signed, k, theta, leave_out=1)
    special = signed.classes.where("id <> rep").select("id", F.lit(True).alias("copy"), F.lit(None).cast("long").alias("comp")).union(signed.parts.select("node", F.lit(False), "root"))
    reading = signed.texts.join(nd.side_table(special, "copies"), "id", "left").where("text is not null and (copy is null or not copy)").select("id", "text", F.coalesce("comp", "id").alias("comp"), (F.col("side") == 1).alias("held"))
    links = evaluation_links(reading, k, theta, signed.shingles)
    groups = nd.groups_of(signed.classes, signed.star_links.union(inner).union(links.select("a", "b")))
    return Overlaps(groups.join(records.select("id", "split"), "id"), links, signed.classes)


def cross_split_groups(records: DataFrame, k: int = 5, theta: float = 0.8, held: tuple[str, ...] = ("val", "test")) -> DataFrame:
    """(id, grp, split): rows of ``records(id, text, split)`` in a group of two or more near texts.

    The groups are those of ``near_duplicate_groups``.  Null ids take no part, null splits belong to no side but pass nearness on;
    texts without a shingle are near nothing.  Further columns are ignored; an empty table gives no rows.
    """
    return overlaps(records, k, theta, held).groups


def cross_pairs(members: DataFrame, key: str, train: str = "train", held: tuple[str, ...] = ("val", "test")) -> DataFrame:
    """(seq_lo, seq_hi): pairs of rows of ``members(id, key, split)`` with the same key, one in training, the other held out; null keys and splits never match."""
    members = materialize(members.select("id", key, "split").where(F.col(key).isNotNull() & F.col("split").isin(train, *held)), "members")
    x, y = members.where(F.col("split") == train), members.where(F.col("split").isin(*held))
    return nd.pairs_within(x.select("id", key), y.select("id", key), key).select(F.least("x", "y").alias("seq_lo"), F.greatest("x", "y").alias("seq_hi"))
