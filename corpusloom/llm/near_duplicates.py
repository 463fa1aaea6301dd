"""Near-duplicate groups of texts by a token-group matrix.

Two texts are near if the Jaccard similarity of their distinct word shingles reaches a threshold;
groups are closed over nearness.  The work is exact: every pair at or above the threshold inside
different groups is found and verified, whatever the sizes of groups and posting lists.

1. *Signature pass.*  Each text becomes its sorted set of shingle hashes.  A hash of the set makes
   equal sets one class; only the first row of a class goes on.  The same pass counts shingles in a
   table of 2**20 cells (fixed size), which orders all shingles from rare to frequent.
2. *Partition.*  Texts whose one-permutation minima agree in a band are compared with the first text
   of the band, never with each other.  Verified links give the groups of the partition, so a
   family that holds a third of all rows is one group before any pair is formed.
3. *Matrix.*  Of each text the rarest shingles are posted: of a set of n, those that some text of at
   least the same size (or of the smallest admissible size) must share, and 4 % more.  Blocks of
   postings are joined with each other (see ``meetings``).  Each query text counts the groups it
   meets; a pair at the threshold must meet at least 1 + 4 % of theta * n times, which bounds the
   query-group overlap.
4. *Open.*  Groups that reach the bound are opened: members whose size or 512-bit parity sketch rules the
   query out are left, and the query is verified exactly against the others.  Links of 2 and 4 give the final groups.

Texts without a single shingle (null, empty, fewer than k words) are near nothing, not even each other.
"""

from __future__ import annotations

import zlib
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import meetings
from corpusloom.llm import textkernel as K
from corpusloom.operators.graph import SMALL_EDGES, components
from corpusloom.plans.workspace import discard, materialize, materialize_counted, spread

_U = np.uint64
#: Cells of the shingle counts: 2 ** 20, and twice as many for each doubling of the rows beyond ``CELL_ROWS``, up to 2 ** 22 (one byte a cell is broadcast, at most 4 MB).
CELL_BITS, CELL_ROWS, CELL_MOST = 20, 4_000_000, 22
#: A list of more postings is split by ``spread_hot``; postings of a block at least.
HOT_LIST, BUCKET = 50_000, 250_000
ASKS, ASKED = 2, 4
PARTS = 64
BANDS, BAND_BINS = 4, 6
#: Rows of a side table up to which it is broadcast (at most about 40 bytes a row); beyond that the join shuffles.
BROADCAST_ROWS = 400_000
_SIGN = "kind int, id long, side int, sig long, n int, bands array<long>, sketch array<long>, part int, counts binary"


def side_table(df: DataFrame, name: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written and counted in one job, with a broadcast hint if its rows are within the bound."""
    written, n = materialize_counted(df, name)
    return F.broadcast(written) if n <= limit else written


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, list]:
    return batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()


def _segments(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(doc, minlength=n_docs)
    return n, np.concatenate(([0], np.cumsum(n)[:-1]))


def _signatures(k: int, bits: int):
    """Map (id, text, side) to a row a text with shingles, and the shingle counts of the whole task in compressed parts."""

    def run(batches):
        cells = np.zeros(1 << bits, dtype=np.uint32)
        schema = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("side", pa.int32()), ("sig", pa.int64()), ("n", pa.int32()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("part", pa.int32()), ("counts", pa.binary())])
        some = False
        for batch in batches:
            ids, texts = _texts(batch)
            side = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, h, d, m in K.shingle_sets(texts, k):
                if not len(h):
                    continue
                some = True
                np.add(cells, np.bincount((h >> _U(K.HASH_BITS - bits)).astype(np.int64), minlength=len(cells)).astype(np.uint32), out=cells)
                n, start = _segments(d, m)
                has = np.flatnonzero(n)
                sig = np.add.reduceat(K.mix(h + _U(0x51ED27)), start[has]) + K.mix(n[has].astype(_U))
                # One-permutation minima: the top 5 bits of a hash name its bin, the set is sorted, so the first of a bin is its minimum.
                cut = (d << 5) | (h >> _U(K.HASH_BITS - 5)).astype(np.int64)
                first = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1])))
                minima = np.zeros((m, 32), dtype=_U)
                minima[d[first], cut[first] & 31] = h[first]
                bands = np.zeros((len(has), BANDS), dtype=_U)
                for b in range(BANDS):
                    for j in range(BAND_BINS):
                        bands[:, b] = K.mix(bands[:, b] * _U(31) + minima[has, b * BAND_BINS + j] + _U(b + 1))
                size, sketch = len(has), meetings.sketches(h, d, m)[has]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(size, np.int32)), pa.array(ids[lo + has]), pa.array(side[lo + has]), pa.array(sig.view(np.int64)), pa.array(n[has].astype(np.int32)),
                        pa.ListArray.from_arrays(np.arange(0, (size + 1) * BANDS, BANDS, dtype=np.int32), pa.array(bands.ravel().view(np.int64))),
                        pa.ListArray.from_arrays(np.arange(0, (size + 1) * meetings.SKETCH_WORDS, meetings.SKETCH_WORDS, dtype=np.int32), pa.array(sketch.ravel())), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
                    ],
                    schema=schema,
                )
        if some:
            step = len(cells) // PARTS
            blobs = [zlib.compress(cells[i * step : (i + 1) * step].tobytes(), 1) for i in range(PARTS)]
            null = [pa.nulls(PARTS, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(PARTS, np.int32)), *null[1:7], pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(blobs, pa.binary())], schema=schema)

    return run


def _add_counts(batches):
    """Add the count tables of one part of the cells; the input is partitioned by part."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a = np.frombuffer(zlib.decompress(blob), dtype=np.uint32).astype(np.uint64)
            total[part] = total[part] + a if part in total else a
    for part, a in total.items():
        # Eighths of a power of two order the shingles well enough; one byte a cell.
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.minimum(255, np.log2(a + 1.0) * 8).astype(np.uint8).tobytes()], pa.binary())], names=["part", "ranks"])


def hot_chunks(rank: np.ndarray) -> np.ndarray:
    """Into how many chunks the lists of shingles of these ranks are split: one for about ``HOT_LIST`` postings."""
    return np.maximum(1, np.ceil((np.exp2(rank / 8.0) - 1) / HOT_LIST)).astype(np.int64)


def spread_hot(h: np.ndarray, ids: np.ndarray, comp: np.ndarray, chunks: np.ndarray, n: np.ndarray, own: np.ndarray):
    """(source place, list key, flag) of every posting.

    A posting of an ordinary list both asks and is asked.  A list of S chunks becomes S * S smaller ones, one for each chunk of the askers
    (by text) and of the asked (by group): every posting asks in S of them and is asked in S.  What is asked is summed by group within the
    block first: of the postings of a group and list only the smallest and the largest text of each prefix stay, so a group that holds a third of all rows sends four.
    """
    plain = np.flatnonzero(chunks == 1)
    hot = np.flatnonzero(chunks > 1)
    if not len(hot):
        return plain, h[plain], np.full(len(plain), ASKS | ASKED, np.int32)
    c = chunks[hot]
    rep = np.repeat(hot, c)
    j = np.arange(len(rep)) - np.repeat(np.cumsum(c) - c, c)
    cc = chunks[rep]
    name = lambda q, g: K.mix(h[rep] * _U(31) + K.mix((q * cc + g + 1).astype(_U))) >> _U(24)
    asks = name((K.mix(ids[rep].astype(_U)) % cc.astype(_U)).astype(np.int64), j)
    asked = name(j, (K.mix(comp[rep].astype(_U)) % cc.astype(_U)).astype(np.int64))
    order = np.lexsort((n[rep], own[rep], comp[rep], asked))
    head = np.concatenate(([True], (asked[order][1:] != asked[order][:-1]) | (comp[rep][order][1:] != comp[rep][order][:-1]) | (own[rep][order][1:] != own[rep][order][:-1])))
    last = np.concatenate((head[1:], [True]))
    keep = order[head | last]
    return np.concatenate((plain, rep, rep[keep])), np.concatenate((h[plain], asks, asked[keep])), np.concatenate((np.full(len(plain), ASKS | ASKED, np.int32), np.full(len(rep), ASKS, np.int32), np.full(len(keep), ASKED, np.int32)))


def _sets(k: int):
    """Map (id, text) to (id, set): the sorted shingle hashes, 8 bytes each."""

    def run(batches):
        for batch in batches:
            ids, texts = _texts(batch)
            for lo, h, d, m in K.shingle_sets(texts, k):
                n, start = _segments(d, m)
                raw = h.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo : lo + m]), pa.array([raw[s * 8 : (s + c) * 8] for s, c in zip(start.tolist(), n.tolist(), strict=True)], pa.binary())], names=["id", "shingles"])

    return run


def _near(theta: float):
    """Keep the pairs (a, b, sa, sb) whose sets are near."""
    t = Fraction(theta).limit_denominator(10_000)

    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                both = len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True))
                if both and both * t.denominator >= t.numerator * ((len(x) + len(y)) // 8 - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(j).take(pa.array(keep, pa.int64())) for j in (0, 1)], names=["a", "b"])

    return run


def admissible(pairs: DataFrame, sketches: DataFrame, theta: float) -> DataFrame:
    """The pairs (a, b), a side table, that sizes and parity sketches (id, n, sketch) don't rule out; no near pair is ruled out."""
    x, y = (sketches.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    both = x.join(pairs, "a").join(y, "b")
    differ = F.aggregate(F.zip_with("sa", "sb", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, v: t + v)
    total = F.col("na") + F.col("nb")
    need = F.ceil(F.lit(theta / (1 + theta)) * total - 1e-9)
    return both.where((F.least("na", "nb") >= F.lit(theta) * F.greatest("na", "nb") - 1e-9) & (differ <= total - 2 * need)).select("a", "b")


def verify_pairs(pairs: DataFrame, texts: DataFrame, k: int, theta: float) -> DataFrame:
    """The pairs (a, b) of ids whose texts are near, exactly.  Only the texts named in a pair are read into sets.  pairs: a side table."""
    named = side_table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "named")
    sets = materialize(texts.join(named, "id", "left_semi").select("id", "text").mapInArrow(_sets(k), "id long, shingles binary"), "sets")
    joined = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")).join(pairs, "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(_near(theta), "a long, b long")


class Signed(NamedTuple):
    """What the signature and partition steps give: texts(id, text, side), classes(id, side, rep, copies, sig, n, bands, sketch), the broadcast
    shingle ranks, star links (a, b), the partition (node, root) of the representatives that have one, and the shingles of all representatives."""

    texts: DataFrame
    classes: DataFrame
    ranks: object
    star_links: DataFrame
    parts: DataFrame
    shingles: int


def sign(texts: DataFrame, k: int, theta: float) -> Signed:
    """Steps 1 and 2 over ``texts(id, text)``; with a column ``side`` (int) equal and near texts of different sides are not united here."""
    side = F.col("side").cast("int") if "side" in texts.columns else F.lit(0)
    texts = texts.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.coalesce(side, F.lit(0)).alias("side")).where("id is not null")
    texts, rows = materialize_counted(spread(texts), "texts")
    bits = min(CELL_MOST, CELL_BITS + max(0, (rows // CELL_ROWS).bit_length()))
    signed = materialize(texts.mapInArrow(_signatures(k, bits), _SIGN), "signed")
    docs = signed.where("kind = 0")
    classes = docs.groupBy("sig", "n", "side").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(docs.select("id", "side", "sig", "n", "bands", "sketch").join(classes, ["sig", "n", "side"]), "classes")
    shingles = classes.where("id = rep").agg(F.sum("n")).first()[0] or 0

    cells = signed.where("kind = 1").select("part", "counts").repartition(PARTS, "part").mapInArrow(_add_counts, "part int, ranks binary").collect()  # 64 rows, 4 MB in all at most
    ranks = np.zeros(1 << bits, dtype=np.uint8)
    step = len(ranks) // PARTS
    for row in cells:
        ranks[row.part * step : (row.part + 1) * step] = np.frombuffer(row.ranks, np.uint8)
    table = texts.sparkSession.sparkContext.broadcast(ranks.tobytes())

    # Partition: each text of a band against the band's first of the same side.
    reps = classes.where("id = rep")
    banded = reps.select("id", "side", F.posexplode("bands").alias("b", "v"))
    leaders = banded.groupBy("side", "b", "v").agg(F.min("id").alias("a"), F.count("*").alias("m")).where("m > 1").select("side", "b", "v", "a")
    met = side_table(banded.join(leaders, ["side", "b", "v"]).where("id <> a").select("a", F.col("id").alias("b")).distinct(), "met")
    stars = side_table(admissible(met, reps.select("id", "n", "sketch"), theta), "stars")
    star_links = materialize(verify_pairs(stars, texts, k, theta), "starlinks")
    return Signed(texts, classes, table, star_links, materialize(components(star_links, merge_up_to=SMALL_EDGES), "groups"), int(shingles))


def matrix_links(signed: Signed, k: int, theta: float, leave_out: int | None = None) -> DataFrame:
    """Steps 3 and 4: links (a, b) between representatives of different groups; those of the side ``leave_out`` take no part."""
    texts, classes, parts = signed.texts, signed.classes, signed.parts
    sizes = parts.groupBy("root").agg(F.count("*").cast("int").alias("csize"))
    grouped = parts.join(sizes, "root").select(F.col("node").alias("id"), F.col("root").alias("comp"), "csize")
    special = side_table(classes.where("id <> rep").select("id", F.lit(None).cast("long").alias("comp"), F.lit(0).alias("csize")).union(grouped), "special")

    part = texts if leave_out is None else texts.where(F.col("side") != leave_out)
    reading = part.join(special, "id", "left").where("csize is null or csize > 0").select("id", "text", F.coalesce("comp", "id").alias("comp"), F.coalesce("csize", F.lit(1)).alias("csize"))
    blocks = meetings.block_count(0.45 * signed.shingles, BUCKET)
    posted = meetings.write_blocks(reading.mapInArrow(meetings.postings(k, theta, signed.ranks, blocks), meetings.SCHEMA))
    open_ = materialize(meetings.meet(texts.sparkSession, (posted, blocks), None, theta, meetings.SLACK * theta).distinct(), "open")
    discard(posted)
    members = open_.join(grouped.select(F.col("comp").alias("g"), F.col("id").alias("node")), "g", "left").select(F.col("q").alias("a"), F.coalesce("node", "g").alias("b"))
    opened = side_table(admissible(side_table(members, "members"), classes.where("id = rep").select("id", "n", "sketch"), theta), "opened")
    return verify_pairs(opened, texts, k, theta)


def groups_of(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, grp) of every row in a group of two or more, from classes and links between representatives."""
    roots = components(links, merge_up_to=SMALL_EDGES)
    by_class = classes.where("copies > 1").select("id", "rep").union(roots.select(F.col("node").alias("id"), F.col("node").alias("rep"))).distinct()
    return by_class.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("id", F.coalesce("root", "rep").alias("grp"))


def near_duplicate_groups(texts: DataFrame, k: int = 5, theta: float = 0.8) -> DataFrame:
    """Groups of near texts.

    ``texts(id, text)``: id a bigint without repeats; rows with a null id are left out.  Further columns are ignored.
    Returns (id, grp) of every row in a group of two or more; grp is the smallest id of the group.  Rows with the
    same shingle set are one class and always share a group.
    """
    signed = sign(texts, k, theta)
    return groups_of(signed.classes, signed.star_links.union(matrix_links(signed, k, theta)))


def group_pairs(groups: DataFrame) -> DataFrame:
    """The pairs (seq_lo, seq_hi) of ids that share a group."""
    groups = materialize(groups.select("id", "grp"), "grouped")
    return pairs_within(groups, groups, "grp").where("x < y").select(F.col("x").alias("seq_lo"), F.col("y").alias("seq_hi"))


def pairs_within(left: DataFrame, right: DataFrame, key: str, chunk: int = 2000) -> DataFrame:
    """(x, y): every id of ``left(id, key)`` with every id of ``right(id, key)`` of the same key.

    Keys of more than ``chunk`` rows are cut into chunks on both sides, so that no task holds a whole key: chunk i of the left meets chunk j of
    the right in the part (key, i, j).  Null keys never match.
    """
    count = lambda df, name: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))
    hot = count(left, "l").join(count(right, "r"), key).where((F.col("l") > chunk) | (F.col("r") > chunk))
    hot = side_table(hot.select(key, F.ceil(F.col("l") / chunk).cast("int").alias("lc"), F.ceil(F.col("r") / chunk).cast("int").alias("rc")), "hotkeys")
    own = lambda m: F.pmod(F.xxhash64("id"), F.coalesce(m, F.lit(1))).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(m), F.lit(1)) - 1))
    a = left.join(hot, key, "left").select(key, F.col("id").alias("x"), own(F.col("lc")).alias("i"), every("rc").alias("j"))
    b = right.join(hot, key, "left").select(key, F.col("id").alias("y"), every("lc").alias("i"), own(F.col("rc")).alias("j"))
    return a.join(b, [key, "i", "j"]).select("x", "y")


def record_texts(records: DataFrame, *further: str) -> DataFrame:
    """(id, text) of conversation records: the contents of user and assistant messages in order, joined by a line feed; null contents are skipped."""
    said = F.filter("messages", lambda m: m["role"].isin("user", "assistant"))
    return records.select(F.col("input_seq").alias("id"), F.array_join(F.transform(said, lambda m: m["content"]), "\n").alias("text"), *further)
