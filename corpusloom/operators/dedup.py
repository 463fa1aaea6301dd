"""Duplicates and set operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from corpusloom.functions.text import jaccard, word_set
from corpusloom.operators.graph import components
from corpusloom.plans.workspace import materialize, read_part, write_parts


def first_by_key(df: DataFrame, keys: list[str | Column], seq: str, keep_all: Column | None = None) -> DataFrame:
    """The row of smallest ``seq`` of every key; rows where ``keep_all`` holds (say, an empty id) all stay.

    The smallest row is found by an aggregate with partial sums, so a key with a third of all rows does not gather in one task.
    """
    cols = [k if isinstance(k, Column) else F.col(k) for k in keys]
    row = F.struct(*[F.col(c) for c in df.columns])
    named = [c.alias(f"__k{i}") for i, c in enumerate(cols)]
    part = df if keep_all is None else df.where(~F.coalesce(keep_all, F.lit(False)))
    best = part.groupBy(*named).agg(F.min_by(row, F.col(seq)).alias("__row")).select("__row.*")
    return best if keep_all is None else best.union(df.where(F.coalesce(keep_all, F.lit(False))))


def fingerprint(*columns: str) -> Column:
    """md5 of the canonical JSON of the columns, in the order of their names; nulls are left out."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])))


def near_vector_groups(pairs: DataFrame) -> DataFrame:
    """(node, root) of groups of two or more, from pairs (a, b) closer than the threshold."""
    return components(pairs)


def consecutive_overlap(df: DataFrame, group: list[str], order: str, text: str, limit: float = 0.6) -> DataFrame:
    """Pairs of consecutive texts with the Jaccard similarity of their words, and whether it stays below the limit."""
    w = Window.partitionBy(*group).orderBy(order)
    words = word_set(F.coalesce(F.col(text), F.lit("")))
    return df.withColumn("__w", words).withColumn("__p", F.lag("__w").over(w)).where("__p is not null").withColumn("overlap", jaccard(F.col("__w"), F.col("__p"))).withColumn("distinct_enough", F.col("overlap") < limit).drop("__w", "__p")


def latest_by_key(df: DataFrame, keys: list[str], seq: str, values: list[str]) -> DataFrame:
    """Of every key the values of the row with the largest ``seq``."""
    return df.groupBy(*keys).agg(*[F.max_by(v, seq).alias(v) for v in values])


#: Sets of a part at most, and about how many parts a smaller table has; sets of a tile, whose pairs are counted in one matrix, and shared grams counted in one step.
PART, PARTS, TILE, STEP = 30_000, 12, 2000, 4_000_000


class _Sets:
    """The sets of a part: their grams sorted within each tile."""

    def __init__(self, table):
        grams = table.column("g").combine_chunks()
        self.r, self.c, self.n = table.column("r"), table.column("c").to_numpy().astype(float), table.column("n").to_numpy().astype(float)
        flat, ends = grams.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(np.diff(grams.offsets.to_numpy()))))
        owner = np.repeat(np.arange(len(self.n)), np.diff(ends))
        self.tiles = []
        for lo in range(0, len(self.n), TILE):
            hi = min(lo + TILE, len(self.n))
            part = slice(ends[lo], ends[hi])
            order = np.argsort(flat[part])
            self.tiles.append((slice(lo, hi), flat[part][order], owner[part][order] - lo))


def _similar(a: _Sets, ta, b: _Sets, tb) -> np.ndarray:
    """Jaccard similarity of every set of a tile with every set of another."""
    (rows, ga, oa), (cols, gb, ob) = ta, tb
    na, nb = a.n[rows], b.n[cols]
    shared = np.zeros(len(na) * len(nb))
    lo, hi = np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right")
    busy = np.flatnonzero(hi > lo)
    base, width = lo[busy], (hi - lo)[busy]
    ends, begin = np.cumsum(width), 0
    while begin < len(busy):  # a list has at most TILE entries
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + STEP, side="right")))
        w = width[begin:end]
        at = np.repeat(base[begin:end] - (np.cumsum(w) - w), w) + np.arange(w.sum())
        shared += np.bincount(np.repeat(oa[busy[begin:end]] * len(nb), w) + ob[at], minlength=len(shared))
        begin = end
    shared = shared.reshape(len(na), len(nb))
    return shared / np.maximum(1, na[:, None] + nb[None, :] - shared)


def _sums(path: str, tasks: list[tuple[str, str]]):
    """Map numbers of tasks (two parts each) to (r, t): the sum of a set's similarities to the rows of the other sets."""

    def run(batches):
        for batch in batches:
            for i, j in (tasks[t] for t in batch.column(0).to_pylist()):
                read = [read_part(path, "part", x, ["r", "c", "n", "g"]) for x in ((i,) if i == j else (i, j))]
                if any(t is None for t in read):
                    continue
                sets = [_Sets(t) for t in read]
                a, b = sets[0], sets[-1]
                sums = [np.zeros(len(x.n)) for x in sets]
                for p, ta in enumerate(a.tiles):
                    for q, tb in enumerate(b.tiles):
                        if a is b and q < p:
                            continue
                        m = _similar(a, ta, b, tb)
                        if a is b and p == q:
                            np.fill_diagonal(m, 0)
                        else:
                            sums[-1][tb[0]] += a.c[ta[0]] @ m
                        sums[0][ta[0]] += m @ b.c[tb[0]]
                for x, t in zip(sets, sums, strict=True):
                    yield from pa.table({"r": x.r, "t": t}).to_batches()

    return run


def mean_novelty(df: DataFrame, ident: str, group: str, grams: str) -> DataFrame:
    """(ident, novelty, n_grams): 1 - mean Jaccard of a row's distinct, non-empty ``grams`` with those of each other row of the group.

    Equal sets are one representative with its count.  The work grows with the square of a group's representatives, but no pair is written:
    their grams (as 64-bit hashes, of the group too) are written once in parts, two parts are a task that counts shared grams in tiles and returns sums.
    """
    spark = df.sparkSession
    x = materialize(df.select(F.col(ident).alias("r"), F.col(group).alias("k"), F.size(grams).alias("n"), F.sha2(F.to_json(F.array_sort(grams)), 256).alias("s")), "sets")
    reps = x.groupBy("k", "s").agg(F.min("r").alias("first"), F.count("*").alias("c"))
    full = materialize(x.join(reps, ["k", "s"]).drop("s"), "novelty")
    one = full.where("r = first")
    sets = one.count()
    size = int(min(PART, max(TILE, sets // PARTS)))
    # Groups of more than a part are cut; the others share parts by hash.
    large = {i: row for i, row in enumerate(one.groupBy("k").count().where(F.col("count") > size).collect())}  # at most one for every ``size`` sets
    parts = {i: -(-row["count"] // size) for i, row in large.items()}
    small = max(1, -(-sets // size))
    names = spark.createDataFrame([(row["k"], i, parts[i]) for i, row in large.items()], StructType([StructField("k", df.schema[group].dataType), StructField("i", IntegerType()), StructField("m", IntegerType())]))
    part = F.when(F.col("i").isNull(), F.concat(F.lit("s"), F.pmod(F.xxhash64("k"), F.lit(small)))).otherwise(F.concat("i", F.lit("_"), F.pmod(F.xxhash64("r"), F.col("m"))))
    placed = one.join(F.broadcast(names), "k", "left").select("r", "c", part.alias("part"))
    hashed = df.select(F.col(ident).alias("r"), F.size(grams).alias("n"), F.transform(grams, lambda g: F.xxhash64(F.col(group), g)).alias("g"))
    path = write_parts(hashed.join(placed, "r"), "part", "grams")
    tasks = [(f"s{b}", f"s{b}") for b in range(small)] + [(f"{i}_{p}", f"{i}_{q}") for i, m in parts.items() for p in range(m) for q in range(p, m)]
    met = spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(_sums(path, tasks), StructType([StructField("r", df.schema[ident].dataType), StructField("t", DoubleType())]))
    met = materialize(met.groupBy(F.col("r").alias("first")).agg(F.sum("t").alias("t")), "similar")
    all_ = full.groupBy("k").agg(F.count("*").alias("all"))
    mean = F.try_divide(F.coalesce("t", F.lit(0.0)) + F.col("c") - 1, F.col("all") - 1)
    return full.join(met, "first", "left").join(all_, "k").select(F.col("r").alias(ident), F.round(1 - mean, 6).alias("novelty"), F.col("n").alias("n_grams"))
