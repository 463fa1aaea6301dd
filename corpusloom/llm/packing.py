"""Filling fixed-capacity containers: bulk-synchronous best-fit over size classes.

Sizes are whole numbers up to the capacity, so documents and gaps range-sort into at most
``CLASSES`` size classes, however many rows there are.  The distributed part counts the classes and
ranks the items inside each; the supersteps work on the classes: take the largest class left, find the
smallest gap that holds it (the successor), give the gaps to the items of lowest rank - one item a gap
and superstep - let the items beyond the number of gaps go on to the next successor, update the gaps,
and repeat; items without a successor open containers.  The supersteps yield ranges (class, ranks) ->
(first container), and each item looks its container up by class and rank.  So the rows move once, and
the packing is that of best-fit decreasing over the whole table, not of one shard at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.workspace import materialize

#: Most size classes; a larger capacity is measured in units of capacity / CLASSES, sizes rounded up: an item then loses less than a unit, a
#: 131,072th of a container.  The plan has about ten ranges (24 bytes each) a class, so it stays under 35 MB whatever the rows.
CLASSES = 131_072
#: Salt of the ranking inside a class: a class with a third of all rows is ranked in so many parts.
RANK_PARTS = 64


def best_fit_classes(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Supersteps on classes: ([(class, first rank, items, first container)], number of containers).

    One item of the class goes into each container of the range.  ``gaps`` maps a gap to ranges of containers with it; a bit set finds successors.
    """
    plan: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    bits = 0
    made = 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            above = bits >> size
            if above:
                gap = size + (above & -above).bit_length() - 1
                ranges = gaps[gap]
                first, n = ranges.pop()
                take = min(n, left)
                if take < n:
                    ranges.append((first + take, n - take))
                if not ranges:
                    del gaps[gap]
                    bits &= ~(1 << gap)
            else:
                gap, first = capacity, made
                take = -(-left // (capacity // size))
                made += take
            plan.append((size, rank, take, first))
            rank += take
            left -= take
            if rest := gap - size:
                gaps.setdefault(rest, []).append((first, take))
                bits |= 1 << rest
    return plan, made


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """Containers of ``items(item, size)``: (item, piece, container, size), one row a piece.

    No container exceeds ``capacity``.  An item within the capacity is one piece (0); a larger one has ceil(size / capacity) pieces, all
    but the last full.  Null, zero and negative sizes take no space (size 0) and go to container 0.  Container numbers are dense from 0.
    An empty table gives an empty result.  item: unique, not null; further columns are ignored.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    unit = -(-capacity // CLASSES)
    whole = capacity // unit
    sized = items.select("item", F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    pieces = sized.select("item", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("size") - 1) / capacity)).cast("int"))).alias("piece"))
    piece = F.least(F.lit(capacity), F.col("size") - F.col("piece").cast("long") * capacity)
    pieces = pieces.select("item", "piece", piece.alias("size"), F.least(F.lit(whole), F.ceil(piece / unit)).cast("int").alias("cls")).withColumn("part", F.when(F.col("cls") > 0, F.pmod(F.xxhash64("item", "piece"), F.lit(RANK_PARTS))).cast("int"))
    pieces = materialize(pieces, "pieces")
    parts = pieces.where("cls > 0").groupBy("cls", "part").agg(F.count("*").alias("n"))
    parts = materialize(parts.withColumn("start", F.coalesce(F.sum("n").over(Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "parts")
    counts = {r.cls: r.n for r in parts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}  # at most CLASSES rows
    plan, _ = best_fit_classes(counts, whole)
    table = np.array(sorted(plan) or [(0, 0, 0, 0)], dtype=np.int64)
    sent = items.sparkSession.sparkContext.broadcast((table[:, 0], table[:, 1], table[:, 3]))

    def place(batches):
        cls, rank0, first = sent.value
        at_class = np.searchsorted(cls, np.arange(whole + 2))
        wide = int(rank0.max()) + 1
        key = cls * wide + rank0
        for batch in batches:
            c, r = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            at = np.searchsorted(key, c.astype(np.int64) * wide + np.minimum(r, wide - 1), side="right") - 1
            at = np.maximum(at, at_class[c])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(first[at] + r - rank0[at]), batch.column(2)], names=["item", "piece", "container", "size"])

    # The window has brought the pieces of a class part together, so the join moves the small side only.
    ranked = pieces.where("cls > 0").withColumn("r", F.row_number().over(Window.partitionBy("cls", "part").orderBy("item", "piece")) - 1).join(parts.select("cls", "part", "start"), ["cls", "part"])
    kind = items.schema["item"].dataType.simpleString()
    out = f"item {kind}, piece int, container long, size long"
    placed = ranked.select("item", "piece", "size", "cls", (F.col("start") + F.col("r")).alias("rank")).mapInArrow(place, out)
    return placed.union(pieces.where("cls = 0").select("item", "piece", F.lit(0).cast("long").alias("container"), "size"))
