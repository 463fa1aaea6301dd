"""Connected components by frontier breadth-first search from many seeds at once.

Each contraction works on an adjacency list that is hash-partitioned by node.  Seeds are the nodes
whose hash is the smallest among their neighbours', so every component has one and every node can be
reached from one.  All seeds expand together, level by level; a node takes the smallest label that
reaches it first.  Edges whose ends carry different labels are the collisions: they form a smaller
graph over labels, which is contracted the same way until it has no edge or at most ``SMALL_EDGES``.
Each contraction at least halves the nodes.  All state stays distributed; the driver sees row counts only.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.plans.workspace import materialize, materialize_counted


#: A graph of collisions with at most so many edges (16 bytes each) is merged by one task; a larger one is contracted again.
SMALL_EDGES = 100_000


def _merge(batches):
    """Union-find over a small graph: (label, root)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["node", "root"])


def components(edges: DataFrame, a: str = "a", b: str = "b", merge_up_to: int = 0) -> DataFrame:
    """Label the nodes of the undirected graph ``edges(a, b)``.

    Returns (node, root): one row for every node with an edge to another node; root is the smallest
    node of its component.  Null ends and self-loops are ignored, repeated edges count once, an empty
    edge table gives an empty result.  A whole graph of at most ``merge_up_to`` edges is merged by one task, as the collisions are.
    """
    e = edges.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x is not null and y is not null and x <> y")
    e, n = materialize_counted(e.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not n:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if n <= merge_up_to:
        return e.coalesce(1).mapInArrow(_merge, "node long, root long")
    labels, root = _solve(e, 0)
    full = labels.join(root, "label", "left").select("node", F.coalesce("root", "label").alias("part")) if root is not None else labels.select("node", F.col("label").alias("part"))
    full = materialize(full, "parts")
    low = full.groupBy("part").agg(F.min("node").alias("root"))
    return full.join(low, "part").select("node", "root")


def _solve(edges: DataFrame, r: int) -> tuple[DataFrame, DataFrame | None]:
    """edges(a, b): written, distinct, a < b, not empty.  Gives labels(node, label) and, if labels collide, root(label, root)."""
    adj = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(r)).alias("h"), F.col(c).alias("v"))
    nodes = Observation()
    near = adj.groupBy("a").agg(F.min(rank("b")).alias("m")).observe(nodes, F.count(F.lit(1)).alias("n"))
    labelled, done = materialize_counted(near.where(rank("a") < F.col("m")).select(F.col("a").alias("node"), F.col("a").alias("label")), "seeds")
    total, frontier = int(nodes.get["n"]), labelled
    while done < total:  # every component holds a seed, so each level reaches at least one new node
        reached = frontier.join(adj, F.col("node") == F.col("a")).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("label"))
        frontier, fresh = materialize_counted(reached.join(labelled.select("node"), "node", "left_anti"), "level")
        labelled, done = labelled.union(frontier), done + fresh
    one = labelled.select(F.col("node").alias("a"), F.col("label").alias("la"))
    two = labelled.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    met = edges.join(one, "a").join(two, "b").where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
    clash, n = materialize_counted(met, "clash")
    if not n:
        return labelled, None
    if n <= SMALL_EDGES:
        return labelled, materialize(clash.coalesce(1).mapInArrow(_merge, "node long, root long").withColumnRenamed("node", "label"), "up")
    deeper, root = _solve(clash, r + 1)
    up = deeper.join(root, "label", "left").select(F.col("node").alias("label"), F.coalesce("root", "label").alias("root")) if root is not None else deeper.select(F.col("node").alias("label"), F.col("label").alias("root"))
    return labelled, materialize(up, "up")
