"""Connected components of an edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import written


class Forest:
    """Union-find over integers; the root of a tree is its smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up, root = self.up, x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _stars(batches):
    """The edges of a partition as stars around the smallest node they connect; memory follows the partition's nodes."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            forest.up.setdefault(a, a)
            forest.up.setdefault(b, b)
            forest.union(a, b)
    nodes = [n for n in forest.up if forest.find(n) != n]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([forest.find(n) for n in part], pa.int64())], names=["a", "b"]
        )


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long) → ``node, component``: the smallest node reachable, for every node that has an edge to another.

    Partitions first reduce their edges to stars. Then, round by round, every node hooks onto its smallest neighbour, chains of
    hooks are shortened by joins, and the edges are renamed to the roots, until none is left. A round at least halves the nodes
    that still have edges. Each node has one hook, so a hot node only grows one group of a partial minimum.
    """
    spark = edges.sparkSession
    left = written(edges.filter("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(_stars, "a long, b long"), "graph-edges")
    hooks: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hook = written(hook.select("node", F.least("node", "low").alias("up")), "graph-hooks")
        while True:
            up = hook.select(F.col("node").alias("via"), F.col("up").alias("top"))
            step = hook.join(up, hook["up"] == up["via"], "left").select("node", "up", F.coalesce("top", "up").alias("top"))
            step = written(step, "graph-hooks")
            changed = not step.filter("top <> up").isEmpty()
            hook = step.select("node", F.col("top").alias("up"))
            if not changed:
                break
        hooks.append(hook)
        a = hook.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = hook.select(F.col("node").alias("b"), F.col("up").alias("y"))
        left = written(left.join(a, "a").join(b, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "graph-edges")
    if not hooks:
        return spark.createDataFrame([], "node long, component long")
    found = hooks[-1].select("node", F.col("up").alias("component"))
    for hook in reversed(hooks[:-1]):
        top = found.select(F.col("node").alias("via"), "component")
        named = hook.join(top, hook["up"] == top["via"], "left").select("node", F.coalesce("component", "up").alias("component"))
        found = named.unionByName(found.join(hook.select("node"), "node", "left_anti"))
    return found
