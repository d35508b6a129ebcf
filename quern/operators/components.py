"""Connected components of a table of edges: labels are the smallest node of each component."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.durable import durable, release

#: Nodes that a task holds at once; beyond them it hands on what it has joined and starts anew.
HELD = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition as stars: each node with the smallest node that it is joined to within the partition."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, x)
        return top

    def stars() -> pa.RecordBatch:
        rows = [(x, r) for x in above if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                above[max(a, b)] = min(a, b)
        if len(above) > HELD:
            yield stars()
            above = {}
    if above:
        yield stars()


def connected(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """node, component for all nodes of the edges.

    In a round each partition turns its edges into stars; then each node, grouped by itself alone, hangs all roots it was given on the
    smallest of them, and nodes under a root that found a smaller one move there. No task holds the nodes of a component: a node's
    group has a root for each task at most, and the number of rounds grows with the logarithm of the longest path.
    """
    now = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u != v")
    before: list[DataFrame] = []
    for _ in range(rounds):
        stars = now.mapInArrow(_forest, "u long, v long")
        ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("root")))
        rows = stars.select(F.explode(ends).alias("e")).select("e.node", "e.root")
        named = durable(rows.groupBy("node").agg(F.collect_set("root").alias("roots"), F.max(F.col("root").isNull()).alias("above")))
        release(*before)
        several, moved = F.size("roots") > 1, F.col("above") & (F.size("roots") > 0)
        if named.where(several | moved).isEmpty():
            return named.select("node", F.coalesce(F.array_min("roots"), "node").alias("component"))
        least = F.array_min("roots")
        moves = durable(named.where(moved).select(F.col("node").alias("v"), least.alias("_to")))
        hung = F.concat(F.array(F.struct(F.col("node").alias("u"), least.alias("v"))), F.transform(F.filter("roots", lambda r: r != least), lambda r: F.struct(r.alias("u"), least.alias("v"))))
        links = named.where(F.size("roots") > 0).select(F.explode(hung).alias("e")).select("e.u", "e.v")
        now = links.join(moves, "v", "left").select("u", F.coalesce("_to", "v").alias("v"))
        before = [named, moves]
    raise RuntimeError("components did not settle")
