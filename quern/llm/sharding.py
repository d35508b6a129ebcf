"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups, sorted by size, enter the bin whose remaining capacity is the tightest that still holds them; a balanced tree keeps
the bins by remaining capacity. Every group is packed by its own size. Groups of one size are alike to the plan, so it is made from the number
of groups of each size, and each group finds its bin by its rank among those of its size. D distinct sizes need at least D * D / 2
bytes of texts, so at most sqrt(2 * total bytes) rows reach the driver.

Edge cases: a null text counts as empty (size 8) and shares the group of the empty text; repeated rows take a slot each; groups of equal
size are told apart by their key, rows of a shard by doc_id and key; a group larger than a fair share has its shard to itself as far as
sizes allow; an empty table gives an empty result; texts of any length count whole; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from quern.llm.storage import durable, table

#: Groups with more than this share of all rows are joined by broadcast; there are fewer than 1 / HEAVY of them.
HEAVY = 0.001
SLOT_LANES = 64


class CapacityTree:
    """AVL tree of (remaining capacity, bin), for the tightest bin that still holds a size."""

    class _Node:
        __slots__ = ("height", "key", "left", "right")

        def __init__(self, key):
            self.key, self.left, self.right, self.height = key, None, None, 1

    def __init__(self):
        self._root = None

    @staticmethod
    def _h(n) -> int:
        return n.height if n else 0

    def _fix(self, n):
        n.height = 1 + max(self._h(n.left), self._h(n.right))
        lean = self._h(n.left) - self._h(n.right)
        if lean > 1:
            if self._h(n.left.left) < self._h(n.left.right):
                n.left = self._turn_left(n.left)
            return self._turn_right(n)
        if lean < -1:
            if self._h(n.right.right) < self._h(n.right.left):
                n.right = self._turn_right(n.right)
            return self._turn_left(n)
        return n

    def _turn_left(self, n):
        up = n.right
        n.right, up.left = up.left, n
        n.height = 1 + max(self._h(n.left), self._h(n.right))
        up.height = 1 + max(self._h(up.left), self._h(up.right))
        return up

    def _turn_right(self, n):
        up = n.left
        n.left, up.right = up.right, n
        n.height = 1 + max(self._h(n.left), self._h(n.right))
        up.height = 1 + max(self._h(up.left), self._h(up.right))
        return up

    def insert(self, key) -> None:
        def put(n):
            if n is None:
                return self._Node(key)
            if key < n.key:
                n.left = put(n.left)
            else:
                n.right = put(n.right)
            return self._fix(n)

        self._root = put(self._root)

    def remove(self, key) -> None:
        def cut(n, key):
            if n is None:
                return None
            if key < n.key:
                n.left = cut(n.left, key)
            elif key > n.key:
                n.right = cut(n.right, key)
            elif n.left is None:
                return n.right
            elif n.right is None:
                return n.left
            else:
                least = n.right
                while least.left:
                    least = least.left
                n.key, n.right = least.key, cut(n.right, least.key)
            return self._fix(n)

        self._root = cut(self._root, key)

    def tightest(self, size: int):
        """The smallest key whose capacity is size or more, or None."""
        n, best = self._root, None
        while n:
            if n.key[0] >= size:
                n, best = n.left, n.key
            else:
                n = n.right
        return best


Lines = dict[int, list[tuple[int, int, int]]]


def best_fit_decreasing(classes: dict[int, int], capacity: int, most: int | None = None) -> tuple[Lines, int] | None:
    """(first rank, groups, bin) for intervals of ranks of groups by size, and the number of bins; None if more than `most` are needed.

    classes: number of groups by size. A group above the capacity gets a bin of its own. The bin that takes the first group of a size
    is the tightest for the next as well, for as long as it holds them.
    """
    tree, bins, lines = CapacityTree(), 0, {}
    for size in sorted(classes, reverse=True):
        at, left = 0, classes[size]
        while left:
            found = tree.tightest(size)
            if found is None:
                if bins == most:
                    return None
                found = (max(capacity, size), bins)
                bins += 1
            else:
                tree.remove(found)
            n = min(left, found[0] // size)
            lines.setdefault(size, []).append((at, n, found[1]))
            tree.insert((found[0] - n * size, found[1]))
            at, left = at + n, left - n
    return lines, bins


def pack_into(classes: dict[int, int], shards: int) -> Lines:
    """Lines for the smallest capacity, to a 4096th of a fair share, at which no more than shards bins are needed."""
    if not classes:
        return {}
    total = sum(s * n for s, n in classes.items())
    low = max(-(-total // shards), 1)
    step = max(low // 4096, 1)
    a, b, best = 0, 1, None
    while (found := best_fit_decreasing(classes, low + b * step, shards)) is None:
        a, b = b + 1, 4 * b
    best = found[0]
    while a < b:
        mid = (a + b) // 2
        if found := best_fit_decreasing(classes, low + mid * step, shards):
            best, b = found[0], mid
        else:
            a = mid + 1
    return best


def assign(rows: DataFrame, group: str, size: str, shards: int, out: str = "shard") -> DataFrame:
    """rows with the shard of each row's group. rows should be cheap to read again: it is read three times."""
    spark = rows.sparkSession
    groups = durable(rows.groupBy(group).agg(F.sum(size).alias("_size"), F.count(F.lit(1)).alias("_n")))
    classes = groups.groupBy("_size").agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("rows")).collect()  # at most sqrt(2 * total bytes) rows
    lines = pack_into({r["_size"]: r["n"] for r in classes}, shards)
    line_type = T.StructType([T.StructField("first", T.LongType()), T.StructField("n", T.LongType()), T.StructField("bin", T.IntegerType())])
    schema = T.StructType([T.StructField("_size", T.LongType()), T.StructField("_lines", T.ArrayType(line_type))])
    ranked = with_slots(groups, "_size", [group], F.xxhash64(group), "_place").join(spark.createDataFrame(list(lines.items()), schema), "_size")
    line = F.filter("_lines", lambda x: (F.col("_place") >= x["first"]) & (F.col("_place") < x["first"] + x["n"]))[0]
    placed = durable(ranked.select(group, "_n", line["bin"].alias(out)))
    heavy = F.col("_n") > HEAVY * sum(r["rows"] for r in classes)
    large = F.broadcast(placed.where(heavy).select(group, out))
    one = rows.join(large, group)
    rest = rows.join(large.select(group), group, "left_anti").join(placed.where(~heavy).select(group, out), group)
    return one.unionByName(rest)


def with_slots(rows: DataFrame, shard: str, order: list[str], lane: Column, out: str = "slot") -> DataFrame:
    """rows with gapless numbers from 0 within each shard, counted in SLOT_LANES lanes, so that no task holds a whole shard."""
    laned = rows.withColumn("_lane", F.pmod(lane, F.lit(SLOT_LANES)).cast("int"))
    before = W.partitionBy(shard).orderBy("_lane").rowsBetween(W.unboundedPreceding, -1)
    starts = laned.groupBy(shard, "_lane").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = F.row_number().over(W.partitionBy(shard, "_lane").orderBy(*order))
    return laned.withColumn("_rank", rank).join(starts, [shard, "_lane"]).withColumn(out, (F.col("_start") + F.col("_rank") - 1).cast("long")).drop("_lane", "_rank", "_start")


def query(spark: SparkSession, sf_dir: str, shards: int = 24) -> DataFrame:
    """op5: every document's shard under the law `bytes`; equal texts stay together."""
    text = F.coalesce("text", F.lit(""))
    rows = durable(
        table(spark, sf_dir, "documents").select(
            "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("_group")
        )
    )
    placed = with_slots(assign(rows, "_group", "size", shards), "shard", ["doc_id", "_group"], F.xxhash64("doc_id", "_group"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
