"""Paragraph statistics: exploding documents, exact and near frequencies, joining them back, reassembling documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators.durable import durable, release

PARAGRAPH = "struct<path:string,text:string,pos:int,exact_freq:int,near_freq:int,removed_by:string>"


def explode(docs: DataFrame, sep: str = T.SEPARATOR, clean: bool = True, limits: bool = True) -> DataFrame:
    """A row for each paragraph: the other columns, path, pos and text. Documents beyond the limits go."""
    docs = docs.where(T.within_limits(F.col("text"), sep)) if limits else docs
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(*rest, F.posexplode(T.split_all(F.col("text"), sep)).alias("pos", "_raw"))
    body = T.without_links(F.col("_raw")) if clean else T.body_of(F.col("_raw"))
    return rows.select(*rest, T.path_of(F.col("_raw")).alias("path"), "pos", body.alias("text"))


def frequencies(paragraphs: DataFrame) -> DataFrame:
    """text, freq."""
    return paragraphs.groupBy("text").agg(F.count(F.lit(1)).alias("freq"))


def statistics(reprs: DataFrame, no_ones: bool = False) -> DataFrame:
    """hash, repr_hash, freq -> hash, repr_hash, exact_freq, near_freq (the sum over a representative's group)."""
    groups = reprs.groupBy("repr_hash").agg(T.clamp_int(F.sum("freq")).alias("near_freq"))
    groups = groups.where("near_freq > 1") if no_ones else groups
    rows = reprs.select("hash", "repr_hash", T.clamp_int(F.col("freq")).alias("exact_freq")).join(groups, "repr_hash")
    return rows.select("hash", "repr_hash", "exact_freq", "near_freq").dropDuplicates(["hash"])


def heavy_hitters(rows: DataFrame, key: str, k: int = 100) -> DataFrame:
    """The k most frequent keys and their counts, ties by key."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(k)


def join_statistics(paragraphs: DataFrame, stats: DataFrame, hashed: Column, heavy: int = 100) -> DataFrame:
    """Paragraphs with exact_freq and near_freq; 1 where the statistics don't know them.

    For the `heavy` most frequent hashes both are at least the count in these paragraphs. These hashes, a bounded number, are
    joined by broadcast; the rest of the join isn't skewed then.
    """
    rows = paragraphs.withColumn("_hash", hashed)
    top = F.broadcast(heavy_hitters(rows, "_hash", heavy).select("_hash", F.col("n").alias("_local")))
    known = stats.select(F.col("hash").alias("_hash"), F.col("exact_freq"), F.col("near_freq"))
    heavy_known = F.broadcast(top.join(known, "_hash", "left"))
    one = rows.join(heavy_known, "_hash", "inner")
    other = rows.join(top, "_hash", "left_anti").join(known, "_hash", "left").withColumn("_local", F.lit(1).cast("long"))
    both = one.unionByName(other)
    freq = lambda c: T.clamp_int(F.greatest(F.coalesce(F.col(c), F.lit(1)), F.col("_local"))).alias(c)
    return both.select(*paragraphs.columns, freq("exact_freq"), freq("near_freq"))


def assemble(paragraphs: DataFrame, doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """A row for each document with `paragraphs` in order, `removed_by` null."""
    columns = set(paragraphs.columns)
    field = lambda c, kind, default: (F.col(c) if c in columns else F.lit(default)).cast(kind).alias(c)
    one = F.struct(field("pos", "int", 0), field("path", "string", ""), field("text", "string", ""), field("exact_freq", "int", 1), field("near_freq", "int", 1))
    rows = paragraphs.groupBy(doc_id).agg(F.array_sort(F.collect_list(one)).alias("_p"), *(F.first(c).alias(c) for c in keep or []))
    made = F.transform("_p", lambda p: F.struct(p["path"].alias("path"), p["text"].alias("text"), p["pos"].alias("pos"), p["exact_freq"].alias("exact_freq"), p["near_freq"].alias("near_freq"), F.lit(None).cast("string").alias("removed_by")))
    return rows.select(doc_id, *(keep or []), made.alias("paragraphs"), F.lit(None).cast("string").alias("removed_by"))


def parse(docs: DataFrame, sep: str = T.SEPARATOR, clean: bool = True) -> DataFrame:
    """Documents as arrays of paragraphs without a shuffle, all frequencies 1; empty paragraphs go."""
    parts = F.filter(T.split_all(F.col("text"), sep), lambda x: x != "")
    body = (lambda x: T.without_links(x)) if clean else T.body_of
    made = F.transform(parts, lambda x, i: F.struct(T.path_of(x).alias("path"), body(x).alias("text"), i.alias("pos"), F.lit(1).alias("exact_freq"), F.lit(1).alias("near_freq"), F.lit(None).cast("string").alias("removed_by")))
    return docs.withColumn("paragraphs", made).withColumn("removed_by", F.lit(None).cast("string")).drop("text")


def render(docs: DataFrame, sep: str = T.SEPARATOR, text_only: bool = True, debug: bool = False) -> DataFrame:
    """Documents as text, a row for each marker that removed some of it; only what stays unless debug; empty texts go."""
    told = lambda by: F.transform("paragraphs", lambda p: F.struct(F.coalesce(p["removed_by"], by, F.lit("null")).alias("by"), p["path"].alias("path"), p["text"].alias("text")))
    marked = docs.withColumn("_p", T.once(F.col("removed_by"), told))
    rows = marked.withColumn("filter", F.explode(F.array_distinct(F.transform("_p", lambda p: p["by"]))))
    rows = rows if debug else rows.where("filter = 'null'")
    whole = lambda p: p["text"] if text_only else F.when(p["path"] == "", p["text"]).otherwise(F.concat(p["path"], F.lit(T.PATH_MARK), p["text"]))
    text = F.array_join(F.transform(F.filter("_p", lambda p: p["by"] == F.col("filter")), whole), sep)
    return rows.select(*(c for c in docs.columns if c not in ("paragraphs", "removed_by")), text.alias("text"), "filter").where("text != ''")


def merge_statistics(stats: DataFrame, most_remaps: int = 10, no_ones: bool = False, exact: bool = False) -> DataFrame:
    """One table of statistics from the union of several: hash, repr_hash, exact_freq, near_freq.

    A hash takes the smallest representative it was seen with; the others of its representatives are remapped to it, and remaps are
    followed for most_remaps + 1 rounds at most, fewer if a round changes nothing. exact follows them without a bound, as connected
    components. near_freq is the largest sum within a final group.
    """
    stats = stats.where("near_freq > 1") if no_ones else stats
    total = lambda c: T.clamp_int(F.sum(F.col(c).cast("long"))).alias(c)
    merged = stats.groupBy("hash").agg(F.min("repr_hash").alias("new_repr"), F.count_distinct("repr_hash").alias("_reprs"), total("exact_freq"), total("near_freq"))
    seen = stats.select("hash", "repr_hash").join(merged.select("hash", "new_repr", "_reprs"), "hash")
    changed = durable(seen.where("repr_hash != new_repr").select("repr_hash", "new_repr").distinct())
    direct = changed.groupBy("repr_hash").agg(F.min("new_repr").alias("to"))
    updates = durable(direct.select(F.col("repr_hash").alias("old"), "to").union(changed.join(direct, "repr_hash").select(F.col("new_repr").alias("old"), "to")).where("old != to").distinct())
    release(changed)
    if exact:
        from quern.operators.components import connected

        remaps = connected(updates, "old", "to").select(F.col("node").alias("init"), F.col("component").alias("to"))
    else:
        several = stats.groupBy("repr_hash").count().where("count > 1").select("repr_hash")
        start = several.union(seen.where("_reprs > 1").select("repr_hash")).distinct()
        remaps, before = durable(start.select(F.col("repr_hash").alias("init"), F.col("repr_hash").alias("to"))), None
        for _ in range(most_remaps + 1):
            step = remaps.select("init", F.col("to").alias("old")).join(updates, "old", "left")
            moved = step.groupBy("init").agg(F.min(F.coalesce("to", "old")).alias("to"))
            remaps, old = durable(moved.where("init != to")), remaps
            release(old)
            state = remaps.agg(F.count(F.lit(1)), F.sum(F.xxhash64("init", "to").cast("decimal(38,0)"))).first()
            if state == before:
                break
            before = state
    final = merged.join(remaps.select(F.col("init").alias("new_repr"), F.col("to").alias("_to")), "new_repr", "left")
    rows = final.select("hash", F.coalesce("_to", "new_repr").alias("repr_hash"), "exact_freq", "near_freq")
    near = rows.groupBy("repr_hash").agg(F.max("near_freq").alias("near_freq"))
    return rows.drop("near_freq").join(near, "repr_hash").select("hash", "repr_hash", "exact_freq", "near_freq")
