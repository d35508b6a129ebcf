"""Paragraphs of documents that arrive as a stream (doc_id, text, and a timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import paragraphs


def cleaned(docs: DataFrame, steps, sep: str = T.SEPARATOR) -> DataFrame:
    """Documents through a filter pipeline, by what each has in itself: frequencies are 1. No state."""
    return paragraphs.render(steps(paragraphs.parse(docs, sep)), sep).drop("filter")


def paragraph_counts(docs: DataFrame, time: str, window: str = "1 hour", late: str = "1 hour", sep: str = T.SEPARATOR) -> DataFrame:
    """hash, start, n: how often a paragraph came in each window. State is dropped once a window is `late` past."""
    rows = paragraphs.explode(docs.select("doc_id", time, "text"), sep).withWatermark(time, late)
    return rows.groupBy(F.window(time, window).alias("_w"), F.xxhash64("text").alias("hash")).agg(F.count(F.lit(1)).alias("n")).select("hash", F.col("_w.start").alias("start"), "n")


def first_seen(docs: DataFrame, time: str, late: str = "1 hour", sep: str = T.SEPARATOR) -> DataFrame:
    """Paragraph rows whose text has not come within the watermark before: repeated ones go as they arrive."""
    rows = paragraphs.explode(docs, sep).withWatermark(time, late)
    return rows.withColumn("hash", F.xxhash64("text")).dropDuplicatesWithinWatermark(["hash"])


def frequent(docs: DataFrame, stats: DataFrame, least: int, sep: str = T.SEPARATOR) -> DataFrame:
    """Paragraph rows with near_freq from a table of statistics, of those that occur `least` times or more: a stream joined with a table."""
    known = stats.where(F.col("near_freq") >= least).select("hash", "near_freq")
    return paragraphs.explode(docs, sep).withColumn("hash", F.xxhash64("text")).join(known, "hash")
