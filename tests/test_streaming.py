"""Streams give what the same operators give on tables."""

import json

from pyspark.sql import functions as F

from quern import streaming
from quern.operators import filters
from quern.plans.pipeline import Pipeline

KIND = "doc_id string, at timestamp, text string"
ROWS = [("a", "2024-01-01T00:00:00", "one\n\ntwo\n\none"), ("b", "2024-01-01T00:30:00", "two\n\nthree words here"), ("c", "2024-01-01T02:00:00", "one")]


def source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, row in enumerate(ROWS):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps(dict(zip(("doc_id", "at", "text"), row, strict=True))))
    return spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))


def result(spark, made, tmp_path, name, mode="append"):
    made.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    return spark.table(name).collect()


def test_streams(spark, tmp_path):
    docs = source(spark, tmp_path)
    counts = result(spark, streaming.paragraph_counts(docs, "at", "1 hour", "10 hours"), tmp_path, "counts", "complete")
    names = {r["h"]: r["t"] for r in spark.createDataFrame([("one",), ("two",), ("three words here",)], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    assert sorted((names[r["hash"]], r["start"].hour, r["n"]) for r in counts) == [("one", 0, 2), ("one", 2, 1), ("three words here", 0, 1), ("two", 0, 2)]
    seen = result(spark, streaming.first_seen(docs, "at", "10 hours"), tmp_path, "seen")
    assert sorted(r["text"] for r in seen) == ["one", "three words here", "two"]
    kept = result(spark, streaming.cleaned(docs, Pipeline([filters.DocLength(5)])), tmp_path, "kept")
    assert sorted(r["doc_id"] for r in kept) == ["a", "b"]
    stats = spark.createDataFrame([("one",)], "t string").select(F.xxhash64("t").alias("hash"), F.lit(7).alias("near_freq"))
    met = result(spark, streaming.frequent(docs, stats, 5), tmp_path, "met")
    assert sorted((r["doc_id"], r["pos"], r["near_freq"]) for r in met) == [("a", 0, 7), ("a", 2, 7), ("c", 0, 7)]
