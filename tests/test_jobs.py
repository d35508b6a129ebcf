"""Jobs end to end on small files, sinks and stages that are kept."""

import csv
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_warc import http, record

from quern import jobs
from quern.jobs.__main__ import options
from quern.sources import files, warc


def lines_of(path, suffix):
    return [line for f in sorted(os.listdir(path)) if f.endswith(suffix) for line in open(os.path.join(path, f), encoding="utf-8")]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents whose paragraphs repeat exactly, nearly, or not at all."""
    r = random.Random(1)
    word = lambda: "".join(r.choices("abcdefghilmnorstu", k=r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    often, near = text(20), text(30)
    rows = [(str(k), "\n\n".join([text(15), often, near[:-1] + "xyz"[k % 3], text(12)]), f"http://{k % 2}/") for k in range(6)]
    path = str(tmp_path_factory.mktemp("corpus") / "docs")
    spark.createDataFrame(rows, "doc_id string, text string, url string").write.parquet(path)
    return path, often, near


def test_dedup_in_one_go_and_in_stages(spark, corpus, tmp_path):
    path, often, near = corpus
    at = lambda name: str(tmp_path / name)
    jobs.dedup(spark, [path], at("all"), partitions=2, text_only=True)
    done = {r["doc_id"]: r["text"] for r in spark.read.parquet(at("all")).collect()}
    assert len(done) == 6 and all(often not in t and near[:40] not in t and t.count("\n\n") == 1 for t in done.values())

    jobs.dedup(spark, [path], at("reprs"), ["reprHashes", "saveReprHashes"])
    reprs = spark.read.parquet(at("reprs"))
    assert reprs.count() == 6 * 2 + 1 + 3 and reprs.select("repr_hash").distinct().count() == 6 * 2 + 2
    jobs.dedup(spark, [path], at("stats"), ["stats", "saveStats"], cache=at("reprs"))
    stats = {r["exact_freq"]: r["near_freq"] for r in spark.read.parquet(at("stats")).collect()}
    assert stats == {6: 6, 2: 6}
    jobs.dedup(spark, [path], at("ones"), ["stats", "saveStats"], cache=at("reprs"), intermediate=True)
    assert spark.read.parquet(at("ones")).count() == 16
    jobs.dedup(spark, [path], at("later"), ["filter"], cache=at("stats"), text_only=True)
    assert {r["doc_id"]: r["text"] for r in spark.read.parquet(at("later")).collect()} == done
    jobs.dedup(spark, [path], at("debug"), ["filter", "filter-debug"], cache=at("stats"), text_only=True)
    shown = spark.read.parquet(at("debug"))
    assert {r["filter"]: r["n"] for r in shown.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).collect()} == {"null": 6, "DuplicateParagraphs(2)": 6} and "url" in shown.columns
    jobs.dedup(spark, [path], at("whole"), ["saveReassembled"], cache=at("stats"), partitions=1)
    rows = [json.loads(line) for line in lines_of(at("whole"), ".json")]
    assert len(rows) == 24 and [r["pos"] for r in rows[:4]] == [0, 1, 2, 3] and sorted({r["near_freq"] for r in rows}) == [1, 6]
    jobs.dedup(spark, [path], at("json"), ["reprHashes", "saveReprHashes"], debug=True)
    assert all(json.loads(line)["hash"] != json.loads(line)["repr_hash"] for line in lines_of(at("json"), ".json")) and len(lines_of(at("json"), ".json")) == 2
    jobs.dedup(spark, [path], at("csv"), ["stats", "saveStats"], cache=at("reprs"), debug=True, partitions=1)
    rows = list(csv.reader(lines_of(at("csv"), ".csv")))
    assert [int(r[3]) for r in rows] == [6] * 4 and all(len(r[-1]) == 32 for r in rows)
    with pytest.raises(ValueError, match="no stages"):
        jobs.dedup(spark, [path], at("x"), ["nothing"])

    jobs.merge_stats(spark, [at("stats"), at("stats")], at("merged"), partitions=2)
    assert sorted(r["near_freq"] for r in spark.read.parquet(at("merged")).collect()) == [12] * 4
    jobs.filter_stats(spark, [path], at("metric"), "max-near-freq", stats=at("stats"), examples=1.0, partitions=1)
    rows = list(csv.reader(lines_of(at("metric"), ".csv"), escapechar=None))
    assert len(rows) == 6 and {float(r[1]) for r in rows} == {6.0} and all("<p>" in r[2] for r in rows)
    jobs.filter_stats(spark, [path], at("runs"), "large-freq-paragraphs", arg="5", stats=at("stats"), partitions=1)
    assert {float(r[1]) for r in csv.reader(lines_of(at("runs"), ".csv"))} == {0.0}


def test_warc_files_to_documents(spark, tmp_path):
    pages = [record(http(f"<body><p>page {k}</p></body>".encode()), uri=f"http://{k}/") for k in range(3)] + [record(http(b"", status="500 Error"))]
    (tmp_path / "a.warc.gz").write_bytes(warc.compress(pages))
    told = jobs.extract(spark, [str(tmp_path / "a.warc.gz")], str(tmp_path / "out"), max_partitions=1)
    assert {r["status"]: r["n"] for r in told.collect()} == {"ok": 3, "http 500": 1}
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 3 and os.listdir(tmp_path / "out" / "language=unknown")
    jobs.repackage(spark, [str(tmp_path / "out")], str(tmp_path / "again"), form="json", compression="gzip", clear=True, max_partitions=1)
    names = [n for n in os.listdir(tmp_path / "again") if n.endswith(".json.gz")]
    assert sorted(json.loads(line)["text"] for line in gzip.open(tmp_path / "again" / names[0])) == ["page 0", "page 1", "page 2"]


def test_text_records_to_documents_and_near_copies(spark, tmp_path):
    r = random.Random(2)
    base = " ".join("".join(r.choices("abcdef", k=5)) for _ in range(60))
    texts = [base, base + " more", "another text of its own entirely with several words here", "  ", base]
    (tmp_path / "in.txt").write_text("\n\n\n".join(texts), encoding="utf-8")
    jobs.documents(spark, [str(tmp_path / "in.txt")] * 2, str(tmp_path / "docs"))
    assert spark.read.parquet(str(tmp_path / "docs")).count() == 4
    out = str(tmp_path / "near")
    jobs.minhash_dedup(spark, [str(tmp_path / "in.txt")], out, b=2, r=10)
    read = lambda name: sorted(r["value"] for r in spark.read.option("lineSep", "\n\n\n").text(f"{out}/{name}").collect())
    assert read("dedup") == sorted([base, texts[2]]) and read("dup") == sorted([base, base + " more"])
    before = os.path.getmtime(f"{out}/cc/_SUCCESS")
    jobs.minhash_dedup(spark, [str(tmp_path / "in.txt")], out, b=2, r=10)  # stages that are there aren't made again
    assert os.path.getmtime(f"{out}/cc/_SUCCESS") == before and files.exists(spark, f"{out}/doc") and not files.exists(spark, f"{out}/none")
    jobs.clean(spark, [str(tmp_path / "in.txt")], str(tmp_path / "clean"), ["SplitIntoSentence", {"class": "FilterBySentenceLength", "maxSentLen": 100}])
    assert [r["value"] for r in spark.read.option("lineSep", "\n\n\n").text(str(tmp_path / "clean")).collect()] == [texts[2]]


def test_perplexities_and_sizes(spark, corpus, tmp_path):
    jobs.perplexities(spark, [corpus[0]], str(tmp_path / "p"))
    rows = [json.loads(line) for line in lines_of(tmp_path / "p", ".json")]
    assert len(rows) == 16 and all(r["score"] < 0 for r in rows)
    spark.createDataFrame([("s1", "null", "abc"), ("s1", "A", "äb"), ("s2", "A", "x")], "segment string, filter string, text string").write.parquet(str(tmp_path / "f"))
    jobs.removed_sizes(spark, [str(tmp_path / "f")], str(tmp_path / "sizes"))
    assert sorted(line.strip() for line in lines_of(tmp_path / "sizes", ".csv")) == ["s1,3,3", "s2,1,0"]


def test_sinks(spark, tmp_path):
    df = spark.range(10).select("id", F.lit('say "a", b').alias("t"))
    files.write(df.coalesce(1), str(tmp_path / "b"), most_records=3)
    assert sum(n.endswith(".parquet") for n in os.listdir(tmp_path / "b")) == 4
    files.write(df.coalesce(1), str(tmp_path / "c"), "csv")
    assert list(csv.reader(lines_of(tmp_path / "c", ".csv")))[3] == ["3", 'say "a", b']
    files.write(df.repartition(8), str(tmp_path / "d"), partitions=2)
    assert sum(n.endswith(".parquet") for n in os.listdir(tmp_path / "d")) == 2


def test_command_line(tmp_path):
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"partitions": 7, "form": "json", "output": "o"}))
    name, given = options(["dedup", "--inputs", "a", "b", "--partitions", "3", "--debug", "-P", "x=1", "--config", str(config)])
    assert name == "dedup" and given == {"inputs": ["a", "b"], "output": "o", "partitions": 3, "form": "json", "debug": True, "properties": {"x": "1"}}
    with pytest.raises(SystemExit):
        options(["merge-stats", "--inputs", "a"])
    assert options(["minhash", "--inputs", "a", "--output", "b", "--jaccard", "0.7"])[1]["jaccard"] == 0.7
