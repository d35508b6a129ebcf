"""Cases with known results: runs of frequent paragraphs, merged statistics, scores, lists, DOM paths, headings, sentences, tries, bits."""

import pytest
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import filters, paragraphs, reports

KIND = "array<struct<path:string,text:string,pos:int,exact_freq:int,near_freq:int,removed_by:string>>"


def docs(spark, *documents):
    """Documents of (path, text, near, exact, removed_by) paragraphs."""
    rows = [(str(k), [(p, t, i, e, n, r) for i, (p, t, n, e, r) in enumerate(d)], None) for k, d in enumerate(documents)]
    return spark.createDataFrame(rows, f"doc_id string, paragraphs {KIND}, removed_by string")


RUNS = """15 30 30 | x x x
15 30 30 5 | x x x .
15 30 5 5 | x x . .
15 5 5 5 | x . . .
5 15 15 15 | . x x x
5 5 15 15 | . . x x
5 5 5 15 | . . . x
5 5 15 5 5 | . . . . .
5 5 15 15 5 | . . . . .
5 15 15 15 5 | . x x x .
5 15 15 15 15 5 | . x x x x .
15 15 5 5 15 15 | x x . . x x
5 15 15 5 15 15 5 | . . . . . . .
1 20 1 20 20 20 1 | . x . x x x .""".splitlines()


def test_runs_of_frequent_paragraphs(spark):
    cases = [tuple(side.split() for side in line.split(" | ")) for line in RUNS]
    df = docs(spark, *([("", "text", int(f), 1, None) for f in freqs] for freqs, _ in cases))
    f = filters.LargeFreqParagraphs(3, 10)
    got = {r["doc_id"]: (r["paragraphs"], r["n"]) for r in f.apply(df.withColumn("n", f.metric())).collect()}
    for k, (_, marks) in enumerate(cases):
        assert [("x" if p["removed_by"] else ".") for p in got[str(k)][0]] == marks, RUNS[k]
        assert got[str(k)][1] == marks.count("x")


MERGES = {
    "no remap": ("1,1,1,2; 2,1,1,2; 3,3,1,1; 1,1,1,2; 4,1,1,2; 3,3,1,2; 5,3,1,2", "1,1,2,4; 2,1,1,4; 3,3,2,3; 4,1,1,4; 5,3,1,3"),
    "remap": ("1,1,1,2; 2,1,1,2; 3,3,1,1; 2,2,1,2; 4,2,1,2; 3,3,1,2; 5,3,1,2", "1,1,1,4; 2,1,2,4; 3,3,2,3; 4,1,1,4; 5,3,1,3"),
    "bridge": ("3,3,1,4; 4,3,1,4; 5,5,1,4; 6,5,1,4; 4,4,1,3; 5,4,1,3; 6,4,1,3", "3,3,1,7; 4,3,2,7; 5,3,2,7; 6,3,2,7"),
    "propagate": ("7,1,1,2; 8,2,1,2; 7,5,1,3; 8,5,1,3; 7,7,1,4; 8,8,1,4; 1,1,1,4; 2,2,1,4; 5,5,1,4; 6,6,1,1; 9,6,3,3", "1,1,1,9; 2,1,1,9; 5,1,1,9; 6,6,1,3; 7,1,3,9; 8,1,3,9; 9,6,3,3"),
    "three-way": ("1,1,1,2; 2,1,1,2; 2,2,1,2; 3,2,1,2; 3,3,1,2; 4,3,1,2", "1,1,1,4; 2,1,2,4; 3,1,2,4; 4,1,1,4"),
}


@pytest.mark.parametrize("name", MERGES)
def test_merges_of_statistics(spark, name):
    given, wanted = ([tuple(map(int, row.split(","))) for row in side.split("; ")] for side in MERGES[name])
    stats = spark.createDataFrame(given, "hash long, repr_hash long, exact_freq int, near_freq int")
    merged = paragraphs.merge_statistics(stats, 2 if name == "three-way" else 5)
    assert sorted(map(tuple, merged.collect())) == sorted(wanted)


def test_duplicate_scores(spark):
    df = docs(spark, *([("", "text", f, f, None) for f in freqs] for freqs in ([1] * 4, [1, 1, 99, 100], [100] * 4, [1, 1, 100, 100])))
    a, b, c, d = (r["s"] for r in df.select("doc_id", filters.DeduplicateDocuments(100).score().alias("s")).orderBy("doc_id").collect())
    assert (a, c, d) == (0.0, 1.0, 0.5) and b < 0.5


def test_lists_merge(spark):
    li = "body>ul>li.text"
    df = docs(
        spark,
        [(li, "test", 6, 4, None), (li, "test2", 9, 2, None), (li, "test3", 3, 3, None)],
        [(li, "a", 1, 1, None), ("body>ol>li.text", "b", 1, 1, None)],
        [(li, "a", 1, 1, "gone"), (li, "b", 1, 1, None), (li, "c", 1, 1, None)],
        [(li, "a", 1, 1, None), (li, "b", 1, 1, "gone"), (li, "c", 1, 1, None)],
    )
    got = [[(p["text"], p["near_freq"], p["exact_freq"]) for p in r["paragraphs"] if not p["removed_by"]] for r in filters.MergeListTag().apply(df).orderBy("doc_id").collect()]
    assert got[0] == [("- test\n- test2\n- test3", 3, 2)]
    assert [t for t, _, _ in got[1]] == ["a", "b"] and [t for t, _, _ in got[2]] == ["- b\n- c"] and [t for t, _, _ in got[3]] == ["a", "c"]


def test_paths_without_content(spark):
    kept = ["body>article>p"]
    gone = ["body>header>p", "body>nav>p", "body>noscript", "body>form", "body>div.header>p", "body>div#header-test>p", "body>div.breadcrumbs-test>p", "body>div#widget_wrapper>p", "body>div#testLogo>p", "body>div#headerTop>p"]
    df = docs(spark, [(p, "text", 1, 1, None) for p in [*kept, *gone]])
    found = filters.NoContentDOM().apply(df).first()["paragraphs"]
    assert [p["path"] for p in found if p["removed_by"] is None] == kept


def test_headings(spark):
    df = docs(spark, [(f"body>h{k}", "title", 1, 1, None) for k in range(1, 7)] + [("body>p", "title", 1, 1, None)])
    assert [p["text"] for p in filters.MarkdownizeHeading().apply(df).first()["paragraphs"]] == [*("#" * k + " title" for k in range(1, 7)), "title"]


def test_paths_and_lines(spark):
    df = spark.createDataFrame([("body>div.a.b#c>p.d",), ("body>h1",)], "p string")
    got = df.select(T.path_segments(F.col("p")).alias("s"), T.contains_tags(F.col("p"), ["p", "x"]).alias("c"), T.first_tag(F.col("p"), ["body", "div"]).alias("t")).collect()
    assert [tuple(s) for s in got[0]["s"]] == [("body", None, []), ("div", "c", ["a", "b"]), ("p", None, ["d"])]
    assert got[0]["c"] and not got[1]["c"] and got[0]["t"]["tag"] == "div" and got[1]["t"]["tag"] == "body"
    assert df.select(T.first_tag(F.col("p"), ["nav"]).alias("t")).first()["t"] is None
    assert spark.createDataFrame([("a\nb\\n",)], "t string").select(T.one_line(F.col("t")).alias("t")).first()["t"] == "a\\nb\\n"


def test_sentences(spark):
    df = spark.createDataFrame([("これは。テスト？です", ), ("one\ntwo", ), ("", )], "t string")
    assert [r["s"] for r in df.select(T.sentences(F.col("t"), "\n。？").alias("s")).collect()] == [["これは。", "テスト？", "です"], ["one\n", "two"], []]


def test_bits(spark):
    value = 0x0123456789ABCDEF
    df = spark.createDataFrame([(value, -1)], "a long, b long")
    turned = lambda k: ((value >> k) | (value << (64 - k))) & (2**64 - 1)
    got = df.select(*(T.rotate_right(F.col("a"), k).alias(f"r{k}") for k in (0, 5, 8, 9, 16, 23, 64)), T.rotate_right(T.rotate_right(T.rotate_right(F.col("a"), 30), 20), 14).alias("all"), T.matching_bits(F.col("a"), F.col("b")).alias("m"), T.ratio(F.lit(3), F.lit(0)).alias("z"), T.ratio(F.lit(3.0), F.lit(4.0)).alias("q")).first()
    assert [got[f"r{k}"] % 2**64 for k in (0, 5, 8, 9, 16, 23, 64)] == [turned(k % 64) for k in (0, 5, 8, 9, 16, 23, 64)] and got["all"] == value
    assert (got["m"], got["z"], got["q"]) == (value.bit_count(), 0.0, 0.75)


def test_repeated_substrings_are_the_longest_of_their_count(spark):
    texts = ["head one\nalpha line\nbeta line\ngamma line\ntail", "alpha line\nbeta line\ngamma line\nother end", "beta line\ngamma line", "unique text here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["passage"], r["n"], r["lines"]) for r in reports.repeated_substrings(df, 5).collect()}
    assert got == {("alpha line\nbeta line\ngamma line", 2, 3), ("beta line\ngamma line", 3, 2)}
    assert reports.repeated_substrings(df.where("doc_id = 3")).count() == 0
    same = spark.createDataFrame([(1, "a line here\na line here\na line here")], "doc_id long, text string")
    assert {(r["passage"], r["n"]) for r in reports.repeated_substrings(same).collect()} == {("a line here", 3), ("a line here\na line here", 2)}


def test_histograms_and_sketches(spark):
    df = spark.createDataFrame([("a", v) for v in (-1.0, 0.0, 0.24, 0.5, 0.99, 7.0, None)], "g string, v double")
    assert {(r["bin"], r["n"]) for r in reports.histogram(df, "v", 0.0, 1.0, 4, "g").collect()} == {(0.0, 3), (0.5, 1), (0.75, 2)}
    assert len(reports.frequency_sketch(df.where("v is not null").select(F.col("v").cast("string").alias("v")), "v").first()["sketch"]) > 100


def test_filters_from_configurations_of_other_engines(tmp_path):
    model = tmp_path / "m.json"
    model.write_text('{"order": 1, "counts": {"": 1, "a": 1}, "vocabulary": 1}')
    made = filters.make("KenLMDocAvgPerplexity", kenlm=str(model), dictionary="some.dic")
    assert made.model == str(model)
    with pytest.raises(ValueError, match="no parameter"):
        filters.make("DocLength", nothing=1)
    with pytest.raises(ValueError, match="no filter"):
        filters.make("Nothing")
