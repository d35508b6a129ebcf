"""Reports over corpora: metrics of filters, overlaps of sources, sizes of what filters removed, repeated passages, token counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import filters
from quern.operators.durable import durable, release


def metric(name: str, arg: str | list[str] = "", arg2: str = "uniq") -> Column:
    """A metric of a document (`paragraphs`) by name."""
    made = {
        "compression": lambda: filters.CompressionRate(0, 0).metric(),
        "hiragana": lambda: filters.HiraganaRatio().metric(),
        "length": lambda: filters.DocLength().metric(),
        "links": lambda: filters.LinkCharRatio().metric(),
        "word-instance": lambda: filters.WordInstances(arg).score(),
        "word-type": lambda: filters.WordTypes(arg, kind=arg2).score(),
        "max-near-freq": lambda: F.array_max(F.transform(filters.alive(), lambda p: p["near_freq"])),
        "min-near-freq": lambda: F.array_min(F.transform(filters.alive(), lambda p: p["near_freq"])),
        "duplication-score": lambda: filters.DeduplicateDocuments(int(arg or 10)).score(),
        "length-weighted": lambda: filters.DuplicateDocumentsLengthWeighted().weight(),
        "large-freq-paragraphs": lambda: filters.LargeFreqParagraphs(freq=int(arg or 100)).metric(),
        "freq-percentile": lambda: filters.DeduplicateDocumentsPercentile(float(arg or 0.05)).frequency(),
    }
    if name not in made:
        raise ValueError(f"no metric {name!r}; there are {', '.join(sorted(made))}")
    return made[name]().cast("double")


def metric_table(docs: DataFrame, value: Column, examples: float = 0.001, limit: int | None = None, partitions: int = 10) -> DataFrame:
    """value and an example text for a share of the documents, sorted by value; `limit` is about how many documents are taken."""
    if limit:
        n = docs.count()
        docs = docs.sample(False, min(1.0, limit / n), 0xDEADBEEF) if n > limit else docs
    text = F.regexp_replace(F.array_join(F.transform("paragraphs", lambda p: p["text"]), "<p>"), "\n", "<br>")
    rows = docs.select("doc_id", value.alias("value"), F.when(T.unit_random(F.col("doc_id").cast("string")) < examples, text).otherwise(F.lit("")).alias("text"))
    return rows.repartitionByRange(partitions, "value", "doc_id").sortWithinPartitions("value", "doc_id")


def overlaps(rows: DataFrame, group: str, item: str) -> DataFrame:
    """For pairs of groups with common items: their number, and its shares of the union and of either group."""
    distinct = rows.select(F.col(group).alias("g"), F.col(item).alias("i")).distinct()
    sizes = distinct.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    shared = distinct.alias("a").join(distinct.alias("b"), "i").where("a.g < b.g").groupBy(F.col("a.g").alias("g1"), F.col("b.g").alias("g2")).agg(F.count(F.lit(1)).alias("n_both"))
    one = shared.join(sizes.select(F.col("g").alias("g1"), F.col("n").alias("n1")), "g1").join(sizes.select(F.col("g").alias("g2"), F.col("n").alias("n2")), "g2")
    return one.select("g1", "g2", "n_both", (F.col("n_both") / (F.col("n1") + F.col("n2") - F.col("n_both"))).alias("of_union"), (F.col("n_both") / F.col("n1")).alias("of_first"), (F.col("n_both") / F.col("n2")).alias("of_second"))


def sizes_by(rows: DataFrame, row: str, column: str, values: list[str], text: str = "text") -> DataFrame:
    """Bytes of text by row and column, as a table with a column for each value."""
    return rows.groupBy(row).pivot(column, values).agg(F.sum(F.octet_length(text))).na.fill(0)


def repeated_passages(docs: DataFrame, lines: int = 2, least_chars: int = 10, least: int = 2, doc_id: str = "doc_id") -> DataFrame:
    """Passages of `lines` whole lines that occur `least` times or more: passage, n."""
    parts = F.filter(F.split("text", "\n"), lambda x: x != "")
    found = docs.select(doc_id, parts.alias("_l")).where(F.size("_l") >= lines)
    grams = F.transform(F.sequence(F.lit(1), F.size("_l") - lines + 1), lambda i: F.array_join(F.slice("_l", i, lines), "\n"))
    rows = found.select(F.explode(grams).alias("passage")).where(F.length("passage") >= least_chars)
    return rows.groupBy("passage").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def repeated_substrings(docs: DataFrame, least_chars: int = 10, least: int = 2, most_lines: int | None = None, doc_id: str = "doc_id") -> DataFrame:
    """passage, n, lines: passages of whole lines of any number that occur `least` times or more, and no longer one does as often around them.

    Lengths grow by one line a round; a round only takes up the places whose passage repeated in the round before, and the last one ends all.
    What repeats is known by a hash; texts are put together at the end. most_lines bounds the rounds.
    """
    parts = F.filter(F.split("text", "\n"), lambda x: x != "")
    lines = durable(docs.select(F.xxhash64(doc_id, "text").alias("d"), parts.alias("_l")).select("d", F.posexplode("_l").alias("k", "line")).select("d", "k", "line", F.xxhash64("line").alias("h")).distinct())
    line = lines.select("d", F.col("k").alias("_k"), F.col("h").alias("_h"))
    now, n, rounds = lines.select("d", "k", F.col("h").alias("g")), 1, []
    while True:
        counts = now.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
        places = durable(now.join(counts, "g").select("d", "k", "g", "n", F.lit(n).alias("lines")))
        if places.isEmpty():
            release(places)
            break
        rounds.append(places)
        if n == most_lines:
            break
        n += 1
        now = places.select("d", "k", "g", (F.col("k") + n - 1).alias("_k")).join(line, ["d", "_k"]).select("d", "k", F.xxhash64("g", "_h").alias("g"))
    if not rounds:
        return lines.select(F.col("line").alias("passage"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("lines")).limit(0)
    every = rounds[0]
    for more in rounds[1:]:
        every = every.union(more)
    # a passage is part of a longer one with the same count that begins with it, or ends with it
    longer = every.select("d", "k", (F.col("lines") - 1).alias("lines"), F.col("n")).union(every.select("d", (F.col("k") + 1).alias("k"), (F.col("lines") - 1).alias("lines"), "n"))
    inner = every.join(longer, ["d", "k", "lines", "n"], "left_semi").select("g", "lines").distinct()
    one = every.join(inner, ["g", "lines"], "left_anti").groupBy("g", "lines").agg(F.first("n").alias("n"), F.min(F.struct("d", "k")).alias("at"))
    spelled = one.select("g", "lines", "n", "at.d", F.explode(F.sequence(F.col("at.k"), F.col("at.k") + F.col("lines") - 1)).alias("k")).join(lines, ["d", "k"])
    told = spelled.groupBy("g", "lines", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n").alias("passage"))
    return told.where(F.length("passage") >= least_chars).select("passage", "n", "lines")


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int, by: str | None = None) -> DataFrame:
    """bin (its lower end), n, by group if given: counts of values from low to high; values outside are in the end bins, nulls in none."""
    width = (high - low) / bins
    k = F.least(F.greatest(F.floor((F.col(value) - low) / width), F.lit(0)), F.lit(bins - 1))
    return rows.where(F.col(value).isNotNull()).groupBy(*([by] if by else []), (low + k * width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def frequency_sketch(rows: DataFrame, column: str, eps: float = 0.001, confidence: float = 0.99, seed: int = 1) -> DataFrame:
    """One row with a mergeable count-min sketch of a column's values."""
    return rows.agg(F.count_min_sketch(F.col(column), F.lit(eps), F.lit(confidence), F.lit(seed)).alias("sketch"))


def token_counts(docs: DataFrame, tokens: Column) -> DataFrame:
    """Tokens and bytes of all texts."""
    return docs.select(F.sum(tokens).cast("long").alias("tokens"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))
