"""Jobs as functions of a session and arguments; `python -m quern.jobs NAME --help` runs them from a command line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import cleaning, minhash, paragraphs, reports
from quern.operators import simhash as sim
from quern.operators.components import connected
from quern.operators.durable import durable
from quern.plans.pipeline import Pipeline
from quern.sources import files, warc

#: Stages of dedup(), in order; those named save* end the job.
DEDUP_STAGES = ("reprHashes", "saveReprHashes", "stats", "saveStats", "saveReassembled", "filter", "filter-debug")


def extract(spark: SparkSession, inputs: list[str], output: str, languages: list[str] | None = None, max_partitions: int = 2000, compression: str = "zstd", profiles: str | None = None) -> DataFrame:
    """WARC files to documents, a folder for each language; returns how many responses gave text, and why others didn't.

    profiles: a table of texts with their language (text, lang) that language profiles are trained from; without it no language is told.
    """
    from quern.functions import language

    rows = None
    for path in inputs:
        one = warc.read(spark, path)
        rows = one if rows is None else rows.unionByName(one)
    known = language.profiles(spark.read.parquet(profiles)) if profiles else None
    made = warc.extract(rows, languages, known)
    every = files.kept(spark, f"{output.rstrip('/')}-status", lambda: made.withColumn("language", F.when(F.col("language") == "", "unknown").otherwise(F.col("language"))))
    files.write(every.where("status = 'ok'").drop("status"), output, compression=compression, partition_by=["language"], partitions=max_partitions)
    return warc.histogram(every)


def _rows(raw: DataFrame, sep: str) -> DataFrame:
    return paragraphs.explode(raw.select("doc_id", "text"), sep)


def repr_hashes(raw: DataFrame, shifts: int = 5, sep: str = T.SEPARATOR, window: int = 2000) -> DataFrame:
    """hash, repr_hash, freq, text, sig of the distinct paragraphs of documents (doc_id, text)."""
    rows = sim.prepare(paragraphs.frequencies(_rows(raw, sep)).where(T.has_content(F.col("text"))))
    return sim.sliding(rows, shifts, window)


def debug_statistics(stats: DataFrame, prepared: DataFrame, partitions: int = 100, keep_ones: bool = False) -> DataFrame:
    """Statistics with texts and signatures, largest groups first; texts on one line."""
    told = stats if keep_ones else stats.where("near_freq > 1")
    data = prepared.select("hash", "text", F.col("freq").alias("raw_freq"), F.concat(*(F.lpad(F.hex(f"sig.{c}"), 16, "0") for c in ("high", "low"))).alias("signature"))
    joined = told.join(data, "hash").withColumn("text", T.one_line(F.col("text")))
    order = [F.desc("near_freq"), F.asc("repr_hash"), F.desc("exact_freq"), F.asc("hash")]
    return joined.repartitionByRange(partitions, *order[:2]).sortWithinPartitions(*order)


def reassembled(raw: DataFrame, stats: DataFrame, sep: str = T.SEPARATOR) -> DataFrame:
    """Documents (doc_id, paragraphs, removed_by) whose paragraphs have their frequencies; the other columns of raw pass through."""
    rest = [c for c in raw.columns if c not in ("doc_id", "text")]
    rows = paragraphs.explode(raw, sep)
    return paragraphs.assemble(paragraphs.join_statistics(rows, stats, F.xxhash64("text")), keep=rest)


def dedup(
    spark: SparkSession, inputs: list[str], output: str, stages: list[str] | None = None, cache: str | None = None, num_shifts: int = 5, filters_from: str = "all_duplicate_paragraphs.conf",
    properties: dict[str, str] | None = None, partitions: int = 100, form: str = "parquet", compression: str = "zstd", debug: bool = False, intermediate: bool = False, text_only: bool = False,
    sep: str = T.SEPARATOR, window: int = 2000,
) -> None:
    """Paragraphs counted, near copies grouped, documents filtered. stages: some of DEDUP_STAGES; what they don't make is read from cache.

    saveReprHashes, saveStats and saveReassembled write what they name and end the job. debug writes groups of several as sorted JSON, and
    statistics with their texts as CSV. intermediate keeps statistics of paragraphs that occur once. filter-debug writes a
    folder for each filter with what it removed.
    """
    stages = list(stages or ("reprHashes", "stats", "filter"))
    if unknown := set(stages) - set(DEDUP_STAGES):
        raise ValueError(f"no stages {sorted(unknown)}; there are {', '.join(DEDUP_STAGES)}")
    raw = spark.read.parquet(*inputs)

    def put(df: DataFrame) -> None:
        if debug:
            files.write(df.where("hash != repr_hash").repartitionByRange(partitions, "repr_hash", "hash").sortWithinPartitions("repr_hash", "hash"), output, "json")
        else:
            files.write(df, output, partitions=partitions)

    made = repr_hashes(raw, num_shifts, sep, window) if "reprHashes" in stages else None
    if "saveReprHashes" in stages:
        return put(made if made is not None else spark.read.parquet(cache))
    if "stats" in stages:
        rows = made if made is not None else spark.read.parquet(cache)
        stats = paragraphs.statistics(rows.select("hash", "repr_hash", "freq"), no_ones=not ("saveStats" in stages and intermediate))
    else:
        stats = spark.read.parquet(cache)
    if "saveStats" in stages:
        if debug:
            prepared = sim.prepare(paragraphs.frequencies(_rows(raw, sep)).where(T.has_content(F.col("text"))))
            return files.write(debug_statistics(stats, prepared, partitions, intermediate), output, "csv")
        return files.write(stats, output, partitions=partitions)
    docs = reassembled(raw, stats, sep)
    if "saveReassembled" in stages:
        return files.write(docs.select("*", F.posexplode("paragraphs").alias("_at", "p")).select(*(c for c in docs.columns if c not in ("paragraphs", "removed_by")), "p.*").repartition(partitions, "doc_id").sortWithinPartitions("doc_id", "pos"), output, "json")
    shown = paragraphs.render(Pipeline.of(filters_from, properties)(docs), sep, text_only, debug="filter-debug" in stages)
    if "filter-debug" in stages:
        return files.write(shown, output, form, compression, ["filter"], partitions=partitions)
    return files.write(shown.drop("filter"), output, form, compression, partitions=partitions)


def merge_stats(spark: SparkSession, inputs: list[str], output: str, partitions: int = 500, no_ones: bool = False, remaps: int = 5, exact: bool = False) -> None:
    """Statistics of several corpora as one table, sorted by their groups."""
    merged = paragraphs.merge_statistics(spark.read.parquet(*inputs), remaps, no_ones, exact)
    files.write(merged.repartitionByRange(partitions, "repr_hash", "hash").sortWithinPartitions("repr_hash", "hash"), output)


def filter_stats(spark: SparkSession, inputs: list[str], output: str, name: str, arg: str = "", arg2: str = "uniq", limit: int | None = None, partitions: int = 10, examples: float = 0.001, stats: str | None = None, sep: str = T.SEPARATOR) -> None:
    """A filter's metric of each document, sorted, with some texts, as CSV; stats: a table of paragraph statistics that the metric is of."""
    raw = spark.read.parquet(*inputs).select("doc_id", "text")
    docs = reassembled(raw, spark.read.parquet(stats), sep) if stats else paragraphs.parse(raw, sep)
    files.write(reports.metric_table(docs, reports.metric(name, arg, arg2), examples, limit, partitions), output, "csv")


def perplexities(spark: SparkSession, inputs: list[str], output: str, model: str | None = None, sep: str = T.SEPARATOR) -> None:
    """Distinct paragraphs with their mean log probabilities, least likely first, as JSON; model: a saved one, else all n-grams of the input."""
    from quern.functions import lm

    raw = spark.read.parquet(*inputs).select("doc_id", "text")
    rows = paragraphs.explode(raw, sep).select("text").where(T.has_content(F.col("text")))
    files.write(lm.score_distinct(rows, "text", lm.load(model)) if model else lm.score_by_table(rows, "text", durable(lm.counted(raw, "text"))), output, "json")


def repackage(spark: SparkSession, inputs: list[str], output: str, form: str = "parquet", compression: str = "zstd", max_partitions: int = 10000, clear: bool = False, sep: str = T.SEPARATOR) -> None:
    """Documents in another format and number of files; clear: paragraphs as clean text, without paths and marks."""
    docs = spark.read.parquet(*inputs)
    if clear:
        docs = docs.withColumn("text", F.array_join(T.split_clean(F.col("text"), sep), sep))
    files.write(docs, output, form, compression, partitions=max_partitions)


def clean(spark: SparkSession, inputs: list[str], output: str, stages: list | str = "chitra", input_format: str = "text", output_format: str = "text", delimiter: str = "\n\n\n", column: str = "text", element_delimiter: str = "\n") -> None:
    """Cleaning steps over records of texts or a table's column."""
    docs = files.read_texts(spark, inputs, delimiter, column) if input_format == "text" else spark.read.format(input_format).load(inputs)
    docs = files.with_ids(docs) if "doc_id" not in docs.columns else docs
    done = cleaning.joined(cleaning.pipeline(stages)(cleaning.elements(docs.select("doc_id", F.col(column).alias("text")))), element_delimiter)
    if output_format == "text":
        return files.write(done.select("text"), output, "text", line_sep=delimiter)
    return files.write(done.withColumnRenamed("text", column), output, output_format)


def documents(spark: SparkSession, inputs: list[str], output: str, delimiter: str = "\n\n\n") -> None:
    """Records of text files as a table of documents with ids."""
    files.write(files.with_ids(files.read_texts(spark, inputs, delimiter)), output)


def minhash_dedup(
    spark: SparkSession, inputs: list[str], output: str, ngram: int = 5, b: int = 15, r: int = 150, jaccard: float = 0.8, editsim: float | None = 0.8, delimiter: str = "\n\n\n",
) -> None:
    """Near copies of documents: output/doc, prep, minhash, jaccard, editsim, cc, then dedup and dup. A stage that has been finished is not made again.

    b values to a band, r bands. editsim None leaves out the check of edit similarity.
    """
    at = lambda name: f"{output.rstrip('/')}/{name}"
    docs = files.kept(spark, at("doc"), lambda: files.with_ids(files.read_texts(spark, inputs, delimiter)))
    prep = files.kept(spark, at("prep"), lambda: minhash.features(docs, ngram).select("doc_id", "tokens", "grams"))
    apart, same = minhash.classes(prep)
    pairs = files.kept(spark, at("minhash"), lambda: minhash.candidates(minhash.bands(apart, r, b)), most_records=10_000_000)
    links = files.kept(spark, at("jaccard"), lambda: minhash.verified(pairs, prep, jaccard))
    if editsim is not None:
        alike = links
        links = files.kept(spark, at("editsim"), lambda: minhash.edit_verified(alike, prep, editsim))
    cc = files.kept(spark, at("cc"), lambda: connected(links.select("id1", "id2").union(same), "id1", "id2"))
    named = docs.join(cc.select(F.col("node").alias("doc_id"), F.col("component").alias("cc")), "doc_id", "left")
    stays: Column = F.col("cc").isNull() | (F.col("cc") == F.col("doc_id"))
    files.write(named.where(stays).select("text"), at("dedup"), "text", line_sep=delimiter)
    files.write(named.where(~stays).orderBy("cc", "doc_id").select("text"), at("dup"), "text", line_sep=delimiter)


def removed_sizes(spark: SparkSession, inputs: list[str], output: str, row: str = "segment", column: str = "filter") -> None:
    """Bytes of text by row and by filter, from tables that have both columns, as CSV."""
    rows = spark.read.parquet(*inputs)
    values = sorted(r[0] for r in rows.select(F.col(column).cast("string")).distinct().collect())  # filters of a configuration
    files.write(reports.sizes_by(rows, row, column, values).coalesce(1), output, "csv")


