"""Queries that read their paragraphs several times clean the documents once."""

import pytest

from quern.plans import catalog


@pytest.mark.parametrize("name", ["stats_join_bias"])
def test_documents_are_cleaned_once(spark, sf_dir, name):
    files = catalog.queries()[name](spark, sf_dir).inputFiles()
    assert files and not any("documents.parquet" in f for f in files)


def test_a_documents_marker_is_made_once_not_for_each_paragraph(spark):
    from pyspark.sql import functions as F

    from quern.operators import paragraphs

    docs = paragraphs.parse(spark.createDataFrame([(1, "a\nb"), (2, "needle\nb")], "doc_id long, text string"), "\n")
    marked = docs.withColumn("removed_by", F.when(F.size(F.filter("paragraphs", lambda p: p["text"] == "needle")) > 0, F.lit("gone")))
    done = paragraphs.render(marked, "\n", debug=True).select("doc_id", "text", "filter")
    assert "transform(array(CASE WHEN" in done._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, done.collect())) == [(1, "a\nb", "null"), (2, "needle\nb", "gone")]
