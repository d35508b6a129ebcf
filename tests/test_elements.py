"""Queries of cleaning steps on odd texts, against their SQL; what they cost."""

import duckdb
import pytest

from quern.operators import cleaning
from quern.plans import catalog


def test_a_run_is_found_with_each_text_split_once(spark):
    text = "\n".join(w for k in range(400) for w in (f"line {k}",) * (k % 3 + 1)) + "\n\n\n"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    done = cleaning.pipeline(["SplitIntoSentence", "DeduplicateRepeatingSentence"])(cleaning.elements(docs))
    assert done._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert done.first()["elements"] == [f"line {k}" for k in range(400)]


@pytest.mark.parametrize("name", ["sentence_split", "concat_short", "dedup_element_global", "remove_email", "remove_url", "repeat_sentence_collapse"])
def test_empty_texts_have_no_elements_as_in_sql(spark, tmp_path, name):
    rows = [(1, ""), (2, "\n\n"), (3, None), (4, "\n\na\n\n"), (5, "a\nabc\n\nx@y.zz\nhttp://a.b\nab\nab\nlonger than five\n"), (6, ""), (7, " ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = catalog.queries()[name](spark, str(tmp_path)).select("doc_id", "pos", "text").collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(f"SELECT doc_id, pos, text FROM ({catalog.oracle_sql()[name]})").fetchall())
