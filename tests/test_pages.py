"""Pages are read a few at a time."""

import pyarrow as pa

from quern.sources import html


def test_a_batch_of_pages_is_given_on_in_parts(spark, monkeypatch):
    pages = spark.createDataFrame([(k, f"<p>a {k}</p><p>b</p>") for k in range(300)], "page_id long, html string").coalesce(1)
    sizes = []
    monkeypatch.setattr(type(pages), "mapInArrow", lambda df, run, schema: sizes.extend(b.num_rows for b in run(iter([pa.RecordBatch.from_pylist([r.asDict() for r in df.collect()])]))))
    html.extract(pages)
    assert sum(sizes) == 300 and max(sizes) <= html.AT_ONCE
