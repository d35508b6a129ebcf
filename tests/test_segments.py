"""Older rules for segments of pages."""

import pytest

from quern.sources.segments import segmented, segments

PAGE = """<html><head><title>Top</title><style>x</style></head><body><header>head <p>in</p></header>
<div>one
  two</div><ul><li>a</li><li>b</li></ul>x<br>y<br><br>z<select><option>c</option></select><pre>k
l</pre><script>no</script>end\x07</body></html>"""


def test_rules():
    assert segments(PAGE) == ["Top", "head", "in", "one\ntwo", "ab", "xyz", "c", "k\nl", "end\x07"]
    assert segments(PAGE, "boilerplate") == ["Top", "one\ntwo", "a", "b", "xy", "z", "k\nl", "end\x07"]
    assert segments(PAGE, "lines") == ["Top", "head", "in", "one  two", "a", "b", "x", "y", "zc", "k\nl", "end"]
    assert segments("") == [] and segments("   ", "lines") == []


def test_columns(spark):
    df = spark.createDataFrame([("<p>a</p>b",), (None,)], "p string")
    assert [r["s"] for r in df.select(segmented("p").alias("s")).collect()] == [["a", "b"], None]
    with pytest.raises(ValueError, match="no rule"):
        segmented("p", "other")
