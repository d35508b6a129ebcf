"""WARC files: streaming, broken ends, HTTP heads, charsets, dates, and extraction to documents."""

import gzip
import io

import pytest

from quern.sources import html, warc


def record(content: bytes, kind="response", uri="http://example.com/", more=(), ident="<urn:uuid:12345678-1234-1234-1234-123456789abc>"):
    head = [f"WARC-Type: {kind}", f"WARC-Target-URI: {uri}", "WARC-Date: 2014-01-02T03:04:05Z", f"WARC-Record-ID: {ident}", "Content-Type: application/http; msgtype=response", *more, f"Content-Length: {len(content)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def http(body: bytes, *heads: str, status="200 OK"):
    return f"HTTP/1.1 {status}\r\n".encode() + "".join(f"{h}\r\n" for h in heads).encode() + b"\r\n" + body


def test_records_stream_through_small_reads():
    contents = [bytes([65 + k]) * (k * 37 + 1) for k in range(60)]
    for raw in (b"".join(record(c) for c in contents), warc.compress([record(c) for c in contents]), gzip.compress(b"".join(record(c) for c in contents))):
        for step in (7, 64, 1 << 18):
            data = warc._Inflated(io.BytesIO(raw), step)
            out = []
            while data.skip_to(b"WARC/"):
                head = data.until(b"\r\n\r\n", 1 << 20)
                size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
                out.append(data.take(size, True))
            assert out == contents
    assert [c for _, c, _ in warc.records(raw)] == contents


def test_large_records_are_skipped_and_broken_ends_end_the_file(monkeypatch):
    monkeypatch.setattr(warc, "LARGEST", 1000)
    members = [record(b"a" * 10), record(b"b" * 1001), record(b"c" * 1000), record(b"d" * 5)]
    assert [c[:1] for _, c, _ in warc.records(warc.compress(members))] == [b"a", b"c", b"d"]
    cut = warc.compress(members)[:-20]
    assert [c[:1] for _, c, _ in warc.records(cut)] == [b"a", b"c"]
    assert [c[:1] for _, c, _ in warc.records(warc.compress(members[:1]) + b"rubbish" * 100)] == [b"a"]
    assert list(warc.records(b"")) == [] and list(warc.records(b"no records here")) == []
    assert list(warc.records(record(b"x" * 50)[:-60])) == []


def test_http_heads():
    body = b"<html>"
    assert warc.parse_http(http(body, "Content-Type: text/html", "DATE: x")) == (200, {"content-type": "text/html", "date": "x"}, body)
    assert warc.parse_http(b"HTTP/1.0 404 Not Found\n\nbody") == (404, {}, b"body")
    assert warc.parse_http(b"no head") is None
    assert warc.parse_http(b"HTTP/1.1 200 OK\r\n" + b"x: " + b"y" * 5000 + b"\r\n\r\n") is None


@pytest.mark.parametrize(
    ("name", "text"),
    [
        ("utf-8", "日本語のページです。"), ("cp932", "これは日本語のページです。漢字とかなとカナ。"), ("euc_jp", "これは日本語のページです。漢字とかなとカナ。"), ("iso2022_jp", "これは日本語です"),
        ("euc_kr", "이것은 한국어 페이지입니다. 안녕하세요"), ("cp1251", "Это русская страница с обычным текстом"), ("gb18030", "这是一个中国的网页,我们在这里"), ("big5", "這是一個中國的網頁,我們在這裡"), ("cp1252", "déjà vu, élève, où, à la carte, façon"),
    ],
)
def test_charsets_are_detected(name, text):
    raw = text.encode(name)
    assert warc.decode(raw)[0] == text
    assert raw.decode(warc.detect(raw)) == text


def test_charset_cascade():
    text = "日本語のページ"
    page = f'<meta charset="x-sjis"><meta http-equiv="Content-Type" content="text/html; charset=Shift-JIS">{text}'
    assert warc.decode(page.encode("cp932"), "text/html; charset=utf-8")[1] == "cp932"
    assert warc.decode(text.encode("euc_jp"), "text/html; charset=EUC-JP; x")[0] == text
    assert warc.decode(f'<meta charset="ascii">{text}'.encode())[0].endswith(text)  # a wrong one falls through
    assert [warc.charset(n) for n in (' "UTF8";', "Shift_JIS,", "windows-31j", "nothing-like-it", None)] == ["utf-8", "cp932", "cp932", None, None]


def test_earliest_dates():
    assert warc.earliest("2014-01-02T03:04:05Z", "Sun, 26 May 2013 10:00:00 GMT", "Sat, 29 Dec 2012 16:50:56 GMT") == "2012-12-29T16:50:56"
    assert warc.earliest("2014-01-02T03:04:05Z", "Thu, 01 Jan 1970 00:00:00 GMT", "rubbish") == "2014-01-02T03:04:05"
    assert warc.earliest(None, None) == "" and warc.earliest("1998-12-31T23:59:59Z") == ""


def test_extraction_from_files(spark, tmp_path):
    page = "<html><body><p>First paragraph</p><div class='a b' id='c'>Second<br>line</div><script>no</script></body></html>"
    deep = "<html><body><p>Text</p>" + "<div>" * 300 + "x"
    one = [
        record(http(page.encode("cp932"), "Content-Type: text/html; charset=Shift_JIS", "Date: Sun, 26 May 2013 10:00:00 GMT"), uri="http://a/"),
        record(b"ask", kind="request"),
        record(http(b"gone", status="404 Not Found"), uri="http://b/"),
        record(http(page.encode()), more=["WARC-Truncated: length"]),
        record(http(deep.encode()), uri="http://deep/"),
    ]
    (tmp_path / "sub").mkdir()
    (tmp_path / "one.warc.gz").write_bytes(warc.compress(one))
    (tmp_path / "sub" / "two.warc").write_bytes(record(http(page.encode()), uri="http://c/", ident="none"))
    for rows in (warc.read(spark, str(tmp_path)), warc.read(spark, f"{tmp_path}/*.warc*"), warc.read(spark, f"file://{tmp_path}/one.warc.gz", through_spark=True)):
        assert rows.count() in (5, 6)
    rows = warc.read(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 2
    docs = warc.extract(rows).cache()
    got = {r["url"]: r for r in docs.collect()}
    assert {u: r["status"] for u, r in got.items()} == {"http://a/": "ok", "http://b/": "http 404", "http://deep/": "too deep", "http://c/": "ok"}
    a = got["http://a/"]
    assert (a["doc_id"], a["charset"], a["date"]) == ("12345678-1234-1234-1234-123456789abc", "cp932", "2013-05-26T10:00:00")
    assert a["text"] == got["http://c/"]["text"] and "Second\nline" in a["text"] and "no" not in a["text"]
    assert len(got["http://c/"]["doc_id"]) == 36
    assert {r["status"]: r["n"] for r in warc.histogram(docs).collect()} == {"ok": 2, "http 404": 1, "too deep": 1}
    assert warc.is_page(rows).count() == 6


def test_headers_by_name(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([("A", "1"), ("b", "2"), ("a", "3")],)], "h array<struct<name:string,value:string>>")
    row = df.select(*(F.coalesce(warc.header("h", n, w), F.lit("-")).alias(f"{n}{w}") for n, w in (("a", "first"), ("a", "last"), ("a", "only"), ("B", "only"), ("x", "last")))).first()
    assert list(row) == ["1", "3", "-", "2", "-"]


def test_too_deep_pages_give_nothing():
    assert html.paragraphs("<body><p>a</p>" + "<div>" * 300) == [] and html.read("<body><p>a</p>" + "<div>" * 300) is None
    assert html.paragraphs("<body><p>a</p></body>") == [("body>p", "a")]
