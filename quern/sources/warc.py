"""WARC files as a Spark data source, and what a response's bytes say: status, charset, language, dates, text."""

from __future__ import annotations

import email.utils
import fnmatch
import gzip
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quern.functions.text import PATH_MARK
from quern.sources import html as H

LARGEST = 16 << 20
HEAD = 4096
RECORD = "headers map<string,string>, content binary, path string"
_SHIFT_JIS = ("shift_jis", "shift-jis", "shiftjis", "sjis", "x-sjis", "ms_kanji", "windows-31j", "cp932")
_EARLIEST = "1999-01-01"
_FIRST_CENTURY = re.compile(r"(?<![+-])\b00\d\d\b")


class _Inflated:
    """Bytes of a stream, gunzipped member after member as they are asked for; a member that is cut off gives what it has."""

    def __init__(self, stream: BinaryIO, step: int = 1 << 18):
        self._in, self._step, self._held, self._raw, self._unzip, self._over = stream, step, b"", b"", None, False
        self._raw = stream.read(step)
        self._zipped = self._raw[:2] == b"\x1f\x8b"

    def _more(self) -> bool:
        """Whether there is more now; what is held grows by one step at most."""
        while not self._over:
            raw, self._raw = self._raw or self._in.read(self._step), b""
            if not raw:
                self._over = True
            elif not self._zipped:
                self._held += raw
                return True
            else:
                if self._unzip is None:
                    if raw[:2] != b"\x1f\x8b" and len(raw) > 1:
                        self._over = True  # what follows the last member isn't ours
                        break
                    self._unzip = zlib.decompressobj(31)
                try:
                    got = self._unzip.decompress(raw, 4 * self._step)
                except zlib.error:
                    self._over = True
                    break
                self._raw = self._unzip.unconsumed_tail or self._unzip.unused_data
                if self._unzip.eof:
                    self._unzip = None
                if got:
                    self._held += got
                    return True
        return False

    def until(self, mark: bytes, most: int) -> bytes | None:
        """All up to the mark, which goes; None if it doesn't come within `most` bytes."""
        at = 0
        while (found := self._held.find(mark, max(at - len(mark), 0))) < 0:
            at = len(self._held)
            if at > most or not self._more():
                return None
        out, self._held = self._held[:found], self._held[found + len(mark) :]
        return out

    def skip_to(self, mark: bytes) -> bool:
        """Drops all before the mark."""
        while (found := self._held.find(mark)) < 0:
            self._held = self._held[-len(mark) + 1 :]
            if not self._more():
                return False
        self._held = self._held[found:]
        return True

    def take(self, size: int, keep: bool) -> bytes | None:
        """The next bytes (empty if they aren't kept); None if there are fewer."""
        parts = []
        while size:
            if not self._held and not self._more():
                return None
            part, self._held = self._held[:size], self._held[size:]
            size -= len(part)
            if keep:
                parts.append(part)
        return b"".join(parts)


def stream_records(stream: BinaryIO, path: str = "") -> Iterator[tuple[dict[str, str], bytes, str]]:
    """Headers and content of each record, with one record in memory; records above LARGEST are skipped, a broken end ends the file."""
    data = _Inflated(stream)
    while data.skip_to(b"WARC/"):
        head = data.until(b"\r\n\r\n", 1 << 20)
        if head is None:
            return
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k.strip()}
        try:
            size = int(next((v for k, v in headers.items() if k.lower() == "content-length"), ""))
        except ValueError:
            return
        content = data.take(size, keep=size <= LARGEST)
        if content is None:
            return
        if size <= LARGEST:
            yield headers, content, path


def records(raw: bytes, path: str = "") -> Iterator[tuple[dict[str, str], bytes, str]]:
    """stream_records() of a file's bytes."""
    return stream_records(io.BytesIO(raw), path)


def _files(path: str) -> list[str]:
    """Files below a path, or those a pattern names, by pyarrow's file systems (local, hdfs, s3, gs)."""
    system, inner = _system(path)
    base = inner.split("*")[0].rsplit("/", 1)[0] if "*" in inner else inner
    info = system.get_file_info(base)
    if info.type == pa.fs.FileType.File:
        return [path]
    found = system.get_file_info(pa.fs.FileSelector(base, recursive=True))
    names = [f.path for f in found if f.type == pa.fs.FileType.File and not f.base_name.startswith((".", "_"))]
    if "*" in inner:
        names = [n for n in names if fnmatch.fnmatch(n, inner)]
    scheme = f"{path.split('://', 1)[0]}://" if "://" in path and not path.startswith("file:") else ""
    return sorted(scheme + n for n in names)


def _system(path: str):
    if "://" in path and not path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), os.path.abspath(re.sub(r"^file:(//)?", "", path))


def _batches(rows: Iterator[tuple], least: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about `least` bytes of content, or of one record that is larger."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(row[1])
        if size >= least:
            yield _batch(kept)
            kept, size = [], 0
    if kept:
        yield _batch(kept)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    headers, contents, paths = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array([list(h.items()) for h in headers], pa.map_(pa.string(), pa.string())), pa.array(contents, pa.binary()), pa.array(paths, pa.string())], ["headers", "content", "path"])


class WarcDataSource(DataSource):
    """spark.read.format("warc").load(path): headers, content, path of each record. A file is one partition and is read as a stream."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return _WarcReader(self.options.get("path", ""))


class _WarcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition(f) for f in _files(self.path)]

    def read(self, partition):
        if partition is None or partition.value is None:
            return
        system, inner = _system(partition.value)
        with system.open_input_stream(inner, compression=None) as stream:
            yield from _batches(stream_records(stream, partition.value))


def read(spark: SparkSession, path: str, through_spark: bool = False) -> DataFrame:
    """All records below a path: headers, content, path. A file is read by one task, since gzip can't be split.

    through_spark is for stores that only Spark's readers can open; a file is then held in memory and has 2 GiB at most.
    """
    if not through_spark:
        spark.dataSource.register(WarcDataSource)
        return spark.read.format("warc").load(path)

    def run(batches):
        for batch in batches:
            for p, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield from _batches(stream_records(pa.BufferReader(content.as_buffer()), p))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, RECORD)


def responses(rows: DataFrame) -> DataFrame:
    """Responses that aren't truncated."""
    cut = F.coalesce(F.col("headers")["WARC-Truncated"], F.lit(""))
    return rows.where((F.col("headers")["WARC-Type"] == "response") & (cut == ""))


def parse_http(content: bytes) -> tuple[int, dict[str, str], bytes] | None:
    """Status, headers (names lowered) and body; None without a head in the first HEAD bytes."""
    end, gap = content.find(b"\r\n\r\n", 0, HEAD), 4
    if end < 0:
        end, gap = content.find(b"\n\n", 0, HEAD), 2
    first = re.match(rb"HTTP/\d(?:\.\d)? +(\d{3})", content)
    if end < 0 or not first:
        return None
    lines = content[:end].decode("latin-1").splitlines()[1:]
    return int(first[1]), {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, content[end + gap :]


def charset(name: str | None) -> str | None:
    """Python's name of a charset; None if there is none of this name."""
    low = (name or "").strip(" \n\r\t;,\"'").lower()
    if low in ("utf8", "utf-8"):
        return "utf-8"
    if low in _SHIFT_JIS:
        return "cp932"
    try:
        return "".encode(low) is not None and low or None
    except LookupError:
        return None


def sniff(body: bytes) -> str | None:
    """The charset of the last meta tag in the first 10 KiB."""
    found = re.findall(rb"<meta[^>]*?charset\s*=\s*[\"']?([\w.:-]+)", body[:10240], re.IGNORECASE)
    return charset(found[-1].decode("ascii", "replace")) if found else None


#: Charsets that are tried, and what common letters of their languages look like, as ranges of code points.
_CANDIDATES = {
    "euc_kr": "\uac00-\ud7a3",
    "cp932": "\u3041-\u3093\u30a1-\u30f6\u4e00-\u9fff\u3001\u3002\u30fc", "euc_jp": "\u3041-\u3093\u30a1-\u30f6\u4e00-\u9fff\u3001\u3002\u30fc",
    "gb18030": "\u4e00-\u9fff\u3001\u3002\uff0c", "big5": "\u4e00-\u9fff\u3001\u3002\uff0c",
    "cp1251": "\u0430-\u044f\u0451", "koi8_r": "\u0430-\u044f\u0451", "cp1253": "\u03ac-\u03ce", "cp1252": "\u00e0-\u00ff\u2019\u201c\u201d", "cp1250": "\u0105\u0107\u0119\u0142\u0144\u015b\u017a\u017c\u010d\u0159\u0161\u017e\u011b\u016f\u00e0-\u00ff",
}
#: Letters so common that a text of the language has some, while other languages' bytes rarely give them.
_COMMON = {"cp932": "\u3041-\u3093\u30a1-\u30f6", "euc_jp": "\u3041-\u3093\u30a1-\u30f6", "gb18030": "的一是不了在人有我他这中大来上国", "big5": "的一是不了在人有我他這中大來上國"}
_ALPHABETS = frozenset(("cp1251", "koi8_r", "cp1253"))
_EXAMINED = 8192


def detect(body: bytes) -> str | None:
    """The charset of the first 8 KiB by byte order marks, escapes, valid UTF-8, then by what gives the most letters in common use; None for no idea."""
    head = body[:_EXAMINED]
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if head.startswith(mark):
            return name
    if re.search(rb"\x1b(?:\$[@B]|\([BJI])", head):
        return "iso2022_jp"
    if head.isascii():
        return "utf-8"
    try:
        head.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError as e:
        if len(body) > _EXAMINED and e.start >= len(head) - 3:  # a character cut off at the end
            return "utf-8"
    shown = re.sub(rb"<(?:script|style)\b.*?</(?:script|style)|<[^>]*>", b"", head, flags=re.IGNORECASE | re.DOTALL)
    latin = len(re.findall(rb"[A-Za-z]", shown))
    best, top = None, 0.0
    for name, letters in _CANDIDATES.items():
        text = shown.decode(name, "replace")
        high = [c for c in text if ord(c) > 127]
        if not high or (name in _ALPHABETS and len(high) < latin):  # a few letters among Latin ones are accented ones
            continue
        good = len(re.findall(f"[{letters}]", "".join(high)))
        score = (good - 4 * high.count("\ufffd")) / len(high)
        if name in _COMMON:
            score += min(0.3, 2 * len(re.findall(f"[{_COMMON[name]}]", text)) / len(high))
        if score > top + 1e-9:
            best, top = name, score
    return best if top >= 0.5 else None


def decode(body: bytes, content_type: str = "") -> tuple[str, str]:
    """Text and charset: of the page, of the HTTP head, then the detected one; a charset that doesn't fit falls through to the next."""
    head = re.search(r"charset=([^;]+)", content_type, re.IGNORECASE)
    for name in (sniff(body), charset(head[1]) if head else None, detect(body), "utf-8"):
        if name:
            try:
                return body.decode(name), name
            except (UnicodeDecodeError, LookupError):
                continue
    return body.decode("utf-8", "replace"), "utf-8"


def earliest(warc_date: str | None, *http_dates: str | None) -> str:
    """The earliest of the dates from 1999 on, as ISO local time; empty without one."""
    found = []
    for raw in http_dates:
        try:
            if _FIRST_CENTURY.search(raw):  # parsedate would take 0011 for 2011
                continue
            found.append(email.utils.parsedate_to_datetime(raw).astimezone(timezone.utc))
        except (TypeError, ValueError, AttributeError):
            pass
    try:
        found.append(datetime.fromisoformat((warc_date or "").replace("Z", "+00:00")).astimezone(timezone.utc))
    except ValueError:
        pass
    told = sorted(d.replace(tzinfo=None).isoformat(timespec="seconds") for d in found)  # strftime gives the year 202 three digits
    return next((d for d in told if d >= _EARLIEST), "")


@F.pandas_udf(T.StringType())
def earliest_date(warc_date: pd.Series, date: pd.Series, modified: pd.Series) -> pd.Series:
    """earliest() of columns."""
    return pd.Series([earliest(*row) for row in zip(warc_date, date, modified, strict=True)], dtype="object")


def record_id(header: str | None) -> str:
    """The UUID of `<urn:uuid:...>`, else a new one."""
    m = re.fullmatch(r"<urn:uuid:([0-9a-fA-F-]{36})>", header or "")
    return m[1] if m else str(uuid.uuid4())


_FIELDS = ("doc_id", "url", "language", "charset", "text", "date", "status")


def extract(rows: DataFrame, languages: list[str] | None = None, profiles: dict | None = None, least: int = 256) -> DataFrame:
    """Documents of responses: doc_id, url, language, charset, text (encoded paragraphs), date, status (ok, or why there is no text)."""
    from quern.functions.language import classify

    def one(headers, content):
        h = dict(headers or {})
        out = dict.fromkeys(_FIELDS, "") | {"doc_id": record_id(h.get("WARC-Record-ID")), "url": h.get("WARC-Target-URI", "")}
        parsed = parse_http(content or b"")
        if parsed is None:
            return out | {"status": "no http head"}
        status, head, body = parsed
        if status != 200:
            return out | {"status": f"http {status}"}
        text, out["charset"] = decode(body, head.get("content-type", ""))
        out["date"] = earliest(h.get("WARC-Date"), head.get("date"), head.get("last-modified"))
        found = H.read(text)
        if found is None:
            return out | {"status": "too deep"}
        out["language"] = classify(" ".join(t for _, t in found), profiles, least) if profiles else ""
        if languages and out["language"] not in languages:
            return out | {"status": "language"}
        out["text"] = "\n\n".join(f"{p}{PATH_MARK}{t}" for p, t in found)
        return out | {"status": "ok" if out["text"] else "empty"}

    def run(batches):
        for batch in batches:
            made = [one(h, c) for h, c in zip(batch.column("headers").to_pylist(), batch.column("content").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([m[f] for m in made], pa.string()) for f in _FIELDS], list(_FIELDS))

    return responses(rows).select("headers", "content").mapInArrow(run, ", ".join(f"{f} string" for f in _FIELDS))


def histogram(documents: DataFrame) -> DataFrame:
    """status, n: how many responses gave text, and why others didn't."""
    return documents.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def is_page(rows: DataFrame, http_type: Column | None = None) -> DataFrame:
    """Records whose own type is an HTTP response, and, if given, whose HTTP head's type is HTML."""
    kept = F.lower(F.coalesce(F.col("headers")["Content-Type"], F.lit(""))).startswith("application/http")
    return rows.where(kept if http_type is None else kept & F.lower(F.coalesce(http_type, F.lit(""))).startswith("text/html"))


def header(headers: str, name: str, which: str = "first") -> Column:
    """The first, last or only value of a header among an array of (name, value), whatever its case; null if there is none, or several and `only`."""
    found = F.filter(F.col(headers), lambda h: F.lower(h["name"]) == name.lower())
    value = {"first": F.get(found, F.lit(0)), "last": F.get(found, F.size(found) - 1), "only": F.when(F.size(found) == 1, F.get(found, F.lit(0)))}[which]
    return value["value"]


def compress(members: list[bytes]) -> bytes:
    """A gzip file with a member for each record."""
    return b"".join(gzip.compress(m, mtime=0) for m in members)
