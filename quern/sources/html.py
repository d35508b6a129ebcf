"""Paragraphs of HTML pages with their DOM paths."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import LINK_END, LINK_START

_BLOCKS = frozenset(
    "address article aside blockquote caption center dialog dir div dl fieldset figure footer form frame header hr h1 h2 h3 h4 h5 h6 legend main nav noframes "
    "noscript ol optgroup option p pre section table textarea title ul xmp".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr frame".split())
_UNREAD = frozenset(("script", "style"))
#: A start tag of the key closes open tags of the value first.
_CLOSES = {t: ("p",) for t in _BLOCKS - {"option", "optgroup", "legend", "caption"}} | {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BARRIERS = frozenset("body div table ul ol dl section article td th form".split())
DEEPEST = 256
#: Pages whose paragraphs are held as Python values at a time.
AT_ONCE = 64
_SPACE = re.compile("[\x00-\x01\x04-\x20\xa0]+")
_CONTENT = re.compile("[^\x00-\x20　]")
_EMPTY_LINK = re.compile(f"{LINK_START}[ \\n]*{LINK_END}")


class TooDeep(ValueError):
    pass


def clean(text: str, keep_links: bool = False) -> str:
    """Lines with content, white space collapsed; marks of links go unless kept."""
    if keep_links:
        text = _EMPTY_LINK.sub("", text)
    else:
        text = text.replace(LINK_START, "").replace(LINK_END, "")
    lines = (_SPACE.sub(" ", line).strip() for line in text.split("\n"))
    return "\n".join(line for line in lines if _CONTENT.search(line.replace(LINK_START, "").replace(LINK_END, "")))


def segment(tag: str, attributes: list[tuple[str, str | None]]) -> str:
    named = dict(attributes)
    classes = "".join(f".{c}" for c in (named.get("class") or "").split())
    return tag + classes + (f"#{named['id']}" if named.get("id") else "")


class _Reader(HTMLParser):
    """Splits at block tags. Text before a block's start has the path of the block that began last, even where that one has ended."""

    def __init__(self, keep_links: bool):
        super().__init__(convert_charrefs=True)
        self.keep_links, self.out = keep_links, []
        self.open: list[tuple[str, str]] = []
        self.last, self.text, self.unread, self.body = "", [], 0, False

    def flush(self, path: str) -> None:
        body = clean("".join(self.text), self.keep_links)
        if body and _CONTENT.search(body):
            self.out.append((path, body))
        self.text = []

    def path(self) -> str:
        return ">".join(s for _, s in self.open)

    def handle_starttag(self, tag, attrs):
        if tag == "html" or (tag == "body" and self.body):
            return
        if tag == "body":
            self.text, self.body = [], True
            self.open = []
        for closed in _CLOSES.get(tag, ()):
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == closed:
                    self.handle_endtag(closed)
                    break
                if self.open[k][0] in _BARRIERS:
                    break
        if tag in _UNREAD:
            self.unread += 1
        if tag == "br":
            self.text.append("\n")
        if tag == "a":
            self.text.append(LINK_START)
        if tag in _BLOCKS:
            self.flush(self.last)
        if tag not in _VOID:
            self.open.append((tag, segment(tag, attrs)))
            if len(self.open) > DEEPEST:
                raise TooDeep
        if tag in _BLOCKS or tag == "body":
            self.last = self.path() if tag not in _VOID else ">".join(filter(None, [self.path(), segment(tag, attrs)]))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.open):
            return
        while self.open:
            top = self.open[-1][0]
            if top in _UNREAD:
                self.unread -= 1
            if top == "a":
                self.text.append(LINK_END)
            if top in _BLOCKS:
                self.flush(self.path())
            self.open.pop()
            if top == tag:
                break

    def handle_data(self, data):
        if not self.unread:
            self.text.append(data)


def paragraphs(html: str, keep_links: bool = False) -> list[tuple[str, str]]:
    """(path, text) of each paragraph; none of a document that gets too deep."""
    return read(html, keep_links) or []


def read(html: str, keep_links: bool = False) -> list[tuple[str, str]] | None:
    """(path, text) of each paragraph; None for a document that gets too deep, which has failed as a whole."""
    reader = _Reader(keep_links)
    try:
        reader.feed(html)
        reader.close()
        reader.flush("")
    except TooDeep:
        return None
    return reader.out


def extract(pages: DataFrame, column: str = "html", keep_links: bool = False) -> DataFrame:
    """pages with `paragraphs array<struct<path, text>>` in place of the column."""
    kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
    schema = pages.withColumn("paragraphs", F.lit(None).cast("array<struct<path:string,text:string>>")).drop(column).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rest = [n for n in whole.schema.names if n != column]
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                found = [[{"path": p, "text": t} for p, t in paragraphs(h or "", keep_links)] for h in batch.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(found, kind)], [*rest, "paragraphs"])

    return pages.mapInArrow(run, schema)
