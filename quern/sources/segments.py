"""Plain segments of HTML pages by older rules, which differ in what separates segments and what isn't read.

`blocks` trims lines and separates at block tags; `boilerplate` also separates at list items, cells and two `br` in a row, and leaves out headers
and choices; `lines` breaks lines at tags and drops control characters, and line breaks outside of preformatted text.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Rule(NamedTuple):
    """Tags whose text isn't read; tags that separate; those in which line breaks stay where they go elsewhere; whether two `br` separate."""

    unread: frozenset[str]
    separating: frozenset[str]
    preformatted: frozenset[str] | None = None
    two_breaks: bool = False


#: The tags of each rule.
RULES = {
    "blocks": Rule(
        frozenset("style script".split()),
        frozenset(
            "address article aside blockquote caption dialog dir div dl fieldset figure footer form frame h1 h2 h3 h4 h5 h6 header hr legend main nav noframes noscript ol "
            "optgroup option p pre section table textarea title ul xmp".split()
        ),
    ),
    "boilerplate": Rule(
        frozenset("header style script select".split()),
        frozenset(
            "blockquote caption center col colgroup dd div dl dt fieldset form h1 h2 h3 h4 h5 h6 legend li optgroup option p pre table td textarea tfoot th thead tr ul".split()
        ),
        two_breaks=True,
    ),
    "lines": Rule(
        frozenset("script style".split()),
        frozenset(
            "address article aside blockquote br caption center dd dialog dir div dl dt fieldset figure footer form frame h1 h2 h3 h4 h5 h6 header hr isindex legenda li menu "
            "multicol nav noframes noscript ol p pre section table tbody td textarea tfoot th thead title tr ul xmp".split()
        ),
        preformatted=frozenset("xmp plaintext pre listing textarea".split()),
    ),
}
_CONTROL = re.compile("[\x00-\x1f\x7f-\x9f]")
_BUT_BREAKS = re.compile("[\x00-\x09\x0b\x0c\x0e-\x1f\x7f-\x9f]")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr frame isindex".split())


class _Segmenter(HTMLParser):
    def __init__(self, rule: Rule):
        super().__init__(convert_charrefs=True)
        self.rule, self.parts, self.now, self.depth, self.breaks = rule, [], [], Counter(), 0

    def cut(self) -> None:
        self.parts.append("".join(self.now))
        self.now = []

    def handle_starttag(self, tag, attrs):
        self.breaks = self.breaks + 1 if tag == "br" else 0
        if tag in self.rule.separating or (self.rule.two_breaks and self.breaks == 2):
            self.cut()
        if tag not in _VOID:
            self.depth[tag] += 1

    def handle_endtag(self, tag):
        if tag != "br":
            self.breaks = 0
        self.depth[tag] = max(self.depth[tag] - 1, 0)
        if tag in self.rule.separating:
            self.cut()

    def handle_data(self, data):
        inside = lambda tags: any(self.depth[t] for t in tags)
        if inside(self.rule.unread):
            return
        if self.rule.preformatted is not None:
            data = (_BUT_BREAKS if inside(self.rule.preformatted) else _CONTROL).sub("", data)
        self.now.append(data)


def segments(page: str, how: str = "blocks") -> list[str]:
    """The segments of a page that have text; lines are trimmed, empty ones go."""
    reader = _Segmenter(RULES[how])
    reader.feed(page)
    reader.close()
    reader.cut()
    trimmed = ("\n".join(filter(None, (line.strip() for line in part.split("\n")))) for part in reader.parts)
    return [t for t in trimmed if t]


def segmented(page: str, how: str = "blocks") -> Column:
    """array<string> of a column's pages; null for null."""
    if how not in RULES:
        raise ValueError(f"no rule {how!r}; there are {', '.join(RULES)}")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def one(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else segments(p, how))

    return one(F.col(page))
