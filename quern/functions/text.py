"""Column functions on encoded texts: splitting, cleaning, links, paths, sentences, bits. No UDFs.

An encoded text is a document whose paragraphs are joined by a separator; a paragraph may begin with its DOM path and PATH_MARK,
and holds link text between LINK_START and LINK_END.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_MARK, LINK_START, LINK_END = "\x1c", "\x02", "\x03"
SEPARATOR = "\n\n"
_STRIP = r"^\p{javaWhitespace}+|\p{javaWhitespace}+$"


def literal(s: str) -> str:
    """A regular expression for the string itself."""
    return re.sub(r"([^\w\s])", r"\\\1", s, flags=re.ASCII)


def split_all(text: Column, sep: str = SEPARATOR) -> Column:
    """All parts, empty ones included."""
    return F.split(text, literal(sep))


def has_content(text: Column) -> Column:
    """Anything but control characters, spaces and ideographic spaces."""
    return text.rlike(r"[^\x00-\x20　]")


def clean_paragraph(text: Column) -> Column:
    """Lines with content, white space collapsed and stripped, joined by a line break. Link marks stay."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, r"[\x00-\x01\x04-\x20\xa0]+", " "), _STRIP, ""))
    return F.array_join(F.filter(lines, has_content), "\n")


def split_clean(text: Column, sep: str = SEPARATOR) -> Column:
    """Cleaned paragraphs that have content."""
    return F.filter(F.transform(split_all(text, sep), lambda x: clean_paragraph(body_of(x))), has_content)


def split_lines(text: Column) -> Column:
    """Lines that aren't empty."""
    return F.filter(F.split(text, "\n"), lambda x: x != "")


def count_paragraphs(text: Column, sep: str = SEPARATOR) -> Column:
    return F.size(split_all(text, sep))


def within_limits(text: Column, sep: str = SEPARATOR, most_bytes: int = 2 << 20, most_paragraphs: int = 1000) -> Column:
    """Documents of a size that is worked on at all."""
    return (F.octet_length(text) < most_bytes) & (count_paragraphs(text, sep) < most_paragraphs)


def path_of(paragraph: Column) -> Column:
    return F.when(F.instr(paragraph, PATH_MARK) > 0, F.substring_index(paragraph, PATH_MARK, 1)).otherwise(F.lit(""))


def body_of(paragraph: Column) -> Column:
    at = F.instr(paragraph, PATH_MARK)
    return F.when(at > 0, F.substring(paragraph, at + 1, F.length(paragraph))).otherwise(paragraph)


def without_links(text: Column) -> Column:
    """Without path and link marks, cleaned."""
    return clean_paragraph(F.regexp_replace(body_of(text), f"[{LINK_START}{LINK_END}]", ""))


def link_char_ratio(text: Column) -> Column:
    """Characters within links over all but the marks; 0 for an empty text."""
    inside = F.array_join(F.regexp_extract_all(text, F.lit(f"{LINK_START}([^{LINK_END}]*)"), F.lit(1)), "")
    marks = f"[{LINK_START}{LINK_END}]"
    every = F.length(F.regexp_replace(text, marks, ""))
    return F.when(every == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(inside, marks, "")) / every)


def sentences(text: Column, ends: str = "\n。、！？!?", longest: int | None = None) -> Column:
    """Cut after any of the ends, which stay with their sentence, or at `longest` characters."""
    cls = "".join(literal(c) if c != "\n" else "\\n" for c in ends)
    most = f"{{0,{longest - 1}}}" if longest else "*"
    least = f"{{1,{longest}}}" if longest else "+"
    return F.regexp_extract_all(text, F.lit(f"[^{cls}]{most}[{cls}]|[^{cls}]{least}"), F.lit(0))


def char_ratio(text: Column, char_class: str) -> Column:
    """Share of the characters that are in the class; null for an empty text."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]", "")) / F.nullif(F.length(text), F.lit(0))


def longest_first(words: list[str]) -> str:
    """A regular expression that takes the longest of the words at each place."""
    return "|".join(literal(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))


def once(value: Column, body) -> Column:
    """body(value), with the value computed once however often body names it; a lambda's body would compute it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def char_ngrams(text: Column, n: int) -> Column:
    """All n-grams of characters, as an array; none for shorter texts."""
    some = lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - n + 1), lambda i: F.array_join(F.slice(c, i, n), ""))
    return F.when(F.length(text) >= n, once(F.split(text, ""), some)).otherwise(F.array().cast("array<string>"))


def word_ngrams(words: Column, n: int) -> Column:
    """All n-grams of an array of words, joined by spaces."""
    some = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.array_join(F.slice(w, i + 1, n), " "))
    return once(words, lambda w: F.when(F.size(w) >= n, some(w)).otherwise(F.array().cast("array<string>")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 if either is."""
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(a / b)


def matching_bits(a: Column, b: Column) -> Column:
    """Of two longs."""
    return F.bit_count(F.bitwise_not(a.bitwiseXOR(b)))


def rotate_right(v: Column, k: int) -> Column:
    """64 bits."""
    k %= 64
    return v if not k else F.shiftrightunsigned(v, k).bitwiseOR(F.shiftleft(v, 64 - k))


def clamp_int(v: Column) -> Column:
    return F.least(v, F.lit(2147483647)).cast("int")


def md5_long(text: Column) -> Column:
    """60 bits of a text that other engines can compute too."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def unit_random(text: Column) -> Column:
    """A number in [0, 1) fixed by the text."""
    return md5_long(text) / F.lit(float(1 << 60))


def normal_random(text: Column, mean: float, deviation: float) -> Column:
    """A normally distributed number fixed by the text."""
    u, v = unit_random(F.concat(text, F.lit("\x00u"))), unit_random(F.concat(text, F.lit("\x00v")))
    return mean + deviation * F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * F.pi() * v)


def path_segments(path: Column) -> Column:
    """`tag.class.class#id` joined by `>` as array<struct<tag, id, classes>>."""

    def one(s: Column) -> Column:
        head = F.substring_index(s, "#", 1)
        names = F.split(head, r"\.")
        ident = F.when(F.instr(s, "#") > 0, F.substring(s, F.instr(s, "#") + 1, F.length(s)))
        return F.struct(names[0].alias("tag"), ident.alias("id"), F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))).alias("classes"))

    return F.transform(F.filter(F.split(path, ">"), lambda x: x != ""), one)


def contains_tags(path: Column, tags: list[str]) -> Column:
    return F.exists(path_segments(path), lambda s: s["tag"].isin(tags))


def first_tag(path: Column, tags: list[str]) -> Column:
    """The innermost segment of a path whose tag is one of these; null without one."""
    return F.get(F.reverse(F.filter(path_segments(path), lambda s: s["tag"].isin(tags))), F.lit(0))


def one_line(text: Column) -> Column:
    """Line breaks as a backslash and n."""
    return F.replace(text, F.lit("\n"), F.lit("\\n"))
