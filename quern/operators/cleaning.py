"""Cleaning of documents as arrays of elements (paragraphs or sentences): column `elements array<string>`.

A step maps a frame to a frame; other columns pass through. Filters of elements drop documents that become empty.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import literal, once

STEPS: dict[str, Callable[..., Callable[[DataFrame], DataFrame]]] = {}


def _step(make):
    STEPS[make.__name__] = make
    return make


def _each(edit: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("elements", F.transform("elements", edit))


def _keep(good: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("elements", F.filter("elements", good)).where(F.size("elements") > 0)


def _replace(pattern: str, to: str = "") -> Callable[[DataFrame], DataFrame]:
    return _each(lambda x: F.regexp_replace(x, pattern, to))


@_step
def Identity():
    return lambda df: df


@_step
def SplitElement(element_delim: str = "\n"):
    """Each element's parts; empty ones at the end go."""

    def full(found: Column) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: F.element_at(found, i) != "")
        return F.slice(found, 1, F.coalesce(F.array_max(at), F.lit(0)))

    def parts(x: Column) -> Column:
        return F.when(x == "", F.array(F.lit(""))).otherwise(once(F.split(x, literal(element_delim)), full))

    return lambda df: df.withColumn("elements", F.flatten(F.transform("elements", parts)))


@_step
def SplitIntoSentence():
    return SplitElement("\n")


@_step
def SplitIntoParagraph():
    return SplitElement("\n\n")


@_step
def NormalizeCharacter(keep_ws: bool = False):
    """Without control and separator characters but spaces; white space too stays if keep_ws."""
    kept = r" \s　" if keep_ws else " "
    return _replace(rf"[\p{{C}}\p{{Z}}&&[^{kept}\p{{Cs}}]]")


@_step
def NormalizeWhitespace():
    return _replace(r"[\s　]+", " ")


#: What counts as a citation mark, as a sentence with an address and as one with a link.
CITATION = r"\[\d+?\]|\[要.+?\]|\{\{+[^{}]+?\}\}+|\[(要出典|リンク切れ|.+?\?)\]"
EMAIL = r"[\w\d_-]+@[\w\d_-]+\.[\w\d._-]+"
URL = r"(https?|sftp?)://[\w/:%#\$&\?\(\)~\.=\+\-]+"


@_step
def RemoveWikipediaCitation():
    return _replace(CITATION)


@_step
def ConcatShortSentence(concat_threshold: int = 2):
    """Elements of concat_threshold characters or fewer join the one before."""

    def step(out: Column, x: Column) -> Column:
        joined = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.concat(F.element_at(out, -1), x)))
        return F.when((F.size(out) > 0) & (F.length(x) <= concat_threshold), joined).otherwise(F.concat(out, F.array(x)))

    return lambda df: df.withColumn("elements", F.aggregate("elements", F.array().cast("array<string>"), step))


@_step
def RemoveEmail():
    return _keep(lambda x: ~x.rlike(EMAIL))


@_step
def RemoveURL():
    return _keep(lambda x: ~x.rlike(URL))


@_step
def FilterBySentenceLength(min_sent_len: int = 10, max_sent_len: int = 200):
    return _keep(lambda x: F.length(x).between(min_sent_len, max_sent_len))


@_step
def FilterJapaneseBasedOnCharacter(kana_rate: float = 0.05, jp_rate: float = 0.7):
    share = lambda x, cls: F.try_divide(F.length(F.regexp_replace(x, f"[^{cls}]", "")), F.length(x))
    return _keep(lambda x: (share(x, "぀-ヿ") > kana_rate) & (share(x, "぀-ヿ一-鿿") > jp_rate))


@_step
def RemoveShortDocument(min_sentence: int = 5):
    """Documents with fewer lines; one without elements has none."""
    lines = F.aggregate("elements", F.lit(0), lambda a, x: a + F.size(F.split(x, "\n")))
    return lambda df: df.where(lines >= min_sentence)


@_step
def RemoveScriptDocument():
    """Documents with braces or bars, as source code has them."""
    return lambda df: df.where(~F.exists("elements", lambda x: x.rlike("[{}|]")))


@_step
def RemoveNGWordDocument(words: list[str] | str = (), regex: bool = False):
    """Documents with a listed word, on word boundaries."""
    from quern.operators.filters import words_from

    listed = words_from(words) if isinstance(words, str) else list(words)
    pattern = r"(?U)(?<!\w)(?:" + "|".join(w if regex else literal(w) for w in listed) + r")(?!\w)"
    return (lambda df: df.where(~F.exists("elements", lambda x: x.rlike(pattern)))) if listed else (lambda df: df)


@_step
def DeduplicateElement(doc_id: str = "doc_id"):
    """One copy of each element in all documents: that of the smallest (doc_id, position). Documents without any left go."""

    def run(df: DataFrame) -> DataFrame:
        rows = df.select(doc_id, F.posexplode("elements").alias("_pos", "_text"))
        first = rows.groupBy("_text").agg(F.min(F.struct(doc_id, "_pos")).alias("_at")).select(F.col(f"_at.{doc_id}").alias(doc_id), F.col("_at._pos").alias("_pos"), "_text")
        built = first.groupBy(doc_id).agg(F.array_sort(F.collect_list(F.struct("_pos", "_text"))).alias("_e")).select(doc_id, F.transform("_e", lambda e: e["_text"]).alias("elements"))
        return df.drop("elements").join(built, doc_id)

    return run


@_step
def DeduplicateRepeatingSentence(min_repetition: int = 2):
    """Runs of min_repetition or more equal elements become one."""

    n = min_repetition

    def collapsed(e: Column) -> Column:
        same = lambda i, j: F.element_at(e, i) == F.element_at(e, j)

        def in_run(i: Column) -> Column:  # element i repeats the one before, within a run that is long enough
            back = lambda k: (i - k >= 1) & F.when(i - k >= 1, same(F.greatest(i - k, F.lit(1)), i)).otherwise(F.lit(False))
            ahead = lambda k: (i + k <= F.size(e)) & F.when(i + k <= F.size(e), same(F.least(i + k, F.size(e)), i)).otherwise(F.lit(False))
            whole = F.lit(False)
            for first in range(n):  # some window of n around i is all equal
                inside = F.lit(True)
                for k in range(-first, n - first):
                    inside = inside & (back(-k) if k < 0 else ahead(k) if k > 0 else F.lit(True))
                whole = whole | inside
            return back(1) & whole

        keep = F.filter(F.sequence(F.lit(1), F.size(e)), lambda i: ~in_run(i))
        return F.when(F.size(e) > 0, F.transform(keep, lambda i: F.element_at(e, i))).otherwise(e)

    return lambda df: df.withColumn("elements", once(F.col("elements"), collapsed))


@_step
def RemoveSubstring(substrings: list[str] | str = (), match_sentence: bool = False, regex: bool = False):
    """Without the listed substrings, or lines that are one of them; lines that are empty then go."""
    from quern.operators.filters import words_from

    listed = words_from(substrings) if isinstance(substrings, str) else list(substrings)
    one = "|".join(w if regex else literal(w) for w in sorted(listed, key=lambda w: (-len(w), w)))
    pattern = f"(?m)^(?:{one})$" if match_sentence else f"(?:{one})"

    def edit(x: Column) -> Column:
        return F.array_join(F.filter(F.split(F.regexp_replace(x, pattern, ""), "\n"), lambda line: line != ""), "\n")

    return (lambda df: df.withColumn("elements", F.filter(F.transform("elements", edit), lambda x: x != ""))) if listed else (lambda df: df)


PRESETS: dict[str, list] = {
    "chitra": ["NormalizeCharacter", "NormalizeWhitespace", "SplitIntoSentence", "ConcatShortSentence", "FilterBySentenceLength", "RemoveShortDocument"],
    "warc": [
        "NormalizeCharacter", "NormalizeWhitespace", "SplitIntoParagraph", "SplitIntoSentence", "RemoveURL", "RemoveEmail", "ConcatShortSentence",
        "FilterJapaneseBasedOnCharacter", "FilterBySentenceLength", "DeduplicateRepeatingSentence", "RemoveScriptDocument", "RemoveShortDocument",
    ],
    "rmTemplate": ["DeduplicateElement", "RemoveSubstring"],
    "dictCorpus": ["NormalizeCharacter", "SplitIntoSentence", "RemoveWikipediaCitation", "ConcatShortSentence", "RemoveShortDocument"],
}


def pipeline(stages: list[str | dict] | str) -> Callable[[DataFrame], DataFrame]:
    """The steps in turn: names, or {"class": name, argument: value}; or the name of a preset. Arguments may be camelCase."""
    stages = PRESETS[stages] if isinstance(stages, str) else stages
    made = []
    for stage in stages:
        args = dict(stage) if isinstance(stage, dict) else {"class": stage}
        name = args.pop("class")
        if name not in STEPS:
            raise ValueError(f"no step {name!r}; there are {', '.join(sorted(STEPS))}")
        made.append(STEPS[name](**{re.sub(r"(?<=[a-z])([A-Z])", lambda m: "_" + m[1].lower(), k): v for k, v in args.items()}))

    def run(df: DataFrame) -> DataFrame:
        for step in made:
            df = step(df)
        return df

    return run


def elements(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each text as a document of one element."""
    return docs.withColumn("elements", F.array(text)).drop(text)


def joined(docs: DataFrame, delimiter: str = "\n") -> DataFrame:
    return docs.withColumn("text", F.array_join("elements", delimiter)).drop("elements")


def first_of(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")
