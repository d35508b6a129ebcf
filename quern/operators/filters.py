"""Document and paragraph filters over `paragraphs array<struct>`: each compiles to column expressions, so several fuse into one plan.

A filter marks what it removes by a name; it deletes nothing itself. Paragraph filters skip paragraphs that are marked already, and
no filter touches a document that is.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T

REGISTRY: dict[str, type[Filter]] = {}


def alive() -> Column:
    """Paragraphs that aren't marked."""
    return F.filter("paragraphs", lambda p: p["removed_by"].isNull())


def live_text(sep: str = "") -> Column:
    return F.array_join(F.transform(alive(), lambda p: p["text"]), sep)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


class Filter:
    """Subclasses are found by their name, in configurations too; their arguments are those of __init__."""

    def __init_subclass__(cls, **kw):
        super().__init_subclass__(**kw)
        REGISTRY[cls.__name__] = cls

    def marker(self) -> str:
        return type(self).__name__

    def apply(self, docs: DataFrame) -> DataFrame:
        raise NotImplementedError


class ParagraphFilter(Filter):
    """verdict() says which paragraph goes; edit() may change those that stay."""

    def verdict(self, p: Column) -> Column | None:
        return None

    def edit(self, p: Column) -> Column:
        return p["text"]

    def apply(self, docs: DataFrame) -> DataFrame:
        def one(p: Column) -> Column:
            bad = self.verdict(p)
            by = F.when(bad, F.lit(self.marker())) if bad is not None else p["removed_by"]
            return F.when(p["removed_by"].isNotNull(), p).otherwise(p.withField("removed_by", by).withField("text", self.edit(p)))

        return docs.withColumn("paragraphs", F.when(F.col("removed_by").isNull(), F.transform("paragraphs", one)).otherwise(F.col("paragraphs")))


class DocumentFilter(Filter):
    """marker_column() is the name of what removes the document, or null."""

    def marker_column(self) -> Column:
        raise NotImplementedError

    def apply(self, docs: DataFrame) -> DataFrame:
        return docs.withColumn("removed_by", F.coalesce("removed_by", self.marker_column()))


class MetricFilter(DocumentFilter):
    """Goes if the metric is below low or above high; null and NaN stay."""

    def __init__(self, low: float, high: float):
        self.low, self.high = float(low), float(high)

    def metric(self) -> Column:
        raise NotImplementedError

    def marker_column(self) -> Column:
        m, name = self.metric(), self.marker()
        known = m.isNotNull() & ~F.isnan(m.cast("double"))
        return F.when(known & (m < self.low), F.lit(f"{name}.Low({self.low:g})")).when(known & (m > self.high), F.lit(f"{name}.High({self.high:g})"))


class DocLength(MetricFilter):
    def __init__(self, low: float = 0, high: float = 2147483647):
        super().__init__(low, high)

    def metric(self) -> Column:
        return F.aggregate(alive(), F.lit(0).cast("long"), lambda a, p: a + F.length(p["text"]))


class CharRatio(MetricFilter):
    """Share of a class of characters, given as in a regular expression."""

    def __init__(self, char_class: str, low: float = 0.0, high: float = 1.0):
        super().__init__(low, high)
        self.char_class = char_class

    def metric(self) -> Column:
        return T.char_ratio(live_text(), self.char_class)


class HiraganaRatio(CharRatio):
    def __init__(self, low: float = 0.0, high: float = 1.0):
        super().__init__("぀-ゟ", low, high)


class LinkCharRatio(MetricFilter):
    def __init__(self, low: float = 0.0, high: float = 1.0):
        super().__init__(low, high)

    def metric(self) -> Column:
        return T.link_char_ratio(live_text())


class CompressionRate(MetricFilter):
    """LZ4 bytes over UTF-8 bytes of the first MiB of the live text; an empty document counts as infinitely large."""

    def __init__(self, low: float, high: float):
        super().__init__(low, high)

    def metric(self) -> Column:
        from quern.functions.vector import lz4_ratio

        return lz4_ratio(live_text())


class DuplicateParagraphs(ParagraphFilter):
    def __init__(self, limit: int = 2):
        self.limit = limit

    def marker(self) -> str:
        return f"DuplicateParagraphs({self.limit})"

    def verdict(self, p: Column) -> Column:
        return p["near_freq"] >= self.limit


class AdjacentDuplicateParagraphs(Filter):
    """Drops paragraphs with the same text as the one before."""

    def apply(self, docs: DataFrame) -> DataFrame:
        every = F.col("paragraphs")
        first = F.filter(every, lambda p, i: (i == 0) | (p["text"] != F.element_at(every, F.when(i > 0, i).otherwise(F.lit(1)))["text"]))
        return docs.withColumn("paragraphs", F.when(F.col("removed_by").isNull(), first).otherwise(every))


class LargeFreqParagraphs(Filter):
    """Runs of `count` frequent paragraphs; frames are cut at the ends of the document, so shorter runs there go too.

    A live paragraph triggers if all within `count` up to it, or from it on, are frequent; triggers go, and so do the frequent live
    paragraphs with a trigger among the next `count`.
    """

    def __init__(self, count: int = 3, freq: int = 100):
        self.count, self.freq = count, freq

    def marker(self) -> str:
        return f"{type(self).__name__}({self.count},{self.freq})"

    def hits(self) -> Column:
        return F.transform("paragraphs", lambda p: p["near_freq"] >= self.freq)

    def removed(self) -> Column:
        """For each paragraph whether it goes."""
        n = self.count
        whole = lambda a: F.forall(a, lambda x: x)
        let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
        alive = lambda p: p["removed_by"].isNull()

        def trigger(hit: Column) -> Column:
            before = lambda i: F.slice(hit, F.greatest(i - n + 2, F.lit(1)), F.least(i + 1, F.lit(n)))
            return F.transform("paragraphs", lambda p, i: alive(p) & (whole(before(i)) | whole(F.slice(hit, i + 1, n))))

        def bad(hit: Column, triggers: Column) -> Column:
            soon = lambda i: F.exists(F.slice(triggers, i + 2, n), lambda x: x)
            return F.transform("paragraphs", lambda p, i: alive(p) & (F.element_at(triggers, i + 1) | (F.element_at(hit, i + 1) & soon(i))))

        return let(self.hits(), lambda hit: let(trigger(hit), lambda triggers: bad(hit, triggers)))

    def metric(self) -> Column:
        """How many paragraphs go."""
        return F.size(F.filter(self.removed(), lambda x: x))

    def apply(self, docs: DataFrame) -> DataFrame:
        marked = F.zip_with("paragraphs", self.removed(), lambda p, gone: F.when(gone, p.withField("removed_by", F.lit(self.marker()))).otherwise(p))
        return docs.withColumn("paragraphs", F.when(F.col("removed_by").isNull(), marked).otherwise(F.col("paragraphs")))


class MarkdownizeHeading(ParagraphFilter):
    def edit(self, p: Column) -> Column:
        levels = F.regexp_extract_all(p["path"], F.lit(r"(?:^|>)h([1-6])(?=[.#>]|$)"), F.lit(1))
        level = F.when(F.size(levels) > 0, F.element_at(levels, -1).cast("int")).otherwise(F.lit(0))
        return F.when(level > 0, F.concat(F.repeat(F.lit("#"), level), F.lit(" "), p["text"])).otherwise(p["text"])


class MergeListTag(Filter):
    """Joins live paragraphs of one path that follow each other in a list to one, an item a line; frequencies are the least."""

    def apply(self, docs: DataFrame) -> DataFrame:
        def step(out: Column, p: Column) -> Column:
            last = F.element_at(out, -1)
            item = p["path"].rlike(r"(?:^|>)(?:li|option)(?=[.#>]|$)")
            same = item & last["removed_by"].isNull() & p["removed_by"].isNull() & (last["path"] == p["path"])
            head = F.when(last["_merged"], last["text"]).otherwise(F.concat(F.lit("- "), last["text"]))
            grown = last.withField("text", F.concat(head, F.lit("\n- "), p["text"])).withField("_merged", F.lit(True))
            grown = grown.withField("exact_freq", F.least(last["exact_freq"], p["exact_freq"])).withField("near_freq", F.least(last["near_freq"], p["near_freq"]))
            new = F.array(p.withField("_merged", F.lit(False)))
            return F.when((F.size(out) > 0) & same, F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(out, new))

        kind = "array<struct<path:string,text:string,pos:int,exact_freq:int,near_freq:int,removed_by:string,_merged:boolean>>"
        folded = F.aggregate("paragraphs", F.array().cast(kind), step)
        plain = F.transform(folded, lambda p, i: p.withField("pos", i).dropFields("_merged"))
        return docs.withColumn("paragraphs", F.when(F.col("removed_by").isNull(), plain).otherwise(F.col("paragraphs")))


class NoContentDOM(ParagraphFilter):
    """Paragraphs of page furniture, by tags, and by ids and classes of div, p, ul and h1."""

    TAGS = ("aside", "footer", "form", "header", "nav", "noscript")
    PARTS = ("banner", "breadcrumb", "button", "footer", "header", "logo", "menu", "nav", "pankuzu", "side", "widget")
    WHOLE = ("blog-name", "blog-title-inner", "blogtitle", "head-block1", "head-blog-name", "head-introduction", "left-box")

    def marker(self) -> str:
        return "Nav"

    def verdict(self, p: Column) -> Column:
        camel = [w.split("-")[0] + "".join(x.capitalize() for x in w.split("-")[1:]) for w in self.WHOLE]
        names = [*self.PARTS, *self.WHOLE, *camel]

        def bad(s: Column) -> Column:
            marks = F.concat(s["classes"], F.filter(F.array(s["id"]), lambda x: x.isNotNull()))
            part = F.exists(marks, lambda x: F.lower(x).rlike("|".join(self.PARTS)))
            return s["tag"].isin(list(self.TAGS)) | (s["tag"].isin("div", "p", "ul", "h1") & (part | F.exists(marks, lambda x: x.isin(names))))

        return F.exists(T.path_segments(p["path"]), bad)


class DeduplicateDocuments(DocumentFilter):
    """By the share of repeated text, against a normally distributed number fixed by the document's id."""

    def __init__(self, base: int = 10, mean: float = 0.1, deviation: float = 0.3):
        self.base, self.mean, self.deviation = base, mean, deviation

    def score(self) -> Column:
        size = _sum(F.transform(alive(), lambda p: F.length(p["text"]).cast("double")))
        weight = lambda p: F.length(p["text"]) * F.log(F.least(p["near_freq"], F.lit(self.base)).cast("double")) / F.log(F.lit(float(self.base)))
        return F.when(size == 0, F.lit(0.0)).otherwise(_sum(F.transform(alive(), weight)) / size)

    def marker_column(self) -> Column:
        bound = T.normal_random(F.col("doc_id").cast("string"), self.mean, self.deviation)
        return F.when(self.score() >= bound, F.lit(f"DeduplicateDocuments({self.base})"))


class DeduplicateDocumentsPercentile(DocumentFilter):
    """Keeps about `expected` copies of a document, by a low percentile of its paragraphs' frequencies."""

    def __init__(self, percentile: float = 0.05, expected: float = 1.0):
        self.percentile, self.expected = percentile, expected

    def frequency(self) -> Column:
        freqs = F.array_sort(F.transform(alive(), lambda p: p["near_freq"]))
        return F.when(F.size(freqs) == 0, F.lit(0)).otherwise(F.element_at(freqs, F.floor(F.size(freqs) * F.lit(self.percentile)).cast("int") + 1))

    def marker_column(self) -> Column:
        f = self.frequency()
        goes = (f > 0) & (T.unit_random(F.col("doc_id").cast("string")) > self.expected / f)
        return F.when(goes, F.lit(f"DedupDocsPercentile({self.percentile:g},{self.expected:g})"))


class DuplicateDocumentsLengthWeighted(DocumentFilter):
    def __init__(self, expected: float = 1.0):
        self.expected = expected

    def weight(self) -> Column:
        size = _sum(F.transform(alive(), lambda p: F.length(p["text"]).cast("double")))
        return F.when(size == 0, F.lit(0.0)).otherwise(_sum(F.transform(alive(), lambda p: F.length(p["text"]) * (F.log10(p["near_freq"].cast("double")) + 1))) / size)

    def marker_column(self) -> Column:
        w = self.weight()
        goes = (w > 0) & (T.unit_random(F.col("doc_id").cast("string")) > self.expected / w)
        return F.when(goes, F.lit(f"DuplicateDocumentsLengthWeighted({self.expected:g})"))


def words_from(source: str | list[str]) -> list[str]:
    """A list of words, or a file of one word a line; lines that begin with # are comments."""
    if not isinstance(source, str):
        return list(source)
    with open(source, encoding="utf-8") as f:
        return [w for line in f if (w := line.strip()) and not w.startswith("#")]


class WordInstances(DocumentFilter):
    """Occurrences of listed words, the longest at each place."""

    def __init__(self, list: str | list[str], threshold: float = 3.0, full: float = 1.0, partial: float = 0.1):  # noqa: A002
        self.words, self.threshold, self.full, self.name = words_from(list), threshold, full, list if isinstance(list, str) else f"{len(list)} words"
        del partial

    def matches(self) -> Column:
        return F.regexp_extract_all(live_text("\n"), F.lit(T.longest_first(self.words)), F.lit(0))

    def score(self) -> Column:
        return F.size(self.matches()) * self.full

    def marker_column(self) -> Column:
        return F.when(self.score() + 1e-3 >= self.threshold, F.lit(f"WordInstances({self.name},{self.threshold:g})"))


class WordTypes(WordInstances):
    """Distinct listed words: their number (uniq), with the logs of their counts (log10), or the roots of the counts (sqrt)."""

    def __init__(self, list: str | list[str], threshold: float = 3.0, kind: str = "uniq"):  # noqa: A002
        super().__init__(list, threshold)
        if kind not in ("uniq", "log10", "sqrt"):
            raise ValueError(f"kind {kind!r} is none of uniq, log10, sqrt")
        self.kind = kind

    def score(self) -> Column:
        found = self.matches()
        types = F.array_distinct(found)
        count = lambda w: F.size(F.filter(found, lambda x: x == w)).cast("double")
        per = {"uniq": lambda w: F.lit(1.0), "log10": lambda w: 1 + F.log10(count(w)), "sqrt": lambda w: F.sqrt(count(w))}[self.kind]
        return _sum(F.transform(types, per))

    def marker_column(self) -> Column:
        return F.when(self.score() >= self.threshold, F.lit(f"WordTypes({self.name},{self.threshold:g},{self.kind})"))


class LMDocAvgPerplexity(MetricFilter):
    """Length-weighted mean perplexity of the live paragraphs under a character model."""

    def __init__(self, model: str, low: float = 0.0, high: float = 1e6, outliers: float = 0.0):
        super().__init__(low, high)
        self.model, self.outliers = model, outliers

    def marker(self) -> str:
        return f"LMAvgDoc({self.outliers:g})"

    def metric(self) -> Column:
        from quern.functions.lm import load, scorer

        scores = scorer(load(self.model), self.outliers)(F.transform(alive(), lambda p: p["text"]))
        size = F.transform(alive(), lambda p: F.length(p["text"]).cast("double"))
        return F.try_divide(_sum(F.zip_with(scores, size, lambda s, n: F.pow(F.lit(10.0), -s) * n)), _sum(size))


class LMParagraphPerplexity(LargeFreqParagraphs):
    """Runs of paragraphs that a character model finds unlikely."""

    def __init__(self, model: str, outliers: float = 0.02, count: int = 3, threshold: float = 1e6):
        super().__init__(count, 0)
        self.model, self.outliers, self.threshold = model, outliers, threshold

    def marker(self) -> str:
        return f"LMPar({self.outliers:g},{self.count},{self.threshold:g})"

    def hits(self) -> Column:
        from quern.functions.lm import load, scorer

        scores = scorer(load(self.model), self.outliers)(F.transform("paragraphs", lambda p: p["text"]))
        return F.transform(scores, lambda s: s <= -F.log10(F.lit(float(self.threshold))))


#: The names these go by in configurations written for other engines.
ALIASES = {"KenLMDocAvgPerplexity": "LMDocAvgPerplexity", "KenLMParagraphPerplexity": "LMParagraphPerplexity"}
_RENAMED = {"kenlm": "model", "baseNumFreq": "base"}


def make(name: str, **args) -> Filter:
    """A filter by class name; a dotted name is imported. What other engines' models need besides (a tokenizer's dictionary) is passed over."""
    foreign, name = name in ALIASES, ALIASES.get(name, name)
    if "." in name:
        import importlib

        module, _, last = name.rpartition(".")
        cls: Callable = getattr(importlib.import_module(module), last)
    elif name in REGISTRY:
        cls = REGISTRY[name]
    else:
        raise ValueError(f"no filter {name!r}; there are {', '.join(sorted(REGISTRY))}")
    known = inspect.signature(cls).parameters
    args = {_RENAMED.get(k, k): v for k, v in args.items() if not foreign or _RENAMED.get(k, k) in known}
    if unknown := [k for k in args if k not in known]:
        raise ValueError(f"{name} has no parameter {', '.join(unknown)}")
    return cls(**args)
