"""Language of a text by profiles of character 1- and 2-grams, trained from labelled documents."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T

_ASCII = re.compile("[\x00-\x7f]+")


def text_grams(text: str, ignore_ascii: bool) -> list[str]:
    text = text[: 20 << 10].lower()
    text = (_ASCII.sub(" ", text) if ignore_ascii else re.sub(r"[\W\d_]+", " ", text))[:5000]
    return [*text.replace(" ", ""), *map("".join, zip(text, text[1:], strict=False))]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, n: how often each 1- and 2-gram but the space comes in a batch's texts."""
    for batch in batches:
        found: dict[str | None, Counter] = {}
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("low").to_pylist(), strict=True):
                one = found.setdefault(lang, Counter())
                one.update(text)
                one.update(map("".join, zip(text, text[1:], strict=False)))
        rows = [(lang, gram, n) for lang, one in found.items() for gram, n in one.items() if gram != " "]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)] if rows else [pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())], ["lang", "gram", "n"])


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = 400) -> dict[str, dict[str, float]]:
    """log shares of the `most` commonest n-grams of each language; languages times `most` numbers reach the driver."""
    low = F.regexp_replace(F.lower(F.substring(F.col(text), 1, 5000)), r"[^\p{L}]+", " ")
    known = docs.where(F.length(low) > 2).select(F.col(lang).alias("lang"), low.alias("low"))
    counts = known.mapInArrow(_gram_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("count"))
    from pyspark.sql import Window

    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "gram"))).where(F.col("r") <= most)
    totals = counts.groupBy("lang").agg(F.sum("count").alias("n"))
    out: dict[str, dict[str, float]] = {}
    for r in top.join(totals, "lang").collect():
        out.setdefault(r["lang"], {})[r["gram"]] = math.log(r["count"] / r["n"])
    return out


def classify(text: str, known: dict[str, dict[str, float]], least: int = 256, ignore_ascii: bool = False) -> str:
    """The likeliest language; empty for texts with fewer than `least` characters that count."""
    grams = text_grams(text, ignore_ascii)
    if sum(len(g) == 1 for g in grams) < least or not known:
        return ""
    score = {lang: sum(p.get(g, -14.0) for g in grams) for lang, p in known.items()}
    return max(sorted(score), key=score.get)


def classifier(known: dict[str, dict[str, float]], least: int = 256, ignore_ascii: bool = False) -> Callable[[str], str]:
    """classify() with tables that are made once."""
    langs = sorted(known)
    grams = sorted({g for p in known.values() for g in p})
    row = {g: k for k, g in enumerate(grams)}
    table = np.array([[known[lang].get(g, -14.0) for lang in langs] for g in grams] + [[-14.0] * len(langs)])

    def one(text: str) -> str:
        every = text_grams(text, ignore_ascii)
        if sum(map(len, every)) > 2 * len(every) - least or not langs:  # as many of length 1 as are missing from twice their number
            return ""
        counts = Counter(every)
        at = np.fromiter((row.get(g, -1) for g in counts), dtype=np.int64, count=len(counts))
        return langs[int(np.argmax(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) @ table[at]))]

    return one


def language_of(text: Column, known: dict[str, dict[str, float]], least: int = 256, ignore_ascii: bool = False) -> Column:
    @F.pandas_udf("string")
    def one(texts: pd.Series) -> pd.Series:
        told = classifier(known, least, ignore_ascii)
        return texts.map(lambda t: told(t or ""))

    return one(text)
