"""Language-model scores behind one interface: a character model here; others plug in by load()."""

from __future__ import annotations

import functools
import json
import math
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators.durable import durable

_DROPPED = re.compile("[ \x02\x03\n]")
#: Characters of a sentence that are scored together; a longer one goes on with the next as many.
_SLICE = 16 << 10
#: Bits of a character in a packed n-gram, and the n-grams that are looked up without a join.
_BITS, HOT = 21, 50_000


def slices(text: str) -> list[str]:
    """The sentences of a text to its end, long ones in slices."""
    return [s[i : i + _SLICE] for s in re.split(r"(?<=[\n。、！？!?])", text) for i in range(0, len(s), _SLICE)]


class CharModel:
    """Character n-grams with add-k smoothing and backing off to shorter ones; log10 probabilities."""

    def __init__(self, order: int, counts: dict[str, int], vocabulary: int):
        self.order, self.counts, self.vocabulary = order, counts, vocabulary

    def log_probs(self, sentence: str) -> list[float]:
        s = _DROPPED.sub("", sentence)
        out = []
        for i in range(len(s)):
            for n in range(min(self.order, i + 1), 0, -1):
                seen = self.counts.get(s[i - n + 1 : i + 1], 0)
                if seen or n == 1:
                    context = self.counts.get(s[i - n + 1 : i], 0) if n > 1 else self.counts.get("", 0)
                    out.append(math.log10((seen + 0.1) / (context + 0.1 * self.vocabulary)))
                    break
        return out

    def score(self, text: str, outliers: float = 0.0) -> float:
        """Mean log10 probability of a character over all sentences; without the least likely share."""
        probs = [p for s in slices(text) for p in self.log_probs(s)]
        if outliers >= 1e-3:
            probs = sorted(probs)[int(len(probs) * outliers) :]
        return sum(probs) / len(probs) if probs else -50.0

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump({"order": self.order, "counts": self.counts, "vocabulary": self.vocabulary}, f)


def train(texts: DataFrame, column: str, order: int = 3, most: int = 50_000) -> CharModel:
    """From the most frequent n-grams of all texts; `most` bounds what reaches the driver."""
    rows = None
    for n in range(1, order + 1):
        clean = F.regexp_replace(F.col(column), "[ \x02\x03\n]", "")
        grams = F.when(F.length(clean) >= n, T.char_ngrams(clean, n))
        one = texts.select(F.explode(grams).alias("gram"))
        rows = one if rows is None else rows.union(one)
    counts = rows.groupBy("gram").count()
    found = {r["gram"]: r["count"] for r in counts.orderBy(F.desc("count"), "gram").limit(most).collect()}
    total = counts.where(F.length("gram") == 1).agg(F.sum("count"), F.count(F.lit(1))).first()
    return CharModel(order, found | {"": int(total[0] or 0)}, int(total[1] or 1))


@functools.cache
def load(path: str) -> CharModel:
    """A model from a file, once for each process."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    return CharModel(d["order"], Counter(d["counts"]), d["vocabulary"])


def scorer(model: CharModel, outliers: float = 0.0) -> Callable[[Column], Column]:
    """A function from arrays of texts to arrays of scores."""

    @F.pandas_udf("array<double>")
    def scores(texts: pd.Series) -> pd.Series:
        return texts.map(lambda a: [model.score(t or "", outliers) for t in a])

    return scores


def score_distinct(rows: DataFrame, column: str, model: CharModel, outliers: float = 0.0) -> DataFrame:
    """text, score of the distinct texts, least likely first, range-partitioned."""
    one = rows.select(F.col(column).alias("text")).distinct()
    scored = one.withColumn("score", scorer(model, outliers)(F.array("text"))[0])
    return scored.repartitionByRange("score", "text").sortWithinPartitions("score", "text")


def packed(sentences: list[str], order: int) -> list[np.ndarray]:
    """For n from 1 to order: the n-grams that end at each character, packed in 63 bits, without those that reach over a sentence's start (0)."""
    clean = [_DROPPED.sub("", s) for s in sentences]
    chars = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) + 1
    sizes = np.array([len(s) for s in clean], dtype=np.int64)
    place = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [chars]
    for n in range(2, order + 1):
        longer = np.zeros_like(chars)
        longer[1:] = out[-1][:-1] << _BITS | chars[1:]
        out.append(np.where(place >= n - 1, longer, 0))
    return out


def counted(texts: DataFrame, column: str, order: int = 3) -> DataFrame:
    """gram (packed), count: all n-grams of all texts, with no bound on their number."""
    if not 1 <= order <= 3:
        raise ValueError("packed n-grams have 1 to 3 characters")

    def run(batches):
        for batch in batches:
            lengths = pa.compute.utf8_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(lengths):
                to = max(at + 1, at + int(np.searchsorted(np.cumsum(lengths[at:]), 1 << 20, "right")))
                for grams in packed([t or "" for t in batch.column(0).slice(at, to - at).to_pylist()], order):
                    values, counts = np.unique(grams[grams > 0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["gram", "count"])
                at = to

    return texts.select(column).mapInArrow(run, "gram long, count long").groupBy("gram").agg(F.sum("count").alias("count"))


def resolved(grams: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """gram, lp: the log10 probability of a gram's last character after those before, from all counts, backing off as CharModel does."""
    one = counts.where(F.col("gram") < 1 << _BITS).agg(F.sum("count"), F.count(F.lit(1))).first()
    total, smooth = int(one[0] or 0), 0.1 * int(one[1] or 1)
    levels = [F.struct(F.lit(n).alias("n"), F.col("gram").bitwiseAND(F.lit((1 << _BITS * n) - 1).cast("long")).alias("own"), (F.col("gram") >= 1 << _BITS * (n - 1)).alias("whole")) for n in range(1, order + 1)]
    tails = grams.select("gram", F.explode(F.array(*levels)).alias("t")).where("t.whole")
    tails = tails.select("gram", "t.n", "t.own", F.shiftright("t.own", _BITS).alias("context"))
    seen = tails.join(counts.select(F.col("gram").alias("own"), F.col("count").alias("seen")), "own", "left").where("n = 1 or seen > 0")
    longest = seen.groupBy("gram").agg(F.max_by(F.struct("n", "context", F.coalesce("seen", F.lit(0)).alias("seen")), "n").alias("s")).select("gram", "s.*")
    known = longest.join(counts.select(F.col("gram").alias("context"), F.col("count").alias("before")), "context", "left")
    before = F.when(F.col("n") == 1, F.lit(total)).otherwise(F.coalesce("before", F.lit(0)))
    return known.select("gram", F.log10((F.col("seen") + 0.1) / (before + smooth)).alias("lp"))


def score_by_table(rows: DataFrame, column: str, counts: DataFrame, order: int = 3, hot: int = HOT) -> DataFrame:
    """As score_distinct, from the table of all counts: the hot commonest n-grams are looked up in place, all others are joined."""
    top = resolved(counts.orderBy(F.desc("count"), "gram").limit(hot).select("gram"), counts, order).orderBy("gram").collect()
    keys, values = np.array([r["gram"] for r in top], dtype=np.int64), np.array([r["lp"] for r in top])

    def run(batches):
        for batch in batches:
            found: list[tuple] = []
            for text in batch.column(0).to_pylist():
                grams = packed(slices(text or ""), order)
                longest = grams[0]
                for longer in grams[1:]:
                    longest = np.where(longer > 0, longer, longest)
                at = np.minimum(np.searchsorted(keys, longest), max(len(keys) - 1, 0))
                met = keys[at] == longest if len(keys) else np.zeros(len(longest), dtype=bool)
                rest, times = np.unique(longest[~met], return_counts=True)
                found.append((float(values[at[met]].sum()), len(longest), rest, times))
            sums, sizes, rest, times = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.float64()), pa.array(sizes, pa.int64()), pa.array(rest, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))], ["text", "lp", "n", "rest", "times"]
            )

    one = rows.select(F.col(column).alias("text")).distinct()
    scored = durable(one.mapInArrow(run, "text string, lp double, n long, rest array<long>, times array<long>").withColumn("id", F.monotonically_increasing_id()))
    open_ = scored.select("id", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("id", F.col("r.rest").alias("gram"), "r.times")
    known = resolved(open_.select("gram").distinct(), counts, order)
    more = open_.join(known, "gram").groupBy("id").agg(F.sum(F.col("times") * F.col("lp")).alias("more"))
    total = F.col("lp") + F.coalesce("more", F.lit(0.0))
    named = scored.select("id", "text", "lp", "n").join(more, "id", "left").select("text", F.when(F.col("n") > 0, total / F.col("n")).otherwise(-50.0).alias("score"))
    return named.repartitionByRange("score", "text").sortWithinPartitions("score", "text")
