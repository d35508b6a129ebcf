"""Toxicity: boosted trees over dense features with isotonic calibration.

Features are densities: of lexicon words and stems, of their closeness to second-person words, of capitals, punctuation and obfuscated
words. The lexicon, the trees and the calibration are learned from labelled documents, at most `sample` of them (the smallest by
hash of doc_id); rows whose crc32(doc_id as text) mod 5 is 0 are never learned from. Words and their first 4 to 6 letters enter
the lexicon when they are in more toxic texts than chance explains among all the words tested.

Edge cases: a null or empty text has all features 0 and is scored like any other; a document with several labels is toxic
if one says so; of rows with one doc_id the least text is learned from; null labels are ignored; without labels of both kinds every
score is the share of toxic ones (0 without labels); repeated rows are scored each, equally; equal scores need no order; an empty table gives an
empty result; a text of any length is scored whole, by itself; other columns pass through, a score column takes a name that is free.
labels, lang, source and doc_id never are features.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import textops
from quern.llm.boosting import Boosted, Isotonic
from quern.llm.storage import durable, release, table, unused

SAMPLE = 24_000
LEXICON = 2_000
#: Bytes of text that a worker takes up at once.
PIECE = 256 << 10
_LETTERS = re.compile(r"[^\W\d_]+")
_LEET = str.maketrans("013457@$!|*", "oieastasiii")
_YOU = frozenset(
    "you your yours yourself u ur ya du dich dir dein deine deinen deinem deiner ihr euch euer sie ihnen tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros su sus".split()
)
FEATURES = 16
#: Numbers kept of a chunk of text.
FACTS = 12


def stems(word: str) -> list[str]:
    """The word, and its first 4 to 6 letters, marked."""
    return [word, *(f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k)]


def _stem_counts(batches):
    """stem, toxic, clean: documents of each kind that have the stem, a row for each stem and piece of a batch."""
    for batch in batches:
        for piece in textops.pieces(batch, bytes_at_once=PIECE):  # so that a worker holds the stems of few texts
            kinds = {0: Counter(), 1: Counter()}
            for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist(), strict=True):
                kinds[toxic].update({s for w in set(_LETTERS.findall((text or "").lower())) for s in stems(w)})
            every = list(kinds[0].keys() | kinds[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([kinds[k][s] for s in every], pa.int64()) for k in (1, 0))], ["stem", "toxic", "clean"])


def lexicon_of(sample: DataFrame, least: int = 3) -> dict[str, float]:
    """Stems in significantly many toxic texts, with the log of how much likelier they are there."""
    toxic, clean = (int(v or 0) for v in sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    if not toxic or not clean:
        return {}
    counts = sample.select("text", "toxic").mapInArrow(_stem_counts, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    counts = durable(counts.where(F.col("a") + F.col("b") >= least))
    tested, base = max(counts.count(), 1), toxic / (toxic + clean)
    a, n = F.col("a"), F.col("a") + F.col("b")
    share = F.least(a / n, F.lit(1 - 1e-12))
    strength = n * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))  # Chernoff: exp(-strength) bounds the chance
    kept = counts.where((share > 2 * base) & (strength > float(np.log(tested / 0.1))))
    weight = F.log((a + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (clean + 1.0))
    rows = kept.select("stem", weight.alias("w"), strength.alias("s")).orderBy(F.desc("s"), "stem").limit(LEXICON).collect()
    release(counts)
    return {r["stem"]: float(r["w"]) for r in rows}


class Featurizer:
    """Dense features of texts. Chunks of text with the same facts are of one kind; the kinds of `limit` chunks are kept for a worker."""

    def __init__(self, lexicon: dict[str, float], limit: int = 60_000):
        self.lexicon, self._limit = lexicon, limit
        self._begins = {w.rstrip("*")[:4] for w in lexicon}  # a word that begins otherwise has no weight
        self._clear()

    def _clear(self) -> None:
        self._at: dict[str, int] = {}  # kind of a chunk
        self._kinds: dict[tuple, int] = {}
        self._facts = array("f")  # FACTS numbers for each kind

    def _weight(self, word: str) -> tuple[float, float]:
        """Of the word, and of its strongest stem."""
        if word[:4] not in self._begins:
            return 0.0, 0.0
        get = self.lexicon.get
        return get(word, 0.0), max((get(f"{word[:k]}*", 0.0) for k in (4, 5, 6) if len(word) > k), default=0.0)

    def _plain(self, chunk: str) -> tuple | None:
        """Facts of letters alone, or letters and one sign after them; None for all else."""
        word, marks = chunk, 0
        if not chunk.isalpha():
            word, marks = chunk[:-1], 1
            if not word.isalpha() or chunk[-1] not in ".,;:!?":
                return None
        upper, size = 0, len(word)
        if not word.islower():
            upper = sum(map(str.isupper, word)) if not word[1:].islower() else int(word[0].isupper())
            word = word.lower()
            if len(word) != size:
                return None
        whole, stem = self._weight(word)
        return (whole, stem, 0.0, float(word in _YOU), upper, size, float(upper > 1 and upper == size), marks, 0.0, size + marks, float(marks and chunk[-1] == "!"), float(bool(whole or stem)))

    def _chunk(self, chunk: str) -> tuple:
        words = _LETTERS.findall(chunk.lower())
        whole = stem = hidden = 0.0
        for w in words:
            a, b = self._weight(w)
            whole, stem = max(whole, a), max(stem, b)
        letters = sum(map(len, words))
        inner = chunk.strip("\"'.,;:!?()[]{}#%&*$-")
        odd = bool(letters) and not inner.isalpha() and not inner.replace("'", "").replace("-", "").isalpha() and any(c.isalpha() for c in inner)
        if odd and whole == 0.0:
            a, b = self._weight("".join(_LETTERS.findall(inner.lower().translate(_LEET))))
            hidden = max(a, b) if max(a, b) > stem else 0.0
        upper = sum(map(str.isupper, chunk))
        marks = len(chunk) - sum(map(str.isalnum, chunk))
        return (whole, stem, hidden, float(any(w in _YOU for w in words)), upper, letters, float(upper > 1 and upper == letters), marks, float(odd), len(chunk), float("!" in chunk), float(bool(whole or stem or hidden)))

    def _places(self, chunks: list[str]) -> np.ndarray:
        """The kind of each chunk."""
        places, at, kinds = np.empty(len(chunks), dtype=np.int64), self._at, self._kinds
        for k, c in enumerate(chunks):
            i = at.get(c)
            if i is None:
                facts = self._plain(c) or self._chunk(c)
                i = kinds.get(facts)
                if i is None:
                    i = kinds[facts] = len(kinds)
                    self._facts.extend(facts)
                if len(c) < 200:
                    at[c] = i
            places[k] = i
        return places

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Features of a piece of texts. Columns of facts are gathered one at a time: a word of the piece costs a few numbers at once, not FACTS."""
        if max(len(self._at), len(self._kinds)) > self._limit:
            self._clear()
        chunks = pc.utf8_split_whitespace(texts)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy())])
        flat = pc.dictionary_encode(pc.list_flatten(chunks))
        del chunks
        n = len(texts)
        if not len(flat):
            return np.zeros((n, FEATURES))
        facts_at = self._places(flat.dictionary.to_pylist())
        known = np.frombuffer(self._facts, dtype=np.float32).reshape(-1, FACTS)[facts_at]  # of the distinct chunks
        code = flat.indices.to_numpy()
        del flat
        size_of = np.diff(bounds)
        doc = np.repeat(np.arange(n, dtype=np.int32), size_of)
        total = lambda v: np.bincount(doc, v[code], n)
        whole, stem, hidden, you, upper, letters, caps, marks, odd, length, loud, hit = known.T
        words = total(length > 0)  # splitting gives empty chunks at white ends
        size = np.maximum(words, 1)
        strongest = np.zeros(n, dtype=np.float32)
        have = np.flatnonzero(size_of)
        strongest[have] = np.maximum.reduceat(np.maximum(np.maximum(whole, stem), hidden)[code], bounds[have])
        near = np.zeros(len(doc), dtype=bool)
        spots = np.flatnonzero(you[code])
        for step in range(-4, 5):  # second person up to four words away, in the same text
            at = spots + step
            ok = (at >= 0) & (at < len(doc))
            ok[ok] &= doc[at[ok]] == doc[spots[ok]]
            near[at[ok]] = True
        hits, in_letters = total(hit), total(letters)
        return np.stack(
            [
                total(whole) / size, total(stem) / size, total(hidden) / size, total(whole > 0) / size, total(stem > 0) / size, hits, strongest,
                np.bincount(doc, hit[code] * near, n) / np.maximum(hits, 1), total(you) / size, total(upper) / np.maximum(in_letters, 1), total(caps) / size,
                total(marks) / np.maximum(total(length), 1), total(loud) / size, total(odd) / size, in_letters / size, np.log1p(words),
            ],
            axis=1,
        )


_last: tuple[str, Featurizer] | None = None


def featurizer(lexicon: dict[str, float], name: str) -> Featurizer:
    """The worker's table for the lexicon of that name; it lasts over tasks, so that small tasks don't each begin anew."""
    global _last
    if _last is None or _last[0] != name:
        _last = (name, Featurizer(lexicon))
    return _last[1]


def _name_of(lexicon: dict[str, float]) -> str:
    return hashlib.blake2b(repr(sorted(lexicon.items())).encode(), digest_size=16).hexdigest()


class Model:
    """Scores of texts from 0 to 1."""

    def __init__(self, lexicon, trees, calibration, constant):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(features), self.constant)
        raw = self.trees.raw(features)
        return np.clip(0.98 * self.calibration(raw) + 0.02 / (1 + np.exp(-raw)), 0.0, 1.0)  # the slope keeps order within pools


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic, part (0 to 4 by hash) of at most `sample` labelled documents that may be learned from."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # ids and labels only: `sample` rows of 16 bytes
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)).cast("int")
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    own = own.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))  # a doc_id's rows have one label
    return own.select("text", "toxic", part.alias("part"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and trees from the sample; calibration on scores each half gets from trees of the other."""
    rows = durable(labelled_sample(docs, labels, sample))
    lexicon = lexicon_of(rows)
    name = _name_of(lexicon)

    def features(batches):
        make = featurizer(lexicon, name)
        for batch in batches:
            for piece in textops.pieces(batch, bytes_at_once=PIECE):
                yield pa.RecordBatch.from_arrays([pa.array(list(make(textops.texts_of(piece.column("text")))), pa.list_(pa.float64())), piece.column("toxic"), piece.column("part")], ["x", "toxic", "part"])

    got = rows.mapInArrow(features, "x array<double>, toxic int, part int").collect()  # at most `sample` rows of FEATURES numbers
    release(rows)
    got.sort(key=lambda r: (r["part"], r["toxic"], list(r["x"])))
    x, y, part = np.array([r["x"] for r in got]).reshape(-1, FEATURES), np.array([float(r["toxic"]) for r in got]), np.array([r["part"] for r in got])
    if not len(y) or y.min() == y.max():
        return Model(lexicon, None, None, float(y.mean()) if len(y) else 0.0)
    crossed = np.zeros(len(y))
    for k in (0, 1):
        one = part % 2 == k
        other = ~one if (~one).any() else one
        crossed[one] = Boosted().fit(x[other], y[other]).raw(x[one])
    return Model(lexicon, Boosted().fit(x, y), Isotonic().fit(crossed, y), 0.0)


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """docs with their score in the column out; columns in keep go along (all by default). No shuffle."""
    keep = keep or docs.columns
    schema = docs.select(*keep).schema.add(out, "double")
    name = _name_of(model.lexicon)

    def run(batches):
        make = featurizer(model.lexicon, name)
        for batch in batches:
            for piece in textops.pieces(batch, bytes_at_once=PIECE):
                score = model.score(make(textops.texts_of(piece.column("text"))))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), pa.array(score)], [*keep, out])

    read = docs.select(*dict.fromkeys([*keep, "text"]))
    return read.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: toxicity score of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    found = scored(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't toxic, unchanged."""
    own = unused("score", docs)
    return scored(docs, train(docs, table(spark, sf_dir, "labels")), out=own).where(F.col(own) < 0.5).drop(own)
