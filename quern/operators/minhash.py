"""MinHash near-duplicates of documents: n-gram hashes, signatures, bands, candidate pairs, verification, components, split."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions.vector import edit_similarity
from quern.operators.components import connected
from quern.operators.durable import durable

PRIME = 2038074743


def words(text: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " "), lambda w: w != "")


def features(docs: DataFrame, n: int = 5, hashed=F.xxhash64, text: str = "text") -> DataFrame:
    """docs with tokens and `grams`, the distinct hashes of word n-grams; shorter texts have one gram, empty ones none."""
    tokens = words(F.col(text))
    if hashed is T.md5_long:
        made = docs.withColumn("tokens", tokens)
        return made.mapInArrow(_md5_grams(n), made.withColumn("grams", F.lit(None).cast("array<bigint>")).schema)
    grams = F.when(F.size("tokens") >= n, T.word_ngrams(F.col("tokens"), n)).when(F.size("tokens") > 0, F.array(F.array_join("tokens", " "))).otherwise(F.array().cast("array<string>"))
    return docs.withColumn("tokens", tokens).withColumn("grams", F.array_distinct(F.transform(grams, lambda g: hashed(g))))


def _md5_grams(n: int):
    """The same grams hashed by md5_long, without an expression for each of them."""

    def hashes(tokens: list[str] | None) -> list[int]:
        if not tokens:
            return []
        grams = map(" ".join, zip(*(tokens[k:] for k in range(n)), strict=False)) if len(tokens) >= n else [" ".join(tokens)]
        return list(dict.fromkeys(int.from_bytes(hashlib.md5(g.encode("utf-8", "surrogatepass")).digest()[:8], "big") >> 4 for g in grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(map(hashes, part.column("tokens").to_pylist()), pa.list_(pa.int64()))], [*part.schema.names, "grams"])

    return run


def classes(docs: DataFrame, doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """One document for each set of grams, the one with the smallest id; and (id1, id2) links of all others to theirs. Documents without grams are in neither."""
    named = durable(docs.where(F.size("grams") > 0).select(doc_id, F.sha2(F.concat_ws(",", F.array_sort("grams")), 256).alias("_set")))
    least = named.groupBy("_set").agg(F.min(doc_id).alias("id1"))
    same = durable(named.join(least, "_set").where(F.col(doc_id) != F.col("id1")).select("id1", F.col(doc_id).alias("id2")))
    return docs.where(F.size("grams") > 0).join(same.select(F.col("id2").alias(doc_id)), doc_id, "left_anti"), same


def coefficients(count: int, seed: int = 42) -> list[tuple[int, int]]:
    r = random.Random(seed)
    return [(r.randrange(1, PRIME), r.randrange(PRIME)) for _ in range(count)]


def bands(docs: DataFrame, b: int, r: int, seed: int = 42, doc_id: str = "doc_id") -> DataFrame:
    """A row for each document and band: doc_id, band, key. Documents without grams have none.

    A key joins the least values of ((1 + v) a + b) mod PRIME over the document's grams v. The grams are rows, reduced where they are made.
    """
    prime = F.lit(PRIME).cast("long")
    value = lambda x, y: F.pmod((F.pmod("_v", prime) + 1) * F.lit(x).cast("long") + F.lit(y).cast("long"), prime)
    least = [F.min(value(x, y)).alias(f"_m{k}") for k, (x, y) in enumerate(coefficients(b * r, seed))]
    signed = docs.select(doc_id, F.explode("grams").alias("_v")).groupBy(doc_id).agg(*least)
    keys = F.array(*(F.concat_ws(",", *(F.col(f"_m{k * r + i}").cast("string") for i in range(r))) for k in range(b)))
    return signed.select(doc_id, F.posexplode(keys).alias("band", "key"))


def candidates(rows: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Distinct pairs id1 < id2 that share a band."""
    a, b = (rows.select(F.col(doc_id).alias(n), "band", "key") for n in ("id1", "id2"))
    return a.join(b, ["band", "key"]).where("id1 < id2").select("id1", "id2").distinct()


#: Longs of a set's bitmap.
BITMAP = 16


def bitmaps(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n, s0 to s15: how many grams a document has, and the bits of 1,024 places where they fall."""
    place = F.pmod(F.xxhash64("_v"), F.lit(64 * BITMAP))
    at = lambda k: F.when(F.shiftright("_p", 6) == k, F.expr("shiftleft(1L, int(_p & 63))")).otherwise(F.lit(0).cast("long"))
    each = docs.select(doc_id, F.explode("grams").alias("_v")).select(doc_id, place.alias("_p"))
    return each.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n"), *(F.bit_or(at(k)).alias(f"s{k}") for k in range(BITMAP)))


def likely(rows: DataFrame, docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id") -> DataFrame:
    """candidates() without pairs that can't have a Jaccard similarity of `least`.

    A place that only one of two sets has holds a gram that only this set has. With d of these, at most n - d grams are common, and
    the union has the other's n and d more. So no pair is lost, and no gram is fetched for most of those that are far from alike.
    """
    kept = ["n", *(f"s{k}" for k in range(BITMAP))]
    told = durable(rows.join(bitmaps(docs, doc_id), doc_id))
    a, b = (told.select(F.col(doc_id).alias(f"id{x}"), "band", "key", *(F.col(c).alias(f"{c}_{x}") for c in kept)) for x in "12")
    alone = lambda x, y: sum((F.bit_count(F.col(f"s{k}_{x}").bitwiseAND(F.bitwise_not(F.col(f"s{k}_{y}")))) for k in range(1, BITMAP)), F.bit_count(F.col(f"s0_{x}").bitwiseAND(F.bitwise_not(F.col(f"s0_{y}")))))
    could = lambda x, y: (F.col(f"n_{x}") - alone(x, y)) >= (F.lit(least) - 1e-9) * (F.col(f"n_{y}") + alone(x, y))
    met = a.join(b, ["band", "key"]).where("id1 < id2").where((F.least("n_1", "n_2") >= (F.lit(least) - 1e-9) * F.greatest("n_1", "n_2")) & could("1", "2") & could("2", "1"))
    return met.select("id1", "id2").distinct()


def verified(pairs: DataFrame, docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id") -> DataFrame:
    """Pairs with their Jaccard similarity, of at least `least`."""
    grams = docs.select(doc_id, "grams")
    one = pairs.join(grams.select(F.col(doc_id).alias("id1"), F.col("grams").alias("_g1")), "id1").join(grams.select(F.col(doc_id).alias("id2"), F.col("grams").alias("_g2")), "id2")
    return one.select("id1", "id2", T.jaccard(F.col("_g1"), F.col("_g2")).alias("jaccard")).where(F.col("jaccard") >= least)


def edit_verified(pairs: DataFrame, docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id") -> DataFrame:
    """Pairs with the edit similarity of their tokens, of at least `least`."""
    tokens = docs.select(doc_id, "tokens")
    one = pairs.join(tokens.select(F.col(doc_id).alias("id1"), F.col("tokens").alias("_t1")), "id1").join(tokens.select(F.col(doc_id).alias("id2"), F.col("tokens").alias("_t2")), "id2")
    return one.withColumn("editsim", edit_similarity("_t1", "_t2")).drop("_t1", "_t2").where(F.col("editsim") >= least)


def split(docs: DataFrame, pairs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """docs with cc, the smallest id of their component (null: alone), and `kept`."""
    named = connected(pairs, "id1", "id2").select(F.col("node").alias(doc_id), F.col("component").alias("cc"))
    return docs.join(named, doc_id, "left").withColumn("kept", F.col("cc").isNull() | (F.col("cc") == F.col(doc_id)))
