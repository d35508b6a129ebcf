"""Document fingerprints: bottom-k sketches of 5-word shingle hashes.

A sketch is the k smallest distinct 64-bit shingle hashes in ascending order. Sketches of parts merge into the sketch of the
whole (the k smallest of the union), and estimate resemblance, containment and the number of distinct shingles. With fewer
than k hashes a sketch is the whole set and all estimates are exact.

Texts are lower-cased (A-Z) and split at white space; a text of 1 to 4 words has its whole sequence as the one shingle.
Edge cases: a null text counts as empty; empty texts have the empty fingerprint, resemble each other by 1 and others by 0;
a single document is its own next one; repeated rows and equal doc_ids are ordered by their text; a text of any length is read whole, by
itself; an empty table gives an empty result; only doc_id and text are read, so other columns can have any names.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import textops
from quern.llm.storage import table

SHINGLE = 5
K = 128


def sketches(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The bottom-k sketch of each text."""
    h, begin = textops.text_shingles(texts, shingle)
    return [np.unique(h[a:b])[:k] for a, b in zip(begin[:-1], begin[1:], strict=True)]


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u8")


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what a and b were made from."""
    return np.union1d(a, b)[:k]


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Hashes of the union's sketch that are in both, and its size."""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    rank = np.concatenate([[0], np.cumsum(~twice)])  # of each hash among the distinct ones
    return int((twice & (rank[1:] < k)).sum()), min(k, int(rank[-1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated size of the intersection over that of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared, of = _shared(a, b, k)
    return shared / of


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct_count(merge(a, b, k), k) / distinct_count(a, k)) if len(b) else 0.0


def merge_parts(parts: DataFrame, key: str, hashes: str, k: int = K, lanes: int = 64) -> DataFrame:
    """One sketch for each key from sketches of its parts (array<long> of hashes, ordered as unsigned numbers).

    Works on rows of single hashes, pre-aggregated in lanes, so that no task gathers all parts of a hot key.
    """
    one = parts.select(key, F.explode(hashes).alias("_h")).withColumn("_h", F.col("_h").bitwiseXOR(F.lit(-(2**63))))
    bottom = lambda c: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), 1, k)
    lane = F.pmod(F.xxhash64("_h"), F.lit(lanes)).alias("_lane")
    fine = one.distinct().groupBy(key, lane, F.pmod(F.xxhash64("_h", F.lit(1)), F.lit(lanes)).alias("_sub"))
    low = fine.agg(bottom(F.array("_h")).alias("_s")).groupBy(key, "_lane").agg(bottom("_s").alias("_s"))
    back = F.transform(bottom("_s"), lambda x: x.bitwiseXOR(F.lit(-(2**63))))
    return low.groupBy(key).agg(back.alias(hashes))


def _ranges(ids: DataFrame, column: str, parts: int) -> list:
    """Up to parts - 1 ascending values that cut the column into ranges of about the same number of rows."""
    cuts = ids.agg(F.expr(f"percentile_approx({column}, array({', '.join(f'{k / parts:.8f}D' for k in range(1, parts))}), 10000)")).first()[0] if parts > 1 else None
    return sorted(set(cuts or []))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """docs (doc_id, text) dealt by descending ranges of doc_id (`_part`), each range followed by the first row of the next one (`_extra`).

    The ranges are fixed by values of doc_id, so a task that runs again sees the same rows. One shuffle of the texts.
    """
    spark, ids = docs.sparkSession, docs.select("doc_id")
    cuts = _ranges(ids, "doc_id", parts)

    def search(low: int, high: int):
        """The range of a doc_id between two cuts, by halving: the expression is as deep as the logarithm of the cuts."""
        if low == high:
            return F.lit(len(cuts) - low)
        mid = (low + high) // 2
        return F.when(F.col("doc_id") > cuts[mid], search(mid + 1, high)).otherwise(search(low, mid))

    part = search(0, len(cuts))
    heads = ids.groupBy(part.cast("int").alias("_p")).agg(F.max("doc_id").alias("_id")).orderBy("_p").collect()
    befores = spark.createDataFrame([(head["_id"], heads[k - 1]["_p"]) for k, head in enumerate(heads)], "_head long, _before int")
    own = docs.withColumn("_part", part.cast("int")).join(F.broadcast(befores), F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    extra = F.when(F.col("_before").isNotNull(), F.array(F.lit(-1), F.col("_before"))).otherwise(F.array(F.lit(-1)))
    copies = own.select("doc_id", "text", "_part", F.explode(extra).alias("_extra"))
    first = F.col("_extra") >= 0
    dealt = copies.withColumn("_part", F.when(first, F.col("_extra")).otherwise(F.col("_part"))).withColumn("_extra", first)
    return dealt.repartition(max(parts // 3, 1), "_part").sortWithinPartitions("_part", "_extra", F.desc_nulls_last("doc_id"), "text")


def _follow(batches):
    """Of each row but the extra ones: its fingerprint and that of its edited text, which ends with the next row's beginning."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles_est"]
    held = None  # (doc_id, text, sketch, part) that still lacks its next row

    def flush(pairs):
        edited = [t[: len(t) - len(t) // 3] + nxt[: len(t) // 3] for (_, t, _, _), (_, nxt, _, _) in pairs]
        made = sketches(pa.array(edited, pa.string()))
        rows = [
            (d, len(t), hashlib.sha256(e.encode()).hexdigest(), encode(s), encode(m), resemblance(s, m), resemblance(s, n[2]), distinct_count(s))
            for ((d, t, s, _), n), e, m in zip(pairs, edited, made, strict=True)
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for piece in textops.pieces(batch):
            texts = textops.texts_of(piece.column("text"))
            rows = zip(piece.column("doc_id").to_pylist(), texts.to_pylist(), sketches(texts), piece.column("_part").to_pylist(), piece.column("_extra").to_pylist(), strict=True)
            pairs = []
            for d, t, s, part, extra in rows:
                now = (d, t, s, part)
                if held is not None and held[3] == part:
                    pairs.append((held, now))
                held = None if extra else now
            if pairs:
                yield flush(pairs)


def fingerprint_with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of docs (doc_id, text) and of their edited texts."""
    spark = docs.sparkSession
    parts = parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles_est double"
    return with_next(docs, parts).mapInArrow(_follow, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: fingerprints of every whole text and of its edited text."""
    return fingerprint_with_next(table(spark, sf_dir, "documents"))
