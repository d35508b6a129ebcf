"""Best-fit packing of token sequences by exact-complement hashing.

Only the number of pieces of each length matters to the plan, and there are at most `size` lengths; so the plan is made on the
driver from one count for each length, whatever the number of documents. Single lengths, and sums of two and three lengths, are
indexed; the plan takes the longest piece left and looks up combinations that fill its gap exactly, consumes the combination as
often as the counts allow, and falls back to the longest piece that fits (best fit) where no sum fills the gap.

The pieces then find their places from the plan: a piece's rank among those of its length picks the interval of the plan it lies
in. Ranks are counted in lanes, so no task holds all pieces of a common length.

Edge cases: a null text counts as empty and has one piece with only the end token; repeated rows are packed each; pieces of one length are
ranked by doc_id, piece and checksum, and those equal in all of these are interchangeable; an empty table gives an empty result; texts of
any length are cut into full pieces and one shorter last piece; only doc_id and text are read, so other columns can have any names.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import textops
from quern.llm.sharding import with_slots
from quern.llm.storage import durable, table
from quern.llm.wordbpe import word_bpe

SIZE = 2048


class Gaps:
    """Counts of lengths, with single, pair and triple sums to fill gaps exactly."""

    def __init__(self, counts: dict[int, int], size: int):
        self.size = size
        self.count = np.zeros(size + 1, dtype=np.int64)
        for length, n in counts.items():
            self.count[length] = n
        self._index()

    def _index(self) -> None:
        """Which sums two or three available lengths can have. Consuming makes some entries stale; lookups verify."""
        have = self.count > 0
        self._pair = np.zeros(self.size + 1, dtype=bool)
        self._triple = np.zeros(self.size + 1, dtype=bool)
        for a in np.flatnonzero(have):
            self._pair[a:] |= have[: self.size + 1 - a]
        for a in np.flatnonzero(have):
            self._triple[a:] |= self._pair[: self.size + 1 - a]
        self._stale = 0

    def _ok(self, parts: tuple[int, ...]) -> bool:
        return all(self.count[p] >= parts.count(p) for p in set(parts))

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap, longest first."""
        if gap <= 0:
            return None
        if self.count[gap] > 0:
            return (gap,)
        have = np.flatnonzero(self.count[: gap + 1] > 0)[::-1]
        if self._pair[gap]:
            for a in have[(gap - have <= have) & (self.count[gap - have] > 0)]:
                if self._ok(parts := (int(a), int(gap - a))):
                    return parts
        if self._triple[gap]:
            for a in have[(3 * have >= gap) & self._pair[gap - have]]:
                rest = gap - a
                low = have[(have <= a) & (have <= rest) & (rest - have <= have)]
                for b in low[self.count[rest - low] > 0]:
                    if self._ok(parts := (int(a), int(b), int(rest - b))):
                        return parts
        return None

    def below(self, gap: int) -> int | None:
        """The longest available length that fits."""
        have = np.flatnonzero(self.count[: gap + 1] > 0)
        return int(have[-1]) if len(have) else None

    def consume(self, parts: list[int]) -> int:
        """Takes the parts as often as there are enough of each; how often."""
        times = min(int(self.count[p]) // parts.count(p) for p in set(parts))
        for p in parts:
            self.count[p] -= times
        self._stale += 1
        if self._stale >= 64:
            self._index()
        return times


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, pieces, pieces per sequence, first sequence, offset) for intervals of ranks of pieces of a length.

    Piece r of an interval is in sequence first + (r - first rank) // per, at offset + length * ((r - first rank) % per).
    """
    gaps, out, sequences, used = Gaps(counts, size), [], 0, dict.fromkeys(counts, 0)
    while (longest := gaps.below(size)) is not None:
        parts, gap = [], size
        piece = longest
        while piece is not None:
            parts.append(piece)
            gaps.count[piece] -= 1
            gap -= piece
            if filled := gaps.exact(gap):
                parts += filled
                for p in filled:
                    gaps.count[p] -= 1
                break
            piece = gaps.below(gap)
        for p in parts:
            gaps.count[p] += 1
        times, offset = gaps.consume(parts), 0
        for p in sorted(set(parts), reverse=True):
            per = parts.count(p)
            out.append((p, used[p], times * per, per, sequences, offset))
            used[p] += times * per
            offset += p * per
        sequences += times
    return out


def pack(pieces: DataFrame, order: list[str], size: int = SIZE) -> DataFrame:
    """pieces (with `length` from 1 to size) with sequence_id and offset. It is read three times and should be kept."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    lines: dict[int, list] = {}
    for length, *line in plan(counts, size):
        lines.setdefault(length, []).append(tuple(line))
    line_type = T.StructType([T.StructField(n, T.LongType()) for n in ("from", "n", "per", "first", "at")])
    schema = T.StructType([T.StructField("length", T.LongType()), T.StructField("_lines", T.ArrayType(line_type))])
    lanes = F.xxhash64(*order)
    ranked = with_slots(pieces, "length", order, lanes, "_rank_of_length")
    found = ranked.join(F.broadcast(spark.createDataFrame(list(lines.items()), schema)), "length")
    line = F.filter("_lines", lambda x: (F.col("_rank_of_length") >= x["from"]) & (F.col("_rank_of_length") < x["from"] + x["n"]))[0]
    placed = found.withColumn("_line", line).withColumn("_r", F.col("_rank_of_length") - F.col("_line.from"))
    placed = placed.withColumn("sequence_id", F.col("_line.first") + F.floor(F.expr("_r div _line.per"))).withColumn("offset", F.col("_line.at") + F.col("length") * F.expr("_r % _line.per"))
    return placed.drop("_lines", "_line", "_r", "_rank_of_length")


def _cut(path: str, size: int):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        encoder = word_bpe(path)
        for batch in batches:
            for part in textops.pieces(batch):
                ids, counts = encoder.encode(textops.texts_of(part.column("text")))
                ends = np.cumsum(counts)
                out: list[list] = [[], [], [], [], []]
                for d, a, b in zip(part.column("doc_id").to_pylist(), ends - counts, ends, strict=True):
                    raw = ids[a:b].astype("<u4").tobytes() + b"\0\0\0\0"
                    for k in range(0, len(raw), 4 * size):
                        cut = raw[k : k + 4 * size]
                        for column, v in zip(out, (d, k // (4 * size), k // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                            column.append(v)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return run


def pieces_of(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """The pieces of docs (doc_id, text): whole documents with their end token, cut only where longer than size."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return docs.select("doc_id", "text").mapInArrow(_cut(path, size), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    packed = pack(durable(pieces_of(docs, path, size)), ["doc_id", "piece", "ids_crc32"], size)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return pack_documents(docs)
