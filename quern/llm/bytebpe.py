"""Byte-level BPE by a rank queue under a hierarchical bitmap.

A pre-token's bytes form a linked list. Each merge rank has a bucket of list positions whose pair has this rank; a bitmap of three
levels of 64-bit words tells which buckets have entries, so the lowest rank is found by three find-first-set steps, however long
the pre-token is. An entry is stale when its position is gone or its pair has changed, and is skipped as it comes up. Positions of
one rank come up from left to right. Time grows with the bytes of the pre-token, apart from the order within a bucket.

Texts are cut before single spaces, where no match of the pattern crosses; a distinct chunk is encoded once per worker. A text
with runs of white space that this rule can't cut goes through the pattern as a whole.

Edge cases: a null text counts as empty, with no tokens; decoding gives back the bytes of any text; repeated rows are encoded each, with
equal ids; pairs of one rank merge from the left; a text or pre-token of any length is encoded whole; an empty table gives an empty
result; only doc_id and text are read, so other columns can have any names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from quern.llm import textops
from quern.llm.chunktable import ChunkTable, gather
from quern.llm.storage import table

#: White space of the pattern on both sides of a space, or before a space that ends the text.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CROSSED = f"{_SPACE} ({_SPACE}|$)"


_BIT = [1 << k for k in range(64)]


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self._pattern = ranks, regex.compile(pattern)
        self._longest = max(map(len, ranks))
        # the rank queue: buckets of positions, and for 64 buckets, 64 of these words, and 64 of those, a word of bits
        self._buckets: dict[int, list[int]] = {}
        self._low = [0] * ((max(ranks.values()) >> 6) + 1)
        self._mid = [0] * ((len(self._low) >> 6) + 1)
        self._known: dict[str, list[int]] = {}
        self.table = ChunkTable(self._chunk, 1_200_000)
        tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self._sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        ranks, longest, n = self.ranks.get, self._longest, len(raw)
        buckets, lows, mids, top, bit = self._buckets, self._low, self._mid, 0, _BIT
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # rank of the pair that begins at a position; -1 also for positions that are gone
        for k in range(n - 1):
            r = ranks(raw[k : k + 2])
            if r is not None:
                pair[k] = r
                bucket = buckets.get(r)
                if bucket is None:
                    buckets[r] = [k]
                    low = r >> 6
                    mid = low >> 6
                    lows[low] |= bit[r & 63]
                    mids[mid] |= bit[low & 63]
                    top |= bit[mid]
                else:
                    bucket.append(k)
        while top:
            mid = (top & -top).bit_length() - 1  # find first set, level by level
            word = mids[mid]
            low = (mid << 6) + (word & -word).bit_length() - 1
            word = lows[low]
            rank = (low << 6) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                k = heappop(bucket)
            else:
                k = bucket[0]
                del buckets[rank]
                word &= word - 1
                lows[low] = word
                if not word:
                    mids[mid] &= mids[mid] - 1
                    if not mids[mid]:
                        top &= top - 1
            if pair[k] != rank:
                continue
            gone = after[k]
            to = after[k] = after[gone]
            pair[gone] = pair[k] = -1
            left = before[k]
            if to < n:
                before[to] = k
                spots = ((k, after[to]), (left, to)) if left >= 0 else ((k, after[to]),)
            else:
                spots = ((left, to),) if left >= 0 else ()
            for spot, end in spots:
                r = ranks(raw[spot:end]) if end - spot <= longest else None
                if r is None:
                    pair[spot] = -1
                elif r != pair[spot]:
                    pair[spot] = r
                    bucket = buckets.get(r)
                    if bucket is None:
                        buckets[r] = [spot]
                        low = r >> 6
                        mid = low >> 6
                        lows[low] |= bit[r & 63]
                        mids[mid] |= bit[low & 63]
                        top |= bit[mid]
                    else:
                        heappush(bucket, spot)
        out, k = [], 0
        while k < n:
            to = after[k]
            out.append(self.ranks[raw[k:to]])
            k = to
        return out

    def _chunk(self, chunk: str) -> list[int]:
        out: list[int] = []
        known = self._known
        for piece in self._pattern.findall(chunk):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode())
                if len(piece) < 64:
                    if len(known) > 700_000:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of each text's ids."""
        self.table.fit()
        chunks = pc.split_pattern(texts, " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy())])
        flat = pc.dictionary_encode(pc.list_flatten(chunks))
        places = self.table.index([" " + c for c in flat.dictionary.to_pylist()])[flat.indices.to_numpy()] if len(flat) else np.zeros(0, dtype=np.int64)
        heads = bounds[:-1]
        places[heads] = self.table.index(flat.take(pa.array(heads)).to_pylist())
        ids, sizes = self.table.ids_of(places)
        counts = np.diff(np.concatenate([[0], np.cumsum(sizes)])[bounds])
        crossed = np.flatnonzero(pc.match_substring_regex(texts, _CROSSED).to_numpy(zero_copy_only=False))
        if len(crossed):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in crossed:
                parts[k] = np.array(self._chunk(texts[int(k)].as_py()), dtype=np.uint32)
            counts = np.array([len(p) for p in parts])
            ids = np.concatenate(parts)
        return ids, counts

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, invalid UTF-8 included."""
        return gather(self._bytes, self._starts[ids], self._sizes[ids])[0].tobytes()

    def decode_each(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text, given all ids and the number of each text's."""
        raw = self.decode(ids)
        ends = np.concatenate([[0], np.cumsum(self._sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@functools.cache
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One for each Python worker."""
    with open(path, "rb") as f:
        return ByteBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def _round_trip(path: str, pattern: str):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for part in textops.pieces(batch):
                ids, counts = bpe.encode(textops.texts_of(part.column("text")))
                ends, raw = 4 * np.cumsum(counts), ids.astype("<u4").tobytes()
                digest = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip((ends - 4 * counts).tolist(), ends.tolist(), strict=True)]
                decoded = [hashlib.sha256(own).hexdigest() for own in bpe.decode_each(ids, counts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(digest), pa.array(decoded)], names)

    return run


def round_trips(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """docs (doc_id, text) encoded, and decoded from the ids. No shuffle."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return docs.select("doc_id", "text").mapInArrow(_round_trip(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every whole text to ids and back."""
    return round_trips(table(spark, sf_dir, "documents"))
