"""Words, word hashes and shingle hashes of many texts at once, on the bytes of Arrow string columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text handled at once; a longer text is handled alone.
PIECE_BYTES = 2 << 20

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
#: Words longer than this are hashed one by one.
_LONG_WORD = 1024

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in the ranges, ends included."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words `[^\\x20\\x09-\\x0D]+`.
SPACE_WORDS = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lowered.
ALNUM_WORDS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def texts_of(column) -> pa.Array:
    """The column as strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()) if column.type != pa.string() else column, "")


def pieces(batch: pa.RecordBatch, column: str = "text", bytes_at_once: int = PIECE_BYTES):
    """Parts of the batch with about bytes_at_once of text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + bytes_at_once, "right")))
        yield batch.slice(at, to - at)
        at = to


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text starts (one more: the end)."""
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of texts: starts, ends (bytes), doc (index of the text), first (index of each text's first word; one more: the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        """data should be lowered already where that matters."""
        word = inside[data]
        starts, ends = word.copy(), word.copy()
        if len(data):
            starts[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            edges = offsets[1:-1]
            edges = edges[(edges > 0) & (edges < len(data))]
            starts[edges] = word[edges]
            ends[edges - 1] = word[edges - 1]
        self.data = data
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def bytes_at(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()

    def hashes(self) -> np.ndarray:
        """64 bits for each word, from its bytes."""
        size = (self.ends - self.starts).astype(np.uint64)
        h = size * _C2
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        eight = np.ndarray(len(self.data) + 1, dtype="<u8", buffer=padded, strides=(1,))
        live, at, left = np.flatnonzero(size <= _LONG_WORD), self.starts, size.astype(np.int64)
        for k in np.flatnonzero(size > _LONG_WORD):
            h[k] = xxhash.xxh3_64_intdigest(self.data[self.starts[k] : self.ends[k]])
        step = 0
        while len(live):
            block = eight[at[live] + step] & _MASKS[np.minimum(left[live] - step, 8)]
            x = (h[live] ^ block) * _C1
            h[live] = x ^ (x >> np.uint64(29))
            step += 8
            live = live[left[live] > step]
        return mixed(h)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose results look independent."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles text after text, and where each text's begin (one more: the end).

    A text with 1 to n - 1 words has its whole sequence as the one shingle; without words it has none. Repeated shingles stay.
    """
    h, count = words.hashes(), np.diff(words.first)
    have = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(have)])
    out = np.empty(begin[-1], dtype=np.uint64)
    long = count >= n
    if long.any():
        docs = np.flatnonzero(long)
        size = have[docs]
        at = np.repeat(words.first[docs] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        x = h[at]
        for k in range(1, n):
            x = (x * _C1 + h[at + k]) ^ (x >> np.uint64(31))
        to = np.repeat(begin[docs] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        out[to] = x
    for d in np.flatnonzero((count > 0) & ~long):
        x = np.uint64(0x51ED270B)
        for k in range(words.first[d], words.first[d + 1]):
            x = np.uint64((int(x) * int(_C1) + int(h[k])) & 0xFFFFFFFFFFFFFFFF) ^ (x >> np.uint64(31))
        out[begin[d]] = x ^ np.uint64(count[d])
    return mixed(out), begin


def text_shingles(texts: pa.Array, n: int, inside: np.ndarray = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """shingles() of texts with A-Z lowered."""
    data, offsets = bytes_of(texts)
    return shingles(Words(LOWER[data], offsets, inside), n)
