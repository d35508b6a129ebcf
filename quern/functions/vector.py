"""Arrow-batched functions for what no built-in expression does: LZ4 sizes, SimHash, edit similarity of tokens."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MIB = 1 << 20


@F.pandas_udf(T.DoubleType())
def lz4_ratio(texts: pd.Series) -> pd.Series:
    """LZ4 block bytes over the bytes of the first MiB; an empty text has no size to compare with."""

    def one(text: str | None) -> float | None:
        if text is None:
            return None
        raw = text.encode()[:_MIB]
        return len(pa.compress(raw, codec="lz4_raw", asbytes=True)) / len(raw) if raw else float("inf")

    return texts.map(one).astype("float64")


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose results look independent."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _mix(h: np.ndarray) -> np.ndarray:
    """_mixed() in place."""
    shifted = np.empty_like(h)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, None):
        h ^= np.right_shift(h, np.uint64(33), out=shifted)
        if factor is not None:
            h *= np.uint64(factor)
    return h


def char_gram_hashes(text: str, shortest: int, longest: int, seed: int = 0) -> np.ndarray:
    """64 bits for each character n-gram of the orders, in no line's end."""
    out = []
    for line in text.split("\n"):
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        for n in range(shortest, longest + 1):
            size = len(codes) - n + 1
            if size > 0:
                h = np.full(size, n + 16 * seed, dtype=np.uint64)
                for k in range(n):
                    h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + size])
                out.append(h)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def simhash_words(text: str, orders: tuple[int, int] = (2, 4), seed: int = 0) -> tuple[int, int]:
    """128 bits as two signed longs: the sign of a sum of random signs over all character n-grams of the orders."""
    h = char_gram_hashes(text, *orders, seed)
    if not len(h):
        h = _mixed(np.array([xxhash.xxh3_64_intdigest(text.encode(), seed=seed)], dtype=np.uint64))
    raw = np.stack([h, _mixed(h ^ np.uint64(0xD1B54A32D192ED03))], axis=1).view(np.uint8).reshape(len(h), 16)
    total = np.zeros(128, dtype=np.int64)
    for at in range(0, len(h), 4096):
        total += np.unpackbits(raw[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    high, low = np.packbits(2 * total > len(h)).view(">i8")
    return int(high), int(low)


#: Places of a text's characters are padded to whole blocks; so many places are worked on at once, to stay in the cache.
_BLOCK, _STRIP = 16, 1 << 15


class _Laid:
    """Texts laid out one after the other: code points, each text followed by line breaks up to a whole block."""

    def __init__(self, texts: list[str]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        blocks = sizes // _BLOCK + 1
        self.count, self.text_of = len(texts), np.repeat(np.arange(len(texts)), blocks)
        padded = "".join([t + "\n" * int(n) for t, n in zip(texts, blocks * _BLOCK - sizes, strict=True)])
        self.codes = np.frombuffer((padded + "\n" * 4).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def strips(self, shortest: int, longest: int, seed: int = 0):
        """For strips of whole blocks: the text of each block and, for each order, the n-grams' hashes by their first place and whether there is one there."""
        whole = len(self.text_of) * _BLOCK
        for at in range(0, whole, _STRIP):
            end = min(at + _STRIP, whole)
            part = self.codes[at : end + longest - 1]
            codes, inside = part.astype(np.uint64) + np.uint64(1), part != 10
            grams = []
            for n in range(shortest, longest + 1):
                h, there = np.full(end - at, n + 16 * seed, dtype=np.uint64), np.ones(end - at, dtype=bool)
                for k in range(n):
                    h *= np.uint64(0x9E3779B97F4A7C15)
                    h += codes[k : k + end - at]
                    _mix(h)
                    there &= inside[k : k + end - at]
                grams.append((h, there))
            yield self.text_of[at // _BLOCK : end // _BLOCK], grams


def _starts(sorted_ids: np.ndarray) -> np.ndarray:
    """Where runs of equal ids begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]])) if len(sorted_ids) else np.zeros(0, dtype=np.int64)


def _full(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bits, in each bit of the words."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def _block_counts(words: list[np.ndarray]) -> np.ndarray:
    """How often each of the 64 bits is set in the words of a block's places, over all the arrays (three)."""
    planes = list(_full(*words))
    for _ in range(_BLOCK.bit_length() - 1):
        a, b = [p[0::2] for p in planes], [p[1::2] for p in planes]
        made, carry = [a[0] ^ b[0]], a[0] & b[0]
        for x, y in zip(a[1:], b[1:], strict=True):
            one, carry = _full(x, y, carry)
            made.append(one)
        planes = [*made, carry]
    total = np.zeros((len(planes[0]), 64), dtype=np.uint8)
    for k, p in enumerate(planes):
        total += np.unpackbits(p.view(np.uint8).reshape(-1, 8), axis=1) << np.uint8(k)
    return total


def simhashes(texts: list[str]) -> np.ndarray:
    """simhash_words() of each text, as rows of two."""
    laid = _Laid(texts)
    ones, count = np.zeros((laid.count, 128), dtype=np.int64), np.zeros(laid.count, dtype=np.int64)
    for text_of, grams in laid.strips(2, 4):
        begin = _starts(text_of)
        for h, there in grams:
            count[text_of[begin]] += np.add.reduceat(there.reshape(-1, _BLOCK).sum(axis=1), begin)
        masks = [-there.astype(np.int64).view(np.uint64) for _, there in grams]
        firsts = [h & m for (h, _), m in zip(grams, masks, strict=True)]
        seconds = [_mix(h ^ np.uint64(0xD1B54A32D192ED03)) & m for (h, _), m in zip(grams, masks, strict=True)]
        for side, words in enumerate((firsts, seconds)):
            ones[text_of[begin], 64 * side : 64 * side + 64] += np.add.reduceat(_block_counts(words), begin, axis=0, dtype=np.int64)
    out = np.packbits(2 * ones > count[:, None], axis=1).view(">i8").astype(np.int64).reshape(-1, 2)
    for k in np.flatnonzero(count == 0):
        out[k] = simhash_words(texts[k])
    return out


@F.pandas_udf(T.StructType([T.StructField("high", T.LongType()), T.StructField("low", T.LongType())]))
def simhash(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(simhashes([t or "" for t in texts]), columns=["high", "low"], dtype="int64")


@functools.cache
def _family(count: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(count)).integers(0, 2**63, (count, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash_bytes(text: str, orders: tuple[int, int] = (3, 4), count: int = 32) -> bytes:
    """A byte for each of `count` MinHash values of the text's character n-grams; zeros without n-grams."""
    h = np.unique(char_gram_hashes(text, *orders))
    if not len(h):
        return bytes(count)
    family = _family(count)
    least = np.array([(h * a + b).min() for a, b in family], dtype=np.uint64)
    return (_mixed(least) >> np.uint64(56)).astype(np.uint8).tobytes()


def sketches(texts: list[str], count: int = 32) -> np.ndarray:
    """minhash_bytes() of each text, as rows."""
    laid, family = _Laid(texts), _family(count)
    least, some = np.full((count, laid.count), 2**64 - 1, dtype=np.uint64), np.zeros(laid.count, dtype=bool)
    value = np.empty(_STRIP, dtype=np.uint64)
    for text_of, grams in laid.strips(3, 4):
        for h, there in grams:
            h, text = h[there], np.repeat(text_of, there.reshape(-1, _BLOCK).sum(axis=1))
            if not len(h):
                continue
            begin = _starts(text)
            text = text[begin]
            some[text] = True
            v = value[: len(h)]
            for k, (a, b) in enumerate(family):
                np.multiply(h, a, out=v)
                v += b
                least[k, text] = np.minimum(least[k, text], np.minimum.reduceat(v, begin))
    return np.where(some[:, None], (_mix(least) >> np.uint64(56)).astype(np.uint8).T, np.uint8(0))


@F.pandas_udf(T.StructType([T.StructField(f"s{k}", T.LongType()) for k in range(4)]))
def gram_sketch(texts: pd.Series) -> pd.DataFrame:
    """The 32 bytes as four longs."""
    made = np.ascontiguousarray(sketches([t or "" for t in texts])).view(np.int64)
    return pd.DataFrame(made, columns=[f"s{k}" for k in range(4)])


def _packed_grams(text: str, shortest: int, longest: int) -> np.ndarray | None:
    """The distinct n-grams of up to four characters as sorted numbers; None if a character needs more than 16 bits."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(codes) and codes.max() >= 0xFFFF:
        return None
    codes, grams = codes.astype(np.uint64) + np.uint64(1), []
    for n in range(shortest, longest + 1):
        size = len(codes) - n + 1
        if size > 0:
            g = codes[:size].copy()
            for k in range(1, n):
                g <<= np.uint64(16)
                g |= codes[k : k + size]
            grams.append(g)
    every = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
    every.sort()
    return every[_starts(every)]


def gram_jaccard(a: str, b: str, shortest: int, longest: int, known: dict | None = None) -> float:
    """Of the sets of character n-grams; 0 if both are empty."""
    sets = []
    for t in (a, b):
        kept = None if known is None else known.get((t, shortest))
        if kept is None:
            kept = _packed_grams(t, shortest, longest)
            if known is not None:
                known[t, shortest] = kept
        sets.append(kept)
    x, y = sets
    if x is None or y is None:
        x, y = ({t[i : i + n] for n in range(shortest, longest + 1) for i in range(len(t) - n + 1)} for t in (a, b))
        both = len(x & y)
    else:
        met = np.concatenate([x, y])
        met.sort()
        both = int(np.count_nonzero(met[1:] == met[:-1]))
    union = len(x) + len(y) - both
    return both / union if union else 0.0


@F.pandas_udf(T.DoubleType())
def pair_jaccard(a: pd.Series, b: pd.Series, shortest: pd.Series, longest: pd.Series) -> pd.Series:
    """gram_jaccard() of each pair; texts that come again in a batch are cut once."""
    known: dict = {}
    return pd.Series([gram_jaccard(*p, known) for p in zip(a, b, shortest, longest, strict=True)], dtype="float64")


def edit_distance(a: list[str], b: list[str]) -> int:
    """Levenshtein over tokens: what both begin and end with goes, then a row of the table is two whole numbers of a bit for each token of b."""
    start, most = 0, min(len(a), len(b))
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return max(len(a), len(b))
    places: dict[str, int] = {}
    for k, t in enumerate(b):
        places[t] = places.get(t, 0) | 1 << k
    every, last, found = (1 << len(b)) - 1, 1 << (len(b) - 1), len(b)
    more, less = every, 0  # where the row goes up by one, and down
    for t in a:
        equal = places.get(t, 0)
        down = equal | less
        same = (((equal & more) + more) ^ more) | equal
        up, back = less | (every & ~(same | more)), more & same
        found += bool(up & last) - bool(back & last)
        up, back = (up << 1 | 1) & every, back << 1 & every
        more, less = back | (every & ~(down | up)), up & down
    return found


@F.pandas_udf(T.DoubleType())
def edit_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 - distance / longer length, of arrays of tokens; 1 for two empty ones."""
    return pd.Series([1.0 if not (longest := max(len(x), len(y))) else 1 - edit_distance(list(x), list(y)) / longest for x, y in zip(a, b, strict=True)], dtype="float64")


def matching_bits(a: str, b: str) -> Column:
    """Of two simhash() columns."""
    equal = lambda part: F.bit_count(F.bitwise_not(F.col(f"{a}.{part}").bitwiseXOR(F.col(f"{b}.{part}"))))
    return equal("high") + equal("low")
