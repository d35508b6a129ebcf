"""Token ids of the word-end BPE vocabulary, as the `tokenizers` library gives them, at several times its speed.

Texts are cut at white space, which no token of this vocabulary crosses, and each distinct chunk is encoded once per worker.
Chunks of plain letters run the merges here, all new words of a piece of text together; a text or chunk with anything unusual goes to the
library itself.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from quern.llm.chunktable import gather

_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Characters up to here have the same classes in all versions of Unicode; separators of other kinds and marks lie beyond.
_PLAIN = re.compile("[!-~¡-ɏ]+")


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(more)
            more += 1
    return [out[b] for b in range(256)]


_NONE = 1 << 30
#: Words of more bytes go to the library, whose queue is faster there.
_LONG = 96


class WordBpe:
    """Texts become chunks, chunks words, words ids. What is new in a piece of text is merged for all its words at once."""

    def __init__(self, path: str, limit: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        letters = _byte_letters()
        self._inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self._last = np.array([vocab[c + "</w>"] for c in letters], dtype=np.int64)
        ranks: dict[int, int] = {}  # rank of a pair of ids
        merged = []  # id that a rank makes
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ranks.setdefault(vocab[a] << 20 | vocab[b], rank)
            merged.append(vocab[a + b])
        self._pairs = PairTable(ranks)
        self._merged = np.array(merged, dtype=np.int64)
        self._limit = limit
        self._clear()

    def _clear(self) -> None:
        self._chunks: dict[str, int] = {}
        self._chunk_words, self._chunk_starts = array("q"), array("q", [0])
        self._words: dict[str, int] = {}
        self._ids, self._starts = array("I"), array("q", [0])

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of each word's ids.

        In each round every word that still has a pair with a rank merges its leftmost pair of the lowest rank; words without one are done.
        """
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self._inner[data]
        ends = np.cumsum(sizes)
        ids[ends - 1] = self._last[data[ends - 1]]
        ranks = np.full(len(ids), _NONE, dtype=np.int64)
        ranks[:-1] = self._pairs(ids[:-1], ids[1:])
        ranks[ends - 1] = _NONE
        which, total = np.arange(len(words)), sizes.copy()
        done_ids, done_which = [], []
        while len(which):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, starts)
            live = least != _NONE
            if not live.all():
                stays = np.repeat(live, sizes)
                done_ids.append(ids[~stays])
                done_which.append(which[~live])
                total[which[~live]] = sizes[~live]
                ids, ranks, which, sizes, least = ids[stays], ranks[stays], which[live], sizes[live], least[live]
                if not len(which):
                    break
                starts = np.cumsum(sizes) - sizes
            spots = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = spots[np.searchsorted(spots, starts)]  # the first of each word
            ids[at] = self._merged[least]
            stays = np.ones(len(ids), dtype=bool)
            stays[at + 1] = False
            ids, ranks = ids[stays], ranks[stays]
            shift = np.arange(len(at))
            at, starts, sizes = at - shift, starts - shift, sizes - 1
            ranks[at] = _NONE
            right = at[at + 1 < starts + sizes]
            ranks[right] = self._pairs(ids[right], ids[right + 1])
            left = at[at > starts] - 1
            ranks[left] = self._pairs(ids[left], ids[left + 1])
        flat, order = np.concatenate(done_ids), np.concatenate(done_which)
        at = np.empty(len(words), dtype=np.int64)
        ended = np.cumsum(total[order])
        at[order] = ended - total[order]
        return gather(flat, at, total)

    def _spell(self, chunk: str) -> tuple[str, ...]:
        """The words of a chunk; one the rule here doesn't cover is a word of its own, marked."""
        low = chunk.lower()
        if low.isascii():
            if low.isalpha():
                return (low,)
            if low[:-1].isalpha() and low[-1] in ".,;:!?|":
                return (low[:-1], low[-1])
        if not _PLAIN.fullmatch(chunk):
            return ("\0" + chunk,)
        return (low,) if low.isalpha() else tuple(_SPLIT.findall(low))

    def _learn(self, chunks: list[str]) -> None:
        """Adds chunks that aren't known yet."""
        words, new = self._words, []
        for c in chunks:
            self._chunks[c] = len(self._chunk_starts) - 1
            for w in self._spell(c):
                k = words.get(w)
                if k is None:
                    k = words[w] = len(words)
                    new.append(w)
                self._chunk_words.append(k)
            self._chunk_starts.append(len(self._chunk_words))
        if not new:
            return
        raw = [w.encode() for w in new]
        own = [k for k, (w, r) in enumerate(zip(new, raw, strict=True)) if w[0] == "\0" or len(r) > _LONG]  # the library's
        told = dict(zip(own, (e.ids for e in self.library.encode_batch([new[k].removeprefix("\0") for k in own], add_special_tokens=False)), strict=True)) if own else {}
        rest = [k for k in range(len(new)) if k not in told]
        if rest:
            ids, sizes = self.merged([raw[k] for k in rest])
        if not told:
            self._ids.frombytes(ids.astype(np.uint32).tobytes())
            self._starts.frombytes((np.cumsum(sizes) + self._starts[-1]).astype(np.int64).tobytes())
            return
        parts = dict(zip(rest, np.split(ids, np.cumsum(sizes)[:-1]), strict=True)) if rest else {}
        for k in range(len(new)):
            self._ids.extend(told[k] if k in told else parts[k].tolist())
            self._starts.append(len(self._ids))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of each text's ids."""
        if len(self._chunks) > self._limit or len(self._ids) > 8 * self._limit:
            self._clear()
        chunks = pc.utf8_split_whitespace(texts)
        flat = pc.dictionary_encode(pc.list_flatten(chunks))
        flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
        named, known = flat.dictionary.to_pylist(), self._chunks
        if new := [c for c in named if c not in known]:
            self._learn(new)
        places = np.fromiter((known[c] for c in named), np.int64, len(named))[flat.indices.to_numpy()] if len(flat) else np.zeros(0, dtype=np.int64)
        starts = np.frombuffer(self._chunk_starts, dtype=np.int64)  # views: gone before the arrays grow again
        words, per_chunk = gather(np.frombuffer(self._chunk_words, dtype=np.int64), starts[places], starts[places + 1] - starts[places])
        starts = np.frombuffer(self._starts, dtype=np.int64)
        ids, per_word = gather(np.frombuffer(self._ids, dtype=np.uint32), starts[words], starts[words + 1] - starts[words])
        word_ends = np.concatenate([[0], np.cumsum(per_word)])
        ends = word_ends[np.concatenate([[0], np.cumsum(per_chunk)])]
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy())])
        counts = np.diff(ends[bounds])
        odd = np.flatnonzero(pc.match_substring_regex(texts, "[\\x1c-\\x1f]|<\\|(?:start|end)oftext\\|>").to_numpy(zero_copy_only=False))
        if len(odd):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in odd:
                parts[k] = np.array(self.library.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
            counts = np.array([len(p) for p in parts])
            ids = np.concatenate(parts)
        return ids, counts


class PairTable:
    """Ranks of pairs of ids, for arrays of pairs at once: a table by hash, and a sorted list for the pairs that share a slot."""

    def __init__(self, ranks: dict[int, int], bits: int = 19):
        keys = np.array(sorted(ranks), dtype=np.int64)
        values = np.array([ranks[int(k)] for k in keys], dtype=np.int64)
        self._shift = np.uint64(64 - bits)
        slots = self._slot(keys)
        self._key = np.full(1 << bits, -1, dtype=np.int64)
        self._rank = np.full(1 << bits, _NONE, dtype=np.int64)
        first = np.unique(slots, return_index=True)[1]
        self._key[slots[first]], self._rank[slots[first]] = keys[first], values[first]
        more = np.setdiff1d(np.arange(len(keys)), first)
        self._more, self._more_rank = keys[more], values[more]  # sorted
        self._full = np.zeros(1 << bits, dtype=bool)
        self._full[slots[more]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 20 | b
        slot = self._slot(keys)
        hit = self._key[slot] == keys
        out = np.where(hit, self._rank[slot], _NONE)
        if len(rest := np.flatnonzero(~hit & self._full[slot])):
            at = np.minimum(np.searchsorted(self._more, keys[rest]), len(self._more) - 1)
            found = self._more[at] == keys[rest]
            out[rest[found]] = self._more_rank[at[found]]
        return out


@functools.cache
def word_bpe(path: str) -> WordBpe:
    """One for each Python worker."""
    return WordBpe(path)


__all__ = ["WordBpe", "word_bpe"]
