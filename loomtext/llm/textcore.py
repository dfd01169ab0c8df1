"""Vectorised word-shingle hashing shared by the operators of this package.

Words are the maximal runs of word characters (the pattern \\w+) of the lower-cased text, so punctuation and case do
not count. A shingle is `size` consecutive words. Its
64-bit value depends on the words only, never on the process, the batch or the platform. A text with fewer words
than `size`, but at least one, has a single shingle of all its words; a text without words has none.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BATCH_BYTES = 300_000


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after which the worker gives the memory that it has freed back to the system: workers are reused by later stages."""

    def to_the_end(found: Iterator) -> Iterator:
        yield from run(found)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return to_the_end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Hash values to the open interval (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


_WORD_BYTES = bytes(i if i >= 128 or chr(i).isalnum() or i == 95 else 32 for i in range(256))
_WIDE_GAP = re.compile(r"[^\w\x00-\x7f]")


def flat_words(text: str | None) -> bytes:
    """The words of the lower-cased text in UTF-8, one blank between two."""
    if not text:
        return b""
    low = text.lower()
    if not low.isascii() and _WIDE_GAP.search(low):
        low = _WIDE_GAP.sub(" ", low)
    return b" ".join(low.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split())


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, _BATCH_BYTES)
        ones = np.full(size, _BASE, dtype=np.uint64)
        ones[0] = 1
        inverse = np.full(size, _INVERSE, dtype=np.uint64)
        inverse[0] = 1
        _POWERS["p"], _POWERS["q"] = np.multiply.accumulate(ones), np.multiply.accumulate(inverse)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def shingle_hashes(texts: Sequence[str | None], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, one text after the other, and the count of each text."""
    flat = [flat_words(t) for t in texts]
    counts = np.zeros(len(flat), dtype=np.int64)
    kept = [i for i, b in enumerate(flat) if b]
    if not kept:
        return np.zeros(0, dtype=np.uint64), counts
    data = np.frombuffer(b" ".join(flat[i] for i in kept) + b" ", dtype=np.uint8)
    power, inverse = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])
    ends = np.flatnonzero(data == 32)
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    text_ends = np.cumsum([len(flat[i]) + 1 for i in kept])
    last_word = np.searchsorted(ends, text_ends - 1)  # index of each text's last word
    first_word = np.concatenate(([0], last_word[:-1] + 1))
    words = last_word - first_word + 1
    per_text = np.maximum(words - size + 1, 1)
    counts[kept] = per_text
    offsets = np.concatenate(([0], np.cumsum(per_text)))
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first_word, per_text)
    stop = np.minimum(index + size - 1, np.repeat(last_word, per_text))
    s, e = starts[index], ends[stop]
    return mix((prefix[e] - prefix[s]) * inverse[s]), counts


def batches(texts: Sequence[str | None], limit: int = _BATCH_BYTES) -> Iterator[slice]:
    """Cuts a sequence of texts so that a piece has about `limit` characters at most, or a single text."""
    begin = used = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if used and used + n > limit:
            yield slice(begin, i)
            begin, used = i, 0
        used += n
    if begin < len(texts):
        yield slice(begin, len(texts))


def multiset(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of two multisets; 0 when both are empty."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 0.0
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][ia], b[1][ib]).sum())
    return common / (total - common)
