"""Windows of words cut into super-k-mers, on whole batches of texts at a time.

The minimiser of a window of ``k`` words is the run of ``m`` words in it with the smallest hash,
the leftmost of equal ones. Neighbouring windows mostly have the same minimiser at the same
place; such a row of windows is a super-k-mer, some k + k/2 words of which k/2 begin a window.
Equal windows have equal minimisers, so they meet where super-k-mers are gathered by minimiser.
And as equal windows have theirs at equal distance, no two windows of one super-k-mer are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TEXT_BYTES = 1 << 20
_SEGMENT = 1 << 22
_PLACE_BITS = np.uint64(24)  # more than a segment has places


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers, in which every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts that lie in ``data`` behind one another, each up to one of ``ends``: a hash per
    word, and the number of words per text. Words are separated by ASCII white space."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(ends), dtype=np.int64)
    inside = ~_SPACE[data]
    begins = np.concatenate([[0], ends[:-1]])
    before = np.concatenate([[False], inside[:-1]])
    before[begins[begins < len(data)]] = False
    after = np.concatenate([inside[1:], [False]])
    after[ends[ends > 0] - 1] = False
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(int(_BASE), len(data)), dtype=np.uint64)
    low = np.where(first > 0, sums[first - 1], np.uint64(0))
    hashes = mix((sums[last] - low) * _powers(_inverse(int(_BASE)), len(data))[first])
    return hashes, np.searchsorted(first, ends) - np.searchsorted(first, begins)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash per run of ``n`` words, as many as there are places for one."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        out = (out + words[i : i + count]) * _BASE
    return mix(out)


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    low, have = keys, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def cut(words: np.ndarray, text_of: np.ndarray, k: int, m: int) -> tuple[np.ndarray, ...]:
    """Super-k-mers of hashed words: minimiser, place of the first word, number of windows."""
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, len(words) - k + 1), _SEGMENT):
        part = words[at : at + _SEGMENT + k - 1]
        runs = shingle_hashes(part, m)
        places = np.arange(len(runs), dtype=np.uint64)
        keys = (runs >> _PLACE_BITS << _PLACE_BITS) | places
        place = (_lowest(keys, k - m + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        windows = len(place)
        owner = text_of[at : at + windows]
        whole = owner == text_of[at + k - 1 : at + k - 1 + windows]
        new = np.ones(windows, dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, windows))
        kept = whole[start]
        start, count = start[kept], count[kept]
        found.append((runs[place[start]].view(np.int64), start + at, count))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def parts_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The bytes of an Arrow array of texts in parts of about a megabyte, or a single longer text:
    index of the first text, bytes, and where each text ends in them. NULL is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        stop = int(np.searchsorted(offsets, offsets[first] + _TEXT_BYTES, side="right")) - 1
        stop = min(max(stop, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[stop]], offsets[first + 1 : stop + 1] - offsets[first]
        first = stop


def superkmers(texts: pa.Array, k: int, m: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For parts of ``texts``: index of the text, minimiser, first word in the text, windows."""
    for first, data, ends in parts_of(texts):
        words, counts = hashed_words(data, ends)
        text_of = np.repeat(np.arange(len(counts)), counts)
        minimiser, start, windows = cut(words, text_of, k, m)
        owner = text_of[start]
        begins = np.cumsum(counts) - counts
        yield first + owner, minimiser, start - begins[owner], windows
