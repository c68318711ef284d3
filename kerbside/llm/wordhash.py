"""Word positions and 64-bit hashes of many texts at once, with numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
# Bytes whose prefix sums are held at once.
_CHUNK = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x ^= x >> np.uint64(29)
        x *= _BASE
        x ^= x >> np.uint64(32)
        return x


def word_hashes(texts: Sequence[bytes], most_bytes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of every text in order, number of words per text).

    A word's hash is a polynomial of its bytes, taken from prefix sums, then
    mixed; equal words have equal hashes in every process. With ``most_bytes``
    only that many bytes from a word's start count. The sums, several numbers a
    byte, start anew every ``_CHUNK`` bytes or word longer than that: the hash
    does not depend on where they start.
    """
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts]) if len(texts) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    if most_bytes:
        ends = np.minimum(ends, starts + most_bytes)
    hashes = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return hashes, counts
    cuts = np.unique([*np.searchsorted(starts, np.arange(0, len(data), _CHUNK)).tolist(), len(starts)])
    longest = int((ends[cuts[1:] - 1] - starts[cuts[:-1]]).max())
    with np.errstate(over="ignore"):
        powers = np.full(longest + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        back = np.full(longest + 1, _INVERSE, dtype=np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        sums = np.zeros(longest + 1, dtype=np.uint64)
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            origin = starts[first]
            start, end = starts[first:last] - origin, ends[first:last] - origin
            size = int(end[-1])
            own = data[origin : origin + size].astype(np.uint64)
            own += np.uint64(1)
            own *= powers[:size]
            np.cumsum(own, out=sums[1 : size + 1])
            hashes[first:last] = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    return hashes, counts


def windows_of(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words inside a text, its first word's place, runs per text).

    A text with fewer words, but some, has one run that holds them all.
    """
    per_text = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text_starts = np.cumsum(counts) - counts
    run_starts = np.cumsum(per_text) - per_text
    places = np.arange(int(per_text.sum())) - np.repeat(run_starts - text_starts, per_text)
    words_left = np.repeat(text_starts + counts, per_text) - places
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    runs = np.zeros(len(places), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            word = np.where(words_left > j, padded[places + j], np.uint64(0))
            runs = runs * _BASE + word
    return mix(runs), places, per_text
