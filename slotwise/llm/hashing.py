"""Rabin-Karp hashes of words and of runs of words, for many texts at a time."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once; a word is never cut.
BLOCK = 1 << 21
#: Stands for a null id: the smallest of all.
NO_ID = -(1 << 63)
ODD, ODD_WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of the hashes over all others (a fixed bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of values[start:end] for each pair: differences of one running sum, shifted to power 0."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(inverse(base), len(values) + 1)[starts])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    hashes, places, at = [], [], 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):  # up to the last space, or the whole of a longer word
            space = max(data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            while space < 0 and end < len(data) and not SPACE[data[end]]:
                end += 1
            end = end if space < 0 else space + 1
        block = np.frombuffer(data[at:end], np.uint8)
        edge = np.diff(np.concatenate(([True], SPACE[block], [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
        hashes.append(ranges(block.astype(np.uint64) + np.uint64(1), starts, ends, ODD))
        places.append(starts + at)
        at = end
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(places or [np.zeros(0, np.int64)])


def windows(ids: np.ndarray, texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, id and place of every window."""
    hashes, at = word_hashes(b"\n".join(texts))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(bounds, at, "right")
    n = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n) - n
    starts = np.flatnonzero(np.arange(len(doc)) + window <= (first + n)[doc])
    return ranges(hashes, starts, starts + window, ODD_WORD), ids[doc[starts]], starts - first[doc[starts]]
