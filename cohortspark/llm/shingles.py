"""Word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20  # bytes hashed at a time; the arrays of a worker take some 60 times as much

# Fixed odd multipliers: bytes of a word, words of a shingle, final mixing.
BASE = 0x9E3779B97F4A7C15
PLACES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(PLACES[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(PLACES[1])
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes of the blank-separated words of lower-cased bytes: a polynomial in the bytes, by differences of its sums."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(BASE, -1, 1 << 64)
            for name, base in (("up", BASE), ("down", inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def block(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of each word."""
        raw = np.frombuffer(data, np.uint8)
        inside = ~_BLANK[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        begin, end = edge[::2], edge[1::2]
        self._powers(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=sums[1:])
        return mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64)), begin

    def words(self, data: bytes) -> np.ndarray:
        """Hashes of the words of one text of any length."""
        parts, at = [], 0
        while len(data) - at > BLOCK:
            to = at + BLOCK
            while to < len(data) and data[to] not in b" \t\n\v\f\r":
                to += 1
            parts.append(self.block(data[at:to])[0])
            at = to
        parts.append(self.block(data[at:])[0])
        return np.concatenate(parts)


def shingle_sets(texts: list[bytes | None], hasher: WordHasher, size: int = 5) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted. Fewer words than `size` make one shingle; no words none."""
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + len(texts[to] or b"") < BLOCK):
            total += len(texts[to] or b"") + 1
            to += 1
        own = [(t or b"").lower() for t in texts[at:to]]
        if len(own) == 1:
            words = hasher.words(own[0])
            bounds = np.array([0, len(words)])
        else:
            words, begin = hasher.block(b"\n".join(own))
            bounds = np.searchsorted(begin, np.concatenate([[0], np.cumsum([len(t) + 1 for t in own])]))
        count = max(0, len(words) - size + 1)
        every = np.full(count, size, np.uint64)
        for k in range(size):
            every += words[k : k + count] * np.uint64(PLACES[k % len(PLACES)] ^ (k // len(PLACES)))
        every = mix(every)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= size:
                yield distinct(every[a : b - size + 1])
            elif b > a:
                one = np.uint64(b - a)
                with np.errstate(over="ignore"):
                    for k in range(b - a):
                        one += words[a + k] * np.uint64(PLACES[k % len(PLACES)] ^ (k // len(PLACES)))
                yield mix(np.array([one], np.uint64))
            else:
                yield words[:0]
        at = to


def distinct(values: np.ndarray) -> np.ndarray:
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
