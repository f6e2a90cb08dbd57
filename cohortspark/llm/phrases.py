"""Triggers, phrases and rolling hashes of bytes, in numpy."""

from __future__ import annotations

import numpy as np

# Fixed odd multiplier of the rolling hash, and the mixing of its values.
BASE = 0xD1342543DE82EF95
GRAM = 16
_PLACE = np.uint64((1 << 24) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of any substring of a text in constant time: differences of the sums of a polynomial in its bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: bytes) -> None:
        n = len(data) + 1
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        raw = np.frombuffer(data, np.uint8).astype(np.uint64)
        raw += np.uint64(1)
        raw *= self.up[: n - 1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(raw, out=self.sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the substrings [begin, end); equal for equal bytes, wherever they are."""
        size = (end - begin).astype(np.uint64)
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin] + size * np.uint64(0x9E3779B97F4A7C15))

    def fixed(self, size: int, first: int, last: int) -> np.ndarray:
        """Hashes of all substrings of one size that begin at first .. last - 1."""
        return mix((self.sums[first + size : last + size] - self.sums[first:last]) * self.down[first:last])


def triggers(rolling: Rolling, n: int, reach: int, windows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the first `windows` starts the trigger: the place of the least hash of `GRAM` bytes among the next `reach`,
    the first of equals. Returns the places, and the first and last start that has each. What a start's trigger is depends on
    the bytes behind it alone, and triggers move ahead with the starts, so the starts of one trigger lie together."""
    values = rolling.fixed(GRAM, 0, windows + reach - 1)
    values = (values & ~_PLACE) | np.arange(len(values), dtype=np.uint64)
    rows = -(-len(values) // reach)
    grid = np.full(rows * reach, ~np.uint64(0))
    grid[: len(values)] = values
    grid = grid.reshape(rows, reach)
    ahead = np.minimum.accumulate(grid, 1).reshape(-1)  # least from the block's begin
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)  # least to the block's end
    place = (np.minimum(behind[:windows], ahead[reach - 1 : reach - 1 + windows]) & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], first, np.append(first[1:], windows) - 1
