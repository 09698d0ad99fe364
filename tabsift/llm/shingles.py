"""Word shingles as 64-bit numbers, many texts at once."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1


def _random64(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, count, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Shingler:
    """Distinct shingles of ``width`` words; A-Z in lower case, words end at space, tab to carriage return."""

    def __init__(self, width: int = 4):
        self.width = width
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.white = np.zeros(256, bool)
        self.white[[32, *range(9, 14)]] = True
        self.byte = _random64(256, 1)
        self.place = _random64(width + 1, 2) | np.uint64(1)
        self.base = 0x9E3779B97F4A7C15 | 1
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(self.base, -1, 2**64)
            self.up = np.cumprod(np.append(np.uint64(1), np.full(n, self.base, np.uint64)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(n, inverse, np.uint64)))

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A number per word of all texts, and the words before the end of each text."""
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        white = self.white[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], white, [True]]).astype(np.int8)))
        starts, stops = edge[::2], edge[1::2]
        self._powers(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.byte[self.lower[raw]] * self.up[:len(raw)], out=sums[1:])
        words = (sums[stops] - sums[starts]) * self.down[starts]
        return _mix(words + (stops - starts).astype(np.uint64)), np.searchsorted(starts, ends)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per text its distinct shingles, sorted; a text with fewer words has all of them as one."""
        words, upto = self.words(texts)
        whole = np.zeros(max(0, len(words) - self.width + 1), np.uint64)
        for k in range(self.width):
            whole += words[k:k + len(whole)] * self.place[k]
        whole = _mix(whole)
        found, begin = [], 0
        for end in upto.tolist():
            n = end - begin
            if n >= self.width:
                found.append(np.unique(whole[begin:end - self.width + 1]))
            elif n:
                few = (words[begin:end] * self.place[:n]).sum(dtype=np.uint64) + self.place[self.width] * np.uint64(n)
                found.append(_mix(np.array([few], np.uint64)))
            else:
                found.append(np.zeros(0, np.uint64))
            begin = end
        return found
