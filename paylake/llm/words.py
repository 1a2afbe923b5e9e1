"""Words of many texts at once, as places and hashes over one byte buffer."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_ASCII = np.arange(256)
UPPER = (_ASCII >= 0x41) & (_ASCII <= 0x5A)
LOWERED = np.where(UPPER, _ASCII + 32, _ASCII).astype(np.uint8)
# Digits, ASCII letters and every byte of a character above ASCII.
WORD_BYTE = ((_ASCII >= 0x30) & (_ASCII <= 0x39)) | UPPER | ((_ASCII >= 0x61) & (_ASCII <= 0x7A)) | (_ASCII >= 0x80)

_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


class Words:
    """Word places of texts that lie behind each other in ``flat``, text i from ``places[i]`` on.

    ``start`` and ``end`` are byte places, ``first`` is the number of words before each text
    (one more entry than texts), ``hash`` is a 64-bit hash of the lower-cased bytes.
    """

    def __init__(self, flat: np.ndarray, places: np.ndarray):
        self.lowered = LOWERED[flat]
        inside = WORD_BYTE[flat]
        before = np.zeros(len(flat), bool)
        before[1:] = inside[:-1]
        begins = places[:-1][places[:-1] < len(flat)]
        before[begins] = False
        behind = np.zeros(len(flat), bool)
        behind[:-1] = inside[1:]
        stops = places[1:][places[1:] > 0] - 1
        behind[stops] = False
        self.inside = inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~behind) + 1
        self.first = np.searchsorted(self.start, places)
        up, down = _powers(1 << max(20, int(len(flat)).bit_length()))
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(np.where(inside, _VALUES[self.lowered], 0) * up[: len(flat)], out=sums[1:])
        self.hash = (sums[self.end] - sums[self.start]) * down[self.start]

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one blank between them, and where each word begins and ends there."""
        gap = np.zeros(len(self.inside), bool)
        after = self.end[self.end < len(gap)]
        gap[after] = True
        gap &= ~self.inside  # a text may begin with a word right behind the last one
        keep = self.inside | gap
        place = np.cumsum(keep) - keep
        compact = np.where(self.inside, self.lowered, 0x20).astype(np.uint8)[keep].tobytes()
        begin = place[self.start]
        return compact, begin, begin + (self.end - self.start)
