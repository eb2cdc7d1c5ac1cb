"""Words of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Hashes are two polynomials in the bytes (Rabin-Karp) modulo the prime 2**31 - 1, joined and mixed, so
equal words have equal hashes on every machine. Two different words of n bytes agree for at most n of the
2**31 bases in each polynomial; no pattern of letters makes them agree whatever the base is, as it does modulo a power of two.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tillroll.llm.common import utf8

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LETTERS = LOWER.copy()
LETTERS[[i for i in range(128) if not chr(i).isalnum()]] = 0x20

PRIME = (1 << 31) - 1
STEP = 0xD1B54A32D192ED03
DRAW = np.random.Generator(np.random.PCG64(20240501))
SYMBOLS = DRAW.integers(1, PRIME, (2, 256), dtype=np.uint64)  # what a byte counts in each polynomial
BYTES_AT_A_TIME = 1_000_000  # hashed together; one longer text is hashed alone


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits; no two inputs share an output."""
    h = h.copy()
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def reduced(x: np.ndarray) -> np.ndarray:
    """The same numbers modulo the prime, below 2**31 + 5."""
    for _ in range(2):
        x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return x


class Powers:
    """Powers of a number and of its inverse modulo the prime, kept up to the longest length asked for."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, PRIME)
        self.kept = [np.ones(1, np.uint32)] * 2

    def of(self, n: int) -> list[np.ndarray]:
        if len(self.kept[0]) >= n:
            return [k[:n] for k in self.kept]
        found = []
        for base, line in zip(self.bases, self.kept):
            while len(line) < n:  # each step doubles the line
                more = reduced(line[: n - len(line)].astype(np.uint64) * np.uint64(pow(base, len(line), PRIME)))
                line = np.concatenate((line, np.where(more >= PRIME, more - np.uint64(PRIME), more).astype(np.uint32)))
            found.append(line)
        if n <= 1 << 23:  # longer ones, of a very long text, are not worth keeping
            self.kept = found
        return [k[:n] for k in found]


BYTE_POWERS, WORD_POWERS = ([Powers(int(b)) for b in DRAW.integers(1 << 24, PRIME, 2)] for _ in range(2))


def span_hashes(lanes, powers: list[Powers], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values from start to end for each pair; ``lanes`` has the values of each polynomial."""
    joined = np.zeros(len(starts), np.uint64)
    for values, lane in zip(lanes, powers):
        up, down = lane.of(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)  # sums of the values before each place, times the place's power
        np.cumsum(reduced(values * up[:-1]), dtype=np.uint64, out=total[1:])
        # a difference of sums, shifted to place zero
        found = reduced(reduced(total[ends] - total[starts]) * down[starts])
        joined = (joined << np.uint64(31)) | np.where(found >= PRIME, found - np.uint64(PRIME), found)
    return mixed(mixed(joined) + (ends - starts).astype(np.uint64))


def runs(values: np.ndarray, powers: list[Powers], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of 64-bit values; each polynomial takes other bits of a value."""
    lanes = [(values & np.uint64(PRIME)) + np.uint64(1), ((values >> np.uint64(32)) & np.uint64(PRIME)) + np.uint64(1)]
    return span_hashes(lanes, powers, starts, ends)


def byte_hashes(body: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes; the runs ascend and none leaves its text."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + BYTES_AT_A_TIME, side="right")) - 1)
        first, last = bounds[low], bounds[high]
        mine = slice(*np.searchsorted(starts, (first, last)))
        piece = body[first:last]
        out[mine] = span_hashes((table[piece] for table in SYMBOLS), BYTE_POWERS, starts[mine] - first, ends[mine] - first)
        low = high
    return out


@dataclass
class Words:
    """Words of a run of texts, in order."""

    starts: np.ndarray  # byte positions in all texts on end
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]
    body: np.ndarray  # the bytes of all texts
    texts: np.ndarray  # and where each text starts

    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words are longer than ``size`` bytes, and the hashes of their beginnings."""
        return next(self.all_beginnings([size]))

    def all_beginnings(self, sizes: Sequence[int]):
        """For each size: which words are longer than so many bytes, and the hashes of their beginnings.

        All sizes are hashed in one pass over the bytes.
        """
        longer = [np.flatnonzero(self.ends - self.starts > size) for size in sizes]
        counts = [len(which) for which in longer]
        starts = self.starts[np.concatenate(longer)]
        order = np.argsort(starts, kind="stable")
        first, last = starts[order], (starts + np.repeat(sizes, counts))[order]
        hashes = np.empty(len(starts), np.uint64)
        hashes[order] = mixed(byte_hashes(self.body, self.texts, first, last) + np.uint64(STEP))
        return zip(longer, np.split(hashes, np.cumsum(counts)[:-1]))


def words(texts: pa.Array, lower: bool = False, letters: bool = False) -> Words:
    """Words of each text; with A-Z lower-cased, or also without ASCII punctuation."""
    body, bounds = utf8(texts)
    if letters:
        body = LETTERS[body]
    elif lower:
        body = LOWER[body]
    inside = np.zeros(len(body) + 1, bool)
    np.logical_not(IS_SPACE[body], out=inside[:-1])
    edge = np.zeros(len(body) + 1, bool)  # a text starts here, so a word cannot go on
    edge[bounds] = True
    starts = np.flatnonzero(inside[:-1] & (edge[:-1] | ~np.concatenate(([False], inside[:-2])))) if len(body) else np.empty(0, np.int64)
    ends = np.flatnonzero(inside[:-1] & (edge[1:] | ~inside[1:])) + 1 if len(body) else np.empty(0, np.int64)
    hashes = byte_hashes(body, bounds, starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, bounds), body, bounds)
