"""Words of many texts at once, as numpy arrays inside tasks.

The texts of a piece stand in one byte buffer, separated by newlines, which are no part of any word.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)

#: Bytes of a word between white space, and of an alphanumeric one (digits, a-z, all beyond ASCII).
SPACED = np.array([not (b == 0x20 or 9 <= b <= 13) for b in range(256)])
PLAIN = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Texts:
    """The texts of one piece; None counts as empty."""

    def __init__(self, texts: list[bytes | None], word: np.ndarray = SPACED, lower: bool = False):
        texts = [t or b"" for t in texts]
        self.count = len(texts)
        buffer = np.frombuffer(b"\n".join(texts), np.uint8)
        self.buffer = LOWER[buffer] if lower else buffer
        lengths = np.fromiter(map(len, texts), np.int64, self.count)
        self.ends = np.cumsum(lengths + 1) - 1
        self.begins = self.ends - lengths
        self.inside = word[self.buffer]
        edge = np.flatnonzero(np.diff(self.inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.starts, self.stops = edge[0::2], edge[1::2]
        #: Document of each word.
        self.doc = np.searchsorted(self.ends, self.starts, side="right")

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.count).astype(np.int64)

    def count_bytes(self, wanted: np.ndarray) -> np.ndarray:
        """How many positions of each text are wanted."""
        sums = np.concatenate(([0], np.cumsum(wanted, dtype=np.int64)))
        return sums[self.ends] - sums[self.begins]

    def hashes(self, starts: np.ndarray | None = None, stops: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each word, or of the given non-empty stretches, which do not overlap."""
        starts = self.starts if starts is None else starts
        stops = self.stops if stops is None else stops
        if not len(starts):
            return np.zeros(0, np.uint64)
        lengths = stops - starts
        first = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), _STEP))
        sums = np.add.reduceat(_BYTE[self.buffer[within + np.repeat(starts, lengths)]] * powers[within], first)
        return mix(sums + lengths.astype(np.uint64) * _M2)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document of every run of ``width`` words; a text of fewer words, but not none, is one run."""
        words = self.hashes()
        n = max(0, len(words) - width + 1)
        whole = np.flatnonzero(self.doc[:n] == self.doc[width - 1 :]) if n else np.zeros(0, np.int64)
        runs = np.zeros(len(whole), np.uint64)
        for k in range(width):
            runs = mix(runs * _M1 + words[whole + k] + np.uint64(k + 1))
        counts = self.per_doc(self.doc)
        short = np.flatnonzero((counts > 0) & (counts < width))
        first = np.cumsum(counts) - counts
        rest = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short):
            value = np.zeros(1, np.uint64)
            for k in range(counts[d]):
                value = mix(value * _M1 + words[first[d] + k : first[d] + k + 1] + np.uint64(k + 1))
            rest[i] = mix(value ^ np.uint64(counts[d]))[0]
        return np.concatenate((runs, rest)), np.concatenate((self.doc[whole], short))
