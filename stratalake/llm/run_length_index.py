"""Run-length compressed Burrows-Wheeler index of a set of strings, and matching statistics streamed through it.

Strings are held as the runs of their Burrows-Wheeler transform, with text positions sampled at both ends of every
run; the suffix order itself is dropped once the runs are made. Runs also end where the first ``depth`` bytes of the
suffixes change, so that the rows of any match of ``depth`` bytes or more are whole runs, and each run can carry
the smallest value of all strings that hold those bytes. In repetitive strings there are far fewer runs than bytes.
"""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).max


def _ordered(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """Order of the positions by (high, low, position); both are below 2**bits."""
    n = len(high)
    width = max(1, (n - 1).bit_length())
    if 2 * bits + width <= 64:
        b, w = np.uint64(bits), np.uint64(width)
        packed = ((high.astype(np.uint64) << b | low.astype(np.uint64)) << w) | np.arange(n, dtype=np.uint64)
        packed.sort()
        return (packed & np.uint64((1 << width) - 1)).astype(np.int64)
    return np.argsort(high.astype(np.uint64) << np.uint64(bits) | low.astype(np.uint64), kind="stable")


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    """values[i + by], 0 beyond the end."""
    out = np.zeros_like(values)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


class RunLengthIndex:
    """Index of ``strings``; ``owners`` are their values, of which runs carry the smallest."""

    def __init__(self, strings: list[bytes], owners: np.ndarray, depth: int):
        self.depth = depth
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        #: First position of each string; a separator, 0, follows it. Bytes are 1 to 256.
        self.begins = np.cumsum(lengths + 1) - lengths - 1
        self.n = n = int(lengths.sum()) + len(strings)
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.begins + lengths] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        self.text, self.lengths = text, lengths
        order, exact = self._sort(int(lengths.max(initial=0)))
        self._compress(order, exact, np.repeat(np.asarray(owners, np.int64), lengths + 1))

    def _sort(self, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Suffix order to the length of the longest string, by doubling; and ranks of which those of a position and
        of a later one together tell equality in the first ``depth`` bytes."""
        bits = max(18, self.n.bit_length())
        pairs = self.text << 9 | _shifted(self.text, 1)
        high, low, size = pairs, _shifted(pairs, 2), 4
        exact: list[np.ndarray] = []
        while True:
            order = _ordered(high, low, bits if size > 4 else 18)
            h, lo = high[order], low[order]
            new = np.ones(self.n, bool)
            new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(new)
            if size <= self.depth:
                exact = [rank, _shifted(rank, self.depth - size)] if 2 * size >= self.depth else []
            if size >= longest or new.all() and exact:
                if not exact:
                    exact = [rank]
                return order, exact
            high, low, size = rank, _shifted(rank, size), 2 * size

    def _compress(self, order: np.ndarray, exact: list[np.ndarray], owner: np.ndarray) -> None:
        n = self.n
        before = self.text[order - 1]  # position 0 follows a separator, too
        first = np.zeros(n, bool)
        first[:1] = True
        for ranks in exact:
            r = ranks[order]
            first[1:] |= r[1:] != r[:-1]
        head = first.copy()
        head[1:] |= before[1:] != before[:-1]
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], n)
        groups = np.flatnonzero(first)
        least = np.minimum.reduceat(owner[order], groups) if n else owner
        #: By row: start of each run, its byte, text positions at its two ends, and the smallest owner.
        self.starts, self.heads = starts, before[starts]
        self.samples = (order[starts], order[ends - 1])
        self.least = least[np.cumsum(first)[starts] - 1] if n else owner
        #: By byte, then row: key of each run, and the row that its first symbol maps to.
        by = np.lexsort((starts, self.heads))
        size = (ends - starts)[by]
        self.key = self.heads[by] * (n + 1) + starts[by]
        self.by_size, self.target = size, np.cumsum(size) - size
        self.by_head, self.by_start = self.heads[by], starts[by]
        counts = np.bincount(self.heads, ends - starts, 258).astype(np.int64) if n else np.zeros(258, np.int64)
        self.smaller = np.concatenate(([0], np.cumsum(counts)))

    def _step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row before which all rows stand that begin with ``symbol`` and go on like a row before ``row``."""
        at = np.searchsorted(self.key, symbol * (self.n + 1) + row, side="right") - 1
        known = (at >= 0) & (self.by_head[at] == symbol)
        return np.where(known, self.target[at] + np.minimum(row - self.by_start[at], self.by_size[at]), self.smaller[symbol])

    def _rows_of(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each stretch of ``flat``; none where high <= low."""
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), self.n)
        for k in range(int(size.max(initial=0))):
            on = np.flatnonzero((k < size) & (low < high))
            symbol = flat[begin[on] + size[on] - 1 - k]
            low[on], high[on] = self._step(symbol, low[on]), self._step(symbol, high[on])
        return low, high

    def _longest(self, flat: np.ndarray, begin: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest indexed stretch at each place, at most ``most``, by halving: parts of what is
        indexed are indexed, too."""
        least, most = np.zeros(len(begin), np.int64), most.copy()
        while (least < most).any():
            half = (least + most + 1) // 2
            low, high = self._rows_of(flat, begin, half)
            found = low < high
            least, most = np.where(found, half, least), np.where(found, most, half - 1)
        return least

    def stream(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics of each text: for each position the length of the longest stretch from there on that
        an indexed string holds, a position in the index that has it (where it is sampled, else -1), and the
        smallest owner if the stretch has ``depth`` bytes or more, else NONE.

        All texts are read side by side from their ends, and a match grows to the left, two rank queries a byte. Where
        it can not, it is first cut from the right to the longest one that can; a text that the index holds never is.
        """
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        match, place, owner = np.zeros(len(flat), np.int64), np.full(len(flat), -1), np.full(len(flat), NONE)
        active = np.argsort(-lengths, kind="stable")
        low, high = np.zeros(len(texts), np.int64), np.full(len(texts), self.n)
        grown = np.zeros(len(texts), np.int64)
        for k in range(int(lengths.max(initial=0))):
            active = active[: np.searchsorted(-lengths[active], -k, side="left")]
            at = ends[active] - 1 - k
            symbol = flat[at]
            lo, hi = self._step(symbol, low[active]), self._step(symbol, high[active])
            size = grown[active] + 1
            lost = np.flatnonzero(hi <= lo)
            if len(lost):
                size[lost] = self._longest(flat, at[lost], size[lost] - 1)
                lo[lost], hi[lost] = self._rows_of(flat, at[lost], size[lost])
            low[active], high[active], grown[active] = lo, hi, size
            run = np.searchsorted(self.starts, lo, side="right") - 1
            match[at] = size
            # the first row of a long match is the first of its run, where a position is sampled
            deep = size >= self.depth
            owner[at[deep]] = self.least[run[deep]]
            sampled = deep & (self.starts[run] == lo)
            place[at[sampled]] = self.samples[0][run[sampled]]
        cut = np.split(np.arange(len(flat)), ends[:-1]) if len(texts) else []
        return [(match[c], place[c], owner[c]) for c in cut]
