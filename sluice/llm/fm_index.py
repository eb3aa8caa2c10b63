"""Compressed full-text index over word sequences: a k-order BWT in a wavelet matrix.

Bit planes and the interval borders of every match length are bit vectors with 32-bit counts.
The suffixes are sorted by their first ``order`` symbols only, ties by position. Patterns of up to
``order`` symbols still own one interval of rows each, a backward step stays exact, and the first row
of a full-length interval holds the earliest occurrence, so one sampled position a group is enough.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class BitRank:
    """A bit vector with a popcount directory: 32 bits of counts for 64 bits, until there are 2**32 of them."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, U64)
        self.words.view(np.uint8)[:len(packed)] = packed
        count = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=count[1:])
        self.total = int(count[-1])
        self.counts = count.astype(np.uint32 if len(bits) < 1 << 32 else np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        mask = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self.counts[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Bit planes of a symbol sequence; ranks a symbol in one pass of levels."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.levels = len(symbols), max(1, int(sigma - 1).bit_length())
        self.planes, self.zeros = [], []
        order = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            ones = ((order >> level) & 1).astype(bool)
            plane = BitRank(ones)
            self.planes.append(plane)
            self.zeros.append(self.n - plane.total)
            order = np.concatenate([order[~ones], order[ones]])
        self.place = self._places(np.arange(sigma), np.zeros(sigma, np.int64))

    def _places(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` ends after following ``symbols`` through all levels."""
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.planes[k].rank(at)
            at = np.where((symbols >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._places(symbols, at) - self.place[symbols]


class FMIndex:
    """Index over word sequences. ``sequences`` are arrays of word hashes, in corpus order.

    A match never crosses a sequence: symbol 0 stands between them and is in no pattern.
    """

    def __init__(self, sequences: list[np.ndarray], order: int):
        self.order = order
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.starts = np.zeros(len(sequences) + 1, np.int64)
        np.cumsum(lengths + 1, out=self.starts[1:])
        n = int(self.starts[-1])
        words = np.concatenate(sequences) if len(sequences) else np.zeros(0, U64)
        self.alphabet, ranks = np.unique(words, return_inverse=True)
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.starts[1:] - 1] = False
        text[inside] = ranks + 1
        self.sigma = len(self.alphabet) + 1
        doubled = self._doubled(text)
        suffixes = np.argsort(self._joined(doubled), kind="stable") if n else np.zeros(0, np.int64)
        self.lcp = self._lcp(doubled, suffixes)
        del doubled
        self.wavelet = WaveletMatrix(text[suffixes - 1], self.sigma)
        self.cumulative = np.zeros(self.sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=self.sigma), out=self.cumulative[1:])
        heads = np.flatnonzero(self.lcp < order)
        self.head_rows, self.head_positions = heads, suffixes[heads]  # sampled suffix array
        self.n, self._bounds = n, {}

    def _doubled(self, text: np.ndarray) -> list[np.ndarray]:
        """Ranks of the first 1, 2, 4 ... symbols from each position, up to ``order``."""
        out, width = [text], 1
        while width * 2 <= self.order:
            key = self._pair(out[-1], out[-1], width)
            out.append(np.unique(key, return_inverse=True)[1])
            width *= 2
        return out

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        later = np.zeros(len(left), np.int64)
        if shift < len(left):
            later[:-shift] = right[shift:]
        return left * (int(right.max(initial=0)) + 1) + later

    def _joined(self, doubled: list[np.ndarray]) -> np.ndarray:
        """Ranks of the first ``order`` symbols: powers of two put together from the longest down."""
        out, width = doubled[-1], 1 << (len(doubled) - 1)
        for k in range(len(doubled) - 1, -1, -1):
            if width + (1 << k) <= self.order:
                out = np.unique(self._pair(out, doubled[k], width), return_inverse=True)[1]
                width += 1 << k
        return out

    def _lcp(self, doubled: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        """Symbols that each row shares with the row above, ``order`` at most."""
        out = np.zeros(len(rows), np.uint8 if self.order < 256 else np.int64)
        if len(rows) < 2:
            return out
        a, b, shared = rows[:-1], rows[1:], np.zeros(len(rows) - 1, np.int64)
        for k in range(len(doubled) - 1, -1, -1):
            for _ in range(2):  # the widest step may fit twice, as in 16 + 4 for 20
                step = 1 << k
                i, j = a + shared, b + shared
                ok = (shared + step <= self.order) & (i < len(rows)) & (j < len(rows))
                same = ok & (doubled[k][np.where(ok, i, 0)] == doubled[k][np.where(ok, j, 0)])
                shared = shared + step * same
                if k < len(doubled) - 1:
                    break
        out[1:] = shared
        return out

    def _widen(self, low: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the first ``depth`` symbols of row ``low`` (the parent in the suffix tree)."""
        if depth not in self._bounds:
            first = self.lcp < depth
            heads = np.append(np.flatnonzero(first), self.n)
            self._bounds[depth] = (BitRank(first), heads.astype(np.uint32 if self.n < 1 << 32 else np.int64))
        first, heads = self._bounds[depth]
        g = first.rank(low + 1)  # intervals that begin up to the row, its own the last of them
        return heads[g - 1].astype(np.int64), heads[g].astype(np.int64)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.alphabet, words)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == words[known]
        return np.where(known, at + 1, 0)

    def matching_statistics(self, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each position of each query (one after the other): the length of the longest match that
        starts there (``order`` at most), the row interval's start, and its size.

        All queries are read from right to left in step; a failed backward step shortens the match at
        its right end, depth by depth, as the suffix tree's parent does.
        """
        lengths = np.fromiter(map(len, queries), np.int64, len(queries))
        offsets = np.zeros(len(queries) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        total = int(offsets[-1])
        found, rows, sizes = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
        if not total or not self.n:
            return found, rows, sizes
        symbols = self.symbols(np.concatenate(queries))
        by_length = np.argsort(-lengths, kind="stable")
        ends, lengths = offsets[1:][by_length], lengths[by_length]
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), self.n)
        depth = np.zeros(len(queries), np.int64)
        for step in range(1, int(lengths[0]) + 1):
            live = int(np.searchsorted(-lengths, -step, "right"))
            at = ends[:live] - step
            c, lo, hi, d = symbols[at], low[:live], high[:live], depth[:live]
            full = np.flatnonzero(d == self.order)
            if len(full):
                lo[full], hi[full] = self._widen(lo[full], self.order - 1)
                d[full] = self.order - 1
            todo = np.arange(live)
            unknown = c == 0
            if unknown.any():
                lo[unknown], hi[unknown], d[unknown] = 0, self.n, 0
                todo = todo[~unknown]
            while len(todo):
                s, m = c[todo], len(todo)
                both = self.wavelet.rank(np.concatenate([s, s]), np.concatenate([lo[todo], hi[todo]]))
                new_lo, new_hi = self.cumulative[s] + both[:m], self.cumulative[s] + both[m:]
                ok = new_hi > new_lo
                hit = todo[ok]
                lo[hit], hi[hit], d[hit] = new_lo[ok], new_hi[ok], d[hit] + 1
                todo = todo[~ok]
                for k in np.unique(d[todo]):  # shorten by one symbol and try again
                    those = todo[d[todo] == k]
                    if k <= 1:
                        lo[those], hi[those] = 0, self.n
                    else:
                        lo[those], hi[those] = self._widen(lo[those], k - 1)
                    d[those] = k - 1
            found[at], rows[at], sizes[at] = d, lo, hi - lo
        return found, rows, sizes

    def earliest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the earliest occurrence of full-length matches whose interval starts at ``rows``."""
        position = self.head_positions[np.searchsorted(self.head_rows, rows)]
        sequence = np.searchsorted(self.starts, position, "right") - 1
        return sequence, position - self.starts[sequence]
