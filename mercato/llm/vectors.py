"""Words, code points and their 64-bit hashes over whole Arrow batches of text.

Everything works on the bytes of a batch at once; no Python object is made per
word.  Work is cut into pieces at white space, so memory follows the number of
words, not the length of the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# White space of the word rule [^\x20\x09-\x0D]+ ; ASCII only, so bytes suffice.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers; a piece's worth of them is kept."""
    if n > _PIECE + 1:
        return _powers(base, n)
    if base not in _KEPT:
        _KEPT[base] = _powers(base, _PIECE + 1)
    return _KEPT[base][:n]


_KEPT: dict[np.uint64, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of 64-bit values; spans lie in order and don't overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = starts[at]
            stop = max(at + 1, int(np.searchsorted(ends, low + _PIECE, side="right")))
            high = ends[stop - 1]
            terms = values[low:high] * powers(_BASE, high - low)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
            s, e = starts[at:stop] - low, ends[at:stop] - low
            back = powers(_BASE_INVERSE, high - low + 1)
            out[at:stop] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64) * _SYMBOL[7])
            at = stop
    return out


class Texts:
    """The texts of an Arrow column as one byte array; null counts as empty."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_string()).fill_null("")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
        self.bytes = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]

    def words(self, lower: bool = True) -> "Words":
        return Words(self, lower)


class Words:
    """Words of each text: ``hash``, byte span and the row of each; ``first`` has each row's first word."""

    def __init__(self, texts: Texts, lower: bool):
        data, offsets = texts.bytes, texts.offsets
        inside = ~_SPACE[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offsets] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        self.starts = np.flatnonzero(after & (~before | cut))
        self.ends = np.flatnonzero(before & (~after | cut))
        symbols = _SYMBOL[_LOWER] if lower else _SYMBOL
        self.hash = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(self.starts):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + _PIECE, side="right")))
            piece = symbols[data[low : self.ends[stop - 1]]]
            self.hash[at:stop] = span_hashes(piece, self.starts[at:stop] - low, self.ends[at:stop] - low)
            at = stop
        self.first = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and row of every window of ``k`` words of one text; a shorter text is one window."""
        n = len(self)
        scale = mix(np.arange(11, 11 + k, dtype=np.uint64) * _BASE) | np.uint64(1)
        counts = np.diff(self.first)
        with np.errstate(over="ignore"):
            sums = np.zeros(max(n - k + 1, 0), dtype=np.uint64)
            for j in range(k):
                sums += self.hash[j : n - k + 1 + j] * scale[j] if len(sums) else np.uint64(0)
            whole = self.row[: len(sums)] == self.row[k - 1 :] if len(sums) else np.zeros(0, bool)
            hashes, rows = mix(sums[whole]), self.row[: len(sums)][whole]
            short = np.flatnonzero((counts > 0) & (counts < k))
            if len(short):
                own = np.array(
                    [
                        mix(np.sum(self.hash[a:b] * scale[: b - a], dtype=np.uint64, keepdims=True) + _SYMBOL[b - a])[0]
                        for a, b in zip(self.first[short], self.first[short + 1], strict=True)
                    ],
                    dtype=np.uint64,
                )
                hashes, rows = np.concatenate((hashes, own)), np.concatenate((rows, short))
                order = np.argsort(rows, kind="stable")
                hashes, rows = hashes[order], rows[order]
        return hashes, rows


def distinct_per_row(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and the offsets of the rows in them; rows come in order."""
    cuts = np.searchsorted(rows, np.arange(n_rows + 1))
    hashes = hashes.copy()
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[cuts[:-1][cuts[:-1] < len(hashes)]] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    return hashes[new], kept[cuts]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 22):
    """The batch in slices of about ``limit`` bytes of text, at least one row each."""
    texts = Texts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, side="right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop
