"""Word-level substring dedup with a compressed FM-index per shard.

A shard's segments are indexed by a wavelet matrix over their Burrows-Wheeler transform. Every segment is streamed
through it by backward search, all segments of a shard in step: a word more widens the match, and beyond the threshold
the match falls back to its first WINDOW words by a bit vector that marks where these change. Each interval of at
least the threshold gives, over the documents of its suffixes, the smallest one that holds the window.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .repeats import WINDOW, cut_documents


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Over a sequence of symbols, sorted to a depth of WINDOW + 1 at least; 0 ends a segment."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        deep = {1: rank}
        h = 1
        while h <= WINDOW:
            later = np.concatenate([rank[h:], np.full(min(h, n), -1, np.int64)])[:n]
            rank = np.unique(rank * (n + 2) + later + 1, return_inverse=True)[1].astype(np.int64)
            h *= 2
            deep[h] = rank
        self.order = np.argsort(rank, kind="stable")
        half = deep[32]
        rest = np.concatenate([half[WINDOW - 32 :], np.full(min(WINDOW - 32, n), -1, np.int64)])[:n]
        a, b = half[self.order], rest[self.order]
        starts = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        self.block_at = np.flatnonzero(np.concatenate([starts, [True]]))
        self.blocks = Bits(starts)
        last = text[self.order - 1]
        symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.depth = max(1, (symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for d in range(self.depth - 1, -1, -1):
            bit = (last >> d & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            last = np.concatenate([last[~bit], last[bit]])
        self.base = self._walk(np.arange(symbols), np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for d, bits, zeros in zip(range(self.depth - 1, -1, -1), self.levels, self.zeros):
            ones = bits.rank1(at)
            at = np.where(symbol >> d & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + match, from those of the matches."""
        at = self._walk(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) - np.tile(self.base[symbol], 2)
        return self.first[symbol] + at[: len(lo)], self.first[symbol] + at[len(lo) :]

    def shorten(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the first WINDOW symbols of matches that are longer."""
        block = self.blocks.rank1(lo + 1) - 1
        return self.block_at[block], self.block_at[block + 1]


def owners(texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every text, end to end, the smallest of docs over all texts that hold it; windows a text."""
    number: dict[bytes, int] = {}
    seqs = [np.array([number.setdefault(w, len(number) + 1) for w in t.split(b" ")], np.int64) for t in texts]
    sizes = np.array([len(s) for s in seqs])
    text = np.concatenate([np.append(s, 0) for s in seqs])
    index = FMIndex(text)
    doc_of = np.repeat(docs, sizes + 1)[index.order]
    start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    lanes = np.argsort(-sizes, kind="stable")
    lo, hi = np.zeros(len(seqs), np.int64), np.full(len(seqs), len(text), np.int64)
    low, high = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    for step in range(1, int(sizes.max()) + 1):
        live = lanes[: np.searchsorted(-sizes[lanes], -step, "right")]
        at = start[live] + sizes[live] - step
        lo[live], hi[live] = index.extend(text[at], lo[live], hi[live])
        if step > WINDOW:
            lo[live], hi[live] = index.shorten(lo[live])
        if step >= WINDOW:
            low[at], high[at] = lo[live], hi[live]
    # Intervals of windows are equal or disjoint, so one pass over their edges gives the smallest document of each.
    is_window = high > low
    edges = np.unique(np.concatenate([low[is_window], high[is_window]]))
    least = np.minimum.reduceat(np.append(doc_of, np.iinfo(np.int64).max), edges)
    best = least[np.searchsorted(edges, low)]
    place = np.arange(len(text)) - np.repeat(start, sizes + 1)
    return best[place <= np.repeat(sizes, sizes + 1) - WINDOW], sizes - WINDOW + 1


def _finish(data: bytes, first: np.ndarray, end: np.ndarray) -> tuple[int, int, str]:
    words = data.split()
    kept = words
    if len(first):
        gone = np.zeros(len(words) + 1, bool)
        for a, b in zip(first.tolist(), end.tolist()):
            gone[a:b] = True
        kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def substring_dedup(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row: words in windows that start in a smaller document go.

    Words are runs of characters other than space and U+0009 to U+000D; a null or empty text has none. Texts shorter
    than a window keep all; one of 2**28 words or more fails. Rows that repeat a document share its cuts; rows without
    doc_id neither remove nor lose words. Other columns are not read. No rows give no rows.
    """
    return cut_documents(docs, "word", owners, _finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", **limits)
