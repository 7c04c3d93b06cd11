"""Byte-level substring dedup by bucket-pointer refinement of suffixes.

The suffixes of a shard's segments are put in buckets by their first Q bytes; a bucket's identifier is its place in the
order of suffixes. Buckets are refined a few at a time: a bucket that agrees in d bytes is sorted by the identifiers of
its suffixes d bytes later, and its parts are refined on, recursively, until they are single or agree in WINDOW bytes.
New identifiers and depths are in use at once, so a later bucket whose pointers lead into refined ones is done in one
step. Windows that are equal stand together in the order that comes out.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .repeats import WINDOW, cut_documents

#: Bytes of the initial grams, and suffixes that are refined together.
Q, PART = 8, 1 << 15


def _refine(bucket: np.ndarray, depth: np.ndarray, live: np.ndarray) -> None:
    """Refines the buckets of the suffixes live, whole buckets in order, in place."""
    n = len(bucket)
    while len(live):
        key = bucket[live] * n + bucket[live + depth[live]]
        order = np.argsort(key)
        key, live = key[order], live[order]
        own = key // n
        head = np.flatnonzero(np.diff(key, prepend=-1))
        part = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(live))))
        # A part's identifier is the old bucket's plus the part's place in it, so it stays below the next bucket's.
        old = np.flatnonzero(np.diff(own, prepend=-1))
        first = np.repeat(old, np.diff(np.append(old, len(live))))
        deeper = depth[live] + depth[live + depth[live]]
        bucket[live] = own + (head[part] - first)
        depth[live] = deeper
        size = np.diff(np.append(head, len(live)))
        live = live[(size[part] > 1) & (deeper < WINDOW)]


def owners(texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every text, end to end, the smallest of docs over all texts that hold it; windows a text."""
    sizes = np.array([len(t) for t in texts])
    n = int(sizes.sum())
    data = np.frombuffer(b"".join(texts) + bytes(2 * WINDOW), np.uint8)
    places = n + WINDOW  # a suffix is refined by places less than WINDOW later
    gram = np.zeros(places, np.uint64)
    for i in range(Q):
        gram = (gram << np.uint64(8)) | data[i : i + places]
    order = np.argsort(gram)
    head = np.flatnonzero(np.diff(gram[order], prepend=gram[order[:1]] + np.uint64(1)))
    size = np.diff(np.append(head, places))
    bucket, depth = np.empty(places, np.int64), np.full(places, Q)
    bucket[order] = np.repeat(head, size)
    several = size > 1
    live = order[np.repeat(several, size)]
    live_head = np.cumsum(size[several]) - size[several]
    inside = live < n  # the padding behind the last text stays as it is
    cuts = np.unique(live_head[np.searchsorted(live_head, np.arange(0, len(live), PART), "right") - 1])
    for a, b in zip(cuts, np.append(cuts[1:], len(live))):
        _refine(bucket, depth, live[a:b][inside[a:b]])
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    is_window = np.arange(n) - start <= np.repeat(sizes, sizes) - WINDOW
    own = np.repeat(docs, sizes)
    best = own.copy()
    at = live[inside]
    at = at[is_window[at]]
    at = at[np.argsort(bucket[at])]
    # Neighbours in order are compared gram by gram; a window begins a group where they differ.
    same = np.arange(1, len(at))
    for i in [*range(0, WINDOW - Q, Q), WINDOW - Q]:
        same = same[gram[at[same] + i] == gram[at[same - 1] + i]]
    new = np.ones(len(at), bool)
    new[same] = False
    if len(at):
        group = np.flatnonzero(new)
        best[at] = np.repeat(np.minimum.reduceat(own[at], group), np.diff(np.append(group, len(at))))
    return best[is_window], sizes - WINDOW + 1


def _finish(data: bytes, first: np.ndarray, end: np.ndarray) -> tuple[int, int, int, str]:
    if not len(first):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest()
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, np.minimum(first, len(data)), 1)
    np.add.at(edge, np.minimum(end, len(data)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()


def suffix_dedup(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row: bytes in strings that start in a smaller document go.

    A null text counts as empty; texts shorter than a window keep all, one of 2**28 bytes or more
    fails. Rows that repeat a document share its cuts; rows without doc_id neither remove nor lose bytes. Other columns
    are not read. No rows give no rows.
    """
    return cut_documents(docs, "byte", owners, _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", **limits)
