"""Finding windows of W units (words or bytes) that start in more than one document, shared by two dedup operators.

Every window has an anchor: its gram of K units with the smallest hash, leftmost on ties. Equal windows have equal
anchors, so consecutive windows with one anchor form a segment, and the segments of an anchor go to one shard. Three
scans, none of which ships a text that could not repeat:
1. anchors are counted by hash; those seen once are done with;
2. anchors of very many segments ("hot") have their windows counted as well, so that what is unique around a passage
   that a third of all documents share isn't gathered in one place;
3. segments of repeated anchors go to their shards, several of which travel and are dealt with in one bucket, so that
   the number of rows grows no faster than the input. Those of hot anchors go by content, once a flush, with the places.
Bit filters carry the repeated hashes to the executors. They have no false negatives; the bits of a bucket of hashes are
packed where these were counted, and FILTER_BITS is the most that comes together: where that fills up, scan 3 ships more
and the shards sort it out. In a shard an engine finds, for every window, the smallest document that holds it. It gets
the contents that share half a window about their anchor with another; windows of the rest are in no other content.
Places of anchors of more than DEALT segments are dealt over salts by document, as many as the anchor's own segments call
for; their contents, which are few since they are trimmed to repeated windows, go to every one of these. Filters carry
the hot anchors too, one for each power of two above DEALT, so that no list of them is gathered anywhere; an anchor that
a filter takes for hotter than it is has a few salts more.
"""

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .shared import mix64, partitions, stored

#: Units in a window.
WINDOW = 50
#: Units of an anchor's gram.
GRAM = {"word": 6, "byte": 16}
#: Bits of a filter at most, bits of a key below that, 64-bit words of a bucket of keys at least, and such buckets at most.
FILTER_BITS, KEY_BITS, LEAST_WORDS, MOST_PARTS = 1 << 29, 16, 8, 1 << 15
#: Segments from which an anchor is hot, times as many from which its places are dealt over salts, and powers of two of these.
HOT, DEALT, SALTS = 4096, 8, 24
#: Bytes of segments that a shard is planned for, buckets of shards that are aimed at, and shards of a bucket at most.
SHARD_BYTES, BUCKETS, PER_BUCKET = 1_500_000, 512, 32
#: Bytes of text that are looked at together (their arrays stay in the cache), and keys or bytes held before a flush.
SLICE, KEYS_HELD, BYTES_HELD = 1 << 17, 1 << 21, 1 << 24
#: Bytes that a place of a hot segment is counted for while it is held.
PLACE_HELD = 64

MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
SPREAD = np.uint64(0x5851F42D4C957F2D)
PLACE = np.uint64(28)  # bits of a place within a slice, beside 36 of a hash


def _poly(x: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all runs of n values, by doubling."""
    out, have, power, todo = None, 0, MULT, n
    h, size = x, 1
    while todo:
        if todo & 1:
            if out is None:
                out, have = h, size
            else:
                m = len(x) - have - size + 1
                out = out[:m] * np.uint64(pow(int(MULT), size, 2**64)) + h[have : have + m]
                have += size
        todo >>= 1
        if todo:
            h = h[: len(h) - size] * power + h[size:]
            power, size = power * power, 2 * size
    return out


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    a = x
    while 2 * size <= n:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return a if size == n else np.minimum(a[: len(x) - n + 1], a[n - size : n - size + len(x) - n + 1])


class Slice:
    """Texts laid end to end, with their segments. unit_at: where every unit begins in data, one more for the end."""

    def __init__(self, texts: list[bytes], unit: str):
        self.unit = unit
        if unit == "byte":
            self.data = b"".join(texts)
            values = np.frombuffer(self.data, np.uint8).astype(np.uint64) + np.uint64(1)
            sizes = np.array([len(x) for x in texts], np.int64)
            self.unit_at = None
        else:
            words = [x.split() for x in texts]
            sizes = np.array([len(x) for x in words], np.int64)
            flat = [w for x in words for w in x]
            self.data = b" ".join(flat)
            self.unit_at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in flat])]).astype(np.int64)
            values = np.fromiter(map(xxh3_64_intdigest, flat), np.uint64, len(flat))
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        k = GRAM[unit]
        n = len(values)
        if n >= 1 << int(PLACE):
            raise ValueError(f"a text of {n} units: {1 << int(PLACE)} is the limit")
        self.runs = np.zeros((0, 4), np.int64)
        self.keys = self.values = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        with np.errstate(over="ignore"):
            self.values = values
            gram = mix64(_poly(values, k))
            packed = (gram >> PLACE << PLACE) | np.arange(len(gram), dtype=np.uint64)
            anchor = _sliding_min(packed, WINDOW - k + 1)  # of the window that starts at each place
        valid = np.ones(len(anchor), bool)
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        for b, e in zip(self.begin[:-1].tolist(), self.begin[1:].tolist()):
            valid[max(b, e - WINDOW + 1) : e] = False
            if b < len(new):
                new[b] = True
        first = np.flatnonzero(valid & new)
        doc = np.searchsorted(self.begin, first, "right") - 1
        last = np.minimum(np.append(first[1:], n) - 1, self.begin[doc + 1] - WINDOW)
        place = (anchor[first] & np.uint64((1 << int(PLACE)) - 1)).astype(np.int64)
        self.runs = np.stack([doc, first, last, place], 1)  # windows first..last of a document share an anchor
        with np.errstate(over="ignore"):
            self.keys = mix64(gram[place] ^ SPREAD)  # the smallest hashes are no even keys

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window of runs: its run, its place and its hash."""
        if not len(runs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        size = runs[:, 2] - runs[:, 1] + 1
        long = size + WINDOW - 1
        skipped = np.cumsum(long) - long
        units = np.arange(long.sum()) + np.repeat(runs[:, 1] - skipped, long)
        of = np.repeat(np.arange(len(runs)), size)
        own = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        with np.errstate(over="ignore"):
            hashes = mix64(_poly(self.values[units], WINDOW)[skipped[of] + own] ^ SPREAD)
        return of, runs[of, 1] + own, hashes

    def contents(self, first, end) -> list[bytes]:
        """The bytes of units first to end, for arrays of both."""
        if self.unit == "word":
            first, end = self.unit_at[first], self.unit_at[end] - 1
        return [self.data[a:b] for a, b in zip(first, end)]


#: Of a row: for every place, document and place; for every text, its bytes, places, shard in the bucket, windows and anchor.
KINDS = [("docs", np.int64), ("places", np.int32)], [("sizes", np.int32), ("counts", np.int32), ("shard", np.uint8), ("windows", np.uint8), ("anchor", np.uint8)]


def _blobs(squeeze: Callable, texts: list[bytes], **numbers: np.ndarray) -> tuple[bytes, bytes]:
    """A blob of numbers and one of texts; the places of a text stand together, the texts by shard."""
    head = np.array([len(numbers["docs"]), len(texts)], np.int64).tobytes()
    return squeeze(head + b"".join(numbers[name].astype(kind).tobytes() for kinds in KINDS for name, kind in kinds)), squeeze(b"".join(texts))


def _numbers(blob: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 16
    for n, kinds in zip(np.frombuffer(blob, np.int64, 2).tolist(), KINDS):
        for name, kind in kinds:
            out[name] = np.frombuffer(blob, kind, n, at).astype(np.int64)
            at += out[name].size * np.dtype(kind).itemsize
    return out


def slices(batches, unit: str):
    """(doc_ids, Slice) over (doc_id, text) batches, a bounded number of bytes at once. A text is never cut."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = text.as_buffer().to_pybytes()
            if len(x) < WINDOW:
                continue
            ids.append(doc)
            texts.append(x)
            size += len(x)
            if size >= SLICE:
                yield np.array(ids, np.int64), Slice(texts, unit)
                ids, texts, size = [], [], 0
    if ids:
        yield np.array(ids, np.int64), Slice(texts, unit)


def bucket_of(keys48: np.ndarray, parts: int) -> np.ndarray:
    """By range, so that sorted keys stand by bucket."""
    return ((keys48 >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(32)


def probes(keys48: np.ndarray, parts: int, words: int):
    """Two bits of every key, in the words of its bucket."""
    with np.errstate(over="ignore"):
        h = mix64(keys48 ^ SPREAD)
    own, bits = bucket_of(keys48, parts) * np.uint64(64 * words), np.uint64(64 * words)
    for half in (h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)):
        yield own + ((half * bits) >> np.uint64(32))


class BitFilter:
    """Membership of 48-bit keys by two bits of each."""

    def __init__(self, parts: int, words: int):
        self.parts, self.each = parts, words
        self.words = np.zeros(parts * words, np.uint64)

    def has(self, keys48: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys48), bool)
        for at in probes(keys48, self.parts, self.each):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    @staticmethod
    def of(found: DataFrame, above: list[tuple[int, int]]) -> "list[BitFilter]":
        """Of (key, n), a filter for each (least, how many keys have a larger n).

        Every task packs the bits of the buckets it holds, so what comes to the driver is the filters, once.
        """
        parts = _parts(found)
        limits = [(least, int(min(max(LEAST_WORDS, -(-KEY_BITS * n // (64 * parts))), max(1, FILTER_BITS // (64 * parts))))) for least, n in above]

        def pack(batches):
            both = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
            keys, n = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*both) if both else ((), ())))
            keys = keys.view(np.uint64)
            for i, (least, words) in enumerate(limits):
                own = keys[n > least]
                buckets = bucket_of(own, parts)
                for b in np.unique(buckets).tolist():
                    flags = np.zeros(64 * words, np.uint8)
                    for at in probes(own[buckets == b], parts, words):
                        flags[at - np.uint64(64 * words * b)] = 1
                    bits = np.packbits(flags, bitorder="little").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([b], pa.int64()), pa.array([bits], pa.binary())], ["filter", "bucket", "bits"])

        out = [BitFilter(parts, words) for _, words in limits]
        for r in found.mapInArrow(pack, "filter int, bucket long, bits binary").collect():
            f = out[r["filter"]]
            f.words[r["bucket"] * f.each : (r["bucket"] + 1) * f.each] |= np.frombuffer(r["bits"], np.uint64)
        return out


def _parts(df: DataFrame) -> int:
    """Buckets of keys."""
    return min(MOST_PARTS, 4 * partitions(df.sparkSession))


def repeated(docs: DataFrame, unit: str, keys_of: Callable) -> DataFrame:
    """(key, n): 48-bit keys that keys_of(Slice) gives at least twice. Keys travel packed, counted once a flush."""
    parts = _parts(docs)
    starts = np.array([-(-(b << 32) // parts) << 16 for b in range(parts + 1)], np.uint64)

    def flush(held):
        keys, counts = np.unique(np.concatenate(held) >> np.uint64(16), return_counts=True)
        packed = (keys << np.uint64(16)) | np.minimum(counts, 65535).astype(np.uint64)
        edges = np.searchsorted(keys, starts)
        some = np.flatnonzero(edges[1:] > edges[:-1])
        blobs = [packed[edges[b] : edges[b + 1]].tobytes() for b in some.tolist()]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "keys"])

    def emit(batches):
        held, n = [], 0
        for _, s in slices(batches, unit):
            held.append(keys_of(s))
            n += len(held[-1])
            if n >= KEYS_HELD:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def count(batches):
        by: dict[int, list] = {}
        for batch in batches:
            for b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(b, []).append(np.frombuffer(x, np.uint64))
        while by:
            x = np.sort(np.concatenate(by.popitem()[1]))
            if not len(x):
                continue
            at = np.flatnonzero(np.concatenate([[True], x[1:] >> np.uint64(16) != x[:-1] >> np.uint64(16)]))
            n = np.add.reduceat((x & np.uint64(0xFFFF)).astype(np.int64), at)
            keep = n > 1
            yield pa.RecordBatch.from_arrays([pa.array((x[at][keep] >> np.uint64(16)).astype(np.int64)), pa.array(n[keep])], ["key", "n"])

    sent = docs.mapInArrow(emit, "bucket int, keys binary").repartition(partitions(docs.sparkSession), "bucket")
    return stored(sent.mapInArrow(count, "key long, n long"))


def contested(texts: list[bytes], anchor: np.ndarray, unit: str) -> np.ndarray:
    """The texts that may share a window with another one, each given with the place of its anchor.

    A window holds half of its units beside the anchor to the left of it, or else to the right. Texts that share one have
    that half and the anchor in common.
    """
    k = GRAM[unit]
    half = (WINDOW - k) // 2
    at = anchor.tolist()
    units, joined = (texts, bytes) if unit == "byte" else ([x.split(b" ") for x in texts], b" ".join)
    left = [joined(x[i - half : i + k]) if i >= half else None for x, i in zip(units, at)]
    right = [joined(x[i : i + k + half]) if len(x) >= i + k + half else None for x, i in zip(units, at)]
    lefts, rights = Counter(left), Counter(right)
    lefts[None] = rights[None] = 0
    return np.flatnonzero([lefts[a] > 1 or rights[b] > 1 for a, b in zip(left, right)])


def removals(docs: DataFrame, unit: str, owners: Callable, hot_from: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, first, end) in units: stretches covered by windows that also start in a smaller document.

    docs: (doc_id long, text). owners(contents, docs): for every window of every content, end to end, the smallest of
    the documents of all contents that hold it; and the number of windows of each content. Stretches of a document may overlap or touch; a row may come twice.
    """
    spark = docs.sparkSession
    if hot_from < 1:
        raise ValueError("hot_from is 1 at least")
    found = repeated(docs, unit, lambda s: s.keys)
    levels = [1, hot_from, *(hot_from * DEALT << i for i in range(SALTS))]
    total, *above = found.agg(F.coalesce(F.sum("n"), F.lit(0)), *(F.count_if(F.col("n") > least) for least in levels)).first()
    filters = BitFilter.of(found, [x for x in zip(levels, above) if x[0] == 1 or x[1]])
    wanted, hotter = spark.sparkContext.broadcast(filters[0]), spark.sparkContext.broadcast(filters[1:])
    trim = None

    def heat(keys48):
        """The salts of every anchor, 0: not hot."""
        out = np.zeros(len(keys48), np.int64)
        at = np.arange(len(keys48))
        for tier, keys in enumerate(hotter.value):
            at = at[keys.has(keys48[at])]
            out[at] = 1 << tier
        return out

    if len(filters) > 1:
        again = repeated(docs, unit, lambda s: s.windows(s.runs[heat(s.keys >> np.uint64(16)) > 0])[2])
        trim = spark.sparkContext.broadcast(BitFilter.of(again, [(1, again.count())])[0])
    shards = max(1, int(total * (72 if unit == "byte" else 500) // shard_bytes))
    per = min(PER_BUCKET, -(-shards // BUCKETS))

    def send(batches):
        """Segments packed by bucket, once a flush; those of hot anchors are held longer."""
        plain, hot_held, size, hot_size = [], {}, 0, 0
        for ids, s in slices(batches, unit):
            keys48 = s.keys >> np.uint64(16)
            pick = np.flatnonzero(wanted.value.has(keys48)) if len(keys48) else np.zeros(0, np.int64)
            if not len(pick):
                continue
            salts = heat(keys48[pick])
            hot, cold, salts = pick[salts > 0], pick[salts == 0], salts[salts > 0]
            runs = s.runs[cold]
            texts = s.contents(runs[:, 1], runs[:, 2] + WINDOW)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            plain.append((bucket_of(keys48[cold], shards).astype(np.int64), texts, sizes, ids[runs[:, 0]], runs[:, 1] - s.begin[runs[:, 0]], runs[:, 2] - runs[:, 1] + 1, runs[:, 3] - runs[:, 1]))
            size += int(sizes.sum()) + 16 * len(texts)
            if len(hot):
                shard = bucket_of(keys48[hot], shards).astype(np.int64)
                runs = s.runs[hot]
                of, at, windows = s.windows(runs)
                kept = trim.value.has(windows >> np.uint64(16))
                of, at = of[kept], at[kept]
                first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(of, prepend=-1) != 0))
                n = np.diff(np.append(first, len(at)))
                of, at = of[first], at[first]
                texts = s.contents(at, at + n - 1 + WINDOW)
                for text, *key, doc, place, n_windows, anchor in zip(texts, shard[of].tolist(), salts[of].tolist(), ids[runs[of, 0]].tolist(), (at - s.begin[runs[of, 0]]).tolist(), n.tolist(), (runs[of, 3] - at).tolist()):
                    held = hot_held.get((*key, text))
                    if held is None:
                        held = hot_held[(*key, text)] = (n_windows, anchor, [], [])
                        hot_size += len(text) * key[1]
                    held[2].append(doc)
                    held[3].append(place)
                    hot_size += PLACE_HELD
            if size >= BYTES_HELD:
                yield from pack(plain)
                plain, size = [], 0
            if hot_size >= BYTES_HELD:
                yield from pack_hot(hot_held)
                hot_held, hot_size = {}, 0
        yield from pack(plain)
        yield from pack_hot(hot_held)

    def batch_of(rows):
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["bucket", "salt", "numbers", "texts"])

    def pack(plain):
        if not plain:
            return
        squeeze = zstandard.ZstdCompressor(level=1).compress
        shard, sizes, docs_, places, windows, anchor = (np.concatenate([x[i] for x in plain]) for i in (0, 2, 3, 4, 5, 6))
        texts = [t for x in plain for t in x[1]]
        order = np.argsort(shard, kind="stable")
        bucket = shard[order] // per
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
        rows = []
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            numbers = {"docs": docs_[at], "places": places[at], "sizes": sizes[at], "counts": np.ones(b - a), "shard": shard[at] % per, "windows": windows[at], "anchor": anchor[at]}
            rows.append((int(bucket[a]), -1, *_blobs(squeeze, [texts[i] for i in at.tolist()], **numbers)))
        yield from batch_of(rows)

    def pack_hot(held):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        by: dict[tuple, list] = {}
        for (shard, salts, text), (windows, anchor, docs_, places) in sorted(held.items(), key=lambda x: x[0]):
            docs_, places = np.array(docs_, np.int64), np.array(places, np.int64)
            if salts == 1:
                by.setdefault((shard // per, -1), []).append((text, shard % per, windows, anchor, docs_, places))
                continue
            own = docs_ % salts
            for salt in range(salts):  # the owner, without a place, goes to every salt
                mine = own == salt
                by.setdefault((shard // per, salt), []).append((text, shard % per, windows, anchor, np.append(docs_[mine], docs_.min()), np.append(places[mine], -1)))
        rows = []
        for (bucket, salt), x in by.items():
            texts, shard, windows, anchor, docs_, places = zip(*x)
            numbers = {"docs": np.concatenate(docs_), "places": np.concatenate(places), "sizes": np.array(list(map(len, texts))), "counts": np.array(list(map(len, docs_)))}
            rows.append((bucket, salt, *_blobs(squeeze, list(texts), **numbers, shard=np.array(shard), windows=np.array(windows), anchor=np.array(anchor))))
        yield from batch_of(rows)

    def settle(table: pa.Table) -> pa.Table:
        """The shards of a bucket, one after another."""
        expand, rows = zstandard.ZstdDecompressor().decompress, []
        for numbers, blob in zip(table.column("numbers"), table.column("texts")):
            x = _numbers(expand(numbers.as_py()))
            rows.append((x, expand(blob.as_py()), np.append(0, np.cumsum(x["sizes"])), np.append(0, np.cumsum(x["counts"])), np.searchsorted(x["shard"], np.arange(per + 1))))
        out = np.concatenate([settle_shard(rows, shard) for shard in range(per)])
        return pa.table({"doc_id": out[:, 0].astype(np.int64), "first": out[:, 1].astype(np.int32), "end": out[:, 2].astype(np.int32)})

    def settle_shard(rows, shard):
        number: dict[bytes, int] = {}
        of, docs_, places, windows, anchor = [], [], [], [], []
        for x, blob, ends, lots, at in rows:
            a, b = int(at[shard]), int(at[shard + 1])
            if a == b:
                continue
            cuts = ends[a : b + 1].tolist()
            known = len(number)
            ids = np.array([number.setdefault(blob[i:j], len(number)) for i, j in zip(cuts[:-1], cuts[1:])], np.int64)
            of.append(np.repeat(ids, x["counts"][a:b]))
            docs_.append(x["docs"][lots[a] : lots[b]])
            places.append(x["places"][lots[a] : lots[b]])
            new = np.unique(ids, return_index=True)
            new = a + new[1][new[0] >= known]
            windows.append(x["windows"][new])
            anchor.append(x["anchor"][new])
        if not of:
            return np.zeros((0, 3), np.int64)
        of, docs_, places, windows, anchor = (np.concatenate(x) for x in (of, docs_, places, windows, anchor))
        texts = list(number)
        least = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(least, of, docs_)
        whole = (docs_ > least[of]) & (places >= 0)
        out = [np.stack([docs_[whole], places[whole], places[whole] + windows[of[whole]] + WINDOW - 1], 1)]
        some = contested(texts, anchor, unit)
        if not len(some):
            return out[0]
        # In its smallest document a segment loses what a smaller document of another segment holds.
        own, n = owners([texts[i] for i in some.tolist()], least[some])
        text_of = np.repeat(some, n)
        gone = own < least[text_of]
        joined = np.concatenate([[False], gone[:-1] & (text_of[1:] == text_of[:-1])])
        follows = np.concatenate([gone[1:] & (text_of[1:] == text_of[:-1]), [False]])
        start, stop = np.flatnonzero(gone & ~joined), np.flatnonzero(gone & ~follows)
        begin = np.zeros(len(texts), np.int64)
        begin[some] = np.cumsum(n) - n
        mine = np.flatnonzero((docs_ == least[of]) & (places >= 0))
        mine = mine[np.argsort(of[mine], kind="stable")]
        low, high = (np.searchsorted(of[mine], text_of[start], side) for side in ("left", "right"))
        run = np.repeat(np.arange(len(start)), high - low)
        at = mine[np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[run]] if len(run) else np.zeros(0, np.int64)
        head = begin[text_of[start[run]]]
        out.append(np.stack([docs_[at], places[at] + start[run] - head, places[at] + stop[run] - head + WINDOW], 1))
        return np.concatenate(out)

    sent = docs.mapInArrow(send, "bucket long, salt int, numbers binary, texts binary")
    return sent.groupBy("bucket", "salt").applyInArrow(settle, "doc_id long, first int, end int")


def cut_documents(docs: DataFrame, unit: str, owners: Callable, finish: Callable, schema: str, **limits) -> DataFrame:
    """Joins every document of (doc_id, text) with its stretches; finish(bytes, firsts, ends) gives the other columns."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = removals(texts.filter("doc_id is not null"), unit, owners, **limits)
    lists = found.groupBy("doc_id").agg(F.collect_list(F.struct("first", "end")).alias("cuts"))
    joined = texts.join(lists, "doc_id", "left").select("doc_id", "text", F.col("cuts.first").alias("first"), F.col("cuts.end").alias("end"))

    def run(batches):
        for batch in batches:
            first, end = (batch.column(i).values.to_numpy() for i in (2, 3))
            edges = [list(zip(x.offsets[:-1].to_pylist(), x.offsets[1:].to_pylist())) for x in (batch.column(2), batch.column(3))]
            rows = []
            for doc, text, some, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).is_valid().to_pylist(), *edges):
                cuts = (first[slice(*a)], end[slice(*b)]) if some else (first[:0], end[:0])
                rows.append((doc, *finish(text.as_buffer().to_pybytes(), *cuts)))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names, kinds = zip(*(x.split() for x in schema.split(",")))
    kinds = [{"long": pa.int64(), "string": pa.string()}[k] for k in kinds]
    return joined.mapInArrow(run, schema)
