"""Near-duplicate texts by Order MinHash.

Shingles of five words are labelled with their occurrence number, so repeats count. For each table a hash orders the
labelled shingles; the two smallest, kept in text order, are the table's key, which makes keys sensitive to order and
so to edit similarity. Texts that share a key of any table are candidates. A pair counts when a banded alignment of its
shingle sequences matches enough: aligned / (all - aligned) >= 0.8. Equal word sequences are one entry throughout.

Candidates are compared in two rounds, so that a large group of near copies costs in proportion to its size. Round one
compares every entry with one other, the smallest first entry of its buckets. A bucket whose entries are then connected
is done, and of buckets with the same entries one is enough. Round two compares the others bucket by bucket: in those of
more than a block, the entries outside the part of most entries with all entries of their own and adjoining sizes, any two blocks
once, since aligned shingles are no more than the smaller text's. The multiset Jaccard index, exact for all pairs of a block by matrix
products, bounds the alignment from above, and pairs that links already connect need none. No pair that shares a key and
could link two parts is left out, and no bucket of more than two emits its pairs.
"""

import bisect
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .components import components
from .repeats import MULT, _poly
from .shared import mix64, stored

SHINGLE, SIMILARITY, TABLES = 5, 0.8, 12
#: Entries of a bucket that are compared in one task, with each other or with another block's.
BLOCK = 512
#: Diagonals of the alignment's band on either side, as a share of the longer text.
BAND = 0.25
SLICE = 1 << 19


def labelled(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all occurrence-labelled shingles of the texts, end to end, and where each text begins.

    A text of fewer than five words has one shingle, itself; one without words has none.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    values = np.fromiter((xxh3_64_intdigest(x) for w in words for x in w), np.uint64, int(sizes.sum()))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    with np.errstate(over="ignore"):
        padded = np.concatenate([values, np.zeros(SHINGLE, np.uint64)])
        gram = mix64(_poly(padded, SHINGLE))
        for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):
            own = np.concatenate([values[begin[i] : begin[i + 1]], np.zeros(SHINGLE - sizes[i], np.uint64)])
            gram[begin[i]] = mix64(_poly(own, SHINGLE))[0]
        starts = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(words)), counts)
        gram = gram[np.arange(starts[-1]) - starts[text] + begin[text]]
        order = np.lexsort((np.arange(len(gram)), gram, text))
        same = np.concatenate([[False], (gram[order][1:] == gram[order][:-1]) & (text[order][1:] == text[order][:-1])])
        place = np.arange(len(gram))
        nth = np.zeros(len(gram), np.uint64)
        nth[order] = (place - np.maximum.accumulate(np.where(same, 0, place))).astype(np.uint64)
        return mix64(gram + nth * MULT), starts


def sketch(labels: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, TABLES) keys; texts without shingles get zeros."""
    some = np.flatnonzero(np.diff(starts))
    out = np.zeros((len(starts) - 1, TABLES), np.int64)
    if not len(some):
        return out
    head, size = starts[:-1][some], np.diff(starts)[some]
    with np.errstate(over="ignore"):
        for t in range(TABLES):
            h = mix64(labels ^ np.uint64(0xD6E8FEB86659FD93 * (t + 1) % 2**64))
            ends = []
            for _ in range(2):
                low = np.minimum.reduceat(h, head)
                at = np.flatnonzero(h == np.repeat(low, size))
                at = at[np.concatenate([[True], np.searchsorted(head, at[1:], "right") != np.searchsorted(head, at[:-1], "right")])]
                ends.append(np.where(size > 1, at, head) if not ends else at)
                h[at] = np.uint64(2**64 - 1)
            second = np.where(size > 1, ends[1], ends[0])
            a, b = np.minimum(ends[0], second), np.maximum(ends[0], second)
            out[some, t] = mix64(labels[a] * MULT + labels[b] + np.uint64(t)).view(np.int64)
    return out


def aligned(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two sequences of distinct labels within the band."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    inside = np.abs(i - j) <= max(16, BAND * max(len(a), len(b)))
    i, j = i[inside], j[inside]
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        at = bisect.bisect_left(tails, x)
        tails[at : at + 1] = [x]
    return len(tails)


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether enough of two sequences is aligned; sequences of too different length need no look."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    n = aligned(a, b)
    return n >= similarity * (len(a) + len(b) - n)


def compare(ids: np.ndarray, group: np.ndarray, side: np.ndarray, seqs: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A block with itself (side 2) or two blocks (sides 0 and 1) of a bucket: links that connect different groups, no more than needed."""
    labels = np.concatenate(seqs)
    sizes = np.array([len(x) for x in seqs], np.float64)
    _, number = np.unique(labels, return_inverse=True)
    shared = np.flatnonzero(np.bincount(number) > 1)
    column = np.full(number.max() + 1 if len(number) else 0, -1)
    column[shared] = np.arange(len(shared))
    column, row = column[number], np.repeat(np.arange(len(seqs)), sizes.astype(np.int64))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    common = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, len(shared), 8192):
        pick = (column >= c) & (column < c + 8192)
        m = np.zeros((len(seqs), min(8192, len(shared) - c)), np.float32)
        m[row[pick], column[pick] - c] = 1
        common += m[left] @ m[right].T
    jaccard = common / np.maximum(sizes[left, None] + sizes[None, right] - common, 1)
    like = jaccard >= similarity - 1e-6
    i, j = np.nonzero(np.triu(like, 1) if (side == 2).all() else like)
    bound = jaccard[i, j]
    i, j = left[i], right[j]
    up = np.unique(group, return_index=True, return_inverse=True)
    up = up[1][up[2]].tolist()  # of every entry the first of its group
    out = []

    def top(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for k in np.argsort(-bound, kind="stable"):
        x, y = top(i[k]), top(j[k])
        if x != y and alike(seqs[i[k]], seqs[j[k]], similarity):
            up[max(x, y)] = min(x, y)
            out.append((int(ids[i[k]]), int(ids[j[k]])))
    return out


def _levels(members: DataFrame) -> DataFrame:
    """A row for every level of a bucket: whether the bucket is larger than a block, and the blocks of its main part and of
    its outside entries at the level itself and at those below and above.
    """
    per = members.groupBy("bucket", "level").agg(F.count_if(~F.col("outside")).alias("main"), F.count_if("outside").alias("out"))
    bucket = Window.partitionBy("bucket")
    at = lambda by, n: F.coalesce(F.max(F.ceil(F.col(n) / BLOCK)).over(bucket.orderBy("level").rangeBetween(by, by)), F.lit(0)).cast("int")
    return per.select("bucket", "level", (F.sum(F.col("main") + F.col("out")).over(bucket) > BLOCK).alias("large"), *(at(by, n).alias(f"{n}{by}") for n in ("main", "out") for by in (-1, 0, 1)))


def _code(level: Column, block: Column, main: bool) -> Column:
    return F.shiftleft(level, 32) + block + (1 << 31 if main else 0)


def _numbers(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _task(x: Column, y: Column, side) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), (side if isinstance(side, Column) else F.lit(side)).alias("side"))


def _tasks() -> Column:
    """The tasks of an entry: blocks of outside entries meet the blocks of the main part and each other near their level, each two once.

    A bucket of one block at most is a single task.
    """
    level = F.col("level")
    block = lambda n: F.pmod(F.xxhash64("id"), F.greatest(F.col(n), F.lit(1))).cast("int")
    main, own = _code(level, block("main0"), True), _code(level, block("out0"), False)

    def among(other: Column) -> Column:
        return _task(F.least(own, other), F.greatest(own, other), F.when(own == other, 2).when(own < other, 0).otherwise(1))

    def beside(by: int) -> Column:
        outside = _numbers(F.col(f"out{by}"))
        mains = F.transform(_numbers(F.col(f"main{by}")), lambda o: _task(own, _code(level + by, o, True), 0))
        of_outside = F.concat(mains, F.transform(outside, lambda o: among(_code(level + by, o, False))))
        of_main = F.transform(outside, lambda o: _task(_code(level + by, o, False), main, 1))
        return F.when(F.col("outside"), of_outside).otherwise(of_main)

    return F.when(F.col("large"), F.concat(*map(beside, (-1, 0, 1)))).otherwise(F.array(_task(F.lit(0).cast("long"), F.lit(0).cast("long"), 2)))


def _leaders(shared: DataFrame) -> DataFrame:
    """(a, b): every entry with the smallest first entry of its buckets."""
    return shared.filter("id != first").groupBy(F.col("id").alias("a")).agg(F.min("first").alias("b"))


def _verified(pairs: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are alike, stored."""

    def run(batches):
        for batch in batches:
            ends = [batch.column(c) for c in ("la", "lb")]
            good = [alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), similarity) for x, y in zip(*ends)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda end: labels.select(F.col("id").alias(end), F.col("labels").alias(f"l{end}"))
    return stored(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "la", "lb").mapInArrow(run, "a long, b long"))


def _mixed(shared: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left to compare once parts are connected: pairs (a, b), and members (bucket, id, group, level, outside) of larger buckets.

    A bucket whose entries are connected is done, and of buckets with the same entries one is enough. outside: not in the
    bucket's part of most entries.
    """
    at = stored(shared.join(parts.select(F.col("node").alias("id"), F.col("component").alias("group")), "id", "left").withColumn("group", F.coalesce("group", "id")))
    seen = [F.sum(F.xxhash64(F.lit(i), "id").cast("decimal(38,0)")).alias(f"s{i}") for i in (0, 1)]
    open_ = at.groupBy("t", "key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.max("id").alias("last"), F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), *seen).filter("low != high")
    one = stored(open_.groupBy("s0", "s1", "n", "first", "last").agg(F.min(F.struct("t", "key")).alias("k")).select("n", "first", "last", "k.t", "k.key"))
    pairs = one.filter("n = 2").select(F.col("last").alias("a"), F.col("first").alias("b")).distinct()
    large = stored(one.filter("n > 2").select("t", "key", F.monotonically_increasing_id().alias("bucket")))
    members = stored(at.drop("first", "n").join(large, ["t", "key"]).select("bucket", "id", "group", "level"))
    counts = members.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("n"))
    main = stored(counts.groupBy("bucket").agg(F.max_by("group", F.struct("n", -F.col("group"))).alias("main")))
    return pairs, stored(members.join(main, "bucket").select("bucket", "id", "group", "level", (F.col("group") != F.col("main")).alias("outside")))


def _within(members: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b), stored, of buckets whose entries are compared block by block."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seqs = [np.frombuffer(x, np.uint64) for x in pdf["labels"]]
        out = compare(pdf["id"].to_numpy(), pdf["group"].to_numpy(), pdf["side"].to_numpy(), seqs, similarity)
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    sizes = stored(_levels(members))
    placed = members.join(sizes, ["bucket", "level"]).select("bucket", "id", "group", _tasks().alias("tasks")).filter(F.size("tasks") > 0)
    each = placed.join(labels, "id").select("bucket", "id", "group", "labels", F.inline("tasks"))
    return stored(each.groupBy("bucket", "x", "y").applyInPandas(run, "a long, b long"))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, kept, text_sha256 for every row: class_id is the smallest doc_id of the texts that links connect.

    kept says that the row's doc_id is it and its text is the class's own; where texts of one class share this doc_id, the
    one with the smallest hash. Rows of equal words are alike; rows that share a doc_id but not their words are documents of
    their own, linked only if their texts are. Words are split at white space and compared in lower case; texts of fewer
    than five words only match equal ones. Null and empty texts stay alone, rows without doc_id too, and both are kept.
    Other columns are not read. No rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"))

    def slices(batch):
        """The rows from one number to another, and their words."""
        done, size, words = 0, 0, []
        texts = batch.column("text")
        for n in range(len(texts)):
            words.append(texts[n].as_py().lower().encode().split())
            size += sum(map(len, words[-1]))
            if size >= SLICE or n + 1 == len(texts):
                yield batch.slice(done, len(words)), words
                done, size, words = n + 1, 0, []

    def sketches(batches):
        for batch in batches:
            for own, words in slices(batch):
                digests = [hashlib.sha256(b" ".join(w)).digest() if w else None for w in words]
                labels, starts = labelled(words)
                keys = pa.array(list(sketch(labels, starts)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("sha"), pa.array(digests, pa.binary()), keys, pa.array(np.diff(starts), pa.int64())], ["doc_id", "sha", "digest", "keys", "size"])

    def sequences(batches):
        for batch in batches:
            for own, words in slices(batch):
                labels, starts = labelled(words)
                yield pa.RecordBatch.from_arrays([own.column("id"), pa.array([labels[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())], ["id", "labels"])

    sketched = stored(rows.mapInArrow(sketches, "doc_id long, sha binary, digest binary, keys array<long>, size long"))
    some = sketched.filter("doc_id is not null and digest is not null")
    entries = some.groupBy("digest").agg(F.min(F.struct("doc_id", "sha", "keys", "size")).alias("e")).select("digest", "e.*")
    # Numbers of their own: two entries may have the same smallest doc_id.
    entries = stored(entries.withColumn("id", F.monotonically_increasing_id()))
    # The base of the levels is a trace wider than the bound, for rounding.
    level = F.floor(F.log("size") / math.log(1.0001 / similarity)).cast("long")
    spots = entries.select("id", level.alias("level"), F.posexplode("keys").alias("t", "key"))
    # Stored, so that both sides of the join come straight from a shuffle and the entries of a hot key can be split.
    buckets = stored(spots.groupBy("t", "key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = stored(spots.join(buckets, ["t", "key"]))
    wanted = entries.join(shared.select("id").distinct(), "id").select("id", "doc_id", "sha")
    texts = rows.filter("doc_id is not null").join(wanted, ["doc_id", "sha"]).dropDuplicates(["doc_id", "sha"]).select("id", "text")
    labels = stored(texts.mapInArrow(sequences, "id long, labels binary"))
    links = _verified(_leaders(shared), labels, similarity)
    pairs, members = _mixed(shared, stored(components(links)))
    links = links.unionByName(_verified(pairs, labels, similarity)).unionByName(_within(members, labels, similarity))
    parts = components(links).withColumnRenamed("node", "id")
    of_entry = stored(entries.join(parts, "id", "left").select("digest", "doc_id", F.coalesce("component", "id").alias("component")))
    least = stored(of_entry.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("m")))
    classes = of_entry.join(least, "component").select("digest", F.col("m.doc_id").alias("class_id"), (F.col("digest") == F.col("m.digest")).alias("own"))
    joined = sketched.join(classes, "digest", "left")
    alone = F.col("doc_id").isNull() | F.col("own").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, True).otherwise(F.col("own") & (F.col("doc_id") == F.col("class_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
