"""Importance resampling towards a target set, by hashed n-gram features.

A table of 256 bytes lower-cases A-Z and blanks every separator in the UTF-8 bytes of a text, so that bytes.split gives
the words; bytes above 0x7F belong to words. The checksum of an n-gram goes on from that of the words before it: zlib.crc32
takes the last value as its seed. Counters reduce repeated features before anything else is worked out. Feature counts of
corpus and target meet in a table of buckets, whose gains are the only thing that is broadcast; the draw is a Gumbel
top-k over hashes of the ids, ranked by a range partitioning.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import kept, stored

#: Longest run of words that is a feature, buckets of features, words that a drawn document needs, percent drawn, seed.
NGRAM, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Bytes of a text that are split at once; a slice ends between words.
SLICE = 1 << 20
#: Features that a worker counts before it adds them to its buckets.
HELD = 1 << 18
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a whole text, slice by slice."""
    data = (text or "").encode().translate(TABLE)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= SLICE else data.rfind(b" ", at, at + SLICE)
        if end <= at:  # a word longer than a slice
            end = data.find(b" ", at + SLICE)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end + 1


def ngrams(words: list[bytes], n: int, past: tuple = ()) -> Iterator[tuple[bytes, ...]]:
    """Runs of 1 to n words that end in these; past: the words before them."""
    whole = [*past, *words]
    for i in range(len(past), len(whole)):
        for k in range(1, min(n, i + 1) + 1):
            yield tuple(whole[i + 1 - k : i + 1])


def feature_counts(text: str | None, n: int) -> tuple[int, Iterator[Counter]]:
    """Words of the text, and Counters of its features (words, or tuples of them), one for every slice."""
    counters, total, past = [], 0, ()
    for words in word_slices(text):
        total += len(words)
        if n == 1:
            counters.append(Counter(words))
        else:
            counters.append(Counter(ngrams(words, n, past)))
            past = tuple([*past, *words][max(0, len(past) + len(words) - n + 1) :])
    return total, counters


def checksum(feature: bytes | tuple[bytes, ...]) -> int:
    """crc32 of the words joined by single spaces, each word going on from the checksum before it."""
    if isinstance(feature, bytes):
        return zlib.crc32(feature)
    *_, value = accumulate(feature[1:], lambda seed, word: zlib.crc32(b" " + word, seed), initial=zlib.crc32(feature[0]))
    return value


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket; at most a row a bucket and task is shuffled, a row a bucket reaches the driver."""

    def run(batches):
        out, held = np.zeros(buckets, np.int64), Counter()

        def settle():
            for feature, count in held.items():
                out[checksum(feature) % buckets] += count
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                for counter in feature_counts(text.as_py(), n)[1]:
                    held.update(counter)
                    if len(held) > HELD:
                        settle()
        settle()
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """Floor of 1000 times the log of the smoothed ratio of shares, by bucket."""
    s, t, b = float(corpus.sum()), float(target.sum()), len(corpus)
    return [math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in zip(corpus.tolist(), target.tolist())]


def gumbel(doc_id: Column, seed: int) -> Column:
    """Floor of 1000 times a standard Gumbel variable drawn by the id; null ids draw as an empty one."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    return F.floor(-1000 * F.log(-F.log((F.conv(head, 16, 10).cast("double") + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, take: int, *order: Column) -> DataFrame:
    """rows with rank 1 to take in this order, null beyond; rows in one range partition each, counted, none gathered."""
    sorted_rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("part")
    sizes = sorted_rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = {r["part"]: b for r, b in zip(sizes, accumulate((r["n"] for r in sizes), initial=0))}
    if not before:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    offsets = rows.sparkSession.createDataFrame(list(before.items()), StructType([StructField("_part", LongType()), StructField("_before", LongType())]))
    placed = sorted_rows.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("rank", F.when(rank <= take, rank)).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS, least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of docs; target: texts whose distribution is aimed at.

    Null and empty texts have no features and weight 0; texts are whole however long, and other columns are not read.
    Documents of at least least words are ranked by score, equal ones by doc_id, null last, and then in any order (they
    are alike); the first percent of a hundred (rounded down) have their rank, the rest none. Without target texts
    every bucket's gain follows from the corpus alone. No rows give no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(texts, n, buckets), bucket_counts(target, n, buckets)))

    def run(batches):
        kept("importance", dict)
        of = table.value
        for batch in batches:
            words, features, sums = [], [], []
            for text in batch.column("text"):
                total, counters = feature_counts(text.as_py(), n)
                words.append(total)
                features.append(sum(map(Counter.total, counters)))
                sums.append(sum(count * of[checksum(x) % buckets] for counter in counters for x, count in counter.items()))
            weight = [s // f if f else 0 for s, f in zip(sums, features)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"])

    schema = StructType([texts.schema["doc_id"], *(StructField(c, LongType()) for c in ("n_words", "n_features", "weight"))])
    weighed = stored(texts.mapInArrow(run, schema).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    able = weighed.filter(F.col("n_words") >= least)
    chosen = ranked(able, percent * able.count() // 100, F.desc("score"), F.asc_nulls_last("doc_id"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    short = weighed.filter(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return chosen.select(*columns).unionByName(short.select(*columns))
