"""Exact dedup with a heavy-hitter split.

A Misra-Gries pass over digests finds every digest that can hold more than 1/(k+1) of the rows. Exact counts verify
these few winners; they are broadcast (at most k rows) and settled on the map side, so a text with a third of all
copies never meets in one task. What is left has no frequent key and takes an ordinary shuffle.
"""

import heapq
import string

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Counters of a Misra-Gries summary: at most this many digests are broadcast.
COUNTERS = 1024


def _cut(counts: dict, k: int) -> dict:
    if len(counts) <= k:
        return counts
    least = heapq.nlargest(k + 1, counts.values())[-1]
    return {d: n - least for d, n in counts.items() if n > least}


def summarise(batches, k: int):
    """Misra-Gries over Arrow batches of one column; yields the summary of one partition, at most k rows."""
    counts: dict = {}
    for batch in batches:
        for x in pc.value_counts(batch.column(0)):
            d = x["values"].as_py()
            counts[d] = counts.get(d, 0) + x["counts"].as_py()
        counts = _cut(counts, k)
    yield pa.RecordBatch.from_pydict(
        {"digest": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
    )


def heavy_digests(keyed: DataFrame, k: int = COUNTERS) -> list:
    """At most k digests, among them every one with more than rows / (k + 1) copies."""
    parts = keyed.select("digest").mapInArrow(lambda b: summarise(b, k), "digest binary, n long")
    top = parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k + 1).collect()
    return list(_cut({bytes(r["digest"]): r["n"] for r in top}, k))


def exact_dedup(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty, and empty texts are equal.
    The largest doc_id of a group stays; rows that repeat this doc_id with this text all say kept. A null doc_id is
    kept only where the whole group has none. Other columns are not read, whatever their names. No rows give no rows.
    """
    text = F.translate(F.coalesce(docs["text"], F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    keyed = stored(docs.select(docs["doc_id"], F.unhex(F.sha2(text, 256)).alias("digest")))
    found = docs.sparkSession.createDataFrame([(d,) for d in heavy_digests(keyed, k)], "digest binary")
    winners = keyed.join(F.broadcast(found), "digest").groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    heavy = keyed.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    light = keyed.join(F.broadcast(found), "digest", "left_anti").select(
        "digest", "doc_id", F.max("doc_id").over(group).alias("keep_id"), F.count(F.lit(1)).over(group).alias("group_size")
    )
    return heavy.unionByName(light).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
