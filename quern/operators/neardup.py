"""Keep-first removal of near duplicates over a whole table: the ordered maximal independent set of candidate links.

Candidates come from signed random projections: rows that agree on all bits of a band share a bucket. In rounds, every
undecided row looks for the smallest earlier row of its buckets that is near enough and not dropped. A row that finds none
is kept, and one that finds a kept row is dropped; the rest wait for the row that they found. This is what the loop
in order does, without a kept list: each round passes over the buckets in blocks, and a row leaves a task with one
partner at most, never with all of its pairs. Before that, cheap rounds look at the first row of each bucket only: a row that
is the first of all its buckets is kept, and rows near a kept first one are dropped, so a large family of near copies goes in
one pass, in proportion to its size.

Before anything is hashed, the first FIRST rows in order are decided by the loop itself, and all later rows that are near to
a kept one of them go, by matrix products; this is taken again as long as it removes a good share of the rows.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.sources.files import stored

#: Rows of a bucket that one task compares with another block's.
BLOCK = 1024
#: Rows that a bucket of unlike vectors has on average, at most, when the bits are chosen by the size of the table.
CROWD = 64
#: Rows that the loop decides at once, in order; its kept ones are sent to all tasks.
FIRST = 4096
#: Share of the undecided rows that a look at the first rows must decide to be taken again.
SHARE = 0.1


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band and bands: a pair at the threshold shares a bucket with probability recall, a nearer one oftener.

    Two vectors at angle a agree on a bit with probability 1 - a / pi.
    """
    bits = max(6, math.ceil(math.log2(max(n, 1) / CROWD)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def bands(rows: DataFrame, bits: int, n: int, seed: int = 1) -> DataFrame:
    """ord, band, key of (ord, vector)."""

    def run(frames):
        planes = None
        for pdf in frames:
            if not len(pdf):
                continue
            v = np.stack(pdf["vector"])
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((n, v.shape[1], bits))
            weights = 1 << np.arange(bits, dtype=np.int64)
            keys = np.stack([(v @ p > 0) @ weights for p in planes], 1)
            yield pdf[["ord"]].assign(keys=list(keys))

    kind = rows.schema["ord"].dataType.simpleString()
    return rows.mapInPandas(run, f"ord {kind}, keys array<long>").select("ord", F.posexplode("keys").alias("band", "key"))


def _tasks(blocks: Column) -> Column:
    """Pairs of blocks that a row of a bucket of so many blocks belongs to."""
    block = F.pmod(F.xxhash64("ord"), blocks).cast("int")
    return F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, block).alias("x"), F.greatest(o, block).alias("y")))


def _earliest(threshold: float, kind: str):
    """Of a task's rows, every undecided one with the first row before it that is near enough."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        v, open_ = np.stack(pdf["vector"]), ~pdf["kept"].to_numpy()
        near = np.tril(v @ v.T > threshold, -1) & open_[:, None]
        found = np.flatnonzero(near.any(1))
        ids = pdf["ord"].to_numpy()
        return pd.DataFrame({"ord": ids[found], "near": ids[near[found].argmax(1)]})

    return run, f"ord {kind}, near {kind}"


def _settle_firsts(state: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The ord of those of the first FIRST rows that stay, and the rows after these to which none of them is near; both stored."""
    kind = state.schema["ord"].dataType.simpleString()

    def loop(frames):
        pdf = pd.concat(list(frames) or [pd.DataFrame({"ord": [], "vector": []})]).sort_values("ord")
        if len(pdf):
            v, gone = np.stack(pdf["vector"]), np.zeros(len(pdf), bool)
            for i in range(len(v)):
                if not gone[i]:
                    gone[i + 1 :] |= v[i + 1 :] @ v[i] > threshold
            yield pdf[~gone]

    head = stored(state.select("ord", "vector").orderBy("ord").limit(FIRST))
    kept = stored(head.coalesce(1).mapInPandas(loop, f"ord {kind}, vector array<double>"))
    held = state.sparkSession.sparkContext.broadcast([np.array(r["vector"]) for r in kept.select("vector").collect()])

    def far(frames):
        firsts = np.stack(held.value).T if held.value else None
        for pdf in frames:
            if len(pdf) and firsts is not None:
                v = np.stack(pdf["vector"])
                near = np.concatenate([(v[i : i + 1024] @ firsts > threshold).any(1) for i in range(0, len(v), 1024)])
                pdf = pdf[~near]
            yield pdf

    later = state.select("ord", "vector").join(F.broadcast(head.select("ord")), "ord", "left_anti")
    return kept.select("ord"), stored(later.mapInPandas(far, f"ord {kind}, vector array<double>"))


def _look_at_firsts(state: DataFrame, spots: DataFrame, threshold: float) -> DataFrame:
    """state after a look at the first row of each bucket that isn't dropped; nothing is decided that isn't certain."""
    live = stored(spots.join(state.select("ord", "kept"), "ord").select("band", "key", "ord", "kept"))
    firsts = stored(live.groupBy("band", "key").agg(F.min("ord").alias("first")))
    behind = stored(live.filter("not kept").join(firsts, ["band", "key"]).filter("first <> ord").select("ord", "first").distinct())
    # A row without a bucket, or first in all of them, has no earlier row to be near to.
    free = state.join(behind.select("ord").distinct(), "ord", "left_anti").select("ord", "vector", F.lit(True).alias("kept"))
    looked = stored(free.unionByName(state.join(behind.select("ord").distinct(), "ord", "left_semi")))
    leaders = looked.filter("kept").select(F.col("ord").alias("first"), F.col("vector").alias("_w"))
    met = behind.join(leaders, "first").join(looked.select("ord", "vector"), "ord")

    def near(batches):
        for pdf in batches:
            if len(pdf):
                dots = np.einsum("ij,ij->i", np.stack(pdf["vector"]), np.stack(pdf["_w"]))
                yield pdf.loc[dots > threshold, ["ord"]]

    kind = state.schema["ord"].dataType.simpleString()
    gone = met.select("ord", "vector", "_w").mapInPandas(near, f"ord {kind}").distinct()
    return stored(looked.join(gone, "ord", "left_anti"))


def keep_first(df: DataFrame, threshold: float = 0.70, recall: float = 0.999) -> DataFrame:
    """The ord of the rows of (ord, vector) that stay: in order, those to which no kept row is nearer than the threshold.

    ord is unique and not null; vectors are of one width. A null or zero vector, or one with a null or NaN, is near to none and
    stays. Equal vectors share one place, the first one's. recall: of pairs exactly at the threshold; what the bands
    miss (nothing beyond a few in a thousand pairs at the threshold) stays twice. Other columns are not read.
    """
    kind = df.schema["ord"].dataType.simpleString()
    rows = df.select("ord", F.col("vector").cast("array<double>").alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    rows = stored(rows.withColumn("norm", norm))
    real = F.coalesce(F.col("norm") > 0, F.lit(False)) & ~F.isnan("norm")
    odd = rows.filter(~real).select("ord")
    unit = rows.filter(real).select("ord", F.transform("vector", lambda x: x / F.col("norm")).alias("vector"))
    state = stored(unit.groupBy("vector").agg(F.min("ord").alias("ord")).select("ord", "vector"))
    settled, left, before = odd, state.count(), None
    while left and (before is None or before - left > SHARE * before):
        kept, state = _settle_firsts(state, threshold)
        settled, before, left = settled.unionByName(kept), left, state.count()
    if not left:
        return settled
    state = state.withColumn("kept", F.lit(False))
    bits, n = plan(left, threshold, recall)
    spots = bands(state.select("ord", "vector"), bits, n)
    sizes = stored(spots.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spots = stored(spots.join(sizes, ["band", "key"]).select("band", "key", "ord", _tasks(blocks).alias("tasks")))
    run, schema = _earliest(threshold, kind)
    places, before = spots.select("band", "key", "ord"), None
    while left and (before is None or before - left > SHARE * before):
        before, state = left, _look_at_firsts(state, places, threshold)
        left = state.filter("not kept").count()
    while not state.filter("not kept").isEmpty():
        # Only buckets with an undecided row are looked at again.
        live = spots.join(state.select("ord", "kept"), "ord")
        busy = live.filter("not kept").select("band", "key").distinct()
        dealt = live.join(busy, ["band", "key"], "left_semi").join(state.select("ord", "vector"), "ord").select("band", "key", "ord", "vector", "kept", F.inline("tasks"))
        found = dealt.groupBy("band", "key", "x", "y").applyInPandas(run, schema).groupBy("ord").agg(F.min("near").alias("near"))
        looked = stored(state.join(found, "ord", "left").withColumn("kept", F.col("kept") | F.col("near").isNull()))
        kept = stored(looked.filter("kept").select(F.col("ord").alias("near")))
        waiting = looked.filter("not kept").join(kept, "near", "left_anti")
        state = stored(looked.filter("kept").unionByName(waiting).select("ord", "vector", "kept"))
    return state.select("ord").unionByName(settled)
