"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and fast Hadamard transforms; its hash is the nearest vertex of the
cross-polytope, +-e_i. A table combines several such hashes. A vector lies in its own bucket of every table and probes
the next likely ones. Equal vectors are one entry with a count. Buckets are counted first, and vectors travel only to
those that two entries share. A pair is verified, in double precision, only in the first bucket in which it meets, so no
pair is counted twice and none leaves a task as a row: a bucket yields the number of links of each entry and a spanning
star of its components. Buckets beyond BLOCK entries are compared block by block in many tasks.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, spread
from .shared import stored

#: Tables, hashes combined in a table, and buckets a vector probes beside its own.
TABLES, HASHES, PROBES = 8, 2, 1
#: Entries of one bucket that one task compares with another block's.
BLOCK = 1024
#: Rows of small buckets that one group holds, and entries of a bucket from which a matrix product compares them.
CELL, FEW = 4096, 16
COSINE = 0.93


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    h, n = 1, x.shape[1]
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x


def buckets(v: np.ndarray, seed: int = 0) -> np.ndarray:
    """(rows, TABLES, 1 + PROBES) of unit vectors: own bucket first, then the likeliest others, best first."""
    width = 1 << max(1, (v.shape[1] - 1).bit_length())
    x0 = np.zeros((len(v), width))
    x0[:, : v.shape[1]] = v
    out = np.zeros((len(v), TABLES, 1 + PROBES), np.int64)
    rows = np.arange(len(v))
    for t in range(TABLES):
        tops, gaps = [], []
        for j in range(HASHES):
            signs = np.random.default_rng([seed, t, j]).choice([-1.0, 1.0], (3, width))
            x = x0
            for s in signs:
                x = hadamard(x * s) / np.sqrt(width)
            # Vertex 2i is +e_i, 2i + 1 is -e_i; the likeliest are those of the largest coordinates.
            big = np.argsort(-np.abs(x), axis=1, kind="stable")[:, : 1 + PROBES]
            at = np.take_along_axis(x, big, 1)
            tops.append(2 * big + (at < 0))
            gaps.append((np.abs(at[:, :1]) - np.abs(at)) ** 2)
        moves = [(j, p) for j in range(HASHES) for p in range(1, min(1 + PROBES, width))]
        cost = np.stack([gaps[j][:, p] for j, p in moves], 1)
        order = np.argsort(cost, axis=1, kind="stable")
        for k in range(1 + PROBES):
            key = np.full(len(v), t, np.int64)
            for j in range(HASHES):
                vertex = tops[j][:, 0].copy()
                if k:
                    move = order[:, min(k, len(moves)) - 1]
                    for m, (mj, p) in enumerate(moves):
                        if mj == j:
                            vertex = np.where(move == m, tops[j][rows, p], vertex)
                key = key * (2 * width) + vertex
            out[:, t, k] = key
    return out


def _first_meeting(a: np.ndarray, b: np.ndarray, bucket) -> np.ndarray:
    """Whether bucket is the first in which the entries of a and b (their buckets, row by row, -1: shared with none) meet."""
    won = np.zeros(len(a), bool)
    open_ = np.ones(len(a), bool)
    for t in range(TABLES):
        meet = np.full(len(a), np.iinfo(np.int64).max)
        for x, y in ((a, b), (b, a)):
            hit = (x[:, t, :1] == y[:, t, :]).any(1) & (x[:, t, 0] >= 0)
            meet = np.where(hit, np.minimum(meet, x[:, t, 0]), meet)
        here = open_ & (meet != np.iinfo(np.int64).max)
        won |= here & (meet == bucket)
        open_ &= ~here
    return won


def _entries(pdf: pd.DataFrame) -> tuple:
    """Ids, unit vectors, whether in their own bucket, all buckets, and counts of the rows."""
    v = np.stack(pdf["v"]).astype(np.float64)
    keys = np.stack(pdf["buckets"]).reshape(len(pdf), TABLES, 1 + PROBES)
    return pdf["key"].to_numpy(), v / np.sqrt((v * v).sum(1, keepdims=True)), pdf["base"].to_numpy(), keys, pdf["count"].to_numpy()


def _result(ids: np.ndarray, links: np.ndarray, low: np.ndarray) -> pd.DataFrame:
    at = np.flatnonzero((links > 0) | (low != np.arange(len(low))))
    return pd.DataFrame({"key": ids[at], "other": ids[low[at]], "n": links[at].astype(np.int64)})


def compare_cell(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Whole buckets of BLOCK entries at most: (key, other, n): an entry's links here, and an entry of its component."""
    pdf = pdf.sort_values("bucket", kind="stable")
    bucket = pdf["bucket"].to_numpy()
    ids, v, base, keys, count = _entries(pdf)
    head = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
    size = np.diff(np.append(head, len(bucket)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for h, n in zip(head[size > FEW].tolist(), size[size > FEW].tolist()):
        i, j = np.nonzero(np.triu(v[h : h + n] @ v[h : h + n].T >= cosine, 1))
        left.append(i + h)
        right.append(j + h)
    few = np.repeat(size <= FEW, size)
    for d in range(1, FEW):
        i = np.flatnonzero((bucket[d:] == bucket[:-d]) & few[d:])
        i = i[np.einsum("ij,ij->i", v[i], v[i + d]) >= cosine]
        left.append(i)
        right.append(i + d)
    i, j = np.concatenate(left), np.concatenate(right)
    meet = base[i] | base[j]  # two probes don't meet
    i, j = i[meet], j[meet]
    kept = [_first_meeting(keys[i[s : s + 65536]], keys[j[s : s + 65536]], bucket[i[s : s + 65536]]) for s in range(0, len(i), 65536)]
    kept = np.concatenate(kept) if kept else np.zeros(0, bool)
    i, j = i[kept], j[kept]
    # An entry may stand here in several buckets; its first row stands for all.
    _, first, row = np.unique(ids, return_index=True, return_inverse=True)
    i, j = first[row[i]], first[row[j]]
    links = np.bincount(i, count[j], len(ids)) + np.bincount(j, count[i], len(ids))
    return _result(ids, links, spread(i, j, len(ids)))


def compare_blocks(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Two blocks of one large bucket, or one with itself (side 2); rows as of compare_cell."""
    same = (pdf["side"] == 2).all()
    sides = [pdf] if same else [pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]]
    parts = [_entries(x) for x in sides]
    (ids, v, base, keys, count), (ids2, v2, base2, keys2, count2) = parts[0], parts[-1]
    hit = (v @ v2.T >= cosine) & (base[:, None] | base2[None, :])
    i, j = np.nonzero(np.triu(hit, 1) if same else hit)
    bucket = int(pdf["bucket"].iloc[0])
    keep = [_first_meeting(keys[i[s : s + 65536]], keys2[j[s : s + 65536]], bucket) for s in range(0, len(i), 65536)]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    i, j = i[keep], j[keep]
    if same:
        return _result(ids, np.bincount(i, count[j], len(ids)) + np.bincount(j, count[i], len(ids)), spread(i, j, len(ids)))
    links = np.concatenate([np.bincount(i, count2[j], len(ids)), np.bincount(j, count[i], len(ids2))])
    return _result(np.concatenate([ids, ids2]), links, spread(i, j + len(ids), len(ids) + len(ids2)))


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Only rows with equal labels that are not null are linked, at a cosine of at least `cosine` in double precision.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    unequal widths, nor rows without vec_id. Equal vectors of a label are linked. Every row is a vector of its own, also
    where rows repeat a vec_id: n_links counts other rows, and component_id is the smallest vec_id of the rows that links
    lead to. Other columns are not read. No rows give no rows.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v"), "label")
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))
    # Equal vectors are told by 128 bits of hash, so that the way back from entries to rows moves no vectors.
    digest = ["label", F.xxhash64("v").alias("d1"), F.xxhash64(F.lit("second"), "v").alias("d2")]
    grouped = rows.filter(ok).select("vec_id", "v", *digest).groupBy("label", "d1", "d2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("count"), F.first("v").alias("v"))
    entries = stored(grouped.withColumn("key", F.monotonically_increasing_id()))

    def hash_all(frames):
        for pdf in frames:
            for width, part in pdf.groupby(pdf["v"].map(len)):
                v = np.stack(part["v"]).astype(np.float64)
                keys = buckets(v / np.sqrt((v * v).sum(1, keepdims=True)))
                yield pd.DataFrame({"label": part["label"].to_numpy(), "key": part["key"].to_numpy(), "width": width, "buckets": list(keys.reshape(len(v), -1))})

    label = entries.schema["label"].dataType.simpleString()
    hashed = stored(entries.select("label", "key", "v").mapInPandas(hash_all, f"label {label}, key long, width int, buckets array<long>"))
    spots = hashed.select("label", "width", "key", F.posexplode("buckets").alias("at", "bucket")).withColumn("base", F.col("at") % (1 + PROBES) == 0)
    sizes = spots.groupBy("label", "width", "bucket").agg(F.count(F.lit(1)).alias("m"), F.max("base").alias("any_base"))
    # Stored, so that Spark can split the entries of a hot bucket.
    sizes = stored(sizes.filter("m > 1 and any_base").select("label", "width", "bucket", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    shared = spots.join(sizes, ["label", "width", "bucket"]).groupBy("key", "width").agg(F.collect_list(F.struct("at", "bucket", "base", "blocks")).alias("spots"))
    of = F.map_from_entries(F.transform("spots", lambda s: F.struct(s["at"], s["bucket"])))
    masked = F.transform(F.sequence(F.lit(0), F.lit(TABLES * (1 + PROBES) - 1)), lambda i: F.coalesce(F.try_element_at(of, i), F.lit(-1).cast("long")))
    carried = entries.join(shared, "key").select("label", "width", "key", "count", "v", masked.alias("buckets"), F.inline("spots")).drop("at")
    placed = carried.withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    cells = max(1, hashed.count() * TABLES * (1 + PROBES) // CELL)
    small = placed.filter("blocks = 1").withColumn("cell", F.pmod(F.xxhash64("label", "width", "bucket"), F.lit(cells)))
    near = small.groupBy("label", "width", "cell").applyInPandas(lambda pdf: compare_cell(pdf, cosine), "key long, other long, n long")
    # Every pair of blocks (x <= y) of a large bucket is a task of its own; side 2: both are the same block.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.least(o, F.col("block")).alias("x"), F.greatest(o, F.col("block")).alias("y"),
            F.when(o == F.col("block"), 2).when(F.col("block") < o, 0).otherwise(1).alias("side"),
        ),
    )
    large = placed.filter("blocks > 1").select("label", "width", "bucket", "key", "count", "v", "buckets", "base", F.inline(pairs))
    far = large.groupBy("label", "width", "bucket", "x", "y").applyInPandas(lambda pdf: compare_blocks(pdf, cosine), "key long, other long, n long")
    found = stored(near.unionByName(far))
    links = found.groupBy("key").agg(F.sum("n").alias("n"))
    parts = stored(components(found.select(F.col("key").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "key"))
    known = entries.select("label", "d1", "d2", "key", "id", "count")
    least = stored(known.join(parts, "key").groupBy("component").agg(F.min("id").alias("least")))
    # From entries back to rows: equal vectors are linked with each other, whatever rounding makes of their cosine.
    of_entry = stored(
        known.join(links, "key", "left").join(parts.join(least, "component").select("key", "least"), "key", "left").select(
            "label", "d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("count") - 1).alias("n_links"), F.coalesce("least", "id").alias("component_id")
        )
    )
    joined = rows.filter(ok).select("vec_id", *digest).join(of_entry, ["label", "d1", "d2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(ok, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
