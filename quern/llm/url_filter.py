"""URL filters: prefix rules, then a Bloom filter cascade.

The cascade is built over the complete key universe of the corpus. Level 1 encodes the listed keys, level 2 those
unlisted keys that level 1 lets through, level 3 the listed keys that level 2 lets through, and so on until a level
has no false positives. For every key of the universe the first level that lacks it tells its class exactly, so rows
are judged where they lie: no join, no shuffle of rows. Bits are sharded by key. A group of shards is built, held and used
at a time, so that neither the driver nor an executor ever holds more than about HELD_BITS.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import mix64, stored

#: Bits a key gets at each level and probes into them; about 1 in 50 of the other class passes a level.
BITS_PER_KEY, PROBES = 8, 5
#: Bits planned for a shard, and for the shards held at once: 16 MB and 64 MB.
SHARD_BITS, HELD_BITS = 1 << 27, 1 << 29
#: Bits that travel to the driver as one row, tasks that pack them, and keys for each such task.
PIECE, PACKERS, PACKED = 1 << 19, 16, 1 << 20


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. rules: (verdict, 'host/path'), a short list."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _spots(a: np.ndarray, b: np.ndarray, level: int, bits: np.ndarray) -> np.ndarray:
    """PROBES bit numbers below bits for keys of the hash pair (a, b)."""
    with np.errstate(over="ignore"):
        x, y = mix64(a ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)), mix64(b + np.uint64(level)) | np.uint64(1)
        return np.stack([(x + np.uint64(i) * y) % bits for i in range(PROBES)])


@dataclass
class Cascade:
    """levels: a dict for each level from shard to the words of its bits; a shard that a level lacks ends there."""

    shards: int
    levels: list[dict[int, np.ndarray]]

    def holds(self, a: np.ndarray, b: np.ndarray, shards=None) -> np.ndarray:
        """Membership of keys of the universe; shards: those to look at, False elsewhere."""
        a, b = a.view(np.uint64), b.view(np.uint64)
        shard = ((a >> np.uint64(1)) % np.uint64(self.shards)).astype(np.int64)
        out = np.zeros(len(a), bool)
        for s in np.unique(shard):
            if shards is None or s in shards:
                at = np.flatnonzero(shard == s)
                for n, level in enumerate(self.levels):
                    if s not in level:
                        out[at] = n % 2 == 1
                        break
                    here = passes(level[s], a[at], b[at], n)
                    out[at[~here]] = n % 2 == 1
                    at = at[here]
                else:
                    out[at] = len(self.levels) % 2 == 1
        return out


def passes(words: np.ndarray, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    at = _spots(a, b, level, np.uint64(64 * len(words)))
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(0)


def _level(keys: DataFrame, level: int) -> dict[int, np.ndarray]:
    """The bits of keys (a, b, shard) by shard; executors pack them, and the driver takes one task's pieces at a time."""
    sizes = {r["shard"]: r["n"] for r in keys.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = {s: -(-n * BITS_PER_KEY // 64) for s, n in sizes.items()}

    def pack(frames):
        held: dict[tuple[int, int], np.ndarray] = {}
        for pdf in frames:
            shard = pdf["shard"].to_numpy()
            m = np.array([words[s] for s in shard], np.uint64) * np.uint64(64)
            at = _spots(pdf["a"].to_numpy().view(np.uint64), pdf["b"].to_numpy().view(np.uint64), level, m)
            of, at = np.tile(shard, PROBES), at.ravel()
            piece = (at // np.uint64(PIECE)).astype(np.int64)
            for s, c in set(zip(of.tolist(), piece.tolist())):
                own = at[(of == s) & (piece == c)] & np.uint64(PIECE - 1)
                bit = np.uint64(1) << (own & np.uint64(63))
                np.bitwise_or.at(held.setdefault((s, c), np.zeros(PIECE // 64, np.uint64)), (own >> np.uint64(6)).astype(np.int64), bit)
        if held:
            yield pd.DataFrame([(s, c, x.tobytes()) for (s, c), x in held.items()], columns=["shard", "piece", "bits"])

    out = {s: np.zeros(n, np.uint64) for s, n in words.items()}
    tasks = min(PACKERS, 1 + sum(sizes.values()) // PACKED)
    for r in keys.coalesce(tasks).mapInPandas(pack, "shard long, piece long, bits binary").toLocalIterator():
        to = out[r["shard"]][r["piece"] * PIECE // 64 :][: PIECE // 64]
        to |= np.frombuffer(r["bits"], np.uint64)[: len(to)]
    return out


def build_cascade(keys: DataFrame, shards: int) -> Cascade:
    """keys: distinct (a, b, listed, shard), by hash pair, of some shards. A level is a few small jobs over what is left."""
    spark, levels, side = keys.sparkSession, [], True
    while True:
        mine = keys.filter(F.col("listed") == side)
        level = _level(mine, len(levels))
        if not level:
            return Cascade(shards, levels)
        held = spark.sparkContext.broadcast(level)

        def through(frames, held=held, n=len(levels)):
            for pdf in frames:
                a, b = (pdf[c].to_numpy().view(np.uint64) for c in "ab")
                ok = np.zeros(len(pdf), bool)
                for s in pdf["shard"].unique():
                    at = np.flatnonzero(pdf["shard"] == s)
                    if s in held.value:
                        ok[at] = passes(held.value[s], a[at], b[at], n)
                yield pdf[ok]

        levels.append(level)
        survivors = keys.filter(F.col("listed") != side).mapInPandas(through, keys.schema)
        # Level n + 1 encodes the survivors; what it has to keep apart from them is what level n encoded.
        keys = stored(survivors.unionByName(mine))
        side = not side
        if len(levels) > 64:
            raise ValueError("two keys of both classes share 128 hash bits")


def _holds_udf(held):
    @F.pandas_udf("boolean")
    def holds(a: pd.Series, b: pd.Series) -> pd.Series:
        cascade, shards = held.value
        return pd.Series(cascade.holds(a.to_numpy(), b.to_numpy(), shards))

    return holds


def listed_mark(rows: DataFrame, key: str, universe: DataFrame, out: str) -> DataFrame:
    """rows with a boolean column out: whether the key is listed. universe: distinct (a, b, listed) of every key.

    Groups of shards are built and used one after another; rows are stored between groups.
    """
    keys = stored(universe)
    n, listed = keys.agg(F.count(F.lit(1)), F.count_if("listed")).first()
    shards = max(1, -(-(listed + n // 32) * BITS_PER_KEY // SHARD_BITS))  # a level lets about 1 in 50 of the others through
    keys = keys.withColumn("shard", F.expr(f"pmod(shiftrightunsigned(a, 1), {shards})"))
    some = max(1, HELD_BITS // SHARD_BITS)
    rows = rows.withColumn("_a", F.xxhash64(key)).withColumn("_b", F.xxhash64(F.lit("second"), key)).withColumn(out, F.lit(False))
    for start in range(0, shards, some):
        group = range(start, min(start + some, shards))
        part = build_cascade(keys.filter(F.col("shard").between(group[0], group[-1])), shards)
        held = rows.sparkSession.sparkContext.broadcast((part, set(group)))
        rows = rows.withColumn(out, F.col(out) | _holds_udf(held)("_a", "_b"))
        if group[-1] + 1 < shards:
            rows = stored(rows)
    return rows.drop("_a", "_b")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages.

    listed: one column, host: what the cascade blocks. A fitting rule decides; else a listed host is blocked and any
    other allowed. A url that is null or has no :// has an empty host and path, no rule, and is allowed unless the
    empty host is listed. Of fitting rules the longest text decides, and of equally long ones the later in code point
    order. Urls of any length are judged whole; repeated rows are judged alike; other columns are not read. No rows give
    no rows.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = rows.select("host", F.lit(False).alias("listed")).unionByName(
        listed.select(F.coalesce(F.col("host"), F.lit("")).alias("host"), F.lit(True).alias("listed"))
    )
    universe = hosts.groupBy("host").agg(F.max("listed").alias("listed")).select(
        F.xxhash64("host").alias("a"), F.xxhash64(F.lit("second"), "host").alias("b"), "listed"
    )
    marked = listed_mark(rows, "host", universe, "listed")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
