"""The prefix trie against a trie of dictionaries, over many small pieces and partitions, and on odd rows."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quern.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int, id string, ends int, key int, pid int, base int, own int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 1, 1, 1, 1, 1) for r in rows], SCHEMA)


def brute(rows):
    """Nodes of the trie by plain dictionaries."""
    own = {}
    piece = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32]
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), piece(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = turns.get(c - int(math.fmod(c, 5)), [])[:h] + mine[h:]
        for d in range(len(seq) + 1):
            n = nodes.setdefault(tuple(seq[:d]), {"members": [], "ends": []})
            n["members"].append(c)
        n["ends"].append(c)
    out = []
    for seq, n in nodes.items():
        inside = {s: m for s, m in nodes.items() if s[: len(seq)] == seq}
        leaf = lambda s: not any(len(x) == len(s) + 1 and x[:-1] == s for x in nodes)
        saved = sum((len(m["members"]) - 1) * len(s[-1][1].encode()) for s, m in inside.items() if s)
        ends = hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest()
        kids = sum(len(s) == len(seq) + 1 for s in inside)
        up = min(nodes[seq[:-1]]["members"]) if seq else None
        out.append((min(n["members"]), len(seq), up, len(n["members"]), kids, sum(map(leaf, inside)), saved, ends))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.mark.parametrize("batch", ["10000", "1", "3"])
@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, batch, seed):
    """Few different turns, so that prefixes cross pieces and partitions; long and equal conversations among them."""
    rng = random.Random(seed)
    rows = [(c, i, rng.choice("ua"), rng.choice(["", "x", "ää"])) for c in range(0, 130) for i in range(rng.choice([1, 2, 4, 9, 14])) if c % 7]
    rows += [(c, i, "u", "same") for c in range(1000, 1060) for i in range(10)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert result(T.conversation_trie(frame(spark, rows).repartition(7))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark, monkeypatch):
    """Null turns, roles, texts and ids, tied and repeated turns, a long text, ids over several blocks; families without a base."""
    monkeypatch.setattr(T, "ID_BLOCK", 1)
    long = "ä" * 300_000
    rows = [(0, None, None, None), (0, 0, "u", long), (0, 0, "u", "b"), (0, 0, "u", "b"), (None, 1, "u", "lost"), (1, 5, "", ""), (2, 5, None, None), (-3, 1, "a", "b")]
    rows += [(c, None, "u", "b") for c in range(21, 40)]
    assert result(T.conversation_trie(frame(spark, rows))) == brute(rows)


def test_empty_and_alone(spark):
    assert T.conversation_trie(frame(spark, [])).count() == 0
    alone = T.conversation_trie(frame(spark, [(21, 1, "u", "b")])).collect()  # its first turns come from an absent family
    assert [tuple(r)[:4] for r in alone] == [(0, 21, None, 1)] and alone[0].n_leaves == 1


def test_equal_ids_are_hashed_in_order(spark):
    rows = spark.range(5000).select(F.lit(b"").alias("key"), (F.col("id") - 2500).alias("conv_id"))
    got = T.distinct_sequences(rows).collect()
    assert [(r.n, r.first) for r in got] == [(5000, -2500)]
    assert got[0].ends == hashlib.sha256(",".join(map(str, range(-2500, 2500))).encode()).hexdigest()
