"""Importance resampling against plain Python, with n-grams, slices, nulls, ties and empty tables."""

import hashlib
import math
import random
import re
import zlib

import pytest

from quern.llm import importance as I

SCHEMA = "doc_id long, text string, weight int, score int, rank int, n_words int, _at int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, 1, 1, 1, 1) for d, t in rows], SCHEMA)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def features(text, n, buckets):
    w = words(text)
    return [zlib.crc32(b" ".join(w[i : i + k])) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n, buckets, least, percent):
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in features(text, n, buckets):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    out = []
    for doc, text in docs:
        f = features(text, n, buckets)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    ranks = {}
    for i, r in enumerate(drawn):
        ranks.setdefault(r, []).append(i + 1)
    return sorted(((*r[:4], ranks[r].pop() if ranks.get(r) else None) for r in out), key=str)


@pytest.mark.parametrize("n, size", [(1, 1 << 20), (3, 1 << 20), (3, 16), (1, 1)])
def test_brute_force(spark, monkeypatch, n, size):
    monkeypatch.setattr(I, "SLICE", size)
    rng = random.Random(n)
    make = lambda k: " ".join(rng.choice(["Größe", "the", "THE", "a-b", "x_y", "12", "日本", "\x00", "…"]) for _ in range(k))
    docs = [(i, make(rng.randrange(60))) for i in range(300)] + [(5, "the a " * 30)] * 3 + [(None, "the " * 40), (901, None), (902, ""), (903, "--- \t"), (904, "w" * 5000 + " the")]
    target = [make(9) for _ in range(20)] + [None, ""]
    got = I.resample(frame(spark, docs).repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), n, 97, 20, 30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, n, 97, 20, 30)


def test_empty_tables(spark):
    assert I.resample(frame(spark, []), frame(spark, [(1, "a b")])).count() == 0
    rows = I.resample(frame(spark, [(1, "a b " * 20)] * 10), frame(spark, [])).collect()
    assert sorted(r["rank"] or 0 for r in rows) == [0] * 9 + [1]


def test_long_text(spark):
    text = "Wort " * 700_000
    row = I.resample(frame(spark, [(1, text), (2, "x" * 3_000_000)]), frame(spark, [(1, "wort")])).orderBy("doc_id").collect()
    assert [r.n_features for r in row] == [700_000, 1]
