"""The shared step of op3 and op5: what it indexes grows no faster than the input; buckets, filters, and what passes by the index."""

import random

import numpy as np
import pytest

from quern.llm import queries as Q
from quern.llm import repeats as R
from quern.llm import suffix_dedup as S


def words(rng, n):
    return " ".join(f"v{rng.randrange(10**5)}" for _ in range(n))


def test_many_shards_in_a_bucket(spark):
    docs = Q.table(spark, "/root/testdata/sf0.001", "documents")
    found = [S.suffix_dedup(docs, **limits).orderBy("doc_id").collect() for limits in ({}, {"shard_bytes": 100}, {"shard_bytes": 100, "hot_from": 2})]
    assert found[0] == found[1] == found[2]


def test_index_does_not_grow_with_salts(spark):
    """One passage in all of 400 documents: its contents are indexed for a few salts, not for each document."""
    rng = random.Random(5)
    common = words(rng, 40)
    rows = [(i, f"{words(rng, 20)} {common} {words(rng, 20)}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    indexed = spark.sparkContext.accumulator(0)

    def owners(texts, docs):
        indexed.add(sum(map(len, texts)))
        return S.owners(texts, docs)

    found = R.removals(df, "byte", owners, hot_from=2).collect()
    gone = {i: set() for i in range(400)}
    for r in found:
        gone[r.doc_id].update(range(r.first, r.end))
    assert not gone[0] and all(len(gone[i]) >= len(common) for i in range(1, 400))
    assert indexed.value <= 4 * sum(len(t) for _, t in rows)


@pytest.mark.parametrize("unit", ["byte", "word"])
def test_contested_texts_are_all_that_share_windows(unit):
    rng = random.Random(3)
    pieces = [words(rng, 30) for _ in range(12)]
    texts = [" ".join(words(rng, rng.randrange(3)) + " " + rng.choice(pieces) for _ in range(6)).encode() for _ in range(60)]
    s = R.Slice(texts, unit)
    doc, first, last, place = s.runs.T
    by = {}
    for c, a, b, p in zip(s.contents(first, last + R.WINDOW), first, last, place):
        by[c] = (int(p - a), int(b - a + 1))
    contents = list(by)
    some = set(R.contested(contents, np.array([by[c][0] for c in contents]), unit).tolist())
    units = [c if unit == "byte" else tuple(c.split()) for c in contents]
    holders = {}
    for i, u in enumerate(units):
        for j in range(len(u) - R.WINDOW + 1):
            holders.setdefault(u[j : j + R.WINDOW], set()).add(i)
    shared = set().union(*(h for h in holders.values() if len(h) > 1))
    assert shared and shared <= some
    assert len(some) < len(contents)


def test_windows_of_runs_are_hashes_of_their_bytes():
    rng = random.Random(1)
    texts = [words(rng, 60).encode(), b"x" * 49, words(rng, 80).encode()]
    s = R.Slice(texts * 2, "byte")
    of, at, hashes = s.windows(s.runs[::3])
    want = [(i, p) for i, (_, a, b, _) in enumerate(s.runs[::3].tolist()) for p in range(a, b + 1)]
    assert list(zip(of.tolist(), at.tolist())) == want
    same = {}
    for p, h in zip(at.tolist(), hashes.tolist()):
        assert same.setdefault(s.data[p : p + R.WINDOW], h) == h
    assert len(set(same.values())) == len(same)
    assert all(len(x) == 0 for x in s.windows(s.runs[:0]))


def test_filters_have_all_their_keys(spark, monkeypatch):
    """Also where they fill up; keys above a count have a filter of their own."""
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 40_000))
    n = rng.integers(2, 9, len(keys))
    found = spark.createDataFrame([*zip(keys.tolist(), n.tolist())], "key long, n long").repartition(3)
    others = np.setdiff1d(rng.integers(0, 1 << 48, 40_000), keys).view(np.uint64)
    for bits in (R.FILTER_BITS, 1 << 15):
        monkeypatch.setattr(R, "FILTER_BITS", bits)
        every, some = R.BitFilter.of(found, [(1, len(keys)), (6, int((n > 6).sum()))])
        assert every.has(keys.view(np.uint64)).all() and some.has(keys[n > 6].view(np.uint64)).all()
        assert len(every.words) * 64 <= max(bits, 64 * every.parts)
        if bits > 1 << 15:
            assert every.has(others).mean() < 0.03 and some.has(keys[n <= 6].view(np.uint64)).mean() < 0.03
