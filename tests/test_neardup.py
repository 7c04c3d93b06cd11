"""Keep-first dedupe over a corpus against the loop in order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import neardup as N
from quern.plans import qa_queries


def loop(rows, threshold):
    kept = []
    for ord_, v in sorted(rows, key=lambda r: r[0]):
        x = None if v is None or None in v else np.array(v, float)
        if x is None or not (x @ x > 0):
            kept.append((ord_, None))
        elif not any(k is not None and x @ k / np.sqrt((x @ x) * (k @ k)) > threshold for _, k in kept):
            kept.append((ord_, x))
    return sorted(o for o, _ in kept)


def frame(spark, rows):
    return spark.createDataFrame([(o, v, 1, True) for o, v in rows], "ord long, vector array<double>, near int, kept boolean").repartition(5)


@pytest.mark.parametrize("block, share", [(1024, 0.1), (7, 1.0)])
def test_equals_the_loop(spark, monkeypatch, block, share):
    """Chains (each near the next, not the one after), families of near copies, equal and unlike vectors."""
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "SHARE", share)
    rng = np.random.default_rng(4)
    rows = []
    for c in range(6):
        plane = np.linalg.qr(rng.standard_normal((16, 2)))[0]
        rows += [plane @ [np.cos(a), np.sin(a)] for a in np.arange(0, 5, 0.35)]
    for c in range(4):
        base = rng.standard_normal(16)
        rows += [base + 0.25 * rng.standard_normal(16) for _ in range(25)]
    rows += [rows[3], rows[40] * 2, rows[40]]
    rows += list(rng.standard_normal((60, 16)))
    rng.shuffle(rows)
    data = [(10 * i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(-1, None), (-2, [0.0] * 16), (5, [0.0] * 16), (7, [None] + [1.0] * 15)]
    got = sorted(r.ord for r in N.keep_first(frame(spark, data), 0.7, 0.99999).collect())
    assert got == loop(data, 0.7)


def test_a_large_family_goes_in_one_pass(spark, monkeypatch):
    """Near copies of one vector are settled by the first look, so no block of theirs is ever compared."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal(16)
    data = [(i, (base + 0.02 * rng.standard_normal(16)).tolist()) for i in range(3000)]
    monkeypatch.setattr(N, "_earliest", lambda *_: (None, None))
    assert [r.ord for r in N.keep_first(frame(spark, data), 0.7).collect()] == [0]


def test_empty_and_alone(spark):
    assert N.keep_first(frame(spark, []).limit(0)).count() == 0
    assert [r.ord for r in N.keep_first(frame(spark, [(3, [1.0, 0.0])])).collect()] == [3]


def test_query_equals_the_loop(spark):
    """All questions of the table in one group."""
    sf = "/root/testdata/sf0.01"
    data = [(r.ord, r.vector) for r in qa_queries._question_vectors(spark, sf).collect()]
    got = sorted(r.ord for r in qa_queries.QUERIES["q11_corpus_dedupe"](spark, sf).collect())
    assert got == loop(data, 0.7) and 0 < len(got) < len(data)


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine just above the threshold, the hardest ones, share a band as often as asked for."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.701 * a + np.sqrt(1 - 0.701**2) * b).tolist())]
    bits, n = N.plan(3000, 0.7, 0.99)
    spots = N.bands(frame(spark, rows).select("ord", "vector"), bits, n)
    met = spots.groupBy("band", "key", F.shiftright("ord", 1).alias("pair")).count().filter("count = 2").select("pair").distinct().count()
    assert met >= 0.98 * 1500


@pytest.mark.parametrize("first, share", [(5, 1.0), (40, 0.1)])
def test_first_rows_then_bands(spark, monkeypatch, first, share):
    """Families of near copies beside unlike vectors: the loop over first rows takes the families, bands the rest."""
    monkeypatch.setattr(N, "FIRST", first)
    monkeypatch.setattr(N, "SHARE", share)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((3, 16))
    rows = [base[i % 3] + 0.2 * rng.standard_normal(16) for i in range(90)] + list(rng.standard_normal((60, 16)))
    rng.shuffle(rows)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(-1, None), (500, [0.0] * 16)]
    assert sorted(r.ord for r in N.keep_first(frame(spark, data), 0.7, 0.99999).collect()) == loop(data, 0.7)


def test_few_rows_are_never_hashed(spark, monkeypatch):
    monkeypatch.setattr(N, "bands", None)
    rng = np.random.default_rng(6)
    data = [(i, rng.standard_normal(16).tolist()) for i in range(300)]
    assert sorted(r.ord for r in N.keep_first(frame(spark, data), 0.7).collect()) == loop(data, 0.7)
