"""The byte network: gradients against differences, chunks that cover all of a text, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from quern.llm import queries as Q
from quern.llm import quality_net as N


def test_chunks_cover_every_byte():
    for n in [0, 1, 511, 512, 513, 960, 961, 5000]:
        data = bytes(1 + i % 255 for i in range(n))
        got = N.chunks_of(data)
        spots = (np.arange(len(got))[:, None] * N.STEP + np.arange(N.CHUNK)).ravel()
        assert set(range(n)) <= set(spots.tolist()) and (n == 0 or (len(got) - 1) * N.STEP < n)
        assert all(got.ravel()[i] == (data[s] if s < n else 0) for i, s in enumerate(spots))


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = N.Net.start()
    for name in ("embed", "filters", "bias", "hidden", "hidden_bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64) + 0.01)
    net.embed[0] = 0
    chunks, first, y, w = rng.integers(1, 90, (5, N.CHUNK)).astype(np.uint8), np.array([0, 2]), np.array([0, 1]), np.array([0.7, 1.2])

    def loss():
        logit = net.combine(net.features(chunks), first)[2]
        return float((w * (np.logaddexp(0, logit) - y * logit)).sum())

    for part, grad in zip(net.parts, net.gradients(chunks, first, y, w)):
        flat, want = part.reshape(-1), np.asarray(grad).reshape(-1)
        for i in np.argsort(-np.abs(want))[:4]:
            old, h = flat[i], 1e-6
            flat[i] = old + h
            up = loss()
            flat[i] = old - h
            down = loss()
            flat[i] = old
            assert (up - down) / (2 * h) == pytest.approx(want[i], rel=2e-3, abs=1e-7)


def test_same_score_alone_and_in_a_batch():
    net = N.Net.start(3)
    texts = [b"", b"abc", b"x y " * 2000, bytes(range(256)) * 9]
    assert np.allclose(net.scores(texts), [net.scores([t])[0] for t in texts], atol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in Q.table(spark, sf, "labels").collect()}
    rows = Q.op11_quality(spark, sf).collect()
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    auc = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95 and sum(p == y for _, p, y in held) / len(held) > 0.95


def test_odd_rows(spark):
    rng = random.Random(5)
    text = lambda junk: " ".join("".join(rng.choices("abcdefgh", k=4)) + ("###" if junk else "") for _ in range(80))
    rows = [(i, text(i % 3 == 0)) for i in range(120)] + [(5, text(False)), (None, text(False)), (7, None), (8, ""), (9, "a b " * 100_000), (9, "a b " * 100_000)]
    docs = spark.createDataFrame([(d, t, 2.0, True, 1) for d, t in rows], "doc_id long, text string, score double, held_out boolean, quality int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)] + [(200, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = N.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    judged = [r for r in got if r.doc_id is not None and r.doc_id > 9]
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in judged) > 0.9 * len(judged)
    again = [r.score for r in got if r.doc_id == 9 and r.score]
    assert len({round(s, 12) for s in again[-2:]}) == 1
    assert N.quality(docs.limit(0), labels).count() == 0 and N.quality(docs, labels.limit(0)).count() == len(rows)
