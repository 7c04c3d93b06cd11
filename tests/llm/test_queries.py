"""The queries against their SQL over the small tables, and against brute force where SQL can't say it."""

import collections
import hashlib

import pytest

from pyspark.sql import functions as F

from oracle import both
from quern.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    mine, theirs = both(spark, Q.QUERIES[name], Q.ORACLE_SQL[name], SF)
    assert mine == theirs


def texts(spark):
    return [(r.doc_id, r.text or "") for r in Q.table(spark, SF, "documents").collect()]


def cut(rows, unit):
    """doc_id to (units, removed, spans, hash of what is left), window by window."""
    seen, out = {}, {}
    for doc, text in sorted(rows):
        data = text.encode()
        units = data.split() if unit == "word" else [data[i : i + 1] for i in range(len(data))]
        gone = [False] * len(units)
        for i in range(len(units) - 49):
            key = tuple(units[i : i + 50])
            if seen.setdefault(key, doc) < doc:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        kept = (b" " if unit == "word" else b"").join(u for u, g in zip(units, gone) if not g)
        out[doc] = (len(units), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_op3_brute_force(spark, hot):
    from quern.llm.substring_dedup import substring_dedup

    want = cut(texts(spark), "word")
    got = substring_dedup(Q.table(spark, SF, "documents"), hot_from=hot).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {d: (a, b, h) for d, (a, b, _, h) in want.items()}


@pytest.mark.parametrize("hot", [4096, 2])
def test_op5_brute_force(spark, hot):
    from quern.llm.suffix_dedup import suffix_dedup

    got = suffix_dedup(Q.table(spark, SF, "documents"), hot_from=hot).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == cut(texts(spark), "byte")


@pytest.mark.parametrize("unit", ["word", "byte"])
def test_one_anchor_far_above_the_others(spark, unit):
    """A passage in all of 300 documents, others in a few, over many salts; every salt deals with its own documents."""
    import random

    from quern.llm.substring_dedup import substring_dedup
    from quern.llm.suffix_dedup import suffix_dedup

    rng = random.Random(9)
    make = lambda n: " ".join(f"v{rng.randrange(10**5)}" for _ in range(n))
    common, few = make(70), [make(60) for _ in range(5)]
    rows = [(i, " ".join([make(20), common, make(rng.randrange(30)), few[i % 5] if i % 20 < 5 else ""])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = cut(rows, unit)
    if unit == "word":
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df, hot_from=2).collect()}
        assert got == {d: (a, b, h) for d, (a, b, _, h) in want.items()}
    else:
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(df, hot_from=2).collect()} == want


def classes(rows):
    """doc_id to class: multiset Jaccard of five-word shingles, all pairs."""
    sets = {}
    for doc, text in rows:
        words, seen = text.lower().split(), collections.Counter()
        sets[doc] = set()
        for i in range(max(1, len(words) - 4) if words else 0):
            gram = tuple(words[i : i + 5])
            sets[doc].add((gram, seen[gram]))
            seen[gram] += 1
    of = {d: d for d in sets}
    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            n = len(sets[a] & sets[b])
            if n and n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) and of[a] != of[b]:
                low, high = sorted((of[a], of[b]))
                of = {d: low if c == high else c for d, c in of.items()}
    return of


def test_op7_brute_force(spark):
    got = {r.doc_id: (r.class_id, r.kept) for r in Q.op7_order_minhash(spark, SF).collect()}
    assert got == {d: (c, c == d) for d, c in classes(texts(spark)).items()}


def reference_codec():
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op10_equals_tiktoken(spark):
    codec = reference_codec()
    want = {}
    for doc, text in texts(spark):
        ids = codec.encode_ordinary(text)
        want[doc] = (len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = Q.op10_bpe(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_pipeline_brute_force(spark):
    """Each stage on what the one before kept, with the stages' own decisions worked out in plain Python."""
    import corpus_pipeline as P
    from quern.llm.toxicity import toxicity

    docs = Q.table(spark, SF, "documents")
    bad = {r.doc_id for r in toxicity(docs, Q.table(spark, SF, "labels")).filter("predicted = 1").collect()}
    left = {d: t for d, t in texts(spark) if d not in bad}
    lower = lambda t: t.translate({c: c + 32 for c in range(65, 91)})
    last = {}
    for d, t in sorted(left.items()):
        last[lower(t)] = d
    left = {d: left[d] for d in last.values()}
    left = {d: left[d] for d, c in classes(list(left.items())).items() if c == d}
    from pyspark.sql import functions as F

    from quern.llm.mixing import mix

    want = collections.Counter(r.doc_id for r in mix(docs.filter(F.col("doc_id").isin(list(left)))).collect())
    got = P.run(spark, SF).collect()
    assert collections.Counter(r.doc_id for r in got) == want
    assert all(r.decoded_sha256 == hashlib.sha256(left[r.doc_id].encode()).hexdigest() for r in got)


def test_op7_splits_large_families(spark, monkeypatch):
    from quern.llm import order_minhash

    monkeypatch.setattr(order_minhash, "BLOCK", 2)
    got = {r.doc_id: r.class_id for r in Q.op7_order_minhash(spark, SF).collect()}
    assert got == classes(texts(spark))


def test_op7_large_families_keep_pairs_of_one_key(spark, monkeypatch):
    """Texts alike enough that share a single table's key stay linked however large their family is."""
    import random

    from quern.llm import order_minhash as M

    rng = random.Random(7)
    made = []
    while len(made) < 20:
        a = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        b = a[:50] + [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 12))]
        labels, starts = M.labelled([[w.encode() for w in x] for x in (a, b)])
        one, other = labels[: starts[1]], labels[starts[1] :]
        n = M.aligned(one, other)
        if n >= 0.5 * (len(one) + len(other) - n) and (M.sketch(labels, starts)[0] == M.sketch(labels, starts)[1]).sum() == 1:
            made += [" ".join(a), " ".join(b)]
    monkeypatch.setattr(M, "BLOCK", 1)
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in M.near_classes(df, 0.5).collect()} == {i: i - i % 2 for i in range(len(made))}


def test_op7_large_group_of_edited_copies(spark, monkeypatch):
    """Copies of two texts with edits of their own, some cut short, over many small blocks and levels, against all pairs."""
    import random

    from quern.llm import order_minhash as M

    rng = random.Random(11)
    bases = [[f"w{rng.randrange(10**6)}" for _ in range(120)] for _ in range(2)]
    made = []
    for i in range(160):
        words = list(bases[i % 2])
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        made.append(" ".join(words[: rng.choice([120, 120, 112, 100, 92, 84])]))
    made.append(" ".join(bases[0][:60] + bases[1][60:]))
    monkeypatch.setattr(M, "BLOCK", 5)
    rows = list(enumerate(made))
    assert {r.doc_id: r.class_id for r in M.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()} == classes(rows)


def clustered(spark, tmp_path, n=700, seed=5):
    """A folder with an embeddings table whose vectors have links: tight and loose clusters, copies, odd rows; as Parquet."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 14, 64))
    rows = []
    for i in range(n):
        noise = rng.choice([0.02, 0.2, 0.3, 0.36, 0.6])
        c = centres[rng.integers(len(centres)) if rng.random() < 0.7 else 0]
        v = c + noise * rng.standard_normal(64)
        rows.append((i, [float(x) for x in v], int(rng.integers(2))))
    rows += [(n + i, rows[i][1], rows[i][2]) for i in range(20)] + [(n + 50, rows[0][1], None), (n + 51, None, 1), (n + 52, [0.0] * 64, 1), (n + 53, [float("nan")] * 64, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("block", [None, 8])
def test_op9_on_vectors_with_links(spark, tmp_path, monkeypatch, block):
    """Links and components against its SQL: none too many, recall above 0.99; the same when buckets are compared in small blocks."""
    import duckdb

    from quern.llm import embed_dedup

    if block:
        monkeypatch.setattr(embed_dedup, "BLOCK", block)
        monkeypatch.setattr(embed_dedup, "FEW", 2)
    folder = clustered(spark, tmp_path)
    got = {r.vec_id: r for r in Q.op9_embedding_dedup(spark, folder).collect()}
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    names = [c[0] for c in con.execute(Q.OP9_SQL).description]
    want = {r["vec_id"]: r for r in (dict(zip(names, x)) for x in con.execute(Q.OP9_SQL).fetchall())}
    found, there = sum(r.n_links for r in got.values()), sum(r["n_links"] for r in want.values())
    assert set(got) == set(want) and there > 2000 and 0.99 * there < found <= there
    assert all(got[i].n_links <= want[i]["n_links"] for i in got)
    same = sum(got[i].component_id == want[i]["component_id"] for i in got)
    assert same > 0.99 * len(got) and len({r["component_id"] for r in want.values()}) < 0.9 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_blocks_of_a_large_bucket_meet_once(spark, monkeypatch):
    """Two entries of near sizes meet in one task, both of the main part in none; no entry is sent to a task twice."""
    from itertools import combinations

    from quern.llm import order_minhash as M

    monkeypatch.setattr(M, "BLOCK", 3)
    data = [(1, i, 7 + i % 3, i >= 10) for i in range(40)]
    members = spark.createDataFrame(data, "bucket long, id long, level long, outside boolean")
    dealt = members.join(M._levels(members), ["bucket", "level"]).select("id", F.inline(M._tasks())).collect()
    tasks = {}
    for r in dealt:
        tasks.setdefault((r.x, r.y), []).append((r.id, r.side))
    met = {}
    for own in tasks.values():
        assert len({i for i, _ in own}) == len(own)
        for (a, s), (b, t) in combinations(sorted(own), 2):
            if s == t == 2 or {s, t} == {0, 1}:
                met[a, b] = met.get((a, b), 0) + 1
    want = {(a[1], b[1]): 1 for a, b in combinations(data, 2) if abs(a[2] - b[2]) <= 1 and (a[3] or b[3])}
    assert met == want
