"""Features that the shared tables can't show: folders, crashes, files, the relational store, model families."""

import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import analytics as M
from quern.operators import answers as A
from quern.operators import catalog as D
from quern.operators import export as E
from quern.operators import questions as Q
from quern.operators import registry as R
from quern.operators import trainset as T
from quern.sources import files as S
from quern.sources import report_files as P


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


# Folders


def tree(root):
    for path in ["a.txt", "x/b.MD", "x/y/z/c.pdf", "my_venv/lost.txt", "x/.cache/deep/lost.txt", "lib64x/lost.bin"]:
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(path)
    (root / "empty").mkdir()
    (root / "x" / "loop").symlink_to(root / "x")


def test_walk_lists_all_but_pruned_folders(spark, tmp_path):
    tree(tmp_path)
    found = S.walk(spark, str(tmp_path))
    assert rows(found, "path", "length") == sorted((str(tmp_path / p), len(p)) for p in ["a.txt", "x/b.MD", "x/y/z/c.pdf"])
    assert {r.flag: r.n for r in S.inventory(found).collect()} == {"OK": 3} and rows(S.allowed_files(found), "length") == [(5,), (6,), (11,)]
    assert found.filter("modificationTime > current_timestamp() - interval 1 hour and modificationTime <= current_timestamp()").count() == 3
    assert S.walk(spark, str(tmp_path / "empty")).count() == 0


def test_pruned_folders_are_never_opened(tmp_path, monkeypatch):
    tree(tmp_path)
    opened, scan = [], os.scandir
    monkeypatch.setattr(os, "scandir", lambda p: opened.append(str(p)) or scan(p))
    level = [str(tmp_path)]
    while level:
        level = [r[0] for r in S.list_folders(level) if r[1]]
    assert sorted(opened) == sorted(map(str, [tmp_path, tmp_path / "x", tmp_path / "x/y", tmp_path / "x/y/z", tmp_path / "empty"]))


# Tables written in place


def test_upsert_replaces_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    S.save_keyed(spark.range(200).selectExpr("id as question_id", "'old' as best_model"), path, "question_id", 16)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("_part=*/*.parquet")}
    before = files()
    new = spark.createDataFrame([(3, "new"), (5000, "new")], "question_id long, best_model string")
    S.upsert(path, new, "question_id", A.overwrite_rankings, 16)
    after = files()
    kept = {p.parent.name for p in before if p in after}
    assert len(kept) >= 14 and all(before[p] == after[p] for p in before if p in after)
    assert rows(S.load_keyed(spark, path), "question_id", "best_model") == sorted([(i, "new" if i == 3 else "old") for i in range(200)] + [(5000, "new")])
    S.upsert(path, new, "question_id", A.overwrite_rankings, 16)  # again: the same table
    assert S.load_keyed(spark, path).count() == 201


def test_name_index_equals_the_scan(spark, tmp_path):
    rng = random.Random(8)
    names = ["".join(rng.choice("abAB.ü/") for _ in range(rng.randrange(0, 12))) for _ in range(400)] + [None, "ab"]
    docs = spark.createDataFrame(list(enumerate(names)), "id long, file_path string")
    D.save_name_index(docs, str(tmp_path / "i"))
    for part in ["", "a", "ab", "aba", "ABab", "ü/a", "aaaa", "abababab", "zzz", "a.b", "%"]:
        want = [(i,) for i, n in enumerate(names) if not part or n is not None and part.lower() in n.lower()]
        assert rows(D.search_names(docs, str(tmp_path / "i"), part), "id") == want
    plan = D.search_names(docs, str(tmp_path / "i"), "abab")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "part#" in plan.split("PartitionFilters")[1][:200]


# Percentiles


@pytest.mark.parametrize("parts", [100, 3])
def test_exact_percentiles(spark, monkeypatch, parts):
    monkeypatch.setattr(M, "PARTS", parts)
    rng = random.Random(3)
    data = [(g, rng.choice([rng.random(), rng.random() ** 9 * 1000, 7.0])) for g in "abc" for _ in range(700)] + [("d", None), ("e", 1.0), ("c", None)]
    shares = {"p1": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: tuple(r)[1:] for r in M.exact_percentiles(spark.createDataFrame(data, "g string, v double"), ["g"], "v", shares).collect()}
    import math

    want = {}
    for g in "abce":
        own = sorted(v for x, v in data if x == g and v is not None)
        want[g] = tuple(own[max(0, math.ceil(len(own) * p) - 1)] for p in shares.values())
    assert got == want


def test_sketches_of_days_merge(spark):
    df = spark.range(0, 60_000, 1, 8).selectExpr("'m' as g", "pow(id * 7919 % 60000, 2) as v", "timestamp_seconds(id * 60) as ts")
    daily = M.daily_sketches(df, ["g"], "v", "ts")
    r = M.merged_percentiles(daily, ["g"], {"p50": 0.5, "p99": 0.99}).first()
    assert daily.count() == 42 and r.n == 60_000
    assert all(abs(x**0.5 / 60_000 - p) <= M.RANK_ERROR for x, p in ((r.p50, 0.5), (r.p99, 0.99)))


# Generation that can go on after a crash


def work(spark):
    return spark.range(300).selectExpr("id as question_id", "concat('m', id % 3) as model_name", "concat('q', id) as question").repartition(6)


SCHEMA, KEY = "question_id long, model_name string, answer string", ["question_id", "model_name"]


def test_generation_goes_on_after_a_crash(spark, tmp_path):
    """The worker dies in a slice; the second call makes only what is missing."""
    out, log, flag = str(tmp_path / "out"), tmp_path / "log", tmp_path / "crashed"
    log.mkdir()

    def make():
        def model(pdf):
            if 150 in set(pdf["question_id"]) and not flag.exists():
                flag.write_text("")
                os._exit(1)
            (log / uuid.uuid4().hex).write_text(" ".join(map(str, pdf["question_id"])))
            return pdf[["question_id", "model_name"]].assign(answer=pdf["question"])

        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        with pytest.raises(Exception):
            Q.generate_resumable(work(spark), make, SCHEMA, KEY, out, "model_name", slices=5)
        first = {int(x) for p in log.iterdir() for x in p.read_text().split()}
        done = {r.question_id for r in spark.read.schema(SCHEMA).parquet(out).collect()}
        for p in log.iterdir():
            p.unlink()
        got = Q.generate_resumable(work(spark), make, SCHEMA, KEY, out, "model_name", slices=5).collect()
        again = [int(x) for p in log.iterdir() for x in p.read_text().split()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(done) < 300 and done <= first and sorted(again) == sorted(set(range(300)) - done)
    assert sorted((r.question_id, r.answer, r.error) for r in got) == [(i, f"q{i}", None) for i in range(300)]


def test_one_bad_row_is_quarantined(spark, tmp_path):
    def make():
        def model(pdf):
            if (pdf["question_id"] % 100 == 7).any():
                raise KeyError("no such thing")
            return pdf[["question_id", "model_name"]].assign(answer="ok")

        return model

    got = Q.generate_resumable(work(spark), make, SCHEMA, KEY, str(tmp_path / "o"), slices=2).collect()
    bad = {r.question_id: r.error for r in got if r.error}
    assert len(got) == 300 and set(bad) == {7, 107, 207} and "no such thing" in bad[7] and all((r.answer is None) == bool(r.error) for r in got)


# Files and stores


def test_report_files(spark, tmp_path):
    out = tmp_path / "reports"
    df = spark.createDataFrame([(i, f"Bericht ü {i}\nline") for i in range(40)] + [(99, None)], "doc_id long, report string").repartition(4)
    P.save_reports(df, str(out))
    files = {p.name: p.read_bytes() for p in out.glob("part-*/*.txt")}
    assert files == {f"{i}.txt": f"Bericht ü {i}\nline".encode() for i in range(40)} | {"99.txt": b""} and (out / "_SUCCESS").exists()
    assert not [p for p in out.iterdir() if p.name.startswith("_staging")]
    assert rows(P.read_reports(spark, str(out)), "name") == sorted((n,) for n in files if files[n])
    P.save_reports(df.filter("doc_id < 3"), str(out), "overwrite")
    assert sorted(p.name for p in out.glob("part-*/*.txt")) == ["0.txt", "1.txt", "2.txt"]


def test_report_parts_are_streamed_into_one_file(spark, tmp_path):
    """Heads first, then chunks by page and id, as in the text of one row; a long report in many parts."""
    rng = random.Random(4)
    data = [(d, f"ctx {d} {c}", f"d{d}", rng.choice([None, 1, 2, 10]), f"c{c}", d * 100 + c, 1, "q?", "m", "a", True) for d in range(12) for c in range(200 if d == 5 else 3)]
    df = spark.createDataFrame(data, "doc_id long, context string, document string, page int, chunk_id string, question_id int, question_index int, question string, model_name string, answer string, is_best boolean").repartition(5)
    P.save_report_parts(E.report_parts(df), str(tmp_path / "r"))
    files = {p.name: p.read_text() for p in (tmp_path / "r").glob("part-*/*.txt")}
    assert files == {f"{r.doc_id}.txt": r.report for r in E.text_report(df).collect()} and len(files["5.txt"]) > 50_000


def test_a_failed_report_write_leaves_nothing(spark, tmp_path):
    out = tmp_path / "reports"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "doc_id long, report string").coalesce(1)
    with pytest.raises(Exception, match="two reports named"):
        P.save_reports(df, str(out))
    assert not list(out.glob("**/*.txt"))


def test_report_tables_are_saved(spark, tmp_path):
    df = spark.createDataFrame([(1, "s", "c", 5, 1, "q?", "m", "a, \"b\"\nc", 0.5, True)], "doc_id int, document string, chunk_id string, question_id int, question_index int, question string, model_name string, answer string, score double, is_best boolean")
    S.save_report(E.report_tables(df), str(tmp_path / "r"), "parquet")
    back = {n: spark.read.parquet(str(tmp_path / "r" / n)) for n in ("qna", "questions", "answers")}
    assert rows(back["answers"]) == [(5, "m", "a, \"b\"\nc", 0.5, True)] and rows(back["qna"], "question") == rows(back["questions"], "question") == [("q?",)]
    S.save_report({"questions": back["questions"]}, str(tmp_path / "csv"))
    assert (next((tmp_path / "csv/questions").glob("*.csv")).read_text().splitlines()) == ["doc_id,document,chunk_id,question_id,question_index,question", "1,s,c,5,1,q?"]


def test_structure_files(spark, tmp_path):
    for i in range(3):
        chunks = [{"page": 1, "chunk_type": "text", "text": f"t{i}{k}"} for k in range(i)]
        (tmp_path / f"{i}.json").write_text(json.dumps({"source_path": f"/d/{i}", "doc_type": "pdf", "total_pages": 1, "chunks": chunks}, indent=2))
    got = rows(S.read_structures(spark, str(tmp_path)).select("source_path", F.coalesce("ord", F.lit(-1)).alias("ord"), F.coalesce("text", F.lit("")).alias("text")))
    assert got == [("/d/0", -1, ""), ("/d/1", 0, "t10"), ("/d/2", 0, "t20"), ("/d/2", 1, "t21")]


def test_relational_store(spark):
    """An embedded database by JDBC: written, appended to, read at once and in parts."""
    jdbc = {"url": f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, f"n{i}", None if i % 3 else i / 2) for i in range(60)], "id long, name string, score double")
    S.save_table(df, "answers", jdbc)
    S.save_table(df.withColumn("id", F.col("id") + 100), "answers", jdbc)
    whole, split = S.load_table(spark, "answers", jdbc), S.load_table(spark, "answers", jdbc, "id", 4)
    assert whole.count() == split.count() == 120 and split.rdd.getNumPartitions() == 4
    assert sorted(map(str, rows(split.select("id", "name", F.coalesce("score", F.lit(-1.0)))))) == sorted(map(str, rows(whole.select("id", "name", F.coalesce("score", F.lit(-1.0))))))


# Values and rules


def test_white_space_is_pythons(spark):
    odd = ["　", " ", "\u0085", " ", "\x1c", " ", "\t", "\n", "\x0b", "​", "﻿"]
    texts = ["".join(random.Random(i).choices([*odd, "a", "B"], k=9)) for i in range(300)] + ["", "\n", "a\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: (r.s, r.w) for r in df.select("i", X.strip(F.col("t")).alias("s"), X.words(F.col("t")).alias("w")).collect()}
    assert got == {i: (t.strip(), t.split()) for i, t in enumerate(texts)}


def test_cleaners_of_model_families(spark):
    cases = [
        ("TinyLlama-1.1B", " Assistant: answer- Here is what I found: It runs. And more", "It runs."),
        ("tinyllama", "A: q: Overall, it holds", "it holds."),
        ("openelm-simple", "user <|im_start|>assistant a<|im_start|>assistant It << is   so? Yes! no. end", "It is so? Yes! no."),
        ("openelm-simple", "What? No!", "What?"),
        ("openelm-simple", "No\n!x", "No !"),
        ("openelm-simple", "no end", "no end"),
        ("qwen", "Response: 'It runs'", "'It runs'."),
        (None, "Answer: `It runs`", "It runs."),
    ]
    df = spark.createDataFrame([(i, m, a) for i, (m, a, _) in enumerate(cases)], "i int, model_name string, answer string")
    assert rows(A.clean_by_model(df), "i", "answer") == [(i, w) for i, (_, _, w) in enumerate(cases)]


def test_strict_eligibility(spark):
    docs = spark.createDataFrame([(1, "en", 1, 2), (2, None, None, None)], "id long, domain_code string, audience_id long, severity int")
    tags = spark.createDataFrame([(1, "SOP")], "document_id long, tag string")
    own = spark.createDataFrame([(1,)], "doc_id long")
    report = D.eligibility(docs, tags, own, own)
    assert {r.id: r.errors for r in report.collect()} == {1: [], 2: ["missing tags", "missing domain", "missing audience", "missing criticality", "no chunks", "no ranked answers"]}
    assert D.require_eligible(report.filter("id = 1")).count() == 1 and D.require_eligible(report.filter("id = 1")).first().errors == []
    with pytest.raises(Exception, match="Document id=2 invalid: missing tags, missing domain"):
        D.require_eligible(report).collect()


def test_refusals(spark):
    df = spark.createDataFrame([(1, "the pump runs", True), (2, "no idea", False), (3, "x", None)], "i int, answer string, ok boolean")
    assert rows(A.ground_or_refuse(df, F.col("ok")), "i", "answer") == [(1, "the pump runs"), (2, A.INSUFFICIENT), (3, A.INSUFFICIENT)]


def test_whole_rows_make_the_hash(spark):
    base = [("d", "text", 1), ("d", None, 2), ("d", "", 3)]
    hash_of = lambda data, schema="name string, t string, n int": R.content_hashes(spark.createDataFrame(data, schema), "name").first().content_hash
    want = hash_of(base)
    assert hash_of(base[::-1]) == want
    others = [[*base[:2], ("d", "", 4)], [base[0], ("d", "", 2), base[2]], [*base, base[0]]]
    assert len({want, *map(hash_of, others), hash_of(base, "name string, t2 string, n int"), hash_of(base, "name string, t string, n long")}) == 6


def test_register_takes_the_smallest_path(spark):
    new = [("b", "d/v2/x", "h1"), ("a", "d/v1/x", "h1"), ("c", "d/v3/x", "h0"), ("e", "d/v9/y", "h2")]
    registry = spark.createDataFrame([("h0",)], "content_hash string")
    df = spark.createDataFrame(new, "name string, path string, content_hash string")
    for n in (1, 3):
        assert rows(R.register(registry, df.repartition(n)), "content_hash", "name", "path", "version") == [("h1", "a", "d/v1/x", "v1"), ("h2", "e", "d/v9/y", "v9")]


def test_labels_are_numbered_over_partitions(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("id as ord", "concat('l', lpad(cast(id * 7919 % 1000 as string), 4, '0')) as label")
    got = {r.label: r.label_id for r in T.sorted_labels(df).collect()}
    assert got == {f"l{i:04d}": i for i in range(1000)}
    seen = {}
    for i in range(5000):
        seen.setdefault(f"l{i * 7919 % 1000:04d}", len(seen))
    assert {r.label: r.label_id for r in T.first_seen_labels(df).collect()} == seen and T.sorted_labels(df.limit(0)).count() == 0


def test_surrogate_ids_and_newest_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, at int, v string")
    ids = D.next_ids(df.repartition(3), ["k", "at"]).collect()
    assert len({r.id for r in ids}) == 3 and {r.id for r in ids} == {r.id for r in D.next_ids(df.repartition(1), ["k", "at"]).collect()}
    assert rows(D.latest(df, "k", "at")) == [("a", 3, "y"), ("b", 2, "z")]


def test_rejected_training_rows(spark):
    df = spark.createDataFrame([("p", "r", None), (None, "r", None), ("p", "", "t"), ("p", None, "")], "prompt string, response string, text string")
    assert rows(T.sft_rejects(df).select(F.coalesce("prompt", F.lit("-")), F.coalesce("response", F.lit("-")))) == [("-", "r"), ("p", "-")]
