"""Literal frames for branches that the tables don't hold, and loops that the window forms must equal."""

import random
import textwrap

import pytest
from pyspark.sql import functions as F

from quern.functions.text import SPACE, SPACE_JAVA, SPACES
from quern.operators import answers as A
from quern.operators import catalog as D
from quern.operators import chunks as C
from quern.operators import export as E
from quern.operators import extract as X
from quern.operators import questions as Q
from quern.operators import registry as R
from quern.operators import trainset as T
from quern.sources import files as S


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


def test_merge_headings_equals_the_loop(spark):
    rng = random.Random(1)
    data = [(d, i, f"t{i}", i // 3, rng.choice(["heading", "text"])) for d in range(60) for i in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(data, "doc_id long, ord int, text string, page int, chunk_type string")
    got = sorted(rows(C.merge_headings(df), "doc_id", "ord", "text", "page"))
    want = []
    for d in range(60):
        own = [x for x in data if x[0] == d]
        i = 0
        while i < len(own):
            if own[i][4] == "heading" and i + 1 < len(own):
                want.append((d, own[i][1], own[i][2] + "\n" + own[i + 1][2], own[i + 1][3]))
                i += 2
            else:
                want.append((d, own[i][1], own[i][2], own[i][3]))
                i += 1
    assert got == sorted(want)


def test_normalize_prefers_true_pages(spark):
    df = spark.createDataFrame([(1, 0, 4, 7, "", "md", ""), (2, 0, 0, 0, None, None, None), (3, None, None, None, "x", "md", "t")], "doc_id int, page int, page_number int, page_index int, text string, markdown string, chunk_type string")
    assert sorted(rows(C.normalize_schema(df), "doc_id", "page", "text", "chunk_type")) == [(1, 4, "md", "content"), (2, 0, "", "content"), (3, 1, "x", "t")]


def test_strip_lines_takes_hard_spaces(spark):
    df = spark.createDataFrame([(" a \n\t b c ",)], "text string")
    assert rows(C.strip_lines(df)) == [("a\nb c",)]


def test_sections_clear_subsections(spark):
    texts = ["MAIN PART", "A RATHER LONG SUBTITLE OF FIVE", "body", "NEXT", "body two", "Ends with colon:"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id int, ord int, text string")
    got = rows(C.fill_sections(C.with_levels(df)).orderBy("ord"), "section", "subsection")
    assert got == [("MAIN PART", None), ("MAIN PART", texts[1]), ("MAIN PART", texts[1]), ("NEXT", None), ("NEXT", None), (texts[5], None)]


def test_markdown_sections(spark):
    lines = ["intro", "# One", "body", "# Empty", "## Two", ""]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(lines)], "doc_id string, ord int, line string")
    assert rows(X.markdown_sections(df).orderBy("page"), "page", "text") == [(1, "Document Start\nintro"), (2, "One\nbody"), (3, "Two")]


def test_page_blocks_take_carriage_returns(spark):
    df = spark.createDataFrame([(1, 1, "a b c d\r\n\r\ntoo short\r\n\r\ne f g h i")], "doc_id int, page int, text string")
    assert [r.text for r in X.page_blocks(df).collect()] == ["a b c d", "e f g h i"]


def test_clean_markdown(spark):
    df = spark.createDataFrame([("<think>x</think>```md\n# A\n``` ",), ("plain",), ("a</think>b</think> c",)], "t string")
    assert [r[0] for r in df.select(X.clean_markdown(F.col("t"))).collect()] == ["# A", "plain", "c"]


def test_blank_headers_get_column_names(spark):
    df = spark.createDataFrame([("s", 1, ["h", " "]), ("s", 2, ["a", "b"]), ("s", 3, ["", None])], "sheet string, row_no int, cells array<string>")
    assert rows(X.table_rows_to_text(df)) == [("s", 2, "Sheet: s\nRow 2:\nh: a\nColumn_2: b")]


def test_statement_rules(spark):
    cases = {
        "The valve must be closed first.": "What must be done be closed first?",
        "The relay enables the fan when hot.": "What does The relay enables?",
        "A fault occurs after ten seconds.": "What happens when A fault?",
        "Pumps are painted blue.": "What is stated about Pumps?",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r[0] for r in df.select(Q.statement_to_question(F.col("s"))).collect()] == list(cases.values())


def test_greedy_dedupe_equals_the_loop(spark):
    rng = random.Random(2)
    data = [(g, i, [rng.gauss(0, 1) + 0.7 for _ in range(4)]) for g in range(20) for i in range(12)]
    got = sorted(rows(Q.greedy_dedupe(spark.createDataFrame(data, "g int, ord int, vector array<double>"), "g", 0.7)))
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    want = []
    for g in range(20):
        kept = []
        for _, i, v in (x for x in data if x[0] == g):
            if all(cos(v, k) <= 0.7 for k in kept):
                kept.append(v)
                want.append((g, i))
    assert got == sorted(want)


def test_prompts_need_their_columns(spark):
    df = spark.createDataFrame([("c" * 50, None)], "context string, question string")
    assert rows(Q.render_prompt(df, "{context}|{question}", 10, "head"), "prompt") == [("ccccccccc|",)]
    with pytest.raises(ValueError, match="answer"):
        Q.render_prompt(df, "{answer}")


def test_score_and_extract(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("pump is hot",), ("zzz",)], "a string")
    got = [r[0] for r in df.select(A.score(F.col("a"), F.lit("the pump is hot now"))).collect()]
    assert got == [float("-inf"), float("-inf"), -12.0, 3.0, -12.0]
    df = spark.createDataFrame([("Answer: the pump Question: x?",), ("Answer: why pump?",), ("nothing",), (None,)], "a string")
    assert [r[0] for r in df.select(A.extract(F.col("a"), F.lit("which pump"))).collect()] == ["the pump", None, None, None]


def test_clean_output(spark):
    df = spark.createDataFrame([("Assistant: According to the context, `it is 5`. More.",), ("",), ("no mark",)], "a string")
    assert [r[0] for r in df.select(A.clean_output(F.col("a"))).collect()] == ["it is 5`.", "", "no mark."]


def test_sole_answer_is_not_worst(spark):
    df = spark.createDataFrame([(1, "a", 1, "x", 2.0), (2, "a", 1, "x", 1.0), (2, "b", 2, "y", 1.0)], "question_id int, model_name string, ord int, answer string, score double")
    assert sorted(rows(A.rank_models(df), "question_id", "model_name", "is_best", "is_worst")) == [(1, "a", True, False), (2, "a", True, False), (2, "b", False, True)]


def test_failures_are_loud(spark):
    levels = spark.createDataFrame([("LOW", 1)], "code string, severity int")
    docs = spark.createDataFrame([(1, 1)], "id long, severity int")
    with pytest.raises(Exception, match="unknown criticality"):
        D.max_severity(docs, levels, "NOPE").collect()
    reg = spark.createDataFrame([("n", "v001", "p", "h"), ("n", "v001", "q", "i")], "name string, version string, path string, content_hash string")
    with pytest.raises(Exception, match="not exactly one"):
        R.resolve(reg.select("name", "version").distinct(), reg).collect()
    with pytest.raises(Exception, match="no version"):
        R.register(reg, spark.createDataFrame([("n", "a/b.jsonl", "z")], "name string, path string, content_hash string")).collect()
    with pytest.raises(Exception, match="empty"):
        T.step_plan(spark.createDataFrame([], "prompt string, response string"), 1, 1, 1).collect()


def test_json_round_trip_and_bad_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None)], "a int, b string, c string")
    S.write_jsonl(df, str(tmp_path / "x"))
    written = "".join(p.read_text("utf-8") for p in sorted((tmp_path / "x").glob("part-*")))
    assert written.strip() == '{"a":1,"b":"é","c":null}'
    lines = spark.createDataFrame([(1, '{"a": 1}'), (2, "  "), (3, "{bad")], "line_no long, value string")
    assert [r.line_no for r in S.parse_jsonl(lines, "a int", True).orderBy("line_no").collect()] == [1, 3]
    with pytest.raises(Exception, match="line 3"):
        S.parse_jsonl(lines, "a int").collect()


def test_append_logs_and_files(spark, tmp_path):
    log = str(tmp_path / "log")
    one = spark.createDataFrame([("m", 1, 5)], "model_name string, version int, rating int")
    S.append_feedback(one, log)
    S.append_feedback(one, log)
    assert S.read_log(spark, log, S.FEEDBACK).filter("timestamp is not null").count() == 2
    (tmp_path / "docs" / "deep").mkdir(parents=True)
    for name in ("a.TXT", "deep/b.md", "deep/c.exe"):
        (tmp_path / "docs" / name).write_text("x")
    found = S.allowed_files(S.list_files(spark, str(tmp_path / "docs")))
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == ["a.TXT", "b.md"]


def test_streams_take_a_path_once(spark, tmp_path):
    from quern.streaming import streams as ST

    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    text = "A line that is long enough to stay in the table of chunks."
    for n in range(2):  # the second run finds the same path in a new file
        spark.createDataFrame([("a.txt", text), (f"b{n}.txt", text)], "path string, text string").write.mode("append").parquet(source)
        ST.ingest(spark.readStream.schema("path string, text string").parquet(source), out, state)
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == ["a.txt", "b0.txt", "b1.txt"]


def test_ids_hold_over_partitions(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("doc_id"), F.col("id").cast("int").alias("ord"), F.concat(F.lit("some text that is long enough to be kept "), F.col("id").cast("string")).alias("text"), F.lit(1).alias("page"))
    one, many = (sorted(rows(C.chunk_ids(x), "doc_id", "ord", "chunk_id")) for x in (df.repartition(1), df.repartition(64)))
    assert one == many


def test_text_report_equals_the_loop(spark):
    """Two chunks of one document, one without questions; long lines; ties of models; a question without answers."""
    import textwrap

    long = " ".join(f"word{i}" for i in range(60))
    flat = [
        (1, "d", 2, "p2_c1", None, long, 20, 1, "Why?", "m1", long, False),
        (1, "d", 2, "p2_c1", None, long, 20, 1, "Why?", "m0", "short", True),
        (1, "d", None, "p0_c1", "S", "first", None, None, None, None, None, None),
        (1, "d", 2, "p2_c1", None, long, 21, 0, "Who?", None, None, None),
        (2, "e", 1, "p1_c1", None, None, 30, 1, "What?", "m0", "a", False),
    ]
    names = ["doc_id", "document", "page", "chunk_id", "section", "context", "question_id", "question_index", "question", "model_name", "answer", "is_best"]
    df = spark.createDataFrame(flat, "doc_id long, document string, page int, chunk_id string, section string, context string, question_id long, question_index int, question string, model_name string, answer string, is_best boolean")
    got = {r.doc_id: r.report for r in E.text_report(df.repartition(3)).collect()}
    for doc in (1, 2):
        own = [dict(zip(names, r)) for r in flat if r[0] == doc]
        lines = ["=" * 140, f"DOCUMENT: {own[0]['document']}", "PATH:     None", "=" * 140]
        for chunk in sorted({r["chunk_id"] for r in own}, key=lambda c: (next(r["page"] or 0 for r in own if r["chunk_id"] == c), c)):
            here = [r for r in own if r["chunk_id"] == chunk]
            first = here[0]
            lines += ["\n" + "-" * 140, f"[CHUNK] chunk_id={chunk}   (page={first['page']}, section={first['section']}, subsection=None)", "-" * 140, "\n".join(textwrap.wrap(first["context"] or "", 100)), "-" * 140]
            asked = sorted({(r["question_index"], r["question_id"], r["question"]) for r in here if r["question_id"]})
            if not asked:
                lines.append("  (No questions for this chunk)")
            for index, qid, question in asked:
                lines.append(f"\n  ► QUESTION {index}: {question}")
                answers = sorted((r["model_name"] or "", r["answer"] or "", r["is_best"]) for r in here if r["question_id"] == qid)
                if not answers[0][1]:
                    lines.append("      (No answers found for this question)")
                    continue
                for model, answer, best in answers:
                    lines.append(f"      - [{model}]" + (" (best)" if best else ""))
                    lines += ["          " + x for x in textwrap.wrap(answer, 100)]
        assert got[doc] == "\n".join(lines)


def test_question_dedupe_of_the_table_equals_the_loop(spark):
    """The registered query, over all questions, against a loop over the same vectors."""
    from quern.plans import qa_queries

    sf = "/root/testdata/sf0.001"
    vectors = sorted((r.doc_id, r.ord, list(r.vector)) for r in qa_queries._question_vectors(spark, sf).collect())
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    want, kept = [], {}
    for doc, ord_, v in vectors:
        if all(cos(v, k) <= 0.7 for k in kept.get(doc, [])):
            kept.setdefault(doc, []).append(v)
            want.append((doc, ord_))
    assert sorted(rows(qa_queries.QUERIES["q11_greedy_dedupe"](spark, sf))) == want


def test_group_cosine_in_blocks(spark, monkeypatch):
    from quern.operators import embed as B

    rng = random.Random(3)
    data = [(g, g * 100 + i, [rng.gauss(0, 1) for _ in range(3)]) for g in range(3) for i in range(20)]
    df = spark.createDataFrame(data, "grp int, id long, vector array<float>")
    whole = sorted((r.grp, r.a, r.b, round(r.cosine, 9)) for r in B.group_cosine(df, "grp", 0.5).collect())
    monkeypatch.setattr(B, "BLOCK", 4)
    assert whole and sorted((r.grp, r.a, r.b, round(r.cosine, 9)) for r in B.group_cosine(df, "grp", 0.5).collect()) == whole


def test_embedding_counts_words(spark):
    import zlib

    from quern.operators import embed as B

    df = spark.createDataFrame([(1, "a b A"), (2, None), (3, "")], "id long, text string")
    got = {r.id: list(r.vector) for r in B.embed(df).collect()}
    want = [0.0] * 64
    for w in ("a", "b", "a"):
        want[zlib.crc32(w.encode()) % 64] += 1 / 5**0.5
    assert all(abs(x - y) < 1e-12 for x, y in zip(got[1], want)) and got[2] == got[3] == [0.0] * 64


def test_unrendered_places_fail(spark):
    df = spark.createDataFrame([("see { name }", "q")], "context string, question string")
    with pytest.raises(Exception, match="not rendered"):
        Q.render_prompt(df, "{context}|{question}").collect()
    assert rows(Q.render_prompt(df, "{context}|{question}", strict=False, context_longest=3), "prompt") == [("see|q",)]


def test_intent_rows(spark):
    df = spark.createDataFrame([(1, None, "x", "b", None), (2, "t", None, "a", None), (3, "", "u", "b", None), (4, "v", None, "z", 9)], "ord int, text string, query string, label string, label_id int")
    assert sorted(rows(T.intent_rows(df))) == [(1, "x", 0), (2, "t", 1), (3, "u", 0), (4, "v", 9)]
    for bad in [(5, None, None, "a", None), (5, "t", None, None, None)]:
        with pytest.raises(Exception, match="an intent row has no"):
            T.intent_rows(spark.createDataFrame([bad], df.schema)).collect()


def test_clean_by_model(spark):
    df = spark.createDataFrame([("openelm-1", "<|im_start|>assistant It runs.<|im_end|>"), ("qwen", "Response: 'It runs'"), ("flan", "Answer: `It runs`")], "model_name string, answer string")
    assert [r.answer for r in A.clean_by_model(df).collect()] == ["It runs.", "'It runs'.", "It runs."]


def test_report_columns_come_in_order(spark):
    df = spark.createDataFrame([(0.5, True, "a", 1, "x", "c")], "score double, is_best boolean, answer string, doc_id int, own string, context string")
    assert E.report_tables(df)["qna"].columns == ["doc_id", "answer", "is_best", "context", "score", "own"]


def test_wrapped_as_textwrap_does(monkeypatch):
    """Plain texts don't need textwrap; all others still go through it."""
    r, said, real = random.Random(5), [], textwrap.wrap
    some = ["a", "bc", "déf", "x" * 99, "y" * 100, "z" * 101, " ", "  ", "-", "--", "\t", "\n", "\r", "\xa0", "well-known", "Satz.", "(in)", "\u3000", "ß", "\x1c", "\u2028"]
    texts = ["".join(r.choice(some) + " " * (r.random() < 0.7) for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += [r.choice(" \n").join(w for w in t.replace("-", "").split() if len(w) <= 100) for t in texts]
    assert [E.wrap(t) for t in texts] == ["\n".join(real(t, 100)) for t in texts] and E.wrap(None) == ""
    monkeypatch.setattr(textwrap, "wrap", lambda t, n: said.append(t) or real(t, n))
    E.wrap("one two\nthree. " * 99 + "end"), E.wrap("two  spaces"), E.wrap("well-known")
    assert said == ["two  spaces", "well-known"]


def test_an_answer_is_scored_once_in_a_context(spark):
    """Equal answers to many questions are one row where they are scored, words are split at one place; rows stay as they are."""
    contexts = spark.createDataFrame([(1, "the pump is RED and big"), (2, None), (3, "x"), (1, "pump")], "doc_id int, context string")
    texts = ["The pump is red.", "pump pump", "", None, "red big " * 50, "no"]
    rows = [(q, d, q % 3, texts[q % 6]) for q in range(40) for d in (1, 2, 4)]
    answers = spark.createDataFrame(rows, "question_id int, doc_id int, ord int, answer string").repartition(3)
    got = A.scored_in(answers, contexts)
    assert got.columns == ["doc_id", "question_id", "ord", "answer", "score"]

    def points(answer, context):
        own = set((answer or "").lower().split())
        n = len(own & set((context or "").lower().split()))
        return float("-inf") if not answer else n + (-10.0 if not n else 0.0) + (1.0 if 5 <= len(own) <= 40 else -2.0 if len(own) < 3 or len(own) > 80 else 0.0)

    want = [(d, q, o, a, points(a, c)) for q, d, o, a in rows for k, c in [(1, "the pump is RED and big"), (2, None), (1, "pump")] if k == d]
    order = lambda r: (r[0], r[1], r[4])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)
    plan = answers.select(A.score(F.col("answer"), F.lit(None), known=F.array("answer")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_both_forms_of_white_space_are_the_same(spark):
    c = F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')")
    chars = spark.range(0xD800).union(spark.range(0xE000, 0x10000)).select("id", c.rlike(SPACE).alias("a"), c.rlike(SPACE_JAVA).alias("b"))
    assert chars.filter("a <> b").count() == 0 and chars.filter("b").count() == len(SPACES)


def test_the_flagship_finds_facts_once(spark):
    """Sentences are split at one place of the plan, and a chunk's words only where it has facts; the rows are those of rule_based_qa."""
    from quern.plans.flagship import flagship

    df = flagship(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?<=[.!?])") == 1 and "CASE WHEN (size(facts" in plan
    texts = df.select("doc_id", "chunk_id", "context").distinct()
    qa = Q.rule_based_qa(texts.select(F.struct("doc_id", "chunk_id").alias("doc_id"), F.col("context").alias("text")))
    want = sorted(tuple(r) for r in qa.select("doc_id.doc_id", "doc_id.chunk_id", "ord", "question", "response").collect())
    assert sorted(tuple(r) for r in df.select("doc_id", "chunk_id", "ord", "prompt", "response").collect()) == want and want
