"""The stages of corpus_pipeline on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _id int, _n int, copy int, ids int, class_id int"
LONG = " ".join(f"w{i}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


def frame(spark, *rows):
    return spark.createDataFrame([(d, t, "en", s, 1, 0.5, 1, 1, 1, 1, 1) for d, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, None), (2, "", "a"), (3, LONG, "a"), (4, LONG + " x", "a"), (5, PASSAGE, "b"), (5, PASSAGE, "b"), (5, "other words", "b")]
    return frame(spark, *rows, (6, PASSAGE.upper(), "b"), (6, PASSAGE, "a"), (None, "no id", "a"), (None, PASSAGE, "b"), (9, "x " + PASSAGE, None))


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_columns_and_empty_tables(spark, odd, name, stage):
    out = stage(spark, odd, SF)
    assert out.columns == P.COLUMNS or name == P.STAGES[-1][0]
    assert out.count() <= 3 * odd.count() and stage(spark, odd.limit(0), SF).count() == 0


def test_toxic_rows_go_by_themselves(spark, monkeypatch):
    """Rows that share an id, or have none, are judged by their own text."""
    clean = [f"plain words about thing {i} and matter {i % 7}" for i in range(200)]
    bad = [f"vile foul rotten scum {i}" for i in range(60)]
    rows = [(i, t, "a") for i, t in enumerate(clean + bad)] + [(0, "vile foul rotten scum 3", "a"), (None, "vile foul rotten scum 4", "a"), (None, "plain words about thing 9", "a")]
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(1, 260)], "doc_id long, toxic int")
    monkeypatch.setattr(P, "table", lambda *_: labels)
    left = P.drop_toxic(spark, frame(spark, *rows), SF)
    assert sorted(r.text for r in left.collect()) == sorted(clean + ["plain words about thing 9"])


def test_one_row_of_each_text_stays(spark, odd):
    got = sorted((str(r.doc_id), r.text[:9] if r.text else r.text, r.source) for r in P.drop_copies(spark, odd, SF).collect())
    assert got == [("2", "", "a"), ("3", LONG[:9], "a"), ("4", LONG[:9], "a"), ("5", "other wor", "b"), ("6", PASSAGE[:9], "a"), ("9", "x p0 p1 p", None), ("None", "no id", "a")]


def test_near_copies_go(spark, odd):
    got = sorted((str(r.doc_id), (r.text or "")[:5]) for r in P.drop_near_copies(spark, odd, SF).collect())
    assert got == [("1", ""), ("2", ""), ("3", "w0 w1"), ("5", "other"), ("5", "p0 p1"), ("5", "p0 p1"), ("None", "no id"), ("None", "p0 p1")]


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    """In exact and near dedup alike: of two texts of one id the copy goes, the other one stays."""
    other = " ".join(f"o{i}" for i in range(60))
    rows = frame(spark, (1, PASSAGE, "a"), (2, PASSAGE + " x", "a"), (2, other, "a"), (3, other.upper(), "b"), (4, other + " y", "b"))
    exact = P.drop_copies(spark, rows, SF)
    assert sorted((r.doc_id, r.text[:2]) for r in exact.collect()) == [(1, "p0"), (2, "p0"), (3, "O0"), (4, "o0")]
    assert sorted((r.doc_id, r.text[:2]) for r in P.drop_near_copies(spark, exact, SF).collect()) == [(1, "p0"), (3, "O0")]
    assert sorted((r.doc_id, r.text[:2]) for r in P.drop_near_copies(spark, rows, SF).collect()) == [(1, "p0"), (2, "o0")]


def test_repeated_rows_draw_alike(spark):
    rows = [(i // 2, f"t{i % 2}", "a" if i % 6 else None) for i in range(120)]
    counts = P.mix_sources(spark, frame(spark, *rows), SF).groupBy("doc_id", "source", "text").count().collect()
    by = {}
    for r in counts:
        by.setdefault((r.doc_id, r.source), set()).add(r["count"])
    assert by and all(len(v) == 1 for v in by.values())


def test_encoding_keeps_every_row(spark, odd):
    got = P.encode(spark, odd, SF).collect()
    assert len(got) == odd.count() and all(4 * r.n_tokens == len(r.ids) for r in got)
    assert {r.doc_id: r.n_tokens for r in got if r.doc_id in (1, 2)} == {1: 0, 2: 0}
