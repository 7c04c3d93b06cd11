"""What the entry point registers when parts are missing."""

import __spark_entry__ as E


def names(monkeypatch, *missing):
    there = E._there
    monkeypatch.setattr(E, "_there", lambda n: n not in missing and there(n))
    return set(E.queries()), set(E.oracle_sql())


def test_without_the_corpus_operators(monkeypatch):
    queries, sql = names(monkeypatch, "quern.llm.queries")
    assert "flagship" in queries and not any(n.startswith("op") or n == "pipeline" for n in queries | sql)


def test_without_a_package(monkeypatch):
    assert not any(n.startswith("op") for n in names(monkeypatch, "xxhash")[0])


def test_without_the_vocabulary(monkeypatch):
    assert not names(monkeypatch, "public_tokenizers")[0] & {"op10_bpe", "pipeline"}


def test_without_the_pipeline(monkeypatch):
    assert "pipeline" not in names(monkeypatch, "corpus_pipeline")[0]


def test_sql_names_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
