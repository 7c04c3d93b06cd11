"""Sources over real folders: line numbers across splits."""

import json

import pytest

from quern.sources import files as S


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def folder(tmp_path, bad=()):
    """Three files of many splits and an empty one; blank lines, both line ends, a last line without one."""
    want = {}
    for f, end in enumerate(["\n", "\r\n", "\n"]):
        lines = []
        for i in range(1, 400 + 100 * f):
            text = json.dumps({"prompt": f"p{i} ü", "n": i})
            lines.append("  " if i % 17 == 0 else text[:-3] if (f, i) in bad else text)
        path = tmp_path / f"f{f}.jsonl"
        path.write_bytes((end.join(lines) + (end if f else "")).encode())
        with open(path, encoding="utf-8") as h:
            want |= {(path.name, n): line for n, line in enumerate(h, start=1)}
    (tmp_path / "empty.jsonl").write_bytes(b"")
    return want


def test_line_numbers_equal_enumerate(spark, tmp_path, small_splits):
    want = folder(tmp_path)
    lines = S.numbered_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 1 and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert {(r.path.rpartition("/")[2], r.line_no): r.value for r in lines.collect()} == {k: v.rstrip("\r\n") for k, v in want.items()}
    rows = S.read_jsonl(spark, str(tmp_path), "prompt string, n long").collect()
    assert {(r.path.rpartition("/")[2], r.line_no): r.n for r in rows} == {k: json.loads(v)["n"] for k, v in want.items() if v.strip()}


def test_bad_line_fails_with_its_number(spark, tmp_path, small_splits):
    folder(tmp_path, {(1, 333), (2, 5)})
    with pytest.raises(Exception, match=r"bad JSON in line (333 of .*f1|5 of .*f2)"):
        S.read_jsonl(spark, str(tmp_path), "prompt string, n long").collect()
    kept = S.read_jsonl(spark, str(tmp_path), "prompt string, n long", quarantine=True).filter("bad_line is not null").collect()
    assert {(r.path.rpartition("/")[2], r.line_no) for r in kept} == {("f1.jsonl", 333), ("f2.jsonl", 5)}
