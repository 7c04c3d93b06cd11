"""Scans in segments against the plain windows and loops, and one very long document over many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import chunks as C
from quern.operators import extract as X
from quern.operators import scan


def made(spark, seed):
    """Documents with gaps in ord, long runs of headings, sections and subsections far apart."""
    rng, rows = random.Random(seed), []
    texts = ["MAIN PART", "A RATHER LONG SUBTITLE OF FIVE", "body of text", "other body", "more"]
    for d in range(80):
        i = 0
        for _ in range(rng.randrange(1, 60)):
            i += rng.choice([1, 1, 1, 2, 9])
            rows.append((d, i, rng.choices(texts, [1, 1, 6, 6, 6])[0] + ("" if rng.random() < 0.5 else " "), i // 3, rng.choices(["heading", "text"], [3 if d % 2 else 1, 1])[0], 1))
    return spark.createDataFrame(rows, "doc_id long, ord int, text string, page int, chunk_type string, _x int").repartition(5)


@pytest.mark.parametrize("segment", [1, 3, 10])
def test_equal_to_whole_windows(spark, segment):
    df = made(spark, segment)
    same = lambda a, b: sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)
    assert same(C.merge_headings(df, segment), C.merge_headings(df, None))
    assert same(C.fill_sections(C.with_levels(df), segment), C.fill_sections(C.with_levels(df), None))
    lines = df.select("doc_id", "ord", F.when(F.col("chunk_type") == "heading", F.concat(F.lit("#"), "text")).otherwise(F.col("text")).alias("line"))
    assert same(X.markdown_sections(lines, segment), X.markdown_sections(lines, 10**6))
    assert same(C.clean(df, 3, segment), C.clean(df, 3))


def test_running_sum(spark):
    df = spark.createDataFrame([(d, i, (i * 7 + d) % 5) for d in range(3) for i in range(50)], "g int, i int, v int")
    got = scan.running_sum(df, F.col("v"), "total", "g", "i", 4).collect()
    want, total = {}, {}
    for r in sorted(df.collect()):
        want[r.g, r.i] = total[r.g] = total.get(r.g, 0) + r.v
    assert {(r.g, r.i): r.total for r in got} == want


def test_one_long_document_over_many_tasks(spark):
    """A million lines of one document: no task sees more than a few segments, and the carried section reaches the last row."""
    n = 1_000_000
    text = F.when(F.col("id") == 3, "ONLY SECTION").when(F.col("id") == 11, "THE ONE AND ONLY SUBSECTION OF IT").otherwise("plain text")
    rows = spark.range(0, n, 1, 16).select(F.lit(1).alias("doc_id"), F.col("id").alias("ord"), text.alias("text"), F.lit(1).alias("page"), F.when((F.col("id") >= 99_998) & (F.col("id") < 250_001), "heading").otherwise("text").alias("chunk_type"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        filled = C.fill_sections(C.with_levels(rows), 50_000)
        assert filled.filter("section = 'ONLY SECTION' and subsection = 'THE ONE AND ONLY SUBSECTION OF IT'").count() == n - 11
        most = filled.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < n / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    merged = C.merge_headings(rows, 50_000)
    assert merged.count() == n - 75_002 and merged.filter("merged_heading").agg(F.min("ord"), F.max("ord")).first() == (99_998, 250_000)
