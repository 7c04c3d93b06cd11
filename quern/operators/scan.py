"""Ordered scans of documents in two levels, so that a document of very many rows is the work of many tasks.

A document's rows are cut into segments by their place. Windows run inside segments; what a segment hands on to the
next (a sum, a run's length, the last section) is one row a segment, and the windows over whole documents run over these.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places of a document that make a segment.
SEGMENT = 100_000


def with_segment(df: DataFrame, segment: int, ord_: str = "ord") -> DataFrame:
    return df.withColumn("_seg", F.floor(F.col(ord_) / segment))


def inside(doc: str = "doc_id", ord_: str = "ord", *more: str):
    """The window of a segment's rows so far."""
    return Window.partitionBy(doc, "_seg", *more).orderBy(ord_)


def over(doc: str = "doc_id", *more: str):
    """The window of a document's segments so far."""
    return Window.partitionBy(doc, *more).orderBy("_seg")


def hand_on(rows: DataFrame, carry: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The rows with what their segment gets from those before and after it; carry: a row for each segment that gets anything."""
    return rows.join(carry, [doc, "_seg"], "left")


def running_sum(df: DataFrame, value: Column, out: str, doc: str, ord_: str, segment: int = SEGMENT) -> DataFrame:
    """out: the sum of value over a document's rows up to this one."""
    rows = with_segment(df.withColumn("_v", value), segment, ord_)
    sums = rows.groupBy(doc, "_seg").agg(F.sum("_v").alias("_own"))
    carry = sums.select(doc, "_seg", (F.sum("_own").over(over(doc)) - F.col("_own")).alias("_before")).filter("_before <> 0")
    summed = rows.withColumn("_sum", F.sum("_v").over(inside(doc, ord_)))
    whole = hand_on(summed, carry, doc).withColumn("_sum", F.col("_sum") + F.coalesce("_before", F.lit(0)))
    return whole.select(*df.columns, F.col("_sum").alias(out))
