"""Data-quality checks; each returns what is wrong, or counts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Children whose parent is missing; a null key counts."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def polymorphic_orphans(df: DataFrame, **parents: DataFrame) -> DataFrame:
    """Rows (parent_type, parent_id) without a parent; parents: type to frame with an id."""
    ids = reduce(DataFrame.unionByName, (p.select(F.lit(t).alias("parent_type"), F.col("id").alias("parent_id")) for t, p in parents.items()))
    return df.join(ids.distinct(), ["parent_type", "parent_id"], "left_anti")


def row_counts(**tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, (t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()))


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """column_name, n_null of the required columns in one pass; n_null is -1 for a column that isn't there."""
    have = [c for c in required if c in df.columns]
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in have)) if have else df.sparkSession.range(1).select()
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), (F.col(c) if c in have else F.lit(-1)).cast("long").alias("n_null")) for c in required))
    return counts.select(F.inline(pairs))


def wrong_dimensions(df: DataFrame, dim: int = 384) -> DataFrame:
    """Vectors of another width; nulls are passed over."""
    return df.filter(F.size("embedding") != dim).filter(F.col("embedding").isNotNull())


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
