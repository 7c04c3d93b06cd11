"""The registry of dataset versions: content hash, versions, immutable rows, audit log."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame) -> Column:
    """SHA-256 of a row: of the hashes of its values as text, in the order of the columns; null is not the empty text."""
    return F.sha2(F.concat_ws(",", *(F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("-")) for c in df.columns)), 256)


def content_hashes(df: DataFrame, name: str) -> DataFrame:
    """(name, n, content_hash): per dataset a hash of all its columns' names, types and rows, whatever the rows' order.

    A tree: equal row hashes are counted, buckets of the first five hex digits hash their sorted hashes with counts,
    buckets of the first two digits those buckets' hashes, and the dataset the 256 that are left. No array holds more
    than a millionth of the distinct rows, 4,096 buckets or 256 of them.
    """
    rows = df.select(F.col(name).alias("name"), row_hash(df).alias("h"))
    level = rows.groupBy("name", "h").agg(F.count(F.lit(1)).alias("n")).withColumn("p", F.concat_ws(":", "h", F.col("n").cast("string")))
    for digits in (5, 2, 0):
        inside = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("h", "p"))), lambda r: r["p"]), ",")
        level = level.groupBy("name", F.left("h", F.lit(digits)).alias("h")).agg(F.sha2(inside, 256).alias("p"), F.sum("n").alias("n"))
    fields = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return level.select("name", "n", F.sha2(F.concat(F.lit(fields + "\n"), "p"), 256).alias("content_hash"))


def next_versions(registry: DataFrame) -> DataFrame:
    """name, version after the latest by created_at: v001, v002, …"""
    last = registry.groupBy("name").agg(F.max_by("version", "created_at").alias("v"))
    number = F.coalesce(F.regexp_extract("v", r"^v(\d+)$", 1).cast("int"), F.lit(0)) + 1
    return last.select("name", F.format_string("v%03d", number).alias("version"))


def version_of_path(path):
    """The first part of a path that is v and digits; empty where there is none."""
    return F.regexp_extract(path, r"(?:^|/)(v\d+)(?=/|$)", 1)


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to append: of new (name, path, content_hash, …), one for each hash that isn't there yet, with its version.

    Of rows with the same hash the one with the smallest path is written, whole; `known` returns what is there already.
    A path without a version part fails.
    """
    version = version_of_path(F.col("path"))
    checked = new.withColumn("version", F.when(version == "", F.raise_error(F.concat(F.lit("no version in "), "path")).cast("string")).otherwise(version))
    fresh = checked.join(registry.select("content_hash"), "content_hash", "left_anti")
    columns = [c for c in checked.columns if c != "content_hash"]
    order = F.struct("path", *(c for c in columns if c != "path"))
    return fresh.groupBy("content_hash").agg(F.min_by(F.struct(*columns), order).alias("_r")).select("content_hash", "_r.*")


def known(registry: DataFrame, new: DataFrame) -> DataFrame:
    return registry.join(new.select("content_hash").distinct(), "content_hash", "left_semi")


def profile(df: DataFrame, name: str) -> DataFrame:
    """Record count, and the fields of the records with their types, as JSON."""
    fields = json.dumps({f.name: f.dataType.simpleString() for f in df.schema.fields})
    return df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("records")).withColumn("fields", F.lit(fields))


def audit_state(log: DataFrame, key: str = "content_hash") -> DataFrame:
    """The current state of every dataset: its last action, and how many there were."""
    return log.groupBy(key).agg(F.max_by("action", "created_at").alias("state"), F.count(F.lit(1)).alias("n_actions"))


def resolve(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """(name, version) requests to path and hash; anything but exactly one match fails."""
    hits = registry.groupBy("name", "version").agg(F.count(F.lit(1)).alias("_n"), F.first("path").alias("path"), F.first("content_hash").alias("content_hash"))
    j = requests.join(hits, ["name", "version"], "left")
    bad = F.raise_error(F.concat(F.lit("not exactly one dataset "), "name", F.lit(" "), "version")).cast("string")
    return j.select("name", "version", F.when(F.coalesce("_n", F.lit(0)) == 1, F.col("path")).otherwise(bad).alias("path"), "content_hash")
