"""Embeddings: bulk encoding with a pluggable encoder, the embedding table, cosine inside groups."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .questions import generate


def hashing_encoder(width: int = 64):
    """The encoder that is always there: hashed word counts, scaled to length 1; the same in every process."""
    import zlib

    def make():
        def encode(pdf: pd.DataFrame) -> pd.DataFrame:
            out = np.zeros((len(pdf), width))
            for i, text in enumerate(pdf["text"]):
                for w in (text or "").lower().split():
                    out[i, zlib.crc32(w.encode()) % width] += 1
            norm = np.sqrt((out * out).sum(1, keepdims=True))
            return pdf[["id"]].assign(vector=list(out / np.where(norm == 0, 1, norm)))

        return encode

    return make


def embed(df: DataFrame, make=None) -> DataFrame:
    """(id, text) to (id, vector) in batches."""
    kind = df.schema["id"].dataType.simpleString()
    return generate(df.select("id", "text"), make or hashing_encoder(), f"id {kind}, vector array<double>")


def embedding_table(df: DataFrame, model: str) -> DataFrame:
    """Parent pointer, model, vector, its width, and metadata."""
    return df.select(
        "parent_type", "parent_id", F.lit(model).alias("model_name"), F.col("embedding").alias("vector"), F.size("embedding").alias("actual_dimensions"),
        F.create_map(F.lit("source"), F.col("parent_type")).alias("meta"),
    )


#: Rows of a group that one task compares with another block's.
BLOCK = 1024


def _compare(pdf: pd.DataFrame, group: str, at_least: float) -> pd.DataFrame:
    """Two blocks of a group, or one with itself (side 2)."""
    parts = [pdf] if (pdf["side"] == 2).all() else [pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]]
    if min(map(len, parts)) == 0:  # the other block is empty
        return pd.DataFrame({group: [], "a": [], "b": [], "cosine": []})
    v = [np.stack(p["vector"]).astype(np.float64) for p in parts]
    v = [x / np.sqrt((x * x).sum(1, keepdims=True)) for x in v]
    cosine = v[0] @ v[-1].T
    ids, others = parts[0]["id"].to_numpy(), parts[-1]["id"].to_numpy()
    i, j = np.nonzero(cosine >= at_least)
    if len(parts) == 1:
        i, j = i[ids[i] < ids[j]], j[ids[i] < ids[j]]
    a, b = np.minimum(ids[i], others[j]), np.maximum(ids[i], others[j])
    return pd.DataFrame({group: [pdf[group].iloc[0]] * len(i), "a": a, "b": b, "cosine": cosine[i, j]})


def group_cosine(df: DataFrame, group: str, at_least: float) -> DataFrame:
    """Pairs (a < b) of a group with a cosine of at_least, in doubles; ids are unique, vectors of one width and not zero.

    Groups are split in blocks of BLOCK rows and every pair of blocks is a task, so a hot group is spread out.
    """
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    rows = df.join(sizes, group).withColumn("_block", F.pmod(F.xxhash64("id"), "_blocks").cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda o: F.struct(
            F.least(o, F.col("_block")).alias("x"), F.greatest(o, F.col("_block")).alias("y"),
            F.when(o == F.col("_block"), 2).when(F.col("_block") < o, 0).otherwise(1).alias("side"),
        ),
    )
    dealt = rows.select(group, "id", "vector", F.inline(pairs))
    kinds = dealt.select(group, "id").schema
    schema = f"{group} {kinds[group].dataType.simpleString()}, a {kinds['id'].dataType.simpleString()}, b {kinds['id'].dataType.simpleString()}, cosine double"
    return dealt.groupBy(group, "x", "y").applyInPandas(lambda pdf: _compare(pdf, group, at_least), schema)
