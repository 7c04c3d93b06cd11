"""Connected components of a table of links, on Spark: local contraction, then large-star and small-star rounds."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Links that one task contracts; a table of more is spread over more tasks and takes star rounds between them.
LINKS = 50_000


def spread(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place reachable from every place below n over the pairs (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _contract(frames):
    """The links of a partition as stars around the smallest node of each of their components."""
    whole = pd.concat(list(frames) or [pd.DataFrame({"a": [], "b": []}, dtype="int64")])
    nodes, at = np.unique(whole[["a", "b"]].to_numpy(), return_inverse=True)
    at = at.reshape(-1, 2)
    low = spread(at[:, 0], at[:, 1], len(nodes))
    moved = np.flatnonzero(low != np.arange(len(nodes)))
    yield pd.DataFrame({"a": nodes[moved], "b": nodes[low[moved]]})


def _round(links: DataFrame, large: bool) -> DataFrame:
    """links (a > b). Large star: the larger neighbours of a node go to its smallest; small star: the smaller ones."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # Stored, so that both sides of the join come straight from a shuffle and a centre of very many links can be split.
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    moved = both.join(least, "u")
    if large:
        out = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") > F.col("b")).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, and no centre has one."""
    twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.isEmpty() and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) in any order, loops and repeats allowed. node, component: every linked node and its smallest.

    Every round is stored in the shared folder, so a lost executor costs one round at most. Without links no rows.
    """
    edges = stored(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        tasks = -(-edges.count() // LINKS) or 1
        edges = stored(edges.coalesce(tasks).mapInPandas(_contract, "a long, b long"))
        if tasks == 1 or _only_stars(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        edges = stored(_round(_round(edges.distinct(), True), False))
