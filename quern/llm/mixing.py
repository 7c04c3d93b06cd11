"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the mixture over its share of the rows. Every row inverts a
Poisson distribution of that mean at a uniform number hashed from (seed, doc_id), is exploded by the count, and all
copies are dealt by a hashed key over all partitions and ordered by it: a global shuffle without a sampling job.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Sources up to which the table of rates is broadcast: their distributions are 20 MB at most.
SOURCES = 10_000
#: A larger mean is drawn as a sum of this many at most, so that exp(-mean) stays a normal number.
PART = 64.0


def _uniform(*key):
    """52 bits of a SHA-256, in [0, 1)."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *key), 256), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def repetition_rates(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0) -> DataFrame:
    """source, n, rate: counts over all rows; weights has (source, weight), all sources alike where none is given.

    A source without a weight has rate 0. The weights of sources that have rows are scaled to a sum of 1.
    """
    sizes = docs.groupBy(docs["source"].alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        w = weights.select(weights["source"].alias("w_source"), weights["weight"].cast("double").alias("weight"))
        sizes = sizes.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
    total = sizes.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    rate = F.coalesce(F.lit(float(epochs)) * F.col("weight") / F.col("weights") * F.col("rows") / F.col("n"), F.lit(0.0))
    return sizes.join(F.broadcast(total)).select("source", "n", rate.alias("rate"))


def with_copies(docs: DataFrame, rates: DataFrame, seed: int = 0) -> DataFrame:
    """docs with n_copies. The table of rates has a row per source and is counted: up to SOURCES rows it is broadcast.

    Beyond that it is joined by a shuffle of both sides; it is stored first, so that Spark can split a hot source.
    """
    rates = stored(rates)
    part = F.greatest(F.lit(1.0), F.ceil(F.col("rate") / PART))
    last = (F.col("mean") + 15 * F.sqrt("mean") + 30).cast("int")
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf")),
        lambda a, k: F.struct(
            (a["p"] * F.col("mean") / k).alias("p"),
            F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * F.col("mean") / k)).alias("cdf"),
        ),
    )["cdf"]
    cdf = (
        rates.select(F.col("source").alias("_source"), "rate", part.cast("int").alias("_parts"))
        .withColumn("mean", F.col("rate") / F.col("_parts"))
        .select("_source", "_parts", step.alias("_cdf"))
    )
    draws = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda j: _uniform(F.lit(str(seed)), j.cast("string"), F.col("doc_id").cast("string")))
    draw = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("_cdf", lambda x: x <= u)))
    cdf = F.broadcast(cdf) if rates.count() <= SOURCES else cdf
    joined = docs.join(cdf, docs["source"].eqNullSafe(F.col("_source")))
    return joined.withColumn("n_copies", draw).drop("_source", "_parts", "_cdf")


def mix(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = 0) -> DataFrame:
    """Rows of docs, each repeated by its Poisson count, with n_copies, copy (from 1) and mix_key, in shuffled order.

    Rows that draw 0 do not appear; that is the operator. A null source is a source of its own; a null doc_id draws
    from the hash of the seed alone; repeated rows draw alike. Texts are carried along whole, null, empty or long. Copies
    whose keys tie come in any order. Columns of docs named n_copies, copy or mix_key are replaced. No rows give no rows.
    """
    docs = docs.drop("n_copies", "copy", "mix_key")
    drawn = with_copies(docs, repetition_rates(docs, weights, epochs), seed)
    copies = drawn.withColumn("copy", F.explode(F.when(F.col("n_copies") > 0, F.sequence(F.lit(1), F.col("n_copies")))))
    key = F.sha2(F.concat_ws(":", F.lit(f"{seed}:order"), F.col("doc_id").cast("string"), F.col("copy").cast("string")), 256)
    keyed = copies.withColumn("mix_key", F.substring(key, 1, 16))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")
