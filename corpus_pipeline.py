"""From raw documents to packed token ids: five stages, each written as Parquet and read again by the next.

Every stage takes all rows of (doc_id, text, lang, source, n_chars) and treats them alike, whatever else the input holds:
null texts count as empty, texts are whole however long, other columns are left out, and empty tables stay empty. doc_id
is an integer or null; what a stage makes of ties, of null ids and of rows that repeat an id is said at the stage.
"""

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.bpe import encode_documents
from quern.llm.exact_dedup import exact_dedup
from quern.llm.mixing import mix
from quern.llm.order_minhash import near_classes
from quern.llm.queries import table, vocabulary
from quern.llm.shared import stored, write_stage
from quern.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text is not predicted toxic; rows that share an id, or have none, are judged each by itself."""
    return toxicity(docs, table(spark, sf_dir, "labels"), carry=tuple(COLUMNS[1:])).filter("predicted = 0").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, A-Z in lower case, the one with the largest doc_id, null only where all are.

    Of several such rows the least by source, language, length and spelling stays. Rows that share an id but not a text
    are different documents.
    """
    kept = exact_dedup(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_n"))
    kept = stored(kept.withColumnRenamed("doc_id", "_id"))
    sha = F.sha2(F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase), 256)
    rows = docs.select(*COLUMNS).withColumn("_sha", sha)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["_sha"] == kept["text_sha256"]))
    if kept.filter("_n > 1").isEmpty():
        return rows.select(*COLUMNS)
    first = F.min(F.struct("source", "lang", "n_chars", "text")).alias("_row")
    several = rows.filter("_n > 1").groupBy("doc_id", "_sha").agg(first).select("doc_id", *(F.col(f"_row.{c}").alias(c) for c in COLUMNS[1:]))
    return rows.filter("_n = 1").select(*COLUMNS).unionByName(several)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the smallest doc_id.

    Rows that share an id but not a text are different documents, as in the stage before; rows without an id stay. Empty
    texts are alike to none.
    """
    kept = near_classes(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept")).distinct()
    rows = docs.select(*COLUMNS).withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    return rows.join(kept, rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["_sha"] == kept["_kept"]), "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated by a Poisson count whose mean brings all sources, null among them, to equal shares.

    Rows that share an id draw alike, rows without one too.
    """
    return mix(docs.select(*COLUMNS)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number and hashes, row by row; an empty text has no ids."""
    return encode_documents(docs.select(*COLUMNS), *vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE", encode),
]
#: Toxicity, near-dedup and BPE have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them goes to the shared folder as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
