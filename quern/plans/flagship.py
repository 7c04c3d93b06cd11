"""The flagship plan: documents to blocks, cleaned chunks, facts, questions, a grounding score and training rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import word_set
from quern.operators import answers, chunks, extract, questions

from .views import table


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, chunk_id, ord, prompt, context, response, score: one plan, no model, all deterministic."""
    blocks = extract.paragraph_blocks(table(spark, sf_dir, "documents"), "\n")
    ready = chunks.chunk_ids(chunks.min_length(chunks.dedupe_in_document(chunks.strip_lines(blocks))))
    found = ready.select("doc_id", "chunk_id", F.col("text").alias("context"), questions.fact_list(F.col("text")).alias("facts"))
    # A chunk's word set is made where it has facts only. Outer, since Spark otherwise finds the facts a second time to drop chunks without any.
    rows = found.withColumn("known", F.when(F.size("facts") > 0, word_set(F.col("context")))).select("doc_id", "chunk_id", "context", "known", F.inline_outer("facts")).filter("sentence is not null")
    return rows.select(
        "doc_id", "chunk_id", "ord", questions.statement_to_question(F.col("sentence")).alias("prompt"), "context", F.col("sentence").alias("response"),
        answers.score(F.col("sentence"), F.col("context"), known=F.col("known")).alias("score"),
    )
