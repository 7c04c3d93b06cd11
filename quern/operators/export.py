"""Export formats, and the report tables."""

import re
import textwrap

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip

SYSTEM = "You are a helpful assistant. Answer using only the provided context."


def exportable(df: DataFrame) -> DataFrame:
    """Rows with a question and a best answer."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return df.filter(filled("question") & filled("best_answer"))


def canonical(df: DataFrame) -> DataFrame:
    return df.select(F.col("instruction").alias("prompt"), F.col("input").alias("context"), F.col("output").alias("response"), "metadata")


def alpaca(df: DataFrame) -> DataFrame:
    return df.select("instruction", "input", "output")


def chatml(df: DataFrame, user: str = "instruction", system: str = SYSTEM) -> DataFrame:
    """messages of system, user and assistant; user: the question (instruction) or the context (input)."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    messages = F.array(turn("system", F.lit(system)), turn("user", F.col(user)), turn("assistant", F.col("output")))
    return df.select(messages.alias("messages"), F.col("input").alias("context"), *[c for c in df.columns if c == "metadata"])


def prompt_response(df: DataFrame) -> DataFrame:
    """Question, blank line and context as prompt; rows with an empty side go."""
    out = df.select(strip(F.concat("instruction", F.lit("\n\n"), "input")).alias("prompt"), strip(F.col("output")).alias("response"), *[c for c in df.columns if c == "metadata"])
    return out.filter("prompt <> '' and response <> ''")


def preference(df: DataFrame) -> DataFrame:
    return df.select(F.col("question").alias("prompt"), F.col("best_answer").alias("chosen"), F.col("worst_answer").alias("rejected"))


#: Column order of the reports, under this library's names; fixed values.
PREFERRED = ["doc_id", "document", "file_path", "page", "section", "subsection", "chunk_id", "question_id", "question_index", "question", "model_name", "answer_id", "answer", "is_best", "context"]


def report_tables(qna: DataFrame) -> dict[str, DataFrame]:
    """qna in preferred column order, its distinct questions, its distinct answers."""
    order = [c for c in PREFERRED if c in qna.columns]
    full = qna.select(*order, *[c for c in qna.columns if c not in order])
    pick = lambda *names: full.select(*[c for c in names if c in full.columns]).distinct()
    questions = pick("doc_id", "document", "chunk_id", "question_id", "question_index", "question")
    return {"qna": full, "questions": questions, "answers": pick("question_id", "model_name", "answer_id", "answer", "score", "is_best")}


#: Width of wrapped text, and rules of the text report; fixed values.
WIDTH, RULE = 100, 140
#: Words of a line at most, one space apart, no hyphens: what textwrap breaks at spaces only, where LINE breaks it too.
PLAIN, LINE = re.compile(rf"[^\s-]{{1,{WIDTH}}}(?: [^\s-]{{1,{WIDTH}}})*"), re.compile(rf"(.{{1,{WIDTH}}})(?: |\Z)")


def wrap(text: str | None) -> str:
    """Lines of WIDTH characters at most, as textwrap makes them; empty for null and blank texts."""
    flat = (text or "").replace("\n", " ")
    return "\n".join(LINE.findall(flat) if PLAIN.fullmatch(flat) else textwrap.wrap(text, WIDTH)) if text else ""


@F.pandas_udf(T.StringType())
def wrap_lines(s: pd.Series) -> pd.Series:
    return s.map(wrap)


def report_parts(qna: DataFrame) -> DataFrame:
    """doc_id, page, chunk_id, part: the pieces of the text reports: a head for each document, then its chunks by page and id.

    In a chunk questions come by index and answers by model. The head's chunk_id is null, as is no chunk's.
    qna: doc_id, context, question_id, question_index, question, model_name, answer, is_best; document, file_path, page,
    section, subsection and chunk_id where there are any. Rows without a question stand for a chunk without questions,
    rows whose first answer is empty for a question without answers. Contexts and answers are wrapped.
    """
    given = lambda n, kind="string": F.col(n).cast(kind) if n in qna.columns else F.lit(None).cast(kind)
    said = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    rows = qna.select(
        "doc_id", given("document").alias("document"), given("file_path").alias("file_path"), given("page", "long").alias("page"), given("section").alias("section"),
        given("subsection").alias("subsection"), given("chunk_id").alias("chunk_id"), "context", "question_id", "question_index", "question", "model_name", "answer", "is_best",
    )
    tag = F.when(F.col("model_name").isNull(), "[NO_MODEL]").otherwise(F.concat(F.lit("["), "model_name", F.lit("]"), F.when(F.col("is_best"), " (best)").otherwise("")))
    wrapped = wrap_lines("answer")
    indented = F.when(wrapped == "", "").otherwise(F.concat(F.lit("\n          "), F.replace(wrapped, F.lit("\n"), F.lit("\n          "))))
    answer = F.struct(F.coalesce("model_name", F.lit("")).alias("m"), F.coalesce("answer", F.lit("")).alias("a"), F.concat(F.lit("      - "), tag, indented).alias("line"))
    first = lambda *names: [F.first(n, ignorenulls=True).alias(n) for n in names]
    of_chunk = ["document", "file_path", "section", "subsection", "context"]
    asked = rows.groupBy("doc_id", "page", "chunk_id", "question_id").agg(*first(*of_chunk, "question_index", "question"), F.array_sort(F.collect_list(answer)).alias("answers"))
    lines = F.when(F.col("answers")[0]["a"] == "", "      (No answers found for this question)").otherwise(F.array_join(F.transform("answers", lambda r: r["line"]), "\n"))
    block = F.concat(F.lit("\n  ► QUESTION "), said(F.col("question_index")), F.lit(": "), F.coalesce("question", F.lit("")), F.lit("\n"), lines)
    question = F.when(F.col("question_id").isNotNull(), F.struct("question_index", "question_id", block.alias("block")))
    chunks = asked.withColumn("q", question).groupBy("doc_id", "page", "chunk_id").agg(*first(*of_chunk), F.array_sort(F.collect_list("q")).alias("questions"))
    rule = F.lit("-" * RULE)
    head = F.concat(F.lit("[CHUNK] chunk_id="), said(F.col("chunk_id")), F.lit("   (page="), said(F.col("page")), F.lit(", section="), said(F.col("section")), F.lit(", subsection="), said(F.col("subsection")), F.lit(")"))
    body = F.when(F.size("questions") == 0, F.lit("  (No questions for this chunk)")).otherwise(F.array_join(F.transform("questions", lambda r: r["block"]), "\n"))
    text = F.concat_ws("\n", F.concat(F.lit("\n"), rule), head, rule, wrap_lines("context"), rule, body)
    parts = chunks.select("doc_id", F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("chunk_id", F.lit("")).alias("chunk_id"), text.alias("part"))
    rule = F.lit("=" * RULE)
    head = F.concat_ws("\n", rule, F.concat(F.lit("DOCUMENT: "), said(F.col("document"))), F.concat(F.lit("PATH:     "), said(F.col("file_path"))), rule)
    heads = rows.groupBy("doc_id").agg(*first("document", "file_path"))
    return parts.unionByName(heads.select("doc_id", F.lit(None).cast("long").alias("page"), F.lit(None).cast("string").alias("chunk_id"), head.alias("part")))


def text_report(qna: DataFrame) -> DataFrame:
    """doc_id, report: one text for each document, its report_parts one below the other; for texts beyond a row see save_report_parts."""
    part = F.struct("page", "chunk_id", "part")
    ordered = F.sort_array(F.collect_list(part))
    return report_parts(qna).groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda r: r["part"]), "\n").alias("report"))
