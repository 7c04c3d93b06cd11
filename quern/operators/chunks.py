"""Cleaning of raw chunks. The order of the steps is fixed: normalise, strip, merge headings, dedupe, length, ids."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import is_upper, strip, words

from . import scan


def _by(doc: str = "doc_id", *more: str):
    return Window.partitionBy(doc, *more).orderBy("ord")


def normalize_schema(df: DataFrame) -> DataFrame:
    """page: first of page and page_number that is not 0, then page_index, then 1; text, else markdown; default type."""
    have = set(df.columns)
    c = lambda name, kind: F.col(name) if name in have else F.lit(None).cast(kind)
    page = F.coalesce(F.nullif(c("page", "int"), F.lit(0)), F.nullif(c("page_number", "int"), F.lit(0)), c("page_index", "int"), F.lit(1))
    text = F.coalesce(F.nullif(c("text", "string"), F.lit("")), c("markdown", "string"), F.lit(""))
    kind = F.coalesce(F.nullif(c("chunk_type", "string"), F.lit("")), F.lit("content"))
    return df.withColumns({"page": page, "text": text, "chunk_type": kind}).drop("page_number", "page_index", "markdown")


def strip_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Hard spaces become spaces, then the text and every line of it is stripped."""
    plain = strip(F.replace(F.col(text), F.lit("\xa0"), F.lit(" ")))
    return df.withColumn(text, F.array_join(F.transform(F.split(plain, "\n", -1), strip), "\n"))


def merge_headings(df: DataFrame, segment: int | None = scan.SEGMENT) -> DataFrame:
    """A heading joins the chunk after it, which it consumes even where that is a heading; the last chunk stays.

    In a run of headings those at odd places merge: a window sum, no loop. merged_heading tells which rows did. Windows run
    over segments of a document, and a segment hands on how many headings end it, its first text and page; without
    segment they run over whole documents.
    """
    names = [c for c in df.columns if c not in ("text", "page", "chunk_type")]
    rows = scan.with_segment(df, segment) if segment else df.withColumn("_seg", F.lit(0).cast("long"))
    w = scan.inside()
    is_heading = F.col("chunk_type") == "heading"
    rows = rows.withColumn("_run", F.sum(F.when(is_heading, 0).otherwise(1)).over(w))
    rows = rows.withColumn("_k", F.sum(F.when(is_heading, 1).otherwise(0)).over(scan.inside("doc_id", "ord", "_run")))
    if segment:
        ends = rows.groupBy("doc_id", "_seg").agg(
            F.max_by(F.when(is_heading, F.col("_k")).otherwise(0), "ord").alias("_tail"), (F.max("_run") == 0).alias("_all"),
            F.min_by(F.struct("text", "page"), "ord").alias("_head"),
        )
        # A segment of headings only lengthens the run before it.
        ends = ends.withColumn("_since", F.sum((~F.col("_all")).cast("int")).over(scan.over()))
        ends = ends.withColumn("_tail", F.sum("_tail").over(scan.over("doc_id", "_since")))
        carry = ends.select("doc_id", "_seg", F.lag("_tail").over(scan.over()).alias("_before"), F.lead("_head").over(scan.over()).alias("_after"))
        rows = scan.hand_on(rows, carry.filter("_before is not null or _after is not null"))
    else:
        rows = rows.withColumns({"_before": F.lit(None).cast("long"), "_after": F.lit(None).cast(rows.select(F.struct("text", "page")).schema[0].dataType)})
    before = F.coalesce("_before", F.lit(0))
    k = F.col("_k") + F.when(F.col("_run") == 0, before).otherwise(0)
    rows = rows.withColumn("_next", F.coalesce(F.lead(F.struct("text", "page")).over(w), F.col("_after")))
    rows = rows.withColumn("_m", is_heading & (k % 2 == 1) & F.col("_next").isNotNull())
    rows = rows.withColumn("_gone", F.coalesce(F.lag("_m").over(w), before % 2 == 1))
    merged = F.col("_m")
    return rows.filter(~F.col("_gone")).select(
        *names,
        F.when(merged, F.concat("text", F.lit("\n"), "_next.text")).otherwise(F.col("text")).alias("text"),
        F.when(merged, F.col("_next.page")).otherwise(F.col("page")).alias("page"),
        F.when(merged, F.lit("text")).otherwise(F.col("chunk_type")).alias("chunk_type"),
        merged.alias("merged_heading"),
    )


def dedupe_in_document(df: DataFrame) -> DataFrame:
    """The first chunk of every text in a document; texts are told by their SHA-256."""
    rows = df.withColumn("_sha", F.unhex(F.sha2("text", 256)))
    return rows.withColumn("_n", F.row_number().over(_by("doc_id", "_sha"))).filter("_n = 1").drop("_n", "_sha")


def min_length(df: DataFrame, n: int = 40) -> DataFrame:
    return df.filter(F.length("text") >= n)


def chunk_ids(df: DataFrame) -> DataFrame:
    """chunk_id p{page}_c{n}, n counted in each page of a document."""
    n = F.row_number().over(_by("doc_id", "page"))
    return df.withColumn("chunk_id", F.format_string("p%d_c%d", F.col("page"), n))


def heading_level(text: Column) -> Column:
    """section or subsection for texts that look like headings, else body."""
    head = ((F.length(text) <= 60) & is_upper(text)) | ((F.length(text) <= 80) & text.endswith(":"))
    return F.when(~head, "body").when(F.size(words(text)) <= 4, "section").otherwise("subsection")


def with_levels(df: DataFrame) -> DataFrame:
    return df.withColumn("level", heading_level(F.col("text")))


def fill_sections(df: DataFrame, segment: int | None = scan.SEGMENT) -> DataFrame:
    """section and subsection carried forward in a document; a new section clears the subsection.

    Windows run over segments of a document, and a segment hands on its last section and the subsection after it; without
    segment they run over whole documents.
    """
    rows = scan.with_segment(df, segment) if segment else df.withColumn("_seg", F.lit(0).cast("long"))
    of = lambda level, c: F.when(F.col("level") == level, F.col(c))
    w = scan.inside()
    rows = rows.withColumn("_s", F.sum((F.col("level") == "section").cast("int")).over(w))
    last = lambda level, w: F.last(of(level, "text"), ignorenulls=True).over(w)
    rows = rows.withColumns({"section": last("section", w), "subsection": last("subsection", scan.inside("doc_id", "ord", "_s"))})
    if segment:
        ends = rows.groupBy("doc_id", "_seg").agg(F.max("_s").alias("_n"), F.max_by(F.struct("section", "subsection"), "ord").alias("_end"))
        ends = ends.withColumn("_since", F.sum((F.col("_n") > 0).cast("int")).over(scan.over()))
        held = lambda c, w: F.last(F.col(f"_end.{c}"), ignorenulls=True).over(w)
        ends = ends.withColumn("_state", F.struct(held("section", scan.over()).alias("section"), held("subsection", scan.over("doc_id", "_since")).alias("subsection")))
        carry = ends.select("doc_id", "_seg", F.lag("_state").over(scan.over()).alias("_before"))
        rows = scan.hand_on(rows, carry.filter("_before.section is not null or _before.subsection is not null"))
        # Rows before a segment's first section still belong to the last one.
        rows = rows.withColumns({
            "section": F.coalesce("section", "_before.section"),
            "subsection": F.when(F.col("_s") > 0, F.col("subsection")).otherwise(F.coalesce("subsection", "_before.subsection")),
        }).drop("_before")
    return rows.drop("_s", "_seg")


def collapse_and_count(df: DataFrame) -> DataFrame:
    """context with single spaces, its number of words, and whether a section stands over it."""
    w = words(F.col("text"))
    return df.withColumns({"context": F.array_join(w, " "), "context_tokens": F.size(w), "has_heading": F.col("section").isNotNull()})


#: Wording of the prompts; fixed values.
QUESTION_PROMPT = (
    "You are generating factual knowledge-check questions from manufacturing documents.\n\n",
    "TASK:\n"
    "Generate exactly 3 clear, factual questions that are:\n"
    "- based ONLY on information explicitly written in the context\n"
    "- short and direct (max 18 words)\n"
    "- answerable from the text\n"
    "- using question starters: What / Where / When / Which / How many / What is the purpose of\n\n"
    "Return ONLY the questions, each on its own line.",
)
ANSWER_PROMPT = (
    "You are answering a factual knowledge-check question.\n"
    "Answer ONLY using information explicitly stated in the context.\n"
    "Keep answers short and precise.\n\n",
    "QUESTION: <question_here>\nANSWER:",
)


def render_prompts(df: DataFrame) -> DataFrame:
    """question_prompt and answer_prompt, with the section and subsection where there are any."""
    prefix = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name + ": "), c, F.lit("\n"))).otherwise("")
    head = F.concat(prefix("SECTION", F.col("section")), prefix("SUBSECTION", F.col("subsection")), F.lit("CONTEXT:\n"), F.col("context"), F.lit("\n\n"))
    return df.withColumns(
        {name: F.concat(F.lit(a), head, F.lit(b)) for name, (a, b) in (("question_prompt", QUESTION_PROMPT), ("answer_prompt", ANSWER_PROMPT))}
    )


def first_chunks(df: DataFrame, n: int) -> DataFrame:
    """The first n chunks of every document."""
    return df.withColumn("_n", F.row_number().over(_by())).filter(F.col("_n") <= n).drop("_n")


def clean(df: DataFrame, least: int = 40, segment: int | None = None) -> DataFrame:
    """The whole chain, from raw chunks to chunks with ids, sections and contexts; segment: for documents of very many chunks."""
    df = dedupe_in_document(merge_headings(strip_lines(normalize_schema(df)), segment))
    return collapse_and_count(fill_sections(with_levels(chunk_ids(min_length(df, least))), segment))
