"""From readable text, table cells and recognised lines to chunk rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import ordered_text, strip, words

from . import scan


def paragraph_blocks(df: DataFrame, sep: str = "\n\n", longer_than: int = 5) -> DataFrame:
    """(doc_id, text) to blocks between separators, stripped, page 1."""
    rows = df.select("doc_id", F.posexplode(F.split("text", sep, -1)).alias("ord", "text"))
    return rows.withColumn("text", strip(F.col("text"))).filter(F.length("text") > longer_than).withColumn("page", F.lit(1))


def page_blocks(df: DataFrame, sep: str = "\n\n", more_than: int = 3) -> DataFrame:
    """(doc_id, page, text) to blocks of more than 3 words."""
    plain = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))
    rows = df.select("doc_id", "page", F.posexplode(F.split(plain, sep, -1)).alias("ord", "text"))
    return rows.withColumn("text", strip(F.col("text"))).filter(F.size(words(F.col("text"))) > more_than)


def markdown_sections(lines: DataFrame, segment: int = scan.SEGMENT) -> DataFrame:
    """(doc_id, ord, line) to sections: a line that starts with # ends the one before it.

    text is title, line break, body; the first title is Document Start; a heading without a line below it gives
    nothing; page is the running number of the sections. Lines and sections are counted in segments of a document, so only
    the lines of one section meet in a task.
    """
    head = F.col("line").startswith("#")
    rows = scan.running_sum(lines.select("doc_id", "ord", "line").withColumn("_head", head), F.col("_head").cast("int"), "_part", "doc_id", "ord", segment)
    body = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("ord", "line", "_head"))), lambda r: ~r["_head"]), lambda r: r["line"])
    parts = rows.groupBy("doc_id", "_part").agg(body.alias("_body"), F.max(F.when(F.col("_head"), F.col("line"))).alias("_title")).filter(F.size("_body") > 0)
    title = F.coalesce(strip(F.regexp_replace("_title", "^#+", "")), F.lit("Document Start"))
    texts = parts.select("doc_id", "_part", strip(F.concat(title, F.lit("\n"), F.array_join("_body", "\n"))).alias("text"))
    return scan.running_sum(texts, F.lit(1), "page", "doc_id", "_part", segment).select("doc_id", F.col("page").cast("int").alias("page"), "text")


def valid_chunks(df: DataFrame) -> DataFrame:
    t = strip(F.coalesce(F.col("text"), F.lit("")))
    return df.filter((F.length(t) >= 5) & (F.size(words(t)) >= 3))


def table_rows_to_text(rows: DataFrame) -> DataFrame:
    """(sheet, row_no, cells): row 1 of a sheet is its header. Text: Sheet, Row, then header: value for filled cells."""
    header = rows.filter("row_no = 1").select(F.col("sheet").alias("_sheet"), F.col("cells").alias("_names"))
    joined = rows.filter("row_no > 1").join(header, F.col("sheet") == F.col("_sheet"))
    cell = lambda c: strip(F.coalesce(c, F.lit("")))
    pairs = F.transform(
        F.col("cells"),
        lambda c, i: F.when(
            cell(c) != "",
            F.concat(F.coalesce(F.nullif(cell(F.get("_names", i)), F.lit("")), F.concat(F.lit("Column_"), (i + 1).cast("string"))), F.lit(": "), cell(c)),
        ),
    )
    kept = joined.withColumn("_pairs", F.array_compact(pairs)).filter(F.size("_pairs") > 0)
    text = F.concat(F.lit("Sheet: "), F.col("sheet"), F.lit("\nRow "), F.col("row_no").cast("string"), F.lit(":\n"), F.array_join("_pairs", "\n"))
    return kept.select("sheet", "row_no", text.alias("text"))


def _row_text(cells: Column, sep: str = " | ") -> Column:
    return F.array_join(F.filter(F.transform(cells, lambda c: strip(F.coalesce(c, F.lit("")))), lambda c: c != ""), sep)


def tables_to_text(rows: DataFrame) -> DataFrame:
    """(sheet, row_no, cells) to one text for each table: filled cells joined by a bar, rows by line breaks."""
    lines = rows.withColumn("_line", _row_text(F.col("cells"))).filter("_line <> ''")
    return lines.groupBy("sheet").agg(ordered_text(["row_no"], "_line", "\n").alias("text"))


def tables_to_chunk(rows: DataFrame) -> DataFrame:
    """One chunk for each table: Sheet line, header and rows, cells joined by a comma."""
    lines = rows.withColumn("_line", F.array_join(F.transform("cells", lambda c: F.coalesce(c, F.lit(""))), ","))
    text = F.concat(F.lit("Sheet: "), F.col("sheet"), F.lit("\n"), F.col("_text"))
    return lines.groupBy("sheet").agg(ordered_text(["row_no"], "_line", "\n").alias("_text")).select("sheet", text.alias("text"))


def group_ocr_lines(lines: DataFrame, gap: float = 20.0, least: float = 0.5) -> DataFrame:
    """(page, y, ord, text, confidence) to blocks: a gap of 20 or more to the line above begins a new one."""
    w = Window.partitionBy("page").orderBy("y", "ord")
    rows = lines.filter(F.col("confidence") >= least).withColumn("_new", F.coalesce((F.col("y") - F.lag("y").over(w) >= gap).cast("int"), F.lit(0)))
    rows = rows.withColumn("block", F.sum("_new").over(w))
    return rows.groupBy("page", "block").agg(ordered_text(["y", "ord"], "text", " ").alias("text"), F.count(F.lit(1)).alias("n_lines"))


def ocr_fallback(lines: DataFrame, native: DataFrame, least: float = 0.5) -> DataFrame:
    """Recognised text of pages that have no native text: lines above the confidence, joined by line breaks."""
    rows = lines.join(native.select("page").distinct(), "page", "left_anti")
    rows = rows.filter((F.col("confidence") > least) & (strip(F.col("text")) != ""))
    return rows.groupBy("page").agg(ordered_text(["ord"], "text", "\n").alias("text"))


def route_pages(chunks: DataFrame, pages: DataFrame, prefer_ocr: bool = False) -> DataFrame:
    """pages (doc_id, page, n_images) with use_ocr: preferred, no chunk, under 100 characters, or over 3 images."""
    sums = chunks.groupBy("doc_id", "page").agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("n"))
    out = pages.join(sums, ["doc_id", "page"], "left")
    ocr = F.lit(prefer_ocr) | F.col("n").isNull() | (F.col("chars") < 100) | (F.col("n_images") > 3)
    return out.select("doc_id", "page", F.coalesce("chars", F.lit(0)).alias("chars"), ocr.alias("use_ocr"))


#: File suffixes; fixed values.
NATIVE = [".pdf", ".doc", ".docx", ".pptx", ".txt", ".md", ".xlsx", ".xls", ".xlsm", ".csv"]
OCR_ONLY = [".tif", ".tiff"]


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/\\.](\.[^./\\]+)$", 1))


def route_documents(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """files (doc_id, file_path) with route: ocr for images and for native files without text, native, or unsupported."""
    text = chunks.groupBy("doc_id").agg(F.bool_or(F.length(strip(F.col("text"))) > 0).alias("has_text"))
    s = suffix(F.col("file_path"))
    route = F.when(s.isin(OCR_ONLY), "ocr").when(~s.isin(NATIVE), "unsupported").when(F.coalesce("has_text", F.lit(False)), "native").otherwise("ocr")
    return files.join(text, "doc_id", "left").select("doc_id", "file_path", route.alias("route"))


def style_types(df: DataFrame) -> DataFrame:
    """chunk_type and heading_level from a style name."""
    s = F.lower(F.coalesce("style", F.lit("")))
    n = F.regexp_extract(s, r"heading\s*(\d+)", 1)
    return df.withColumns({
        "chunk_type": F.when(s.contains("heading"), "heading").when(s.contains("title"), "title").otherwise("paragraph"),
        "heading_level": F.when(s.contains("heading"), F.when(n == "", 1).otherwise(F.nullif(n, F.lit("")).cast("int"))).when(s.contains("title"), 0),
    })


def assemble_documents(chunks: DataFrame, images: DataFrame) -> DataFrame:
    """One row for each document with its chunks in order, its images, and their counts."""
    a = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "page", "chunk_type", "text"))).alias("chunks"), F.max("page").alias("total_pages"))
    b = images.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "image_index"))).alias("images"))
    out = a.join(b, "doc_id", "full")
    return out.withColumns({"n_chunks": F.coalesce(F.size("chunks"), F.lit(0)), "n_images": F.coalesce(F.size("images"), F.lit(0))})


def batch_summary(files: DataFrame) -> DataFrame:
    """(status, chunks, pages) of a batch to one row."""
    of = lambda s: F.count_if(F.col("status") == s)
    ok = lambda c: F.coalesce(F.sum(F.when(F.col("status") == "success", F.col(c))), F.lit(0))
    return files.agg(
        F.count(F.lit(1)).alias("scanned"), of("success").alias("processed"), of("skipped").alias("skipped"), of("failed").alias("failed"),
        ok("chunks").alias("total_chunks"), ok("pages").alias("total_pages"),
    )


def join_pages(pages: DataFrame, sep: str = "\n\n---\n\n") -> DataFrame:
    """(doc_id, page, markdown) to one text a document, in page order."""
    return pages.groupBy("doc_id").agg(ordered_text(["page"], "markdown", sep).alias("markdown"))


def clean_markdown(c: Column) -> Column:
    """What follows the last </think>, without a surrounding code fence."""
    s = strip(F.substring_index(c, "</think>", -1))
    inner = F.regexp_replace(F.regexp_replace(s, r"^```[^\n]*\n", ""), r"\s*```\s*$", "")
    return strip(F.when(s.startswith("```"), inner).otherwise(s))


def failed_pages(df: DataFrame) -> DataFrame:
    """doc_id, page, reason of the failure marks in a text."""
    marks = F.regexp_extract_all("markdown", F.lit(r"(?s)<!-- PAGE (\d+ FAILED: .*?) -->"), F.lit(1))
    rows = df.select("doc_id", F.explode(marks).alias("_m"))
    return rows.select("doc_id", F.substring_index("_m", " ", 1).cast("int").alias("page"), F.regexp_replace("_m", r"^\d+ FAILED: ", "").alias("reason"))
