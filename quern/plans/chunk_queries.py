"""Queries and SQL of extraction and chunk cleaning."""

from pyspark.sql import functions as F

from quern.operators import chunks as C
from quern.operators import extract as X

from .views import duck, table, view

NOT_NULL = "select doc_id, ord, text, case when page = 0 then 1 else page end as page, chunk_type from v_blocks"
MERGE = f"""with n as ({NOT_NULL}),
r as (select *, sum(case when chunk_type = 'heading' then 0 else 1 end) over (partition by doc_id order by ord) as run from n),
k as (select *, chunk_type = 'heading' and sum(case when chunk_type = 'heading' then 1 else 0 end) over (partition by doc_id, run order by ord) % 2 = 1
        and lead(1) over (partition by doc_id order by ord) is not null as m, lead(text) over (partition by doc_id order by ord) as ntext,
        lead(page) over (partition by doc_id order by ord) as npage from r),
g as (select *, coalesce(lag(m) over (partition by doc_id order by ord), false) as gone from k),
merged as (select doc_id, ord, case when m then text || chr(10) || ntext else text end as text, case when m then npage else page end as page,
        case when m then 'text' else chunk_type end as chunk_type, m as merged_heading from g where not gone)"""
CHAIN = MERGE + """,
d as (select * from (select *, row_number() over (partition by doc_id, text order by ord) as n from merged) where n = 1),
l as (select doc_id, ord, text, page, row_number() over (partition by doc_id, page order by ord) as c from d where length(text) >= 40),
v as (select *, case when not ((length(text) <= 60 and regexp_matches(text, '\\p{Lu}') and not regexp_matches(text, '\\p{Ll}')) or (length(text) <= 80 and text like '%:')) then 'body'
        when len(W(text)) <= 4 then 'section' else 'subsection' end as level from l),
s as (select *, sum(case when level = 'section' then 1 else 0 end) over (partition by doc_id order by ord) as sec from v),
f as (select *, last_value(case when level = 'section' then text end ignore nulls) over (partition by doc_id order by ord rows unbounded preceding) as section,
        last_value(case when level = 'subsection' then text end ignore nulls) over (partition by doc_id, sec order by ord rows unbounded preceding) as subsection from s),
e as (select doc_id, ord, 'p' || page || '_c' || c as chunk_id, level, section, subsection, array_to_string(W(text), ' ') as context,
        cast(len(W(text)) as int) as context_tokens, section is not null as has_heading from f)""".replace("\\\\", "\\")


def _merged(s, d):
    return C.merge_headings(C.normalize_schema(view(s, d, "v_blocks")))


def _lines(s, d):
    return view(s, d, "v_blocks").select("doc_id", "ord", F.when(F.col("chunk_type") == "heading", F.concat(F.lit("# "), "text")).otherwise(F.col("text")).alias("line"))


def _cells(s, d):
    return view(s, d, "v_cells").select("sheet", "row_no", F.array("a", "b", "c").alias("cells"))


def _pages(s, d):
    return view(s, d, "v_blocks").groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda r: r["text"]), "\n").alias("text"))


def _files(s, d):
    kinds = F.element_at(F.array(*map(F.lit, ["txt", "pdf", "TIFF", "exe", "md"])), (F.col("id") % 5 + 1).cast("int"))
    return view(s, d, "v_documents").select(F.col("id").alias("doc_id"), F.concat("file_name", F.lit("/"), F.col("id").cast("string"), F.lit("."), kinds).alias("file_path"))


LINES = "select doc_id, ord, case when chunk_type = 'heading' then '# ' || text else text end as line from v_blocks"
QUERIES = {
    "x1_paragraph_blocks": lambda s, d: X.paragraph_blocks(table(s, d, "documents"), "\n"),
    "x2_page_blocks": lambda s, d: X.page_blocks(_pages(s, d), "\n"),
    "x3_markdown_sections": lambda s, d: X.markdown_sections(_lines(s, d)),
    "x4_valid_chunks": lambda s, d: X.valid_chunks(view(s, d, "v_blocks").select("doc_id", "ord", "text")),
    "x5_table_rows_to_text": lambda s, d: X.table_rows_to_text(_cells(s, d)),
    "x6_tables_to_text": lambda s, d: X.tables_to_text(_cells(s, d)),
    "x7_tables_to_chunk": lambda s, d: X.tables_to_chunk(_cells(s, d)),
    "x8_group_ocr_lines": lambda s, d: X.group_ocr_lines(view(s, d, "v_ocr_lines")),
    "x9_ocr_fallback": lambda s, d: X.ocr_fallback(view(s, d, "v_ocr_lines"), table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("page"))),
    "x10_route_pages": lambda s, d: X.route_pages(view(s, d, "v_blocks"), view(s, d, "v_blocks").groupBy("doc_id", "page").agg((F.max("ord") % 5).alias("n_images"))),
    "x11_route_documents": lambda s, d: X.route_documents(_files(s, d), view(s, d, "v_blocks")),
    "x12_style_types": lambda s, d: X.style_types(table(s, d, "documents").select("doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "Heading ").when(F.col("doc_id") % 3 == 1, "Sub Title").otherwise("Normal"), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).otherwise("")).alias("style"))),
    "x13_assemble_documents": lambda s, d: X.assemble_documents(view(s, d, "v_blocks"), view(s, d, "v_blocks").filter("chunk_type = 'heading'").select("doc_id", "page", F.col("ord").alias("image_index"))).select("doc_id", "total_pages", "n_chunks", "n_images", F.coalesce(F.col("chunks")[0]["text"], F.lit("")).alias("first_text")),
    "x14_batch_summary": lambda s, d: X.batch_summary(table(s, d, "documents").select(F.when(F.col("doc_id") % 5 == 0, "skipped").when(F.col("doc_id") % 7 == 0, "failed").otherwise("success").alias("status"), (F.col("doc_id") % 9).alias("chunks"), (F.col("doc_id") % 4).alias("pages"))),
    "x15_join_pages": lambda s, d: X.join_pages(_pages(s, d).withColumnRenamed("text", "markdown")),
    "x16_clean_markdown": lambda s, d: view(s, d, "v_blocks").select("doc_id", "ord", X.clean_markdown(F.concat(F.when(F.col("ord") % 2 == 0, "<think>so</think>\n```markdown\n").otherwise(" "), "text", F.when(F.col("ord") % 2 == 0, "\n``` ").otherwise(" "))).alias("markdown")),
    "x17_failed_pages": lambda s, d: X.failed_pages(view(s, d, "v_blocks").select("doc_id", F.concat(F.lit("a\n<!-- PAGE "), F.col("ord").cast("string"), F.lit(" FAILED: "), "text", F.lit(" -->\nb")).alias("markdown"))),
    "c1_normalize_schema": lambda s, d: C.normalize_schema(view(s, d, "v_blocks")),
    "c2_strip_lines": lambda s, d: C.strip_lines(table(s, d, "documents").select("doc_id", F.concat(F.lit("\n  "), F.replace("text", F.lit("\n"), F.lit(" \n\t")), F.lit(" ")).alias("text"))),
    "c3_merge_headings": _merged,
    "c4_dedupe_in_document": lambda s, d: C.dedupe_in_document(_merged(s, d)),
    "c5_min_length": lambda s, d: C.min_length(view(s, d, "v_blocks")),
    "c6_chunk_ids": lambda s, d: C.chunk_ids(C.min_length(C.dedupe_in_document(_merged(s, d)))).select("doc_id", "ord", "chunk_id"),
    "c7_heading_levels": lambda s, d: C.clean(view(s, d, "v_blocks")).select("doc_id", "ord", "level"),
    "c8_fill_sections": lambda s, d: C.clean(view(s, d, "v_blocks"), segment=C.scan.SEGMENT).select("doc_id", "ord", "section", "subsection"),
    "c9_collapse_and_count": lambda s, d: C.clean(view(s, d, "v_blocks")).select("doc_id", "ord", "chunk_id", "context", "context_tokens", "has_heading"),
    "c10_render_prompts": lambda s, d: C.render_prompts(C.clean(view(s, d, "v_blocks"))).select("doc_id", "ord", F.sha2("question_prompt", 256).alias("question_sha"), F.sha2("answer_prompt", 256).alias("answer_sha")),
    "c11_first_chunks": lambda s, d: C.first_chunks(view(s, d, "v_blocks"), 5),
}


def _quote(s):
    return "'" + s.replace("'", "''") + "'"


_head = "case when coalesce(section, '') <> '' then 'SECTION: ' || section || chr(10) else '' end || case when coalesce(subsection, '') <> '' then 'SUBSECTION: ' || subsection || chr(10) else '' end || 'CONTEXT:' || chr(10) || context || chr(10) || chr(10)"
CELLS = "c as (select sheet, row_no, [a, b, c] as cells from v_cells)"
SQL = {
    "x1_paragraph_blocks": r"select doc_id, ord, S(text) as text, 1 as page from v_blocks where length(S(text)) > 5",
    "x2_page_blocks": r"select doc_id, page, cast(ord - min(ord) over (partition by doc_id, page) as int) as ord, S(text) as text from (select * from v_blocks) b qualify len(W(S(text))) > 3",
    "x3_markdown_sections": rf"""with l as ({LINES}), p as (select *, line like '#%' as head, sum(case when line like '#%' then 1 else 0 end) over (partition by doc_id order by ord) as part from l),
        g as (select doc_id, part, max(case when head then line end) as title, string_agg(line, chr(10) order by ord) filter (where not head) as body, count(*) filter (where not head) as n from p group by doc_id, part)
        select doc_id, cast(row_number() over (partition by doc_id order by part) as int) as page, S(coalesce(S(regexp_replace(title, '^#+', '')), 'Document Start') || chr(10) || body) as text from g where n > 0""",
    "x4_valid_chunks": r"select doc_id, ord, text from v_blocks where length(S(text)) >= 5 and len(W(text)) >= 3",
    "x5_table_rows_to_text": "select sheet, row_no, concat('Sheet: ', sheet, chr(10), 'Row ', row_no, ':', chr(10), 'name: ', a, chr(10), 'Column_3: ', c) as text from v_cells where row_no > 1",
    "x6_tables_to_text": "select sheet, string_agg(case when row_no = 1 then a || ' | ' || b else a || ' | ' || c end, chr(10) order by row_no) as text from v_cells group by sheet",
    "x7_tables_to_chunk": "select sheet, 'Sheet: ' || sheet || chr(10) || string_agg(a || ',' || b || ',' || c, chr(10) order by row_no) as text from v_cells group by sheet",
    "x8_group_ocr_lines": """with k as (select *, coalesce(case when y - lag(y) over (partition by page order by y, ord) >= 20 then 1 else 0 end, 0) as new from v_ocr_lines where confidence >= 0.5),
        b as (select *, sum(new) over (partition by page order by y, ord) as block from k)
        select page, cast(block as bigint) as block, string_agg(text, ' ' order by y, ord) as text, count(*) as n_lines from b group by page, block""",
    "x9_ocr_fallback": "select page, string_agg(text, chr(10) order by ord) as text from v_ocr_lines where page not in (select n_nationkey from nation) and confidence > 0.5 and S(text) <> '' group by page",
    "x10_route_pages": "select doc_id, page, cast(sum(length(text)) as bigint) as chars, sum(length(text)) < 100 or max(ord) % 5 > 3 as use_ocr from v_blocks group by doc_id, page",
    "x11_route_documents": r"""with f as (select id as doc_id, file_name || '/' || id || '.' || ['txt', 'pdf', 'TIFF', 'exe', 'md'][id % 5 + 1] as file_path from v_documents),
        t as (select doc_id, bool_or(length(S(text)) > 0) as has_text from v_blocks group by doc_id)
        select f.doc_id, file_path, case when file_path like '%.TIFF' then 'ocr' when file_path like '%.exe' then 'unsupported' when coalesce(has_text, false) then 'native' else 'ocr' end as route from f left join t on f.doc_id = t.doc_id""",
    "x12_style_types": """with s as (select doc_id, case doc_id % 3 when 0 then 'Heading ' when 1 then 'Sub Title' else 'Normal' end || case when doc_id % 2 = 0 then cast(doc_id as varchar) else '' end as style from documents)
        select doc_id, style, case doc_id % 3 when 0 then 'heading' when 1 then 'title' else 'paragraph' end as chunk_type,
        case doc_id % 3 when 0 then case when doc_id % 2 = 0 then cast(doc_id as int) else 1 end when 1 then 0 end as heading_level from s""",
    "x13_assemble_documents": "select doc_id, max(page) as total_pages, cast(count(*) as int) as n_chunks, cast(count(*) filter (where chunk_type = 'heading') as int) as n_images, arg_min(text, ord) as first_text from v_blocks group by doc_id",
    "x14_batch_summary": """with f as (select case when doc_id % 5 = 0 then 'skipped' when doc_id % 7 = 0 then 'failed' else 'success' end as status, doc_id % 9 as chunks, doc_id % 4 as pages from documents)
        select count(*) as scanned, count(*) filter (where status = 'success') as processed, count(*) filter (where status = 'skipped') as skipped, count(*) filter (where status = 'failed') as failed,
        cast(sum(chunks) filter (where status = 'success') as bigint) as total_chunks, cast(sum(pages) filter (where status = 'success') as bigint) as total_pages from f""",
    "x15_join_pages": "with p as (select doc_id, page, string_agg(text, chr(10) order by ord) as text from v_blocks group by doc_id, page) select doc_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by page) as markdown from p group by doc_id",
    "x16_clean_markdown": "select doc_id, ord, S(text) as markdown from v_blocks",
    "x17_failed_pages": "select doc_id, ord as page, text as reason from v_blocks",
    "c1_normalize_schema": NOT_NULL,
    "c2_strip_lines": r"select doc_id, array_to_string(list_transform(string_split(S(text), chr(10)), lambda l: S(l)), chr(10)) as text from documents",
    "c3_merge_headings": MERGE + " select * from merged",
    "c4_dedupe_in_document": MERGE + " select * from merged qualify row_number() over (partition by doc_id, text order by ord) = 1",
    "c5_min_length": "select * from v_blocks where length(text) >= 40",
    "c6_chunk_ids": CHAIN + " select doc_id, ord, chunk_id from e",
    "c7_heading_levels": CHAIN + " select doc_id, ord, level from e",
    "c8_fill_sections": CHAIN + " select doc_id, ord, section, subsection from e",
    "c9_collapse_and_count": CHAIN + " select doc_id, ord, chunk_id, context, context_tokens, has_heading from e",
    "c10_render_prompts": CHAIN + " select doc_id, ord, " + ", ".join(f"sha256({_quote(a)} || {_head} || {_quote(b)}) as {n}" for n, (a, b) in (("question_sha", C.QUESTION_PROMPT), ("answer_sha", C.ANSWER_PROMPT))) + " from e",
    "c11_first_chunks": "select * from v_blocks qualify row_number() over (partition by doc_id order by ord) <= 5",
}
ORACLE_SQL = {k: duck(v) for k, v in SQL.items()}
